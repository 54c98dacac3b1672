"""Spelling variants: words one edit apart, by neighbourhoods of reduced words.

Letters are hashed to a few symbols. Two words one edit apart have reduced words that are equal or
one edit apart, so the whole one-edit neighbourhood of every reduced word is joined with the
reduced vocabulary, and what meets there names the words to look at and the place of the edit.
The words themselves are then compared by what the edit leaves of them at that place: an
equality again, so words that merely share a reduced word are never paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, marked, settled

#: A run of letters, and the capitals that are lower-cased.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters that a lower-cased run can hold.
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
SYMBOLS = "0123"
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A form is at least so many times as frequent as its variant.
RATIO = 5
#: One in so many runs loses a letter.
NOISE = 199
REDUCED_BITS = 1 << 25


def reduced(word: Column, symbols: str = SYMBOLS) -> Column:
    """The word with a symbol for each letter: the letter's code point modulo their number."""
    return F.translate(word, LETTERS, "".join(symbols[ord(c) % len(symbols)] for c in LETTERS))


def _without(word: Column, place: Column) -> Column:
    """The word less the code point at a place counted from 1."""
    return F.concat(F.substr(word, F.lit(1), place - 1), F.substr(word, place + 1))


def _damaged(run: Column, doc_id: Column) -> Column:
    """The run, less one letter where its digest with the document's id says so."""
    digest = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    place = (digest % F.length(run) + 1).cast("int")
    return F.when(digest % NOISE == 0, _without(run, place)).otherwise(run)


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``(word, n)``: words of enough letters and occurrences over whole texts.

    A run too short for a word is left out at once, since it can only get shorter.
    """
    runs = docs.select(F.col(id_col).alias("_id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("_run"))
    # most runs have no capitals; what changes them one by one is dear
    lowered = F.when(F.lower("_run") == F.col("_run"), F.col("_run")).otherwise(F.translate("_run", UPPER, LOWER))
    words = (
        runs.where(F.length("_run") >= least_letters).select("_id", lowered.alias("_run"))
        .select(_damaged(F.col("_run"), F.col("_id")).alias("word"))
    )
    return (
        words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_count)
    )


def reduced_edges(known: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """``(r, edit, at, r2)``: reduced words of ``known(r)`` one edit apart, and where.

    Of two reduced words of one length the one with the smaller symbol makes the replacement,
    of two lengths the longer one the deletion; an insertion is the same pair seen from the
    shorter one. So each pair comes once per place. A bitmap of the reduced vocabulary tells most
    neighbours that no word has before they are shuffled.
    """
    r, at = F.col("r"), F.col("at")
    places = known.select("r", F.explode(F.sequence(F.lit(1), F.length("r"))).alias("at"))
    own = F.substr(r, at, F.lit(1))
    replaced = F.transform(
        F.filter(F.array(*[F.lit(s) for s in symbols]), lambda s: s > own),
        lambda s: F.struct(F.lit("sub").alias("edit"), F.concat(F.substr(r, F.lit(1), at - 1), s, F.substr(r, at + 1)).alias("r2")),
    )
    deleted = F.array(F.struct(F.lit("del").alias("edit"), _without(r, at).alias("r2")))
    near = places.select("r", "at", F.explode(F.concat(replaced, deleted)).alias("_e")).select("r", "at", "_e.edit", "_e.r2")
    likely = marked(near, F.col("r2"), bitmap(known, "r", REDUCED_BITS), "_may", REDUCED_BITS).where("_may")
    return likely.join(known.select(F.col("r").alias("r2")), "r2").select("r", "edit", "at", "r2")


def near_pairs(words: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """``(word, n, other, other_n)``: words of ``words(word, n)`` one edit apart, each pair both ways."""
    spelt = settled(words.select("word", "n", reduced(F.col("word"), symbols).alias("r")))
    known = settled(spelt.select("r").distinct())
    word, at = F.col("word"), F.col("at")
    places = F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at")
    rest = _without(word, at)

    # what is left when the edit at a place is undone; the reduced words and the place must agree
    edges = reduced_edges(known, symbols)
    of_edges = spelt.join(edges, "r").select("word", "n", "edit", "at", F.col("r2").alias("to"), rest.alias("rest"))
    # a deletion inside a run of one letter is made at the run's first place only
    first = (F.col("edit") == "sub") | (at == 1) | (F.substr(word, at - 1, F.lit(1)) != F.substr(word, at, F.lit(1)))
    by_place = spelt.select("word", "n", "r", places)
    alike = by_place.select("word", "n", F.lit("sub").alias("edit"), "at", F.col("r").alias("to"), rest.alias("rest"))
    whole = spelt.select(
        "word", "n", F.lit("del").alias("edit"), F.lit(0).alias("at"), F.col("r").alias("to"), F.col("word").alias("rest")
    )
    # reduced words fit whenever letters do: the key holds both, and the place of a replacement
    place = F.when(F.col("edit") == "sub", at).otherwise(0)
    key = F.xxhash64("edit", place, "to", "rest")

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select(key.alias("_key"), "word", "n", "edit", "at")

    left = keyed(of_edges.where(first)).unionByName(keyed(alike)).select("_key", "word", "n", "edit", "at")
    right = keyed(alike).unionByName(keyed(whole)).select(
        "_key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("edit").alias("_edit"), F.col("at").alias("_at")
    )
    other = F.col("other")
    replaced = (
        (F.col("_edit") == "sub") & (at == F.col("_at")) & (F.length(word) == F.length(other)) & (word != other)
        & (rest == _without(other, at))
        # within one reduced word both are on both sides
        & ((reduced(word, symbols) != reduced(other, symbols)) | (word < other))
    )
    verified = (F.col("edit") == F.col("_edit")) & F.when(F.col("edit") == "sub", replaced).otherwise(rest == other)
    met = left.join(right, "_key").where(verified)
    both = F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
    )
    return met.select(F.explode(both).alias("_p")).select("_p.*")


def followed(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: the last word of each chain of forms.

    Every round each word takes what its present end points to, so chains shorten by halves.
    Forms grow in frequency, so chains end; running out of rounds raises.
    """
    chains = settled(forms.select("word", F.col("form").alias("root")))
    for _ in range(max_rounds):
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        chains = settled(chains.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if chains.where("_moved").isEmpty():
            return chains.select("word", "root")
        chains = chains.select("word", "root")
    raise RuntimeError("chains of forms did not end")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    symbols: str = SYMBOLS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, a row per word of :func:`vocabulary`.

    ``n_near`` counts the words one inserted, deleted or replaced code point away; ``form`` is the
    most frequent of them (the smallest by code points of several) if it is ``ratio`` times as
    frequent as the word, else null; ``root`` is where the chain of forms ends.

    Null texts have no runs, and a null id stands as an empty one where runs are damaged; rows
    that repeat count as often as they stand there. An empty table gives an empty result. Other
    columns are not read. A word has at most some two thousand words near it, whatever the
    corpus: that bounds every key of the last joins.
    """
    words = settled(vocabulary(docs, id_col, text_col, least_letters, least_count))
    pairs = near_pairs(words, symbols)
    # the largest n first, then the smallest word: n falls as its negative rises
    best = F.min(F.struct((-F.col("other_n")).alias("_n"), F.col("other").alias("_word")))
    near = pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    is_form = -F.col("_best._n") >= F.lit(ratio) * F.col("n")
    found = settled(
        near.select(
            "word", "n_near",
            F.when(is_form, F.col("_best._word")).alias("form"),
            F.when(is_form, -F.col("_best._n")).alias("form_n"),
        )
    )
    roots = followed(found.where("form IS NOT NULL").select("word", "form"))
    return (
        words.join(found, "word", "left").join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# The CRC is taken bit by bit: eight steps for each of 256 bytes give the table that its bytes use.
SQL = rf"""
WITH RECURSIVE steps AS (
  SELECT range AS byte, range::UBIGINT AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(0, length(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) AS h
  FROM counted, crc),
spelt AS (
  SELECT CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM hashed),
vocab AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN vocab b ON a.rest = b.word),
near AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM pairs),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(near.n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * v.n THEN other END AS form,
         CASE WHEN other_n >= {RATIO} * v.n THEN other_n END AS form_n
  FROM vocab v LEFT JOIN near ON near.word = v.word AND near.k = 1),
chain AS (
  SELECT word, word AS root, form AS ahead FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.ahead)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.ahead IS NULL"""
