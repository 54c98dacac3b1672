import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorfold.llm.op12_spelling import LETTERS, followed, near_pairs, reduced, spelling_variants, vocabulary

SHAPE = "doc_id bigint, text string, source string"
UPPER = {i: i + 32 for i in range(65, 91)}


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    words = brute_words(rows)
    near = {w: [o for o in words if is_near(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o.encode()), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s") for i, t in rows], SHAPE)


def rows_of(seed, n_docs=60):
    """Words over few letters, so that edits and runs of a letter abound; some are frequent."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aabÀé") for _ in range(rng.randint(5, 8))) for _ in range(40)]
    for _ in range(160):
        word, at = rng.choice(words), rng.randrange(6)
        words.append(word[:at] + rng.choice(["", "a", "b", "aa"]) + word[at + rng.randint(0, 1) :])
    weights = [rng.choice((1, 1, 1, 6, 40, 250)) for _ in words]
    docs = [(k, " ".join(rng.choices(words, weights, k=200))) for k in range(n_docs)]
    return docs + [
        (None, "Colour colour COLOUR colour; colour-colour"), (7, None), (8, ""), (9, "12 !"), (docs[0][0], docs[0][1]),
        (docs[0][0], docs[0][1]), (10, "color " * 400 + "x" * 30_000), (11, "colours " * 30 + "×÷×÷×÷ " * 6 + "×÷×÷×a " * 40 + "ÉÉÉÉÉÉ " * 9),
    ]


@pytest.mark.parametrize("symbols", ["0123", "0", "01234567"])
def test_against_brute_force(spark, crowded, symbols):
    rows = rows_of(len(symbols))
    got = spelling_variants(crowded(frame(spark, rows)).repartition(4), symbols=symbols)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(f is not None for _, f, *_ in want) and any(n > 2 for *_, n, _ in want)


def test_every_pair_once(spark):
    words = ["aaaaaa", "aaaaaaa", "aaaaaab", "baaaaaa", "abaaaaa", "aaaaab", "bbbbbb"]
    got = near_pairs(spark.createDataFrame([(w, 9) for w in words], "word string, n bigint"))
    pairs = [(r["word"], r["other"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if is_near(a, b)}


def test_no_rows(spark):
    assert spelling_variants(frame(spark, [])).count() == 0
    assert spelling_variants(frame(spark, [(1, None), (2, "few words")])).count() == 0


def test_vocabulary_drops_letters(spark):
    rows = [(i, f"abcdefg{chr(97 + i % 26)}hij " * 5) for i in range(800)]
    got = {r["word"]: r["n"] for r in vocabulary(frame(spark, rows)).collect()}
    assert got == brute_words(rows) and any(len(w) == 10 for w in got)


def test_reduced_words_take_every_letter(spark):
    got = spark.range(1).select(reduced(F.lit(LETTERS)).alias("r")).first()["r"]
    assert len(got) == len(LETTERS) and set(got) == set("0123")


def test_long_chains_end(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(70)]
    got = followed(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r["root"] for r in got} == {"w70"} and len(got) == 70
