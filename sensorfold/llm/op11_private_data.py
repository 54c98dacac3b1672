"""Personal data: proposed spans, boosted trees over their format and context, calibrated thresholds.

Generators of high recall propose overlapping spans of four kinds. A strict rule per kind confirms
some of them: the base spans, which always stay. Boosted trees of two levels learn from those what
confirmed data look like: digit groups, marks, neighbours, words of cue, but neither the checksum
nor the leading plus by which the rules confirm. Every proposal that no rule confirmed is scored,
and goes where it looks as much like personal data as nearly all confirmed data of its kind do and
where, by held-out documents, that makes it likely enough.

All of it is DataFrame functions. Texts are read once; training sees counts of equal feature
vectors, gathered into histograms of a fixed size per split, in whole numbers, so no order of
additions shows and reruns agree.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bitmap, marked, settled

KINDS = ("email", "ip", "card", "phone")

# The strict form of each kind. Loops take what they can and give nothing back
# (``++``), and a search begins where a run does (``\G`` or a look behind): the same matches as
# without, in a time that grows with the text and on a stack that does not.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

#: What the generators propose: kind and pattern. Lengths are bounded, so each span is short.
GENERATORS = [
    ("email", r"[\p{L}0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[\p{L}0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[\p{L}0-9-]{1,63}){1,8}"),
    ("email", r"[\p{L}0-9._%+-]{1,64}\x20at\x20[\p{L}0-9-]{1,63}(?:\x20dot\x20[\p{L}0-9-]{1,63}){1,8}"),
    ("ip", r"(?<![0-9.])[0-9]{1,6}(?:\x20?(?:\.|\[\.\]|,)\x20?[0-9]{1,6}){3}(?![0-9])"),
    ("ip", r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9])[0-9](?:[\x20\u00A0./_-]{0,2}[0-9]){11,18}(?![0-9])"),
    ("phone", r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[\x20\u00A0()./-]{0,3}[0-9]){6,14}(?![0-9])"),
]
# What a text must hold for a pattern to be tried at all.
_NEEDS = [("@", "(at)", "[at]"), (" dot ",), None, (":",), None, None]

#: Words before a span that hint at its kind, and characters looked at.
CUES = [
    r"(?i)(?:phone|tel|call|fax|mobile|cell|sms|whatsapp)",
    r"(?i)(?:mail|contact|write to|reply)",
    r"(?i)(?:\bip\b|host|server|address|client)",
    r"(?i)(?:card|visa|account|iban|payment|credit)",
    r"(?i)(?:token|key|hash|isbn|serial|version|license|order)",
]
CUE_CHARS = 24

TREES = 10
RATE = 0.6
RIDGE = 4.0
#: One document in so many is held out of training to calibrate the thresholds.
HELD_OUT = 5
#: Share of a kind's confirmed spans that its threshold lets through, and the least share of
#: confirmed ones among held-out proposals of a score that may be redacted.
RECALL = 0.95
LEAST = 0.05
#: Scores are whole thousandths of a logit, gradients whole millionths.
MILLI, MICRO = 1_000, 1_000_000


# --- spans of a pattern ------------------------------------------------------------


def _running(lengths: Column) -> Column:
    """Sums of all numbers before each; in blocks, as an array that grows is copied each time."""
    block = 256

    def sums(numbers: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(numbers, zero, step, lambda acc: acc["out"])

    zero = F.lit(0).cast("bigint")
    places = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int"))
    blocks = F.transform(places, lambda b: F.slice(lengths, b * block + 1, F.lit(block)))
    totals = F.transform(blocks, lambda numbers: F.aggregate(numbers, zero, lambda acc, x: acc + x))
    return F.when(F.size(lengths) > 0, F.flatten(F.zip_with(blocks, sums(totals, zero), sums))).otherwise(
        F.array().cast("array<bigint>")
    )


def _found(rows: DataFrame, searches: dict[str, tuple[str, tuple[str, ...] | None]]) -> DataFrame:
    """Adds a column per search: its matches ``(start, end, hit, before, after)``, leftmost first.

    Places count code points from 0. The text between matches gives the places and the context.
    """
    names = rows.columns
    for name, (pattern, needs) in searches.items():
        text = F.col("_text")
        worth = reduce(Column.__or__, [F.contains(text, F.lit(n)) for n in needs]) if needs else F.col("_digits")
        hits = F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        rows = rows.select("*", hits.alias("_hits"))
        pieces = F.when(F.size("_hits") > 0, F.split(text, pattern)).otherwise(F.array().cast("array<string>"))
        rows = rows.select("*", pieces.alias("_pieces"))
        between = F.slice("_pieces", 1, F.size("_hits"))
        steps = F.zip_with(between, F.col("_hits"), lambda p, h: (F.length(p) + F.length(h)).cast("bigint"))
        rows = rows.select("*", _running(steps).alias("_at"))
        spans = F.transform(
            F.col("_hits"),
            lambda hit, i: F.struct(
                (F.col("_at")[i] + F.length(F.col("_pieces")[i])).alias("start"),
                (F.col("_at")[i] + F.length(F.col("_pieces")[i]) + F.length(hit)).alias("end"),
                hit.alias("hit"),
                F.right(F.col("_pieces")[i], F.lit(CUE_CHARS)).alias("before"),
                F.left(F.col("_pieces")[i + 1], F.lit(1)).alias("after"),
            ),
        )
        names = [*names, name]
        rows = rows.select("*", spans.alias(name)).select(*names)
    return rows


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits."""
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(backwards, i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _confirmed(kind: str, hit: Column) -> Column:
    """The condition that a match of the strict form must meet as well."""
    if kind == "ip":
        return F.rlike(hit, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    digits = _digits(hit)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``_id, _h1, _h2`` (a digest of id and text), ``base(kind, start, end)`` and
    ``proposed(kind, start, end, hit, before, after)``. One pass over the texts, no shuffle."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    rows = docs.select(F.col(id_col).alias("_id"), text)
    rows = rows.select("*", F.rlike("_text", F.lit("[0-9]")).alias("_digits"))
    searches = {f"_b{k}": (BASE[kind], ("@",) if kind == "email" else ("+",) if kind == "phone" else None) for k, kind in enumerate(KINDS)}
    searches |= {f"_g{k}": (pattern, _NEEDS[k]) for k, (_, pattern) in enumerate(GENERATORS)}
    found = _found(rows, searches)

    def base(k: int, kind: str) -> Column:
        fit = F.filter(f"_b{k}", lambda s: _confirmed(kind, s["hit"]))
        return F.transform(fit, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def proposed(k: int, kind: str) -> Column:
        number = F.lit(KINDS.index(kind)).alias("kind")
        fields = ("start", "end", "hit", "before", "after")
        return F.transform(f"_g{k}", lambda s: F.struct(number, *[s[f].alias(f) for f in fields]))

    identity = [F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_id").isNull(), F.col("_text")]
    return found.select(
        "_id",
        F.xxhash64(F.lit(1), *identity).alias("_h1"),
        F.xxhash64(F.lit(2), *identity).alias("_h2"),
        F.concat(*[base(k, kind) for k, kind in enumerate(KINDS)]).alias("base"),
        F.concat(*[proposed(k, kind) for k, (kind, _) in enumerate(GENERATORS)]).alias("proposed"),
    )


# --- features and labels -----------------------------------------------------------


def _side(char: Column) -> Column:
    """0 for an end of the text or a space, 1 a letter, 2 a digit, 3 a quote, bar or bracket, 4 others."""
    return (
        F.when((char == "") | F.rlike(char, F.lit(r"^\s")), 0).when(F.rlike(char, F.lit(r"^\p{L}")), 1)
        .when(F.rlike(char, F.lit("^[0-9]")), 2).when(F.rlike(char, F.lit(r"""^["'|()\[\]{}<>=]""")), 3).otherwise(4)
    )


#: Marks counted in a span, and the names of all features.
MARKS = {"space": r"[\s\u00A0]", "dot": r"\.", "dash": "-", "bracket": r"[()\[\]]", "slash": "[/_]", "colon": ":", "at": "@", "comma": ","}
FEATURES = ["kind", "digits", "letters", "groups", "longest", "first", "last", "left", "right", "cue", *MARKS]


def feature_columns() -> dict[str, Column]:
    """Small whole numbers from ``kind, hit, before, after``, in the order of :data:`FEATURES`."""
    hit, before = F.col("hit"), F.col("before")
    groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    longest = F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0))
    count = lambda pattern: F.regexp_count(hit, F.lit(pattern))
    cue = F.lit(0)
    for k, words in reversed(list(enumerate(CUES, 1))):
        cue = F.when(F.rlike(before, F.lit(words)), k).otherwise(cue)
    return {
        "kind": F.col("kind"),
        "digits": F.least(count("[0-9]"), F.lit(24)),
        "letters": F.least(count(r"\p{L}"), F.lit(16)),
        "groups": F.least(F.size(groups), F.lit(8)),
        "longest": F.least(longest, F.lit(20)),
        "first": F.least(F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)), F.lit(8)),
        "last": F.least(F.coalesce(F.length(F.element_at(F.concat(F.array(F.lit("")), groups), -1)), F.lit(0)), F.lit(8)),
        "left": _side(F.right(before, F.lit(1))),
        "right": _side(F.col("after")),
        "cue": cue,
        **{name: F.least(count(pattern), F.lit(6)) for name, pattern in MARKS.items()},
    }


def labelled(found: DataFrame) -> DataFrame:
    """A row per proposal: its place, its features, ``sure`` (a base span of its kind lies in it,
    in part at least) and ``open`` (no base span of any kind does).

    Per document the base spans on either side of a proposal are told by running ends and
    starts: two sorts of narrow rows, however many spans a document has.
    """
    key = ["_h1", "_h2"]
    numbers = list(range(len(KINDS)))
    given = found.where("size(base) > 0 AND size(proposed) > 0").select(*key, F.explode("base").alias("_s")).select(
        *key, "_s.*", F.lit(True).alias("_base")
    )
    asked = found.where("size(proposed) > 0").select(*key, F.explode("proposed").alias("_s")).select(
        *key, "_s.*", F.lit(False).alias("_base")
    )
    rows = asked.unionByName(given, allowMissingColumns=True)
    ahead = W.partitionBy(*key).orderBy("start").rangeBetween(W.unboundedPreceding, 0)
    back = W.partitionBy(*key).orderBy(F.desc("start")).rangeBetween(W.unboundedPreceding, 0)
    own = lambda k: F.col("_base") & (F.col("kind") == k)
    rows = rows.select("*", *[F.max(F.when(own(k), F.col("end"))).over(ahead).alias(f"_end{k}") for k in numbers])
    rows = rows.select("*", *[F.min(F.when(own(k), F.col("start"))).over(back).alias(f"_start{k}") for k in numbers])
    meets = [F.coalesce(F.col(f"_end{k}") > F.col("start"), F.lit(False)) | F.coalesce(F.col(f"_start{k}") < F.col("end"), F.lit(False)) for k in numbers]
    sure = reduce(Column.__or__, [(F.col("kind") == k) & meets[k] for k in numbers])
    features = feature_columns()
    return rows.where("NOT _base").select(
        *key, "start", "end", *[c.cast("int").alias(f"f_{n}") for n, c in features.items()],
        sure.alias("sure"), (~reduce(Column.__or__, meets)).alias("open"),
    )


# --- boosted trees -----------------------------------------------------------------


class Tree(NamedTuple):
    """Feature and cut of the root and of both its sides (at most the cut: left), four leaves."""

    root: tuple[str, int]
    left: tuple[str, int]
    right: tuple[str, int]
    leaves: tuple[int, int, int, int]


def margin(trees: list[Tree]) -> Column:
    """Sum of the leaves a row falls into."""
    low = lambda split: F.col(f"f_{split[0]}") <= split[1]
    total = F.lit(0)
    for t in trees:
        a, b, c, d = t.leaves
        total = total + F.when(low(t.root), F.when(low(t.left), a).otherwise(b)).otherwise(F.when(low(t.right), c).otherwise(d))
    return total


def best_split(histogram: dict[str, dict[int, tuple[int, int]]]) -> tuple[str, int, int, int]:
    """Feature, cut and both leaves of the best gain; of equal ones the first feature and least cut.

    ``histogram`` has sums of gradient and curvature per feature and value.
    """
    gain = lambda g, h: g * g / (h + RIDGE * MICRO)
    leaf = lambda g, h: round(MILLI * RATE * g / (h + RIDGE * MICRO))
    best = None
    for feature in FEATURES:
        bins = histogram.get(feature, {})
        whole_g, whole_h = (sum(b[k] for b in bins.values()) for k in (0, 1))
        g = h = 0
        for value in sorted(bins):
            g, h = g + bins[value][0], h + bins[value][1]
            score = gain(g, h) + gain(whole_g - g, whole_h - h)
            if best is None or score > best[0] * (1 + 1e-12):
                best = (score, feature, value, leaf(g, h), leaf(whole_g - g, whole_h - h))
    return best[1:] if best else (FEATURES[0], 0, 0, 0)


def fit(vectors: DataFrame, trees: int = TREES) -> list[Tree]:
    """Boosted trees from ``vectors(f_..., sure, n)``. What comes back per split is a row per
    feature, value and side: a few hundred, whatever the corpus."""
    values = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"f_{f}").alias("value")) for f in FEATURES])

    def histograms(grown: list[Tree], root: tuple[str, int] | None) -> list[dict]:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(margin(grown) / F.lit(-float(MILLI))))
        gradient = F.round((F.col("sure") - F.col("n") * p) * MICRO).cast("long")
        curvature = F.round(F.col("n") * p * (F.lit(1.0) - p) * MICRO).cast("long")
        side = F.when(F.col(f"f_{root[0]}") <= root[1], 0).otherwise(1) if root else F.lit(0)
        rows = (
            vectors.select(side.alias("side"), gradient.alias("g"), curvature.alias("h"), F.explode(values).alias("_v"))
            .groupBy("side", "_v.feature", "_v.value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        )
        out: list[dict] = [{}, {}]
        for r in rows:
            out[r["side"]].setdefault(r["feature"], {})[r["value"]] = (r["g"], r["h"])
        return out

    grown: list[Tree] = []
    for _ in range(trees):
        root = best_split(histograms(grown, None)[0])[:2]
        left, right = (best_split(side) for side in histograms(grown, root))
        tree = Tree(root, left[:2], right[:2], (*left[2:], *right[2:]))
        if not any(tree.leaves):
            break
        grown.append(tree)
    return grown


def calibrated(scores: list[tuple[int, int, int]]) -> dict[int, float]:
    """Share of sure proposals by score, made to rise with the score by pooling neighbours."""
    pools: list[list] = []
    for score, sure, n in sorted(scores):
        pools.append([[score], sure, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    return {score: sure / n for members, sure, n in pools for score in members}


def threshold(scores: list[tuple[int, int, int]], recall: float = RECALL, least: float = LEAST) -> int | None:
    """The score from which proposals go: ``recall`` of the sure ones have it, and its calibrated
    share is ``least`` or more. None without sure ones. ``scores`` holds (score, sure, all)."""
    sure = sum(s for _, s, _ in scores)
    if not sure:
        return None
    share, seen, reached = calibrated(scores), 0, None
    for score, s, _ in sorted(scores, reverse=True):
        seen, reached = seen + s, score
        if seen >= recall * sure:
            break
    fit_ = [score for score, p in share.items() if p >= least and score >= reached]
    return min(fit_, default=None)


class Model(NamedTuple):
    trees: list[Tree]
    thresholds: dict[int, int]


def train(rows: DataFrame, trees: int = TREES, recall: float = RECALL, least: float = LEAST) -> Model:
    """Trees and a threshold per kind from all of ``labelled(...)``.

    Documents are held out by their digest. A kind without sure spans has no threshold; without
    both sure and other proposals there is nothing to learn, and nothing is added.
    """
    names = [f"f_{f}" for f in FEATURES]
    kept = F.pmod("_h1", F.lit(HELD_OUT)) == 0
    vectors = settled(
        rows.groupBy(*names, kept.alias("_held")).agg(F.count_if("sure").alias("sure"), F.count(F.lit(1)).alias("n"))
    )
    total = vectors.where("NOT _held").agg(F.sum("sure"), F.sum("n")).first()
    if not total[0] or total[0] == total[1]:
        return Model([], {})
    grown = fit(vectors.where("NOT _held"), trees)
    by_score = (
        vectors.where("_held").groupBy("f_kind", (F.round(margin(grown) / 100.0) * 100).cast("int").alias("score"))
        .agg(F.sum("sure").alias("sure"), F.sum("n").alias("n")).collect()
    )
    scores: dict[int, list] = {}
    for r in by_score:
        scores.setdefault(r["f_kind"], []).append((r["score"], r["sure"], r["n"]))
    limits = {kind: threshold(found, recall, least) for kind, found in scores.items()}
    return Model(grown, {kind: limit for kind, limit in limits.items() if limit is not None})


def selected(rows: DataFrame, model: Model) -> DataFrame:
    """``_h1, _h2, kind, start, end``: open proposals at or above their kind's threshold; those that
    overlap become one span of the best-scored one's kind."""
    limit = F.lit(None).cast("int")
    for kind, score in model.thresholds.items():
        limit = F.when(F.col("f_kind") == kind, score).otherwise(limit)
    score = (F.round(margin(model.trees) / 100.0) * 100).cast("int")
    key = ["_h1", "_h2"]
    chosen = rows.where("open").select(*key, "start", "end", "f_kind", score.alias("score"), limit.alias("limit")).where("score >= limit")
    order = W.partitionBy(*key).orderBy("start", "end", "f_kind")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    marked_rows = chosen.select("*", F.coalesce((F.col("start") >= before).cast("int"), F.lit(1)).alias("_new"))
    return (
        marked_rows.select("*", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("_island"))
        .groupBy(*key, "_island")
        .agg(
            F.min(F.struct((-F.col("score")).alias("s"), "start", "f_kind"))["f_kind"].alias("kind"),
            F.min("start").alias("start"), F.max("end").alias("end"),
        )
        .select(*key, "kind", "start", "end")
    )


# --- results -----------------------------------------------------------------------


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by kind, then start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, ``n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256``,
    ``spans`` (all of them), ``found`` (the same as an array of kind, start, end), and the digest
    ``_h1, _h2`` of id and text.

    Places are code points, ends exclusive. A null text counts as empty. Rows that repeat an id
    each get a row; rows alike in id and text have the same spans. An empty table gives an
    empty result; other columns are not read. Added spans lie beside the base spans, never on them.
    """
    found = settled(proposals(docs, id_col, text_col))
    rows = settled(labelled(found))
    more = selected(rows, train(rows)).groupBy("_h1", "_h2").agg(F.collect_list(F.struct("kind", "start", "end")).alias("_more"))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    spans = F.concat("base", F.coalesce("_more", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))
    return (
        found.select("_id", "_h1", "_h2", "base").join(more, ["_h1", "_h2"], "left")
        .select(
            F.col("_id").alias(id_col), *counts, F.sha2(F.encode(_joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
            _joined(spans).alias("spans"), F.array_sort(spans).alias("found"), "_h1", "_h2",
        )
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans by the first one's.

    Only texts with spans are shuffled, told by a bitmap of fixed size; all others pass as they are.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    identity = [F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(id_col).isNull(), text]
    keyed = docs.withColumns({"_h1": F.xxhash64(F.lit(1), *identity), "_h2": F.xxhash64(F.lit(2), *identity)})
    hits = settled(find_private(docs, id_col, text_col).where("size(found) > 0").select("_h1", "_h2", "found").distinct())
    near = marked(keyed, F.col("_h1"), bitmap(hits, "_h1"), "_may")
    tags = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    by_start = F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(F.col(text_col), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, tags[s["kind"]])).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    rest = lambda acc: F.concat(acc["out"], F.substr(F.col(text_col), (acc["at"] + 1).cast("int")))
    hit = near.where("_may").join(hits, ["_h1", "_h2"], "left")
    changed = hit.withColumn(text_col, F.when(F.col("found").isNull(), F.col(text_col)).otherwise(F.aggregate(by_start, zero, step, rest)))
    return near.where("NOT _may").select(*docs.columns).unionByName(changed.select(*docs.columns))


def op11_private_data(spark, sf_dir: str) -> DataFrame:
    return find_private(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found", "_h1", "_h2")
