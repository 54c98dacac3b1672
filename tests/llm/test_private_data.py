import functools
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sensorfold.llm import op11_private_data as op
from sensorfold.llm.op11_private_data import KINDS, Tree, find_private, proposals, redact

SHAPE = "doc_id bigint, text string, source string"
# As the contract spells them.
STRICT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def confirmed(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


@functools.cache
def brute_base(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(STRICT[k], text or "") if confirmed(k, m[0])]


def as_python(pattern):
    """A generator's pattern for Python: letters and possessive loops are spelled otherwise."""
    letters = "A-Za-zÀ-ÖØ-öø-ÿ"
    return pattern.replace(r"\p{L}", letters)


def brute_proposals(text):
    out = []
    for kind, pattern in op.GENERATORS:
        for m in re.finditer(as_python(pattern), text or ""):
            out.append((KINDS.index(kind), m.start(), m.end(), m[0]))
    return out


def card(rng, ok=True):
    while True:
        digits = "".join(rng.choice("0123456789") for _ in range(16))
        if luhn(digits) == ok:
            return digits


def corpus(seed=3, n=240):
    rng = random.Random(seed)
    words = lambda: " ".join(rng.choice(["été", "and", "the", "größe", "ñandú", "of", "is"]) for _ in range(rng.randint(1, 9)))
    kinds = [
        lambda: f"{rng.choice('abc')}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com",
        lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        lambda: card(rng),
        lambda: f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}",
        lambda: 'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"',
        lambda: f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}.",
        lambda: "",
    ]
    rows = [(i, " ".join([words(), rng.choice(kinds)(), words(), rng.choice(kinds)(), words()])) for i in range(n)]
    return rows + EDGES


EDGES = [
    (1000, None), (1001, ""), (1002, "a@b.c%d@e.f a@b@c.d .@x.y ..a@-.- a@b. a@b"), (1003, "1.2.3.4.5.6.7.8 256.1.1.1 000001.2.3.255 1.2.3"),
    (1004, "0" * 13 + " " + "0" * 20 + " 4111-1111 1111-1111 4111  1111 1111 1111"), (1005, "+1 (212) 555-1234) +12345678 +1 2 3 4 5 6 7 8 9 ++123456789-"),
    (1006, "😀 é@x.fr 😀a@b.co😀1.1.1.1😀"), (1007, "9" * 2_000 + " x"), (1008, "a" * 2_000 + " b"), (1009, "a.b@" + "c." * 900 + "d"),
    (1010, "1.1.1.1 " * 300 + "é 2.2.2.2"), (1011, "+" * 900 + "1 " * 900), (1002, "a@b.c"), (1002, "a@b.c"), (None, "x@y.zz"), (None, "x@y.zz"),
    (1012, "write to kim (at) example (dot) com or kim at example dot com"), (1013, "fe80::1:2:3:4 12:30:45"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s") for i, t in rows], SHAPE)


def text_of(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


@pytest.fixture(scope="module")
def found(spark):
    rows = corpus()
    return rows, find_private(frame(spark, rows).repartition(3)).collect()


def test_base_spans_against_brute_force(found):
    rows, got = found
    want = []
    for i, text in rows:
        base = brute_base(text)
        want.append((i, *[sum(k == kind for k, *_ in base) for kind in KINDS], hashlib.sha256(text_of(base).encode()).hexdigest()))
    have = [(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_added_spans_stand_beside_base_spans(found):
    rows, got = found
    ids = [i for i, _ in rows]
    by_row = {r["doc_id"]: r["spans"] for r in got}
    for i, text in rows:
        if ids.count(i) > 1:
            continue
        base = brute_base(text)
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in by_row[i].split(",") if s)]
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
        for k, start, end in set(spans) - set(base):
            assert all(end <= s or start >= e for _, s, e in base)


def test_proposals_against_brute_force(spark):
    rows = [(i, t) for i, t in corpus(5, 80) if t is None or len(t) < 3_000]
    got = {}
    for r in proposals(frame(spark, rows)).collect():
        got.setdefault(r["_id"], []).append(sorted((s["kind"], s["start"], s["end"], s["hit"]) for s in r["proposed"]))
    for i, text in rows:
        assert sorted(brute_proposals(text)) in got[i]


def test_scores_against_brute_force(spark):
    """What is added is what plain Python picks by the same trees and thresholds."""
    rows = [(i, t) for i, t in corpus(7) if i is not None and i != 1002]
    df = frame(spark, rows)
    seen = op.labelled(op.proposals(df))
    model = op.train(seen)
    assert model.trees and set(model.thresholds) == set(range(4))
    by_text = {r["_h1"]: r["_id"] for r in proposals(df).select("_h1", "_id").collect()}
    picked, texts = {}, dict(rows)
    for r in seen.collect():
        base = brute_base(texts[by_text[r["_h1"]]])
        meets = [k for k, s, e in base if s < r["end"] and e > r["start"]]
        assert r["open"] == (not meets) and r["sure"] == (KINDS[r["f_kind"]] in meets)
        score = 0
        for t in model.trees:
            low = lambda split: r[f"f_{split[0]}"] <= split[1]  # noqa: E731, B023
            score += (t.leaves[0] if low(t.left) else t.leaves[1]) if low(t.root) else (t.leaves[2] if low(t.right) else t.leaves[3])
        rounded = int(abs(score) / 100 + 0.5) * 100 * (1 if score >= 0 else -1)
        if r["open"] and rounded >= model.thresholds[r["f_kind"]]:
            picked.setdefault(by_text[r["_h1"]], []).append((r["start"], r["end"]))
    want = {}
    for i, spans in picked.items():
        for start, end in sorted(spans):
            if i in want and start < want[i][-1][1]:
                want[i][-1] = (want[i][-1][0], max(end, want[i][-1][1]))
            else:
                want.setdefault(i, []).append((start, end))
    got = {}
    for r in op.selected(seen, model).orderBy("start").collect():
        got.setdefault(by_text[r["_h1"]], []).append((r["start"], r["end"]))
    assert got == want


def test_held_out_documents(spark):
    """Of unconfirmed numbers like cards all are found, hex keys and versions are left alone."""
    rng = random.Random(1)
    rows = corpus(11, 400)[:400] + [(5000 + i, f"une ñ {card(rng, False)} and") for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in find_private(frame(spark, rows)).collect()}
    assert all(got[5000 + i] == "card:6:22" for i in range(30))
    for i, text in rows:
        if i < 400 and not brute_base(text):
            assert got[i] == ""


def test_redacted_texts(spark, crowded):
    rows = [(1, "mail a.b@c.de now"), (2, "clean"), (3, None), (4, "+1 (212) 555-1234, 1.2.3.4"), (4, "+1 (212) 555-1234, 1.2.3.4"), (None, "x@y.zz😀")]
    df = crowded(frame(spark, rows))
    out = redact(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == [
        (0, "[EMAIL]😀"), (1, "mail [EMAIL] now"), (2, "clean"), (3, ""), (4, "[PHONE], [IP]"), (4, "[PHONE], [IP]"),
    ]


def test_no_rows_and_nothing_to_learn(spark, crowded):
    assert find_private(frame(spark, [])).count() == 0
    got = find_private(crowded(frame(spark, [(1, "a@b.cd"), (2, "nothing"), (3, "12345678901234567")]))).collect()
    assert {r["doc_id"]: r["spans"] for r in got} == {1: "email:0:6", 2: "", 3: ""}


def test_splits_and_thresholds():
    f, g = op.FEATURES[1], op.FEATURES[2]
    histogram = {f: {0: (-5_000_000, 4_000_000), 3: (6_000_000, 4_000_000)}, g: {1: (1_000_000, 8_000_000)}}
    feature, cut, low, high = op.best_split(histogram)
    assert (feature, cut) == (f, 0) and low < 0 < high
    assert op.best_split({}) == (op.FEATURES[0], 0, 0, 0)
    scores = [(0, 0, 100), (100, 5, 10), (200, 4, 10), (300, 90, 90)]
    share = op.calibrated(scores)
    assert share == {0: 0.0, 100: 0.45, 200: 0.45, 300: 1.0}
    assert op.threshold(scores, recall=0.9, least=0.05) == 300
    assert op.threshold(scores, recall=1.0, least=0.05) == 100
    assert op.threshold(scores, recall=1.0, least=0.5) == 300
    assert op.threshold([(0, 0, 5)]) is None


def test_margin_adds_leaves(spark):
    tree = Tree((op.FEATURES[1], 2), (op.FEATURES[2], 0), (op.FEATURES[2], 5), (1, 2, 30, 40))
    rows = [(a, b) for a in (2, 3) for b in (0, 5, 6)]
    df = spark.createDataFrame(rows, f"f_{op.FEATURES[1]} int, f_{op.FEATURES[2]} int")
    got = [r[0] for r in df.select(op.margin([tree, tree])).collect()]
    assert got == [2 * ((1 if b <= 0 else 2) if a <= 2 else (30 if b <= 5 else 40)) for a, b in rows]


def test_running_sums_over_many_blocks(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        numbers = [k % 7 + 1 for k in range(n)]
        array = F.array(*map(F.lit, numbers)).cast("array<bigint>")
        got = spark.range(1).select(op._running(array).alias("r")).first()["r"]
        assert got == [sum(numbers[:k]) for k in range(n)]


def test_long_texts_take_time_in_proportion(spark):
    """Runs that a search tried again at each character would take hours over."""
    n = 200_000
    rows = [(1, "9" * n), (2, "a" * n + "@"), (3, "a.b@" + "c." * n + "d"), (4, "1-" * n), (5, "+" * n), (6, "1.1.1.1 " * (n // 40))]
    got = {r["doc_id"]: r for r in find_private(frame(spark, rows)).collect()}
    assert [got[i]["n_email"] for i in range(1, 6)] == [0, 0, 1, 0, 0] and got[6]["n_ip"] == n // 40
