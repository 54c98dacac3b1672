import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sensorfold.llm import op13_source_audit as op
from sensorfold.llm.op13_source_audit import block_divergence, count_terms, radix_order, source_audit

SHAPE = "doc_id bigint, text string, lang string, source string"
UPPER = {i: i + 32 for i in range(65, 91)}
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for _, text, lang, source in rows]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in seen.items()}
    groups = sorted(counts)

    def shares(lang, count):
        total = sum(count[t] for t in kept[lang]) + len(kept[lang])
        return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept[lang]}

    p = {g: shares(g[0], counts[g]) for g in groups}
    q = {lang: shares(lang, sum((counts[g] for g in groups if g[0] == lang), Counter())) for lang in kept}
    out = []
    for g in groups:
        lang = g[0]
        f = lambda a, b: (a - b) ** 2 // b
        pairs = [(o[1], sum(f(p[g][t], p[o][t]) for t in kept[lang])) for o in groups if o[0] == lang and o != g]
        terms = [(t, f(p[g][t], q[lang][t])) for t in kept[lang] if counts[g][t] and p[g][t] > q[lang][t]]
        for part, found in (("pair", pairs), ("term", terms)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(*g, part, item, v, r) for r, (item, v) in enumerate(ranked, 1) if part == "pair" or r <= top]
    return sorted(out)


LONG = "w" * 40_000
ROWS = [
    (1, "The cat, the Cat; THE cat's", "en", "a"), (2, "the dog 12dogs\x00dog", "en", "b"), (2, "the dog 12dogs\x00dog", "en", "b"),
    (3, "cat the dog " * 3_000 + LONG, "en", "c"), (4, LONG + " the", "en", "c"), (5, LONG, "en", None), (6, None, "en", "empty"),
    (7, "", "en", "a"), (8, "été ÉTÉ l'été œuvre × seventeenletters1 seventeenletterss", "fr", "a"), (9, "été œuvre seventeenletterss", "fr", "b"),
    (10, "été œuvre seventeenletterss exactly16letterz abcdefgh abcdefghi", "fr", "b"), (11, "rare words only", "de", "a"),
    (12, None, None, None), (13, "日本語 日本 😀", "ja", "a"), (14, "日本語 日本語", "ja", "b"), (15, "日本語 日本", "ja", "b"), (16, "日本", "ja", "c"),
    (None, "abcdefgh abcdefghi exactly16letterz abcdefgh", "fr", "c"), (17, "abcdefgh abcdefghi exactly16letterz", "fr", "c"),
]


@pytest.mark.parametrize("pack, cells", [(4 << 20, 1 << 20), (1, 4)])
def test_against_brute_force(spark, crowded, monkeypatch, pack, cells):
    monkeypatch.setattr(op, "PACK_BYTES", pack)
    monkeypatch.setattr(op, "BLOCK_CELLS", cells)
    got = source_audit(crowded(spark.createDataFrame(ROWS, SHAPE)).repartition(3))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(ROWS)


def test_ranks_end_at_the_top(spark):
    got = source_audit(spark.createDataFrame(ROWS, SHAPE), least_docs=1, top=2)
    assert sorted(map(tuple, got.collect())) == brute(ROWS, least=1, top=2)


def test_no_rows(spark):
    assert source_audit(spark.createDataFrame([], SHAPE)).count() == 0


def test_radix_order_is_that_of_numbers():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 4, 500).astype(np.uint32)
    b = rng.integers(0, 2**64, 500, dtype=np.uint64)
    b[::3] = b[0]
    order = radix_order([a, b])
    assert order.tolist() == sorted(range(500), key=lambda i: (a[i], b[i], i))


def test_documents_and_groups_are_told_apart():
    texts = [b"ab cd ab", b"", b"ab", b"cd cd", b"x" * 17 + b" " + b"x" * 17]
    found = {(g, t): (n, d) for part in count_terms(texts, np.array([0, 0, 0, 1, 1])) for g, t, n, d in zip(*part)}
    assert found == {(0, "ab"): (3, 2), (0, "cd"): (1, 1), (1, "cd"): (2, 1), (1, "x" * 17): (2, 1)}


def test_large_counts_are_exact():
    counts = np.array([[10**13, 3], [5, 10**12]])
    totals = counts.sum(axis=0) + 2
    p = [[1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(row, totals)] for row in counts]
    want = [[sum((r[a] - r[b]) ** 2 // r[b] for r in p) for b in range(2)] for a in range(2)]
    assert block_divergence(counts, totals).tolist() == want
