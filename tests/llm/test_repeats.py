import hashlib
import random
from collections import Counter, defaultdict

import pytest

from sensorfold.llm.op8_repeats import common_prefix, interval_tree, op8_repeats, remove_repeats, repeated_spans

SHAPE = "doc_id bigint, text string"


def brute(rows, least):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[k : k + least] for k in range(len(b) - least + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - least + 1):
            if seen[b[k : k + least]] > 1:
                gone[k : k + least] = b"\1" * least
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=150):
    r = random.Random(seed)
    rand = lambda k: "".join(r.choice("abc é") for _ in range(k))
    pool = [rand(r.randint(20, 120)) for _ in range(10)]
    rows = []
    for i in range(n):
        parts = [r.choice(pool)[r.randint(0, 5) :] if r.random() < 0.6 else rand(r.randint(1, 60)) for _ in range(r.randint(0, 10))]
        rows.append((i, "".join(parts)))
    rows += [(400, None), (401, ""), (402, "a" * 1_500), (403, "ab" * 700), (5, rows[5][1]), (None, rows[6][1])]
    return rows


@pytest.mark.parametrize("most_classes", [2_048, 2])
def test_against_brute_force(spark, crowded, most_classes):
    rows = corpus(most_classes)
    df = crowded(spark.createDataFrame(rows, SHAPE)).repartition(4)
    got = remove_repeats(df, least=40, anchor=12, bits=1 << 16, most_classes=most_classes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 40)


def test_no_and_short_documents(spark):
    rows = [(1, "short"), (2, "short"), (3, None)]
    assert sorted(map(tuple, remove_repeats(spark.createDataFrame(rows, SHAPE)).collect())) == brute(rows, 400)
    assert remove_repeats(spark.createDataFrame([], SHAPE)).count() == 0


def test_groups_have_all_occurrences(spark):
    r = random.Random(4)
    rand = lambda k: "".join(r.choice("abcdefgh") for _ in range(k))
    x, rows = rand(50), []
    for i in range(7):
        rows.append((i, rand(30) + x + rand(30)))
    found = repeated_spans(spark.createDataFrame(rows, SHAPE), least=40, anchor=12, bits=1 << 16, groups=True)
    groups = defaultdict(set)
    for g in found.collect():
        groups[g["repeat"]].add((int(g["_id"]), g["start"], g["length"]))
    assert any({i for i, *_ in members} == set(range(7)) for members in groups.values())
    text = dict(rows)
    for members in groups.values():  # one string each
        assert len({text[i].encode()[a : a + n] for i, a, n in members}) == 1


def test_interval_tree_against_all_pairs():
    r = random.Random(2)
    for _ in range(200):
        text = "".join(r.choice("ab") for _ in range(r.randint(2, 30))).encode()
        order = sorted(range(len(text)), key=lambda k: text[k:])
        shared = [0] + [common_prefix(text[a:], text[b:]) for a, b in zip(order, order[1:])]
        left = [text[k - 1] if k else 256 for k in order]
        got = {(n, frozenset(order[a : b + 1])) for n, a, b in interval_tree(shared, left, 1)}
        want = set()
        for i in range(len(text)):
            for j in range(i):
                n = common_prefix(text[i:], text[j:])
                if n and (j == 0 or text[i - 1] != text[j - 1]):  # maximal on both sides
                    want.add((n, frozenset(k for k in range(len(text)) if text[k : k + n] == text[i : i + n])))
        assert got == want


def test_groups_of_copied_texts_and_of_many_classes(spark):
    r = random.Random(8)
    rand = lambda k: "".join(r.choice("abcdefgh") for _ in range(k))
    x = rand(50)
    a, b = (rand(30) + x + rand(30) for _ in range(2))
    y = rand(60)
    rows = [(0, a), (1, a), (2, b), (3, b)]
    rows += [(10 + k, rand(20) + y[: 45 + 3 * (k % 3)] + rand(20)) for k in range(7)]
    text = {i: t.encode() for i, t in rows}
    found = []
    for most in (2_048, 1):
        spans = repeated_spans(spark.createDataFrame(rows, SHAPE), least=40, anchor=12, bits=1 << 16, groups=True, most_classes=most)
        groups = defaultdict(list)
        for g in spans.collect():
            groups[g["repeat"]].append((int(g["_id"]), g["start"], g["length"]))
        for members in groups.values():  # each group has all occurrences of its string, once
            i, start, n = members[0]
            part = text[i][start : start + n]
            want = {(j, at, n) for j, t in text.items() for at in range(len(t)) if t.startswith(part, at)}
            assert len(members) == len(want) and set(members) == want
        found.append({frozenset(m) for m in groups.values()})
    assert found[0] == found[1]
    assert any({i for i, *_ in m} == {0, 1, 2, 3} for m in found[0])
    assert any(n > 40 for m in found[1] for *_, n in m)


def test_the_operator_has_its_own_columns_and_the_query_one_more(spark, tmp_path):
    passage = " ".join(f"wörd{k:03d}" for k in range(60))  # 539 bytes, of which 60 words repeat
    short = " ".join(f"w{k:03d}" for k in range(60))  # as many words, but 299 bytes
    rows = [(1, "a " + passage), (2, "b " + passage), (3, "c " + short), (4, "d " + short)]
    docs = spark.createDataFrame(rows, SHAPE)
    assert remove_repeats(docs).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["changed"]) for r in op8_repeats(spark, str(tmp_path)).collect()}
    n = len(passage.encode())
    assert got[1] == got[2] == (n + 2, n + 1, True)  # n_bytes is the input's, the blank before repeats too
    assert got[3] == got[4] == (301, 0, False)
