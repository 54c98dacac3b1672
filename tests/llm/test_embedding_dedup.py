import numpy as np
import pytest

from sensorfold.llm.op1_embedding_dedup import near_duplicates, quantised

SHAPE = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold=0.9):
    ok = {}
    for i, (_, v, _) in enumerate(rows):
        if v is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, dtype=np.float32).astype(np.float64)
    links = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i != j and len(ok[i]) == len(ok[j]):
                if ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= threshold:
                    links[i].add(j)
    out = []
    for i in range(len(rows)):
        seen, open_ = {i}, [i]
        while open_:
            for k in links[open_.pop()] - seen:
                seen.add(k)
                open_.append(k)
        low = min(rows[k][0] for k in seen)
        out.append((rows[i][0], len(links[i]), low, rows[i][0] == low))
    return sorted(out)


@pytest.mark.parametrize("block, strip", [(8_192, 1_024), (16, 4)])
def test_against_brute_force(spark, block, strip):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 24))
    rows = []
    for i in range(150):
        v = centres[i % 6] + r.normal(size=24) * (0.1 + 0.5 * (i % 5) / 4)
        rows.append((i * 7 % 1009, [float(x) for x in v.astype(np.float32)], 0))
    rows += [(2000 + k, rows[k % 3][1], 1) for k in range(9)]  # copies
    rows += [(3000, None, 0), (3001, [0.0] * 24, 0), (3002, [float("nan")] + [1.0] * 23, 0), (3003, [], 0)]
    rows += [(3004, [None] + [1.0] * 23, 0), (3005, [float("inf")] + [1.0] * 23, 0), (3006, [1.0, 2.0], 0), (3007, [2.0, 4.0], 0)]
    rows += [(3008, [1e-30] * 24, 0), (3009, [1e30] * 24, 0), (3010, [-0.0] * 23 + [1.0], 0), (3011, [0.0] * 23 + [2.0], 0)]
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    got = near_duplicates(df, block=block, strip=strip)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_null_ids_repeated_ids_extra_columns_and_no_rows(spark, crowded):
    rows = [(None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0)]
    got = near_duplicates(crowded(spark.createDataFrame(rows, SHAPE)))
    assert sorted(map(tuple, got.collect()), key=repr) == [
        (1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, False),
    ]
    empty = near_duplicates(spark.createDataFrame([], SHAPE))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and empty.count() == 0


def test_error_bounds_hold():
    r = np.random.default_rng(1)
    unit = r.normal(size=(300, 48)) ** 3
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes, scale, error = quantised(unit)
    near = (codes.astype(float) * scale[:, None]) @ (codes.astype(float) * scale[:, None]).T
    bound = error[:, None] + error[None, :] * (1 + error[:, None])
    assert (np.abs(unit @ unit.T - near) <= bound).all()
