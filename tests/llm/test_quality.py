import random

import pytest
from pyspark.sql import functions as F

from sensorfold.llm.op5_quality import classify, keep_good, site_posteriors, url_site

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    out = classify(docs, labels.where(~held)).join(labels.where(held), "doc_id").cache()
    good, bad = out.where("quality = 1"), out.where("quality = 0")
    assert good.where("kept").count() >= 0.99 * good.count()
    assert bad.where("NOT kept").count() >= 0.95 * bad.count()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_sparse_sites_are_shrunk(spark):
    rows = [(i, "some words of a text", "big", "en") for i in range(100)] + [(200, "some words of a text", "bad", "en"), (201, "some words of a text", "one", "en")]
    rows += [(300 + i, "some words of a text", "bad", "en") for i in range(40)]
    marks = [(i, 1, 0) for i in range(100)] + [(300 + i, 0, 0) for i in range(40)] + [(201, 0, 0)]
    rate = {r["doc_id"]: r["site_rate"] for r in classify(frame(spark, rows), labels_of(spark, marks)).collect()}
    assert rate[0] > 0.9 and rate[200] < 0.2
    assert rate[200] < rate[201] < rate[0]  # one bad label says less than forty


def test_nulls_empties_and_missing_labels(spark, crowded):
    rows = [(1, None, None, None), (2, "", "a", None), (3, "x", None, "en"), (3, "x", None, "en"), (None, "y z", "a", "en")]
    df = crowded(frame(spark, rows))
    for marks in ([], [(None, 1, 0), (1, None, 0)], [(1, 1, 0), (1, 0, 0), (2, 0, 1)]):
        out = classify(df, labels_of(spark, marks)).collect()
        assert len(out) == len(rows)
        assert all(0 < r["p_quality"] < 1 for r in out)
        if len(marks) < 3:
            assert all(r["kept"] for r in out)
    assert keep_good(df, labels_of(spark, [])).columns == df.columns
    assert keep_good(df, labels_of(spark, [])).count() == len(rows)
    none = frame(spark, [])
    assert classify(none, labels_of(spark, [(1, 1, 0)])).count() == 0


URLS = [
    ("https://Host.Example:8080/news/2024/a.html?x=/y#z", ("host.example", "news", "news/2024")),
    ("http://u:p@h.org/news/", ("h.org", "news", "news")), ("http://h.org/page", ("h.org", "", "")),
    ("http://h.org", ("h.org", "", "")), ("http://h.org/", ("h.org", "", "")), ("h.org/news/a", ("", "", "")), ("", ("", "", "")), (None, ("", "", "")),
    ("ftp://h.org//a/b", ("h.org", "", "/a")),
]


def test_host_and_path_of_urls(spark):
    df = spark.createDataFrame([(u,) for u, _ in URLS], "url string")
    (host, one), (_, two) = url_site(F.col("url"), 1), url_site(F.col("url"), 2)
    assert [tuple(r) for r in df.select(host, one, two).collect()] == [w for _, w in URLS]


def brute_posteriors(counts):
    """The same sums in plain Python: moments first, then shrinking path to host to all."""

    def strength(sites):
        seen = sum(n * (g / n - p) ** 2 for g, n, p in sites if n > 0)
        chance = sum(p * (1 - p) for g, n, p in sites if n > 0)
        room = sum((n - 1) * p * (1 - p) for g, n, p in sites if n > 0)
        between = (seen - chance) / room if room > 0 else 0.0
        return min(1e6, max(1.0, 1 / between - 1)) if between > 0 else 1e6

    rate = (sum(g for *_, g, _ in counts) + 1) / (sum(n for *_, n in counts) + 2)
    hosts = {}
    for host, _, g, n in counts:
        hg, hn = hosts.get(host, (0, 0))
        hosts[host] = (hg + g, hn + n)
    m = strength([(g, n, rate) for g, n in hosts.values()])
    prior = {h: (g + m * rate) / (n + m) for h, (g, n) in hosts.items()}
    k = strength([(g, n, prior[h]) for h, _, g, n in counts])
    return {(h, p): (g + k * prior[h]) / (n + k) for h, p, g, n in counts}, rate


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_posteriors_against_brute_force(spark, seed):
    rng = random.Random(seed)
    counts = []
    for h in [None, *(f"h{i}" for i in range(12))]:
        bad = rng.choice([0.1, 0.5, 0.9])
        for p in [None, *(f"p{i}" for i in range(rng.randint(0, 5)))]:
            n = rng.choice([0.0, 1.0, 3.0, 50.0, 400.0])
            counts.append((h, p, round(n * min(1, max(0, rng.gauss(bad, 0.1))), 3), n))
    got, rate = site_posteriors(spark.createDataFrame(counts, "_host string, _path string, _good double, _n double"))
    want, want_rate = brute_posteriors(counts)
    assert rate == pytest.approx(want_rate)
    assert {(r["_host"], r["_path"]): r["_site"] for r in got.collect()} == {k: pytest.approx(v) for k, v in want.items()}


def test_sites_of_urls(spark):
    rows = [(i, "some words of a text", f"http://good.org/a/{i}") for i in range(60)]
    rows += [(100 + i, "some words of a text", f"http://good.org/spam/{i}") for i in range(60)]
    rows += [(200 + i, "some words of a text", f"http://new.org/x/{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, url string")
    marks = labels_of(spark, [(i, 1, 0) for i in range(50)] + [(100 + i, 0, 0) for i in range(50)])
    rate = {r["doc_id"]: r["site_rate"] for r in classify(df, marks, url_col="url").collect()}
    assert rate[55] > 0.9 and rate[155] < 0.1 and 0.3 < rate[200] < 0.7
