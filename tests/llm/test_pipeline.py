"""The pipeline's stages against plain versions, each on its own input."""

import re
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sensorfold.llm.op4_bpe import vocabulary_path
from sensorfold.llm.op5_quality import classify

from .test_exact_dedup import brute as exact
from .test_mix_sources import fill
from .test_ngram_join import brute as near


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_quality(spark, stages, sf_dir):
    before, after = stages["quality"]
    kept = {r["doc_id"] for r in classify(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("kept").collect()}
    assert sorted(rows(after)) == sorted(r for r in rows(before) if r[0] in kept)
    assert 0 < after.count() < before.count()


def test_exact_and_near_copies(stages):
    for name, want in (("exact_dedup", lambda x: {i for i, k, *_ in exact(x) if i == k}), ("near_dedup", lambda x: {i for i, _, c in near(x, 5, 80) if i == c})):
        before, after = stages[name]
        stay = want(rows(before))
        assert sorted(rows(after)) == sorted(r for r in rows(before) if r[0] in stay)
        assert after.columns == before.columns


def test_mix(stages):
    before, after = stages["mix"]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before.collect():
        sizes[r["source"]] += count(r["text"])
    for r in after.collect():
        taken[r["source"]] += count(r["text"])
    for source, target in fill(sizes).items():
        assert abs(taken[source] - target) <= 0.51


def test_tokens(stages):
    before, after = stages["tokens"]
    library = Tokenizer.from_file(vocabulary_path())
    want = sorted((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows(before))
    assert sorted((r["doc_id"], list(r["ids"])) for r in after.collect()) == want


def test_run_gives_the_last_stage(spark, stages, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    want = stages["tokens"][1]
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
