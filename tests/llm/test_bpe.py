import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from sensorfold.llm import op4_bpe
from sensorfold.llm.op4_bpe import Codec, encode_documents, vocabulary_path

PIECES = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "é", "ß", "1", "!", "<|endoftext|>", "<|endo", "ftext|>", "the", "日本", " ", "aaaa", "\x1c", "\x85", "😀", "“"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def coder():
    return Codec(vocabulary_path())


def test_plain_characters_are_cut_alike(library, coder):
    for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xA0, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]:
        ch = chr(c)
        assert coder.plain(ch)
        for s in (f"a{ch}b", f"1{ch}2", f" {ch} {ch}{ch}x", f"x{ch}", f"-{ch}-  {ch}", f"'s{ch}'"):
            assert coder.find(s) == [s[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(s)], hex(c)


@pytest.mark.parametrize("seed", range(6))
def test_joined_segments_equal_the_library(library, coder, monkeypatch, seed):
    r = random.Random(seed)
    for _ in range(150):
        monkeypatch.setattr(op4_bpe, "LONG_WORD", r.choice([8, 16, 2_048]))
        coder.cache.clear()
        pieces = r.choice([PIECES, ["a", "b", "aa", "th", "e"], [" ", "\n", "  "]])
        text = "".join(r.choice(pieces) for _ in range(r.randint(2, 400)))
        width = len(text) // r.choice([2, 4, 8]) + 1
        level = [coder.segment(text[k : k + width]) for k in range(0, len(text), width)]
        while len(level) > 1:
            level = [coder.join(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        assert level[0][0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert level[0][1].tolist() == coder.segment(text)[1].tolist()


def test_documents(spark, library, crowded):
    r = random.Random(9)
    texts = ["", None, "x", "<|endoftext|>", " <|endoftext|> a", "a" * 5_000, "日本" * 900, "w " * 3_000, "\u0000�"]
    texts += ["".join(r.choice(PIECES) for _ in range(r.randint(0, 900))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, "other"), (None, texts[5])]
    df = crowded(spark.createDataFrame(rows, "doc_id bigint, text string")).repartition(4)
    got = encode_documents(df, segment=256).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids, back))
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
    assert sorted((tuple(g[n] for n in names) for g in got), key=repr) == sorted(want, key=repr)


def test_no_documents(spark):
    out = encode_documents(spark.createDataFrame([], "doc_id bigint, text string"), more=())
    assert out.count() == 0 and set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
