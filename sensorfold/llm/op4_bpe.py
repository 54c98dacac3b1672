"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

A text is cut into words by the vocabulary's pattern, and BPE runs within a word, so a worker
keeps the ids of words it has met. Long texts are halved blindly until they fit a segment;
segments are rows of their own, so that several tasks encode one text. Then neighbours are
joined, level by level: the last words of the left side and a growing window of the right one
are encoded anew until the window and the right side begin a word at the same place. From there on
both have read the same characters under the same rules. A word that has no cut
for thousands of bytes is joined the same way on token level: the last tokens of the left half
and the first of the right one are encoded anew, in growing windows, until the outer tokens
stay as they were on both sides.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, ship

#: Characters per segment of a long text.
SEGMENT = 16_384
#: Bytes from which a single word is halved.
LONG_WORD = 2_048
#: Words a worker remembers; the cache starts anew beyond it.
CACHE_WORDS = 250_000

#: The pattern of the byte-level vocabularies. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters for which the regex module and the vocabulary's library cut alike (tested one by
#: one); a text with any other character is cut by the library.
PLAIN = r"[\t\n\r\x20-\x7e\xa0-ɏ‐-‧‰-⁞]*"


#: Stands between words handed to the model at once; no byte maps to it.
BETWEEN = "\ue000"
#: So many words at once.
WORDS_AT_ONCE = 2_000


def vocabulary_path() -> str:
    """The installed public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Encodes and decodes with one vocabulary file; one instance serves a worker."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        # Spark's tasks share the cores already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = Tokenizer(self.whole.model)  # cuts at BETWEEN only, so takes words as given
        self.model.pre_tokenizer = Split(BETWEEN, "removed")
        self.find = regex.compile(PATTERN).findall
        self.plain = regex.compile(PLAIN).fullmatch
        self.special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.reach = max([1, *(len(s.encode()) for s in self.special)])
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        # printable bytes stand for themselves, the others for characters from U+0100 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.shown_as = {b: chars[b] for b in range(256)}
        back = {c: b for b, c in chars.items()}
        size = self.whole.get_vocab_size()
        names = [self.whole.id_to_token(i) or "" for i in range(size)]
        self.bytes_of = [
            bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in names
        ]
        self.length_of = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        # ids as bytes: a quarter of what tuples take, and joined at once
        self.cache: dict[str, bytes] = {}

    # --- words ---------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The text cut as the library cuts it; special tokens are words of their own."""
        if not text:
            return []
        if self.cut and any(s in text for s in self.special):
            out, at = [], 0
            for m in self.cut.finditer(text):
                out += self._pieces(text[at : m.start()])
                out.append(m.group())
                at = m.end()
            return out + self._pieces(text[at:])
        return self._pieces(text)

    def _pieces(self, text: str) -> list[str]:
        if not text:
            return []
        if self.plain(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def word_ids(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word, as bytes of 32-bit numbers."""
        new = [w for w in set(words) if w not in self.cache]
        if new:
            if len(self.cache) + len(new) > CACHE_WORDS:
                self.cache = {}
                new = list(set(words))
            short = [w for w in new if len(w) <= LONG_WORD // 4 and w not in self.special]
            for k in range(0, len(short), WORDS_AT_ONCE):
                self._learn(short[k : k + WORDS_AT_ONCE])
            for w in set(new) - set(short):
                i = self.special.get(w)
                found = [i] if i is not None else self.tree(w.encode())
                self.cache[w] = np.array(found, dtype=np.uint32).tobytes()
        return map(self.cache.__getitem__, words)

    def _learn(self, words: list[str]) -> None:
        """Caches the ids of many short words from one call, cut apart by their bytes."""
        data = [w.encode() for w in words]
        line = BETWEEN.join([d.decode("latin-1") for d in data]).translate(self.shown_as)
        ids = self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids
        ends = np.cumsum(self.length_of[ids])
        cuts = np.searchsorted(ends, np.cumsum([len(d) for d in data]), side="left") + 1
        raw, at = np.array(ids, dtype=np.uint32).tobytes(), 0
        for word, cut in zip(words, (cuts * 4).tolist(), strict=True):
            self.cache[word] = raw[at:cut]
            at = cut

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.word_ids(self.words(text))), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return joined.decode("utf-8", "replace")

    # --- joins ---------------------------------------------------------------------

    def bpe(self, data: bytes) -> list[int]:
        """BPE of one word, without any cut."""
        return self.model.encode(data.decode("latin-1").translate(self.shown_as), add_special_tokens=False).ids

    def tree(self, data: bytes) -> list[int]:
        """BPE of one long word from its halves."""
        if len(data) <= LONG_WORD:
            return self.bpe(data)
        half = len(data) // 2
        return self.join_tokens(self.tree(data[:half]), self.tree(data[half:]))

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of one word from the ids of its two parts.

        A sequence of tokens is what BPE gives for a word if every two neighbours are what it
        gives for their bytes. In the result they are: outside the window as before, inside
        it by its encoding, and at its edges because the outer tokens stayed.
        """
        n = 4
        while True:
            a, b = left[-n:], right[:n]
            mid = self.bpe(b"".join(map(self.bytes_of.__getitem__, a + b)))
            all_left, all_right = n >= len(left), n >= len(right)
            if (all_left or mid[0] == a[0]) and (all_right or mid[-1] == b[-1]) and (
                len(mid) > 1 or (all_left and all_right)
            ):
                return left[: len(left) - len(a)] + mid + right[len(b) :]
            n *= 2

    def segment(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a segment, and the index of each word's first token."""
        parts = list(self.word_ids(self.words(text)))
        ids = np.frombuffer(b"".join(parts), dtype=np.uint32)
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        return ids, np.cumsum(sizes) - sizes

    def join(self, left: tuple, right: tuple) -> tuple:
        """``(ids, word starts)`` of two neighbouring parts as one.

        A word of the left part that ends before the part's end is a word of the whole text:
        what ended it was seen. Special tokens can straddle the cut, so the window begins a
        special token's length before it, and a common start counts only that far before the
        window's end (unless the right part ends there too).
        """
        (lids, lstarts), (rids, rstarts) = left, right
        if not len(lids) or not len(rids):
            return left if len(lids) else right
        lat = np.concatenate([[0], np.cumsum(self.length_of[lids])])
        rat = np.concatenate([[0], np.cumsum(self.length_of[rids])])
        safe = np.flatnonzero(lat[lstarts] < lat[-1] - 2 * self.reach)
        first = lstarts[max(0, len(safe) - 1)] if len(safe) else 0
        # the word before the last safe start may itself touch the end only if it is the last
        last_word = lstarts[-1]
        first = int(min(first, last_word))
        tail = b"".join(map(self.bytes_of.__getitem__, lids[first:].tolist()))
        places = {int(p): k for k, p in enumerate(rat[rstarts])}
        span = 256
        while True:
            k = int(np.searchsorted(rat[rstarts], span))
            stop = int(rat[rstarts[k]]) if k < len(rstarts) else int(rat[-1])
            at_end = stop == rat[-1]
            n_tok = int(rstarts[k]) if k < len(rstarts) else len(rids)
            head = b"".join(map(self.bytes_of.__getitem__, rids[:n_tok].tolist()))
            words = self.words((tail + head).decode("utf-8"))
            at = np.cumsum([0, *(len(w.encode()) for w in words)]) - len(tail)
            agreed = next(
                (j for j, p in enumerate(at[:-1].tolist()) if p in places and p < stop - 2 * self.reach), None
            )
            if agreed is None and at_end:
                agreed = len(words)
            if agreed is not None:
                break
            span *= 2
        place = int(at[agreed])
        keep = int(rstarts[places[place]]) if agreed < len(words) else len(rids)
        mid = [self._across(w, int(a), tail, lids, lstarts, rids, rstarts) for w, a in zip(words[:agreed], at.tolist(), strict=False)]
        sizes = np.array([len(m) // 4 for m in mid], dtype=np.int64)
        mid_ids = np.frombuffer(b"".join(mid), dtype=np.uint32)
        ids = np.concatenate([lids[:first], mid_ids, rids[keep:]])
        starts = np.concatenate([
            lstarts[lstarts < first],
            first + np.cumsum(sizes) - sizes,
            rstarts[rstarts >= keep] - keep + first + len(mid_ids),
        ]).astype(np.int64)
        return ids, starts

    def _across(self, word: str, at: int, tail: bytes, lids, lstarts, rids, rstarts) -> bytes:
        """Ids of a word of a window; a long one across the cut from what both sides have."""
        size = len(word.encode())
        if size <= LONG_WORD or at >= 0 or at + size <= 0 or word in self.special:
            return next(self.word_ids([word]))
        left, right = lids[lstarts[-1] :].tolist(), rids[: rstarts[1] if len(rstarts) > 1 else len(rids)].tolist()
        sizes = (int(self.length_of[left].sum()), int(self.length_of[right].sum()))
        if sizes == (-at, at + size):
            return np.array(self.join_tokens(left, right), dtype=np.uint32).tobytes()
        return next(self.word_ids([word]))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _result(coder: Codec, ids: np.ndarray, more: tuple[str, ...]) -> dict:
    text = coder.decode(ids)
    row = {
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
        "decoded_sha256": hashlib.sha256(text.encode("utf-8")).hexdigest(),
    }
    return row | {k: v for k, v in (("ids", ids.astype(np.int32)), ("decoded", text)) if k in more}


def _short(path: str, more: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(path)
        for batch in batches:
            rows = [_result(coder, coder.encode(t), more) for t in batch["_text"]]
            if rows:
                yield pd.DataFrame(rows).assign(_id=batch["_id"].to_numpy())

    return released(run)


def _leaves(path: str) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(path)
        for batch in batches:
            done = [coder.segment(t) for t in batch["_part"]]
            yield batch.drop(columns="_part").assign(
                _ids=[ids.tobytes() for ids, _ in done],
                _starts=[s.astype(np.uint32).tobytes() for _, s in done],
            )

    return released(run)


def _joined(path: str, more: tuple[str, ...]) -> Callable:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        coder = codec(path)
        times = int((group["_seg"] == 0).sum())  # rows that repeat id and text
        one = group.drop_duplicates("_seg").sort_values("_seg")
        level = [
            (np.frombuffer(i, dtype=np.uint32), np.frombuffer(s, dtype=np.uint32).astype(np.int64))
            for i, s in zip(one["_ids"], one["_starts"], strict=True)
        ]
        while len(level) > 1:
            level = [
                coder.join(*level[k : k + 2]) if k + 1 < len(level) else level[k]
                for k in range(0, len(level), 2)
            ]
        row = _result(coder, level[0][0], more)
        return pd.DataFrame([row | {"_id": one["_id"].iloc[0]}] * times)

    return run


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    more: tuple[str, ...] = ("ids", "decoded"),
    segment: int = SEGMENT,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and
    of ``ids`` and ``decoded`` those named in ``more``.

    The ids are those of the vocabulary's library for the whole text. Special tokens written
    out in a text count as such tokens, as they do there. A null text counts as empty and has
    no tokens. Rows that repeat an id each get a row; an empty table gives an empty result.
    The ids of ``docs`` may be of any type; other columns are not read. A text has to fit a
    row, and its ids one task.
    """
    path = path or vocabulary_path()
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    # as text, since pandas would make doubles of integers beside a null
    rows = docs.select(
        F.col(id_col).cast("string").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    shape = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    shape += ", ids array<int>" * ("ids" in more) + ", decoded string" * ("decoded" in more)
    shape += ", _id string"
    chars = F.char_length("_text")
    short = rows.where(chars <= segment).mapInPandas(_short(path, more), shape)

    # leaves of a balanced tree: equal parts, as many as a power of two needs
    parts = F.pow(F.lit(2), F.ceil(F.log2(chars / segment))).cast("int")
    width = F.ceil(chars / F.col("_n")).cast("int")
    long = (
        rows.where(chars > segment)
        .withColumn("_n", parts)
        .withColumn("_key", F.sha2(F.encode("_text", "UTF-8"), 256))
        .withColumn("_w", width)
        .select("_id", "_key", "_w", "_text", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_seg"))
        .select("_id", "_key", "_seg", F.substring("_text", F.col("_seg") * F.col("_w") + 1, F.col("_w")).alias("_part"))
    )
    width_now = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = long.repartition(width_now, "_id", "_key", "_seg").mapInPandas(
        _leaves(path), "_id string, _key string, _seg int, _ids binary, _starts binary"
    )
    whole = leaves.groupBy("_id", "_key").applyInPandas(_joined(path, more), shape)
    both = short.unionByName(whole)
    return both.select(F.col("_id").cast(kind).alias(id_col), *[c for c in both.columns if c != "_id"])


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, more=())
