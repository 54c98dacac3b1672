"""Repeated byte strings: common-prefix interval tree over sparse enhanced suffix arrays.

Every window of ``least`` bytes picks an anchor, the k-gram in it with the smallest hash. Equal
windows pick equal anchors, and the windows of a text that share an anchor form a run. So all
that can match lies in runs of equal anchors:

1. anchors that occur once are dropped, with everything that hangs on them;
2. runs of equal bytes are one class; a class that occurs twice is repeated as a whole;
3. an anchor with several classes gets an enhanced suffix array over the bytes of its classes:
   the starts whose window recurs behind different left bytes, sorted, with common prefix
   lengths. A stack scan walks the tree of common-prefix intervals; an interval with diverse left
   extensions is a maximal repeat, with all members of the interval as its occurrences;
4. an anchor with too many classes for one task is decided window by window instead, by counting
   the windows of its classes, which splits over tasks however many there are. Where groups are
   asked for, the suffixes that begin with one window make a tree of their own: the intervals of
   ``least`` bytes or more never reach over two windows.

What is found per class goes back to all its occurrences, and the spans of a text are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, marked, released, settled, ship
from .op7_ngram_join import _bucket, _packed, _powers, _unpacked, mixed

LEAST = 400
#: Bytes of an anchor.
ANCHOR = 128
#: Positions of a text looked at together.
STRIP = 1 << 20
HELD = 1 << 19
#: Classes of one anchor that share a suffix array at most.
MOST_CLASSES = 2_048
#: Bits of the bitmaps that keep tasks from handing on what cannot match: 8 MB each.
BITS = 1 << 26
#: Bytes of classes per suffix array task, about.
TASK_BYTES = 1 << 20

_LOW = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` bytes of ``data``."""
    power, inverse = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])
        return mixed((sums[size:] - sums[:-size]) * inverse[: len(data) - size + 1])


def _runs(data: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor hash of each run of a text of ``least`` bytes or more.

    Runs are cut at strips of the text, too; equal windows still have equal anchors, but a run of
    one text may be two of another there. Strips therefore begin where windows change anchors.
    """
    wide = least - anchor + 1
    out, base = [], 0
    while len(data) - base >= least:
        part = data[base : base + STRIP + least]
        hashes = gram_hashes(part, anchor)
        value = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        n = len(hashes) - wide + 1
        pad = -len(value) % wide
        blocks = np.concatenate([value, np.full(pad, ~np.uint64(0))]).reshape(-1, wide)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        best = np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n])
        at = (best & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], n) - 1
        done = base + len(part) == len(data)
        if not done:  # the last run may go on: the next strip begins with it
            if len(first) > 1:
                step, first, last = first[-1], first[:-1], last[:-1]
            else:  # cannot be: a run has at most ``wide`` windows
                raise AssertionError("strip shorter than a run")
        out.append((base + first, base + last, hashes[at[first]]))
        if done:
            break
        base += int(step)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _texts(batch: pd.DataFrame, least: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    for k, text in enumerate(batch["_text"]):
        data = text.encode("utf-8", "surrogatepass")
        if len(data) >= least:
            yield k, data, np.frombuffer(data, dtype=np.uint8)


def _count_anchors(least: int, anchor: int, buckets: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def out() -> pd.DataFrame:
            seen = np.sort(np.concatenate(held))
            cuts = np.searchsorted(_bucket(seen, buckets), np.arange(buckets + 1))
            full = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
            return pd.DataFrame({"bucket": full, "data": [_packed(seen[cuts[k] : cuts[k + 1]]) for k in full]})

        for batch in batches:
            for _, _, data in _texts(batch, least):
                held.append(_runs(data, least, anchor)[2])
                size += len(held[-1])
                if size > HELD:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return released(run)


def _bits_of(values: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(values) % np.uint64(bits)).astype(np.int64)


def _repeated_bits(bits: int) -> Callable:
    """Places in the bitmap of the values that occur twice, as bytes of their 64-bit words."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        seen = np.sort(np.concatenate([_unpacked(d) for d in group["data"]]))
        again = np.unique(seen[1:][seen[1:] == seen[:-1]])
        return _words(_bits_of(again, bits))

    return run


def _words(places: np.ndarray) -> pd.DataFrame:
    places = np.unique(places)
    word, bit = places >> 6, np.uint64(1) << (places & 63).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    masks = np.bitwise_or.reduceat(bit, first) if len(first) else np.empty(0, np.uint64)
    return pd.DataFrame({"word": word[first] if len(first) else word, "mask": masks.view(np.int64)})


def _gathered(spark, words: DataFrame, bits: int):
    """The bitmap, broadcast: of fixed size, whatever goes in."""
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[found["word"].to_numpy(dtype=np.int64)] = found["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(table)


def _in(table: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    place = _bits_of(values, bits)
    return (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


OCCURRENCE = "_th bigint, pos bigint, size int, h bigint, d1 bigint, d2 bigint"


def _occurrences(least: int, anchor: int, bits: int, known) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, owner = [], []
            for k, raw, data in _texts(batch, least):
                first, last, h = _runs(data, least, anchor)
                for j in np.flatnonzero(_in(known.value, h, bits)).tolist():
                    a, b = int(first[j]), int(last[j]) + least
                    d = np.frombuffer(hashlib.blake2b(raw[a:b], digest_size=16).digest(), dtype=np.int64)
                    rows.append((a, b - a, h[j].astype(np.int64), d[0], d[1]))
                    owner.append(k)
            if rows:
                pos, size, h, d1, d2 = zip(*rows, strict=True)
                yield pd.DataFrame({
                    "_id": batch["_id"].to_numpy()[owner], "_th": batch["_th"].to_numpy()[owner],
                    "pos": pos, "size": size, "h": h, "d1": d1, "d2": d2,
                })

    return released(run)


def _place_key(th: np.ndarray, pos: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(th.astype(np.int64).view(np.uint64)) + pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _place_words(bits: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _words(_bits_of(_place_key(batch["_th"].to_numpy(), batch["pos"].to_numpy()), bits))

    return released(run)


def _contents(least: int, anchor: int, bits: int, wanted) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, owner, th = [], [], batch["_th"].to_numpy()
            for k, raw, data in _texts(batch, least):
                first, last, _ = _runs(data, least, anchor)
                keys = _place_key(np.full(len(first), th[k]), first)
                for j in np.flatnonzero(_in(wanted.value, keys, bits)).tolist():
                    rows.append((int(first[j]), raw[first[j] : int(last[j]) + least]))
                    owner.append(k)
            if rows:
                pos, data = zip(*rows, strict=True)
                yield pd.DataFrame({"_id": batch["_id"].to_numpy()[owner], "_th": th[owner], "pos": pos, "data": data})

    return released(run)


# --- enhanced suffix array --------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def interval_tree(lengths: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Maximal repeats as ``(length, first, last)`` of the sorted suffixes, by one stack scan.

    ``lengths[i]`` is the common prefix of suffixes ``i - 1`` and ``i``; ``left[i]`` the byte before
    suffix ``i``, or a number of its own where nothing stands before it. Intervals of shared
    left byte are not maximal: the string one byte longer to the left has the same members.
    """
    # length, first member, smallest and largest left byte seen
    stack: list[list[int]] = []
    for i in range(1, len(lengths) + 1):
        here = lengths[i] if i < len(lengths) else 0
        here = here if here >= least else 0
        first, lo, hi = i - 1, left[i - 1], left[i - 1]
        while stack and stack[-1][0] > here:
            length, start, a, b = stack.pop()
            lo, hi, first = min(lo, a), max(hi, b), start
            if lo != hi:
                yield length, start, i - 1
        if here:
            if stack and stack[-1][0] == here:
                stack[-1][2:] = [min(stack[-1][2], lo), max(stack[-1][3], hi)]
            else:
                stack.append([here, first, lo, hi])


def suffix_array(contents: list[bytes], groups: np.ndarray, least: int) -> tuple[list, list, list, list]:
    """Sorted suffixes that may start a maximal repeat: content index, offset, common prefix with
    the one before, left byte. Contents of different ``groups`` never match."""
    data = np.frombuffer(b"".join(contents), dtype=np.uint8)
    sizes = np.array([len(c) for c in contents])
    starts = np.cumsum(sizes) - sizes
    windows = sizes - least + 1
    owner = np.repeat(np.arange(len(contents)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = starts[owner] + offset
    with np.errstate(over="ignore"):
        names = gram_hashes(data, least)[at] + mixed(groups.astype(np.int64).view(np.uint64))[owner]
    left = np.where(offset > 0, data[np.maximum(at - 1, 0)].astype(np.int64), 256 + owner)
    order = np.argsort(names, kind="stable")
    names, left_o = names[order], left[order]
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    count = np.diff(np.append(first, len(names)))
    diverse = (count > 1) & (np.minimum.reduceat(left_o, first) != np.maximum.reduceat(left_o, first))
    picked = order[np.repeat(diverse, count)]
    suffixes = [(int(groups[o]), contents[o][f:], o, f, l_) for o, f, l_ in zip(owner[picked].tolist(), offset[picked].tolist(), left[picked].tolist(), strict=True)]
    suffixes.sort(key=lambda s: s[:2])
    shared = [0][: len(suffixes)] + [common_prefix(a[1], b[1]) if a[0] == b[0] else 0 for a, b in zip(suffixes, suffixes[1:], strict=False)]
    return [s[2] for s in suffixes], [s[3] for s in suffixes], shared, [s[4] for s in suffixes]


def _named(data: bytes) -> str:
    """The digest of a string, spelled as Spark spells the two halves of a class's digest."""
    return "".join(f"{x:X}" for x in np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), dtype=np.uint64).tolist())


SPAN = "cls bigint, start bigint, length bigint, repeat string"


def _spans(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["cls", "start", "length", "repeat"]).astype({"cls": "int64", "start": "int64", "length": "int64"})


def _window_task(least: int) -> Callable:
    """Maximal repeats that begin with one window, from all suffixes that do."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["data", "cls", "start"], ignore_index=True)
        suffixes, ids, starts = part["data"].tolist(), part["cls"].tolist(), part["start"].tolist()
        shared = [0] + [common_prefix(a, b) for a, b in zip(suffixes, suffixes[1:], strict=False)]
        rows = []
        for length, a, b in interval_tree(shared, part["before"].tolist(), least):
            name = _named(suffixes[a][:length])
            rows += [(ids[k], starts[k], length, name) for k in range(a, b + 1)]
        return _spans(rows)

    return run


def _array_task(least: int, groups_out: bool) -> Callable:
    def run(part: pd.DataFrame) -> pd.DataFrame:
        contents = part["data"].tolist()
        owner, offset, shared, left = suffix_array(contents, part["h"].to_numpy(), least)
        longest, rows = [0] * len(owner), []
        ids = part["cls"].tolist()
        for length, a, b in interval_tree(shared, left, least):
            for k in range(a, b + 1):
                longest[k] = max(longest[k], length)
            if groups_out:
                name = _named(contents[owner[a]][offset[a] : offset[a] + length])
                rows += [(ids[owner[k]], offset[k], length, name) for k in range(a, b + 1)]
        if not groups_out:
            rows = [(ids[owner[k]], offset[k], n, "") for k, n in enumerate(longest) if n]
        return _spans(rows)

    return run


def _window_rows(least: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h, cls, occ, data in zip(batch["h"], batch["cls"], batch["occ"], batch["data"], strict=True):
                n = len(data) - least + 1
                digests = np.frombuffer(b"".join(
                    hashlib.blake2b(data[k : k + least], digest_size=16).digest() for k in range(n)
                ), dtype=np.int64).reshape(-1, 2)
                yield pd.DataFrame({"h": h, "cls": cls, "occ": occ, "start": np.arange(n), "w1": digests[:, 0], "w2": digests[:, 1]})

    return released(run)


# --- operator ---------------------------------------------------------------------------------


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    # ids as text, since pandas would make doubles of integers beside a null
    return docs.select(F.col(id_col).cast("string").alias("_id"), text.alias("_text")).withColumn("_th", F.xxhash64("_text"))


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    anchor: int = ANCHOR,
    most_classes: int = MOST_CLASSES,
    bits: int = BITS,
    groups: bool = False,
) -> DataFrame:
    """Repeated strings per occurrence: ``_id, _th, start, length`` in bytes, not yet merged.

    With ``groups`` also ``repeat``, the digest of a maximal repeat's bytes as seen within runs, so that
    rows of equal ``repeat`` are all its occurrences, whatever ``most_classes`` and however often the
    texts around it are copied; texts that repeat as a whole run have the digest of the run.
    """
    spark = docs.sparkSession
    ship(spark)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(docs, id_col, text_col)
    counted = rows.select("_text").mapInPandas(_count_anchors(least, anchor, 4 * width), "bucket int, data binary")
    again = counted.groupBy("bucket").applyInPandas(_repeated_bits(bits), "word bigint, mask bigint")
    known = _gathered(spark, again, bits)
    found = settled(rows.mapInPandas(_occurrences(least, anchor, bits, known), f"_id string, {OCCURRENCE}"))

    key = ["h", "d1", "d2", "size"]
    classes = found.groupBy(*key).agg(
        F.count(F.lit(1)).alias("occ"), F.min(F.struct("_id", "_th", "pos")).alias("at")
    )
    classes = settled(settled(classes).withColumn("cls", F.monotonically_increasing_id()))
    anchors = classes.groupBy("h").agg(
        F.count(F.lit(1)).alias("n_cls"), F.min("occ").alias("least_occ")
    )
    # classes that occur twice are repeated whole; suffix arrays serve the others, and for groups
    # those too, since what they share with other classes occurs more often than they do
    whole = classes.where("occ > 1").select(
        "cls", F.lit(0).cast("bigint").alias("start"), F.col("size").cast("bigint").alias("length"),
        F.concat(F.hex("d1"), F.hex("d2")).alias("repeat"),
    )
    open_ = settled(
        classes.join(anchors.where("n_cls > 1" if groups else "n_cls > 1 AND least_occ = 1"), "h")
        .select("h", "cls", "occ", "n_cls", "size", "at._id", "at._th", "at.pos")
    )
    wanted = _gathered(spark, open_.select("_th", "pos").mapInPandas(_place_words(bits), "word bigint, mask bigint"), bits)
    near = marked(rows, F.col("_th"), bitmap(open_, "_th"), "_may").where("_may").drop("_may")
    bytes_of = near.mapInPandas(
        _contents(least, anchor, bits, wanted), "_id string, _th bigint, pos bigint, data binary"
    ).dropDuplicates(["_id", "_th", "pos"])
    same = (
        open_["_id"].eqNullSafe(bytes_of["_id"]) & (open_["_th"] == bytes_of["_th"]) & (open_["pos"] == bytes_of["pos"])
    )
    read = settled(open_.join(bytes_of, same).select("h", "cls", "occ", "n_cls", "data"))
    total = read.where(F.col("n_cls") <= most_classes).agg(F.sum(F.octet_length("data"))).first()[0] or 0
    tasks = max(width, -(-total // TASK_BYTES))
    arrays = (
        read.where(F.col("n_cls") <= most_classes)
        .groupBy(F.pmod(F.xxhash64("h"), F.lit(tasks)).alias("_task"))
        .applyInPandas(_array_task(least, groups), SPAN)
    )
    windows = read.where(F.col("n_cls") > most_classes).mapInPandas(
        _window_rows(least), "h bigint, cls bigint, occ bigint, start bigint, w1 bigint, w2 bigint"
    )
    windows = settled(windows)
    if groups:
        # only windows behind different bytes may begin a maximal repeat
        before = F.when(
            F.col("start") > 0, F.conv(F.hex(F.expr("substring(data, int(start), 1)")), 16, 10).cast("bigint")
        ).otherwise(F.col("cls") + 256)
        sides = windows.select("h", "cls", "start", "w1", "w2").join(read.select("cls", "data"), "cls").select(
            "h", "w1", "w2", "cls", "start", before.alias("before")
        )
        sides = settled(sides)
        diverse = sides.groupBy("h", "w1", "w2").agg(F.min("before").alias("_a"), F.max("before").alias("_b")).where("_a <> _b")
        split = (
            sides.join(diverse, ["h", "w1", "w2"]).join(read.select("cls", "data"), "cls")
            .select("h", "w1", "w2", "cls", "start", "before", F.expr("substring(data, int(start) + 1)").alias("data"))
            .groupBy("h", "w1", "w2").applyInPandas(_window_task(least), SPAN)
        )
    else:
        twice = windows.groupBy("h", "w1", "w2").agg(F.sum("occ").alias("_n")).where("_n > 1")
        split = windows.join(twice, ["h", "w1", "w2"]).select(
            "cls", "start", F.lit(least).cast("bigint").alias("length"), F.lit("").alias("repeat")
        )
    spans = whole.unionByName(arrays).unionByName(split)
    if groups:  # a whole run that others hold is found twice
        spans = spans.distinct()
    else:
        # one row per class: its merged spans
        spans = spans.groupBy("cls").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("_s")).select(
            "cls", F.explode(_merged(F.col("_s"))).alias("_s")
        ).select("cls", "_s.start", "_s.length", F.lit("").alias("repeat"))
    # settled, so that both sides of the join are shuffled for it and AQE can split a class of
    # very many occurrences
    spans = settled(spans)
    placed = found.join(classes.select(*key, "cls"), key).select("_id", "_th", "pos", "cls")
    out = placed.join(spans, "cls").select(
        "_id", "_th", (F.col("pos") + F.col("start")).alias("start"), "length", "repeat"
    )
    return out if groups else out.drop("repeat")


def _merged(spans):
    """Sorted spans with those that touch or overlap joined."""
    empty = F.array().cast("array<struct<start:bigint,length:bigint>>")

    def step(acc, s):
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (s["start"] <= last["start"] + last["length"])
        end = F.greatest(last["start"] + last["length"], s["start"] + s["length"])
        grown = F.concat(
            F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(last["start"].alias("start"), (end - last["start"]).alias("length"))),
        )
        return F.when(joins, grown).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, empty, step)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, starts, lengths in zip(batch["_text"], batch["_starts"], batch["_lengths"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            kept, at, removed, spans = hashlib.sha256(), 0, 0, 0
            if starts is not None and len(starts):
                order = np.argsort(starts, kind="stable")
                a, b = np.asarray(starts)[order], (np.asarray(starts) + np.asarray(lengths))[order]
                reach = np.maximum.accumulate(b)
                new = np.concatenate([[True], a[1:] > reach[:-1]])
                ends = reach[np.append(np.flatnonzero(new)[1:], len(a)) - 1]
                for x, y in zip(a[new].tolist(), ends.tolist(), strict=True):
                    kept.update(data[at:x])
                    at, removed, spans = y, removed + y - x, spans + 1
            kept.update(data[at:])
            rows.append((len(data), removed, spans, kept.hexdigest()))
        if rows:
            n, removed, spans, sha = zip(*rows, strict=True)
            yield pd.DataFrame({"_id": batch["_id"].to_numpy(), "n_bytes": n, "n_removed": removed, "n_spans": spans, "kept_sha256": sha})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Removes each byte covered by a string of ``least`` bytes that also starts anywhere else, in
    this text or another; matches never cross texts. Null text is empty; texts shorter than
    ``least`` stay whole. Rows that repeat an id or a text are texts of their own, so their long
    texts go in all copies. No documents, no rows.
    """
    rows = _rows(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, **options)
    kind = docs.schema[id_col].dataType.simpleString()
    shape = "_id string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    # a text's spans fit its row: at most one per run, after those of each run were merged
    per_text = settled(
        spans.distinct().groupBy("_id", "_th").agg(
            F.collect_list("start").alias("_starts"), F.collect_list("length").alias("_lengths")
        )
    )
    near = marked(rows, F.col("_th"), bitmap(per_text, "_th"), "_may")
    none = F.array().cast("array<bigint>")
    clear = near.where("NOT _may").select("_id", "_text", none.alias("_starts"), none.alias("_lengths"))
    hit = near.where("_may")
    same = hit["_id"].eqNullSafe(per_text["_id"]) & (hit["_th"] == per_text["_th"])
    joined = hit.join(per_text, same, "left").select(hit["_id"], "_text", "_starts", "_lengths")
    return clear.unionByName(joined).mapInPandas(_cut, shape).select(
        F.col("_id").cast(kind).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op8_repeats(spark, sf_dir: str) -> DataFrame:
    """``remove_repeats`` of ``documents``, and ``changed``, whether anything was removed."""
    cut = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cut.withColumn("changed", F.col("n_removed") > 0)


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 399, 0))) AS i FROM b)),
r AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
e AS (
  SELECT doc_id, i, lag(i) OVER o AS before, lead(i) OVER o AS after FROM r
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
-- spans: a start that no earlier one reaches, up to the last start within reach
s AS (
  SELECT doc_id, i, after, before IS NULL OR i > before + 400 AS opens,
         after IS NULL OR after > i + 400 AS closes FROM e),
o AS (SELECT doc_id, i AS a, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM s WHERE opens),
x AS (SELECT doc_id, i + 400 AS z, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM s WHERE closes),
p AS (SELECT doc_id, k, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY k) AS z0 FROM o JOIN x USING (doc_id, k)),
g AS (
  SELECT doc_id, sum(z - a) AS removed, count(*) AS spans, max(z) AS last,
         string_agg(substr(h, 2 * z0 + 1, 2 * (a - z0)), '' ORDER BY k) AS head
  FROM p JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(g.removed, 0) AS BIGINT) AS n_removed,
       coalesce(g.spans, 0) AS n_spans,
       sha256(unhex(coalesce(g.head || substr(b.h, 2 * g.last + 1), b.h))) AS kept_sha256,
       g.removed IS NOT NULL AS changed
FROM b LEFT JOIN g USING (doc_id)"""
