"""Jaccard self-join over word shingles: grouped prefix join.

Two sets that are similar enough share a token within the first few of each, in any one order of
all tokens. The order here puts the most frequent tokens last, so that common lines do not bring
unlike documents together. Documents of equal sets are one class; classes of equal prefix and
size are one group, and tokens list groups only. What tokens tell about groups, the groups that
share it and how often, is folded into runs: lists of groups with the number of tokens that have
just this list. Pairs of groups are made from runs, and counted up against the overlap that a
linked pair must have in its prefixes; classes of what is left are verified on whole sets.

Components need no pair twice over: first each group is held against one partner, and then only
pairs across the components found so far are made. Runs of many classes make no pairs at all:
their classes are compared in tiles, and a tile gives only what joins components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, components, forest, forget, give_back, marked, released, settled, ship, unkept, without

WIDTH, PERCENT = 4, 85
#: The most frequent tokens, known to all tasks: 8 bytes each. Any number gives right results.
FREQUENT = 1 << 17
#: Tokens of fewer classes than this never count as frequent.
LEAST_DF = 8
#: Runs of up to so many classes give pairs; larger ones are compared in tiles of two blocks of
#: about so many classes and tokens at most, so many different tokens and classes at once.
FEW, BLOCK, BLOCK_TOKENS, STRIPE, ROWS = 64, 1_024, 1 << 19, 2_048, 128
#: Leading bits of a token by which its frequency is counted. Tokens that share them count as one,
#: which moves them in the order and changes no result.
COUNTED_BITS = np.uint64(40)
#: Bytes of text hashed at once, tokens held before they are handed on.
STRIP, HELD = 1 << 19, 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                   0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = max(n, STRIP)
        with np.errstate(over="ignore"):
            made = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b)])) for b in (_BASE, inverse))
        _POWERS[0] = made
    return _POWERS[0]


def shingle_sets(texts: list[str], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    Words are runs of what is not ASCII white space, A-Z in lower case. A text of fewer words
    than ``width`` has its whole sequence as one shingle; one without words has none.
    """
    part: list[bytes] = []
    size = 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if part and size + len(data) > STRIP:
            yield from _sets(part, width)
            part, size = [], 0
        part.append(data)
        size += len(data) + 1
    if part:
        yield from _sets(part, width)


def _sets(part: list[bytes], width: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        line = b"\n".join(part) + b"\n"
        data = _LOWER[np.frombuffer(line, dtype=np.uint8)]
        blank = _BLANK[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
        starts, ends = edge[::2], edge[1::2]  # the line ends blank
        power, inverse = _powers(len(data) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])
        words = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        bounds = np.cumsum([0, *(len(p) + 1 for p in part)])
        cuts = np.searchsorted(starts, bounds)
        shingles, order = None, np.arange(width, dtype=np.uint64)
        place = _PLACE[np.arange(width) % 8] * (order // np.uint64(8) * np.uint64(2) + np.uint64(1))
        if len(words) >= width:
            total = np.zeros(len(words) - width + 1, dtype=np.uint64)
            for k in range(width):
                total += words[k : len(words) - width + 1 + k] * place[k]
            shingles = mixed(total)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a >= width:
                found = np.sort(shingles[a : b - width + 1])
                yield found[np.concatenate([[True], found[1:] != found[:-1]])]
            elif b > a:
                few = (words[a:b] * place[: b - a]).sum(dtype=np.uint64)
                yield mixed(np.array([few + np.uint64(b - a)], dtype=np.uint64))
            else:
                yield np.empty(0, dtype=np.uint64)


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` of which a similar one must share at least one."""
    return n - -(-percent * n // 100) + 1


def set_key(tokens: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        one = mixed(tokens ^ _PLACE[4])
        return np.array([one.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(tokens + _PLACE[5]))]).tobytes()


def prefix_of(tokens: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> tuple[np.ndarray, int]:
    """The first tokens of a set in the global order, and the id of their group.

    Tokens that are not frequent come first, by hash; then the frequent ones, rarest first.
    """
    p = prefix_length(len(tokens), percent)
    keys, ranks = frequent
    if len(keys):
        short = tokens >> (np.uint64(64) - COUNTED_BITS)
        at = np.minimum(np.searchsorted(keys, short), len(keys) - 1)
        often = keys[at] == short
        rare = tokens[~often]
        if len(rare) >= p:
            first = rare[:p]
        else:
            rest = tokens[often][np.argsort(ranks[at[often]], kind="stable")]
            first = np.concatenate([rare, rest[: p - len(rare)]])
    else:
        first = tokens[:p]
    with np.errstate(over="ignore"):
        seen = mixed(mixed(first).sum(dtype=np.uint64) * _PLACE[6] + np.uint64(len(tokens)))
    return first, int(seen.astype(np.int64))


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane, so that high zeros vanish."""
    steps = np.diff(values, prepend=np.uint64(0))
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash space."""
    return ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _count_tokens(width: int, buckets: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()

        def out() -> pd.DataFrame:
            tokens = np.sort(np.concatenate(held))
            cuts = np.searchsorted(_bucket(tokens, buckets), np.arange(buckets + 1))
            full = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
            tokens >>= np.uint64(64) - COUNTED_BITS
            return pd.DataFrame({"bucket": full, "data": [_packed(tokens[cuts[k] : cuts[k + 1]]) for k in full]})

        for batch in batches:
            for tokens in shingle_sets(batch["_text"].tolist(), width):
                if len(tokens) and (key := set_key(tokens)) not in seen:
                    seen.add(key)
                    held.append(tokens)
                    size += len(tokens)
                    if size > HELD:
                        yield out()
                        held, size = [], 0
        if size:
            yield out()

    return released(run)


def _frequent(most: int, least: int) -> Callable:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        tokens = np.sort(np.concatenate([_unpacked(d) for d in group["data"]]))
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        counts = np.diff(np.append(first, len(tokens)))
        keep = np.flatnonzero(counts >= least)
        keep = keep[np.lexsort((tokens[first[keep]], -counts[keep]))][:most]
        return pd.DataFrame({"token": tokens[first[keep]].astype(np.int64), "df": counts[keep]})

    return run


def _describe(width: int, percent: int, frequent) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for tokens in shingle_sets(batch["_text"].tolist(), width):
                if len(tokens):
                    rows.append((len(tokens), set_key(tokens).hex(), prefix_of(tokens, frequent.value, percent)[1]))
                else:
                    rows.append((0, None, 0))
            if rows:
                n, cls, group = zip(*rows, strict=True)
                yield pd.DataFrame({"_id": batch["_id"].to_numpy(), "n": n, "cls": cls, "grp": group})

    return released(run)


def _post(width: int, percent: int, frequent, buckets: int) -> Callable:
    """Prefix tokens with their group, per bucket; a task hands a group on once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()

        def out() -> pd.DataFrame:
            tokens = np.concatenate([h[0] for h in held])
            sizes = [len(h[0]) for h in held]
            groups = np.repeat(np.array([h[1] for h in held], dtype=np.int64), sizes)
            ns = np.repeat(np.array([h[2] for h in held], dtype=np.int32), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, groups, ns = tokens[order], groups[order], ns[order]
            cuts = np.searchsorted(_bucket(tokens, buckets), np.arange(buckets + 1))
            full = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
            cut = lambda x: [x[cuts[k] : cuts[k + 1]] for k in full]
            return pd.DataFrame({
                "bucket": full, "data": [_packed(t) for t in cut(tokens)],
                "groups": [g.tobytes() for g in cut(groups)], "ns": [n.tobytes() for n in cut(ns)],
            })

        for batch in batches:
            for tokens in shingle_sets(batch["_text"].tolist(), width):
                if not len(tokens):
                    continue
                first, group = prefix_of(tokens, frequent.value, percent)
                if group not in seen:
                    seen.add(group)
                    held.append((first, group, len(tokens)))
                    size += len(first)
                    if size > HELD // 2:
                        yield out()
                        held, size = [], 0
        if size:
            yield out()

    return released(run)


RUN_SHAPE = "kind int, a bigint, b bigint, n int, times int"


def _runs(percent: int) -> Callable:
    """Of a bucket's tokens: runs (kind 1: run, group, size, tokens) and pairs of each group with
    the smallest group of fitting size in its run (kind 0: group, partner, tokens)."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        tokens = np.concatenate([_unpacked(d) for d in part["data"]])
        groups = np.frombuffer(b"".join(part["groups"]), dtype=np.int64)
        ns = np.frombuffer(b"".join(part["ns"]), dtype=np.int32)
        order = np.lexsort((groups, ns, tokens))
        tokens, groups, ns = tokens[order], groups[order], ns[order]
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (groups[1:] != groups[:-1])])
        tokens, groups, ns = tokens[new], groups[new], ns[new]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        sizes = np.diff(np.append(first, len(tokens)))
        many = np.repeat(sizes > 1, sizes)
        groups, ns, sizes = groups[many], ns[many].astype(np.int64), sizes[sizes > 1]
        if not len(sizes):
            return pd.DataFrame({"kind": [], "a": [], "b": [], "n": [], "times": []}, dtype="int64")
        first = np.cumsum(sizes) - sizes
        with np.errstate(over="ignore"):
            names = mixed(np.add.reduceat(mixed(groups.view(np.uint64)), first) + sizes.astype(np.uint64))
        _, pick, times = np.unique(names, return_index=True, return_counts=True)
        # members of the runs picked, each run once
        lengths = sizes[pick]
        at = np.repeat(first[pick] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        owner = np.repeat(np.arange(len(pick)), lengths)
        g, n, t = groups[at], ns[at], times[owner]
        # the first member of the run whose size fits, by one search over all runs
        wide = int(n.max()) + 1
        place = np.searchsorted(owner * wide + n, owner * wide + -(-percent * n // 100))
        pairs = place < np.arange(len(g))
        return pd.DataFrame({
            "kind": np.concatenate([np.ones(len(g), int), np.zeros(pairs.sum(), int)]),
            "a": np.concatenate([names[pick].view(np.int64)[owner], g[pairs]]),
            "b": np.concatenate([g, g[place[pairs]]]),
            "n": np.concatenate([n, n[pairs]]),
            "times": np.concatenate([t, t[pairs]]),
        })

    return run


def _wrapped(text: str, tokens: np.ndarray) -> bytes:
    """A set on its way to other tasks: as its text or as its tokens, whichever takes fewer bytes.

    Tokens are eight bytes each that nothing shortens; a text is mostly less than half of that.
    """
    data = zstandard.compress(text.encode("utf-8", "surrogatepass"), 1)
    return data + b"t" if len(data) < 8 * len(tokens) else tokens.tobytes() + b"s"


def _unwrapped(sets: list[bytes], width: int) -> list[np.ndarray]:
    texts = [zstandard.decompress(s[:-1]).decode("utf-8", "surrogatepass") for s in sets if s.endswith(b"t")]
    made = shingle_sets(texts, width)
    return [
        next(made) if s.endswith(b"t") else np.frombuffer(s, dtype=np.uint64, count=len(s) // 8) for s in sets
    ]


def _whole_sets(width: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["_text"].tolist()
            keys, sets = [], []
            for text, tokens in zip(texts, shingle_sets(texts, width), strict=True):
                keys.append(set_key(tokens).hex() if len(tokens) else None)
                sets.append(_wrapped(text, tokens))
            if sets:
                yield pd.DataFrame({"_id": batch["_id"].to_numpy(), "key": keys, "wrapped": sets})

    return released(run)


def _overlap(width: int) -> Callable:
    def shared(x: np.ndarray, y: np.ndarray) -> int:
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        return int((y[at] == x).sum())

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        sets = list(dict.fromkeys([*a, *b]))
        of = dict(zip(sets, _unwrapped(sets, width), strict=True))
        return pd.Series([shared(of[x], of[y]) for x, y in zip(a, b, strict=True)], dtype="int64")

    return run


def _fits(a: str, b: str, percent: int) -> Column:
    small, large = F.least(a, b), F.greatest(a, b)
    return small * 100 >= large * percent


def _reaches(times: str, a: str, b: str, percent: int) -> Column:
    """Whether the tokens shared in two prefixes leave a link possible.

    What lies past the prefix that ends first is the only overlap not counted.
    """
    need = F.ceil(F.lit(percent) * (F.col(a) + F.col(b)) / (100 + percent))
    rest = lambda n: F.ceil(F.lit(percent) * F.col(n) / 100) - 1
    return F.col(times) + F.greatest(rest(a), rest(b)) >= need


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    frequent: int = FREQUENT,
    buckets: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` and ``component_id``.

    Documents link when ``100 * intersection >= percent * union`` of their shingle sets;
    ``component_id`` is the smallest id reachable by links, itself included. Null, empty and
    blank texts have no shingles and link with nothing. Null ids: such rows link like others
    but lend no id; where nothing else is linked the component is null. Rows that repeat an
    id each get a row. No documents, no rows. ``buckets`` are the ranges of the token space
    (default: four per shuffle partition), each of which one task holds.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ids pass through tasks as text, since pandas would make doubles of integers beside a null
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    counted = rows.mapInPandas(_count_tokens(width, buckets), "bucket int, data binary")
    each = max(1, frequent // buckets)  # so at most ``frequent`` reach the driver
    often = counted.groupBy("bucket").applyInPandas(_frequent(each, LEAST_DF), "token bigint, df bigint").toPandas()
    often = often.sort_values(["df", "token"], ignore_index=True)
    tokens = often["token"].to_numpy(dtype=np.int64).view(np.uint64)
    by_hash = np.argsort(tokens)
    known = spark.sparkContext.broadcast((tokens[by_hash], by_hash))

    told = settled(rows.mapInPandas(
        _describe(width, percent, known), "_id string, n bigint, cls string, grp bigint"
    ).withColumn("_id", F.col("_id").cast(kind)))
    forget(spark)  # the counts' files; the gateway lets go of frames a little late, so some may stay until the next call
    # a class is known by a number; its text is read from its first row
    classes = told.where("n > 0").groupBy("cls", "n", "grp").agg(F.min("_id").alias("rep"))
    classes = settled(settled(classes).withColumn("node", F.monotonically_increasing_id()))
    posts = rows.mapInPandas(
        _post(width, percent, known, buckets), "bucket int, data binary, groups binary, ns binary"
    )
    found = settled(posts.groupBy("bucket").applyInPandas(_runs(percent), RUN_SHAPE))
    # groups with the class that stands for them
    groups = settled(classes.groupBy("grp").agg(
        F.min("node").alias("head"), F.max("node").alias("_last"), F.first("n").alias("gn")
    ))

    forget(spark)
    # 1: every group against its best partner, every class against its group's head
    counts = found.where("kind = 0").groupBy("a", "b").agg(F.sum("times").alias("times"))
    ends = lambda side: groups.select(
        F.col("grp").alias(side), F.col("head").alias(f"{side}_node"), F.col("gn").alias(f"{side}_n")
    )
    sized = counts.join(ends("a"), "a").join(ends("b"), "b").where(_reaches("times", "a_n", "b_n", percent))
    best = sized.groupBy("a_node").agg(F.max_by("b_node", F.struct("times", F.negative("b_node"))).alias("b_node"))
    inside = classes.join(groups.where("head <> _last"), "grp").where("node <> head")
    first_pairs = best.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).unionByName(
        inside.select(F.col("node").alias("a"), F.col("head").alias("b"))
    )
    first_pairs = settled(first_pairs)  # under its own name: a frame that is kept keeps its shuffle files
    links = _verified(rows, classes, first_pairs, width, percent)
    nodes = classes.select("node")
    so_far = settled(components(nodes, links))
    forget(spark)

    # 2: across components, runs of few classes by pairs counted over whole runs, others by tiles
    at = settled(classes.join(so_far, "node").groupBy("grp").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n_cls")
    ))
    member = (
        found.where("kind = 1").groupBy(F.col("a").alias("run"), F.col("b").alias("grp"), "n")
        .agg(F.sum("times").alias("times")).join(at, "grp")
    )
    open_runs = (
        member.groupBy("run").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"), F.sum("n_cls").alias("_m"))
        .where("_lo <> _hi").select("run", "_m")
    )
    member = settled(member.join(open_runs, "run"))
    few = member.where(F.col("_m") <= FEW)
    x = few.select("run", "times", F.col("grp").alias("a"), F.col("n").alias("a_n"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    y = few.select("run", F.col("grp").alias("b"), F.col("n").alias("b_n"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    apart = ~((F.col("a_lo") == F.col("a_hi")) & (F.col("b_lo") == F.col("b_hi")) & (F.col("a_lo") == F.col("b_lo")))
    across = (
        x.join(y, "run").where((F.col("a") < F.col("b")) & apart & _fits("a_n", "b_n", percent))
        .groupBy("a", "b", "a_n", "b_n").agg(F.sum("times").alias("times"))
        .where(_reaches("times", "a_n", "b_n", percent)).select("a", "b")
    )
    torn = at.where("lo <> hi")  # groups of classes that are not yet together
    inner = torn.where(F.col("n_cls") <= FEW).select(F.col("grp").alias("a"), F.col("grp").alias("b"))
    of = settled(classes.join(so_far, "node").select("grp", "node", "component"))
    of_a = of.select(F.col("grp").alias("a"), F.col("node").alias("a_node"), F.col("component").alias("a_of"))
    of_b = of.select(F.col("grp").alias("b"), F.col("node").alias("b_node"), F.col("component").alias("b_of"))
    more = (
        across.unionByName(inner).join(of_a, "a").join(of_b, "b").where("a_of <> b_of")
        .where("a <> b OR a_node < b_node").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    )
    many = member.where(F.col("_m") > FEW).select("run", "grp").unionByName(
        torn.where(F.col("n_cls") > FEW).select(F.xxhash64("grp", F.lit(1)).alias("run"), "grp")
    ).join(of, "grp").select("run", "node").distinct()
    many = settled(many)
    forget(spark)
    joined = _tiled(rows, classes, many, so_far, width, percent)
    more = settled(more)
    pairs = _verified(rows, classes, more, width, percent)
    end = lambda side: so_far.select(F.col("node").alias(side), F.col("component").alias(f"{side}_of"))
    joined = joined.unionByName(
        pairs.join(end("a"), "a").join(end("b"), "b").select(F.col("a_of").alias("a"), F.col("b_of").alias("b"))
    )

    forget(spark)
    final = _together(so_far, settled(joined.distinct())).withColumnRenamed("component", "_comp")
    named = classes.join(final, "node")
    least = named.groupBy("_comp").agg(F.min("rep").alias("component_id"))
    of_class = named.join(least, "_comp").select("cls", F.col("n").alias("_n"), "component_id")
    same = (F.col("cls") == F.col("_cls")) & (F.col("n") == F.col("_n"))
    linked = told.where("n > 0").join(of_class.withColumnRenamed("cls", "_cls"), same)
    alone = told.where("n = 0").select("_id", "n", F.col("_id").alias("component_id"))
    return linked.select("_id", "n", "component_id").unionByName(alone).select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"
    )


def _verified(rows: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose whole sets link.

    Only rows that may stand for a class of a pair are hashed again, and only the sets of such
    classes move. The join keys are class numbers, so a class in many pairs is split by AQE.
    """
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    forget(rows.sparkSession)
    sets = _sets_of(rows, classes, needed, width)
    forget(rows.sparkSession)  # sets are settled, so the files they came by may go before pairs get theirs
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("wrapped").alias("a_set")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("wrapped").alias("b_set")), "b")
    shared = F.pandas_udf(_overlap(width), "bigint")("a_set", "b_set")
    scored = both.where(_fits("a_n", "b_n", percent)).select("a", "b", "a_n", "b_n", shared.alias("_s"))
    linked = (100 + percent) * F.col("_s") >= F.lit(percent) * (F.col("a_n") + F.col("b_n"))
    return settled(scored.where(linked).select("a", "b"))


def _sets_of(rows: DataFrame, classes: DataFrame, needed: DataFrame, width: int) -> DataFrame:
    """``node, n, wrapped`` of the classes in ``needed(node)``: sets that :func:`_unwrapped` opens."""
    reps = settled(classes.join(needed, "node").select("node", "rep", "cls", "n"))
    # a class of null ids alone is read by its key among the rows of null id
    reps = reps.withColumn("rep", F.coalesce(F.col("rep").cast("string"), F.lit("")))
    rows = rows.select(F.coalesce("_id", F.lit("")).alias("_id"), "_text")
    few = marked(rows, F.col("_id"), bitmap(reps, "rep"), "_may").where("_may").select("_id", "_text")
    made = few.mapInPandas(_whole_sets(width), "_id string, key string, wrapped binary")
    sets = (
        # rows may repeat an id: take the one whose set the class has; by the join's own keys, so that sets move once
        made.join(reps, (F.col("_id") == F.col("rep")) & (F.col("key") == F.col("cls")))
        .dropDuplicates(["rep", "cls", "node"]).select("node", "n", "wrapped")
    )
    return settled(sets)


def _tile_links(percent: int) -> Callable:
    """Links of a tile's classes that join components, as each component with the smallest it hangs
    together with. ``of`` is a class's component so far; without it each class is one of its own."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("node", ignore_index=True)
        n, side, nodes = tile["n"].to_numpy(), tile["side"].to_numpy(), tile["node"].to_numpy()
        known, of = np.unique(tile["of"].to_numpy() if "of" in tile else nodes, return_inverse=True)
        owner = np.repeat(np.arange(len(tile)), n)
        tokens = np.frombuffer(b"".join(tile["tokens"]), dtype=np.uint64)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        count = np.diff(np.append(first, len(tokens)))
        # only tokens of two classes or more add to an overlap
        column = np.repeat(np.cumsum(count > 1) - 1, count)
        kept = np.repeat(count > 1, count)
        owner, column = owner[kept], column[kept]
        shared = np.zeros((len(tile), len(tile)), dtype=np.float32)
        cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + STRIPE + 1, STRIPE))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a < b:
                part = np.zeros((len(tile), STRIPE), dtype=np.float32)
                part[owner[a:b], column[a:b] % STRIPE] = 1
                shared += part @ part.T
        labels = np.arange(len(known))
        crossing = tile["i"].iloc[0] != tile["j"].iloc[0]  # of two blocks only what lies between them
        for low in range(0, len(tile), ROWS):
            high = min(low + ROWS, len(tile))
            linked = (100 + percent) * shared[low:high].astype(np.int64) >= percent * (n[low:high, None] + n[None, :])
            if crossing:
                linked &= side[low:high, None] != side[None, :]
            linked &= of[low:high, None] != of[None, :]
            i, j = np.nonzero(np.triu(linked, low + 1))
            forest(labels, of[i + low], of[j])
        hit = np.flatnonzero(labels != np.arange(len(known)))
        found = pd.DataFrame({"a": known[hit], "b": known[labels[hit]]})
        del shared, tokens, owner, column, order, count, kept
        give_back()
        return found

    return run


def _tiled(rows: DataFrame, classes: DataFrame, many: DataFrame, so_far: DataFrame, width: int, percent: int) -> DataFrame:
    """Links within each run of ``many(run, node)``, by tiles of its blocks, between components of
    ``so_far(node, component)``.

    Pairs stay in their tile: it tells its overlaps by a matrix product and gives a forest of what
    is not yet together. Each block is compared within itself first, and what that joins counts as
    one component when two blocks are compared, so that the edges of a large group follow its
    blocks and not its tiles. Tiles of one component are left out.
    """
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS))
    sizes = many.join(classes.select("node", "n"), "node").groupBy("run").agg(blocks.cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = settled(many.join(sizes, "run").withColumn("own", own))
    sets = _sets_of(rows, classes, many.select("node").distinct(), width)
    forget(rows.sparkSession)
    alone = placed.select("run", "node", F.col("own").alias("i"), F.col("own").alias("j"), F.lit(0).alias("side"))
    within = _joins(alone, sets, so_far, width, percent)
    two = (
        placed.where("blocks > 1")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("own <> other")
        .select("run", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") > F.col("other")).cast("int").alias("side"))
    )
    if two.isEmpty():
        return within
    return within.unionByName(_joins(two, sets, _together(so_far, within), width, percent))


def _joins(tiles: DataFrame, sets: DataFrame, so_far: DataFrame, width: int, percent: int) -> DataFrame:
    """What the tiles join, as distinct pairs of components of ``so_far``."""
    tiles = tiles.join(so_far.withColumnRenamed("component", "of"), "node")
    open_ = (
        tiles.groupBy("run", "i", "j").agg(F.min("of").alias("_lo"), F.max("of").alias("_hi"))
        .where("_lo <> _hi").select("run", "i", "j")
    )
    found = tiles.join(open_, ["run", "i", "j"]).join(sets, "node").groupBy("run", "i", "j")
    links = _tile_links(percent)

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        tile["tokens"] = [s.tobytes() for s in _unwrapped(tile.pop("wrapped").tolist(), width)]
        return links(tile)

    return settled(found.applyInPandas(run, "a bigint, b bigint").distinct())


def _together(so_far: DataFrame, edges: DataFrame) -> DataFrame:
    """``so_far(node, component)`` after edges between its components."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    moved = components(ends, edges).where("node <> component")
    moved = settled(moved.select(F.col("node").alias("component"), F.col("component").alias("_whole")))
    return settled(
        so_far.join(moved, "component", "left").select("node", F.coalesce("_whole", "component").alias("component"))
    )


def op7_ngram_join(spark, sf_dir: str) -> DataFrame:
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(
           CASE WHEN len(w) >= 4
                THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
walk(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT k.doc_id, l.b FROM walk k JOIN links l ON k.seen = l.a),
c AS (SELECT doc_id, min(seen) AS component_id FROM walk GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that have a smaller id in their component, with all their columns.

    Rows that share an id stay or go together: they stay if one of them does.
    """
    found = similar_documents(docs, id_col=id_col, **options)
    kept = F.col(id_col).eqNullSafe(F.col("component_id")).alias("kept")
    return without(docs, unkept(found.select(id_col, kept), id_col), id_col)
