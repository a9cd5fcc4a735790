"""Groups of near-duplicate records: an LSH forest over min-hash signatures, then exact verification.

Each content has 128 min-hashes of its character shingles.  A tree of the forest is a sorted order of all
contents by a label of four of them; neighbours in the order are contents whose labels share a long prefix.

*Orders.*  All trees are one table, range-partitioned and sorted by tree and label.  One sweep over it takes the
longest common prefix (LCP) of each row with the next.  A row's *region* is the run of rows around it whose
prefixes agree to some depth; the depth adapts everywhere: it is the first, from ``SHARED`` values on, at which the run has at most
``REGION`` rows.  Sparse parts of the collection are compared under short prefixes, dense ones under long ones.
*Edges.*  A sweep sees one partition.  Whatever lies so near to a partition's edge that its region could reach
over is handed to a second sweep of the rows around the edges, so partitioning changes no result.
*Crowded regions.*  More than ``REGION`` rows may share a whole label.  They branch into ``FAN`` orders of four further values, which
are sorted and swept in the same way; each region has values of its own, so that misses in different trees are
independent.  What is crowded after ``LEVELS`` branchings is compared block against block, so no region is cut short.
*Candidates* are the pairs of a region whose one-bit sketches, then whose whole signatures agree enough; their shingles verify them.

A pair of similarity 0.7 shares four values in some of 40 trees with probability 0.99998, and fewer suffice where its
region is sparse; a branch loses it with probability 0.01 at most, and it has about ten trees to be found in.  Sketch and signature pass
it with probability above 0.9999.  Equal contents are one class from the start.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from loomgraph.operators.skew import attach
from loomgraph.workspace import Workspace

#: Min-hashes, made in so many passes: a pass gives each shingle to one of its bins, and each bin keeps its least.  With few bins a
#: pass even the values of texts of ten shingles hardly depend on each other.
HASHES, PASSES = 128, 16
BINS = HASHES // PASSES
#: Orders, and values of a label.
TREES, DEPTH = 40, 4
#: Values that a region shares at least, and its rows at most.
SHARED, REGION = 2, 64
#: A crowded region branches into so many orders, at most so many times.
FAN, LEVELS = 16, 2
#: Least share of equal bits of the sketches; a pair of similarity 0.7 has 0.85 on average, four deviations above.
SKETCH = 0.72
#: How far below the threshold the share of equal min-hashes may lie: four and a half deviations.
SIGNATURE = 0.18
#: Up to this size a class of equal contents is written out as pairs; of a larger one each member is paired with the representative.
WRITTEN_OUT = 1000
#: Rows swept at once, and characters hashed at once.
SWEPT, HASHED = 100_000, 500_000
_RNG = np.random.default_rng(5)
_FACTORS = _RNG.integers(1 << 62, 1 << 63, PASSES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Where an empty bin takes its value from: the first of these bins that has one.
_LENDERS = np.stack([np.concatenate([_RNG.permutation(BINS) for _ in range(2)]) for _ in range(HASHES)])
_ORDERS = np.stack([_RNG.permutation(HASHES)[:DEPTH] for _ in range(TREES)])
#: By level, then ``TREES`` sets, of which a region's hash chooses one: what the branches of one tree miss, those of another don't.
_BRANCHES = np.stack([[[_RNG.permutation(HASHES)[:DEPTH] for _ in range(FAN)] for _ in range(TREES)] for _ in range(LEVELS)])
_SPACES = re.compile("[ \t\r\n\u3000]+")


def content(title: str | None, text: str | None) -> str | None:
    """Title, one space, text, with white space unified, in lower case; null where the text is null or blank."""
    if text is None or not text.strip():
        return None
    return _SPACES.sub(" ", f"{title or ''} {text}").strip(" ").lower()


def shingles(s: str, n: int = 5) -> set[str]:
    return {s[i : i + n] for i in range(len(s) - n + 1)}


def _windows(c: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` adjacent code points."""
    c = c.astype(np.uint64)
    h = np.zeros(max(0, len(c) - n + 1), np.uint64)
    for i in range(n):
        h = (h ^ c[i : len(c) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def shingle_hashes(s: str, n: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; two of a pair of texts meet by chance once in 10^12."""
    return np.unique(_windows(np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32), n))


def signatures(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Min-hashes of ``n`` texts; ``owner`` is the text of each shingle hash, and repeats don't matter.

    An empty bin takes the value of another bin of its pass, chosen alike for all texts, so that bins agree with the
    probability of the texts' similarity also where a text has few shingles.
    """
    none = np.iinfo(np.uint64).max
    out = np.full((n, HASHES), none, np.uint64)
    shift, low = np.uint64(65 - int(BINS).bit_length()), np.uint64((1 << 56) - 1)
    row_at, h, at = owner * HASHES, np.empty_like(hashes), np.empty(len(hashes), np.int64)
    for i in range(PASSES):
        np.multiply(hashes, _FACTORS[i], out=h)
        np.right_shift(h, shift, out=at.view(np.uint64))
        at += row_at
        at += i * BINS
        h &= low
        np.minimum.at(out.ravel(), at, h)
        own = out[:, i * BINS : (i + 1) * BINS]
        row, gap = np.nonzero(own == none)
        filled = own.copy()
        for turn in range(_LENDERS.shape[1]):
            if not len(row):
                break
            got = own[row, _LENDERS[i * BINS + gap, turn]]
            filled[row, gap] = got
            open_ = got == none
            row, gap = row[open_], gap[open_]
        out[:, i * BINS : (i + 1) * BINS] = filled
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    return signatures(hashes, np.zeros(len(hashes), np.int64), 1)[0]


def _text_signatures(texts: list[str], n: int = 5) -> np.ndarray:
    """Signatures of texts of at least ``n`` characters, hashed some at a time."""
    out, a = [], 0
    while a < len(texts):
        b, chars = a, 0
        while b < len(texts) and (b == a or chars + len(texts[b]) <= HASHED):
            chars += len(texts[b])
            b += 1
        size = np.fromiter((len(t) for t in texts[a:b]), np.int64, b - a)
        h = _windows(np.frombuffer("".join(texts[a:b]).encode("utf-32-le", "surrogatepass"), np.uint32), n)
        owner = np.repeat(np.arange(b - a), size)[: len(h)]
        inside = np.arange(len(h)) + n <= np.cumsum(size)[owner]
        out.append(signatures(h[inside], owner[inside], b - a))
        a = b
    return np.concatenate(out)


def _contents(units: DataFrame, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [content(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            keep = [i for i, s in enumerate(made) if s is not None and len(s) >= 5]
            digest = [hashlib.blake2b(made[i].encode("utf-8", "surrogatepass"), digest_size=16).digest() for i in keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(digest, pa.binary()), pa.array([made[i] for i in keep], pa.string())], ["unit_id", "digest", "content"])

    return units.select(F.col(key), "title", "text").where(F.col(key).isNotNull()).mapInArrow(run, "unit_id string, digest binary, content string")


def _signatures(classes: DataFrame) -> DataFrame:
    """``cid, values`` (16 bits of each min-hash) and the two halves of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mixed = (_text_signatures(batch.column(1).to_pylist()) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
            bits = np.packbits((mixed >> np.uint64(20)).astype(np.uint8) & 1, axis=1).view(np.int64)
            values = [v.tobytes() for v in mixed.astype(np.uint16)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary()), pa.array(bits[:, 0]), pa.array(bits[:, 1])], ["cid", "values", "s0", "s1"])

    return classes.select("cid", "content").mapInArrow(run, "cid bigint, values binary, s0 bigint, s1 bigint")


def _held(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def _packed(values: np.ndarray) -> np.ndarray:
    """Labels of ``DEPTH`` values as one number whose order is that of the values."""
    v = values.astype(np.uint64)
    out = np.zeros(v.shape[:-1], np.uint64)
    for i in range(DEPTH):
        out = (out << np.uint64(16)) | v[..., i]
    return out.view(np.int64)


_ORDER = "home bigint, label bigint, cid bigint, s0 bigint, s1 bigint"


def _ordered(signed: DataFrame) -> DataFrame:
    """One row per content and tree: ``home`` (the tree), ``label``, ``cid``, the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            label = _packed(_held(batch.column(1))[:, _ORDERS])
            at = pa.array(np.repeat(np.arange(n), TREES))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(TREES), n)), pa.array(label.ravel()), *(batch.column(i).take(at) for i in (0, 2, 3))], ["home", "label", "cid", "s0", "s1"])

    return signed.select("cid", "values", "s0", "s1").mapInArrow(run, _ORDER)


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A hash of two numbers, not negative."""
    h = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = ((h ^ (h >> np.uint64(31))) + y.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(1)).view(np.int64)


def _branched(crowded: DataFrame, signed: DataFrame, level: int) -> DataFrame:
    """Rows ``home, cid`` of crowded regions, each in ``FAN`` orders of its region."""
    orders = _BRANCHES[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            home = np.asarray(batch.column(0))
            own = orders[(home >> 20) % TREES].reshape(n, FAN * DEPTH)
            label = _packed(np.take_along_axis(_held(batch.column(4)), own, axis=1).reshape(n, FAN, DEPTH))
            at = pa.array(np.repeat(np.arange(n), FAN))
            yield pa.RecordBatch.from_arrays([pa.array(_mixed(np.repeat(home, FAN), np.tile(np.arange(FAN), n))), pa.array(label.ravel()), *(batch.column(i).take(at) for i in (1, 2, 3))], ["home", "label", "cid", "s0", "s1"])

    return crowded.join(signed, "cid").select("home", "cid", "s0", "s1", "values").mapInArrow(run, _ORDER)


def _regions(home: np.ndarray, label: np.ndarray, low: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each row's region in a sorted order (-1 for none), and which rows are crowded under their whole label.

    A region is the run of rows whose labels share a prefix of the first depth, from ``low`` on, at which the run has at most ``most`` rows.
    """
    n = len(home)
    x = label.view(np.uint64)
    differ = x[1:] ^ x[:-1]
    lcp = np.full(n, -1, np.int8)
    shared = sum((differ < np.uint64(1 << 16 * i)).astype(np.int8) for i in range(1, DEPTH)) + (differ == 0)
    lcp[1:] = np.where(home[1:] == home[:-1], shared, -1)
    first, crowded = np.full(n, -1, np.int64), np.ones(n, bool)
    for depth in range(low, DEPTH + 1):
        edge = np.flatnonzero(lcp < depth)
        size = np.diff(np.append(edge, n))
        fits = crowded & np.repeat(size <= most, size)
        first[fits] = np.repeat(edge, size)[fits]
        crowded &= ~fits
    return first, crowded


_FOUND = "kind int, a bigint, b bigint, home bigint, label bigint, s0 bigint, s1 bigint, part int, place bigint"
_PAIR, _EDGE, _SIZE, _CROWDED = range(4)


def _rows(kind: int, n: int, **cols: np.ndarray) -> pa.RecordBatch:
    names = [c.split()[0] for c in _FOUND.split(", ")]
    small = {"kind": np.full(n, kind, np.int32), "part": np.zeros(n, np.int32)}
    return pa.RecordBatch.from_arrays([pa.array((small | cols)[c] if c in small or c in cols else np.zeros(n, np.int64)) for c in names], names)


def _judged(rows: dict[str, np.ndarray], first: np.ndarray, crowded: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Candidates of the regions given by ``first`` (-1: none), and the crowded rows under the name of their region."""
    at = np.flatnonzero(first >= 0)
    if len(at):
        sketch = np.stack([rows["s0"][at], rows["s1"][at]], axis=1).view(np.uint64)
        pairs = _pairs_inside(first[at], np.full(len(at), -1, np.int32), rows["cid"][at], sketch)
        if len(pairs):
            yield _rows(_PAIR, len(pairs), a=pairs[:, 0], b=pairs[:, 1])
    if crowded.any():
        yield _rows(_CROWDED, int(crowded.sum()), a=rows["cid"][crowded], home=_mixed(rows["home"][crowded], rows["label"][crowded]))


def _sweep(batches: Iterator[pa.RecordBatch], low: int, most: int) -> Iterator[pa.RecordBatch]:
    """One sorted partition: what its inner rows find, the rows near its edges, and its size.

    Whether a run has more than ``most`` rows shows within ``most`` places of any of its rows; so rows that far from both edges are judged here.
    """
    names = ["home", "label", "cid", "s0", "s1"]
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    held, place, done, n = {c: np.empty(0, np.int64) for c in names}, 0, 0, 0  # place: of the first row that is held

    def edge(where: np.ndarray) -> pa.RecordBatch:
        at = place + np.flatnonzero(where)
        cols = {c: held[c][where] for c in names if c != "cid"}
        return _rows(_EDGE, len(at), a=held["cid"][where], place=at, part=np.full(len(at), part, np.int32), **cols)

    def judge(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, place, done
        at = place + np.arange(len(held["home"]))
        first, crowded = _regions(held["home"], held["label"], low, most)
        size = np.bincount(first[first >= 0], minlength=len(at))
        end = n if last else n - most
        begin = place + first
        ours = (first >= 0) & (begin >= max(done, most)) & (begin < end)
        if last:
            ours &= begin + size[first] <= n - most
            end = n - most
        yield from _judged(held, np.where(ours, first, -1), crowded & (at >= max(done, most)) & (at < end))
        if done < 2 * most:
            yield edge((at >= done) & (at < min(2 * most, n if last else n - most)))
        if last:
            yield edge((at >= max(2 * most, n - 2 * most)))
            yield _rows(_SIZE, 1, part=np.full(1, part, np.int32), place=np.full(1, n, np.int64))
        done = max(done, n - most)
        cut = max(0, n - 2 * most - place)
        held, place = {c: v[cut:] for c, v in held.items()}, place + cut

    fresh: list[pa.RecordBatch] = []

    def take() -> None:
        nonlocal held, n
        for c in names:
            held[c] = np.concatenate([held[c], *(np.asarray(b.column(names.index(c))) for b in fresh)])
        n += sum(b.num_rows for b in fresh)
        fresh.clear()

    for batch in batches:
        fresh.append(batch)
        if sum(b.num_rows for b in fresh) >= SWEPT:
            take()
            yield from judge(False)
    take()
    if n:
        yield from judge(True)


def _swept(rows: DataFrame, n_rows: int, low: int, most: int, ws: Workspace, level: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``a, b`` of sorted orders, and their crowded rows ``home, cid``."""
    spark = rows.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // (8 * most)), n_rows // 1_000_000)
    # with the content as last key, rows of one label spread over as many tasks as they fill
    ordered = rows.repartitionByRange(parts, "home", "label", "cid").sortWithinPartitions("home", "label", "cid")
    swept = ws.write(ordered.mapInArrow(lambda batches: _sweep(batches, low, most), _FOUND), f"swept{level}")
    # one row per partition
    size = {r["part"]: r["place"] for r in swept.where(F.col("kind") == _SIZE).select("part", "place").collect()}
    order = sorted(size)
    begin = np.cumsum([0, *(size[p] for p in order)])
    base = {p: int(b) for p, b in zip(order, begin)}
    # rows around edges that lie near to each other are judged together
    group = np.cumsum(np.diff(begin, prepend=begin[:1]) > 4 * most)
    near = {p: (int(group[i]), int(group[i + 1])) for i, p in enumerate(order)}
    known = spark.createDataFrame([(p, size[p], base[p], *near[p]) for p in order], "part int, n bigint, base bigint, before bigint, after bigint")
    around = swept.where(F.col("kind") == _EDGE).join(F.broadcast(known), "part")
    head, tail = F.col("place") < 2 * most, F.col("place") >= F.col("n") - 2 * most
    at_edge = F.array_distinct(F.array_compact(F.array(F.when(head, F.col("before")), F.when(tail, F.col("after")))))
    inner = (F.col("place") >= most) & (F.col("place") < F.col("n") - most)
    around = around.select(F.explode(at_edge).alias("group"), (F.col("base") + F.col("place")).alias("at"), inner.alias("inner"), "home", "label", F.col("a").alias("cid"), "s0", "s1")

    def judge(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("at")
        cols = {c: table.column(c).to_numpy() for c in ("home", "label", "cid", "s0", "s1")}
        outer = ~table.column("inner").to_numpy(zero_copy_only=False)
        first, crowded = _regions(cols["home"], cols["label"], low, most)
        reach = np.bincount(first[first >= 0], outer[first >= 0], len(first))
        found = list(_judged(cols, np.where((first >= 0) & (reach[first] > 0), first, -1), crowded & outer))
        return pa.Table.from_batches(found or [_rows(_PAIR, 0)])

    over = ws.write(around.groupBy("group").applyInArrow(judge, _FOUND), f"edges{level}")
    every = swept.where(F.col("kind").isin(_PAIR, _CROWDED)).unionByName(over)
    return every.where(F.col("kind") == _PAIR).select("a", "b"), every.where(F.col("kind") == _CROWDED).select("home", F.col("a").alias("cid")).distinct()


def _blocks(crowded: DataFrame, signed: DataFrame, most: int) -> DataFrame:
    """``region, side, cid, s0, s1``: regions crowded to the end as blocks, each against each; -1 as side means everyone in the block."""
    size = crowded.groupBy("home").count()
    blocks = F.ceil(F.col("count") / most).cast("int")
    own = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    grid = attach(crowded, size, "home").join(signed.select("cid", "s0", "s1"), "cid").select("home", "cid", "s0", "s1", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    a, b = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(a == b, -1).otherwise(F.when(F.col("own") == a, 0).otherwise(1)).cast("int")
    return grid.select(F.xxhash64("home", a, b).alias("region"), side.alias("side"), "cid", "s0", "s1")


def _candidates(signed: DataFrame, ws: Workspace) -> DataFrame:
    """``a, b``: all pairs that the forest brings together, once."""
    rows, low, parts = _ordered(signed), SHARED, []
    n_rows = signed.count() * TREES
    for level in range(LEVELS + 1):
        pairs, crowded = _swept(rows, n_rows, low, REGION, ws, level)
        parts.append(pairs)
        crowded = ws.write(crowded, f"crowded{level}")
        n = crowded.count()
        if not n:
            break
        if level == LEVELS:
            parts.append(_block_pairs(_blocks(crowded, signed, max(REGION, 1024))))
        else:
            rows, n_rows, low = ws.write(_branched(crowded, signed, level), f"branched{level}"), n * FAN, 1
    return _union(parts).distinct()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _pairs_inside(region: np.ndarray, side: np.ndarray, cid: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Pairs of one region whose sketches agree enough; rows are sorted by region."""
    most = int(HASHES * (1 - SKETCH))
    edge = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    size = np.diff(np.concatenate([edge, [len(region)]]))
    length = np.repeat(size, size)
    found = []
    small = length <= 64
    step = 1
    idx = np.flatnonzero(small & (length > 1))
    while len(idx):
        idx = idx[idx + step < len(region)]
        idx = idx[region[idx] == region[idx + step]]
        if not len(idx):
            break
        j = idx + step
        far = np.bitwise_count(sketch[idx] ^ sketch[j]).sum(axis=1)
        ok = (far <= most) & ((side[idx] < 0) | (side[idx] != side[j]))
        found.append(np.stack([cid[idx[ok]], cid[j[ok]]], axis=1))
        step += 1
    for a, n in zip(edge[size > 64], size[size > 64]):
        s, c, w = sketch[a : a + n], cid[a : a + n], side[a : a + n]
        for i in range(0, n, 256):
            far = np.bitwise_count(s[i : i + 256, None, 0] ^ s[None, :, 0]) + np.bitwise_count(s[i : i + 256, None, 1] ^ s[None, :, 1])
            x, y = np.nonzero(far <= most)
            x = x + i
            ok = (x < y) & ((w[x] < 0) | (w[x] != w[y]))
            found.append(np.stack([c[x[ok]], c[y[ok]]], axis=1))
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    pairs = np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1)
    return np.unique(pairs, axis=0)


def _block_pairs(regions: DataFrame) -> DataFrame:
    """Pairs of blocks whose sketches agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            cols = [np.asarray(batch.column(i)) for i in range(5)]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
            if not len(cols[0]):
                continue
            last = np.searchsorted(cols[0], cols[0][-1])  # the last region may go on in the next batch
            rest = [c[last:] for c in cols]
            yield out([c[:last] for c in cols])
        if rest is not None:
            yield out(rest)

    def out(cols: list[np.ndarray]) -> pa.RecordBatch:
        region, side, cid, s0, s1 = cols
        pairs = _pairs_inside(region, side, cid, np.stack([s0, s1], axis=1).view(np.uint64)) if len(region) else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    ordered = regions.repartition("region").sortWithinPartitions("region")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def _likely(pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose signatures agree in enough places."""
    least = HASHES * (threshold - SIGNATURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = (_held(batch.column(2)) == _held(batch.column(3))).sum(axis=1)
            keep = pa.array(same >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    left, right = (signed.select(F.col("cid").alias(c), F.col("values").alias(v)) for c, v in (("a", "v"), ("b", "w")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "v", "w").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            keep, sims = [], []
            a, b = (batch.column(i).to_pylist() for i in (0, 1))
            for i in range(batch.num_rows):
                sets = []
                for cid, text in ((a[i], batch.column(2)), (b[i], batch.column(3))):
                    if cid not in known:
                        if size > 4_000_000:
                            known.clear()
                            size = 0
                        known[cid] = shingle_hashes(text[i].as_py())
                        size += len(known[cid])
                    sets.append(known[cid])
                p, q = sets
                met = np.sort(np.concatenate(sets))
                both = int((met[1:] == met[:-1]).sum())
                sim = both / (len(p) + len(q) - both)
                if sim >= threshold:
                    keep.append(i)
                    sims.append(sim)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(sims, pa.float64())], ["a", "b", "similarity"])

    left = classes.select(F.col("cid").alias("a"), F.col("content").alias("x"))
    right = classes.select(F.col("cid").alias("b"), F.col("content").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, similarity double")


def _classes(units: DataFrame, key: str, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """``cid, content`` of distinct contents, and ``unit_id, cid, class_id, n`` of their members."""
    made = ws.write(_contents(units, key), "contents")
    grouped = made.groupBy("digest").agg(F.min("unit_id").alias("class_id"), F.count_distinct("unit_id").alias("n"), F.first("content").alias("content"))
    classes = ws.write(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = made.select("unit_id", "digest").distinct().join(classes.select("digest", "cid", "class_id", "n"), "digest").drop("digest")
    return classes.select("cid", "content"), ws.write(members, "members")


def similar_classes(classes: DataFrame, ws: Workspace, threshold: float = 0.7) -> DataFrame:
    """``a, b, similarity``: pairs of distinct contents that are at least ``threshold`` similar."""
    signed = ws.write(_signatures(classes), "signatures")
    likely = ws.write(_likely(_candidates(signed, ws), signed, threshold), "likely")
    return ws.write(_verified(likely, classes, threshold), "similar")


def near_duplicates(units: DataFrame, key: str = "knowledge_unit_id", threshold: float = 0.7) -> DataFrame:
    """``unit_id_a, unit_id_b``: pairs of different units whose contents are at least ``threshold`` similar, once, smaller id first.

    Similarity is Jaccard's of distinct 5-character shingles of the content (title, one space, text, white
    space unified, lower case; a null title is empty).  Null ids, null and blank texts and contents under
    five characters take no part.  Repeated rows count once; of a unit with several contents each counts.
    Of a class of more than WRITTEN_OUT equal contents the representative (smallest id) stands for it in pairs
    and is paired with each member; :func:`duplicate_groups` gives the membership.  Empty tables give no rows.
    """
    ws = Workspace(units.sparkSession, "near_duplicates")
    classes, members = _classes(units, key, ws)
    similar = similar_classes(classes, ws, threshold)
    named = members.where((F.col("n") <= WRITTEN_OUT) | (F.col("unit_id") == F.col("class_id")))
    one = named.select(F.col("cid").alias("a"), F.col("unit_id").alias("u"))
    two = named.select(F.col("cid").alias("b"), F.col("unit_id").alias("v"))
    across = similar.select("a", "b").join(one, "a").join(two, "b").select("u", "v")
    small = members.where((F.col("n") > 1) & (F.col("n") <= WRITTEN_OUT)).select("cid", F.col("unit_id").alias("u"))
    within = small.join(small.withColumnRenamed("u", "v"), "cid").where("u < v").select("u", "v")
    large = members.where(F.col("n") > WRITTEN_OUT).select(F.col("class_id").alias("u"), F.col("unit_id").alias("v"))
    every = across.unionByName(within).unionByName(large).where("u <> v")
    return every.select(F.least("u", "v").alias("unit_id_a"), F.greatest("u", "v").alias("unit_id_b")).distinct()


def components(pairs: DataFrame, ws: Workspace) -> DataFrame:
    """``node, component`` (its smallest node) of all nodes of the pairs ``a, b``: large star and small star in turn."""
    edges = ws.write(pairs.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct(), "edges0")
    i = 0
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        # large star: larger neighbours move to the smallest node around
        large = both.where("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = ws.write(large.where("u <> v").distinct(), f"large{i}")
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array("v", "u")).alias("v"), F.col("m").alias("u"))
        nxt = ws.write(small.where("u <> v").distinct(), f"edges{i + 1}")
        # done when every node hangs on one node that hangs on none
        settled = not nxt.groupBy("v").count().where("count > 1").limit(1).count() and not nxt.join(nxt.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        ws.discard(f"edges{i}"), ws.discard(f"large{i}")
        edges, i = nxt, i + 1
        if settled:
            roots = edges.select(F.col("u").alias("node")).distinct()
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def duplicate_groups(units: DataFrame, key: str = "knowledge_unit_id", threshold: float = 0.7) -> DataFrame:
    """``unit_id, class_id, group_id, n_links``, one row per unit and content that takes part.

    ``class_id`` is the smallest unit of equal content, ``group_id`` the smallest unit that similar pairs
    connect it with, ``n_links`` the number of other distinct contents it is similar to.
    """
    ws = Workspace(units.sparkSession, "duplicate_groups")
    classes, members = _classes(units, key, ws)
    similar = similar_classes(classes, ws, threshold)
    where = components(similar, ws)
    links = similar.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    placed = (
        members.join(where.withColumnRenamed("node", "cid"), "cid", "left").join(links.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("component", F.coalesce("component", "cid")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    )
    names = placed.groupBy("component").agg(F.min("class_id").alias("group_id"))
    return placed.join(names, "component").select("unit_id", "class_id", "group_id", "n_links")
