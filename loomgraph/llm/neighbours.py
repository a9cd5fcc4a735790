"""The k most similar vectors of every vector: a forest of random-projection trees with exact reranking.

*Index.*  Each node of a tree splits by a projection direction of its own and a threshold; below ``OWN`` levels, the nodes of a level
share one direction, so that what is sent to the executors stays at some hundred directions and one number per node.  Directions
are differences of two sample vectors of the node, thresholds medians of a bounded sample; every row is indexed.
*Search.*  Each vector walks all trees at once with one priority queue: the home leaf of each tree has
priority 0, the other side of a split the largest distance to a split crossed so far, and the nearest
``probes`` leaves of all trees together are visited.  The queue runs for a whole Arrow batch in NumPy.
*Rerank.*  A vector is sent to the leaves it visits; there exact cosines of visitors and residents are
matrix products.  A pair met in either direction counts for both ends.

Vectors travel as 16-bit fixed-point numbers of their own largest element: half the shuffle of floats, and cosines within ``CLOSE`` of
the exact ones.  Where two neighbours are closer to each other than that, their cosines are computed anew from the original numbers, so the
order is exact.  Vectors of one direction (to the precision of floats) are one class with one representative, so copies can't crowd a leaf;
leaves that the sample shows to be crowded nevertheless are split, and their visitors see every part; visitors of leaves that many visit are dealt
to blocks, each of which sees all residents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loomgraph.workspace import Workspace

#: Vectors that directions and thresholds are fitted on: all up to this number, else about so many, chosen by a hash of their row.
FIT_SAMPLE = 20_000
#: Cosines nearer to each other than this are compared on the original numbers; for that, so many places more than asked for are kept.  Which of
#: still more that are as close come so far is left to 16 bits; they differ by less than ``CLOSE``.
CLOSE, SPARE = 2e-5, 3
#: Visitors that a block of a leaf is expected to have, in multiples of the leaf.
VISITORS = 10
LEAF = 2_500
TREES = 3
#: Levels whose nodes have directions of their own.
OWN = 8


def pack(x: np.ndarray) -> np.ndarray:
    """Rows as 16-bit numbers; rows must be finite and not all zero."""
    x = x.astype(np.float64)
    return np.rint(x / np.abs(x).max(axis=1, keepdims=True) * 32767).astype(np.int16)


def unpack(column: pa.Array, dim: int) -> np.ndarray:
    """Unit rows from a column of packed vectors."""
    x = np.frombuffer(b"".join(column.to_pylist()), np.int16).reshape(-1, dim).astype(np.float32)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _own_kind(vectors: DataFrame, embedding: str) -> type:
    """The kind of number that holds the vectors' elements exactly."""
    return np.float32 if vectors.schema[embedding].dataType.elementType.simpleString() == "float" else np.float64


def _valid_packed(vectors: DataFrame, row: str, embedding: str, dim: int, exact: bool = False) -> DataFrame:
    """``row, digest`` of the direction, and ``q``: the vector in 16-bit numbers, or as it is in numbers of its own kind."""
    kind = _own_kind(vectors, embedding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = np.asarray(lists.value_lengths().fill_null(-1))
            keep = np.flatnonzero((size == dim) & np.asarray(batch.column(0).is_valid()))
            rows = batch.column(0).take(pa.array(keep))
            flat = lists.take(pa.array(keep)).flatten()
            x = np.asarray(flat.cast(pa.float64()).fill_null(np.nan)).reshape(-1, dim)
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            x = x[good]
            q = [v.tobytes() for v in pack(x)] if len(x) else []
            one = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
            digest = [hashlib.blake2b(v, digest_size=16).digest() for v in one.astype(np.float32) + np.float32(0)]
            held = [v.tobytes() for v in x.astype(kind)] if exact else q
            yield pa.RecordBatch.from_arrays(
                [rows.filter(pa.array(good)).cast(pa.int64()), pa.array(digest, pa.binary()), pa.array(held, pa.binary())], ["row", "digest", "q"],
            )

    return vectors.select(row, embedding).mapInArrow(run, "row bigint, digest binary, q binary")


def _settled(top: DataFrame, members: DataFrame, vectors: DataFrame, k: int, dim: int, ws: Workspace) -> DataFrame:
    """``vid, other, place``: the first k places; where scores of adjacent places are too close to tell, by cosines of the original numbers."""
    gap = F.col("score") - F.lead("score").over(Window.partitionBy("vid").orderBy("place"))
    close = ws.write(top.withColumn("gap", gap).where((F.col("gap") < CLOSE) & (F.col("place") <= k)).select("vid").distinct(), "close")
    unsure = top.join(close, "vid").select("vid", "other")
    wanted = unsure.select(F.explode(F.array("vid", "other")).alias("vid")).distinct()
    named = wanted.join(members.select("vid", "digest").distinct(), "vid")
    rows = _valid_packed(vectors.join(named.select(F.col("vid").alias("row")), "row", "left_semi"), "row", "embedding", dim, exact=True)
    held = named.join(rows.withColumnRenamed("row", "vid"), ["vid", "digest"]).select("vid", "q").dropDuplicates(["vid"])

    kind = _own_kind(vectors, "embedding")

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), kind).reshape(-1, dim).astype(np.float64) for i in (2, 3))
            x, y = (v / np.abs(v).max(axis=1, keepdims=True) if len(v) else v for v in (x, y))
            dot = lambda a, b: np.einsum("ij,ij->i", a, b)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dot(x, y) / np.sqrt(dot(x, x) * dot(y, y)))], ["vid", "other", "score"])

    pairs = unsure.join(held.withColumnRenamed("q", "x"), "vid").join(held.select(F.col("vid").alias("other"), F.col("q").alias("y")), "other")
    exact = pairs.select("vid", "other", "x", "y").mapInArrow(cosines, "vid bigint, other bigint, score double")
    order = Window.partitionBy("vid").orderBy(F.desc(F.round("score", 12)), "other")
    again = exact.withColumn("place", F.row_number().over(order)).select("vid", "other", "place")
    return top.join(close, "vid", "left_anti").select("vid", "other", "place").unionByName(again).where(F.col("place") <= k)


class Forest:
    """Directions, thresholds and leaf splits; small, and sent to every task."""

    def __init__(self, sample: np.ndarray, n: int, leaf: int = LEAF, trees: int = TREES, probes: int | None = None, seed: int = 11):
        self.depth = max(0, round(math.log2(max(1, n / leaf))))
        self.trees = trees if self.depth else 1
        self.probes = min(probes or max(self.trees + 1, self.depth), self.trees << self.depth) if self.depth else 1
        rng = np.random.default_rng(seed)
        d, t = self.depth, self.trees
        own = min(d, OWN)
        self.shared = (1 << own) - 1  # place of the first shared direction
        n_axes = self.shared + d - own
        self.axes = np.zeros((sample.shape[1], t, n_axes), np.float32)
        self.at = np.zeros((t, 2 << d), np.float32)
        self.parts = np.ones((t, 2 << d), np.int64)
        for i in range(t):
            node = np.ones(len(sample), np.int64)
            for level in range(d):
                which = self._axis(node, level)
                axes, first, size = np.unique(which[np.argsort(which, kind="stable")], return_index=True, return_counts=True)
                members = np.argsort(which, kind="stable")
                for axis, f, m in zip(axes, first, size):
                    a, b = members[f + rng.choice(m, 2, replace=m < 2)]
                    v = sample[a] - sample[b]
                    if not v.any():
                        v = rng.normal(size=sample.shape[1])
                    self.axes[:, i, axis] = v / np.linalg.norm(v)
                seen = np.empty(len(sample), np.float32)
                for axis, f, m in zip(axes, first, size):
                    rows = members[f : f + m]
                    seen[rows] = sample[rows] @ self.axes[:, i, axis]
                order = np.lexsort((seen, node))
                nodes, start, count = np.unique(node[order], return_index=True, return_counts=True)
                x = seen[order]
                self.at[i, nodes] = (x[start + (count - 1) // 2] + x[start + count // 2]) / 2
                node = node * 2 + (seen > self.at[i, node])
            nodes, size = np.unique(node, return_counts=True)
            self.parts[i, nodes] = np.maximum(1, np.ceil(size / len(sample) * n / (2 * leaf)))
        self.blocks = np.ones((t, 2 << d), np.int64)
        for a in range(0, len(sample) if d else 0, 2048):
            tree, node, _ = self.visit(sample[a : a + 2048])
            np.add.at(self.blocks, (tree, node), 1)
        self.blocks = np.maximum(1, np.ceil((self.blocks - 1) / len(sample) * n / (VISITORS * leaf))).astype(np.int64)

    def _axis(self, node: np.ndarray, level: int) -> np.ndarray:
        """Place of the direction by which nodes (numbered from 1, the children of v being 2v and 2v + 1) of a level split."""
        if level < OWN:
            return np.minimum(node - 1, self.shared - 1)
        return np.full(len(node), self.shared + level - OWN)

    def visit(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tree, leaf and priority of the leaves each row visits, nearest first; priority 0 is a home leaf."""
        n, d, t, b = len(x), self.depth, self.trees, self.probes
        if not d:
            zero = np.zeros((n, 1), np.int64)
            return zero, zero + 1, zero.astype(np.float32)
        seen = (x @ self.axes.reshape(len(self.axes), -1)).reshape(n, t, -1)
        room = t + b * d
        far = np.full((n, room), np.inf, np.float32)
        node, tree, level = (np.zeros((n, room), np.int64) for _ in range(3))
        far[:, :t], node[:, :t], tree[:, :t] = 0, 1, np.arange(t)
        rows, used = np.arange(n), t
        out = np.zeros((3, n, b))
        for k in range(b):
            j = far.argmin(axis=1)
            p, v, i, start = far[rows, j].copy(), node[rows, j].copy(), tree[rows, j], level[rows, j]
            far[rows, j] = np.inf
            for lev in range(d):
                on = lev >= start
                gap = seen[rows, i, self._axis(v, lev)] - self.at[i, v]
                right = gap > 0
                far[:, used] = np.where(on, np.maximum(p, np.abs(gap)), np.inf)
                node[:, used], tree[:, used], level[:, used] = v * 2 + ~right, i, lev + 1
                v = np.where(on, v * 2 + right, v)
                used += 1
            out[:, :, k] = i, v, p
        return out[0].astype(np.int64), out[1].astype(np.int64), out[2]


def _best(score: np.ndarray, k: int) -> np.ndarray:
    k = min(k, score.shape[1])
    return np.argpartition(-score, k - 1, axis=1)[:, :k] if k < score.shape[1] else np.broadcast_to(np.arange(k), score.shape)


def _search_leaf(ids: np.ndarray, home: np.ndarray, x: np.ndarray, k: int, among: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``id, other, score`` of the best k residents for each visitor, and the best k of all for each resident; residents meet each other only if ``among``."""
    rid, m = ids[home], x[home]
    vid, v = ids[~home], x[~home]
    best_s = np.full((len(rid), k), -np.inf, np.float32)
    best_i = np.full((len(rid), k), -1, np.int64)

    def improve(at: slice, score: np.ndarray, other: np.ndarray) -> None:
        pick = _best(score, k)
        s = np.concatenate([best_s[at], np.take_along_axis(score, pick, 1)], axis=1)
        o = np.concatenate([best_i[at], other[pick]], axis=1)
        pick = _best(s, k)
        best_s[at], best_i[at] = np.take_along_axis(s, pick, 1), np.take_along_axis(o, pick, 1)

    out = []
    for a in range(0, len(rid) if among else 0, 1024):
        score = m[a : a + 1024] @ m.T
        score[np.arange(len(score)), np.arange(a, a + len(score))] = -np.inf
        improve(slice(a, a + 1024), score, rid)
    for a in range(0, len(vid), 1024):
        if not len(rid):
            break
        score = v[a : a + 1024] @ m.T
        pick = _best(score, k)
        who = np.repeat(vid[a : a + 1024], pick.shape[1])
        out.append((who, rid[pick].ravel(), np.take_along_axis(score, pick, 1).ravel()))
        improve(slice(None), np.ascontiguousarray(score.T), vid[a : a + 1024])
    out.append((np.repeat(rid, k), best_i.ravel(), best_s.ravel()))
    who, other, score = (np.concatenate(c) for c in zip(*out))
    real = np.isfinite(score) & (who != other)
    return who[real], other[real], score[real]


def nearest(manifest: DataFrame, vectors: DataFrame, k: int = 5, dim: int = 512, leaf: int = LEAF, trees: int = TREES, probes: int | None = None) -> DataFrame:
    """``chunk_id, other_id, place``: the k most similar chunks of every chunk, place from 1.

    ``manifest`` has ``row, chunk_id``, ``vectors`` ``row, embedding``.  A chunk takes part, once, if its
    row's vector has exactly ``dim`` finite, non-null numbers that are not all zero.  Null rows and chunk
    ids, entries without a vector and vectors without an entry take no part.  A chunk listed under several
    rows counts with the smallest; of several valid vectors of a row one counts (equal copies are usual).
    Equally similar chunks are taken in order of chunk_id among equal vectors and in order of their vectors' rows else.
    With fewer than k others all come out; empty tables give no rows.
    """
    spark = manifest.sparkSession
    ws = Workspace(spark, "nearest")
    packed = ws.write(_valid_packed(vectors, "row", "embedding", dim), "packed")
    listed = manifest.select(F.col("row").cast("bigint").alias("row"), "chunk_id").where("row is not null and chunk_id is not null")
    one = packed.groupBy("row").agg(F.min("digest").alias("digest"))
    # a chunk once; a class of equal vectors by its smallest row
    members = listed.join(one, "row").groupBy("chunk_id").agg(F.min(F.struct("row", "digest")).alias("x")).select("chunk_id", "x.row", "x.digest")
    classes = members.groupBy("digest").agg(F.min("row").alias("vid"), F.count(F.lit(1)).alias("n"))
    members = ws.write(members.join(classes, "digest").select("chunk_id", "vid", "n", "digest"), "members")
    reps = members.select("vid", "digest").distinct()
    n = reps.count()
    if not n:
        return spark.createDataFrame([], "chunk_id string, other_id string, place int")
    # of the vectors that are indexed; the same ones in every run
    few = reps if n <= FIT_SAMPLE else reps.where(F.pmod(F.xxhash64("vid", F.lit(17)), F.lit(1 << 40)) < int((1 << 40) * FIT_SAMPLE / n))
    few = F.broadcast(few.select(F.col("vid").alias("row"), "digest"))
    sample = packed.join(few, ["row", "digest"]).select("row", "q").dropDuplicates(["row"]).toArrow().sort_by("row").column("q").combine_chunks()
    forest = Forest(unpack(sample, dim), n, leaf, trees, probes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                ids = np.asarray(batch.column(0))
                tree, node, far = forest.visit(unpack(batch.column(1), dim))
                at = np.repeat(np.arange(len(ids)), tree.shape[1])
                tree, node, home = tree.ravel(), node.ravel(), far.ravel() <= 0
                parts = forest.parts[tree, node]
                own = ids[at] % parts
                # a resident lies in one part of its leaf and visits the others
                again = np.repeat(np.arange(len(at)), parts)
                part = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                at, home = at[again], home[again] & (own[again] == part)
                leaf_part = (tree[again] << 40 | node[again]) * 4096 + part
                # residents are in every block of visitors, a visitor in one
                blocks = forest.blocks[tree[again], node[again]]
                times = np.where(home, blocks, 1)
                which = np.repeat(np.arange(len(at)), times)
                turn = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                turn = np.where(home[which], turn, (ids[at] // 7 % blocks)[which])
                at, home = at[which], home[which]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf_part[which]), pa.array(turn), pa.array(ids[at]), pa.array(home), batch.column(1).take(pa.array(at))], ["leaf_part", "turn", "vid", "home", "q"],
                )

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids = rows.column("vid").to_numpy()
        _, first = np.unique(ids, return_index=True)  # repeated rows of the matrix meet here
        home = rows.column("home").to_numpy()
        x = unpack(rows.column("q").take(pa.array(first)).combine_chunks(), dim)
        who, other, score = _search_leaf(ids[first], home[first], x, k + SPARE, key[1].as_py() == 0)
        return pa.table({"vid": pa.array(who, pa.int64()), "other": pa.array(other, pa.int64()), "score": pa.array(score, pa.float32())})

    # hash join that builds on the small ids: no sort of vectors
    chosen = packed.join(reps.select("vid", F.col("digest").alias("d")).hint("shuffle_hash"), F.col("row") == F.col("vid")).where("digest = d").select("vid", "q")
    routed = chosen.mapInArrow(route, "leaf_part bigint, turn bigint, vid bigint, home boolean, q binary")
    met = routed.groupBy("leaf_part", "turn").applyInArrow(search, "vid bigint, other bigint, score float")
    met = met.repartition("vid").groupBy("vid", "other").agg(F.max("score").alias("score"))
    order = Window.partitionBy("vid").orderBy(F.desc("score"), "other")
    top = ws.write(met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + SPARE).select("vid", "other", "place", "score"), "top")
    ws.discard("packed")  # the exact cosines read the vectors themselves
    settled = ws.write(_settled(top, members, vectors, k, dim, ws), "settled")
    ws.keep("settled", "members")
    return _expand(settled, members, k)


def _expand(top: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """From classes of equal vectors to chunks: a chunk's copies first, then members of the near classes."""
    rank = F.row_number().over(Window.partitionBy("vid").orderBy("chunk_id"))
    # k + 1 members of a class are enough for anyone; grouped twice so that no task sorts a large class
    salted = members.withColumn("s", F.pmod(F.xxhash64("chunk_id"), F.lit(64)))
    few = salted.withColumn("r", F.row_number().over(Window.partitionBy("vid", "s").orderBy("chunk_id"))).where(F.col("r") <= k + 1)
    few = few.withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("vid").agg(F.array_sort(F.collect_list("chunk_id")).alias("ids"))
    near = top.join(few.select(F.col("vid").alias("other"), "ids"), "other").groupBy("vid").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "ids"))), lambda x: x.ids).alias("lists")
    )
    lists = few.join(near, "vid", "left").select("vid", F.concat("ids", F.coalesce(F.flatten("lists"), F.array().cast("array<string>"))).alias("ids"))
    picked = members.join(lists, "vid").select("chunk_id", F.slice(F.filter("ids", lambda x: x != F.col("chunk_id")), 1, k).alias("ids"))
    return picked.select("chunk_id", F.posexplode("ids").alias("place", "other_id")).select("chunk_id", "other_id", (F.col("place") + 1).alias("place"))


def neighbour_pairs(near: DataFrame) -> DataFrame:
    """``chunk_id_a, chunk_id_b``: each pair of which one is among the nearest of the other, once, smaller key first."""
    return near.select(F.least("chunk_id", "other_id").alias("chunk_id_a"), F.greatest("chunk_id", "other_id").alias("chunk_id_b")).distinct()
