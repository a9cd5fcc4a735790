"""Filling containers of fixed capacity with documents: hierarchical multi-length packing.

Lengths are integers up to the capacity, so the whole corpus is described by one histogram of at most
``capacity`` counts, and a packing is a short list of *patterns* (so many of this length, so many of
that) with multiplicities.  Only the histogram reaches the driver:

1. *Route.*  Pieces belong to context-size tiers by length (up to 256, 512, 1024, 2048 tokens).
2. *Pack each tier*, the longest first, into windows of its own: a window starts with the longest piece left in the
   tier, and the rest of it takes the fullest choice of pieces of the same tier.
3. *Fill the gaps* of these windows with the fullest choice of pieces of shorter tiers, which are then packed in their turn.
   A pattern is repeated as often as its scarcest length allows, so each step uses a length up and the plan stays short
   whatever the corpus holds.
4. *Balance step groups*: containers in order of work (sum of squared lengths) are dealt to step groups in
   serpentine order.

"Fullest" is exact: a bounded subset-sum over all lengths at hand, with long pieces preferred.

Documents get their places by rank within their length; ranks come from counts per partition and
length, so no task sees all documents of one length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loomgraph.llm.tokens import VOCAB_DIR, count_tokens
from loomgraph.workspace import Workspace

TIERS = (256, 512, 1024, 2048)


@dataclass
class Plan:
    """``patterns``: (times, [(length, count)...]); the containers of a pattern are numbered in a row."""

    capacity: int
    patterns: list[tuple[int, list[tuple[int, int]]]] = field(default_factory=list)

    @property
    def containers(self) -> int:
        return sum(t for t, _ in self.patterns)

    def places(self) -> dict[str, np.ndarray]:
        """Ranges of ranks per length, in order of (length, first rank): where they go."""
        order = sorted(self.patterns, key=lambda p: -sum(n * s * s for s, n in p[1]))
        used: dict[int, int] = {}
        rows, first = [], 0
        for times, items in order:
            offset = 0
            for s, n in items:
                rows.append((s, used.get(s, 0), n, first, offset))
                used[s] = used.get(s, 0) + times * n
                offset += s * n
            first += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return dict(zip(("length", "rank", "each", "first", "offset"), table.T))


def _longest_first(room: int, left: np.ndarray, low: int, high: int) -> list[int]:
    """Lengths from ``low + 1`` to ``high``, longest that fits first."""
    out: list[int] = []
    top = min(room, high)
    while room > low:
        fits = np.flatnonzero(left[low + 1 : min(room, top) + 1])
        if not len(fits):
            break
        s = int(fits[-1]) + low + 1
        n = min(int(left[s]), room // s)
        out += [s] * n
        room -= n * s
        top = s - 1
    return out


def _fullest(room: int, left: np.ndarray, low: int, high: int) -> list[int]:
    """The choice of the lengths left, from ``low + 1`` to ``high``, that fills ``room`` best.

    Longest first wherever that leaves no gap.  Else a table of reachable sums, one bit each: ``sums[i]`` are those of the first i
    lengths, longest first, and no more lengths are looked at than fill the room.
    """
    out = _longest_first(room, left, low, high)
    if sum(out) == room or not out:
        return out
    sizes = (np.flatnonzero(left[low + 1 : min(room, high) + 1]) + low + 1)[::-1].tolist()
    mask, sums = (1 << room + 1) - 1, [1]
    for s in sizes:
        bits, n, step = sums[-1], min(int(left[s]), room // s), 1
        while n:  # 1, 2, 4, ... copies and the rest
            step = min(step, n)
            bits |= bits << step * s
            n, step = n - step, step * 2
        sums.append(bits & mask)
        if sums[-1] >> room & 1:
            break
    total = sums[-1].bit_length() - 1
    if total == sum(out):
        return out
    found: list[int] = []
    for i in range(len(sums) - 1, 0, -1):
        s = sizes[i - 1]
        n = next(n for n in range(min(int(left[s]), total // s), -1, -1) if sums[i - 1] >> total - n * s & 1)
        found += [s] * n
        total -= n * s
    return found


def plan_packing(histogram: dict[int, int], capacity: int = 2048, tiers: tuple[int, ...] = TIERS) -> Plan:
    """The patterns for a histogram of lengths from 1 to ``capacity``."""
    left = np.zeros(capacity + 1, np.int64)
    for s, n in histogram.items():
        left[s] = n
    plan = Plan(capacity)
    bounds = [0, *sorted(t for t in set(tiers) if 0 < t < capacity), capacity]
    for low, high in zip(bounds[-2::-1], bounds[:0:-1]):
        while True:
            own = np.flatnonzero(left[low + 1 : high + 1])
            if not len(own):
                break
            s = int(own[-1]) + low + 1
            spare = left.copy()
            spare[s] -= 1
            items = [s, *_fullest(capacity - s, spare, low, high)]
            if low:
                items += _fullest(capacity - sum(items), spare, 0, low)
            lengths, counts = np.unique(items, return_counts=True)
            times = int((left[lengths] // counts).min())
            left[lengths] -= times * counts
            plan.patterns.append((times, [(int(a), int(n)) for a, n in zip(lengths[::-1], counts[::-1])]))
    return plan


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, tiers: tuple[int, ...] = TIERS, group: int = 8,
    tokenizer: str = "byte_bpe_50k", vocab_dir: str = VOCAB_DIR,
) -> DataFrame:
    """``id_col, piece_no, first_token, n_tokens, tier, container_id, position, step_group``.

    Every document lies whole in one container unless it exceeds ``capacity``; such a one fills containers
    of its own and its rest is an item like others.  A document without tokens (null or empty text) needs
    no room: it has n_tokens 0 at position 0 of container 0.  Repeated rows are packed each; a null id is
    kept; an empty table gives no rows.  Containers never overlap nor exceed ``capacity``.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "packing")
    whole = F.floor(F.col("n_tokens") / capacity).cast("bigint")
    cut = F.when(F.col("n_tokens") > capacity, F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n_tokens") / capacity).cast("bigint") - 1)).otherwise(F.array(F.lit(0).cast("bigint")))
    pieces = (
        count_tokens(docs, id_col, text_col, tokenizer, vocab_dir)
        .select(id_col, "n_tokens", whole.alias("full"), F.explode(cut).alias("piece_no"))
        .select(id_col, "piece_no", F.when((F.col("n_tokens") > capacity) & (F.col("piece_no") < F.col("full")), capacity).otherwise(F.col("n_tokens") - F.col("piece_no") * capacity).cast("bigint").alias("size"))
        .withColumn("part", F.spark_partition_id()).withColumn("line", F.monotonically_increasing_id())
    )
    pieces = ws.write(pieces, "pieces")
    counts = ws.write(pieces.groupBy("part", "size").count(), "counts")
    # at most `capacity` rows reach the driver
    histogram = {r["size"]: r["n"] for r in counts.where("size > 0").groupBy("size").agg(F.sum("count").alias("n")).collect()}
    plan = plan_packing(histogram, capacity, tiers)
    places = spark.sparkContext.broadcast(plan.places())
    total = plan.containers
    steps = max(1, -(-total // group))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "size", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    local = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("part", "size").orderBy("line")) - 1)
    ranked = local.join(base, ["part", "size"]).select(id_col, "piece_no", "size", (F.col("rank") + F.col("base")).alias("rank"))
    span = 1 << 44

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        keys = p["length"] * span + p["rank"]
        for batch in batches:
            size, rank = (np.asarray(batch.column(i), dtype=np.int64) for i in (2, 3))
            if not len(keys):
                box = at = np.zeros(len(size), np.int64)
            else:
                i = np.maximum(np.searchsorted(keys, size * span + rank, "right") - 1, 0)
                r = rank - p["rank"][i]
                box = np.where(size > 0, p["first"][i] + r // p["each"][i], 0)
                at = np.where(size > 0, p["offset"][i] + r % p["each"][i] * size, 0)
            turn, place = box // steps, box % steps
            step = np.where(turn % 2 == 0, place, steps - 1 - place)
            tier = np.array([*(t for t in tiers if t < capacity), capacity])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.asarray(batch.column(1)) * capacity), batch.column(2), pa.array(tier[np.searchsorted(tier, size)].astype(np.int32)), pa.array(box), pa.array(at.astype(np.int32)), pa.array(step)],
                [id_col, "piece_no", "first_token", "n_tokens", "tier", "container_id", "position", "step_group"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(assign, f"`{id_col}` {kind}, piece_no bigint, first_token bigint, n_tokens bigint, tier int, container_id bigint, position int, step_group bigint")


def packing_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: pieces, containers, tokens, the fewest containers that could hold them, the share of room left."""
    boxes = packed.where("n_tokens > 0").groupBy("container_id").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    return boxes.agg(
        F.sum("pieces").alias("n_pieces"), F.count(F.lit(1)).alias("n_containers"), F.sum("tokens").alias("n_tokens"),
        F.ceil(F.sum("tokens") / capacity).cast("bigint").alias("fewest_containers"), (1 - F.sum("tokens") / (F.count(F.lit(1)) * capacity)).alias("room_left"),
        F.max("tokens").alias("fullest"),
    )
