"""Parent-child links to full hierarchies, with cycles reported.

1. *Peeling.*  Leaves are peeled in doubling strides: with ``q`` the 2^i-th parent, a node stays only if
   it is the q-image of a remaining node and has a q-image itself, so stride i removes every node whose
   height or depth is below 2^i.  What can't be peeled is exactly the nodes on cycles.
2. *Euler tour.*  Cycle links are cut; each remaining link gives a downward and an upward arc, chained
   over children and siblings.  Siblings are chained inside salted groups first, so no task holds all
   children of one parent.  The last arc of a tour holds the name of its root.
3. *List ranking*, with work in proportion to the arcs: in each round the arcs that a coin selects, no two of them
   adjacent, are spliced out, about a quarter of those left; when at most ``REMAINDER`` still lead to another, one task ranks them by pointer
   doubling; then the rounds are undone in reverse, and each arc gets its rank from the arc after it.  With weights +1/-1 the same
   rounds give the depth, and they carry the root, so that nodes never meet on it.  Ranks give each node an entry-exit interval, and
   intervals give descendants, ancestors and paths.

Nothing is gathered in the driver but counts, hot keys and one row per range partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loomgraph.operators.skew import HOT_ROWS, attach, hot_keys
from loomgraph.workspace import Workspace

#: Arcs that one task ranks, with the last arcs they lead to; some 50 bytes each and the names of their roots.
REMAINDER = 250_000
SPACE = r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+$"


def links_of(edges: DataFrame, relation: str = "contains") -> DataFrame:
    """``child, parent`` of the edges with that relation (trimmed, lower case), each child once.

    Rows with a null end are no links.  A child that several parents claim keeps the smallest of them
    by code point, so that the result is a function of the set of rows.
    """
    return (
        edges.where(F.lower(F.regexp_replace("relation", SPACE, "")) == relation)
        .select(F.col("target_node_id").alias("child"), F.col("source_node_id").alias("parent"))
        .where("child is not null and parent is not null")
        .groupBy("child").agg(F.min("parent").alias("parent"))
    )


def rejected_links(edges: DataFrame, relation: str = "contains") -> DataFrame:
    """``child, parent, kept_parent``: the links that :func:`links_of` leaves out because the child has a smaller parent."""
    every = (
        edges.where(F.lower(F.regexp_replace("relation", SPACE, "")) == relation)
        .select(F.col("target_node_id").alias("child"), F.col("source_node_id").alias("parent"))
        .where("child is not null and parent is not null")
    )
    # distinct before the window: a child's rows are then as many as it has parents
    kept = F.min("parent").over(Window.partitionBy("child"))
    return every.distinct().withColumn("kept_parent", kept).where("parent <> kept_parent")


def peel(links: DataFrame, ws: Workspace, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The nodes on cycles, as ``child, parent``."""
    cur = ws.write(links.select("child", F.col("parent").alias("q")), "peel0")
    (n, hot), i = hot_keys(cur, "q", hot_rows), 0
    while n:
        image = cur.select(F.col("q").alias("child")).distinct()
        step = cur.select(F.col("child").alias("q"), F.col("q").alias("q2"))
        kept = cur.join(image, "child", "left_semi")
        nxt = ws.write(attach(kept, step, "q", hot).select("child", F.col("q2").alias("q")), f"peel{i + 1}")
        left, hot = hot_keys(nxt, "q", hot_rows)
        ws.discard(f"peel{i}")
        cur, i = nxt, i + 1
        if left == n:
            break
        n = left
    return links.join(cur.select("child"), "child", "left_semi")


def cycle_ids(cycle: DataFrame, ws: Workspace) -> DataFrame:
    """``node, cycle_id`` for nodes on cycles; the id is the smallest node of the cycle."""
    cur = ws.write(cycle.select("child", F.col("parent").alias("q"), F.least("child", "parent").alias("low")), "cycle0")
    i = 0
    while True:
        ahead = cur.select(F.col("child").alias("q"), F.col("q").alias("q2"), F.col("low").alias("low2"))
        nxt = cur.join(ahead, "q").select("child", F.col("q2").alias("q"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("moved"))
        nxt = ws.write(nxt, f"cycle{i + 1}")
        moved = nxt.where("moved").limit(1).count()
        ws.discard(f"cycle{i}")
        cur, i = nxt.drop("moved"), i + 1
        if not moved:
            return cur.select(F.col("child").alias("node"), F.col("low").alias("cycle_id"))


def _tour(forest: DataFrame, circles: DataFrame, salts: int) -> DataFrame:
    """``arc, nxt, root, cycle_id``: arc 2*cid goes down to the child, 2*cid+1 up from it; nxt is null at a tour's end, and root only there not."""
    kids = forest.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(salts)).cast("int"))
    chained = kids.withColumn("sib", F.lead("cid").over(Window.partitionBy("parent", "salt").orderBy("cid")))
    groups = kids.groupBy("parent", "salt").agg(F.min("cid").alias("first"))
    # at most `salts` rows per parent from here on
    groups = groups.withColumn("next_first", F.lead("first").over(Window.partitionBy("parent").orderBy("salt")))
    first = groups.groupBy("parent").agg(F.min_by("first", "salt").alias("kid"))
    cols = ["child", "parent", "cid", "sib"]
    # one row per group, then one per parent: no join meets all children of one
    ends = chained.where("sib is null").drop("sib").join(groups.select("parent", "salt", F.col("next_first").alias("sib")), ["parent", "salt"])
    ids = forest.select(F.col("child").alias("parent"), F.col("cid").alias("pid"))
    last = ends.where("sib is null").join(ids, "parent", "left").join(circles.select(F.col("node").alias("parent"), "cycle_id"), "parent", "left")
    none, no_name = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    inner = chained.where("sib is not null").select(*cols).unionByName(ends.where("sib is not null").select(*cols))
    inner = inner.withColumns({"pid": none, "root": no_name, "cycle_id": no_name})
    top = F.when(F.col("pid").isNull(), F.col("parent"))
    whole = inner.unionByName(last.select(*cols, "pid", top.alias("root"), F.when(F.col("pid").isNull(), F.col("cycle_id")).alias("cycle_id")))
    whole = whole.join(first.select(F.col("parent").alias("child"), "kid"), "child", "left")
    down = F.struct((F.col("cid") * 2).alias("arc"), F.coalesce(F.col("kid") * 2, F.col("cid") * 2 + 1).alias("nxt"), no_name.alias("root"), no_name.alias("cycle_id"))
    up = F.struct((F.col("cid") * 2 + 1).alias("arc"), F.coalesce(F.col("sib") * 2, F.col("pid") * 2 + 1).alias("nxt"), "root", "cycle_id")
    return whole.select(F.inline(F.array(down, up)))


_RANK = "arc bigint, cnt bigint, sum bigint, root string, cycle_id string"


def _rank_in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = list(batches)
    if not sum(b.num_rows for b in whole):
        return
    t = pa.Table.from_batches(whole).combine_chunks().sort_by("arc")
    arc = t.column("arc").to_numpy()
    cnt, total = (t.column(c).to_numpy().copy() for c in ("cnt", "sum"))
    n = len(arc)
    end = np.asarray(t.column("nxt").is_null())
    at = np.where(end, np.arange(n), np.searchsorted(arc, t.column("nxt").fill_null(0).to_numpy()))
    # a last arc points to itself and adds nothing
    step_cnt, step_sum = np.where(end, 0, cnt), np.where(end, 0, total)
    own_cnt, own_sum = cnt, total
    while True:
        nxt = at[at]
        moved = nxt != at
        step_cnt, step_sum = step_cnt + np.where(moved, step_cnt[at], 0), step_sum + np.where(moved, step_sum[at], 0)
        if not moved.any():
            break
        at = nxt
    names = [t.column(c).take(pa.array(at)) for c in ("root", "cycle_id")]
    out = pa.table([t.column("arc"), pa.array(step_cnt + own_cnt[at]), pa.array(step_sum + own_sum[at]), *names], names=["arc", "cnt", "sum", "root", "cycle_id"])
    yield from out.combine_chunks().to_batches()


def rank_lists(arcs: DataFrame, ws: Workspace, remainder: int = REMAINDER) -> DataFrame:
    """``arc, cnt, sum, root, cycle_id``: the arcs from here to the end of the list, the sum of their weights (1 down, -1 up), and the names its last arc holds."""
    weight = F.when(F.col("arc") % 2 == 0, 1).otherwise(-1).cast("bigint")
    cur = ws.write(arcs.select("arc", "nxt", F.lit(1).cast("bigint").alias("cnt"), weight.alias("sum"), "root", "cycle_id"), "list")
    live = lambda df: df.where("nxt is not null")
    gone: list[DataFrame] = []
    while live(cur).count() > remainder:
        i = len(gone)
        coin = lambda c, i=i: F.pmod(F.xxhash64(c, F.lit(i)), F.lit(2)) == 1
        # an arc goes if its coin is 1 and that of the arc before it is 0: the arc after it then stays
        before = cur.where(F.col("nxt").isNotNull() & ~coin("arc") & coin("nxt")).select(F.col("nxt").alias("arc"), F.col("arc").alias("by"), F.col("cnt").alias("by_cnt"), F.col("sum").alias("by_sum"))
        skips = F.col("nxt").isNotNull() & ~coin("arc") & coin("nxt")
        step = ws.write(cur.withColumn("skips", F.coalesce(skips, F.lit(False))).join(before, "arc", "left"), f"splice{i}")
        spliced = step.where("by is not null")
        gone.append(spliced.select("arc", "nxt", "cnt", "sum", "root", "cycle_id"))
        longer = spliced.select(F.col("by").alias("arc"), "nxt", (F.col("cnt") + F.col("by_cnt")).alias("cnt"), (F.col("sum") + F.col("by_sum")).alias("sum"), "root", "cycle_id")
        cur = longer.unionByName(step.where("by is null and not skips").select("arc", "nxt", "cnt", "sum", "root", "cycle_id"))
    # a last arc that none leads to any more is a list of its own; there may be any number of those
    last, led = cur.where("nxt is null"), live(cur).select(F.col("nxt").alias("arc"))
    rest = live(cur).unionByName(last.join(led, "arc", "left_semi"))
    known = rest.repartition(1).mapInArrow(_rank_in_one_task, _RANK).unionByName(last.join(led, "arc", "left_anti").select("arc", "cnt", "sum", "root", "cycle_id"))
    known = ws.write(known, "rest")
    for i in range(len(gone) - 1, -1, -1):
        ahead = known.select(F.col("arc").alias("nxt"), F.col("cnt").alias("c2"), F.col("sum").alias("s2"), F.col("root").alias("r2"), F.col("cycle_id").alias("y2"))
        last = gone[i].where("nxt is null").select("arc", "cnt", "sum", "root", "cycle_id")
        undone = gone[i].where("nxt is not null").join(ahead, "nxt").select("arc", (F.col("cnt") + F.col("c2")).alias("cnt"), (F.col("sum") + F.col("s2")).alias("sum"), F.col("r2").alias("root"), F.col("y2").alias("cycle_id"))
        known = known.unionByName(ws.write(undone.unionByName(last), f"undone{i}"))
    return known


def build_hierarchy(links: DataFrame, salts: int = 64, remainder: int = REMAINDER, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per child: ``node_id, parent_id, root_node_id, depth, tour, entry, exit, descendants``.

    ``links`` has ``child`` (unique) and ``parent``.  A node on a cycle has depth -1, a node below one
    depth -2, both with the smallest node of the cycle as root.  ``entry < x.entry <= exit`` within the
    same ``tour`` holds exactly for the descendants x; cycle nodes have null ``tour``, interval and
    descendants.  No links give no rows.  Any string is a node, the empty one too.
    """
    ws = Workspace(links.sparkSession, "hierarchy")
    links = ws.write(links.select("child", "parent"), "links")
    cycle = ws.write(peel(links, ws, hot_rows), "cycles")
    circles = ws.write(cycle_ids(cycle, ws), "cycle_ids")
    cut = links.join(cycle.select("child"), "child", "left_anti")
    forest = ws.write(cut.withColumn("cid", F.monotonically_increasing_id()), "forest")
    salts = max(salts, forest.count() // 100_000)
    ranked = rank_lists(_tour(forest, circles, salts), ws, remainder)
    # both arcs of a node meet in one row
    side = lambda c, up: F.max(F.when(F.col("arc") % 2 == up, F.col(c)))
    sides = ranked.withColumn("cid", F.shiftright("arc", 1)).groupBy("cid").agg(
        F.max("root").alias("root"), F.max("cycle_id").alias("cycle_id"), side("cnt", 0).alias("c_in"), side("cnt", 1).alias("c_out"), side("sum", 0).alias("s_in"),
    )
    nodes = forest.join(sides, "cid").select(
        F.col("child").alias("node_id"), F.col("parent").alias("parent_id"), F.coalesce("cycle_id", "root").alias("root_node_id"),
        F.when(F.col("cycle_id").isNull(), F.lit(1) - F.col("s_in")).otherwise(-2).cast("int").alias("depth"),
        F.col("root").alias("tour"), (-F.col("c_in")).alias("entry"), (-F.col("c_out")).alias("exit"),
        ((F.col("c_in") - F.col("c_out") - 1) / 2).cast("bigint").alias("descendants"),
    )
    none = F.lit(None)
    on_cycle = cycle.join(circles, cycle.child == circles.node).select(
        F.col("child").alias("node_id"), F.col("parent").alias("parent_id"), F.col("cycle_id").alias("root_node_id"), F.lit(-1).alias("depth"),
        none.cast("string").alias("tour"), none.cast("bigint").alias("entry"), none.cast("bigint").alias("exit"), none.cast("bigint").alias("descendants"),
    )
    whole = ws.write(nodes.unionByName(on_cycle), "hierarchy")
    ws.keep("hierarchy")
    return whole


def paths(hierarchy: DataFrame) -> DataFrame:
    """``node_id, root_node_id, depth, path``: the nodes from the root down to the node, both included.

    One pass over the tours in entry order.  A tour may span many range partitions, so each partition
    starts from the intervals that are open at its first row.  Only intervals that reach beyond their own partition can be, at most
    as many in each as the tree is deep there; those alone are joined with the first rows of the partitions.  A node below a cycle has the path from the
    cycle's node above it; a node on a cycle has only itself.
    """
    ws = Workspace(hierarchy.sparkSession, "paths")
    inner = hierarchy.where("tour is not null").select("node_id", "root_node_id", "depth", "tour", "entry", "exit")
    placed = ws.write(inner.repartitionByRange("tour", "entry").withColumn("part", F.spark_partition_id()), "placed")
    bounds = placed.groupBy("part").agg(F.min(F.struct("tour", "entry")).alias("first"), F.max(F.struct("tour", "entry")).alias("last"))
    bounds = ws.write(bounds.select("part", "first.tour", F.col("first.entry").alias("at"), F.col("last.tour").alias("last_tour"), F.col("last.entry").alias("last_entry")), "bounds")
    last = bounds.select("part", F.col("last_tour").alias("tour"), "last_entry")
    reaching = placed.join(F.broadcast(last), ["part", "tour"]).where("exit > last_entry").select("tour", "entry", "exit", "node_id")
    opened = reaching.join(F.broadcast(bounds.select("part", "tour", "at")), "tour").where("entry < at and at <= exit")
    opened = ws.write(opened.select("part", "entry", "exit", "node_id"), "open")

    def walk(rows, above):
        import pandas as pd

        above = above.sort_values("entry")
        stack = list(zip(above["exit"], above["node_id"]))
        tour, out = None, []
        for r in rows.sort_values(["tour", "entry"]).itertuples(index=False):
            if tour is not None and r.tour != tour:
                stack = []
            tour = r.tour
            while stack and stack[-1][0] < r.entry:
                stack.pop()
            stack.append((r.exit, r.node_id))
            out.append((r.node_id, r.root_node_id, r.depth, [tour, *(x[1] for x in stack)]))
        return pd.DataFrame(out, columns=["node_id", "root_node_id", "depth", "path"])

    walked = placed.groupBy("part").cogroup(opened.groupBy("part")).applyInPandas(
        walk, "node_id string, root_node_id string, depth int, path array<string>",
    )
    alone = hierarchy.where("tour is null").select("node_id", "root_node_id", "depth", F.array("node_id").alias("path"))
    return walked.unionByName(alone)


def descendants(path_rows: DataFrame) -> DataFrame:
    """``ancestor_id, node_id, distance`` for every node and each of its ancestors."""
    return (
        path_rows.select("node_id", F.size("path").alias("n"), F.posexplode("path").alias("pos", "ancestor_id"))
        .where("pos < n - 1").select("ancestor_id", "node_id", (F.col("n") - 1 - F.col("pos")).alias("distance"))
    )


def descendant_counts(hierarchy: DataFrame) -> DataFrame:
    """``node_id, descendants`` of every node, roots included; a node on a cycle has what hangs from it below the cycle."""
    inner = hierarchy.where("tour is not null")
    # a tour is named after its root or its node on a cycle; the latter may have none
    tops = inner.select(F.col("tour").alias("node_id"), F.lit(1).alias("n")).unionByName(hierarchy.where("tour is null").select("node_id", F.lit(0).alias("n")))
    return inner.select("node_id", "descendants").unionByName(tops.groupBy("node_id").agg(F.sum("n").alias("descendants")))
