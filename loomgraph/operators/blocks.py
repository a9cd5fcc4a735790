"""Blocks of queries against one written table of rows, which every task reads tile by tile.

A task answers its own queries over all rows, or over a contiguous part of the rows' files where there are fewer queries than tasks.  So what
leaves it is its answer: nothing per query and partition of the rows is shuffled.  The rows are sorted by unit, then document, hence a
row's place is its order among ties, names are met only in what comes out, and the rows of a unit lie together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loomgraph.workspace import Workspace

#: Rows of a tile, at most, and values in its lists.
ROWS, VALUES = 16_384, 4_000_000
#: Units times queries whose scores a task holds at once for full rankings; where nothing but the score is held, ``BARE`` times as many.
HELD, BARE = 16_000_000, 2
#: Ranks of a batch that leaves a task, about, where they travel in lists.
LISTED = 131_072
#: Queries for which it pays that a task reads the rows.
WORTH = 128


class Scorer(Protocol):
    """Scores of the queries of a task; what it holds is sent to every task."""

    def queries(self, rows: pa.Table) -> Any:
        """What the other two need of the queries of a task; ``names`` has each of them once."""

    def prepare(self, rows: pa.Table) -> tuple[Any, pa.Table]:
        """A tile of rows ready for scoring, and those rows of it that take part."""

    def score(self, tile: Any, queries: Any, a: int, b: int) -> np.ndarray:
        """A row of scores for each of the queries from ``a`` to ``b``."""


@dataclass
class Tile:
    state: Any
    doc: pa.Array
    unit: pa.Array
    #: First row of each unit, units are numbered from ``base``; the first may be the last of the tile before.
    edge: np.ndarray
    base: int
    row: int

    def units(self) -> np.ndarray:
        return self.base + np.repeat(np.arange(len(self.edge)), np.diff(np.append(self.edge, len(self.doc))))


class Rows:
    """The written table: ``doc, unit`` and what a scorer needs."""

    def __init__(self, df: DataFrame, ws: Workspace, name: str = "rows"):
        parts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by = [F.col("unit").asc_nulls_first(), F.col("doc").asc_nulls_first()]
        self.table = ws.write(df.repartitionByRange(parts, *by).sortWithinPartitions(*by), name)
        self.files = sorted(self.table.inputFiles(), key=lambda p: p.rsplit("/", 1)[1])

    def parts(self, n: int) -> list[list[str]]:
        """The files in at most n groups of neighbours."""
        n = max(1, min(n, len(self.files)))
        return [self.files[i * len(self.files) // n : (i + 1) * len(self.files) // n] for i in range(n)]


def _tables(files: list[str], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    n = values = 0
    for uri in files:
        system, path = fs.FileSystem.from_uri(uri)
        with system.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=min(rows, 2048)):
                more = sum(len(c.flatten()) for c in batch.columns if pa.types.is_list(c.type))
                if held and (n + batch.num_rows > rows or values + more > VALUES):
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, n, values = [], 0, 0
                held.append(batch)
                n, values = n + batch.num_rows, values + more
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _tiles(files: list[str], scorer: Scorer, rows: int) -> Iterator[Tile]:
    row, base, last = 0, -1, None
    for table in _tables(files, rows):
        state, table = scorer.prepare(table)
        if not table.num_rows:
            continue
        doc, unit = (table.column(c).combine_chunks() for c in ("doc", "unit"))
        code = np.asarray(unit.dictionary_encode("encode").indices)
        edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        if base < 0 or unit[0].as_py() != last:
            base += 1
        yield Tile(state, doc, unit, edge, base, row)
        row, base, last = row + len(doc), base + len(edge) - 1, unit[-1].as_py()


class _Best:
    """The best k units of each query so far; tiles come in the order of their rows."""

    def __init__(self, n: int, k: int, digits: int, positive: bool):
        self.n, self.k, self.digits, self.positive = n, k, digits, positive
        self.query, self.row, self.unit, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.names = np.empty((0, 2), object)
        self.bar, self.full = np.full(n, 0.0 if positive else -np.inf), np.zeros(n, bool)

    def add(self, score: np.ndarray, tile: Tile) -> None:
        low = self.bar
        if not self.full.all() and len(tile.edge) > self.k:
            # the k-th best unit of this tile alone is a bar too
            top = score if len(tile.edge) == score.shape[1] else np.maximum.reduceat(np.ascontiguousarray(score.T), tile.edge, axis=0).T
            low = np.maximum(low, np.partition(top, top.shape[1] - self.k, axis=1)[:, top.shape[1] - self.k] - 2 * 10.0**-self.digits)
        # later rows of equal score come after those that are held
        q, at = np.nonzero(score > low[:, None])
        if not len(q):
            return
        units = tile.units()[at]
        query, row = np.concatenate([self.query, q]), np.concatenate([self.row, tile.row + at])
        unit, raw = np.concatenate([self.unit, units]), np.concatenate([self.score, score[q, at]])
        names = np.concatenate([np.arange(len(self.query)), -1 - at])
        s = np.round(raw, self.digits)
        order = np.lexsort((row, -s, query))
        span = int(unit.max()) + 1
        first = np.unique(query[order] * span + unit[order], return_index=True)[1]
        order = order[np.sort(first)]
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[place < self.k]
        place = place[place < self.k]
        names, held = names[order], np.empty((len(order), 2), object)
        old = names >= 0
        held[old] = self.names[names[old]]
        take = pa.array(-1 - names[~old])
        for i, column in enumerate((tile.doc, tile.unit)):
            fresh = np.empty(len(take), object)
            fresh[:] = column.take(take).to_pylist()
            held[~old, i] = fresh
        self.query, self.row, self.unit, self.score, self.names = query[order], row[order], unit[order], raw[order], held
        last = place == self.k - 1
        self.full[self.query[last]] = True
        self.bar[self.query[last]] = s[order][last]


def _top(scorer: Scorer, files: list[str], queries: Any, kinds: tuple[pa.DataType, pa.DataType], k: int, digits: int, positive: bool, rows: int, width: int) -> Iterator[pa.RecordBatch]:
    n = len(queries.names)
    cuts = [(a, min(n, a + width)) for a in range(0, n, width)]
    best = [_Best(b - a, k, digits, positive) for a, b in cuts]
    for tile in _tiles(files, scorer, rows):
        for (a, b), own in zip(cuts, best):
            own.add(scorer.score(tile.state, queries, a, b), tile)
    for (a, _), own in zip(cuts, best):
        names = [pa.array(own.names[:, i].tolist(), t) for i, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([queries.names.take(pa.array(own.query + a)), *names, pa.array(own.score)], ["query", "doc", "unit", "score"])


def _totals(scorer: Scorer, files: list[str], queries: Any, rows: int, width: int) -> Iterator[pa.RecordBatch]:
    n = len(queries.names)
    count, total, best = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for tile in _tiles(files, scorer, rows):
        for a in range(0, n, width):
            b = min(n, a + width)
            s = scorer.score(tile.state, queries, a, b)
            count[a:b] += np.count_nonzero(s > 0, axis=1)
            total[a:b] += s.sum(axis=1)
            best[a:b] = np.maximum(best[a:b], s.max(axis=1))
    got = pa.array(count > 0)
    yield pa.RecordBatch.from_arrays([x.filter(got) for x in (queries.names, pa.array(count), pa.array(total), pa.array(best))], ["query", "n", "total", "best"])


@dataclass
class _Whole:
    """Of some queries, each unit's best score and the row that has it."""

    score: np.ndarray
    row: np.ndarray
    doc: pa.Array
    unit: pa.Array


def _whole(scorer: Scorer, files: list[str], n_units: int, queries: Any, a: int, b: int, digits: int, rows: int, width: int) -> _Whole:
    score, at = np.full((b - a, n_units), -np.inf), np.zeros((b - a, n_units), np.int32)
    docs, units, done = [], [], 0
    for tile in _tiles(files, scorer, rows):
        edge, n = tile.edge, len(tile.doc)
        again = tile.base < done  # goes on with the last unit of the tile before
        of = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, n)))
        one = np.diff(np.append(edge, n)) == 1
        many = np.flatnonzero(~one[of])
        starts = np.flatnonzero(np.concatenate([[True], of[many][1:] != of[many][:-1]])) if len(many) else many
        for i in range(a, b, width):
            j = min(b, i + width)
            top = scorer.score(tile.state, queries, i, j)
            row = np.broadcast_to(np.arange(n, dtype=np.int32), top.shape)
            if len(many):
                # a unit of one row has it; of another it is the first row of the best rounded score
                raw = np.ascontiguousarray(top.T)
                near = np.round(raw[many], digits)
                best = np.repeat(np.maximum.reduceat(near, starts, axis=0), np.diff(np.append(starts, len(many))), axis=0)
                row = np.repeat(edge.astype(np.int32)[:, None], j - i, axis=1)
                row[~one] = np.minimum.reduceat(np.where(near == best, many[:, None].astype(np.int32), np.int32(n)), starts, axis=0)
                top, row = np.take_along_axis(raw, row, axis=0).T, row.T
            own, first = slice(i - a, j - a), int(again)
            if again:
                more = np.flatnonzero(np.round(top[:, 0], digits) > np.round(score[own, tile.base], digits))
                score[i - a + more, tile.base], at[i - a + more, tile.base] = top[more, 0], row[more, 0] + tile.row
            to = slice(tile.base + first, tile.base + len(edge))
            score[own, to], at[own, to] = top[:, first:], row[:, first:] + tile.row
        docs.append(tile.doc)
        units.append(tile.unit.take(pa.array(edge[int(again):])))
        done = tile.base + len(edge)
    none = pa.nulls(0)
    return _Whole(score[:, :done], at[:, :done], pa.concat_arrays(docs) if docs else none, pa.concat_arrays(units) if units else none)


def _ranking(scorer: Scorer, files: list[str], queries: Any, digits: int, positive: bool, n_units: int, rows: int, width: int, step: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(queries.names), step):
        b = min(len(queries.names), a + step)
        whole = _whole(scorer, files, n_units, queries, a, b, digits, rows, width)
        for i in range(b - a):
            s = whole.score[i]
            real = np.flatnonzero(s > 0 if positive else np.isfinite(s))
            real = real[np.argsort(-np.round(s[real], digits), kind="stable")]
            names = queries.names.slice(a + i, 1).take(pa.array(np.zeros(len(real), np.int64)))
            yield pa.RecordBatch.from_arrays([names, whole.doc.take(pa.array(whole.row[i][real])), whole.unit.take(pa.array(real)), pa.array(s[real]), pa.array(np.arange(1, len(real) + 1, dtype=np.int32))], ["query", "doc", "unit", "score", "rank"])


def _order(s: np.ndarray, digits: int) -> np.ndarray:
    """Places in ``s``, the highest rounded score first, of equal ones the first."""
    near, bits = np.rint(s * 10.0**digits), len(s).bit_length()
    top = near.max(initial=0)
    # whole numbers and places as one number each are sorted several times as fast
    if np.abs(near).max(initial=0) < 2.0**52 and top - near.min(initial=0) < 2.0 ** (62 - bits):
        key = ((top - near).astype(np.int64) << bits) | np.arange(len(s))
        key.sort()
        return key & ((1 << bits) - 1)
    return np.argsort(-np.round(s, digits), kind="stable")


def _unit_ranks(scorer: Scorer, files: list[str], queries: Any, digits: int, positive: bool, n_units: int, rows: int, width: int, step: int) -> Iterator[pa.RecordBatch]:
    """A row per unit and block of queries: the queries that rank the unit, and its ranks.  It doesn't matter which row has the unit's best score."""
    for a in range(0, len(queries.names), step):
        b = min(len(queries.names), a + step)
        score, units, done = np.full((b - a, n_units), -np.inf), [], 0
        for tile in _tiles(files, scorer, rows):
            edge, again = tile.edge, int(tile.base < done)
            for i in range(a, b, width):
                j = min(b, i + width)
                top = scorer.score(tile.state, queries, i, j)
                if len(edge) < top.shape[1]:
                    top = np.maximum.reduceat(np.ascontiguousarray(top.T), edge, axis=0).T
                own = score[i - a : j - a, tile.base : tile.base + len(edge)]
                np.maximum(own, top, out=own)
            units.append(tile.unit.take(pa.array(edge[again:])))
            done = tile.base + len(edge)
        if not done:
            return
        rank = score.view(np.int32)[:, :done]  # ranks take the place of the query's scores
        for i in range(b - a):
            s = score[i, :done]
            real = np.flatnonzero(s > 0 if positive else np.isfinite(s))
            real = real[_order(s[real], digits)]
            rank[i] = 0
            rank[i, real] = np.arange(1, len(real) + 1, dtype=np.int32)
        names, every, some = queries.names.slice(a, b - a), pa.concat_arrays(units), max(1, LISTED // (b - a))
        for x in range(0, done, some):
            own = np.ascontiguousarray(rank[:, x : x + some].T)
            got = own > 0
            size = np.count_nonzero(got, axis=1)
            offsets = pa.array(np.concatenate([[0], np.cumsum(size[size > 0])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, v) for v in (names.take(pa.array(np.nonzero(got)[1])), pa.array(own[got]))]
            yield pa.RecordBatch.from_arrays([every.slice(x, some).filter(pa.array(size > 0)), *lists], ["unit", "queries", "ranks"])


def _wanted(scorer: Scorer, files: list[str], queries: Any, digits: int, rows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each wanted pair its unit's number and best score, and the document that has it; -1 where no row has the unit."""
    ends, n = queries.ends - queries.ends[0], len(queries.names)
    held = queries.wanted.dictionary_encode("encode")
    code = np.asarray(held.indices)
    at, score, doc = np.full(len(code), -1), np.full(len(code), -np.inf), np.empty(len(code), object)
    for tile in _tiles(files, scorer, rows):
        last = np.append(tile.edge[1:], len(tile.doc))
        local = np.asarray(pc.index_in(held.dictionary, value_set=tile.unit.take(pa.array(tile.edge))).fill_null(-1)).astype(np.int64)[code]
        for a in range(0, n, width):
            b = min(n, a + width)
            own = ends[a] + np.flatnonzero(local[ends[a] : ends[b]] >= 0)
            if not len(own):
                continue
            s = scorer.score(tile.state, queries, a, b)
            first, size = tile.edge[local[own]], last[local[own]] - tile.edge[local[own]]
            start = np.cumsum(size) - size
            row = np.arange(size.sum()) + np.repeat(first - start, size)
            raw = s[np.repeat(np.searchsorted(ends, own, "right") - 1 - a, size), row]
            near = np.round(raw, digits)
            top = np.maximum.reduceat(near, start)
            pick = np.minimum.reduceat(np.where(near == np.repeat(top, size), np.arange(len(row)), len(row)), start)
            # a unit may go on from the tile before, whose rows come first
            better = (at[own] < 0) | (top > np.round(score[own], digits))
            own, pick = own[better], pick[better]
            at[own], score[own] = tile.base + local[own], raw[pick]
            doc[own] = tile.doc.take(pa.array(row[pick])).to_pylist()
    return at, score, doc


class _Before:
    """How many units come before each wanted pair; ``of`` is the pair's query, ``at`` its unit's number, ``s`` its rounded score."""

    def __init__(self, n: int, of: np.ndarray, at: np.ndarray, s: np.ndarray):
        self.order = np.lexsort((at, s, of))
        self.s, self.at = s[self.order], at[self.order]
        self.ends = np.searchsorted(of[self.order], np.arange(n + 1))
        # place of the first pair of the same query and score
        new = np.concatenate([[True], (self.s[1:] != self.s[:-1]) | (np.diff(of[self.order]) != 0)]) if len(s) else np.empty(0, bool)
        self.lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        self.above, self.ties = np.zeros(len(s) + n, np.int64), np.zeros(len(s), np.int64)

    def add(self, i: int, s: np.ndarray, base: int) -> None:
        """Rounded best scores of the units from number ``base`` for query ``i``."""
        x, y = self.ends[i], self.ends[i + 1]
        if x == y:
            return
        t = self.s[x:y]
        place = np.searchsorted(t, s)
        self.above[x + i : y + i + 1] += np.bincount(place, minlength=y - x + 1)
        same = np.flatnonzero(np.append(t, np.nan)[place] == s)
        if len(same):
            span = base + len(s) + 1
            key = np.sort(place[same] * span + base + same)
            lead = self.lead[x:y] - x
            self.ties[x:y] += np.searchsorted(key, lead * span + np.minimum(self.at[x:y], span - 1)) - np.searchsorted(key, lead * span)

    def counts(self) -> np.ndarray:
        out = np.empty(len(self.s), np.int64)
        for i, (x, y) in enumerate(zip(self.ends, self.ends[1:])):
            out[self.order[x:y]] = np.cumsum(self.above[x + i : y + i + 1][::-1])[::-1][1:] + self.ties[x:y]
        return out


def _ranks(scorer: Scorer, files: list[str], queries: Any, digits: int, positive: bool, kinds: tuple[pa.DataType, pa.DataType], rows: int, width: int) -> Iterator[pa.RecordBatch]:
    """The rows are read twice, however many queries there are: for scores of wanted pairs, then for the units before them."""
    n = len(queries.names)
    at, score, doc = _wanted(scorer, files, queries, digits, rows, width)
    real = np.flatnonzero((at >= 0) & (score > 0 if positive else np.isfinite(score)))
    of = np.repeat(np.arange(n), np.diff(queries.ends))[real]
    before = _Before(n, of, at[real], np.round(score[real], digits))
    tail, done = np.empty(n), 0  # scores of the last unit so far, which may go on
    for tile in _tiles(files, scorer, rows) if len(real) else ():
        again = tile.base < done
        for a in range(0, n, width):
            b = min(n, a + width)
            s = scorer.score(tile.state, queries, a, b)
            top = s if len(tile.edge) == s.shape[1] else np.maximum.reduceat(np.ascontiguousarray(s.T), tile.edge, axis=0).T
            if again:
                top = np.concatenate([np.maximum(top[:, :1], tail[a:b, None]), top[:, 1:]], axis=1)
            elif done:
                top = np.concatenate([tail[a:b, None], top], axis=1)
            tail[a:b] = top[:, -1]
            near = np.round(top[:, :-1], digits)
            if positive:
                near[top[:, :-1] <= 0] = -np.inf
            for i in range(a, b):
                before.add(i, near[i - a], tile.base - (not again and done > 0))
        done = tile.base + len(tile.edge)
    if positive:
        tail = np.where(tail > 0, tail, -np.inf)
    for i in range(n if done else 0):
        before.add(i, np.round(tail[i : i + 1], digits), done - 1)
    names = [queries.names.take(pa.array(of)), pa.array(doc[real].tolist(), kinds[0]), queries.wanted.take(pa.array(real))]
    yield pa.RecordBatch.from_arrays([*names, pa.array(score[real]), pa.array((before.counts() + 1).astype(np.int32))], ["query", "doc", "unit", "score", "rank"])


class Searched:
    """Queries against rows: ``asked`` has a row per query or more, ``query`` and what the scorer needs; ``n`` rows in all."""

    def __init__(self, rows: Rows, asked: DataFrame, n: int, scorer: Scorer, kinds: tuple[str, str, str], digits: int, positive: bool, tile: int, most: int):
        self.rows, self.asked, self.n, self.scorer, self.kinds, self.most = rows, asked, n, scorer, kinds, most
        self.order = digits, positive
        self.size = min(ROWS, tile)
        self.width = max(1, tile // self.size)
        # each task reads the rows, so there are no more than can run at once
        self.tasks = max(2, asked.sparkSession.sparkContext.defaultParallelism)

    def _run(self, answer: Callable, schema: str, asked: DataFrame, blocks: int, parts: list[list[str]]) -> DataFrame:
        shared = asked.sparkSession.sparkContext.broadcast(self.scorer)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                table = pa.Table.from_batches(held)
                out = answer(shared.value, parts[table.column("part")[0].as_py()], shared.value.queries(table))
                yield from (b for b in out if b.num_rows)

        part = F.explode(F.sequence(F.lit(0), F.lit(len(parts) - 1))) if len(parts) > 1 else F.lit(0)
        dealt = asked.withColumn("part", part).withColumn("task", (F.col("part") * blocks + F.pmod(F.xxhash64("query"), F.lit(blocks))).cast("int"))
        return dealt.repartitionById(blocks * len(parts), "task").drop("task").sortWithinPartitions("query").mapInArrow(run, schema)

    def _split(self, answer: Callable, schema: str) -> DataFrame:
        """Each query goes to one task, or to one for each part of the rows where queries are few."""
        blocks = max(1, -(-self.n // self.most), min(self.tasks, -(-self.n // WORTH)))
        return self._run(answer, schema, self.asked, blocks, self.rows.parts(self.tasks // blocks))

    def _full(self, answer: Callable, schema: str, times: int = 1) -> DataFrame:
        """A task holds the scores of all units for as many queries as fit."""
        n_units = self.rows.table.select("unit").distinct().count()
        step = max(1, min(self.most, times * HELD // max(1, n_units)))
        blocks = max(1, -(-self.n * 6 // (5 * step)), min(self.tasks, -(-self.n // 16)))
        digits, positive = self.order
        answer = partial(answer, digits=digits, positive=positive, n_units=n_units, rows=self.size, width=self.width, step=step)
        return self._run(answer, schema, self.asked, blocks, self.rows.parts(1))

    def _names(self) -> tuple[pa.DataType, pa.DataType]:
        return tuple(to_arrow_type(self.rows.table.schema[c].dataType) for c in ("doc", "unit"))

    def _ranked(self) -> str:
        return "query {}, doc {}, unit {}, score double, rank int".format(*self.kinds)

    def top(self, k: int) -> DataFrame:
        """``query, doc, unit, score``: the best k units of each query and part of the rows."""
        digits, positive = self.order
        answer = partial(_top, kinds=self._names(), k=k, digits=digits, positive=positive, rows=self.size, width=self.width)
        return self._split(answer, "query {}, doc {}, unit {}, score double".format(*self.kinds))

    def totals(self) -> DataFrame:
        """``query, n, total, best`` of the positive scores of each query and part of the rows."""
        return self._split(partial(_totals, rows=self.size, width=self.width), f"query {self.kinds[0]}, n bigint, total double, best double")

    def ranking(self) -> DataFrame:
        """``query, doc, unit, score, rank`` of every unit."""
        return self._full(_ranking, self._ranked())

    def unit_ranks(self) -> DataFrame:
        """``query, unit, rank`` of every unit; a unit's name leaves a task once, and its ranks become rows after that."""
        query, _, unit = self.kinds
        lists = self._full(_unit_ranks, f"unit {unit}, queries array<{query}>, ranks array<int>", BARE)
        return lists.select("unit", "queries", F.posexplode("ranks").alias("at", "rank")).select(F.get("queries", "at").alias("query"), "unit", "rank")

    def ranks(self, wanted: DataFrame) -> DataFrame:
        """``query, doc, unit, score, rank``: the exact ranks of wanted ``query, unit`` pairs among all units.  Pairs that score nothing have no rank."""
        units = wanted.groupBy("query").agg(F.collect_set(F.struct("unit")).alias("wanted"))
        blocks = max(1, -(-self.n // self.most), min(self.tasks, -(-self.n // 16)))
        digits, positive = self.order
        answer = partial(_ranks, digits=digits, positive=positive, kinds=self._names(), rows=self.size, width=self.width)
        return self._run(answer, self._ranked(), self.asked.join(units, "query"), blocks, self.rows.parts(1))
