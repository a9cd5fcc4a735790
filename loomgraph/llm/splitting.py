"""Cutting oversized spans at natural boundaries, with overlap: dynamic programming over cut positions.

A state is the start of a piece.  From it lead the admissible cuts: natural boundaries that make the
piece ``least`` to ``limit`` characters long, or the cut at ``limit`` where there is none; the next state
lies ``overlap`` before the cut.  One table over all states that can be reached holds the least cost from
each on: the penalty of the cut, the piece's deviation from its ideal length, and the cost of what follows.
Two :class:`Cost` settings are given:

* ``LONGEST_FIRST``, the rule of p2_found: all natural cuts are equally good, the ideal length is the limit, and
  what follows counts so little (less than one character's deviation) that plans are compared by their first piece,
  then by their second, and so on.
* ``BALANCED``: forced cuts cost 1, sentence ends 0.05, line ends 0; the ideal is an even length, deviations count squared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Characters after which a text may be cut (fixed values).
ENDS = "。！？!?；;.\n"
_NATURAL = re.compile(f"[{re.escape(ENDS)}]")


@dataclass(frozen=True)
class Cost:
    """Penalties of cuts by kind; ideal length (even shares, or the limit); power of the deviation, in units of the limit; weight of what follows (None: below one character)."""

    forced: float
    sentence: float
    line: float
    even: bool
    power: float
    follows: float | None


LONGEST_FIRST = Cost(1.0, 0.0, 0.0, False, 1.0, None)
BALANCED = Cost(1.0, 0.05, 0.0, True, 2.0, 1.0)


def plan_cuts(text: str, length: int, limit: int = 600, overlap: int = 60, least: int = 360, cost: Cost = LONGEST_FIRST) -> list[tuple[int, int]]:
    """The cheapest pieces ``(start, end)`` of a span of ``length`` characters whose characters are ``text`` (as far as there are any).

    Of plans that cost the same (to nine digits) the one with the longer first piece that differs is taken.
    """
    if not 0 <= overlap < least <= limit:
        raise ValueError("0 <= overlap < least <= limit must hold")
    if length <= limit:
        return [(0, length)]
    ends = np.array([m.end() for m in _NATURAL.finditer(text)], np.int64)
    penalty = np.full(length + 1, cost.forced)
    penalty[ends[ends <= length]] = cost.sentence
    penalty[[e for e in ends.tolist() if text[e - 1] == "\n" and e <= length]] = cost.line
    penalty[length] = 0.0
    pieces = -(-(length - overlap) // (limit - overlap))
    ideal = (length + (pieces - 1) * overlap) / pieces if cost.even else limit
    follows = 1 / (2 * limit) if cost.follows is None else cost.follows

    def cuts(start: int) -> np.ndarray:
        if length - start <= limit:
            return np.array([length])
        inside = ends[np.searchsorted(ends, start + least) : np.searchsorted(ends, start + limit, "right")]
        return inside if len(inside) else np.array([start + limit])

    # states that can be reached: every cut moves the start on
    seen = np.zeros(length + 1, bool)
    seen[0] = True
    states, todo = [], [0]
    while todo:
        start = heappop(todo)
        states.append(start)
        if length - start > limit:
            new = cuts(start) - overlap
            new = new[~seen[new]]
            seen[new] = True
            for x in new.tolist():
                heappush(todo, x)
    value, choice = np.zeros(length + 1), np.zeros(length + 1, np.int64)
    for start in reversed(states):
        reach = cuts(start)
        total = penalty[reach] + (np.abs(reach - start - ideal) / limit) ** cost.power + follows * np.where(reach < length, value[reach - overlap], 0)
        best = int(np.flatnonzero(total <= total.min() + (5e-10 if follows == 1 else 0))[-1])
        value[start], choice[start] = total[best], reach[best]
    out, start = [], 0
    while True:
        end = int(choice[start])
        out.append((start, end))
        if end == length:
            return out
        start = end - overlap


def split_oversized(chunks: DataFrame, units: DataFrame, limit: int = 600, overlap: int = 60, least: int = 360, cost: Cost = LONGEST_FIRST) -> DataFrame:
    """``chunk_id, piece_no, body_start, body_end, piece_count`` of every span longer than ``limit``.

    Positions count in the unit's text from 0.  Spans with a null bound are not oversized.  Where the
    unit or its text is missing, or the span leaves the text, there are no characters and hence no
    natural ends, and pieces are ``limit`` long.  Of several texts of a unit the latest recorded counts, then the
    greatest.  Repeated rows give their pieces once; several spans of one chunk_id are cut each, from
    piece_no 0; a null chunk_id is kept.  Empty tables give no rows.
    """
    # only long spans go on; they are few, so AQE may send them to the units instead of moving texts
    long = chunks.where(F.col("body_end").cast("long") - F.col("body_start") > limit).select("chunk_id", "knowledge_unit_id", "body_start", "body_end").distinct()
    wanted = units.select("knowledge_unit_id", F.struct("recorded_at", "text").alias("x")).join(long.select("knowledge_unit_id").distinct(), "knowledge_unit_id", "left_semi")
    texts = wanted.groupBy("knowledge_unit_id").agg(F.max("x").alias("x"))
    span = F.when(F.col("body_start") >= 0, F.substring(F.col("x.text"), F.col("body_start") + 1, F.col("body_end") - F.col("body_start")))
    spans = long.join(texts, "knowledge_unit_id", "left").select("chunk_id", "body_start", "body_end", F.coalesce(span, F.lit("")).alias("span"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                plan = plan_cuts(r.span, r.body_end - r.body_start, limit, overlap, least, cost)
                out += [(r.chunk_id, i, a + r.body_start, b + r.body_start, len(plan)) for i, (a, b) in enumerate(plan)]
            yield pd.DataFrame(out, columns=["chunk_id", "piece_no", "body_start", "body_end", "piece_count"])

    pieces = spans.mapInPandas(run, "chunk_id string, piece_no int, body_start int, body_end int, piece_count int")
    return pieces.distinct()
