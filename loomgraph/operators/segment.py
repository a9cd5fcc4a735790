"""Lossless greedy segmentation of texts under a budget, sentence ends preferred, with overlap."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from loomgraph.functions.text import IDEOGRAPHS, LATIN, embedding_text, tokens

#: Characters after which a segment may end (fixed values).
ENDS = frozenset("。！？!?；;.\n")
#: Counts the tokens of what is embedded; None counts characters of the body.
TokenCounter = Callable[[str], int]


class SegmentError(ValueError):
    """A text that no segmentation can fit."""


def longest_fit(fits: Callable[[int], bool], start: int, n: int) -> int:
    """The largest end whose prefix fits, by bisection; if not even one character fits, the first longer one that does."""
    low, high = start, n
    while low < high:
        mid = (low + high + 1) // 2
        if fits(mid):
            low = mid
        else:
            high = mid - 1
    if low > start:
        return low
    end = next((e for e in range(start + 1, n + 1) if fits(e)), None)
    if end is None:
        raise SegmentError(f"nothing from character {start} on fits the budget")
    return end


def spans(text: str, budget: int, overlap: int = 60, count: TokenCounter | None = None, frame: tuple[str, str] = ("", "")) -> list[tuple[int, int]]:
    """``(start, end)`` of the segments of a text; an empty text has none.

    ``frame`` is what stands around a segment when its tokens are counted.  An end is moved back to the last
    sentence end that keeps three fifths of the segment.  A frame that exceeds the budget by itself is an error.
    """
    if not 0 <= overlap <= 60:
        raise ValueError("overlap must lie between 0 and 60")
    if count and text and count(frame[0] + frame[1]) > budget:
        raise SegmentError("title and applicability alone exceed the budget")
    n, out, start = len(text), [], 0
    while start < n:
        fits = (lambda e: count(frame[0] + text[start:e] + frame[1]) <= budget) if count else None
        best = longest_fit(fits, start, n) if count else min(n, start + budget)
        end = best
        if best < n:
            least = start + max(1, -(-(best - start) * 3 // 5))
            ends = (p for p in range(best, max(least, start + 2) - 1, -1) if text[p - 1] in ENDS and (not count or fits(p)))
            end = next(ends, best)
        out.append((start, end))
        if end == n:
            break
        start = end if overlap == 0 or end - start <= 1 else end - min(overlap, end - start - 1)
    return out


def segment(df: DataFrame, id_col: str, text_col: str, budget: int, overlap: int = 60, counter: Callable[[], TokenCounter] | None = None, title: str | None = None, applicability: str | None = None) -> DataFrame:
    """``id_col, segment_index, body_start, body_end, segment_count`` of every text; null and empty texts have no row.

    With a ``counter``, ``token_count`` too: the tokens of what is embedded, that is the title, the segment and the applicability
    by line feeds as in :func:`embedding_text`; all of it keeps within the budget.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter() if counter else None
        for frame in frames:
            out = []
            for i, text, head, tail in zip(frame[id_col], frame[text_col], frame["_title"], frame["_tail"]):
                around = (f"{head}\n", f"\n{tail}")
                cut = spans(text, budget, overlap, count, around)
                out += [(i, k, a, b, len(cut), *([count(around[0] + text[a:b] + around[1])] if count else [])) for k, (a, b) in enumerate(cut)]
            yield pd.DataFrame(out, columns=names)

    names = [id_col, "segment_index", "body_start", "body_end", "segment_count", *(["token_count"] if counter else [])]
    nothing = F.lit("")
    head = F.coalesce(F.col(title), nothing) if title else nothing
    tail = F.coalesce(F.array_join(F.col(applicability), "\n"), nothing) if applicability else nothing
    texts = df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, text_col, head.alias("_title"), tail.alias("_tail"))
    return texts.mapInPandas(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} int" for c in names[1:]))


def lexical_counter() -> TokenCounter:
    """Counts the tokens of :func:`loomgraph.functions.text.tokens`: the stand-in where no model's tokenizer is at hand."""
    run = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), f"[{IDEOGRAPHS}]+|{LATIN}"))
    return lambda t: sum(1 if m[0][0].isascii() else 2 * len(m[0]) - 1 for m in run.finditer(t))


def chunk_rows(units: DataFrame, segments: DataFrame) -> DataFrame:
    """Chunks of units: numbered ids, the text that is searched and embedded, hashes, index and count."""
    body = F.substring("text", F.col("body_start") + 1, F.col("body_end") - F.col("body_start"))
    return segments.join(units.select("knowledge_unit_id", "source_id", "subject_root", "title", "text", "applicability"), "knowledge_unit_id").select(
        F.format_string("%s:chunk:%03d", "knowledge_unit_id", F.col("segment_index") + 1).alias("chunk_id"), "knowledge_unit_id", "source_id", "subject_root",
        embedding_text(F.col("title"), body, F.col("applicability")).alias("search_text"), "body_start", "body_end",
        F.sha2("text", 256).alias("full_text_sha256"), "segment_index", "segment_count",
    )


def whole_chunk_rows(units: DataFrame, segments: DataFrame) -> DataFrame:
    """Chunk rows that carry a copy of all fields of their unit, and the number of tokens of what is embedded.

    ``segments`` may bring a ``token_count`` of a model's tokenizer; else the engine's own tokens are counted.  The unit's text and the fields that a
    chunk names itself stay with the unit in ``knowledge_unit``.
    """
    rows = chunk_rows(units, segments.drop("token_count"))
    whole = units.select("knowledge_unit_id", F.struct(*units.columns).alias("knowledge_unit"))
    rows = rows.join(whole, "knowledge_unit_id").withColumn("embedding_text", F.col("search_text"))
    if "token_count" in segments.columns:
        return rows.join(segments.select("knowledge_unit_id", "segment_index", "token_count"), ["knowledge_unit_id", "segment_index"])
    return rows.withColumn("token_count", F.size(tokens(F.col("search_text"))))


def coverage(segments: DataFrame, key: str, start: str = "body_start", end: str = "body_end") -> DataFrame:
    """Each segment with the furthest end before it: ``prev_end`` (0 at first), ``gap`` and ``overlap``."""
    w = Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.coalesce(F.max(end).over(w), F.lit(0))
    return segments.withColumn("prev_end", prev).withColumn("gap", F.greatest(F.col(start) - F.col("prev_end"), F.lit(0))).withColumn("overlap", F.greatest(F.col("prev_end") - F.col(start), F.lit(0)))
