"""Column functions on arrays and loosely typed fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def duplicate_free(a: Column) -> Column:
    """No element twice; null elements count as equal, a null array is not duplicate-free."""
    return F.coalesce(F.size(F.array_distinct(a)) == F.size(a), F.lit(False)) & a.isNotNull()


def disjoint(*arrays: Column) -> Column:
    """No element in two of the arrays; null arrays and null elements share nothing."""
    held = [F.coalesce(F.array_compact(a), F.array().cast("array<string>")) for a in arrays]
    out = F.lit(True)
    for i, a in enumerate(held):
        for b in held[:i]:
            out = out & ~F.arrays_overlap(a, b)
    return out


def place_of(a: Column, x: Column) -> Column:
    """Place of the first match, from 1; null where there is none, or either side is null."""
    return F.nullif(F.array_position(a, x), F.lit(0).cast("bigint"))


def all_named(a: Column) -> Column:
    """An array whose elements are all texts that aren't blank; an empty one is."""
    return F.coalesce(F.forall(a, lambda x: x.isNotNull() & ~F.coalesce(x.rlike(r"(?U)\A\s*\z"), F.lit(True))), F.lit(False))


def intervals(text: Column) -> Column:
    """``array<struct<start: bigint, end: bigint>>`` of a text such as "3-7, 12, 20–25"; null for anything else.

    A single number is an interval of one; ends are included.  White space around parts doesn't matter.
    """
    part = r"\s*\d{1,18}\s*(?:[-–]\s*\d{1,18}\s*)?"
    whole = F.when(text.rlike(rf"\A{part}(?:,{part})*\z"), F.split(text, ","))
    number = lambda x, i: F.regexp_extract(x, r"(\d+)\s*(?:[-–]\s*(\d+))?", i)
    return F.transform(whole, lambda x: F.struct(number(x, 1).cast("bigint").alias("start"), F.coalesce(F.nullif(number(x, 2), F.lit("")), number(x, 1)).cast("bigint").alias("end")))


def valid_intervals(a: Column) -> Column:
    """At least one interval, and in each 1 <= start <= end; null is not valid."""
    good = F.forall(a, lambda x: F.coalesce((x["start"] >= 1) & (x["end"] >= x["start"]), F.lit(False)))
    return F.coalesce(good & (F.size(a) > 0), F.lit(False))


def as_array(json: Column) -> Column:
    """Strings of a JSON value: an array's elements, a lone text as an array of one, anything else null."""
    many = F.from_json(json, "array<string>")
    one = F.from_json(F.concat(F.lit('{"x":'), json, F.lit("}")), "x string")["x"]
    return F.when(json.rlike(r"\A\s*\["), many).when(json.rlike(r'\A\s*"'), F.array(one))


def first_named(json: Column, names: Sequence[str]) -> Column:
    """The value of the first of alternative keys that a JSON object has, as text; null values count as absent."""
    return F.coalesce(*[F.get_json_object(json, f"$.{n}") for n in names])
