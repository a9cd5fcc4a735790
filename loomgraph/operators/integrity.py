"""Constraints as violation tables: each rule gives rows ``code, location, detail``; all empty means pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomgraph.functions.text import has_private_path, is_safe_relative_path, secrets
from loomgraph.operators.current import IntegrityError
from loomgraph.sources.readers import compare_manifest, denied_files
from loomgraph.workspace import Workspace


@dataclass(frozen=True)
class Rule:
    """``check`` gives the violations; ``row`` is set for rules on single rows: table, key and condition."""

    code: str
    check: Callable[[dict[str, DataFrame]], DataFrame]
    row: tuple[str, str, Callable[[], Column]] | None = None


def row_rule(code: str, table: str, key: str, holds: Callable[[], Column]) -> Rule:
    """A condition on single rows; a report looks at each row once for all such rules of its table."""
    return Rule(code, lambda t: predicate(t[table], key, holds()), (table, key, holds))


def _rows(df: DataFrame, location: Column, detail: Column | None = None) -> DataFrame:
    return df.select(location.cast("string").alias("location"), (detail if detail is not None else F.lit(None)).cast("string").alias("detail"))


def predicate(df: DataFrame, key: str, holds: Column) -> DataFrame:
    """Rows for which the condition is not true; null is not true."""
    return _rows(df.where(~F.coalesce(holds, F.lit(False))), F.col(key))


def unique(df: DataFrame, *keys: str) -> DataFrame:
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _rows(found, F.concat_ws("|", *keys), F.col("n"))


def refers(df: DataFrame, key: str, ref: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """References that no parent row has; null refers to nothing."""
    known = parent.select(F.col(parent_key).alias(ref)).distinct()
    return _rows(df.where(F.col(ref).isNotNull()).join(known, ref, "left_anti"), F.col(key), F.col(ref))


def same_sets(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Symmetric difference of two key sets, in one full outer join on the keys."""
    a = left.select(*on).distinct().withColumn("in_left", F.lit(True))
    b = right.select(*on).distinct().withColumn("in_right", F.lit(True))
    odd = a.join(b, on, "full_outer").where("in_left is null or in_right is null")
    return _rows(odd, F.concat_ws("|", *on), F.when(F.col("in_left").isNull(), "missing left").otherwise("missing right"))


def exactly_one(children: DataFrame, child: str, links: DataFrame, link_child: str, parent: str) -> DataFrame:
    """Children with no or more than one distinct parent."""
    n = links.groupBy(F.col(link_child).alias(child)).agg(F.count_distinct(parent).alias("n"))
    found = children.select(child).distinct().join(n, child, "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n <> 1")
    return _rows(found, F.col(child), F.col("n"))


def hash_matches(df: DataFrame, key: str, text: str, stored: str) -> DataFrame:
    """Rows whose stored SHA-256, in either case, is not that of the text; a null on either side does not match."""
    return predicate(df, key, F.sha2(F.col(text), 256) == F.lower(stored))


def ordered(df: DataFrame, position: str, value: str, parts: str | None = None) -> DataFrame:
    """Positions whose value is not above the one before, per group.

    Without groups the rows are ranged by position over many tasks; each takes the value before its first row from the last row of
    the nearest task before it that has any, of which there is one row per task.
    """
    if parts:
        w = Window.partitionBy(parts).orderBy(position)
        return _rows(df.withColumn("before", F.lag(value).over(w)).where(F.col("before") >= F.col(value)), F.col(position), F.col(value))
    ws = Workspace(df.sparkSession, "ordered")
    ranged = ws.write(df.select(F.col(position).alias("at"), F.col(value).alias("value")).repartitionByRange("at").withColumn("part", F.spark_partition_id()), "ranged")
    last = ranged.groupBy("part").agg(F.max_by("value", "at").alias("carried"))
    # one row per task
    carried = last.select((F.lead("part").over(Window.orderBy("part"))).alias("part"), "carried").where("part is not null")
    own = ranged.withColumn("before", F.lag("value").over(Window.partitionBy("part").orderBy("at"))).withColumn("first", F.row_number().over(Window.partitionBy("part").orderBy("at")) == 1)
    joined = own.join(F.broadcast(carried), "part", "left").withColumn("before", F.when(F.col("first"), F.col("carried")).otherwise(F.col("before")))
    return _rows(joined.where("before >= value"), F.col("at"), F.col("value"))


def report(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """All violations of all rules; rules on single rows of a table share one pass over it."""
    parts, shared = [], {}
    for r in rules:
        if r.row:
            shared.setdefault(r.row[:2], []).append(r)
        else:
            parts.append(r.check(tables).withColumn("code", F.lit(r.code)).select("code", "location", "detail"))
    for (table, key), own in shared.items():
        broken = F.array_compact(F.array(*[F.when(~F.coalesce(r.row[2](), F.lit(False)), F.lit(r.code)) for r in own]))
        parts.append(tables[table].select(F.explode(broken).alias("code"), F.col(key).cast("string").alias("location"), F.lit(None).cast("string").alias("detail")))
    out = parts[0]
    for one in parts[1:]:
        out = out.unionByName(one)
    return out


def demand(tables: dict[str, DataFrame], rules: list[Rule]) -> None:
    """Raise on the first violation; no rules demand nothing."""
    if not rules:
        return
    first = report(tables, rules).limit(1).collect()
    if first:
        raise IntegrityError("{code} at {location}: {detail}".format(**first[0].asDict()))


def field_diff(left: DataFrame, right: DataFrame, key: str, fields: list[str], sides: bool = False) -> DataFrame:
    """``key, differing``: names of the fields in which two rows of a key differ, null equal to null.

    Only keys of both sides; with ``sides`` a key of one side comes out too, with the names "(missing)" or "(extra)".
    """
    a = left.select(key, F.struct(*fields).alias("a"))
    b = right.select(key, F.struct(*fields).alias("b"))
    names = F.array_compact(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]))
    if not sides:
        return a.join(b, key).select(key, names.alias("differing")).where(F.size("differing") > 0)
    one = F.when(F.col("a").isNull(), F.array(F.lit("(missing)"))).when(F.col("b").isNull(), F.array(F.lit("(extra)"))).otherwise(names)
    return a.join(b, key, "full_outer").select(key, one.alias("differing")).where(F.size("differing") > 0)


def release_gate(files: DataFrame, manifest: DataFrame, suffixes: list[str], texts: dict[str, tuple[DataFrame, str, list[str]]], most_bytes: int = 10 << 20) -> DataFrame:
    """Everything that stands against publishing: ``code, location, detail``, empty if nothing does.

    ``files`` and ``manifest`` are compared (name, bytes, sha256), files of denied suffixes or sizes named, and the given columns of
    ``texts`` (name to table, key, columns) searched for private paths and secrets.
    """
    parts = [
        _rows(compare_manifest(files, manifest), F.col("name"), F.col("problem")).withColumn("code", F.lit("manifest")),
        _rows(denied_files(files, suffixes, most_bytes), F.col("name"), F.col("why")).withColumn("code", F.lit("denied_file")),
        _rows(files.where(~is_safe_relative_path(F.col("name"))), F.col("name")).withColumn("code", F.lit("unsafe_path")),
    ]
    for name, (df, key, columns) in texts.items():
        said = F.concat_ws("\n", *columns)
        parts.append(_rows(df.select(key, F.explode(secrets(said)).alias("found")), F.concat(F.lit(f"{name}:"), F.col(key).cast("string")), F.col("found")).withColumn("code", F.lit("secret")))
        parts.append(_rows(df.where(has_private_path(said)), F.concat(F.lit(f"{name}:"), F.col(key).cast("string"))).withColumn("code", F.lit("private_path")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("code", "location", "detail")


def against_profile(df: DataFrame, profile: dict[str, object], key: str) -> DataFrame:
    """Where a table departs from what a profile expects of it: ``location, detail``.

    A profile is data: ``rows`` (their number), ``ids`` (the exact set of keys, at most some thousands), ``hashes`` (a hash by key) with the
    column ``hash`` that holds it.  What it doesn't name is not checked.
    """
    spark, parts = df.sparkSession, []
    if "rows" in profile:
        n = df.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != profile["rows"])
        parts.append(_rows(n, F.lit("rows"), F.concat_ws(" ", F.col("n").cast("string"), F.lit(f"instead of {profile['rows']}"))))
    if "ids" in profile:
        ids = spark.createDataFrame([(i,) for i in profile["ids"]], df.select(key).schema)
        parts.append(same_sets(df, ids, [key]))
    if "hashes" in profile:
        want = spark.createDataFrame(list(profile["hashes"].items()), f"`{key}` string, want string")
        held = df.select(key, F.lower(profile["hash"]).alias("held"))
        parts.append(_rows(want.join(held, key, "left").where(~F.lower("want").eqNullSafe(F.col("held"))), F.col(key), F.lit("hash")))
    out = spark.createDataFrame([], "location string, detail string")
    for p in parts:
        out = out.unionByName(p)
    return out
