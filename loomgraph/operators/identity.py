"""Content identity: canonical rows, corpus roots, hashes of vectors, aliases."""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def _in_order(value: Column, kind: DataType) -> Column:
    """A value whose structs, at any depth, have their fields in order of their names, and whose maps have their keys in order."""
    if isinstance(kind, StructType):
        own = F.struct(*[_in_order(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(value.isNotNull(), own)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _in_order(x, kind.elementType)) if isinstance(kind.elementType, (StructType, ArrayType, MapType)) else value
    if isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), _in_order(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(F.array_sort(pairs, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))
    return value


def canonical_json(df: DataFrame) -> Column:
    """The row as JSON: keys in order at every depth, nulls kept, no spaces, times to the microsecond."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    row = F.struct(*[_in_order(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    time = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return F.to_json(row, {"ignoreNullFields": "false", "timestampFormat": f"{time}XXX", "timestampNTZFormat": time})


def corpus_identity(df: DataFrame, key: str, content: Column, fan: int = 4096) -> DataFrame:
    """One row ``n, root``: a hash tree over rows in order of the key.

    Leaves are ``key TAB sha256 LF``; a bucket of keys (by the first digits of the key's hash) hashes its sorted leaves,
    the root hashes the buckets in order.  No task sees more than a bucket, whatever the corpus holds; equal sets of rows have
    equal roots.
    """
    leaf = F.concat_ws("\t", F.col(key).cast("string"), F.sha2(F.coalesce(content, F.lit("")), 256))
    bucket = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 3), 16, 10).cast("int") % fan
    buckets = df.select(bucket.alias("bucket"), leaf.alias("leaf")).distinct().groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("leaf")), "\n"), 256).alias("h"),
    )
    # at most `fan` rows meet in one task
    rows = F.array_sort(F.collect_list(F.struct("bucket", "h")))
    return buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sha2(F.array_join(F.transform(rows, lambda x: x.h), "\n"), 256).alias("root"))


def vector_hashes(df: DataFrame, id_col: str, embedding: str) -> DataFrame:
    """``id_col, vector_sha256``: SHA-256 of the little-endian float32 bytes; null for null vectors or elements."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            flat = lists.flatten()
            end = np.cumsum(size)
            # nulls before each place: a vector with any is left out
            gaps = np.concatenate([[0], np.cumsum(np.asarray(flat.is_null()))])
            whole = np.asarray(lists.is_valid()) & (gaps[end] == gaps[end - size])
            held = memoryview(np.ascontiguousarray(flat.cast(pa.float32()).fill_null(0).to_numpy(zero_copy_only=False), "<f4")).cast("B")
            out = [hashlib.sha256(held[4 * (e - n) : 4 * e]).hexdigest() if w else None for n, e, w in zip(size.tolist(), end.tolist(), whole.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [id_col, "vector_sha256"])

    return df.select(id_col, embedding).mapInArrow(run, f"`{id_col}` {kind}, vector_sha256 string")


def alias_merge(df: DataFrame, key: str, content_hash: str) -> DataFrame:
    """``content_hash, main, n_aliases``: the smallest key of equal content and how many others share it."""
    return df.where(F.col(content_hash).isNotNull() & F.col(key).isNotNull()).groupBy(content_hash).agg(F.min(key).alias("main"), (F.count_distinct(key) - 1).alias("n_aliases"))
