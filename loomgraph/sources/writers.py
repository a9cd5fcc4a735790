"""Sinks: canonical JSON lines, reports, raw matrices, guarded bundles."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, functions as F

from loomgraph.operators.current import IntegrityError
from loomgraph.operators.identity import canonical_json, corpus_identity
from loomgraph.operators.integrity import Rule, demand


def write_jsonl(df: DataFrame, path: str, order: str | None = None) -> None:
    """Canonical JSON lines: keys in order, nulls kept; sorted over all files if ``order`` is given."""
    lines = df if order is None else df.orderBy(order)
    lines.select(canonical_json(df).alias("value")).write.mode("errorifexists").text(path)


def write_report(path: str, report: dict) -> None:
    """A small JSON report for readers, keys in order."""
    Path(path).write_text(json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def envelope(found: DataFrame, method: str, **request: object) -> dict:
    """The answer to one request as a plain object; the rows are at most its limit."""
    rows = [json.loads(x) for x in found.toJSON().collect()]
    return {"status": "ok", "method": method, "rrf_k": 60 if method == "hybrid" else None, **request, "results": rows}


def export_f32_matrix(df: DataFrame, path: str, order: str, embedding: str = "embedding") -> int:
    """Write vectors in order as raw little-endian float32, and return their number.

    Tasks write ranges of rows as part files ``part-00000.f32`` and so on into a folder beside ``path`` that they share; the files in order
    are the matrix.  Only their sizes reach the driver, which puts them together by copying bytes and removes the parts.  Vectors are
    neither null nor hold nulls.
    """
    parts = f"{path}.parts"
    os.makedirs(parts)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number, n = TaskContext.get().partitionId(), 0
        at = f"{parts}/part-{number:05d}.f32"
        with open(f"{at}.{TaskContext.get().taskAttemptId()}", "wb") as f:
            for batch in batches:
                if batch.column(0).null_count or batch.column(0).flatten().null_count:
                    raise ValueError("a vector to be exported is null or holds nulls")
                f.write(np.asarray(batch.column(0).flatten(), "<f4").tobytes())
                n += batch.num_rows
        os.replace(f.name, at)  # a second attempt writes the same bytes
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([n])], ["part", "n"])

    done = df.select(order, embedding).orderBy(order).select(embedding).mapInArrow(run, "part bigint, n bigint").collect()
    with open(path, "wb") as f:
        for r in sorted(done, key=lambda r: r["part"]):
            with open(f"{parts}/part-{r['part']:05d}.f32", "rb") as part:
                shutil.copyfileobj(part, f, 1 << 22)
    shutil.rmtree(parts)
    return sum(r["n"] for r in done)


def write_bundle(tables: dict[str, DataFrame], rules: list[Rule], root: str, keys: dict[str, str], bundle_id: str) -> dict:
    """All checks, then all tables, then the manifest.

    The content's identity is a root over the canonical rows of every table; ``keys`` gives for each table the column
    that its rows are ordered by.  A folder that already holds another identity is refused; the same identity is left as it
    is; tables without a manifest are a partial output and refused too.
    """
    if set(keys) != set(tables):
        raise ValueError("every table of a bundle needs a key")
    spark = next(iter(tables.values())).sparkSession
    demand(tables, rules)
    roots = {t: corpus_identity(df, keys[t], canonical_json(df)).first() for t, df in sorted(tables.items())}
    every = "".join(f"{t}\t{r['n']}\t{r['root']}\n" for t, r in roots.items())
    manifest = {
        "bundle_id": bundle_id, "content_root": hashlib.sha256(every.encode()).hexdigest(), "rows": {t: int(r["n"]) for t, r in roots.items()},
        "roots": {t: r["root"] for t, r in roots.items()}, "tables": sorted(tables),
    }
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(fs_path):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
        if not fs.exists(at):
            raise IntegrityError(f"{root} holds a partial output")
        held = json.loads(spark.read.text(f"{root}/manifest").first()[0])
        if held != manifest:
            raise IntegrityError(f"{root} holds another bundle: {held['bundle_id']} {held['content_root'][:12]}")
        return held
    for t, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{t}")
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.text(f"{root}/manifest")
    return manifest
