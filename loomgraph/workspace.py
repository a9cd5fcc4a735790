"""Materialised intermediate tables in the folder that all executors share.

Iterative operators cut their lineage by writing a table and reading it again.  The folder is the one
the cluster names in ``spark.checkpoint.dir``; only where that is unset (tests, a laptop) a folder of
our own is made.  A written table survives the loss of an executor and gives Catalyst exact sizes, so
joins on it are planned from statistics.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SCOPES: list[list[Workspace]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir`` of the session, else a folder made for a local session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="loomgraph-")
        atexit.register(__import__("shutil").rmtree, _LOCAL["dir"][7:], True)
    return _LOCAL["dir"]


@contextmanager
def released() -> Iterator[None]:
    """Remove, at the end of the block, what operators called inside it have written; their results must have been used by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for ws in _SCOPES.pop():
            ws.drop()
            atexit.unregister(ws.drop)


class Workspace:
    """Tables of one operator call, under one folder.

    Operators remove what their result doesn't read; the rest goes at the end of the :func:`released` block around the call, or when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/loomgraph/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        atexit.register(self.drop)
        if _SCOPES:
            _SCOPES[-1].append(self)

    def _delete(self, path: str) -> None:
        try:
            jvm = self.spark._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone already
            pass

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a table and return it read back."""
        path = f"{self.root}/{name}"
        self.names.add(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        self._delete(f"{self.root}/{name}")
        self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Remove all tables but those that the result reads."""
        for name in self.names - set(names):
            self.discard(name)

    def drop(self) -> None:
        self._delete(self.root)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
