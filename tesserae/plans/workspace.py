"""Materialised intermediate tables in the folder that all executors share.

Iterative operators cut their lineage by writing a Parquet table below ``spark.checkpoint.dir`` and reading it back:
the copy outlives lost executors, carries real size statistics for the join planner, and gives both sides of a later
join an exchange of their own, which adaptive execution can split when a key is hot.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
#: Rows may be large (packed arrays): check a row group's size after every row, and keep groups small.
_WRITER = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only on a local master (tests, a laptop) a temporary folder if it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tesserae-")
    return _OWN[app]


class Workspace:
    """A folder of named tables for one run of one operator."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._path(self.root, on_exit=True)

    def _path(self, path: str, on_exit: bool = False):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if on_exit:
            fs.mkdirs(p)
            fs.deleteOnExit(p)
        return fs, p

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a DataFrame that reads the copy."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").options(**_WRITER).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Let Spark's cleaner delete shuffle files and broadcasts that no live plan needs; it acts on the driver's collection."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            fs, p = self._path(f"{self.root}/{name}")
            fs.delete(p, True)


def fits_broadcast(rows: int, row_bytes: int, limit: int = 64 << 20) -> bool:
    """Whether ``rows`` rows of at most ``row_bytes`` bytes stay below ``limit``."""
    return rows * row_bytes <= limit


def small_side(df: DataFrame, row_bytes: int = 32, limit: int = 64 << 20) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit ``limit`` bytes; else unchanged, for a shuffled join."""
    return F.broadcast(df) if fits_broadcast(df.count(), row_bytes, limit) else df
