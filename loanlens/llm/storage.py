"""Written intermediate tables in the folder the cluster shares.

Every operator that cuts its lineage writes a Parquet table below the folder
named by ``spark.checkpoint.dir`` and reads it back, so a lost executor costs
one re-read and never a recomputation of what came before.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loanlens.session import checkpoint_dir


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


_scope: ContextVar[list[Workspace] | None] = ContextVar("workspaces", default=None)


@contextmanager
def workspaces() -> Iterator[list[Workspace]]:
    """The folders that this thread opens inside the block, for the caller to clear."""
    opened: list[Workspace] = []
    token = _scope.set(opened)
    try:
        yield opened
    finally:
        _scope.reset(token)


class Workspace:
    """A fresh folder below the shared one, for the tables of one call.

    An operator removes what its result doesn't read; the rest stays until
    the caller has used the result and clears what ``workspaces`` collected.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        scope = _scope.get()
        if scope is not None:
            scope.append(self)
        base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` and return the table read from the files."""
        path = self.path(table)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(_plain(df.schema)).parquet(path)

    def remove(self, *tables: str) -> None:
        """Delete tables that no later step reads."""
        for table in tables:
            self._delete(self.path(table))

    def clear(self) -> None:
        """Delete the whole folder."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def _plain(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for a session.

    Python functions inside tasks import it by name; a session started
    elsewhere need not have it on its executors' path.  Texts are long, so
    Arrow batches get fewer rows than Spark's default, if none are set.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "2000")
    sc = spark.sparkContext
    if getattr(sc, "_loanlens_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="loanlens-"), "loanlens_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._loanlens_shipped = True
