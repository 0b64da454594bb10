"""Session settings and the shared folder for tables that cut a lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keeping the call site of every column makes large expressions slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_dirs: dict[str, str] = {}
_open_scopes: list[list[str]] = []


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with this engine's settings; sizes come from the cluster or ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees. Only a local master may fall back to a temporary one."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="twinloom-")
        folder = _local_dirs[context.applicationId]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, never used before."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _open_scopes[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that were put into the shared folder within it.

    Results are lazy and read those tables: write or collect them inside the scope.
    """
    _open_scopes.append([])
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for path in _open_scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, and gives Spark a file size to choose the join by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
