"""Session helpers: the shared folder and tables written to cut lineage."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "ledgerline", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session without that
    setting gets a temporary folder; anywhere else a missing setting is an error, because
    a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_SCOPE: ContextVar[str] = ContextVar("scope", default="")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, within the folder of the scope where there is one."""
    return f"{shared_dir(spark)}/ledgerline/{_SCOPE.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Written tables of the block go when it ends: for steps that have stored their results by then."""
    folder = f"{_SCOPE.get()}{name}-{uuid.uuid4().hex}/"
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/ledgerline/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage on durable storage, so a lost executor costs a re-read only, and gives
    the planner the true size: a later join broadcasts the table only when its files are
    below spark.sql.autoBroadcastJoinThreshold and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_functions(module_name: str) -> None:
    """Send a module's functions to Python workers by value: executors need not install it."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
