"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.storage import delete_path


def local_session(
    app: str = "tidemark", cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8
) -> SparkSession:
    """A session for tests and benches. On a cluster, submit with its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as `--py-files` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), package.name)
    archive = shutil.make_archive(target, "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share for tables that cut lineage.

    It is the one the cluster names in `spark.checkpoint.dir`. Only a local
    session, which has no other machines, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_scratch[app], ignore_errors=True)
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


#: Rows of megabytes: a row group is measured after each row, not after a hundred, as
#: a task holds one in memory to write it and to read it.
LARGE_ROWS = {
    "parquet.block.size": 32 << 20,
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 1,
    "parquet.enable.dictionary": "false",
}


class Scratch:
    """Scratch tables that are deleted when their `with` block ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        for path in self.paths:
            delete_path(self.spark, path)

    def staged(
        self, df: DataFrame, name: str, by: str | None = None, large_rows: bool = False
    ) -> DataFrame:
        """`df` written and read back; with `by`, in one folder for each of its values."""
        self.paths.append(scratch_path(self.spark, name))
        writer = df.write.partitionBy(by) if by else df.write
        writer.options(**(LARGE_ROWS if large_rows else {})).parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])


def staged(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """`df` written to the scratch folder and read back: computed once, however
    often it is used, and still there when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
