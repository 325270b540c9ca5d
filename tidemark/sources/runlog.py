"""Run log: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import LOG, SUMMARY
from tidemark.storage import version_path

LOGGER = "tidemark"
BASE_KEYS = ("level", "logger", "message")

# Fixed value: the message that marks a run's summary line.
RUN_COMPLETE = "pipeline complete"


def log_line(message: str, level: str = "INFO", fields: list[str] | None = None) -> Column:
    """JSON line of the base keys and the given columns, in that order."""
    fields = fields or []
    clash = sorted(set(fields) & set(BASE_KEYS))
    if clash:
        raise ValueError(f"log fields would overwrite base keys: {clash}")
    base = [
        F.lit(value).alias(key) for key, value in zip(BASE_KEYS, (level, LOGGER, message))
    ]
    return F.to_json(F.struct(*base, *[F.col(name) for name in fields]))


def append_log(rows: DataFrame, path: str, message: str, level: str = "INFO") -> None:
    line = log_line(message, level, rows.columns)
    rows.select(line.alias("value")).write.mode("append").text(path)


def write_run_log(summary: DataFrame, root: str, version: int) -> None:
    """Summary line of one run. A replayed run replaces its line."""
    line = log_line(RUN_COMPLETE, "INFO", summary.columns)
    lines = summary.select(line.alias("value"))
    lines.write.mode("overwrite").text(version_path(root, version))


def read_run_summary(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The summary row that a run left."""
    lines = read_log(spark, version_path(root, version))
    return run_history(lines).select(SUMMARY.fieldNames())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).json(path)


def run_history(log: DataFrame) -> DataFrame:
    """Summary lines only."""
    return log.filter(F.col("message") == RUN_COMPLETE)
