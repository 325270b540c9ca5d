"""Versioned table folders: `<root>/version=<n>/` holds what run n wrote.

A version counts only once its committer left `_SUCCESS`, so a lost run is
never read. Writers that run at one time are told apart by two kinds of small
files, each of which exactly one writer can make (`create_once`):

    claims   `<claims>/<version>` names the run that a version belongs to. A run
             that is done again under its name finds its version again, and
             overwrites its own folders and no other's.
    commits  `<root>/_commits/<n>` names the version that a table whose newest
             version is the whole table, as a snapshot's is, was brought to by its
             n-th commit. Who finds that another writer made it first has worked on
             an old state, and has to work again on the new one.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def _version_folders(spark: SparkSession, root: str) -> list:
    fs, hadoop_path = _hadoop_path(spark, root)
    if not fs.exists(hadoop_path):
        return []
    found = [status.getPath() for status in fs.listStatus(hadoop_path)]
    return [path for path in found if path.getName().startswith("version=")]


def folder_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below `root`, in order; none if it is missing."""
    fs, hadoop_path = _hadoop_path(spark, root)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def written_folders(spark: SparkSession, root: str) -> list[str]:
    """Those whose writer left `_SUCCESS`."""
    return [name for name in folder_names(spark, root) if path_exists(spark, f"{root}/{name}/_SUCCESS")]


def _number(path) -> int:
    return int(path.getName().removeprefix("version="))


def versions(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """Committed versions in rising order, `before` excluded."""
    fs, _ = _hadoop_path(spark, root)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    found = [
        _number(path)
        for path in _version_folders(spark, root)
        if fs.exists(hadoop_path(path, "_SUCCESS"))
    ]
    return sorted(v for v in found if before is None or v < before)


def next_version(spark: SparkSession, *roots: str) -> int:
    """The lowest number above all versions of these tables, committed or not."""
    found = [_number(path) for root in roots for path in _version_folders(spark, root)]
    return max([-1, *found]) + 1


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file unless there is one; False if there is.

    Of several writers exactly one makes it, and nobody sees it in part: it is
    written beside and takes its name by a step that fails where the name is
    taken, a hard link on a local disk, else a rename that overwrites nothing. The
    store's rename has to be atomic, as that of HDFS is.
    """
    fs, target = _hadoop_path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    fs.mkdirs(target.getParent())
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            _rename_once(spark, draft, target)
    except FileExistsError:
        return False
    finally:
        fs.delete(draft, False)
    return True


def _rename_once(spark: SparkSession, draft, target) -> None:
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise FileExistsError(str(target)) from error
        raise


def read_small(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _hadoop_path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Files of a folder whose name is a number, in rising order."""
    fs, hadoop_path = _hadoop_path(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return sorted(int(name) for name in names if name.isdecimal())


@dataclass(frozen=True)
class Claim:
    """The version of a run. `again`: the run was begun before."""

    version: int
    run: str
    again: bool


def claim(spark: SparkSession, folder: str, run: str, *roots: str) -> Claim:
    """The version of a run in the tables `roots`, whose writers share `folder`.

    A run that claims again gets the version it has; any other gets the lowest
    one above all claims and all versions written. Two runs never get the same,
    whenever they claim.
    """
    note = f"{folder}/runs/{hashlib.sha256(run.encode()).hexdigest()[:32]}"
    if path_exists(spark, note):
        return Claim(int(read_small(spark, note)), run, True)
    version = max([next_version(spark, *roots), *(n + 1 for n in _numbers(spark, folder))])
    while not create_once(spark, f"{folder}/{version}", run):
        version += 1
    if not create_once(spark, note, str(version)):
        # the same run, claimed twice at one time, goes on with what was noted first
        version = int(read_small(spark, note))
    return Claim(version, run, False)


@dataclass(frozen=True)
class State:
    """Newest version of a whole-table root, None if there is none, and its commits so far."""

    version: int | None
    commits: int


def state(spark: SparkSession, root: str) -> State:
    """What the last commit says. Versions that no commit names are none: a run may
    have been lost before its commit."""
    found = _numbers(spark, f"{root}/_commits")
    if not found:
        return State(None, 0)
    return State(int(read_small(spark, f"{root}/_commits/{found[-1]}")), found[-1] + 1)


def commit(spark: SparkSession, root: str, version: int, base: State) -> bool:
    """Make `version` the newest state, unless another commit came after `base`."""
    return create_once(spark, f"{root}/_commits/{base.commits}", str(version))


def committed(spark: SparkSession, root: str, version: int) -> bool:
    """Whether some commit has named this version."""
    folder = f"{root}/_commits"
    return any(read_small(spark, f"{folder}/{n}") == str(version) for n in _numbers(spark, folder))


def write_version(df: DataFrame, root: str, version: int, replace: bool = False) -> str:
    """Write a version. One that is committed is another run's and is refused,
    unless `replace` says that the same run is done again."""
    spark, path = df.sparkSession, version_path(root, version)
    if not replace and version in versions(spark, root):
        raise ValueError(f"version {version} of {root} is already written")
    df.write.mode("overwrite").parquet(path)
    return path


def keep_newest(spark: SparkSession, root: str, n: int = 2) -> list[int]:
    """Delete all but the newest `n` states of a table whose newest version is the
    whole table, as a snapshot's is; gives the deleted versions. Versions that no
    commit names yet belong to runs under way and stay."""
    if n < 1:
        raise ValueError("one version must stay")
    folder = f"{root}/_commits"
    numbers = _numbers(spark, folder)
    order = [int(read_small(spark, f"{folder}/{number}")) for number in numbers]
    if not numbers:
        order = versions(spark, root)
    kept = set(order[-n:])
    old = sorted(set(order) - kept)
    for version in old:
        delete_path(spark, version_path(root, version))
    for number in numbers[:-n]:
        delete_path(spark, f"{folder}/{number}")
    return old


def read_latest(
    spark: SparkSession, root: str, schema: StructType, before: int | None = None
) -> DataFrame:
    """The newest state, or an empty table. `before`: of the versions below it."""
    if before is None:
        newest = state(spark, root).version
    else:
        newest = max(versions(spark, root, before), default=None)
    return read_version(spark, root, schema, newest)


def read_version(
    spark: SparkSession, root: str, schema: StructType, version: int | None
) -> DataFrame:
    """One version, or an empty table for none."""
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(root, version))


def read_all(
    spark: SparkSession, root: str, schema: StructType, without: int | None = None
) -> DataFrame:
    """All written versions but `without`, with the column `version`."""
    found = [version for version in versions(spark, root) if version != without]
    if not found:
        versioned = StructType([*schema.fields, StructField("version", IntegerType())])
        return spark.createDataFrame([], versioned)
    return (
        spark.read.schema(schema)
        .option("basePath", root)
        .parquet(*[version_path(root, v) for v in found])
    )
