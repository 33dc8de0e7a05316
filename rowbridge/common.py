"""Small helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Per thread or task: two jobs in one session keep their staged paths apart.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())

def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Reference a top-level column whatever characters its name holds."""
    return F.col(quoted(name))


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="rowbridge-")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder the cluster names for checkpoints.

    A local session without that setting gets a temporary folder; on a cluster
    the setting is required, because executors do not share local disks.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/rowbridge/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def session_setting(spark: SparkSession, key: str, value: object):
    """A setting changed for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def recorded(paths: list[str]):
    """Add the folders staged inside the block to ``paths``; nothing is deleted."""
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders and forget them; rows that still read them are lost."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        target.getFileSystem(hadoop).delete(target, True)


@contextmanager
def staging(spark: SparkSession):
    """Delete what is staged inside the block when it ends.

    For work that is complete by then, such as an export; rows handed on lazily
    still need their staged files.
    """
    paths: list[str] = []
    try:
        with recorded(paths):
            yield
    finally:
        drop_staged(spark, paths)


def staged_path(spark: SparkSession, purpose: str) -> str:
    """A scratch path that is deleted with what else is staged in the block."""
    path = scratch_path(spark, purpose)
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return path


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files."""
    path = staged_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_rows(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A few driver-side rows as a relation whose size Catalyst knows."""
    return spark.createDataFrame(pa.table(columns)).to(T.StructType.fromDDL(schema))


def row_hash(df: DataFrame) -> Column:
    """Hash of the whole row: spreads equal sort keys and settles ties."""
    cells = [
        F.to_json(F.struct(column(f.name))) if "map<" in f.dataType.simpleString() else column(f.name)
        for f in df.schema.fields
    ]
    return F.xxhash64(*cells)
