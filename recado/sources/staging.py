"""Tables written to the shared folder, where a result is used more than once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from recado.session import scratch_dir

STORED = {"compression": "zstd"}  # of tables that hold texts: what is written and read again is about 0.6 of the default's size

#: Paths staged in the innermost open scope of this thread; every thread (a stream's batch runs in its own) has its own scopes.
_scope: ContextVar[list[str] | None] = ContextVar("scratch scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new scratch folder, which goes with the open `scratch_scope` of this thread, if there is one."""
    path = scratch_dir(spark, name)
    paths = _scope.get()
    if paths is not None:
        paths.append(path)
    return path


def staged_at(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """Write a table and read it back: later steps start from files that outlive any executor. Also gives its path, for `remove`.

    Inside a `scratch_scope` of the same thread the table goes when the scope ends; outside it stays until it is removed. ``options``: of the writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**STORED, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str) -> DataFrame:
    """`staged_at` without the path."""
    return staged_at(df, name)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table that is read no more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread stages inside, at the end: for work that has written its result by then."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            remove(spark, path)
