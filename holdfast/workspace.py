"""Where intermediate tables live.

Iterative fits and multi-pass evaluations write their input once and read it back, so
that losing an executor costs a re-read of some files and not a rerun of the whole job.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders that local sessions named, by application; they go with the process.
_named: dict[str, tempfile.TemporaryDirectory] = {}


def use_local_folder(spark: SparkSession) -> None:
    """Name a temporary folder for a local session that has no ``spark.checkpoint.dir``.

    On a cluster this is refused, because a folder on one machine is not shared.
    """
    if spark.conf.get("spark.checkpoint.dir", None):
        return
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(
            "spark.checkpoint.dir must name a folder that every executor can reach"
        )
    application = spark.sparkContext.applicationId
    if application not in _named:
        _named[application] = tempfile.TemporaryDirectory(
            prefix="holdfast-", ignore_cleanup_errors=True
        )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or by ``use_local_folder``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    named = _named.get(spark.sparkContext.applicationId)
    if named is None:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return named.name


def new_path(spark: SparkSession, name: str) -> str:
    """A path for a table of this application, see ``clear``."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/holdfast/{application}/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As :func:`materialize`, for as long as the block lasts."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path.rpartition("/")[0])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_path`` named, on whatever file system it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has stored. Results that were not written
    elsewhere may still read them, so this comes last."""
    remove(spark, f"{shared_dir(spark)}/holdfast/{spark.sparkContext.applicationId}")


def require_utc(spark: SparkSession) -> None:
    """Times in files and in the feed are UTC, and hours are read off them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"spark.sql.session.timeZone must be UTC, not {zone}")
