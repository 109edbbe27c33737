"""What the operators of this folder have in common."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The id that stands for a null id inside operators; results show null again.
NO_ID = -(1 << 63)
_folders: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where that is unset, on one machine only (as in tests), one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="sitesieve-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def folder(spark: SparkSession, name: str) -> str:
    """A name for a new folder in the shared folder, which goes when the driver's program ends, if not before."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _folders[path] = spark
    return path


def discard(path: str) -> None:
    """Deletes a folder that folder() named, with Spark's own file system."""
    spark = _folders.pop(path, None)
    if spark is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _discard_all() -> None:
    for path in list(_folders):
        with contextlib.suppress(Exception):  # the JVM may be gone already
            discard(path)


def cut(df: DataFrame) -> DataFrame:
    """df, computed and kept as a table in the shared folder, where it outlives executors."""
    return kept(df)[0]


def kept(df: DataFrame) -> tuple[DataFrame, str]:
    """The same, and the table's folder, which discard() can delete as soon as nothing reads it any more."""
    path = folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def rest_of(docs: DataFrame, *but: str) -> list:
    """A struct `rest` of all columns except those named: an operator's own columns cannot clash with them."""
    names = [c for c in docs.columns if c not in but]
    return [F.struct(*[F.col(f"`{c}`") for c in names]).alias("rest")] if names else []


def fold_of(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5: the fold that contracts hold out by. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5
