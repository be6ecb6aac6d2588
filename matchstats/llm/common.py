"""Helpers the operators share: reading tables, written intermediates, keys of texts."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable
from functools import cache, wraps
from pathlib import Path

import matchstats
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.session import ADAPTIVE_SETTINGS, scratch_folder

ID, TEXT = "doc_id", "text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read from there: later steps neither
    compute them again nor depend on executors that may be lost."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column | str) -> Column:
    """16 bytes that stand for a whole text, NULL for NULL."""
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's decimal text leaves the remainder; that of a NULL id never does."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


@cache
def _sent(application: str) -> str:
    """An archive of the package, which Spark's file server hands from the driver to executors."""
    package = Path(matchstats.__file__).parent
    path = Path(tempfile.mkdtemp()) / "matchstats.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    return str(path)


#: Bytes that a Python worker is given at a time; a long text may be more.
BATCH_BYTES = 8 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def release() -> None:
    """Give memory back that a task of a Python worker no longer needs; other tasks use the worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, with the package sent to the executors first, which need not have it installed, and
    with batches for Python workers bounded in this session, where shuffle files go with the job that
    wrote them: what a later one needs is ``saved``."""

    @wraps(query)
    def run(spark: SparkSession, *rest: object) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        spark.conf.set(CLEANUP, ADAPTIVE_SETTINGS[CLEANUP])
        spark.sparkContext.addPyFile(_sent(spark.sparkContext.applicationId))
        return query(spark, *rest)

    return run
