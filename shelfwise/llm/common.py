"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_folder

#: Rows in one Arrow batch that goes to a Python worker.  A batch holds whole
#: texts, so the number is small enough that a batch of very long texts fits.
BATCH_ROWS = 512
#: Bytes in one Arrow batch, where the running Spark knows the setting.
BATCH_BYTES = 32 << 20


#: Folder that holds the package, for Python workers on the driver's machine.
#: On a cluster the package is installed or sent with ``--py-files``.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def python_workers(spark: SparkSession) -> None:
    """Prepare for Python workers: they find this package, and Arrow batches
    of texts are small unless the session already has smaller ones."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, env.get("PYTHONPATH")]))
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        digits = str(now or "").rstrip("bB")
        if not digits.isdigit() or int(digits) > most or int(digits) <= 0:
            spark.conf.set(key, str(most))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files,
    so that a lost executor costs no recomputation of what came before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """Like ``cut``, by way of a Parquet table: compressed, and read by column."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, apart from any name added later."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def text_key(text: Column) -> list[Column]:
    """A 128-bit key of a text as two longs ``k1`` and ``k2`` (two differently
    seeded hashes).  Null has the key of null, which no text has."""
    return [F.when(text.isNotNull(), F.xxhash64(text)).otherwise(F.lit(0)).alias("k1"),
            F.when(text.isNotNull(), F.xxhash64(F.lit(1), text)).otherwise(F.lit(0)).alias("k2")]


#: Rows of a side that may be broadcast, for rows of a few dozen bytes.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Mark ``df`` (``rows`` narrow rows, as counted) for broadcast when it is
    small enough; larger sides are joined by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
