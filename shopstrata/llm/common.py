"""Helpers of the training-data operators: worker paths, reliable checkpoints, bounded text batches."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
#: Text that one Python step holds at a time; a single longer text is a step of its own.
STEP_BYTES = 2 << 20


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if configured is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()


def long_id(df: DataFrame) -> Column:
    """``doc_id`` as a long. A cast that changes nothing is left out: it would keep two equal exchanges apart."""
    return F.col("doc_id") if dict(df.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


LOWER_ASCII = {c: c + 32 for c in range(65, 91)}


def steps(batch: pa.RecordBatch, column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts together hold about ``most`` bytes."""
    if not batch.num_rows:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    yield batch.slice(start)
