"""Helpers shared by the operators: tables, scratch tables, session settings."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import estatelens
from estatelens.session import checkpoint_dir

#: Rows per Arrow batch handed to a Python task. Documents reach 120 kB and
#: more, so the default of 10,000 rows could hold over a gigabyte.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Before an operator with Python tasks: bound an Arrow batch and send this package to the executors, once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = Path(estatelens.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="package-"), "estatelens_package.zip")
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(str(target))          # the driver serves it to executors, also to those that join later
        _SHIPPED.add(context.applicationId)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def scratch(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: every executor reads the same committed files, so a lost
    executor costs a reread and not a recomputation. Compressed by zstandard,
    as texts pass through here.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def larger(batches: Iterator[pa.RecordBatch], size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in batches of about ``size`` bytes; one row may be larger."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
