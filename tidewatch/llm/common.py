"""Small helpers the training-data operators share."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word for size counts: what lies between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package: once per application, its sources go out as a zip file."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tidewatch-")) / "tidewatch.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Get ready for Python stages: executors can import the package, and an Arrow batch holds few rows, as texts can be long."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stream_bytes(table: pa.Table) -> bytes:
    """An Arrow table as one piece, to broadcast."""
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    return out.getvalue()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def named(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, so that extra columns never clash with ours."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name
