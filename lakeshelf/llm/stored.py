"""Intermediate tables written to the shared scratch folder, so that a lost executor costs one stage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def parts_for(docs: DataFrame, text: str = "text", part_bytes: int = 4 << 20) -> int:
    """How many parts of about ``part_bytes`` the texts make; at least one per shuffle partition."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // part_bytes))


#: Bytes of an Arrow batch. Spark's own limit lets ten thousand texts, or pairs of them, be one batch, held by the executor and its worker at once.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the package's modules to the Python workers, once per application; they need not have it installed.

    The session's Arrow batches get a limit in bytes, unless it has one.
    """
    name, size = BATCH
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, size)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="lakeshelf-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
