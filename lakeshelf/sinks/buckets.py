"""Tables laid out by their join key, so that joins on it shuffle nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a bucket; a task of a join reads one bucket of each side.
BUCKET_BYTES = 128 << 20


def buckets_for(table_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The number of buckets for a table: a power of two, so that of two tables one number divides the other.

    A join of tables with different numbers reads several buckets of the finer one together, up to the ratio of
    ``spark.sql.bucketing.coalesceBucketsInJoin.maxBucketRatio`` (4 by default) and only if
    ``spark.sql.bucketing.coalesceBucketsInJoin.enabled`` is set; otherwise the coarser table is shuffled.
    """
    return 1 << max(0, -(-table_bytes // bucket_bytes) - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """``df`` as the catalog's ``table`` in ``path``: one file per bucket of ``key``, sorted by it.

    Rows are dealt by the same hash as buckets, so each task writes one bucket; with one sorted file a bucket a
    merge join needs no sort either (``spark.sql.legacy.bucketedTableScan.outputOrdering``). A key with a third of all rows is
    one bucket, which no join can split: sum such a fact by its key first, or join it unbucketed.
    """
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
