"""Documents by key for very many keys: a fixed number of buckets, of which only those hit are written again.

A folder per key makes a file per key.  Here a key belongs to a bucket by its hash, so a store has as many
folders as buckets, however many keys it holds.  Documents of new keys are added, those of keys at hand replaced.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievebed.operators.flatten import quoted

_BUCKETS, _BUCKET = "of", "bucket"
_STORED = StructType(
    [
        StructField("document_key", StringType()), StructField("document", StringType()),
        StructField(_BUCKETS, IntegerType()), StructField(_BUCKET, IntegerType()),
    ]
)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_STORED).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def replace_documents(df: DataFrame, path: str, key: str, document: str = "document", buckets: int = 256) -> None:
    """Put documents into a bucketed store; a key's documents at hand take the place of all it had.

    The buckets hit are read, merged and replaced in one job; no other is touched.  A store keeps the number of
    buckets it was made with: choose it so that a bucket suits a task.  A bucket too large for one file is
    split into several.  A null key is a key.
    """
    new = df.select(F.col(quoted(key)).cast("string").alias("document_key"), F.col(quoted(document)).alias("document"))
    new = new.withColumn(_BUCKET, _bucket(F.col("document_key"), buckets))
    stored = _stored(df.sparkSession, path)
    if stored is not None:
        there = stored.select(_BUCKETS).first()
        if there is not None and there[0] != buckets:
            raise ValueError(f"the store there has {there[0]} buckets, not {buckets}")
        # At most as many numbers as there are buckets.
        hit = [row[0] for row in new.select(_BUCKET).distinct().collect()]
        keys = new.select(_BUCKET, F.col("document_key").alias("new_key")).distinct()
        old = stored.where(F.col(_BUCKET).isin(hit)).select("document_key", "document", _BUCKET)
        same = (old[_BUCKET] == keys[_BUCKET]) & old["document_key"].eqNullSafe(keys["new_key"])
        new = old.join(keys, same, "left_anti").unionByName(new)
    # Rows of a bucket come together; one too large for a task is dealt to several.
    laid_out = new.hint("rebalance", _BUCKET).withColumn(_BUCKETS, F.lit(buckets))
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(_BUCKETS, _BUCKET).parquet(path)


def scan_stored(spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """``(document_key, document)`` of a store; of given keys only, whose buckets alone are opened if their number is given."""
    stored = _stored(spark, path)
    if stored is None:
        raise ValueError(f"no store in {path}")
    if keys is not None:
        if buckets is not None:
            wanted = spark.createDataFrame([(key,) for key in keys], "key string").select(_bucket(F.col("key"), buckets))
            stored = stored.where(F.col(_BUCKET).isin([row[0] for row in wanted.distinct().collect()]))
        stored = stored.where(F.col("document_key").isin(keys))
    return stored.select("document_key", "document")
