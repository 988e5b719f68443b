"""A sink that takes each key once and each batch once.

Rows lie in folders by bucket of their key and by batch. A batch looks for its keys in its own buckets only; it
writes over what an earlier try of the same batch has left; and it counts once its number is in the ledger,
the last thing it writes. Readers see the batches of the ledger alone, so a batch that failed half-way is
not seen, and when it comes again it is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET, BATCH = "sink_bucket", "sink_batch"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """None if nothing was written yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.parquet(path)


def batches(spark: SparkSession, path: str) -> DataFrame | None:
    """sink_batch of the batches that are whole."""
    found = _read(spark, f"{path}/ledger")
    return None if found is None else found.select(F.col(BATCH).cast("long").alias(BATCH)).distinct()


def rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of whole batches; None before the first."""
    done, data = batches(spark, path), _read(spark, f"{path}/rows")
    if done is None or data is None:
        return None
    return data.withColumn(BATCH, F.col(BATCH).cast("long")).join(done, BATCH, "left_semi").drop(BUCKET, BATCH)


def ledgered_sink(path: str, key: str = "UniqueKey", buckets: int = 256):
    """foreachBatch function. Of equal keys in a batch the row of the greatest hash stays; a null key is a key like any other."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = batches(spark, path)
        if done is not None and not done.where(F.col(BATCH) == number).isEmpty():
            return
        whole = F.struct(*[F.col(c) for c in batch.columns])
        own = batch.groupBy(F.col(key).alias("sink_key")).agg(F.max_by(whole, F.xxhash64(*batch.columns)).alias("row")).select("row.*")
        own = own.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
        data = _read(spark, f"{path}/rows")
        if done is not None and data is not None:
            touched = [r[0] for r in own.select(BUCKET).distinct().collect()]  # numbers of buckets: no more than there are
            known = data.where(F.col(BUCKET).isin(touched) & (F.col(BATCH) != number)).withColumn(BATCH, F.col(BATCH).cast("long")).join(done, BATCH, "left_semi").select(F.col(key).alias("known_key"), F.col(BUCKET).alias("known_bucket"))
            own = own.join(known, (F.col(BUCKET) == F.col("known_bucket")) & F.col(key).eqNullSafe(F.col("known_key")), "left_anti")
        own.withColumn(BATCH, F.lit(number).cast("long")).repartition(F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(f"{path}/rows")
        spark.range(1).select(F.lit(number).cast("long").alias(BATCH), F.current_timestamp().alias("at")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{path}/ledger")

    return write
