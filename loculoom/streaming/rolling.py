"""The rolling aggregate as a stream: every sample of a plate that lands is counted once into per-variant totals, and taken off again when it is withdrawn.

A micro-batch adds what it changes as a partial of its own, with a ledger of the samples that it counts (+1) or takes off (-1) and the plate they are on.  What a batch does
follows from the ledger of the batches before it, so a batch that runs again, or a plate or a withdrawal that comes again, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CALLS = "variant_id string, sample_id string, dosage int"
PLATE_CALLS, WITHDRAWN = f"plate string, {CALLS}", "sample_id string"
LEDGER = "sample_id string, plate string, sign int"
TOTALS = ("obs_ct", "missing_ct", "alt_ct", "het_ct")


def variant_totals(calls: DataFrame) -> DataFrame:
    """Additive totals per variant: calls, no-calls, ALT alleles and heterozygotes."""
    return calls.groupBy("variant_id").agg(
        F.count("*").alias("obs_ct"), F.count_if(F.col("dosage").isNull()).alias("missing_ct"), F.coalesce(F.sum("dosage"), F.lit(0)).alias("alt_ct"), F.count_if(F.col("dosage") == 1).alias("het_ct")
    )


def once(calls: DataFrame) -> DataFrame:
    """One row a (plate, sample, variant), whatever lands twice."""
    return calls.groupBy("plate", "sample_id", "variant_id").agg(F.max("dosage").alias("dosage"))


def ledger_before(spark: SparkSession, totals: str, epoch: int) -> DataFrame:
    """sample_id and plate of the samples that are counted before a batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{totals}/ledger")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "sample_id string, plate string")
    rows = spark.read.schema(LEDGER + ", epoch long").parquet(f"{totals}/ledger").filter(F.col("epoch") < epoch)
    return rows.groupBy("sample_id", "plate").agg(F.sum("sign").alias("n")).filter("n > 0").drop("n")


def apply_batch(spark: SparkSession, plates: str, totals: str, batch: DataFrame, epoch: int) -> None:
    """Fold calls and withdrawals (rows without a variant) into ``totals``; plates come first, then withdrawals."""
    held = ledger_before(spark, totals, epoch)
    landed, gone = batch.filter("variant_id IS NOT NULL"), batch.filter("variant_id IS NULL").select("sample_id").distinct()
    # a sample is counted from the first plate (by name) that brings it
    new = landed.groupBy("sample_id").agg(F.min("plate").alias("plate")).join(held.select("sample_id"), "sample_id", "left_anti")
    off = held.unionByName(new).join(gone, "sample_id", "left_semi")
    more = once(landed.join(new, ["sample_id", "plate"], "left_semi"))
    # calls that are taken off are read where they lie, of the withdrawn samples alone
    stored = once(spark.read.schema(PLATE_CALLS).parquet(plates).join(off, ["sample_id", "plate"], "left_semi"))
    less = variant_totals(stored).select("variant_id", *[(-F.col(c)).alias(c) for c in TOTALS])
    variant_totals(more).unionByName(less).write.mode("overwrite").parquet(f"{totals}/partials/epoch={epoch}")
    signed = new.withColumn("sign", F.lit(1)).unionByName(off.withColumn("sign", F.lit(-1)))
    signed.write.mode("overwrite").parquet(f"{totals}/ledger/epoch={epoch}")


def follow(spark: SparkSession, plates: str, withdrawn: str | None, totals: str, checkpoint: str) -> None:
    """Fold what is new in ``plates`` (Parquet of PLATE_CALLS) and ``withdrawn`` (Parquet of sample_id) into ``totals``."""
    stream = spark.readStream.schema(PLATE_CALLS).parquet(plates)
    if withdrawn:
        gone = spark.readStream.schema(WITHDRAWN).parquet(withdrawn)
        stream = stream.unionByName(gone, allowMissingColumns=True)

    def fold(batch: DataFrame, epoch: int) -> None:
        apply_batch(spark, plates, totals, batch, epoch)

    stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, totals: str) -> DataFrame:
    """The totals over all samples that are counted; variants without any are left out."""
    sums = [F.sum(c).alias(c) for c in TOTALS]
    return spark.read.parquet(f"{totals}/partials").groupBy("variant_id").agg(*sums).filter("obs_ct > 0")


def counted(spark: SparkSession, totals: str) -> DataFrame:
    """sample_id and plate of the samples in the totals."""
    return ledger_before(spark, totals, 1 << 62)
