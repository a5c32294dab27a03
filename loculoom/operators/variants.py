"""Variant transforms on (chrom, pos, ref, alt, variant_id, ...) frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import variant_id

#: hg38 pseudo-autosomal regions of chrX (GRC): first and last position.
PAR1_X, PAR2_X = (10_001, 2_781_479), (155_701_383, 156_030_895)
CONTIG_CODES = {"X": "23", "Y": "24", "XY": "25", "PAR1": "25", "PAR2": "25", "M": "26", "MT": "26"}


def canonical_ids(df: DataFrame, column: str = "variant_id") -> DataFrame:
    """Rewrite ids that differ from CHROM:POS:REF:ALT."""
    want = variant_id()
    return df.withColumn(column, F.when(~F.col(column).eqNullSafe(want), want).otherwise(F.col(column)))


def split_multiallelic(df: DataFrame, dosage: str | None = None) -> DataFrame:
    """One row per ALT allele; ``dosage``, if named, is an array of allele numbers per call that is recoded to this allele's count."""
    out = df.select("*", F.posexplode(F.split("alt", ",")).alias("allele", "alt_")).withColumn("alt", F.col("alt_")).drop("alt_").withColumn("allele", F.col("allele") + 1)
    if dosage:
        known = F.forall(dosage, lambda x: x.isNotNull())
        out = out.withColumn(dosage, F.when(known, F.size(F.filter(dosage, lambda x: x == F.col("allele")))))
    return out


def matching_reference(df: DataFrame, bases: DataFrame) -> DataFrame:
    """Variants whose REF agrees with ``bases(chrom, pos, base)``, the reference sequence that starts there."""
    return df.join(bases, ["chrom", "pos"]).filter(F.col("base").startswith(F.col("ref"))).drop("base")


def biallelic(df: DataFrame) -> DataFrame:
    return df.filter(F.size(F.split("alt", ",")) == 1)


def exclude_duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Drop every copy of a repeated key, keeping none."""
    keys = keys or ("variant_id",)
    return df.withColumn("copies_", F.count("*").over(Window.partitionBy(*keys))).filter("copies_ = 1").drop("copies_")


def without_repeated_ids(calls: DataFrame) -> DataFrame:
    """Drop all calls of a variant id that stands for several records: a sample with two calls, or (``bpm_index``) two array positions."""
    per = calls.groupBy("variant_id", "sample_id").agg(F.count("*").alias("n"), *([F.min("bpm_index").alias("a"), F.max("bpm_index").alias("b")] if "bpm_index" in calls.columns else []))
    records = F.lit(True) if "bpm_index" not in calls.columns else F.min("a").eqNullSafe(F.max("b"))
    once = per.groupBy("variant_id").agg(((F.max("n") == 1) & records).alias("once")).filter("once").select("variant_id")
    return calls.join(once, "variant_id", "left_semi").select(calls.columns)


def split_par(df: DataFrame) -> DataFrame:
    """chrX positions of the pseudo-autosomal regions become PAR1 and PAR2."""
    x = F.col("chrom").isin("chrX", "X", "23")
    return df.withColumn("chrom", F.when(x & F.col("pos").between(*PAR1_X), "PAR1").when(x & F.col("pos").between(*PAR2_X), "PAR2").otherwise(F.col("chrom")))


def chr_prefixed(chrom: Column) -> Column:
    """chr1..chr22, chrX, chrY, chrM; other contigs pass unchanged."""
    bare = F.regexp_replace(chrom, "^chr", "")
    name = F.when(bare.isin("MT", "26"), "M").when(bare == "23", "X").when(bare == "24", "Y").otherwise(bare)
    return F.when(name.rlike("^([1-9]|1[0-9]|2[0-2]|X|Y|M)$"), F.concat(F.lit("chr"), name)).otherwise(chrom)


def numeric_contig(chrom: Column) -> Column:
    """1..22, X 23, Y 24, XY 25, MT 26; other contigs pass unchanged."""
    bare = F.regexp_replace(chrom, "^chr", "")
    codes = F.create_map(*[x for k, v in CONTIG_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(codes, bare), F.when(bare.rlike("^([1-9]|1[0-9]|2[0-6])$"), bare), chrom)


def with_frequency(calls: DataFrame, af: DataFrame) -> DataFrame:
    """Annotate by site with ``af(chrom, pos, ref, alt, af)``; the optimizer broadcasts it where its size allows."""
    return calls.join(af.select("chrom", "pos", "ref", "alt", "af"), ["chrom", "pos", "ref", "alt"], "left")
