"""Sample transforms: rename, sex, remove, keep, merge of plates, complete grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(calls: DataFrame, names: DataFrame) -> DataFrame:
    """Rename samples by ``names(old_name, sg_id)``; samples without a new name keep theirs."""
    out = calls.join(names.select(F.col("old_name").alias("sample_id"), "sg_id"), "sample_id", "left")
    return out.withColumn("sample_id", F.coalesce("sg_id", "sample_id")).drop("sg_id").select(calls.columns)


def update_sex(samples: DataFrame, sex: DataFrame) -> DataFrame:
    """Set sex from ``sex(sample_id, sex)``; all others are unknown (0)."""
    new = sex.select("sample_id", F.col("sex").alias("sex_"))
    return samples.drop("sex").join(new, "sample_id", "left").withColumn("sex", F.coalesce("sex_", F.lit(0))).drop("sex_")


def remove(calls: DataFrame, gone: DataFrame) -> DataFrame:
    return calls.join(gone.select("sample_id").distinct(), "sample_id", "left_anti").select(calls.columns)


def keep(calls: DataFrame, wanted: DataFrame, check: bool = True) -> DataFrame:
    """Trim to ``wanted(sample_id)``; with ``check`` every distinct wanted sample must be there."""
    wanted = wanted.select("sample_id").filter("sample_id IS NOT NULL").distinct()
    if check:
        expected = wanted.count()
        if not expected:
            raise ValueError("the list of samples to keep is empty")
        kept = calls.select("sample_id").distinct().join(wanted, "sample_id", "left_semi").count()
        if kept != expected:
            raise ValueError(f"kept {kept} samples, expected {expected}")
    return calls.join(wanted, "sample_id", "left_semi").select(calls.columns)


def complete_grid(calls: DataFrame) -> DataFrame:
    """Every variant with every sample: a variant that a plate lacks is a no-call of its samples.

    Samples of a plate share their variants, so the grid is built from the arrays of samples per variant, not from a
    product of two tables: each variant carries the list of all samples once and explodes it.
    """
    samples = calls.agg(F.array_sort(F.collect_set("sample_id")).alias("all_"))
    own = calls.groupBy("variant_id").agg(F.map_from_entries(F.collect_list(F.struct("sample_id", "dosage"))).alias("own_"))
    grid = own.withColumn("all_", samples.scalar())
    return grid.select("variant_id", "own_", F.explode("all_").alias("sample_id")).select("variant_id", "sample_id", F.try_element_at("own_", F.col("sample_id")).alias("dosage"))


def merge_plates(plates: list[DataFrame]) -> DataFrame:
    """Union of plates with disjoint samples; one plate passes through, none is an error, a call that two plates hold is an error."""
    if not plates:
        raise ValueError("nothing to merge")
    if len(plates) == 1:
        return plates[0]
    owners = reduce(DataFrame.unionByName, [p.select("sample_id").distinct().withColumn("plate", F.lit(i)) for i, p in enumerate(plates)])
    twice = owners.groupBy("sample_id").agg(F.count("*").alias("n")).filter("n > 1").orderBy("sample_id").limit(5).collect()
    if twice:
        raise ValueError(f"samples on more than one plate: {', '.join(str(r.sample_id) for r in twice)}")
    return reduce(DataFrame.unionByName, plates)


def rolling_merge(previous: DataFrame | None, gone: DataFrame | None, plates: list[DataFrame], wanted: DataFrame) -> DataFrame:
    """Remove the withdrawn from the carried aggregate, merge the plates, trim to the cohort: in that order."""
    carried = [] if previous is None else [remove(previous, gone) if gone is not None else previous]
    return keep(merge_plates([*carried, *plates]), wanted)
