"""Statistics of calls(variant_id, sample_id, dosage): dosage counts ALT alleles, null is a no-call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hwe_exact, passes
from .hwe_x import hwe_x


def missingness(calls: DataFrame, by: str) -> DataFrame:
    """missing_ct, obs_ct and f_miss per variant or per sample."""
    out = calls.groupBy(by).agg((F.count("*") - F.count("dosage")).alias("missing_ct"), F.count("*").alias("obs_ct"))
    return out.withColumn("f_miss", F.col("missing_ct").cast("double") / F.col("obs_ct"))


def cohort_missingness(calls: DataFrame, by: str) -> DataFrame:
    """``missingness`` over every variant of every sample: what the calls do not list (a variant that a plate lacks) is a no-call.

    Rows of calls are unique by variant and sample, so counts against the cohort's size do, and no grid is built.
    """
    other = "variant_id" if by == "sample_id" else "sample_id"
    size = calls.agg(F.count_distinct(other).alias("n")).scalar()
    out = calls.groupBy(by).agg(F.count("dosage").alias("called")).withColumn("obs_ct", size)
    out = out.select(by, (F.col("obs_ct") - F.col("called")).alias("missing_ct"), "obs_ct")
    return out.withColumn("f_miss", F.col("missing_ct").cast("double") / F.col("obs_ct"))


def with_ploidy(calls: DataFrame, people: DataFrame) -> DataFrame:
    """Calls(chrom, ...) with ploidy by ``people(sample_id, sex)``: 1 on chrX of males, chrY of males and chrM, 0 on chrY of females, else 2.

    Haploid dosages are counted in alleles (0 or 1); a heterozygous haploid call and a call without ploidy are no-calls.
    """
    sex = people.select("sample_id", F.col("sex").cast("int").alias("sex_"))
    male, chrom = F.coalesce(F.col("sex_") == 1, F.lit(False)), F.regexp_replace("chrom", "^chr", "")
    haploid = (chrom.isin("X", "23") & male) | (chrom.isin("Y", "24") & ~F.coalesce(F.col("sex_") == 2, F.lit(False))) | chrom.isin("M", "MT", "26")
    out = calls.join(sex, "sample_id", "left").withColumn("ploidy", F.when(haploid, 1).when(chrom.isin("Y", "24"), 0).otherwise(2))
    dosage = F.when(F.col("ploidy") == 2, F.col("dosage")).when((F.col("ploidy") == 1) & (F.col("dosage") != 1), (F.col("dosage") / 2).cast("int"))
    return out.withColumn("dosage", dosage).drop("sex_")


def allele_frequency(calls: DataFrame, ploidy: Column | None = None) -> DataFrame:
    """alt_freq and obs_ct (alleles) per variant; ploidy is 2 unless given per call (dosage then counts 0..ploidy)."""
    alleles = F.when(F.col("dosage").isNotNull(), F.lit(2) if ploidy is None else ploidy)
    out = calls.groupBy("variant_id").agg(F.sum("dosage").alias("alt_ct"), F.coalesce(F.sum(alleles), F.lit(0)).alias("obs_ct"))
    return out.withColumn("alt_freq", F.when(F.col("obs_ct") > 0, F.col("alt_ct").cast("double") / F.col("obs_ct"))).select("variant_id", "obs_ct", "alt_freq")


def inbreeding(calls: DataFrame, min_samples: int = 0) -> DataFrame:
    """o_hom, e_hom, n_nm and f per sample over the calls given (autosomes, or chrX for sex checks).

    Fewer distinct samples than ``min_samples`` are refused: frequencies are then too uncertain.
    """
    if min_samples and (n := calls.select("sample_id").distinct().count()) < min_samples:
        raise ValueError(f"{n} samples; at least {min_samples} are needed")
    called = calls.filter(F.col("dosage").isNotNull())
    p = allele_frequency(called).select("variant_id", "alt_freq")
    e = F.lit(1.0) - F.lit(2.0) * F.col("alt_freq") * (F.lit(1.0) - F.col("alt_freq"))
    out = called.join(p, "variant_id").groupBy("sample_id").agg(F.count_if(F.col("dosage") != 1).alias("o_hom"), F.sum(e).alias("e_hom"), F.count("*").alias("n_nm"))
    rest = F.col("n_nm") - F.col("e_hom")
    return out.withColumn("f", F.when(F.abs(rest) > 1e-9, (F.col("o_hom") - F.col("e_hom")) / rest))


def sex_check(calls: DataFrame, samples: DataFrame, female_xf: float = 0.25, male_xf: float = 0.75, female_y: int = 100, male_y: int = 1000) -> DataFrame:
    """Sex from chrX inbreeding and chrY calls against ``samples(sample_id, sex)``; calls carry chrom ('chrX', 'chrY').

    1 male, 2 female, 0 unknown; the status is OK if both sexes are known and equal.
    """
    x = inbreeding(calls.filter("chrom = 'chrX'")).select("sample_id", F.col("f").alias("xf"))
    y = calls.filter("chrom = 'chrY'").groupBy("sample_id").agg(F.count("dosage").alias("ycount"), F.count("*").alias("yall"))
    both = samples.select("sample_id", F.col("sex").cast("int").alias("pedsex")).join(x, "sample_id", "left").join(y, "sample_id", "left")
    both = both.withColumn("ycount", F.coalesce("ycount", F.lit(0))).withColumn("yrate", F.when(F.col("yall") > 0, F.col("ycount").cast("double") / F.col("yall")))
    sex = F.when(passes((F.col("xf") <= female_xf) & (F.col("ycount") <= female_y), F.col("xf")), 2).when(passes((F.col("xf") >= male_xf) & (F.col("ycount") >= male_y), F.col("xf")), 1).otherwise(0)
    both = both.withColumn("snpsex", sex)
    status = F.when((F.col("snpsex") != 0) & (F.col("snpsex") == F.col("pedsex")), "OK").otherwise("PROBLEM")
    return both.select("sample_id", "pedsex", "snpsex", status.alias("status"), "xf", "ycount", "yrate")


def genotype_counts(calls: DataFrame) -> DataFrame:
    return calls.groupBy("variant_id").agg(*[F.count_if(F.col("dosage") == k).alias(c) for k, c in enumerate(("hom_ref", "het", "hom_alt"))])


def variant_profile(calls: DataFrame, cohort: bool = False, diploid: Column | None = None, midp: bool = True) -> DataFrame:
    """Missingness, genotype counts and exact test per variant out of one aggregation of the calls.

    With ``cohort`` calls count against the cohort's size as in ``cohort_missingness``; ``diploid``, if given, tells by ``chrom`` which variants are tested.
    """
    chrom = [] if diploid is None else [F.min("chrom").alias("chrom")]
    out = calls.groupBy("variant_id").agg(*chrom, F.count("*").alias("obs_ct"), *[F.count_if(F.col("dosage") == k).alias(c) for k, c in enumerate(("hom_ref", "het", "hom_alt"))])
    if cohort:
        out = out.withColumn("obs_ct", calls.agg(F.count_distinct("sample_id").alias("n")).scalar())
    out = out.withColumn("missing_ct", F.col("obs_ct") - F.col("hom_ref") - F.col("het") - F.col("hom_alt"))
    out = out.withColumn("f_miss", F.col("missing_ct").cast("double") / F.col("obs_ct"))
    p = hwe_exact(F.col("hom_ref"), F.col("het"), F.col("hom_alt"), midp)
    return out.withColumn("p_hwe", p if diploid is None else F.when(diploid, p))


def hardy_weinberg(calls: DataFrame, midp: bool = True) -> DataFrame:
    """Genotype counts and exact test per variant (p is null without calls)."""
    return genotype_counts(calls).withColumn("p_hwe", hwe_exact(F.col("hom_ref"), F.col("het"), F.col("hom_alt"), midp))


def hardy_weinberg_x(calls: DataFrame, people: DataFrame, midp: bool = True) -> DataFrame:
    """Female genotype counts, male allele counts and the exact test for chromosome X per variant; samples of unknown sex do not count.

    The test takes females and males together: how many ALT alleles the males hold and how many females are heterozygous, given
    all ALT alleles.  It runs once per distinct set of counts, in Arrow batches.
    """
    sex = people.select("sample_id", F.col("sex").cast("int").alias("sex"))
    known = calls.select("variant_id", "sample_id", "dosage").join(sex, "sample_id", "left")
    female = [F.count_if((F.col("sex") == 2) & (F.col("dosage") == k)).alias(c) for k, c in enumerate(("hom_ref", "het", "hom_alt"))]
    # a heterozygous male call is none
    male = [F.count_if((F.col("sex") == 1) & (F.col("dosage") == k)).alias(c) for k, c in ((0, "male_ref"), (2, "male_alt"))]
    counts = known.groupBy("variant_id").agg(*female, *male)
    keys = ["hom_ref", "het", "hom_alt", "male_ref", "male_alt"]
    tested = hwe_x(counts.select(*keys).distinct(), midp)
    return counts.join(tested, keys).select("variant_id", *keys, "p_hwe")


def hwe_keeps(p: float = 1e-5, k: float = 0.001, keep_few_het: bool = True) -> Column:
    """Whether a tested variant stays: p-value of at least p * 10^(-n * k), or (keep_few_het) no more heterozygotes than expected; untested ones stay."""
    n = F.col("hom_ref") + F.col("het") + F.col("hom_alt")
    alt = (2 * F.col("hom_alt") + F.col("het")).cast("double")
    expected = F.when(n > 0, alt * (2 * n - alt) / (2 * n))
    keep = F.col("p_hwe") >= F.lit(p) * F.pow(F.lit(10.0), -n * F.lit(k))
    if keep_few_het:
        keep = keep | (F.col("het") <= expected)
    return F.coalesce(keep, F.lit(True))


def hwe_pass(tested: DataFrame, p: float = 1e-5, k: float = 0.001, keep_few_het: bool = True) -> DataFrame:
    """The variants that ``hwe_keeps`` keeps."""
    return tested.filter(hwe_keeps(p, k, keep_few_het)).select("variant_id")


def baf_regression(sites: DataFrame) -> DataFrame:
    """Contamination per sample: the slope of BAF on allele frequency at homozygous sites(sample_id, dosage, baf, af), BB sites folded."""
    folded = sites.filter(F.col("dosage").isin(0, 2)).withColumn("y", F.when(F.col("dosage") == 0, F.col("baf")).otherwise(1.0 - F.col("baf")))
    folded = folded.withColumn("x", F.when(F.col("dosage") == 0, F.col("af")).otherwise(1.0 - F.col("af")))
    return folded.groupBy("sample_id").agg(F.regr_slope("y", "x").alias("contamination"), F.regr_intercept("y", "x").alias("drift"), F.regr_count("y", "x").alias("n_sites"))
