"""The nine stages as functions of tables: lazy frames in, lazy frames out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ibd, reports, samples, stats, variants
from ..sources import fasta
from .workflow import Thresholds


#: The strand's other side.
OTHER = ("ACGT", "TGCA")


def oriented(sites: DataFrame) -> DataFrame:
    """One row per ALT of array sites(bpm_index, chrom, pos, ref, alt[, allele_a, allele_b]) with the number of its copies in the A and in the B allele.

    The alleles of a site are those of its manifest; where they are not named, A is REF and B the one ALT.  Alleles that the
    site has only on the other strand are turned round.  ``a_copies`` is null where they are not told or are none of
    the site's: its calls are no-calls."""
    alts, one = F.split("alt", ","), F.size(F.split("alt", ",")) == 1
    given = lambda c: F.col(c) if c in sites.columns else F.lit(None).cast("string")
    a, b = F.coalesce(given("allele_a"), F.when(one, F.col("ref"))), F.coalesce(given("allele_b"), F.when(one, F.col("alt")))
    known = F.concat(F.array("ref"), alts)
    here = lambda x, y: F.array_contains(known, x) & F.array_contains(known, y)
    turned = [F.reverse(F.translate(x, *OTHER)) for x in (a, b)]
    pick = lambda x, y: F.when(here(a, b), x).when(here(*turned), y)
    named = sites.withColumns({"a_": pick(a, turned[0]), "b_": pick(b, turned[1])})
    split = variants.split_multiallelic(named).drop("allele")
    return split.withColumns({"a_copies": (F.col("a_") == F.col("alt")).cast("int"), "b_copies": (F.col("b_") == F.col("alt")).cast("int")}).drop("a_", "b_", "allele_a", "allele_b")


def allele_count() -> Column:
    """The dosage of a row's ALT by the genotype (1 AA, 2 AB, 3 BB, 0 no-call) and its copies in A and B."""
    a, b = F.col("a_copies"), F.col("b_copies")
    return F.when(F.col("gt") == 1, 2 * a).when(F.col("gt") == 2, a + b).when(F.col("gt") == 3, 2 * b).cast("tinyint")


def plate_calls(intensity: DataFrame, sites: DataFrame, names: DataFrame, bases: DataFrame | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(heavy, light) calls of a plate: intensities meet their sites(bpm_index, chrom, pos, ref, alt[, allele_a, allele_b]) and samples get their ids.

    A site with several ALT alleles becomes one per allele, with the dosage of that allele.  With the reference sequence, a FASTA
    file with its index or ``bases(chrom, pos, base)``, sites with another REF go; by the file, indels also take their normal form.
    """
    sites = oriented(sites)
    if isinstance(bases, str):
        sites = fasta.normalised(sites, bases)
    elif bases is not None:
        sites = variants.matching_reference(sites, bases)
    heavy = intensity.join(sites, "bpm_index").withColumn("dosage", allele_count()).drop("a_copies", "b_copies")
    heavy = heavy.withColumn("variant_id", F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt"))
    heavy = samples.rename(heavy.withColumn("gq", F.round(F.col("score") * 100).cast("int")), names)
    return heavy, heavy.select("chrom", "pos", "ref", "alt", "variant_id", "sample_id", "dosage", "gq", "bpm_index")


def contamination(heavy: DataFrame, af: DataFrame | None = None) -> DataFrame:
    """BAF regression per sample, on a reference's frequencies or else on the plate's own."""
    if af is not None:
        sites = variants.with_frequency(heavy, af).filter("af IS NOT NULL")
    else:
        own = stats.allele_frequency(heavy).select("variant_id", F.col("alt_freq").alias("af"))
        sites = heavy.join(own, "variant_id")
    return stats.baf_regression(sites)


def plate_fileset(light: DataFrame) -> DataFrame:
    """Biallelic calls, PAR split, canonical ids, repeated ids dropped in all copies, chr-prefixed contigs."""
    out = variants.canonical_ids(variants.split_par(variants.biallelic(light)))
    return variants.without_repeated_ids(out.withColumn("chrom", variants.chr_prefixed(F.col("chrom"))))


def raw_qc(calls: DataFrame, people: DataFrame, min_samples: int = 50) -> dict[str, DataFrame]:
    autosomes = calls.filter(F.col("chrom").rlike("^chr([1-9]|1[0-9]|2[0-2])$"))
    by_ploidy = stats.with_ploidy(calls, people)
    return {
        "smiss": stats.cohort_missingness(calls, "sample_id"), "afreq": stats.allele_frequency(by_ploidy, F.col("ploidy")), "het": stats.inbreeding(autosomes, min_samples),
        "sexcheck": stats.sex_check(calls, people),
    }


def recoded(calls: DataFrame) -> DataFrame:
    """Contigs as the numbers that relatedness goes by: 1 to 22, X 23, Y 24, XY 25, MT 26."""
    return calls.withColumn("chrom", variants.numeric_contig(F.col("chrom")))


def autosomal_segments(calls: DataFrame, min_snps: int = 64, min_bp: int = 2_500_000) -> DataFrame:
    auto = calls.filter(F.col("chrom").rlike("^(chr)?([1-9]|1[0-9]|2[0-2])$"))
    return ibd.all_segments(auto, {1: min_snps, 2: min_snps}, min_bp)


def relatedness(calls: DataFrame, genome_length: int, min_snps: int = 64, min_bp: int = 2_500_000) -> DataFrame:
    return ibd.relatives(ibd.sharing(autosomal_segments(calls, min_snps, min_bp), genome_length))


def tested_variants(calls: DataFrame, people: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """ID, F_MISS and pass_hwe of all variants: the calls are aggregated once, those of chromosome X once more by sex.

    Chromosome X is tested by sex, haploid contigs (Y, M) are untested, all others are diploid.
    """
    bare = F.regexp_replace("chrom", "^chr", "")
    on_x, haploid = bare.isin("X", "23"), bare.isin("Y", "24", "M", "MT", "26")
    counted = stats.variant_profile(calls, cohort=True, diploid=~on_x & ~haploid, midp=t.midp)
    keeps = stats.hwe_keeps(t.hwe_p, t.hwe_k, t.keep_few_het)
    x = stats.hardy_weinberg_x(calls.filter(on_x), people, t.midp).select(F.col("variant_id").alias("x_id"), keeps.alias("x_keeps"))
    both = counted.join(x, F.col("variant_id") == F.col("x_id"), "left")
    return both.select(F.col("variant_id").alias("ID"), F.col("f_miss").alias("F_MISS"), F.when(on_x, F.col("x_keeps")).when(haploid, True).otherwise(keeps).alias("pass_hwe"))


def snp_qc(calls: DataFrame, people: DataFrame, egt: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Missingness and the exact test both see the full variant set; the filters meet only in the flags."""
    return reports.variant_qc_of(egt, tested_variants(calls, people, t), gentrain_min=t.gentrain_min, cluster_sep_min=t.cluster_sep_min, fmiss_max=t.fmiss_max)
