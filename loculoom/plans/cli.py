"""Command line: runs of the stages by a configuration file, variant and sample reports, listing of aggregates, merge plans and manifests.

``python -m loculoom.plans.cli COMMAND ...`` returns 0, or 1 with a message if an input cannot be read or breaks a rule.
"""

from __future__ import annotations

import argparse
import csv
import io
import sys

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, reports, stats
from ..sources import readers, writers
from . import cohort
from .workflow import load_config


def variant_qc(spark: SparkSession, a: argparse.Namespace) -> None:
    flagged = reports.variant_qc(
        readers.egt_info(spark, a.egt_info_tsv), readers.vmiss(spark, a.merged_vmiss), readers.id_list(spark, a.hwe_pass_snplist),
        gentrain_min=a.gentrain_min, cluster_sep_min=a.cluster_sep_min, fmiss_max=a.fmiss_max,
    )
    writers.variant_qc(flagged, a.output_audit_tsv, a.output_inclusion_list, a.output_summary_tsv)


def related(spark: SparkSession, path: str) -> DataFrame:
    """Relatives by sample; a file of relatives with the header alone gives no rows, whatever its columns."""
    seg = readers.whitespace_table(spark, path)
    if seg.isEmpty():
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in ["IID", *reports.DEGREE_COLUMNS]))
    return reports.relatedness_wide(seg)


def sample_qc(spark: SparkSession, a: argparse.Namespace) -> None:
    smiss, het, sexcheck = (readers.whitespace_table(spark, p) for p in (a.smiss, a.het, a.sexcheck))
    baf = readers.bafregress(spark, a.bafregress)
    report = reports.sample_qc(smiss, het.drop("ord"), sexcheck.drop("ord"), related(spark, a.seg), baf if len(baf.columns) > 1 else None)
    writers.sample_qc(report, a.output)


def aggregates(spark: SparkSession, a: argparse.Namespace) -> None:
    members, analyses = readers.registry(spark, a.registry)
    rows = [r.asDict() for r in catalog.list_aggregates(analyses, members, a.analysis_type).collect()]
    print(catalog.format_listing(rows) if rows else f"no {a.analysis_type}")


def merge_plan(spark: SparkSession, a: argparse.Namespace) -> None:
    members, analyses = readers.registry(spark, a.registry)
    everyone = members.filter(F.col("cohort_id") == a.cohort).select("sg_id")
    if everyone.isEmpty():
        raise ValueError(f"{a.cohort} is missing or empty")
    # the merged cohort itself has no plate fileset, so it takes no part in the search for plates
    plan = catalog.merge_plan(members, analyses, everyone, a.previous)
    print(catalog.format_merge_plan(plan, a.previous))


def manifest(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = catalog.manifest_rows(spark.read.parquet(a.samples), a.cohort, a.gtc_prefix)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gtc").load(a.gtc_prefix).select("path", "length")
    # stores name one file in several ways (file:/x, file:///x, /x)
    bare = lambda c: F.regexp_replace(c, r"^[a-z0-9]+:/+", "/")
    catalog.check_files(rows.select(bare(F.col("cpg_gcp_filepath")).alias("path")), listed.select(bare(F.col("path")).alias("path"), "length"))
    if a.dry_run:
        out = io.StringIO()
        lines = csv.writer(out, lineterminator="\n")
        lines.writerow(readers.MANIFEST_COLUMNS)
        lines.writerows(tuple(r) for r in rows.select(*readers.MANIFEST_COLUMNS).collect())
        print(out.getvalue(), end="")
    else:
        writers.manifest(rows, a.output, a.force)
        if a.registry:
            writers.register(spark, a.cohort, "manifest", a.output, a.registry)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    for name, log in cohort.run_configured(spark, load_config(a.config), a.dry_run).items():
        print("\n".join(f"{name}: {line}" for line in log))


def contigs(spark: SparkSession, a: argparse.Namespace) -> None:
    """The contigs of an array manifest's dump, one a line; the written list is read again and compared."""
    loci = readers.bpm_loci(spark, a.manifest_dump)
    writers.contig_cache(loci, a.output)
    back = readers.bpm_chroms(spark, a.output)
    if not loci.select("bpm_index", "chrom").exceptAll(back).isEmpty():
        raise ValueError(f"{a.output} is not what was written")


def frequencies(spark: SparkSession, a: argparse.Namespace) -> None:
    """Reference frequencies of ALT from the calls of a cohort (Parquet), as a sites-only VCF."""
    calls = spark.read.parquet(a.calls)
    sites = calls.groupBy("variant_id").agg(F.min(F.struct("chrom", "pos", "ref", "alt")).alias("s")).select("variant_id", "s.*")
    writers.frequency_vcf(stats.allele_frequency(calls).join(sites, "variant_id").withColumnRenamed("alt_freq", "af"), a.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loculoom", description=__doc__.splitlines()[0])
    commands = p.add_subparsers(dest="command", required=True)
    c = commands.add_parser("run")
    c.add_argument("config")
    c.add_argument("--dry-run", action="store_true")
    c.set_defaults(run=run)
    c = commands.add_parser("contigs")
    c.add_argument("--manifest-dump", required=True)
    c.add_argument("--output", required=True)
    c.set_defaults(run=contigs)
    c = commands.add_parser("frequencies")
    c.add_argument("--calls", required=True)
    c.add_argument("--output", required=True)
    c.set_defaults(run=frequencies)
    c = commands.add_parser("variant-qc")
    for name in ("egt-info-tsv", "merged-vmiss", "hwe-pass-snplist", "output-audit-tsv", "output-inclusion-list", "output-summary-tsv"):
        c.add_argument(f"--{name}", required=True)
    for name in ("gentrain-min", "cluster-sep-min", "fmiss-max"):
        c.add_argument(f"--{name}", required=True, type=float)
    c.set_defaults(run=variant_qc)
    c = commands.add_parser("sample-qc")
    for name in ("smiss", "het", "sexcheck", "seg", "output"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--bafregress", nargs="*", default=[])
    c.set_defaults(run=sample_qc)
    c = commands.add_parser("aggregates")
    c.add_argument("--registry", required=True)
    c.add_argument("--analysis-type", default="array_aggregate_pgen")
    c.set_defaults(run=aggregates)
    c = commands.add_parser("merge-plan")
    c.add_argument("--registry", required=True)
    c.add_argument("--cohort", required=True)
    c.add_argument("--previous")
    c.set_defaults(run=merge_plan)
    c = commands.add_parser("manifest")
    for name in ("samples", "cohort", "gtc-prefix", "output"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--registry")
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--force", action="store_true")
    c.set_defaults(run=manifest)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        args.run(spark or SparkSession.builder.appName("loculoom").getOrCreate(), args)
    except (ValueError, OSError, PySparkException) as e:
        print(f"{args.command}: {str(e).splitlines()[0]}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
