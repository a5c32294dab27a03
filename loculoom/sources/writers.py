"""Writers.  Reports are small and leave as one file; calls stay partitioned Parquet."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports, variants
from .readers import MANIFEST_COLUMNS

AUDIT = ["CHROM", "POS", "REF", "ALT", "ID", "GenTrain_Score", "Cluster_Sep", "F_MISS", "pass_gentrain", "pass_cluster_sep", "pass_fmiss", "pass_hwe", "pass"]
SEG_HEADER = "FID1 string, ID1 string, FID2 string, ID2 string, IBD1Seg double, IBD2Seg double, PropIBD double, InfType string"
SEG_X_HEADER = "FID1 string, ID1 string, FID2 string, ID2 string, Sex1 int, Sex2 int, MaxIBD1 double, MaxIBD2 double, IBD1Seg double, IBD2Seg double, PropIBD double"


def ordered(flagged: DataFrame) -> DataFrame:
    """In the order of the input (``ord``), where it is known."""
    return flagged.orderBy("ord") if "ord" in flagged.columns else flagged


def audit(flagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All variants with their flags (True, False) as compressed TSV."""
    flags = {c: F.initcap(F.col(c).cast("string")) for c in AUDIT if c.startswith("pass")}
    ordered(flagged).withColumns(flags).select(AUDIT).coalesce(1).write.mode(mode).option("compression", "gzip").csv(path, sep="\t", header=True)


def inclusion(flagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    ordered(flagged.filter("pass")).select("ID").coalesce(1).write.mode(mode).text(path)


def variant_qc(flagged: DataFrame, audit_path: str, inclusion_path: str, summary_path: str, mode: str = "errorifexists") -> None:
    """The three sinks of one computed frame."""
    flagged = flagged.persist()
    try:
        audit(flagged, audit_path, mode)
        inclusion(flagged, inclusion_path, mode)
        reports.summary(flagged).coalesce(1).write.mode(mode).csv(summary_path, sep="\t", header=True)
    finally:
        flagged.unpersist()


def sample_qc(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV in the order of the smiss file (``ord``), nulls blank."""
    order = [c for c in ("ord", "IID") if c in report.columns]
    drop = [c for c in report.columns if c.split("_")[0] == "ord"]
    report.orderBy(*order).drop(*drop).coalesce(1).write.mode(mode).csv(path, header=True, emptyValue="")


def calls(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Calls by contig, sorted by position within it; never by sample."""
    df.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").write.mode(mode).partitionBy("chrom").parquet(path)


def segments(pairs: DataFrame, path: str, header: str = SEG_HEADER, mode: str = "errorifexists") -> None:
    """Relatives as TSV with the columns of ``header``, families 0; without any pair, a file with the header alone."""
    names = [f.split()[0] for f in header.split(", ")]
    rows = pairs.select([F.lit("0").alias(c) if c.startswith("FID") else F.col(c) for c in names])
    rows.orderBy("ID1", "ID2").coalesce(1).write.mode(mode).csv(path, sep="\t", header=True)


def segment_rows(found: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The segments themselves as compressed TSV, in order; without any, a file with the header alone."""
    names = {"s1": "ID1", "s2": "ID2", "chrom": "Chr", "state": "IBDType", "start_pos": "StartPos", "end_pos": "StopPos", "n_snps": "N_SNP"}
    rows = found.withColumn("state", F.concat(F.lit("IBD"), F.col("state").cast("string"))).select(F.lit("0").alias("FID1"), "s1", F.lit("0").alias("FID2"), "s2", "state", "chrom", "start_pos", "end_pos", "n_snps")
    rows.withColumnsRenamed(names).orderBy("ID1", "ID2", "Chr", "IBDType", "StartPos").coalesce(1).write.mode(mode).option("compression", "gzip").csv(path, sep="\t", header=True)


def gtc_metadata(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The table of samples that leaves beside the calls, one TSV."""
    rows.orderBy("file").coalesce(1).write.mode(mode).csv(path, sep="\t", header=True, emptyValue="")


def id_pairs(samples: DataFrame, path: str, *columns: str, mode: str = "errorifexists") -> None:
    """Lines '0<tab>sample[<tab>column...]' (keep, remove and sex lists), sorted and distinct."""
    rows = samples.select("sample_id", *columns).distinct().orderBy("sample_id")
    rows.coalesce(1).select(F.concat_ws("\t", F.lit("0"), "sample_id", *columns)).write.mode(mode).text(path)


def reheader(names: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines 'old new' that give samples their ids, by the new ones."""
    names.orderBy("sg_id").coalesce(1).select(F.concat_ws(" ", "old_name", "sg_id")).write.mode(mode).text(path)


def frequency_vcf(sites: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A sites-only VCF of ``sites(chrom, pos, ref, alt, af)`` with AF, as ``readers.af_reference`` takes it: gzip parts in the order of positions."""
    head = '##fileformat=VCFv4.2\n##INFO=<ID=AF,Number=A,Type=Float,Description="Alternate allele frequency">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO'
    info = F.concat(F.lit("AF="), F.coalesce(F.col("af").cast("string"), F.lit(".")))
    contig = variants.numeric_contig(F.col("chrom")).try_cast("int")
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt"), "ref", "alt", F.lit("."), F.lit("."), info)
    body = sites.select(F.lit(1).alias("k"), F.coalesce(contig, F.lit(1_000)).alias("c"), "chrom", "pos", line.alias("value"))
    first = sites.sparkSession.createDataFrame([(0, 0, "", 0, head)], "k int, c int, chrom string, pos long, value string")
    first.unionByName(body.withColumn("pos", F.col("pos").cast("long"))).orderBy("k", "c", "chrom", "pos", "value").select("value").write.mode(mode).option("compression", "gzip").text(path)


def manifest(rows: DataFrame, path: str, force: bool = False) -> None:
    """The 14-column manifest; an existing one is refused unless forced."""
    rows.select(*MANIFEST_COLUMNS).coalesce(1).write.mode("overwrite" if force else "errorifexists").csv(path, header=True, emptyValue="")


def register(spark: SparkSession, cohort: str, kind: str, output: str, path: str) -> int:
    """Append a completed analysis to the registry, as a line that ``readers.registry`` reads with those of the cohort; returns its id.

    Call it after the output is committed.  Ids are times in microseconds, so later analyses have larger ones.
    """
    now = datetime.now(UTC)
    made = int(now.timestamp() * 1_000_000)
    analysis = "id long, type string, status string, timestampCompleted string, outputs struct<path:string,basename:string>"
    row = [(cohort, [], [(made, kind, "COMPLETED", now.strftime("%Y-%m-%dT%H:%M:%S"), (output, output.rstrip("/").rsplit("/", 1)[-1]))])]
    spark.createDataFrame(row, f"id string, sequencingGroups array<struct<id:string>>, analyses array<struct<{analysis.replace(' ', ':').replace(',:', ',')}>>").write.mode("append").json(path)
    return made


def registered(spark: SparkSession, registry: str, path: str) -> bool:
    """Whether an analysis with this output is in the registry; a registry that is not there yet holds none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(registry)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return False
    lines = spark.read.schema("analyses array<struct<outputs:variant>>").json(registry).select(F.explode("analyses.outputs").alias("o"))
    return not lines.filter(F.coalesce(F.try_variant_get("o", "$.path", "string"), F.try_variant_get("o", "$", "string")) == path).isEmpty()


def contig_cache(chroms: DataFrame, path: str) -> None:
    chroms.orderBy("bpm_index").coalesce(1).select("chrom").write.option("compression", "gzip").text(path)
