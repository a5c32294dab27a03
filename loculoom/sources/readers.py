"""Readers.  Text with fixed columns is read as strings and cast; whitespace tables are split by expression."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import number
from ..operators.catalog import output_path
from ..operators.variants import canonical_ids
from .storage import numbered_lines

#: Columns of the cluster scores and of a manifest.
EGT_COLUMNS = ("CHROM", "POS", "REF", "ALT", "ID", "GenTrain_Score", "Cluster_Sep")
MANIFEST_COLUMNS = (
    "file_name", "sample_sheet_id", "sample_id", "md5sum", "bbv_barcode", "sentrix_barcode_a", "sentrix_position_a", "sample_plate", "sample_well", "sample_plate_position",
    "cpg_sample_id_internal", "cpg_gcp_filepath", "cpg_sequencing_group_id", "cpg_cohort_id",
)


def strings(columns) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def place_in_files() -> Column:
    """The order of the rows of text files: they are read in splits by their path and place, and numbers rise within a split."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))


def egt_info(spark: SparkSession, path: str) -> DataFrame:
    """Header-less 7-column TSV of variants and cluster scores; ids become CHROM:POS:REF:ALT, ``ord`` rises in the file's order."""
    raw = spark.read.schema(strings(EGT_COLUMNS)).csv(path, sep="\t", quote="", nullValue=".")
    place = place_in_files()
    low = raw.select(*[F.col(c).alias(n) for c, n in zip(EGT_COLUMNS, ("chrom", "pos", "ref", "alt", "id", "gentrain", "cluster"))], place.alias("ord"))
    low = canonical_ids(low, "id")
    return low.select("chrom", F.col("pos").try_cast("long"), "ref", "alt", "id", number(F.col("gentrain")), number(F.col("cluster")), "ord").toDF(*EGT_COLUMNS, "ord")


def vmiss(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True).select("ID", number(F.col("F_MISS")).alias("F_MISS"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("ID")).filter(F.length("ID") > 0).distinct()


def whitespace_table(spark: SparkSession, path: str, text: tuple[str, ...] = ("FID", "IID", "FID1", "ID1", "FID2", "ID2", "InfType", "STATUS", "sample_id")) -> DataFrame:
    """Columns split at white space, '#' stripped from header cells, measures as doubles; ``ord`` is the line's place among those that are not blank."""
    lines = numbered_lines(spark, path)
    first = lines.filter("ord = 0").select("value").head()
    if first is None:
        raise ValueError(f"{path} is empty")
    names = [c.lstrip("#") for c in first.value.split()]
    cells = lines.filter("ord > 0").select("ord", F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ").alias("c"))
    return cells.select("ord", *[(F.get("c", F.lit(i)) if n in text else number(F.get("c", F.lit(i)))).alias(n) for i, n in enumerate(names)])


def bafregress(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of contamination reports, keyed IID; unreadable files are skipped with a warning."""
    got = []
    for p in paths:
        try:
            got.append(whitespace_table(spark, p).drop("ord").withColumnRenamed("sample_id", "IID"))
        except Exception as e:  # noqa: BLE001  a report that cannot be read does not stop the others
            warnings.warn(f"skipped {p}: {str(e).splitlines()[0]}", stacklevel=2)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), got) if got else spark.createDataFrame([], "IID string")


def manifest_csv(spark: SparkSession, path: str) -> DataFrame:
    """The 14 columns of a manifest; ``ord`` rises in the file's order."""
    raw = spark.read.schema(strings(MANIFEST_COLUMNS)).csv(path, header=True, enforceSchema=False)
    return raw.select("*", place_in_files().alias("ord"))


def row_order(manifest: DataFrame) -> Column:
    """A manifest's own ``ord``; a frame without it is taken as it lies."""
    return F.col("ord") if "ord" in manifest.columns else F.monotonically_increasing_id()


def manifest_paths(manifest: DataFrame) -> DataFrame:
    """sg_id and gtc; of repeated samples the last row wins."""
    rows = manifest.select(F.col("cpg_sequencing_group_id").alias("sg_id"), F.col("cpg_gcp_filepath").alias("gtc"), row_order(manifest).alias("ord"))
    return rows.filter("length(sg_id) > 0 AND length(gtc) > 0").groupBy("sg_id").agg(F.max_by("gtc", "ord").alias("gtc"))


def manifest_reheader(manifest: DataFrame) -> DataFrame:
    """sg_id, gtc and old_name (barcode_position) of rows that have all four fields."""
    need = ("cpg_sequencing_group_id", "cpg_gcp_filepath", "sentrix_barcode_a", "sentrix_position_a")
    full = reduce(lambda a, b: a & b, [F.length(F.col(c)) > 0 for c in need])
    rows = manifest.withColumn("ord", row_order(manifest)).filter(full)
    old = F.concat_ws("_", "sentrix_barcode_a", "sentrix_position_a")
    return rows.groupBy(F.col("cpg_sequencing_group_id").alias("sg_id")).agg(F.max_by("cpg_gcp_filepath", "ord").alias("gtc"), F.max_by(old, "ord").alias("old_name"))


def psam(spark: SparkSession, path: str) -> DataFrame:
    """iid in file order: by the '#' header, else column 2 of six-column files, else column 1."""
    header = spark.read.text(path).filter("value LIKE '#%'").head()
    cells = numbered_lines(spark, path, "#").withColumn("c", F.split("value", "\t"))
    if header:
        names = [c.lstrip("#") for c in header.value.split("\t")]
        at = F.lit(names.index("IID") if "IID" in names else 0)
    else:
        at = F.when(F.size("c") == 6, 1).otherwise(0)
    return cells.select("ord", F.get("c", at).alias("iid")).orderBy("ord")


def fam(spark: SparkSession, path: str) -> DataFrame:
    """Samples of a PLINK 1 fileset; ``i`` is the sample's place."""
    raw = numbered_lines(spark, path).select(F.col("ord").cast("int").alias("i"), F.split(F.trim("value"), r"\s+").alias("c"))
    return raw.select("i", *[F.get("c", F.lit(k)).alias(n) for k, n in enumerate(("fid", "iid", "pat", "mat", "sex", "pheno"))])


def bim(spark: SparkSession, path: str) -> DataFrame:
    """Variants of a PLINK 1 fileset: A1 is ALT, A2 is REF; ``ord`` is the variant's place."""
    cells = numbered_lines(spark, path).select("ord", F.split(F.trim("value"), r"\s+").alias("c"))
    g = lambda i: F.get("c", F.lit(i))
    return cells.select("ord", g(0).alias("chrom"), g(1).alias("variant_id"), g(3).try_cast("long").alias("pos"), g(5).alias("ref"), g(4).alias("alt"))


def pvar(spark: SparkSession, path: str) -> DataFrame:
    """Variants of a PLINK 2 fileset; ``ord`` is the variant's place."""
    raw = numbered_lines(spark, path, "#").select("ord", F.split("value", "\t").alias("c"))
    g = lambda i: F.get("c", F.lit(i))
    return raw.select("ord", g(0).alias("chrom"), g(1).try_cast("long").alias("pos"), g(2).alias("variant_id"), g(3).alias("ref"), g(4).alias("alt"))


def vcf_sites(spark: SparkSession, path: str, *info: str) -> DataFrame:
    """Sites of a text VCF with INFO fields as strings."""
    raw = spark.read.text(path).filter("value NOT LIKE '#%' AND length(value) > 0").select(F.split("value", "\t").alias("c"))
    g = lambda i: F.get("c", F.lit(i))
    fields = [F.nullif(F.regexp_extract(g(7), rf"(?:^|;){k}=([^;]+)", 1), F.lit("")).alias(k) for k in info]
    return raw.select(g(0).alias("chrom"), g(1).try_cast("long").alias("pos"), g(2).alias("variant_id"), g(3).alias("ref"), g(4).alias("alt"), *fields)


def vcf_calls(spark: SparkSession, path: str) -> DataFrame:
    """Long calls of a text VCF: dosage counts non-reference alleles, a missing allele makes it null; GQ if there."""
    text = spark.read.text(path)
    header = text.filter("value LIKE '#CHROM%'").head()
    samples = header.value.split("\t")[9:]
    rows = text.filter("value NOT LIKE '#%' AND length(value) > 0").select(F.split("value", "\t").alias("c"))
    g = lambda i: F.get("c", F.lit(i))
    names = spark.createDataFrame(list(enumerate(samples)), "i int, sample_id string")
    rows = rows.select(g(0).alias("chrom"), g(1).try_cast("long").alias("pos"), g(2).alias("variant_id"), g(3).alias("ref"), g(4).alias("alt"), F.split(g(8), ":").alias("f"), F.posexplode(F.slice("c", 10, len(samples))).alias("i", "cell"))
    part = F.split("cell", ":")
    field = lambda k: F.get(part, (F.array_position("f", k) - 1).cast("int"))
    alleles = F.split(field("GT"), r"[/|]")
    dosage = F.when(~F.array_contains(alleles, "."), F.size(F.filter(alleles, lambda a: a != "0")))
    return rows.join(names, "i").select("chrom", "pos", "variant_id", "ref", "alt", "sample_id", dosage.alias("dosage"), field("GQ").try_cast("int").alias("gq"))


def af_reference(spark: SparkSession, path: str) -> DataFrame:
    return vcf_sites(spark, path, "AF").withColumn("af", number(F.col("AF"))).select("chrom", "pos", "ref", "alt", "af")


def egt_from_vcf(spark: SparkSession, path: str) -> DataFrame:
    """The 7 EGT columns from a VCF whose INFO has the cluster scores, with canonical ids."""
    v = canonical_ids(vcf_sites(spark, path, "GenTrain_Score", "Cluster_Sep"))
    return v.select("chrom", "pos", "ref", "alt", "variant_id", number(F.col("GenTrain_Score")), number(F.col("Cluster_Sep"))).toDF(*EGT_COLUMNS)


def bpm_loci(spark: SparkSession, path: str) -> DataFrame:
    """bpm_index and chrom of a manifest dump: digits-only rows after the header with Index and Chr, which must be 1..N."""
    whole = numbered_lines(spark, path, blank=True).withColumnRenamed("value", "line")
    head = whole.filter(F.array_contains(F.split("line", "[,\t]"), "Index") & F.array_contains(F.split("line", "[,\t]"), "Chr")).orderBy("ord").head()
    if head is None:
        raise ValueError("no assay table")
    names = [c for c in head.line.replace("\t", ",").split(",")]
    cells = whole.filter(F.col("ord") > head.ord).select("ord", F.split("line", "[,\t]").alias("c"))
    cells = cells.select("ord", F.get("c", F.lit(names.index("Index"))).alias("i"), F.get("c", F.lit(names.index("Chr"))).alias("chrom")).withColumn("ok", F.coalesce(F.col("i").rlike("^[0-9]+$"), F.lit(False)))
    stop = cells.filter("NOT ok").agg(F.min("ord")).head()[0]
    loci = cells.filter("ok") if stop is None else cells.filter(F.col("ok") & (F.col("ord") < stop))
    loci = loci.select((F.col("ord") - head.ord).alias("place"), F.col("i").cast("int").alias("bpm_index"), "chrom")
    bad = loci.agg(F.count("*").alias("n"), F.count_if(F.col("place") != F.col("bpm_index")).alias("off")).head()
    if not bad.n or bad.off:
        raise ValueError("the assay index is empty or not contiguous")
    return loci.select("bpm_index", "chrom")


def bpm_chroms(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """One contig a line, optionally the first ``limit``."""
    lines = numbered_lines(spark, path).withColumnRenamed("value", "chrom")
    lines = lines if limit is None else lines.filter(F.col("ord") < limit)
    return lines.select((F.col("ord") + 1).alias("bpm_index"), F.trim("chrom").alias("chrom"))


def registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(member, analysis) from JSON lines of cohorts: id, name, sequencingGroups [{id}], analyses [{id, type, timestampCompleted, outputs}].

    A cohort may have several lines, as when analyses were registered later; members carry the cohort's name.
    """
    schema = "id string, name string, sequencingGroups array<struct<id:string>>, analyses array<struct<id:long,type:string,timestampCompleted:string,outputs:variant>>"
    cohort = spark.read.schema(schema).json(path).withColumn("c", F.monotonically_increasing_id())
    member = cohort.select(F.col("id").alias("cohort_id"), F.col("name").alias("cohort_name"), F.explode("sequencingGroups").alias("g"), "c")
    member = member.select("cohort_id", "cohort_name", F.col("g.id").alias("sg_id"), F.col("c").alias("ordinal"))
    a = cohort.select(F.col("id").alias("cohort_id"), "c", F.posexplode("analyses").alias("place", "a")).withColumn("ordinal", F.struct("c", "place"))
    return member, a.select("cohort_id", F.col("a.type").alias("type"), F.col("a.timestampCompleted").alias("ts"), output_path(F.to_json("a.outputs")).alias("path"), "ordinal", F.col("a.id").alias("analysis_id"))


def manifests(analyses: DataFrame) -> DataFrame:
    """id, basename and path of manifest analyses(id, type, outputs JSON) whose outputs are objects."""
    v = F.try_parse_json("outputs")
    got = analyses.filter((F.col("type") == "manifest") & F.schema_of_variant(v).startswith("OBJECT"))
    got = got.select("id", F.try_variant_get(v, "$.basename", "string").alias("basename"), F.try_variant_get(v, "$.path", "string").alias("path"))
    return got.filter(F.col("basename").contains("genotyping_array"))


def reported_sex(groups: DataFrame) -> DataFrame:
    """sg_id and sex of nested sequencing groups(sg_id, sample struct) wherever the whole path is there."""
    sex = F.col("sample.participant.reportedSex")
    return groups.filter(sex.isNotNull() & (F.length(sex) > 0)).select("sg_id", sex.alias("sex"))


def registry_sexes(spark: SparkSession, path: str) -> DataFrame:
    """sample_id and sex (1 male, 2 female) of the registry's samples, of each the first that is told; other values are unknown."""
    schema = "id string, sequencingGroups array<struct<id:string,sample:struct<participant:struct<reportedSex:string>>>>"
    groups = spark.read.schema(schema).json(path).select(F.explode("sequencingGroups").alias("g")).select(F.col("g.id").alias("sg_id"), F.col("g.sample").alias("sample"))
    code = F.when(F.lower("sex").isin("1", "m", "male"), 1).when(F.lower("sex").isin("2", "f", "female"), 2)
    told = reported_sex(groups).select(F.col("sg_id").alias("sample_id"), code.alias("sex")).filter("sex IS NOT NULL")
    return told.groupBy("sample_id").agg(F.min("sex").alias("sex"))


def cluster_scores(spark: SparkSession, path: str) -> DataFrame:
    """The array's cluster scores from the 7-column TSV, or from a VCF whose INFO has them (``ord`` is then unknown)."""
    return egt_from_vcf(spark, path) if path.removesuffix(".gz").endswith(".vcf") else egt_info(spark, path)
