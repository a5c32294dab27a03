"""Queries of the text records: reports, manifests and the registry leave as files and are read again, and SQL says what must come back.

Suppliers and parts are samples and variants as in ``catalogue``; in the registry customers are samples and nations cohorts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, ibd, reports, samples, stats, variants
from ..sources import files, readers, storage, writers
from . import catalogue

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def text_file(rows: DataFrame, path: str, order: list[str], *cells: Column | str, head: str = "", sep: str = "\t") -> str:
    """One file of the rows in the given order, the header first; null is NA."""
    told = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("NA")) for c in cells]
    lines = rows.select(*order, F.concat_ws(sep, *told).alias("value"))
    storage.write_lines(lines, path, head, tuple(order))
    return path


GENTRAIN, CLUSTER = "p_size::DOUBLE / 50", "CASE WHEN p_partkey % 10 <> 7 THEN (p_partkey % 100)::DOUBLE / 100 END"


@query(f"""WITH {catalogue.HWE}, {catalogue.STRICT}, vm AS (SELECT variant_id, round((count(*) - count(dosage))::DOUBLE / count(*), 6) AS f_miss FROM calls GROUP BY variant_id),
e AS (SELECT p_partkey, {GENTRAIN} AS g, {CLUSTER} AS c, f_miss, passed.variant_id IS NOT NULL AS h FROM part LEFT JOIN vm ON p_partkey = vm.variant_id LEFT JOIN passed ON p_partkey = passed.variant_id),
f AS (SELECT *, coalesce(g >= 0.3, false) AS a, coalesce(c >= 0.2, false) AS b, coalesce(f_miss <= 0.3, false) AS m FROM e)
SELECT 'chr1:' || p_partkey || ':A:G' AS id, CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS place, f_miss, concat_ws(' ', if(a, 'True', 'False'), if(b, 'True', 'False'), if(m, 'True', 'False'), if(h, 'True', 'False'), if(a AND b AND m AND h, 'True', 'False')) AS flags,
CASE WHEN a AND b AND m AND h THEN CAST(sum(CAST(a AND b AND m AND h AS INT)) OVER (ORDER BY p_partkey) - 1 AS BIGINT) END AS included_at FROM f""")
def variant_qc_files(spark, sf_dir):
    """Cluster scores, missingness and pass list as text in; audit and inclusion list out, both in the order of the scores."""
    at, id_ = storage.scratch(spark), F.concat(F.lit("chr1:"), F.col("variant_id").cast("string"), F.lit(":A:G"))
    part = catalogue.read(spark, sf_dir, "part")
    cluster = F.when(F.col("p_partkey") % 10 != 7, (F.col("p_partkey") % 100).cast("double") / 100)
    text_file(part, f"{at}/egt.tsv", ["p_partkey"], F.lit("chr1"), "p_partkey", F.lit("A"), F.lit("G"), F.lit("rs"), F.col("p_size").cast("double") / 50, F.coalesce(cluster.cast("string"), F.lit(".")))
    profile = stats.variant_profile(catalogue.calls(spark, sf_dir))
    text_file(profile, f"{at}/vmiss.tsv", ["variant_id"], F.lit("chr1"), id_, F.round("f_miss", 6), head="#CHROM\tID\tF_MISS\n")
    text_file(profile.filter(stats.hwe_keeps(catalogue.HWE_P, 0.0, keep_few_het=False)), f"{at}/passed.txt", ["variant_id"], id_)
    flagged = reports.variant_qc(
        readers.egt_info(spark, f"{at}/egt.tsv"), readers.vmiss(spark, f"{at}/vmiss.tsv"), readers.id_list(spark, f"{at}/passed.txt"),
        gentrain_min=catalogue.GENTRAIN_MIN, cluster_sep_min=catalogue.CLUSTER_SEP_MIN, fmiss_max=catalogue.FMISS_MAX,
    )
    writers.variant_qc(flagged, f"{at}/audit", f"{at}/inclusion", f"{at}/summary")
    audit = storage.numbered_lines(spark, f"{at}/audit").filter("ord > 0").select(F.col("ord").alias("place"), F.split("value", "\t").alias("c"))
    audit = audit.select("place", F.get("c", F.lit(4)).alias("id"), F.get("c", F.lit(7)).try_cast("double").alias("f_miss"), F.array_join(F.slice("c", 9, 5), " ").alias("flags"))
    included = storage.numbered_lines(spark, f"{at}/inclusion").select(F.col("value").alias("id"), F.col("ord").alias("included_at"))
    return audit.join(included, "id", "left")


@query(f"""WITH {catalogue.CALLS}, {catalogue.SEGS}, {catalogue.SIDES}, {catalogue.AF}, {catalogue.HET.format('calls')},
sm AS (SELECT sample_id AS "IID", CAST(count(*) - count(dosage) AS DOUBLE) AS "MISSING_CT", round((count(*) - count(dosage))::DOUBLE / count(*), 6) AS "F" FROM calls GROUP BY sample_id),
h AS (SELECT sample_id AS "IID", CAST(o_hom AS DOUBLE) AS "O_HOM", round((o_hom - e_hom) / (n_nm - e_hom), 6) AS "F_het" FROM het WHERE abs(n_nm - e_hom) > 1e-9),
x AS (SELECT s_suppkey AS "IID", CAST(s_nationkey % 2 + 1 AS DOUBLE) AS "PEDSEX", round(s_acctbal, 6) AS "F_sex" FROM supplier),
b AS (SELECT l_suppkey AS "IID", round(avg(l_tax), 6) AS baf FROM lineitem WHERE l_suppkey % 3 <> 2 GROUP BY l_suppkey)
SELECT CAST("IID" AS VARCHAR) AS "IID", "MISSING_CT", "F", "O_HOM", "F_het", "PEDSEX", "F_sex", "RELATED_MZ", "RELATED_1ST", "RELATED_2ND", "RELATED_3RD", baf FROM sm JOIN h USING ("IID") JOIN x USING ("IID") LEFT JOIN wide USING ("IID") LEFT JOIN b USING ("IID")""")
def sample_qc_files(spark, sf_dir):
    """The tools' tables and two contamination reports as text in; the sample report as CSV out."""
    at = storage.scratch(spark)
    # four tables are made of the calls, which are summed once
    catalogue.calls(spark, sf_dir).write.parquet(f"{at}/calls")
    c = spark.read.parquet(f"{at}/calls")
    text_file(stats.missingness(c, "sample_id"), f"{at}/smiss", ["sample_id"], "sample_id", "missing_ct", F.round("f_miss", 6), head="#IID\tMISSING_CT\tF\n")
    text_file(stats.inbreeding(c).filter("f IS NOT NULL"), f"{at}/het", ["sample_id"], "sample_id", "o_hom", F.round("f", 6), head="#IID  O_HOM\tF\n", sep="  ")
    text_file(catalogue.read(spark, sf_dir, "supplier"), f"{at}/sex", ["s_suppkey"], "s_suppkey", F.col("s_nationkey") % 2 + 1, F.round("s_acctbal", 6), head="#IID\tPEDSEX\tF\n")
    text_file(catalogue.seg(c), f"{at}/seg", ["ID1", "ID2"], "ID1", "ID2", "IBD1Seg", "IBD2Seg", "InfType", head="ID1\tID2\tIBD1Seg\tIBD2Seg\tInfType\n")
    baf = catalogue.read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_tax"), 6).alias("baf"))
    for k in (0, 1):
        text_file(baf.filter(f"l_suppkey % 3 = {k}"), f"{at}/baf{k}", ["l_suppkey"], "l_suppkey", "baf", head="sample_id\tbaf\n")
    smiss, het, sex, seg = (readers.whitespace_table(spark, f"{at}/{n}") for n in ("smiss", "het", "sex", "seg"))
    report = reports.sample_qc(smiss, het.drop("ord"), sex.drop("ord"), reports.relatedness_wide(seg), readers.bafregress(spark, [f"{at}/baf0", f"{at}/baf1"]))
    writers.sample_qc(report, f"{at}/report")
    back = spark.read.csv(f"{at}/report", header=True)
    return back.withColumns({n: F.col(n).cast("double") for n in ("MISSING_CT", "F", "O_HOM", "F_het", "PEDSEX", "F_sex", "baf")})


def registry_of(spark: SparkSession, sf_dir: str) -> str:
    """A registry of cohorts: customers by nation; of the events, the even ones registered plate filesets and the odd ones contamination reports."""
    path, e = storage.scratch(spark), catalogue.read(spark, sf_dir, "events")
    sex = F.get(F.array(F.lit("Male"), F.lit("f"), F.lit("2"), F.lit("unknown"), F.lit(None)), (F.col("c_custkey") % 5).cast("int"))
    person = F.struct(F.col("c_custkey").cast("string").alias("id"), F.struct(F.struct(sex.alias("reportedSex")).alias("participant")).alias("sample"))
    groups = catalogue.read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.sort_array(F.collect_list(person)).alias("sequencingGroups"))
    name = F.concat(F.lit("gs/"), F.col("event_id").cast("string"))
    bed = F.col("event_id") % 2 == 0
    one = F.struct(
        F.col("event_id").alias("id"), F.when(bed, "array_cohort_bed").otherwise("array_bafregress").alias("type"), F.date_format("ts", "yyyy-MM-dd").alias("timestampCompleted"),
        F.when(bed, F.struct(F.concat(name, F.lit(".bed")).alias("path"))).alias("outputs"),
    )
    made = e.groupBy((F.col("event_id") % 50 / 2).cast("int").alias("k")).agg(F.sort_array(F.collect_list(one)).alias("analyses"))
    rows = groups.join(made, "k").select(F.concat(F.lit("COH"), F.col("k").cast("string")).alias("id"), F.concat(F.lit("plate "), F.col("k").cast("string")).alias("name"), "sequencingGroups", "analyses")
    rows.write.json(path)
    return path


LATEST = """l AS (SELECT event_id // 2 % 25 AS k, arg_max('gs/' || event_id, (strftime(ts, '%Y-%m-%d'), -event_id)) AS path FROM events WHERE event_id % 2 = 0 GROUP BY k)"""


@query(f"WITH {LATEST} SELECT CAST(c_custkey AS VARCHAR) AS sg_id, 'COH' || k AS cohort_id, path || '.bed' AS bed, path || '.bim' AS bim, path || '.fam' AS fam FROM customer JOIN l ON c_nationkey = k")
def registry_filesets(spark, sf_dir):
    members, analyses = readers.registry(spark, registry_of(spark, sf_dir))
    return catalog.bed_map(members, analyses)


@query(f"""WITH {LATEST} SELECT 'COH' || k AS cohort_id, path || '.bed' AS bed, path || '.bim' AS bim, path || '.fam' AS fam, count(*) AS new_count FROM customer JOIN l ON c_nationkey = k
WHERE c_nationkey BETWEEN 5 AND 19 AND c_nationkey > 9 AND c_custkey % 4 <> 0 OR c_nationkey BETWEEN 5 AND 9 AND c_custkey % 3 = 0 AND c_custkey % 4 <> 0 GROUP BY k, path""")
def rolling_merge_plates(spark, sf_dir):
    """The plates of a rolling merge: of the wanted samples, those that the carried aggregate (nations up to 9, less each third sample) lacks."""
    members, analyses = readers.registry(spark, registry_of(spark, sf_dir))
    nation, person = F.substring("cohort_id", 4, 9).cast("int"), F.col("sg_id").cast("long")
    everyone = members.filter(nation.between(5, 19) & (person % 4 != 0)).select("sg_id")
    return catalog.plates_to_merge(members, analyses, everyone, members.filter((nation <= 9) & (person % 3 != 0)).select("sg_id"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS sample_id, CAST(CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 0 END AS INT) AS sex FROM customer")
def registry_sex_update(spark, sf_dir):
    """Reported sexes of the registry as a list of the fileset tools, which then sets the sexes of all samples."""
    at = storage.scratch(spark)
    writers.id_pairs(readers.registry_sexes(spark, registry_of(spark, sf_dir)), at, "sex")
    listed = spark.read.text(at).select(F.split("value", "\t").alias("c")).select(F.get("c", F.lit(1)).alias("sample_id"), F.get("c", F.lit(2)).cast("int").alias("sex"))
    return samples.update_sex(catalogue.read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("sample_id")), listed)


@query("""SELECT CAST(s_suppkey // 2 AS VARCHAR) AS sg_id, max(s_suppkey) FILTER (WHERE s_suppkey % 5 <> 4) || '.gtc' AS gtc, 'b' || arg_max(s_nationkey, s_suppkey) FILTER (WHERE s_suppkey % 5 <> 4) || '_' || max(s_suppkey) FILTER (WHERE s_suppkey % 5 <> 4) AS old_name
FROM supplier WHERE s_suppkey % 5 <> 4 GROUP BY s_suppkey // 2""")
def manifest_files(spark, sf_dir):
    """A manifest is written and read: of a sample's rows the last complete one counts, and rows without a barcode do not."""
    at, s = storage.scratch(spark), catalogue.read(spark, sf_dir, "supplier")
    position = F.col("s_suppkey").cast("string")
    known = {
        "sentrix_barcode_a": F.when(F.col("s_suppkey") % 5 != 4, F.concat(F.lit("b"), F.col("s_nationkey").cast("string"))).otherwise(""), "sentrix_position_a": position,
        "cpg_gcp_filepath": F.concat(position, F.lit(".gtc")), "cpg_sequencing_group_id": F.floor(F.col("s_suppkey") / 2).cast("string"), "sample_id": F.col("s_name"),
    }
    rows = s.orderBy("s_suppkey").select(*[known.get(c, F.lit("")).alias(c) for c in readers.MANIFEST_COLUMNS])
    writers.manifest(rows, at)
    return readers.manifest_reheader(readers.manifest_csv(spark, at))


@query("""SELECT 'plates/' || c_custkey || '.gtc' AS path, CASE WHEN c_custkey % 3 = 0 THEN 'missing' ELSE 'empty' END AS fault FROM customer WHERE c_custkey % 3 = 0 OR c_acctbal < 0""")
def manifest_file_faults(spark, sf_dir):
    """The GTC files that a manifest names and the store lacks or holds empty."""
    c = catalogue.read(spark, sf_dir, "customer").select(F.concat(F.lit("plates/"), F.col("c_custkey").cast("string"), F.lit(".gtc")).alias("path"), "c_custkey", "c_acctbal")
    return catalog.faulty_files(c.select("path"), c.filter("c_custkey % 3 <> 0").select("path", F.when(F.col("c_acctbal") < 0, 0).otherwise(9).alias("length")))


@query("""SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS bpm_index, CAST(p_partkey % 24 + 1 AS VARCHAR) AS chrom FROM part""")
def array_contig_list(spark, sf_dir):
    """The array's contigs from a dump of its manifest, by way of the list that is kept beside it."""
    at = storage.scratch(spark)
    part = storage.ranked(catalogue.read(spark, sf_dir, "part").select("p_partkey"), "p_partkey").select("ord", F.col("ord") + 1, F.col("p_partkey") % 24 + 1).toDF("ord", "place", "chrom")
    line = F.concat_ws(",", F.col("place").cast("string"), F.lit("rs"), F.col("chrom").cast("string"))
    end = part.agg(F.max("ord").alias("ord")).select((F.col("ord") + 1).alias("ord"), F.lit("[Controls]").alias("value"))
    storage.write_lines(part.select("ord", line.alias("value")).unionByName(end), f"{at}/dump.csv", "array\n[Assay]\nIndex,Name,Chr\n")
    writers.contig_cache(readers.bpm_loci(spark, f"{at}/dump.csv"), f"{at}/contigs")
    return readers.bpm_chroms(spark, f"{at}/contigs")


@query("""SELECT CAST(row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) - 1 AS BIGINT) AS ord, CAST(s_suppkey AS VARCHAR) AS iid FROM supplier""")
def sample_file_order(spark, sf_dir):
    path = storage.scratch(spark)
    people = catalogue.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("sample_id"), (F.col("s_nationkey") % 3).alias("sex"))
    files.write_psam(files.samples_in_order(people), path)
    return readers.psam(spark, path)


@query("""SELECT p_partkey AS pos, CASE WHEN p_partkey % 3 = 0 THEN 'AC' ELSE 'A' END AS ref, CASE WHEN p_partkey % 5 = 0 THEN 'G,T' ELSE 'G' END AS alt FROM part WHERE p_partkey % 5 <> 0 AND (p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 OR p_partkey % 3 = 0 AND p_partkey % 2 = 0 AND p_partkey % 7 <> 0)""")
def biallelic_on_reference(spark, sf_dir):
    """Sites of one ALT whose REF is what the reference holds there."""
    k = F.col("p_partkey")
    part = catalogue.read(spark, sf_dir, "part").withColumns({"chrom": F.lit("chr1"), "pos": k, "ref": F.when(k % 3 == 0, "AC").otherwise("A"), "alt": F.when(k % 5 == 0, "G,T").otherwise("G")})
    bases = part.select("chrom", "pos", F.when(k % 7 == 0, "GC").when(k % 2 == 0, "ACT").otherwise("AG").alias("base"))
    return variants.matching_reference(variants.biallelic(part.select("chrom", "pos", "ref", "alt")), bases).select("pos", "ref", "alt")


@query(f"""WITH {catalogue.CALLS}, {catalogue.PAIRS}, {catalogue.SEGMENTS.format(1, 'abs(d1 - d2) = 2', 8)}, {catalogue.SEGMENTS.format(2, 'd1 <> d2', 4)}, b AS (SELECT 1 AS state, * FROM seg1 UNION ALL SELECT 2, * FROM seg2)
SELECT '0' AS "FID1", CAST(s1 AS VARCHAR) AS "ID1", '0' AS "FID2", CAST(s2 AS VARCHAR) AS "ID2", 'IBD' || state AS "IBDType", CAST(chrom AS VARCHAR) AS "Chr", CAST(start_pos AS DOUBLE) AS "StartPos", CAST(end_pos AS DOUBLE) AS "StopPos", CAST(n_snps AS DOUBLE) AS "N_SNP" FROM b""")
def segment_file(spark, sf_dir):
    """The table of segments as compressed text, read as any table of the tools."""
    at = storage.scratch(spark)
    writers.segment_rows(ibd.all_segments(catalogue.placed(spark, sf_dir), {1: 8, 2: 4}), at)
    back = readers.whitespace_table(spark, at, ("FID1", "ID1", "FID2", "ID2", "IBDType", "Chr"))
    return back.drop("ord")
