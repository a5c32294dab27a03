"""Every operator as a query on the driver tables, and the same in SQL.

The tables have no genotypes, so they are relabelled: a supplier is a sample, a part a variant, and the sum of the line
numbers of the two, modulo 4, the dosage (3: no call).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import float_text
from ..operators import catalog, ibd, reports, samples, stats, variants

GENTRAIN_MIN, CLUSTER_SEP_MIN, FMISS_MAX, HWE_P = 0.3, 0.2, 0.3, 0.05


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of lineitem that a task groups.
TASK_ROWS = 1_000_000


def dealt_pairs(lines: DataFrame) -> DataFrame:
    """Lines dealt by supplier and part to so many tasks that none groups much more than ``TASK_ROWS``; few lines stay as they are."""
    n = -(-lines.count() // TASK_ROWS)
    return lines.repartition(n, "l_suppkey", "l_partkey") if n > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")) else lines


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dealt_pairs(read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_linenumber"))
    sums = lines.groupBy(F.col("l_suppkey").alias("sample_id"), F.col("l_partkey").alias("variant_id")).agg((F.sum("l_linenumber") % 4).cast("int").alias("d"))
    return sums.select("sample_id", "variant_id", F.when(F.col("d") != 3, F.col("d")).alias("dosage"))


CALLS = "calls AS (SELECT l_suppkey AS sample_id, l_partkey AS variant_id, CASE WHEN sum(l_linenumber) % 4 = 3 THEN NULL ELSE CAST(sum(l_linenumber) % 4 AS INT) END AS dosage FROM lineitem GROUP BY l_suppkey, l_partkey)"


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("variant_id"), F.col("p_partkey").alias("pos"), (F.col("p_partkey") % 24 + 1).cast("int").alias("c"), "p_size")


def plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sg_id"), F.col("s_nationkey").alias("cohort_id"))


def analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("cohort_id"), F.col("event_type").alias("type"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), F.col("props").alias("path"), F.col("event_id").alias("ordinal"), F.col("event_id").alias("analysis_id"))


ANALYSES = "analyses AS (SELECT user_id AS cohort_id, event_type AS type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props AS path, event_id AS analysis_id FROM events)"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


MISS = "CAST(count(*) - count(dosage) AS BIGINT) AS missing_ct, count(*) AS obs_ct, round((count(*) - count(dosage))::DOUBLE / count(*), 6) AS f_miss"


@query(f"WITH {CALLS} SELECT variant_id, {MISS} FROM calls GROUP BY variant_id")
def variant_missingness(spark, sf_dir):
    return six(stats.missingness(calls(spark, sf_dir), "variant_id"), "f_miss")


@query(f"WITH {CALLS} SELECT sample_id, {MISS} FROM calls GROUP BY sample_id")
def sample_missingness(spark, sf_dir):
    return six(stats.missingness(calls(spark, sf_dir), "sample_id"), "f_miss")


@query(f"""WITH {CALLS}, grid AS (SELECT v.variant_id, s.sample_id FROM (SELECT DISTINCT variant_id FROM calls) v CROSS JOIN (SELECT DISTINCT sample_id FROM calls) s)
SELECT g.variant_id, {MISS} FROM grid g LEFT JOIN calls c ON g.variant_id = c.variant_id AND g.sample_id = c.sample_id GROUP BY g.variant_id""")
def variant_missingness_grid(spark, sf_dir):
    return six(stats.cohort_missingness(calls(spark, sf_dir), "variant_id"), "f_miss")


#: Suppliers of even nations are a plate that holds every variant, those of odd nations one that lacks each third.
UNLIKE = "unlike AS (SELECT c.* FROM calls c JOIN supplier ON sample_id = s_suppkey WHERE s_nationkey % 2 = 0 OR variant_id % 3 <> 0)"


def unlike_plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample_id"), "s_nationkey")
    c = calls(spark, sf_dir).join(nation, "sample_id")
    plate = [c.filter("s_nationkey % 2 = 0"), c.filter("s_nationkey % 2 = 1 AND variant_id % 3 <> 0")]
    return samples.merge_plates([p.drop("s_nationkey") for p in plate])


@query(f"""WITH {CALLS}, {UNLIKE}, grid AS (SELECT v.variant_id, s.sample_id FROM (SELECT DISTINCT variant_id FROM unlike) v CROSS JOIN (SELECT DISTINCT sample_id FROM unlike) s)
SELECT g.variant_id, {MISS} FROM grid g LEFT JOIN unlike c ON g.variant_id = c.variant_id AND g.sample_id = c.sample_id GROUP BY g.variant_id""")
def plate_merge_missingness(spark, sf_dir):
    return six(stats.cohort_missingness(unlike_plates(spark, sf_dir), "variant_id"), "f_miss")


@query(f"""WITH {CALLS}, {UNLIKE}, grid AS (SELECT v.variant_id, s.sample_id FROM (SELECT DISTINCT variant_id FROM unlike) v CROSS JOIN (SELECT DISTINCT sample_id FROM unlike) s)
SELECT g.sample_id, {MISS} FROM grid g LEFT JOIN unlike c ON g.variant_id = c.variant_id AND g.sample_id = c.sample_id GROUP BY g.sample_id""")
def plate_merge_sample_missingness(spark, sf_dir):
    return six(stats.cohort_missingness(unlike_plates(spark, sf_dir), "sample_id"), "f_miss")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a sex by nation: unknown, male or female."""
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample_id"), (F.col("s_nationkey") % 3).cast("int").alias("sex"))


@query(f"""WITH {CALLS}, p AS (SELECT variant_id, dosage, CASE WHEN variant_id % 4 = 0 AND s_nationkey % 3 = 1 THEN 1 WHEN variant_id % 4 = 1 AND s_nationkey % 3 <> 2 THEN 1 WHEN variant_id % 4 = 1 THEN 0 ELSE 2 END AS ploidy
FROM calls JOIN supplier ON sample_id = s_suppkey),
d AS (SELECT variant_id, CASE WHEN ploidy = 2 THEN dosage WHEN ploidy = 1 AND dosage <> 1 THEN dosage // 2 END AS a, ploidy FROM p)
SELECT variant_id, CAST(coalesce(sum(CASE WHEN a IS NOT NULL THEN ploidy END), 0) AS BIGINT) AS obs_ct, round(sum(a)::DOUBLE / nullif(sum(CASE WHEN a IS NOT NULL THEN ploidy END), 0), 6) AS alt_freq FROM d GROUP BY variant_id""")
def allele_freq_by_ploidy(spark, sf_dir):
    chrom = F.when(F.col("variant_id") % 4 == 0, "chrX").when(F.col("variant_id") % 4 == 1, "chrY").otherwise("chr1")
    c = stats.with_ploidy(calls(spark, sf_dir).withColumn("chrom", chrom), people(spark, sf_dir))
    return six(stats.allele_frequency(c, F.col("ploidy")), "alt_freq").withColumn("obs_ct", F.col("obs_ct").cast("long"))


@query(f"""WITH {CALLS}, g AS (SELECT variant_id, count(*) FILTER (WHERE s_nationkey % 3 = 2 AND dosage = 0) AS hom_ref, count(*) FILTER (WHERE s_nationkey % 3 = 2 AND dosage = 1) AS het,
count(*) FILTER (WHERE s_nationkey % 3 = 2 AND dosage = 2) AS hom_alt, count(*) FILTER (WHERE s_nationkey % 3 = 1 AND dosage = 0) AS male_ref, count(*) FILTER (WHERE s_nationkey % 3 = 1 AND dosage = 2) AS male_alt
FROM calls JOIN supplier ON sample_id = s_suppkey GROUP BY variant_id),
u AS (SELECT DISTINCT hom_ref, het, hom_alt, male_ref, male_alt, hom_ref + het + hom_alt AS f, male_ref + male_alt AS n, 2 * hom_alt + het + male_alt AS alt FROM g),
m AS (SELECT *, unnest(range(greatest(0, alt - 2 * f), least(n, alt) + 1)) AS m FROM u WHERE f + n > 0),
k AS (SELECT *, unnest(range((alt - m) % 2, least(alt - m, 2 * f - alt + m) + 1, 2)) AS k FROM m),
w AS (SELECT *, k * ln(2.0::DOUBLE) - lgamma(m + 1) - lgamma(n - m + 1) - lgamma(k + 1) - lgamma((alt - m - k) // 2 + 1) - lgamma(f - k - (alt - m - k) // 2 + 1)
   - (het * ln(2.0::DOUBLE) - lgamma(male_alt + 1) - lgamma(male_ref + 1) - lgamma(het + 1) - lgamma(hom_alt + 1) - lgamma(hom_ref + 1)) AS d FROM k),
p AS (SELECT hom_ref, het, hom_alt, male_ref, male_alt, (sum(CASE WHEN d < -1e-8 THEN exp(d) WHEN d <= 1e-8 THEN 0.5::DOUBLE ELSE 0 END)) / sum(exp(d)) AS p_hwe FROM w GROUP BY ALL)
SELECT variant_id, hom_ref, het, hom_alt, male_ref, male_alt, round(p_hwe, 6) AS p_hwe FROM g LEFT JOIN p USING (hom_ref, het, hom_alt, male_ref, male_alt)""")
def hwe_chrx(spark, sf_dir):
    return six(stats.hardy_weinberg_x(calls(spark, sf_dir), people(spark, sf_dir)), "p_hwe")


AF = "af AS (SELECT variant_id, CAST(2 * count(dosage) AS BIGINT) AS obs_ct, sum(dosage)::DOUBLE / nullif(2 * count(dosage), 0) AS alt_freq FROM calls GROUP BY variant_id)"


@query(f"WITH {CALLS}, {AF} SELECT variant_id, obs_ct, round(alt_freq, 6) AS alt_freq FROM af")
def allele_freq(spark, sf_dir):
    return six(stats.allele_frequency(calls(spark, sf_dir)), "alt_freq")


HET = """het AS (SELECT sample_id, count(*) FILTER (WHERE dosage <> 1) AS o_hom, sum(1.0::DOUBLE - 2.0::DOUBLE * alt_freq * (1.0::DOUBLE - alt_freq)) AS e_hom, count(*) AS n_nm
FROM {0} c JOIN af USING (variant_id) WHERE dosage IS NOT NULL GROUP BY sample_id)"""


@query(f"WITH {CALLS}, {AF}, {HET.format('calls')} SELECT sample_id, o_hom, round(e_hom, 6) AS e_hom, n_nm, round(CASE WHEN abs(n_nm - e_hom) > 1e-9 THEN (o_hom - e_hom) / (n_nm - e_hom) END, 6) AS f FROM het")
def inbreeding_f(spark, sf_dir):
    return six(stats.inbreeding(calls(spark, sf_dir)), "e_hom", "f")


@query(f"""WITH {CALLS}, x AS (SELECT * FROM calls WHERE variant_id % 24 + 1 = 23), y AS (SELECT sample_id, count(dosage) AS ycount, count(*) AS yall FROM calls WHERE variant_id % 24 + 1 = 24 GROUP BY sample_id),
af AS (SELECT variant_id, sum(dosage)::DOUBLE / nullif(2 * count(dosage), 0) AS alt_freq FROM x GROUP BY variant_id), {HET.format('x')},
b AS (SELECT s_suppkey AS sample_id, CAST(s_nationkey % 2 + 1 AS INT) AS pedsex, CASE WHEN abs(n_nm - e_hom) > 1e-9 THEN (o_hom - e_hom) / (n_nm - e_hom) END AS xf, coalesce(ycount, 0) AS ycount,
  CASE WHEN yall > 0 THEN ycount::DOUBLE / yall END AS yrate FROM supplier LEFT JOIN het ON s_suppkey = het.sample_id LEFT JOIN y ON s_suppkey = y.sample_id),
c AS (SELECT *, CASE WHEN xf IS NOT NULL AND xf <= -0.01 AND ycount <= 14 THEN 2 WHEN xf IS NOT NULL AND xf >= 0.01 AND ycount >= 15 THEN 1 ELSE 0 END AS snpsex FROM b)
SELECT sample_id, pedsex, snpsex, CASE WHEN snpsex <> 0 AND snpsex = pedsex THEN 'OK' ELSE 'PROBLEM' END AS status, round(xf, 6) AS xf, ycount, round(yrate, 6) AS yrate FROM c""")
def sex_check(spark, sf_dir):
    c = calls(spark, sf_dir).withColumn("chrom", F.when(F.col("variant_id") % 24 + 1 == 23, "chrX").when(F.col("variant_id") % 24 + 1 == 24, "chrY"))
    people = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample_id"), (F.col("s_nationkey") % 2 + 1).alias("sex"))
    return six(stats.sex_check(c, people, -0.01, 0.01, 14, 15), "xf", "yrate")


HWE = f"""{CALLS}, g AS (SELECT variant_id, count(*) FILTER (WHERE dosage = 0) AS hom_ref, count(*) FILTER (WHERE dosage = 1) AS het, count(*) FILTER (WHERE dosage = 2) AS hom_alt FROM calls GROUP BY variant_id),
r AS (SELECT *, hom_ref + het + hom_alt AS n, least(2 * hom_ref + het, 2 * hom_alt + het) AS rare FROM g),
k AS (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS k FROM r WHERE n > 0),
lw AS (SELECT *, k * ln(2.0::DOUBLE) - lgamma(k + 1) - lgamma((rare - k) // 2 + 1) - lgamma(n - k - (rare - k) // 2 + 1) AS lp FROM k),
w AS (SELECT *, exp(lp - max(lp) OVER (PARTITION BY variant_id)) AS w, exp(max(CASE WHEN k = het THEN lp END) OVER (PARTITION BY variant_id) - max(lp) OVER (PARTITION BY variant_id)) AS own FROM lw),
pv AS (SELECT variant_id, (sum(CASE WHEN w <= own * (1 + 1e-8) THEN w ELSE 0 END) - 0.5::DOUBLE * sum(CASE WHEN w <= own * (1 + 1e-8) AND w >= own * (1 - 1e-8) THEN w ELSE 0 END)) / sum(w) AS p_hwe FROM w GROUP BY variant_id),
hwe AS (SELECT g.*, p_hwe FROM g LEFT JOIN pv USING (variant_id))"""


@query(f"WITH {HWE} SELECT variant_id, hom_ref, het, hom_alt, round(p_hwe, 6) AS p_hwe FROM hwe")
def hwe_exact_midp(spark, sf_dir):
    return six(stats.hardy_weinberg(calls(spark, sf_dir)), "p_hwe")


PASSED = f"""passed AS (SELECT variant_id FROM hwe WHERE coalesce(p_hwe >= {HWE_P} OR het <= (2 * hom_alt + het)::DOUBLE * (2 * hom_ref + het) / (2 * (hom_ref + het + hom_alt)), true))"""
STRICT = f"passed AS (SELECT variant_id FROM hwe WHERE coalesce(p_hwe >= {HWE_P}, true))"


@query(f"WITH {HWE}, {PASSED} SELECT variant_id FROM passed")
def hwe_pass_list(spark, sf_dir):
    return stats.hwe_pass(stats.hardy_weinberg(calls(spark, sf_dir)), HWE_P, 0.0)


@query("""SELECT l_suppkey AS sample_id, round(regr_slope(CASE WHEN d = 0 THEN l_discount ELSE 1 - l_discount END, CASE WHEN d = 0 THEN l_tax ELSE 1 - l_tax END), 6) AS contamination,
round(regr_intercept(CASE WHEN d = 0 THEN l_discount ELSE 1 - l_discount END, CASE WHEN d = 0 THEN l_tax ELSE 1 - l_tax END), 6) AS drift, count(*) AS n_sites
FROM (SELECT *, l_linenumber % 3 AS d FROM lineitem) WHERE d IN (0, 2) GROUP BY l_suppkey""")
def baf_regression(spark, sf_dir):
    s = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample_id"), (F.col("l_linenumber") % 3).alias("dosage"), F.col("l_discount").alias("baf"), F.col("l_tax").alias("af"))
    return six(stats.baf_regression(s), "contamination", "drift").withColumn("n_sites", F.col("n_sites").cast("long"))


def egt(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ID"), (F.col("p_size").cast("double") / 50).alias("GenTrain_Score"), ((F.col("p_partkey") % 100).cast("double") / 100).alias("Cluster_Sep"))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stats.hwe_keeps(HWE_P, 0.0, keep_few_het=False)
    tested = stats.variant_profile(calls(spark, sf_dir)).select(F.col("variant_id").alias("ID"), F.col("f_miss").alias("F_MISS"), kept.alias("pass_hwe"))
    return reports.variant_qc_of(egt(spark, sf_dir), tested, gentrain_min=GENTRAIN_MIN, cluster_sep_min=CLUSTER_SEP_MIN, fmiss_max=FMISS_MAX)


FLAGGED = f"""{HWE}, {STRICT}, vm AS (SELECT variant_id, (count(*) - count(dosage))::DOUBLE / count(*) AS f_miss FROM calls GROUP BY variant_id),
e AS (SELECT p_partkey AS "ID", p_size::DOUBLE / 50 AS "GenTrain_Score", (p_partkey % 100)::DOUBLE / 100 AS "Cluster_Sep", f_miss AS "F_MISS", passed.variant_id IS NOT NULL AS pass_hwe
  FROM part LEFT JOIN vm ON p_partkey = vm.variant_id LEFT JOIN passed ON p_partkey = passed.variant_id),
fl AS (SELECT *, coalesce("GenTrain_Score" >= {GENTRAIN_MIN}, false) AS pass_gentrain, coalesce("Cluster_Sep" >= {CLUSTER_SEP_MIN}, false) AS pass_cluster_sep, coalesce("F_MISS" <= {FMISS_MAX}, false) AS pass_fmiss FROM e),
flags AS (SELECT *, pass_gentrain AND pass_cluster_sep AND pass_fmiss AND pass_hwe AS "pass" FROM fl)"""


@query(f'WITH {FLAGGED} SELECT "ID", "GenTrain_Score", "Cluster_Sep", round("F_MISS", 6) AS "F_MISS", pass_gentrain, pass_cluster_sep, pass_fmiss, pass_hwe, "pass" FROM flags')
def snp_qc_flags(spark, sf_dir):
    return six(flagged(spark, sf_dir), "F_MISS")


@query(f"""WITH {FLAGGED}, c AS (SELECT count(*) AS total_variants, count(*) FILTER (WHERE NOT pass_gentrain) AS fail_gentrain, count(*) FILTER (WHERE NOT pass_cluster_sep) AS fail_cluster_sep,
count(*) FILTER (WHERE NOT pass_fmiss) AS fail_fmiss, count(*) FILTER (WHERE NOT pass_hwe) AS fail_hwe, count(*) FILTER (WHERE NOT pass_gentrain) AS first_fail_gentrain,
count(*) FILTER (WHERE pass_gentrain AND NOT pass_cluster_sep) AS first_fail_cluster_sep, count(*) FILTER (WHERE pass_gentrain AND pass_cluster_sep AND NOT pass_fmiss) AS first_fail_fmiss,
count(*) FILTER (WHERE pass_gentrain AND pass_cluster_sep AND pass_fmiss AND NOT pass_hwe) AS first_fail_hwe, count(*) FILTER (WHERE NOT "pass") AS total_excluded, count(*) FILTER (WHERE "pass") AS total_retained FROM flags)
SELECT metric, value FROM (UNPIVOT c ON {', '.join(reports.SUMMARY)} INTO NAME metric VALUE value)""")
def snp_qc_summary(spark, sf_dir):
    return reports.summary(flagged(spark, sf_dir))


@query(f'WITH {FLAGGED} SELECT "ID" FROM flags WHERE "pass"')
def snp_qc_inclusion(spark, sf_dir):
    return flagged(spark, sf_dir).filter("pass").select("ID")


SEGS = """seg AS (SELECT sample_id AS "ID1", variant_id AS "ID2", (dosage + 1)::DOUBLE / 4 AS ibd1, (sample_id % 5)::DOUBLE / 8 AS ibd2, CASE dosage WHEN 0 THEN 'PO' WHEN 1 THEN 'FS' ELSE '3rd' END AS inf,
row_number() OVER (ORDER BY sample_id, variant_id) AS ord FROM calls WHERE sample_id < variant_id AND dosage IS NOT NULL)"""
TEXT = "(CASE WHEN d LIKE '%.%' THEN regexp_replace(regexp_replace(d, '0+$', ''), '\\.$', '.0') ELSE d || '.0' END)"
SIDES = f"""t AS (SELECT *, CAST(CAST(round_even(ibd1 / 4 + ibd2 / 2, 4) AS DECIMAL(18, 4)) AS VARCHAR) AS d FROM seg), u AS (SELECT *, {TEXT} AS k FROM t),
s AS (SELECT 0 AS side, ord, "ID1" AS iid, "ID2" || ':' || k || ':' || inf AS payload, inf FROM u UNION ALL SELECT 1, ord, "ID2", "ID1" || ':' || k || ':' || inf, inf FROM u),
wide AS (SELECT iid AS "IID", {', '.join(f"string_agg(payload, ';' ORDER BY side, ord) FILTER (WHERE inf IN ({v})) AS {c}" for c, v in (('"RELATED_MZ"', "'Dup/MZ'"), ('"RELATED_1ST"', "'PO', 'FS'"), ('"RELATED_2ND"', "'2nd'"), ('"RELATED_3RD"', "'3rd'")))} FROM s GROUP BY iid)"""


def seg(calls: DataFrame) -> DataFrame:
    """Edges between samples and variants as in ``SEGS``."""
    c = calls.filter("sample_id < variant_id AND dosage IS NOT NULL").withColumn("ord", F.struct("sample_id", "variant_id"))
    inf = F.when(F.col("dosage") == 0, "PO").when(F.col("dosage") == 1, "FS").otherwise("3rd")
    return c.select(F.col("sample_id").alias("ID1"), F.col("variant_id").alias("ID2"), ((F.col("dosage") + 1).cast("double") / 4).alias("IBD1Seg"), ((F.col("sample_id") % 5).cast("double") / 8).alias("IBD2Seg"), inf.alias("InfType"), "ord")


@query(f"WITH {CALLS}, {SEGS}, {SIDES} SELECT * FROM wide")
def relatedness_pivot(spark, sf_dir):
    return reports.relatedness_wide(seg(calls(spark, sf_dir)), validate=False)


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_discount::DOUBLE / 4 + l_tax::DOUBLE / 2, 4) AS kinship FROM lineitem),
u AS (SELECT *, CAST(CAST(kinship AS DECIMAL(18, 4)) AS VARCHAR) AS d FROM t) SELECT l_orderkey, l_linenumber, l_partkey, kinship, {TEXT} AS kinship_text FROM u""")
def kinship_coefficient(spark, sf_dir):
    k = reports.kinship(F.col("l_discount"), F.col("l_tax"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", k.alias("kinship"), float_text(k).alias("kinship_text"))


@query(f"""WITH {CALLS}, {SEGS}, {SIDES}, {AF}, {HET.format('calls')},
sm AS (SELECT sample_id AS "IID", count(*) - count(dosage) AS "MISSING_CT", round((count(*) - count(dosage))::DOUBLE / count(*), 6) AS "F" FROM calls GROUP BY sample_id),
h AS (SELECT sample_id AS "IID", o_hom AS "O_HOM", round((o_hom - e_hom) / (n_nm - e_hom), 6) AS "F_het" FROM het WHERE abs(n_nm - e_hom) > 1e-9),
x AS (SELECT s_suppkey AS "IID", s_nationkey % 2 + 1 AS "PEDSEX", round(s_acctbal, 6) AS "F_sex" FROM supplier),
b AS (SELECT l_suppkey AS "IID", round(avg(l_tax), 6) AS "F_baf" FROM lineitem GROUP BY l_suppkey)
SELECT * FROM sm JOIN h USING ("IID") JOIN x USING ("IID") LEFT JOIN wide USING ("IID") LEFT JOIN b USING ("IID")""")
def sample_qc_report(spark, sf_dir):
    c = calls(spark, sf_dir)
    sm = six(stats.missingness(c, "sample_id"), "f_miss").select(F.col("sample_id").alias("IID"), F.col("missing_ct").alias("MISSING_CT"), F.col("f_miss").alias("F"))
    het = six(stats.inbreeding(c), "f").filter("f IS NOT NULL").select(F.col("sample_id").alias("IID"), F.col("o_hom").alias("O_HOM"), F.col("f").alias("F"))
    sex = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("IID"), (F.col("s_nationkey") % 2 + 1).alias("PEDSEX"), F.round("s_acctbal", 6).alias("F"))
    baf = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("IID")).agg(F.round(F.avg("l_tax"), 6).alias("F"))
    return reports.sample_qc(sm, het, sex, reports.relatedness_wide(seg(calls(spark, sf_dir)), validate=False), baf)


@query(f"WITH {ANALYSES} SELECT cohort_id, type, analysis_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY cohort_id, type ORDER BY coalesce(ts, '') DESC, analysis_id) AS rn FROM analyses) WHERE rn = 1")
def latest_analysis(spark, sf_dir):
    return catalog.latest(analyses(spark, sf_dir)).select("cohort_id", "type", "analysis_id", "ts")


@query("""WITH a AS (SELECT user_id AS cohort_id, event_id % 1000 AS analysis_id, strftime(ts, '%Y-%m-%d') AS ts FROM events),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cohort_id ORDER BY ts DESC, analysis_id DESC) AS rn FROM a) WHERE rn = 1),
g AS (SELECT analysis_id, count(DISTINCT cohort_id) > 1 AS legacy FROM a GROUP BY analysis_id), m AS (SELECT s_nationkey AS cohort_id, count(*) AS size FROM supplier GROUP BY s_nationkey)
SELECT l.cohort_id, l.analysis_id, l.ts, legacy, size FROM l LEFT JOIN g USING (analysis_id) LEFT JOIN m ON l.cohort_id = m.cohort_id""")
def latest_aggregate_id_tiebreak(spark, sf_dir):
    a = read(spark, sf_dir, "events").select(F.col("user_id").alias("cohort_id"), F.lit("k").alias("type"), (F.col("event_id") % 1000).alias("analysis_id"), F.date_format("ts", "yyyy-MM-dd").alias("ts"))
    return catalog.list_aggregates(a, plates(spark, sf_dir), "k").select("cohort_id", "analysis_id", "ts", "legacy", "size")


@query(f"""WITH {ANALYSES}, l AS (SELECT cohort_id, path FROM (SELECT *, row_number() OVER (PARTITION BY cohort_id ORDER BY ts DESC, analysis_id) AS rn FROM analyses) WHERE rn = 1)
SELECT s_suppkey AS sg_id, s_nationkey AS cohort_id, path FROM supplier JOIN l ON s_nationkey = l.cohort_id""")
def sg_plate_inversion(spark, sf_dir):
    a = analyses(spark, sf_dir).withColumn("type", F.lit("k"))
    return catalog.invert(plates(spark, sf_dir), a, "k", check=False)


@query("SELECT user_id AS sg_id, count(DISTINCT event_type) AS n_cohorts FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1")
def multi_cohort_conflicts(spark, sf_dir):
    m = read(spark, sf_dir, "events").select(F.col("user_id").alias("sg_id"), F.col("event_type").alias("cohort_id"))
    return catalog.conflicts(m, m.select("cohort_id", F.lit("k").alias("type")), "k")


def super_cohort(spark, sf_dir):
    return plates(spark, sf_dir).filter("cohort_id BETWEEN 5 AND 14").select("sg_id")


def aggregate_cohort(spark, sf_dir):
    return plates(spark, sf_dir).filter("cohort_id BETWEEN 0 AND 9").select("sg_id")


@query("SELECT s_suppkey AS sg_id FROM supplier WHERE s_nationkey BETWEEN 5 AND 14 EXCEPT SELECT s_suppkey FROM supplier WHERE s_nationkey BETWEEN 0 AND 9")
def rolling_new(spark, sf_dir):
    return catalog.new_samples(super_cohort(spark, sf_dir), aggregate_cohort(spark, sf_dir))


@query("SELECT s_suppkey AS sg_id FROM supplier WHERE s_nationkey BETWEEN 0 AND 9 EXCEPT SELECT s_suppkey FROM supplier WHERE s_nationkey BETWEEN 5 AND 14")
def rolling_withdrawn(spark, sf_dir):
    return catalog.withdrawn_samples(super_cohort(spark, sf_dir), aggregate_cohort(spark, sf_dir))


@query("SELECT s_nationkey AS cohort_id, count(*) AS new_count FROM supplier WHERE s_nationkey BETWEEN 10 AND 14 GROUP BY s_nationkey")
def plate_new_counts(spark, sf_dir):
    return catalog.plate_counts(rolling_new(spark, sf_dir), plates(spark, sf_dir))


@query(f"""WITH {CALLS}, s AS (SELECT s_suppkey, s_nationkey FROM supplier)
SELECT c.sample_id, c.variant_id, c.dosage FROM calls c JOIN s ON c.sample_id = s.s_suppkey WHERE s_nationkey BETWEEN 5 AND 14""")
def merge_keep_trim(spark, sf_dir):
    c, p = calls(spark, sf_dir), plates(spark, sf_dir).withColumnRenamed("sg_id", "sample_id")
    of = lambda a, b: c.join(p.filter(F.col("cohort_id").between(a, b)), "sample_id", "left_semi")
    carried = samples.remove(of(0, 9), rolling_withdrawn(spark, sf_dir).withColumnRenamed("sg_id", "sample_id"))
    return samples.keep(carried.unionByName(of(10, 24)), p.filter("cohort_id BETWEEN 5 AND 14"), check=False)


@query("SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_suppkey, l_partkey) = 1")
def dup_variant_exclusion(spark, sf_dir):
    return variants.exclude_duplicates(read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"), "l_suppkey", "l_partkey")


@query("""SELECT p_partkey, 'chr' || CASE p_partkey % 24 + 1 WHEN 23 THEN 'X' WHEN 24 THEN 'Y' ELSE CAST(p_partkey % 24 + 1 AS VARCHAR) END || ':' || p_partkey || ':A:G' AS variant_id, CAST(p_partkey % 24 + 1 AS VARCHAR) AS contig,
CASE WHEN p_partkey % 24 + 1 = 23 AND p_partkey * 1000 BETWEEN 10001 AND 2781479 THEN 'PAR1' WHEN p_partkey % 24 + 1 = 23 AND p_partkey * 1000 BETWEEN 155701383 AND 156030895 THEN 'PAR2'
  ELSE 'chr' || CASE p_partkey % 24 + 1 WHEN 23 THEN 'X' WHEN 24 THEN 'Y' ELSE CAST(p_partkey % 24 + 1 AS VARCHAR) END END AS par FROM part""")
def variant_id_format(spark, sf_dir):
    v = read(spark, sf_dir, "part").select("p_partkey", variants.chr_prefixed((F.col("p_partkey") % 24 + 1).cast("string")).alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.lit("rs").alias("variant_id"))
    v = variants.canonical_ids(v).withColumn("contig", variants.numeric_contig(F.col("chrom"))).withColumn("pos", F.col("pos") * 1000)
    return variants.split_par(v).select("p_partkey", "variant_id", "contig", F.col("chrom").alias("par"))


@query("SELECT p_partkey, i AS allele, string_split(p_name, ' ')[i] AS alt FROM (SELECT p_partkey, p_name, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part)")
def multiallelic_split(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.translate("p_name", " ", ",").alias("alt"))
    return variants.split_multiallelic(p).select("p_partkey", F.col("allele").cast("long").alias("allele"), "alt")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS cpg_sequencing_group_id, s_nationkey || '_' || s_suppkey AS sample_plate_position, 'plates/' || s_nationkey || '_' || s_suppkey || '.gtc' AS cpg_gcp_filepath,
s_nationkey || '_' || s_suppkey || '.gtc' AS file_name, CAST(s_nationkey AS VARCHAR) AS sample_plate FROM supplier""")
def manifest_build(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    t = lambda c: F.col(c).cast("string")
    rows = s.select(t("s_suppkey").alias("sg_id"), F.col("s_name").alias("sample_id"), F.col("s_name").alias("external_id"), F.lit("genotypingarray").alias("type"), F.create_map(F.lit("barcode"), t("s_nationkey"), F.lit("position"), t("s_suppkey"), F.lit("plate"), t("s_nationkey")).alias("meta"))
    return catalog.manifest_rows(rows, "COH", "plates/").select("cpg_sequencing_group_id", "sample_plate_position", "cpg_gcp_filepath", "file_name", "sample_plate")


@query("SELECT c_custkey AS id, c_name AS basename FROM customer WHERE contains(c_name, '7') ORDER BY c_custkey DESC LIMIT 1")
def manifest_filter_latest(spark, sf_dir):
    return catalog.latest_manifest(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("basename")), "7", "substring")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN json_extract_string(props, '$.k') WHEN event_id % 3 = 1 THEN event_type END AS path FROM events")
def analysis_path_extract(spark, sf_dir):
    bare = F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    out = F.when(F.col("event_id") % 3 == 0, F.regexp_replace("props", '"k"', '"path"')).when(F.col("event_id") % 3 == 1, bare).otherwise(F.lit("[1]"))
    return read(spark, sf_dir, "events").select("event_id", catalog.output_path(out).alias("path"))


PAIRS = "pairs AS (SELECT a.sample_id AS s1, b.sample_id AS s2, a.dosage AS d1, b.dosage AS d2, a.variant_id FROM calls a JOIN calls b ON a.variant_id = b.variant_id AND a.sample_id < b.sample_id WHERE a.dosage IS NOT NULL AND b.dosage IS NOT NULL)"


@query(f"WITH {CALLS}, {PAIRS} SELECT s1, s2, count(*) FILTER (WHERE abs(d1 - d2) = 2) AS ibs0, count(*) FILTER (WHERE abs(d1 - d2) = 1) AS ibs1, count(*) FILTER (WHERE d1 = d2) AS ibs2 FROM pairs GROUP BY s1, s2")
def ibs_pairs(spark, sf_dir):
    return ibd.ibs_counts(calls(spark, sf_dir))


SEGMENTS = """r{0} AS (SELECT *, variant_id % 22 + 1 AS chrom, CASE WHEN {1} THEN 1 ELSE 0 END AS brk FROM pairs),
i{0} AS (SELECT *, sum(brk) OVER (PARTITION BY s1, s2, chrom ORDER BY variant_id ROWS UNBOUNDED PRECEDING) AS island FROM r{0}),
seg{0} AS (SELECT s1, s2, chrom, min(variant_id) AS start_pos, max(variant_id) AS end_pos, count(*) AS n_snps FROM i{0} WHERE brk = 0 GROUP BY s1, s2, chrom, island HAVING count(*) >= {2})"""


def placed(spark, sf_dir):
    return calls(spark, sf_dir).withColumn("chrom", F.col("variant_id") % 22 + 1).withColumn("pos", F.col("variant_id"))


@query(f"WITH {CALLS}, {PAIRS}, {SEGMENTS.format(1, 'abs(d1 - d2) = 2', 8)} SELECT * FROM seg1")
def ibd_segments(spark, sf_dir):
    return ibd.segments(placed(spark, sf_dir), 8)


@query(f"""WITH {CALLS}, {PAIRS}, {SEGMENTS.format(1, 'abs(d1 - d2) = 2', 8)}, {SEGMENTS.format(2, 'd1 <> d2', 4)},
a AS (SELECT s1, s2, sum(end_pos - start_pos + 1) AS l1, max(end_pos - start_pos + 1) AS m1 FROM seg1 GROUP BY s1, s2), b AS (SELECT s1, s2, sum(end_pos - start_pos + 1) AS l2, max(end_pos - start_pos + 1) AS m2 FROM seg2 GROUP BY s1, s2),
c AS (SELECT coalesce(a.s1, b.s1) AS s1, coalesce(a.s2, b.s2) AS s2, coalesce(l1, 0) AS l1, coalesce(l2, 0) AS l2, coalesce(m1, 0) AS m1, coalesce(m2, 0) AS m2 FROM a FULL JOIN b ON a.s1 = b.s1 AND a.s2 = b.s2),
d AS (SELECT *, l2 / 10000.0::DOUBLE AS ibd2, greatest(0.0::DOUBLE, l1 / 10000.0::DOUBLE - l2 / 10000.0::DOUBLE) AS ibd1 FROM c)
SELECT s1, s2, round(ibd1, 6) AS "IBD1Seg", round(ibd2, 6) AS "IBD2Seg", round(ibd1 / 2 + ibd2, 6) AS "PropIBD", CAST(m1 AS BIGINT) AS "MaxIBD1", CAST(m2 AS BIGINT) AS "MaxIBD2",
CASE WHEN ibd2 > 0.7 THEN 'Dup/MZ' WHEN ibd1 / 2 + ibd2 >= 0.35355 AND ibd2 >= 0.08 THEN 'FS' WHEN ibd1 / 2 + ibd2 >= 0.35355 THEN 'PO' WHEN ibd1 / 2 + ibd2 >= 0.17678 THEN '2nd' WHEN ibd1 / 2 + ibd2 >= 0.08839 THEN '3rd' END AS inf FROM d""")
def ibd_sharing(spark, sf_dir):
    c = placed(spark, sf_dir)
    out = ibd.sharing(ibd.all_segments(c, {1: 8, 2: 4}), 10_000)
    out = out.withColumn("inf", ibd.relationship(F.col("PropIBD"), F.col("IBD1Seg"), F.col("IBD2Seg")))
    return six(out, "IBD1Seg", "IBD2Seg", "PropIBD")


ON_X = SEGMENTS.replace("variant_id % 22 + 1", "'chrX'")


@query(f"""WITH {CALLS.replace('calls AS', 'every AS')}, calls AS (SELECT * FROM every WHERE variant_id % 2 = 0), {PAIRS}, {ON_X.format(1, 'abs(d1 - d2) = 2', 6)}, {ON_X.format(2, 'd1 <> d2', 6)},
a AS (SELECT s1, s2, sum(end_pos - start_pos + 1) AS l1, max(end_pos - start_pos + 1) AS m1 FROM seg1 GROUP BY s1, s2), b AS (SELECT s1, s2, sum(end_pos - start_pos + 1) AS l2, max(end_pos - start_pos + 1) AS m2 FROM seg2 GROUP BY s1, s2),
c AS (SELECT coalesce(a.s1, b.s1) AS s1, coalesce(a.s2, b.s2) AS s2, coalesce(l1, 0) / 10000.0::DOUBLE AS x1, coalesce(l2, 0) / 10000.0::DOUBLE AS x2, coalesce(m1, 0) AS m1, coalesce(m2, 0) AS m2 FROM a FULL JOIN b ON a.s1 = b.s1 AND a.s2 = b.s2)
SELECT s1 AS "ID1", s2 AS "ID2", CAST(p.s_nationkey % 2 + 1 AS INT) AS "Sex1", CAST(q.s_nationkey % 2 + 1 AS INT) AS "Sex2", CAST(m1 AS BIGINT) AS "MaxIBD1", CAST(m2 AS BIGINT) AS "MaxIBD2",
round(greatest(0.0::DOUBLE, x1 - x2), 6) AS "IBD1Seg", round(x2, 6) AS "IBD2Seg", round(greatest(0.0::DOUBLE, x1 - x2) / 2 + x2, 6) AS "PropIBD" FROM c JOIN supplier p ON s1 = p.s_suppkey JOIN supplier q ON s2 = q.s_suppkey""")
def ibd_sharing_x(spark, sf_dir):
    c = calls(spark, sf_dir).withColumn("pos", F.col("variant_id")).withColumn("chrom", F.when(F.col("variant_id") % 2 == 0, "chrX").otherwise("chr1"))
    people = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample_id"), (F.col("s_nationkey") % 2 + 1).alias("sex"))
    return six(ibd.sharing_x(c, people, 10_000, 6), "IBD1Seg", "IBD2Seg", "PropIBD")


@query("""SELECT l_suppkey AS variant_id, CAST(sum(1) AS BIGINT) AS obs_ct, CAST(count(*) FILTER (WHERE l_linenumber % 4 = 3) AS BIGINT) AS missing_ct, CAST(coalesce(sum(CASE WHEN l_linenumber % 4 < 3 THEN l_linenumber % 4 END), 0) AS BIGINT) AS alt_ct,
CAST(count(*) FILTER (WHERE l_linenumber % 4 = 1) AS BIGINT) AS het_ct FROM lineitem GROUP BY l_suppkey""")
def rolling_totals(spark, sf_dir):
    from ..streaming.rolling import variant_totals

    c = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("variant_id"), F.when(F.col("l_linenumber") % 4 != 3, F.col("l_linenumber") % 4).alias("dosage"))
    return variant_totals(c)


@query("SELECT e.event_id, p.p_partkey, p.p_size AS af FROM events e JOIN part p ON e.event_id % 2000 = p.p_partkey")
def site_annotation(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.lit("c").alias("chrom"), (F.col("event_id") % 2000).alias("pos"), F.lit("A").alias("ref"), F.lit("G").alias("alt"))
    p = read(spark, sf_dir, "part").select(F.lit("c").alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.col("p_size").alias("af"))
    return variants.with_frequency(e, p).filter("af IS NOT NULL").select("event_id", F.col("pos").alias("p_partkey"), "af")
