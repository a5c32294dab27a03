"""Variant and sample QC reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import float_text, ordered_concat, passes, require

#: The metrics of the summary, in order.
SUMMARY = ("total_variants", "first_fail_gentrain", "first_fail_cluster_sep", "first_fail_fmiss", "first_fail_hwe", "fail_gentrain", "fail_cluster_sep", "fail_fmiss", "fail_hwe", "total_excluded", "total_retained")
#: Relationship classes by column of the sample report.
DEGREES = {"Dup/MZ": "RELATED_MZ", "PO": "RELATED_1ST", "FS": "RELATED_1ST", "2nd": "RELATED_2ND", "3rd": "RELATED_3RD"}
DEGREE_COLUMNS = ["RELATED_MZ", "RELATED_1ST", "RELATED_2ND", "RELATED_3RD"]
SEG_COLUMNS = ("ID1", "ID2", "IBD1Seg", "IBD2Seg", "InfType")


def flag_variants(df: DataFrame, hwe_ids: DataFrame | None, gentrain_min: float = 0.7, cluster_sep_min: float = 0.4, fmiss_max: float = 0.02) -> DataFrame:
    """Add five pass flags to a frame with ID, GenTrain_Score, Cluster_Sep and F_MISS; null never passes, bounds are inclusive.

    The test's outcome is membership in ``hwe_ids``, or (None) the frame's own ``pass_hwe``.
    """
    out = df.withColumn("pass_gentrain", passes(F.col("GenTrain_Score") >= gentrain_min, F.col("GenTrain_Score")))
    out = out.withColumn("pass_cluster_sep", passes(F.col("Cluster_Sep") >= cluster_sep_min, F.col("Cluster_Sep")))
    out = out.withColumn("pass_fmiss", passes(F.col("F_MISS") <= fmiss_max, F.col("F_MISS")))
    if hwe_ids is None:
        out = out.withColumn("pass_hwe", F.coalesce("pass_hwe", F.lit(False)))
    else:
        ids = hwe_ids.select(F.col("ID").alias("hwe_id")).distinct()
        out = out.join(ids, F.col("ID") == F.col("hwe_id"), "left").withColumn("pass_hwe", F.col("hwe_id").isNotNull()).drop("hwe_id")
    return out.withColumn("pass", F.col("pass_gentrain") & F.col("pass_cluster_sep") & F.col("pass_fmiss") & F.col("pass_hwe"))


def summary_row(flagged: DataFrame) -> DataFrame:
    """Eleven counts in one pass: disjoint first failures in order, overlapping failures, excluded and retained."""
    tests, before, firsts, fails = ("gentrain", "cluster_sep", "fmiss", "hwe"), F.lit(True), [], []
    for t in tests:
        ok = F.col(f"pass_{t}")
        firsts.append(F.count_if(before & ~ok).alias(f"first_fail_{t}"))
        fails.append(F.count_if(~ok).alias(f"fail_{t}"))
        before = before & ok
    return flagged.agg(F.count("*").alias("total_variants"), *firsts, *fails, F.count_if(~F.col("pass")).alias("total_excluded"), F.count_if("pass").alias("total_retained"))


def summary(flagged: DataFrame) -> DataFrame:
    """metric and value, one row a count, in order."""
    pairs = ", ".join(f"{i}, '{m}', {m}" for i, m in enumerate(SUMMARY))
    return summary_row(flagged).selectExpr(f"stack({len(SUMMARY)}, {pairs}) AS (ord, metric, value)").orderBy("ord").select("metric", "value")


def variant_qc(egt: DataFrame, vmiss: DataFrame, hwe_ids: DataFrame, **thresholds: float) -> DataFrame:
    """Flags of every array variant; duplicate ids are kept, and a variant without missingness fails.  Further columns of ``egt`` (its order) stay."""
    return flag_variants(egt.join(vmiss.select("ID", "F_MISS"), "ID", "left"), hwe_ids, **thresholds)


def variant_qc_of(egt: DataFrame, tested: DataFrame, **thresholds: float) -> DataFrame:
    """``variant_qc`` where missingness and test are columns of one table ``tested(ID, F_MISS, pass_hwe)``: one join."""
    return flag_variants(egt.join(tested.select("ID", "F_MISS", "pass_hwe"), "ID", "left"), None, **thresholds)


def kinship(ibd1, ibd2):
    """Half of the expected sharing, to four places, half-even."""
    return F.bround(ibd1 / 4 + ibd2 / 2, 4)


def relatedness_wide(seg: DataFrame, validate: bool = True) -> DataFrame:
    """IID and four columns of relatives (id:kinship:class joined by ';'), both directions, in file order (``ord``, else as given)."""
    require(seg, *SEG_COLUMNS)
    if validate:
        unknown = sorted(r.InfType or "null" for r in seg.select("InfType").distinct().filter(F.col("InfType").isNull() | ~F.col("InfType").isin(*DEGREES)).limit(20).collect())
        if unknown:
            raise ValueError(f"unknown InfType: {', '.join(unknown)}")
    if "ord" not in seg.columns:
        seg = seg.withColumn("ord", F.monotonically_increasing_id())
    degree = F.create_map(*[x for k, v in DEGREES.items() for x in (F.lit(k), F.lit(v))])
    base = seg.withColumn("degree", F.element_at(degree, F.col("InfType"))).withColumn("k", float_text(kinship(F.col("IBD1Seg"), F.col("IBD2Seg"))))
    # both directions of an edge out of one row, so that the edges are read once
    ends = [F.struct(F.lit(i).alias("side"), F.col(me).alias("IID"), F.concat_ws(":", F.col(you).cast("string"), "k", "InfType").alias("payload")) for i, me, you in ((0, "ID1", "ID2"), (1, "ID2", "ID1"))]
    sides = base.select("ord", "degree", F.inline(F.array(*ends))).filter("IID IS NOT NULL")
    joined = sides.groupBy("IID", "degree").agg(ordered_concat(["side", "ord"], "payload").alias("payload"))
    return joined.groupBy("IID").pivot("degree", DEGREE_COLUMNS).agg(F.first("payload"))


#: Columns of the external tools by those of this package.
TOOL_COLUMNS = {
    "missing_ct": "MISSING_CT", "obs_ct": "OBS_CT", "f_miss": "F_MISS", "o_hom": "O_HOM", "e_hom": "E_HOM", "n_nm": "N_NM", "f": "F", "pedsex": "PEDSEX", "snpsex": "SNPSEX",
    "status": "STATUS", "xf": "F", "ycount": "YCOUNT", "yrate": "YRATE",
}


def tool_names(table: DataFrame) -> DataFrame:
    """A table of the raw QC with the tools' column names, keyed by FID (0: none) and IID."""
    out = table.withColumnRenamed("sample_id", "IID").withColumnsRenamed({k: v for k, v in TOOL_COLUMNS.items() if k in table.columns})
    return out.select(F.lit("0").alias("FID"), "IID", *[c for c in out.columns if c != "IID"])


def join_suffixed(left: DataFrame, right: DataFrame, on: list[str], suffix: str, how: str = "inner") -> DataFrame:
    """Equi-join in which only the right side's colliding columns get the suffix."""
    for c in right.columns:
        if c in left.columns and c not in on:
            right = right.withColumnRenamed(c, c + suffix)
    return left.join(right, on, how)


def sample_qc(smiss: DataFrame, het: DataFrame, sexcheck: DataFrame, related: DataFrame | None = None, baf: DataFrame | None = None) -> DataFrame:
    """The wide sample report: inner with het and sexcheck, left with relatives and contamination."""
    on = [c for c in ("FID", "IID") if c in smiss.columns]
    out = join_suffixed(join_suffixed(smiss, het, on, "_het"), sexcheck, on, "_sex")
    if related is not None:
        out = out.join(related, "IID", "left")
    if baf is not None and "IID" in baf.columns:
        out = join_suffixed(out, baf, ["IID"], "_baf", "left")
    # joins put their keys first
    return out.select(*smiss.columns, *[c for c in out.columns if c not in smiss.columns])
