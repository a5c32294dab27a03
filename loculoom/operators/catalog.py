"""Catalogue algebra over cohort members and registered analyses.

``member(cohort_id, sg_id)`` and ``analysis(cohort_id, type, ts, path, ordinal, analysis_id)``; ``ordinal`` is the order in which
the registry lists analyses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def output_path(outputs: Column) -> Column:
    """Path of an output that is registered as JSON: a bare string, or an object with ``path``; else null."""
    v = F.try_parse_json(outputs)
    kind = F.schema_of_variant(v)
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind.startswith("OBJECT"), F.try_variant_get(v, "$.path", "string"))


def latest(analyses: DataFrame, *keys: str) -> DataFrame:
    """The analysis with the largest timestamp per key (null lowest); of equal ones the first listed."""
    w = Window.partitionBy(*(keys or ("cohort_id", "type"))).orderBy(F.coalesce("ts", F.lit("")).desc(), F.col("ordinal"))
    return analyses.withColumn("rn_", F.row_number().over(w)).filter("rn_ = 1").drop("rn_")


def latest_by_id(analyses: DataFrame, *keys: str) -> DataFrame:
    """The analysis with the largest (timestamp, id) per key, by partial aggregation."""
    rest = [c for c in analyses.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.coalesce("ts", F.lit("")), F.coalesce("analysis_id", F.lit(0)))).alias("a_")
    return analyses.groupBy(*keys).agg(best).select(*keys, "a_.*")


def list_aggregates(analyses: DataFrame, members: DataFrame, kind: str) -> DataFrame:
    """Newest first: each cohort's latest aggregate, its size, and whether the analysis is shared by several cohorts (legacy)."""
    of = analyses.filter(F.col("type") == kind)
    shared = of.groupBy("analysis_id").agg((F.count_distinct("cohort_id") > 1).alias("legacy"))
    name = F.first("cohort_name", ignorenulls=True) if "cohort_name" in members.columns else F.lit(None).cast("string")
    sizes = members.groupBy("cohort_id").agg(F.count("*").alias("size"), name.alias("cohort_name"))
    out = latest_by_id(of, "cohort_id").join(shared, "analysis_id", "left").join(sizes, "cohort_id", "left")
    return out.orderBy(F.coalesce("ts", F.lit("")).desc(), F.coalesce(F.col("cohort_id").cast("string"), F.lit("")).desc())


def conflicts(members: DataFrame, analyses: DataFrame, kind: str) -> DataFrame:
    """Samples in more than one cohort that has an analysis of the kind."""
    having = analyses.filter(F.col("type") == kind).select("cohort_id").distinct()
    return members.join(having, "cohort_id", "left_semi").groupBy("sg_id").agg(F.count_distinct("cohort_id").alias("n_cohorts")).filter("n_cohorts > 1")


def invert(members: DataFrame, analyses: DataFrame, kind: str, check: bool = True) -> DataFrame:
    """sg_id, cohort_id and path of the latest analysis of a kind; with ``check`` a sample in two cohorts or a latest analysis without path is an error."""
    last = latest(analyses.filter(F.col("type") == kind)).select("cohort_id", "path")
    if check:
        bad = last.join(members.select("cohort_id").distinct(), "cohort_id", "left_semi").filter("path IS NULL").orderBy("cohort_id").limit(5).collect()
        if bad:
            raise ValueError(f"analysis without path in {', '.join(str(r.cohort_id) for r in bad)}")
        twice = conflicts(members, analyses, kind).orderBy("sg_id").limit(5).collect()
        if twice:
            raise ValueError(f"in more than one cohort: {', '.join(str(r.sg_id) for r in twice)}")
    return members.join(last, "cohort_id").select("sg_id", "cohort_id", "path")


def sibling(path: Column, old: str, new: str) -> Column:
    """Swap the suffix of a fileset path; any other suffix is an error when the row is read."""
    ok = F.assert_true(path.endswith(old), F.concat(F.lit(f"not a {old} path: "), path))
    return F.coalesce(ok.cast("string"), F.regexp_replace(path, rf"\{old}$", new))


def bed_map(members: DataFrame, analyses: DataFrame, kind: str = "array_cohort_bed", check: bool = True) -> DataFrame:
    """sg_id, cohort_id and its plate's bed, bim and fam."""
    out = invert(members, analyses, kind, check)
    return out.select("sg_id", "cohort_id", F.col("path").alias("bed"), sibling(F.col("path"), ".bed", ".bim").alias("bim"), sibling(F.col("path"), ".bed", ".fam").alias("fam"))


#: Faults that one error names; it tells the number of all.
NAMED = 1_000


def named(faults: DataFrame, column: str) -> tuple[list, int]:
    """The least ``NAMED`` values of a column, and how many rows there are."""
    first = [r[0] for r in faults.select(column).orderBy(column).limit(NAMED + 1).collect()]
    return first[:NAMED], len(first) if len(first) <= NAMED else faults.count()


def enumerated(values: list, n: int) -> str:
    return ", ".join(map(str, values)) + (f" and {n - len(values)} more" if n > len(values) else "")


def requested(found: DataFrame, wanted: DataFrame, what: str) -> DataFrame:
    """The rows of ``found`` for ``wanted(sg_id)``; samples without one are raised together."""
    missing, n = named(wanted.select("sg_id").distinct().join(found, "sg_id", "left_anti"), "sg_id")
    if missing:
        raise ValueError(f"no {what} for: {enumerated(missing, n)}")
    return found.join(wanted.select("sg_id").distinct(), "sg_id", "left_semi")


def baf_map(members: DataFrame, analyses: DataFrame, wanted: DataFrame) -> DataFrame:
    return requested(invert(members, analyses, "array_bafregress").select("sg_id", "path"), wanted, "contamination report")


def first_cohort(members: DataFrame, sg: str) -> str:
    """The first listed cohort (by ``ordinal``) that holds a sample."""
    got = members.filter(F.col("sg_id") == sg).agg(F.min_by("cohort_id", "ordinal").alias("c")).collect()[0].c
    if got is None:
        raise ValueError(f"{sg} is in no cohort")
    return got


def new_samples(everyone: DataFrame, aggregate: DataFrame) -> DataFrame:
    return everyone.select("sg_id").distinct().join(aggregate, "sg_id", "left_anti")


def withdrawn_samples(everyone: DataFrame, aggregate: DataFrame) -> DataFrame:
    return aggregate.select("sg_id").distinct().join(everyone, "sg_id", "left_anti")


def plate_counts(new: DataFrame, plates: DataFrame) -> DataFrame:
    """New samples per plate; plates without any are not pulled."""
    return new.join(plates, "sg_id").groupBy("cohort_id").agg(F.count("*").alias("new_count"))


def plates_to_merge(members: DataFrame, analyses: DataFrame, everyone: DataFrame, aggregate: DataFrame) -> DataFrame:
    """cohort_id, bed, bim, fam and new_count of the plates that bring samples which the aggregate lacks; samples without a plate are raised."""
    plates = requested(bed_map(members, analyses), new_samples(everyone, aggregate), "plate fileset")
    return plates.groupBy("cohort_id", "bed", "bim", "fam").agg(F.count("*").alias("new_count"))


def merge_plan(members: DataFrame, analyses: DataFrame, super_ids: DataFrame, previous: str | None = None) -> dict:
    """What a rolling merge does: the previous fileset, the samples to remove, the plates that bring new samples, and the size.

    Only the plan (plates and withdrawn samples of one cohort) reaches the driver.
    """
    spark = members.sparkSession
    aggregate, prev = spark.createDataFrame([], "sg_id string"), None
    if previous is not None:
        if members.filter(F.col("cohort_id") == previous).isEmpty():
            raise ValueError(f"previous cohort {previous} not found")
        last = latest(analyses.filter((F.col("cohort_id") == previous) & (F.col("type") == "array_aggregate_pgen"))).collect()
        if not last:
            raise ValueError(f"{previous} has no aggregate")
        path = last[0].path
        if not path or not path.endswith(".pgen"):
            raise ValueError(f"the aggregate of {previous} has no valid .pgen path")
        prev = {s: path.removesuffix(".pgen") + f".{s}" for s in ("pgen", "pvar", "psam")}
        aggregate = members.filter(F.col("cohort_id") == previous).select("sg_id")
    new = new_samples(super_ids, aggregate)
    pulled = [] if new.isEmpty() else [r.asDict() for r in plates_to_merge(members, analyses, super_ids, aggregate).orderBy("cohort_id").collect()]
    gone = [r.sg_id for r in withdrawn_samples(super_ids, aggregate).orderBy("sg_id").collect()]
    return {"previous": prev, "samples_to_remove": gone, "plates": pulled, "size": super_ids.select("sg_id").distinct().count()}


def format_merge_plan(plan: dict, previous: str | None) -> str:
    """The plan as text: sizes, withdrawn ids, plates by id.  The wording of its lines is an interchange format."""
    new, gone, plates = sum(p["new_count"] for p in plan["plates"]), plan["samples_to_remove"], plan["plates"]
    what = f"previous aggregate cohort {previous}" if previous else "bootstrap \u2014 no previous aggregate"
    rows = [
        ("super cohort:", f"{plan['size']} SGs"), ("carried forward:", f"{plan['size'] - new} SGs (from previous aggregate)"), ("withdrawn:", f"{len(gone)} SGs" + (f" {gone}" if gone else "")),
        ("new:", f"{new} SGs from {len(plates)} plate cohort(s):"),
    ]
    text = [f"Rolling merge plan ({what}):", *(f"  {k:<23}{v}" for k, v in rows), *(f"       {p['cohort_id']}:  {p['new_count']} new SGs" for p in sorted(plates, key=lambda p: p["cohort_id"]))]
    return "\n".join([*text, f"  {'expected merged total:':<23}{plan['size']} SGs"])


def latest_manifest(manifests: DataFrame, token: str, match: str = "exact") -> DataFrame:
    """The manifest(id, basename, path) with the largest id whose basename names a cohort: as a token, or (``substring``) anywhere."""
    name = F.col("basename")
    hit = name.contains(token) if match == "substring" else F.array_contains(F.split(name, r"[^A-Za-z0-9]+"), token)
    return manifests.filter(hit).orderBy(F.coalesce(F.col("id").try_cast("long"), F.lit(0)).desc()).limit(1)


def manifest_path(manifests: DataFrame, cohort_id: str, match: str = "substring") -> str:
    """The path of a cohort's latest manifest; none, or one without a path, is an error."""
    got = latest_manifest(manifests, cohort_id, match).collect()
    if not got:
        names = [r.basename for r in manifests.select("basename").orderBy("basename").limit(20).collect()]
        raise ValueError(f"No manifest found for cohort {cohort_id}; there are: {', '.join(map(str, names))}")
    if not got[0].path:
        raise ValueError(f"manifest {got[0].id} of cohort {cohort_id} has no path")
    return got[0].path


def gtc_mapping(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """sg_id, gtc and old_name of a cohort's samples by the manifest; samples that it does not list in full are raised together."""
    return requested(manifest, members, "complete manifest row")


def gtc_path(manifest: DataFrame, sg_id: str) -> str:
    """The GTC file of one sample by ``manifest(sg_id, gtc)``; a sample that is not listed is an error."""
    got = manifest.filter(F.col("sg_id") == sg_id).select("gtc").limit(1).collect()
    if not got:
        raise ValueError(f"{sg_id} is not in the manifest of {manifest.count()} entries")
    return got[0].gtc


def manifest_rows(samples: DataFrame, cohort_id: str, folder: str) -> DataFrame:
    """The 14-column manifest of samples(sg_id, sample_id, external_id, type, meta map, plate), by plate, barcode and position."""
    bad = samples.filter((F.col("type") != "genotypingarray") | F.try_element_at("meta", F.lit("barcode")).isNull() | F.try_element_at("meta", F.lit("position")).isNull())
    wrong = bad.select("sg_id").orderBy("sg_id").limit(20).collect()
    if samples.isEmpty():
        raise ValueError(f"{cohort_id} is missing or empty")
    if wrong:
        raise ValueError(f"wrong type or missing barcode or position: {', '.join(r.sg_id for r in wrong)}")
    m = lambda k: F.try_element_at("meta", F.lit(k))
    well = F.concat_ws("_", m("barcode"), m("position"))
    shared = samples.groupBy(well.alias("well")).agg(F.count("*").alias("n")).filter("n > 1").orderBy("well").limit(20).collect()
    if shared:
        raise ValueError(f"shared wells: {', '.join(r.well for r in shared)}")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return samples.select(
        F.concat(well, F.lit(".gtc")).alias("file_name"), blank(m("sample_sheet_id")).alias("sample_sheet_id"), blank(F.col("external_id")).alias("sample_id"), blank(m("md5sum")).alias("md5sum"),
        blank(m("bbv_barcode")).alias("bbv_barcode"), m("barcode").alias("sentrix_barcode_a"), m("position").alias("sentrix_position_a"), blank(m("plate")).alias("sample_plate"),
        blank(m("well")).alias("sample_well"), well.alias("sample_plate_position"), F.col("sample_id").alias("cpg_sample_id_internal"),
        F.concat(F.lit(folder.rstrip("/") + "/"), well, F.lit(".gtc")).alias("cpg_gcp_filepath"), F.col("sg_id").alias("cpg_sequencing_group_id"), F.lit(cohort_id).alias("cpg_cohort_id"),
    ).orderBy("sample_plate", "sentrix_barcode_a", "sentrix_position_a")


def faulty_files(wanted: DataFrame, listed: DataFrame) -> DataFrame:
    """path and fault (missing, empty) of every ``wanted(path)`` that ``listed(path, length)`` does not hold with content."""
    both = wanted.select("path").distinct().join(listed.groupBy("path").agg(F.max("length").alias("length")), "path", "left")
    return both.filter("length IS NULL OR length = 0").select("path", F.when(F.col("length").isNull(), "missing").otherwise("empty").alias("fault"))


def check_files(wanted: DataFrame, listed: DataFrame) -> None:
    """``faulty_files`` is empty; all faults are raised together."""
    bad = faulty_files(wanted, listed)
    of = {k: named(bad.filter(F.col("fault") == k), "path") for k in ("missing", "empty")}
    if any(n for _, n in of.values()):
        raise ValueError("; ".join(f"{k}: [{enumerated(paths, n)}]" for k, (paths, n) in of.items()))


#: The headers of the listing and the columns under them.
LISTING = {"COHORT_ID": "cohort_id", "COHORT_NAME": "cohort_name", "N_SGS": "size", "CREATED": "ts", "ANALYSIS_ID": "analysis_id", "OUTPUT": "path"}


def format_listing(rows: list[dict]) -> str:
    """The listing of aggregates; a cohort without a name goes by its id, and legacy aggregates are marked behind the name."""
    named = [r | {"cohort_name": (r.get("cohort_name") or r["cohort_id"] or "-") + (" [legacy]" if r.get("legacy") else ""), "size": r.get("size") or 0} for r in rows]
    return format_table([{h: r.get(c) or (0 if c == "size" else None) for h, c in LISTING.items()} for r in named], list(LISTING))


def format_table(rows: list[dict], columns: list[str]) -> str:
    """Left-justified columns two spaces apart, '-' for null."""
    text = [[("-" if r.get(c) is None else str(r[c])) for c in columns] for r in rows]
    width = [max([len(c), *(len(t[i]) for t in text)]) for i, c in enumerate(columns)]
    line = lambda cells: "  ".join(x.ljust(w) for x, w in zip(cells, width))
    return "\n".join([line(columns), *map(line, text)])
