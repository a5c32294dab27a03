"""Catalogue algebra on literal rows."""

import json

import pytest

from loculoom.operators import catalog
from loculoom.plans import workflow
from loculoom.sources import readers, writers

BED = "array_cohort_bed"


def tables(spark, cohorts):
    """cohorts: (id, members, [(type, ts, path)])"""
    m = [(c, s, i) for i, (c, sgs, _) in enumerate(cohorts) for s in sgs]
    a = [(c, t, ts, p, i, i) for c, _, xs in cohorts for i, (t, ts, p) in enumerate(xs)]
    return spark.createDataFrame(m, "cohort_id string, sg_id string, ordinal long"), spark.createDataFrame(a, "cohort_id string, type string, ts string, path string, ordinal int, analysis_id long")


def test_inversion(spark):
    m, a = tables(spark, [("COH5", ["1", "2"], [(BED, "2026-01", "old.bed"), (BED, "2026-06", "a.bed")]), ("COH6", ["3"], [(BED, None, "b.bed")]), ("COH9", ["1", "3"], [("array_aggregate_pgen", "2026", "x.pgen")])])
    assert {r.sg_id: r.bim for r in catalog.bed_map(m, a).collect()} == {"1": "a.bim", "2": "a.bim", "3": "b.bim"}
    assert catalog.first_cohort(m, "3") == "COH6"
    with pytest.raises(ValueError, match="no cohort"):
        catalog.first_cohort(m, "9")
    m2, a2 = tables(spark, [("A", ["1"], [(BED, "1", "a.bed")]), ("B", ["1"], [(BED, "1", "b.bed")])])
    with pytest.raises(ValueError, match="more than one cohort"):
        catalog.invert(m2, a2, BED)
    m3, a3 = tables(spark, [("A", ["1"], [(BED, "1", None)])])
    with pytest.raises(ValueError, match="without path"):
        catalog.invert(m3, a3, BED)
    m4, a4 = tables(spark, [("A", ["1"], [(BED, "1", "a.pgen")])])
    with pytest.raises(Exception, match="not a .bed path"):
        catalog.bed_map(m4, a4).collect()
    m5, a5 = tables(spark, [("A", ["1"], [("array_bafregress", "1", "a.txt")])])
    assert catalog.baf_map(m5, a5, m5).count() == 1
    with pytest.raises(ValueError, match="2"):
        catalog.baf_map(m5, a5, spark.createDataFrame([("2",)], "sg_id string"))


def test_rolling_plan(spark):
    m, a = tables(spark, [("AGG", ["1", "2", "3"], [("array_aggregate_pgen", "1", "agg.pgen")]), ("COH5", ["4", "5"], [(BED, "1", "5.bed")]), ("COH6", ["6"], [(BED, "1", "6.bed")]), ("OLD", ["1", "2"], [(BED, "1", "o.bed")])])
    want = spark.createDataFrame([(x,) for x in "12456"], "sg_id string")
    plan = catalog.merge_plan(m, a, want, "AGG")
    assert plan["samples_to_remove"] == ["3"] and plan["size"] == 5 and plan["previous"]["psam"] == "agg.psam"
    assert [(p["cohort_id"], p["new_count"]) for p in plan["plates"]] == [("COH5", 2), ("COH6", 1)]
    text = catalog.format_merge_plan(plan, "AGG")
    assert "  carried forward:       2 SGs (from previous aggregate)" in text.splitlines() and "  withdrawn:             1 SGs ['3']" in text.splitlines() and text.index("COH5") < text.index("COH6")
    boot = catalog.merge_plan(m, a, spark.createDataFrame([("4",)], "sg_id string"))
    assert boot["previous"] is None and boot["samples_to_remove"] == [] and len(boot["plates"]) == 1
    for prev, ids, match in (("NONE", "1", "not found"), ("COH5", "1", "no aggregate"), ("AGG", "9", "plate fileset")):
        with pytest.raises(ValueError, match=match):
            catalog.merge_plan(m, a, spark.createDataFrame([(x,) for x in ids], "sg_id string"), prev)


def test_registry_and_manifest(spark, tmp_path):
    rows = [{"id": "C1", "name": "n", "sequencingGroups": [{"id": "S1"}], "analyses": [{"id": 1, "type": "k", "timestampCompleted": "t", "outputs": "bare"}, {"id": 2, "type": "k", "timestampCompleted": "t", "outputs": {"path": "p"}}, {"id": 3, "type": "k", "outputs": {"x": 1}}]}]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, rows)))
    m, a = readers.registry(spark, str(tmp_path / "r.json"))
    assert m.count() == 1 and {r.analysis_id: r.path for r in a.collect()} == {1: "bare", 2: "p", 3: None}
    assert catalog.latest(a).collect()[0].analysis_id == 1  # a tie: the first listed
    assert catalog.latest_by_id(a, "cohort_id").collect()[0].analysis_id == 2
    s = spark.createDataFrame([("S1", "X1", "e", "genotypingarray", {"barcode": "b", "position": "p2", "plate": "P"}), ("S2", "X2", "e", "genotypingarray", {"barcode": "b", "position": "p1", "plate": "P"})], "sg_id string, sample_id string, external_id string, type string, meta map<string,string>")
    out = catalog.manifest_rows(s, "COH", "gs/")
    assert [r.sample_plate_position for r in out.collect()] == ["b_p1", "b_p2"] and out.columns == list(readers.MANIFEST_COLUMNS)
    writers.manifest(out, str(tmp_path / "m"))
    with pytest.raises(Exception, match="(?i)exist"):
        writers.manifest(out, str(tmp_path / "m"))
    back = readers.manifest_csv(spark, str(tmp_path / "m"))
    assert {r.sg_id: r.gtc for r in readers.manifest_paths(back).collect()} == {"S1": "gs/b_p2.gtc", "S2": "gs/b_p1.gtc"}
    assert {r.old_name for r in readers.manifest_reheader(back).collect()} == {"b_p1", "b_p2"}
    for bad, match in ((s.limit(0), "missing or empty"), (s.withColumn("type", readers.F.lit("wgs")), "wrong type"), (s.withColumn("meta", readers.F.create_map(readers.F.lit("barcode"), readers.F.lit("b"), readers.F.lit("position"), readers.F.lit("p"))), "shared wells")):
        with pytest.raises(ValueError, match=match):
            catalog.manifest_rows(bad, "COH", "x")
    named = spark.createDataFrame([("10", "COH001_genotyping_array"), ("20", "COH001_genotyping_array"), ("30", "COH0010_x")], "id string, basename string")
    assert catalog.latest_manifest(named, "COH001").collect()[0].id == "20"
    assert catalog.latest_manifest(named, "COH001", "substring").collect()[0].id == "30"
    with pytest.raises(ValueError, match="missing"):
        catalog.check_files(spark.createDataFrame([("a",), ("b",)], "path string"), spark.createDataFrame([("a", 0)], "path string, length long"))
    assert catalog.format_table([{"a": 1, "b": None}], ["a", "b"]).splitlines()[1] == "1  -"


def test_small_readers(spark, tmp_path):
    for name, text, want in (("a", "#IID\tFID\nCPG001\tF\nCPG002\tF\n", ["CPG001", "CPG002"]), ("b", "CPG001\tx\n", ["CPG001"]), ("c", "0\tCPG9\t0\t0\t1\t-9\n", ["CPG9"])):
        (tmp_path / name).write_text(text)
        assert [r.iid for r in readers.psam(spark, str(tmp_path / name)).collect()] == want
    (tmp_path / "bpm").write_text("[Header]\nx\nIndex,Name,Chr\n1,a,1\n2,b,X\n[Controls]\n7,z,1\n")
    assert [r.chrom for r in readers.bpm_loci(spark, str(tmp_path / "bpm")).orderBy("bpm_index").collect()] == ["1", "X"]
    (tmp_path / "bad").write_text("Index,Name,Chr\n1,a,1\n3,b,X\n")
    with pytest.raises(ValueError):
        readers.bpm_loci(spark, str(tmp_path / "bad"))
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\nchr1\t5\t.\tA\tG\t.\t.\tAF=0.25;Q=1\tGT:GQ\t0/1:30\t./.:.\n")
    assert readers.af_reference(spark, str(tmp_path / "v.vcf")).collect()[0].af == 0.25
    assert {r.sample_id: (r.dosage, r.gq) for r in readers.vcf_calls(spark, str(tmp_path / "v.vcf")).collect()} == {"S1": (1, 30), "S2": (None, None)}


def test_phases():
    assert workflow.validate_selection(["BafRegress"], ["a", "b"]) == 1 and workflow.validate_selection(["QcReport"], ["a"]) == 2
    for only, cohorts, match in ((None, ["a"], "not set"), (["bafregress"], ["a"], "unknown"), (["BafRegress", "QcReport"], ["a"], "both"), (["QcReport"], [], "exactly one"), (["QcReport"], ["a", "b"], "exactly one")):
        with pytest.raises(ValueError, match=match):
            workflow.validate_selection(only, cohorts)
    ran, made = [], []
    stages = {n: workflow.Stage(n, lambda c, n=n: ran.append(n), n, workflow.NEEDS[n], workflow.REGISTERS.get(n)) for n in workflow.PHASE2}
    r = workflow.Runner(stages, done=lambda p: p == "MergeCohortPlink", register=lambda k, p: made.append(k))
    r.run({})
    assert "MergeCohortPlink" not in ran and ran.index("QcReport") > ran.index("KingIbdseg") and "array_qc_report" in made
    assert workflow.output_prefix("r/", "w", "S", "1") == "r/w/S/1" and workflow.project_name("p", True) == "p-test" == workflow.project_name("p-test", True)


def test_manifest_lookup_raises(spark):
    named = spark.createDataFrame([("9", "genotyping_array_COH001.csv", None), ("3", "genotyping_array_COH002.csv", "x/2.csv")], "id string, basename string, path string")
    assert catalog.manifest_path(named, "COH002") == "x/2.csv"
    with pytest.raises(ValueError, match="No manifest found for cohort COH7; there are: genotyping_array_COH001"):
        catalog.manifest_path(named, "COH7")
    with pytest.raises(ValueError, match="has no path"):
        catalog.manifest_path(named, "COH001")
    manifest = spark.createDataFrame([("s1", "a.gtc")], "sg_id string, gtc string")
    assert catalog.gtc_path(manifest, "s1") == "a.gtc"
    with pytest.raises(ValueError, match="s2 is not in the manifest of 1 entries"):
        catalog.gtc_path(manifest, "s2")


def test_listing(spark):
    rows = [{"cohort_id": "C1", "cohort_name": None, "size": 3, "ts": None, "analysis_id": 7, "path": "p", "legacy": True}, {"cohort_id": "C2", "cohort_name": "two", "size": None, "ts": "t", "analysis_id": 8, "path": None, "legacy": False}]
    assert catalog.format_listing(rows).splitlines() == [
        "COHORT_ID  COHORT_NAME  N_SGS  CREATED  ANALYSIS_ID  OUTPUT",
        "C1         C1 [legacy]  3      -        7            p     ",
        "C2         two          0      t        8            -     ",
    ]


def test_errors_name_a_bounded_list(spark, monkeypatch):
    wanted = spark.createDataFrame([(f"s{i}",) for i in range(9)], "sg_id string")
    found = spark.createDataFrame([("s0",)], "sg_id string")
    with pytest.raises(ValueError, match="for: s1, s2, s3, s4, s5, s6, s7, s8$"):
        catalog.requested(found, wanted, "plate")
    monkeypatch.setattr(catalog, "NAMED", 3)
    with pytest.raises(ValueError, match="no plate for: s1, s2, s3 and 5 more"):
        catalog.requested(found, wanted, "plate")
    paths, listed = wanted.withColumnRenamed("sg_id", "path"), spark.createDataFrame([("s0", 0), ("s1", 0), ("s1", 4)], "path string, length long")
    with pytest.raises(ValueError, match=r"missing: \[s2, s3, s4 and 4 more\]; empty: \[s0\]"):
        catalog.check_files(paths, listed)
    assert {(r.path, r.fault) for r in catalog.faulty_files(paths, listed).filter("fault = 'empty'").collect()} == {("s0", "empty")}
    assert catalog.check_files(paths.limit(0), listed) is None
