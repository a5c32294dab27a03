"""The command line, and the nine stages from GTC files to reports."""

import json
import random

import numpy as np
import pytest

from loculoom.operators import catalog, stats
from loculoom.plans import cli, cohort, workflow
from loculoom.sources import binary, files, plink, readers

MANIFEST = ("file_name,sample_sheet_id,sample_id,md5sum,bbv_barcode,sentrix_barcode_a,sentrix_position_a,sample_plate,sample_well,sample_plate_position,"
            "cpg_sample_id_internal,cpg_gcp_filepath,cpg_sequencing_group_id,cpg_cohort_id")  # fmt: skip


def part(path):
    return "".join(p.read_text() for p in sorted(path.glob("part*")))


def test_variant_command(spark, tmp_path, capsys):
    (tmp_path / "egt").write_text("chr1\t1\tA\tG\trs1\t0.9\t0.8\nchr1\t2\tA\tG\trs2\t.\t0.8\n")
    (tmp_path / "vmiss").write_text("#CHROM\tID\tMISSING_CT\tOBS_CT\tF_MISS\nchr1\tchr1:1:A:G\t0\t9\t0\nchr1\tchr1:2:A:G\t0\t9\t0\n")
    (tmp_path / "hwe").write_text("chr1:1:A:G\n \nchr1:2:A:G\n")
    flags = ["variant-qc", "--egt-info-tsv", "egt", "--merged-vmiss", "vmiss", "--hwe-pass-snplist", "hwe", "--gentrain-min", "0.7", "--cluster-sep-min", "0.4", "--fmiss-max", "0.02",
             "--output-audit-tsv", "a", "--output-inclusion-list", "i", "--output-summary-tsv", "s"]
    flags = [str(tmp_path / f) if f in ("egt", "vmiss", "hwe", "a", "i", "s") else f for f in flags]
    assert cli.main(flags, spark) == 0
    assert part(tmp_path / "i") == "chr1:1:A:G\n" and "first_fail_gentrain\t1" in part(tmp_path / "s")
    with pytest.raises(SystemExit):
        cli.main(flags[:-2], spark)


def test_sample_command(spark, tmp_path, capsys):
    for name, text in (("smiss", "#IID F_MISS\nB 0.1\nA 0.2\n"), ("het", "#IID F\nA 0.5\nB 0.4\n"), ("sex", "#IID STATUS\nA OK\nB OK\n"), ("seg", "FID1 ID1 FID2 ID2\n")):
        (tmp_path / name).write_text(text)
    path = lambda n: str(tmp_path / n)
    flags = ["sample-qc", "--smiss", path("smiss"), "--het", path("het"), "--sexcheck", path("sex"), "--seg", path("seg")]
    with pytest.warns(UserWarning):
        assert cli.main([*flags, "--output", path("out"), "--bafregress", path("none")], spark) == 0
    lines = part(tmp_path / "out").splitlines()
    assert [x.split(",")[0] for x in lines] == ["IID", "B", "A"] and lines[0].endswith("RELATED_3RD")
    assert cli.main(["sample-qc", "--smiss", path("absent"), *flags[3:], "--output", path("out2")], spark) == 1
    assert "absent" in capsys.readouterr().err


#: The merge plan of the test below.
PLAN = [
    "Rolling merge plan (previous aggregate cohort OLD):",
    "  super cohort:          3 SGs",
    "  carried forward:       1 SGs (from previous aggregate)",
    "  withdrawn:             1 SGs ['z']",
    "  new:                   2 SGs from 2 plate cohort(s):",
    "       P1:  1 new SGs",
    "       P2:  1 new SGs",
    "  expected merged total: 3 SGs",
]


def test_catalogue_commands(spark, tmp_path, capsys):
    of = lambda i, kind, ts, path: {"id": i, "type": kind, "timestampCompleted": ts, "outputs": {"path": path}}
    cohorts = [
        {"id": "P1", "name": "p1", "sequencingGroups": [{"id": "a"}, {"id": "b"}], "analyses": [of(1, "array_cohort_bed", "2024-01", "x/p1.bed")]},
        {"id": "P2", "name": "p2", "sequencingGroups": [{"id": "c"}], "analyses": [of(2, "array_cohort_bed", "2024-02", "x/p2.bed")]},
        {"id": "OLD", "name": "old", "sequencingGroups": [{"id": "a"}, {"id": "z"}], "analyses": [of(3, "array_aggregate_pgen", "2024-03", "x/old.pgen")]},
        {"id": "NEW", "name": "new", "sequencingGroups": [{"id": "a"}, {"id": "b"}, {"id": "c"}], "analyses": []},
    ]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, cohorts)))
    where = ["--registry", str(tmp_path / "r.json")]
    assert cli.main(["aggregates", *where], spark) == 0
    assert [x.split() for x in capsys.readouterr().out.splitlines()] == [["COHORT_ID", "COHORT_NAME", "N_SGS", "CREATED", "ANALYSIS_ID", "OUTPUT"], ["OLD", "old", "2", "2024-03", "3", "x/old.pgen"]]
    assert cli.main(["merge-plan", *where, "--cohort", "NEW", "--previous", "OLD"], spark) == 0
    out = capsys.readouterr().out
    assert out.splitlines() == PLAN
    for bad in (["--cohort", "none"], ["--cohort", "NEW", "--previous", "none"], ["--cohort", "NEW", "--previous", "P1"]):
        assert cli.main(["merge-plan", *where, *bad], spark) == 1


def test_manifest_command(spark, tmp_path, capsys):
    (tmp_path / "gtc").mkdir()
    (tmp_path / "gtc/1_R1.gtc").write_bytes(b"x")
    rows = [("g1", "s1", "e1", "genotypingarray", {"barcode": "1", "position": "R1"})]
    spark.createDataFrame(rows, "sg_id string, sample_id string, external_id string, type string, meta map<string,string>").write.parquet(str(tmp_path / "s"))
    flags = ["manifest", "--samples", str(tmp_path / "s"), "--cohort", "C", "--gtc-prefix", str(tmp_path / "gtc"), "--output", str(tmp_path / "m")]
    assert cli.main([*flags, "--dry-run"], spark) == 0
    assert capsys.readouterr().out.splitlines()[0] == MANIFEST and not (tmp_path / "m").exists()
    assert cli.main(flags, spark) == 0 and "1_R1.gtc" in part(tmp_path / "m")
    assert cli.main(flags, spark) == 1 and cli.main([*flags, "--force"], spark) == 0
    (tmp_path / "gtc/1_R1.gtc").write_bytes(b"")
    assert cli.main([*flags, "--force"], spark) == 1


def test_stages_end_to_end(spark, tmp_path):
    rng, path = random.Random(3), lambda n: str(tmp_path / n)
    loci = [("chr1" if i < 40 else "chrX" if i < 50 else "chrY", 3_000_000 + 1000 * i) for i in range(55)]
    sites = [(i + 1, c, p, "A", "G") for i, (c, p) in enumerate(loci)]
    spark.createDataFrame(sites, "bpm_index int, chrom string, pos long, ref string, alt string").write.parquet(path("sites"))
    lines, names, plates = [MANIFEST], [f"SG{i}" for i in range(6)], {}
    for plate, group in (("p1", names[:4]), ("p2", names[4:])):
        (tmp_path / plate).mkdir()
        for n in group:
            # SG1 copies SG0, so the two are duplicates
            g = plates["SG0"] if n == "SG1" else np.array([rng.choice([0, 1, 2, 2, 3]) for _ in loci])
            plates[n] = g
            binary.write_gtc(path(f"{plate}/{n}.gtc"), f"9_{n}", {"genotypes": g, "scores": g / 4, "baf": np.clip((g - 1) / 2, 0, 1), "lrr": g * 0.0, "x": g, "y": g})
            lines.append(f"{n}.gtc,,,,,9,{n},,,,,{path(plate)}/{n}.gtc,{n},{plate}")
    (tmp_path / "manifest.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "egt").write_text("".join(f"{c}\t{p}\tA\tG\trs{i}\t0.9\t0.8\n" for i, (c, p) in enumerate(loci)))
    spark.createDataFrame([(n, 1 + i % 2) for i, n in enumerate(names)], "sample_id string, sex int").write.parquet(path("sexes"))
    for plate in ("p1", "p2"):
        given = cohort.PlateInputs(path(plate), path("sites"), path("manifest.csv"), path("sexes"))
        assert cohort.run(spark, given, plate, list(workflow.PHASE1), path("out"), plate, path("registry"))[0] == "GtcToBcfs: done"
    assert cohort.run(spark, given, plate, ["GtcToBcfs"], path("out"), plate) == ["GtcToBcfs: reused"]
    wanted = [n for n in names if n != "SG3"]
    spark.createDataFrame([(n,) for n in wanted], "sample_id string").write.parquet(path("wanted"))
    merge = cohort.MergeInputs(
        tuple(path(f"out/{p}/CohortBcfToPlink") for p in ("p1", "p2")), path("wanted"), path("egt"), baf=tuple(path(f"out/{p}/BafRegress/baf") for p in ("p1", "p2")),
        genome_length=39_001, min_samples=0, min_snps=5, min_bp=0,
    )
    assert cohort.run(spark, merge, "C", list(workflow.PHASE2), path("out"), "w", dry_run=True)[0].endswith("would run")
    with pytest.raises(ValueError, match="other phase"):
        cohort.run(spark, merge, "C", ["BafRegress"], path("out"), "w")
    log = cohort.run(spark, merge, "C", list(workflow.PHASE2), path("out"), "w", path("registry"))
    assert len(log) == 6 and all(x.endswith("done") for x in log)
    got = {r.sample_id: (r.missing_ct, r.obs_ct) for r in spark.read.parquet(path("out/w/Plink2Qc/C/smiss")).collect()}
    assert got == {n: (int((plates[n] == 0).sum()), len(loci)) for n in wanted}
    assert stats.missingness(spark.read.parquet(path("out/w/ExportCohortDatasets/C/calls")), "variant_id").count() == len(loci)
    report = spark.read.csv(path("out/w/QcReport/C/report"), header=True)
    by = {r.IID: r for r in report.collect()}
    assert set(by) == set(wanted) and by["SG0"].RELATED_MZ.startswith("SG1:") and by["SG0"].RELATED_MZ.endswith("Dup/MZ") and "contamination" in report.columns
    assert report.columns[:6] == ["FID", "IID", "MISSING_CT", "OBS_CT", "F_MISS", "O_HOM"] and {"PEDSEX", "SNPSEX", "STATUS", "F_sex"} < set(report.columns)
    calls = {(r.variant_id, r.sample_id): r.dosage for r in spark.read.parquet(path("out/w/ExportCohortDatasets/C/calls")).collect()}
    to = path("out/w/ExportCohortDatasets/C/cohort")
    for back in (files.read_bcf(spark, to + ".bcf"), plink.read_plink2(spark, to), files.read_bcf(spark, to + ".bcf", "chr1").unionByName(files.read_bcf(spark, to + ".bcf").filter("chrom <> 'chr1'"))):
        back = back.collect()
        assert len(back) == len(loci) * len(wanted) and all(calls[r.variant_id, r.sample_id] == r.dosage for r in back)
    of = path("out/p1/CohortBcfToPlink")
    fam = [x.split("\t") for x in (tmp_path / "out/p1/CohortBcfToPlink/plink.fam").read_text().splitlines()]
    assert [(x[1], x[4]) for x in fam] == [(n, str(1 + i % 2)) for i, n in enumerate(names[:4])]
    back = plink.read_plink1(spark, of + "/plink").collect()
    plate = {(r.variant_id, r.sample_id): r.dosage for r in spark.read.parquet(of + "/calls").collect()}
    assert {(r.variant_id, r.sample_id): r.dosage for r in back} == plate
    about = spark.read.csv(path("out/p1/GtcToBcfs/metadata"), sep="\t", header=True).orderBy("file").collect()
    assert [(r.sample_name, int(r.n_loci)) for r in about] == [(f"9_{n}", len(loci)) for n in names[:4]] and abs(float(about[0].call_rate) - (plates["SG0"] != 0).mean()) < 1e-6
    found = part(tmp_path / "out/w/KingIbdseg/C/seg_tsv").splitlines()
    assert found[0] == "FID1\tID1\tFID2\tID2\tIBD1Seg\tIBD2Seg\tPropIBD\tInfType" and any(x.startswith("0\tSG0\t0\tSG1\t") for x in found[1:])
    assert part(tmp_path / "out/w/KingIbdseg/C/seg_x_tsv").startswith("FID1\tID1\tFID2\tID2\tSex1\tSex2\tMaxIBD1") and not spark.read.parquet(path("out/w/KingIbdseg/C/segments")).isEmpty()
    rows = spark.read.csv(path("out/w/KingIbdseg/C/segments_tsv"), sep="\t", header=True)
    assert rows.columns == ["FID1", "ID1", "FID2", "ID2", "IBDType", "Chr", "StartPos", "StopPos", "N_SNP"] and {"IBD1", "IBD2"} >= {r.IBDType for r in rows.collect()} and rows.count() == spark.read.parquet(path("out/w/KingIbdseg/C/segments")).count()
    assert list((tmp_path / "out/w/KingIbdseg/C/segments_x_tsv").glob("part*.gz"))
    summary = dict(x.split("\t") for x in part(tmp_path / "out/w/SnpQcReport/C/summary").splitlines())
    audit = spark.read.csv(path("out/w/SnpQcReport/C/audit"), sep="\t", header=True).select("ID").collect()
    assert [r.ID for r in audit] == [f"{c}:{p}:A:G" for c, p in loci]
    assert summary["total_variants"] == str(len(loci)) and int(summary["total_excluded"]) + int(summary["total_retained"]) == len(loci)
    analyses = readers.registry(spark, path("registry"))[1]
    assert analyses.filter("path IS NULL OR ts IS NULL OR analysis_id IS NULL").isEmpty()
    assert catalog.latest(analyses.filter("type = 'array_aggregate_pgen'")).collect()[0].cohort_id == "C"
    kinds = sorted(r.type for r in analyses.collect())
    assert kinds.count("array_cohort_bed") == 2 and "array_qc_report" in kinds and "manifest" not in kinds
