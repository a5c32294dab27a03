"""Configuration files, registration after a crash, sexes from the registry, and the small files beside the stages."""

import gzip
import json

import numpy as np
import pytest

from loculoom.operators import catalog
from loculoom.plans import cli, cohort, workflow
from loculoom.sources import binary, readers, writers

MANIFEST = ",".join(readers.MANIFEST_COLUMNS)
LOCI = [("chr1", 1000 + 10 * i) for i in range(12)] + [("chrX", 5_000_000), ("chrY", 6_000_000)]


def part(path):
    return "".join(p.read_text() for p in sorted(path.glob("part*")))


@pytest.fixture
def plate(spark, tmp_path):
    rng = np.random.default_rng(5)
    (tmp_path / "gtc").mkdir()
    lines = [MANIFEST]
    for k in range(4):
        g = rng.integers(0, 4, len(LOCI))
        binary.write_gtc(str(tmp_path / f"gtc/S{k}.gtc"), f"9_S{k}", {"genotypes": g, "scores": g / 4, "baf": np.clip((g - 1) / 2, 0, 1), "lrr": g * 0.0, "x": g, "y": g})
        lines.append(f"S{k}.gtc,,,,,9,S{k},,,,,{tmp_path}/gtc/S{k}.gtc,SG{k},P")
    (tmp_path / "P.csv").write_text("\n".join(lines) + "\n")
    sites = [(i + 1, c, p, "A", "G") for i, (c, p) in enumerate(LOCI)]
    spark.createDataFrame(sites, "bpm_index int, chrom string, pos long, ref string, alt string").write.parquet(str(tmp_path / "sites"))
    with open(tmp_path / "r.fa", "w") as f:
        bases = {c: ["C"] * 6_000_010 for c in ("chr1", "chrX", "chrY")}
        for c, p in LOCI:
            bases[c][p - 1] = "A"
        index, at = "", 0
        for c, b in bases.items():
            head = f">{c}\n"
            index += f"{c}\t{len(b)}\t{at + len(head)}\t{len(b)}\t{len(b) + 1}\n"
            f.write(head + "".join(b) + "\n")
            at += len(head) + len(b) + 1
    (tmp_path / "r.fa.fai").write_text(index)
    sex = lambda k: {"sample": {"participant": {"reportedSex": ["Male", "2", "unknown", None][k]}}}
    (tmp_path / "reg").mkdir()
    (tmp_path / "reg/a.json").write_text(json.dumps({"id": "P", "name": "p", "sequencingGroups": [{"id": f"SG{k}", **sex(k)} for k in range(4)], "analyses": []}) + "\n")
    return tmp_path


PHASE1 = """
[workflow]
name = "w"
only_stages = ["GtcToBcfs", "BafRegress", "CohortBcfToPlink"]
input_cohorts = ["P"]
output_root = "{at}/out"
registry = "{at}/reg"
[array.references]
fasta_ref_path = "hg38/fasta"
[references.hg38]
fasta = "{at}/r.fa"
[inputs]
gtc = "{at}/gtc"
sites = "{at}/sites"
manifest = "{at}/{{cohort}}.csv"
registry = "{at}/reg"
"""
PHASE2 = """
[workflow]
name = "w"
only_stages = ["MergeCohortPlink", "ExportCohortDatasets", "SnpQcReport"]
input_cohorts = ["C"]
output_root = "{at}/out"
registry = "{at}/reg"
[array.snp_qc_report.thresholds]
gentrain_min = {gentrain}
fmiss_max = 1.0
[inputs.C]
plates = ["{at}/out/w/P/CohortBcfToPlink"]
wanted = "{at}/wanted"
egt = "{at}/egt"
"""


def test_runs_by_configuration(spark, plate, capsys):
    config = plate / "c.toml"
    config.write_text(PHASE1.format(at=plate))
    assert cli.main(["run", str(config), "--dry-run"], spark) == 0
    assert capsys.readouterr().out.split("\n")[:3] == [f"P: {n}: would run" for n in workflow.PHASE1] and not (plate / "out").exists()
    assert cli.main(["run", str(config)], spark) == 0 and "P: CohortBcfToPlink: done" in capsys.readouterr().out
    at = plate / "out/w/P"
    assert [x.split("\t")[4] for x in (at / "CohortBcfToPlink/plink.fam").read_text().splitlines()] == ["1", "2", "0", "0"]
    assert part(at / "CohortBcfToPlink/sexes") == "0\tSG0\t1\n0\tSG1\t2\n" and part(at / "GtcToBcfs/reheader") == "".join(f"9_S{k} SG{k}\n" for k in range(4))
    spark.createDataFrame([(f"SG{k}",) for k in range(3)], "sample_id string").write.parquet(str(plate / "wanted"))
    (plate / "egt").write_text("".join(f"{c}\t{p}\tA\tG\trs{i}\t{0.5 + i / 100}\t0.8\n" for i, (c, p) in enumerate(LOCI)))
    (plate / "reg/b.json").write_text(json.dumps({"id": "Q", "name": "q", "sequencingGroups": [{"id": "SG1"}, {"id": "SG8"}], "analyses": []}) + "\n")
    (plate / "Q.csv").write_text((plate / "P.csv").read_text())
    config.write_text(PHASE1.format(at=plate).replace('["P"]', '["Q"]'))
    assert cli.main(["run", str(config)], spark) == 1 and "complete manifest row for: SG8" in capsys.readouterr().err
    found = {}
    for gentrain in (0.2, 0.57):
        config.write_text(PHASE2.format(at=plate, gentrain=gentrain).replace('name = "w"', f'name = "w{gentrain}"'))
        assert cli.main(["run", str(config)], spark) == 0
        found[gentrain] = dict(x.split("\t") for x in part(plate / f"out/w{gentrain}/SnpQcReport/C/summary").splitlines())
        assert part(plate / f"out/w{gentrain}/MergeCohortPlink/C/keep") == "0\tSG0\n0\tSG1\n0\tSG2\n"
    assert found[0.2]["first_fail_gentrain"] == "0" and found[0.57]["first_fail_gentrain"] == "7"
    for bad in (PHASE2.replace("gentrain_min", "gentrain"), PHASE2.replace("fmiss_max = 1.0", "fmiss_max = true"), PHASE2.replace("egt =", "egg ="), PHASE2.replace("wanted", "#wanted"), PHASE1.replace('"hg38/fasta"', '"hg38/none"'), "[workflow]\n", PHASE2 + "[other]\n"):
        config.write_text(bad.format(at=plate, gentrain=0.1))
        assert cli.main(["run", str(config)], spark) == 1
    assert cli.main(["run", str(plate / "none.toml")], spark) == 1


def test_a_run_that_dies_before_registration(spark, plate, monkeypatch):
    """The output is committed, the run dies; the next one registers it, once."""
    given = cohort.PlateInputs(str(plate / "gtc"), str(plate / "sites"), str(plate / "P.csv"))
    where = ("P", list(workflow.PHASE1), str(plate / "out"), "w", str(plate / "reg"))
    whole = writers.register

    def die(spark, name, kind, output, path):
        if kind == "array_cohort_bed":
            raise KeyboardInterrupt
        return whole(spark, name, kind, output, path)

    monkeypatch.setattr(writers, "register", die)
    with pytest.raises(KeyboardInterrupt):
        cohort.run(spark, given, *where)
    monkeypatch.setattr(writers, "register", whole)
    of = lambda: sorted(r.type for r in readers.registry(spark, str(plate / "reg"))[1].collect())
    assert of() == ["array_bafregress"]
    assert cohort.run(spark, given, *where, dry_run=True)[-1] == "CohortBcfToPlink: reused" and of() == ["array_bafregress"]
    assert cohort.run(spark, given, *where) == ["GtcToBcfs: reused", "BafRegress: reused", "CohortBcfToPlink: reused, registered now"]
    assert cohort.run(spark, given, *where)[-1] == "CohortBcfToPlink: reused"
    assert of() == ["array_bafregress", "array_cohort_bed"]
    assert not writers.registered(spark, str(plate / "nowhere"), "x") and writers.registered(spark, str(plate / "reg"), str(plate / "out/w/CohortBcfToPlink/calls"))


def test_absent_samples_are_told(spark):
    manifest = spark.createDataFrame([("a", "a.gtc", "1_1")], "sg_id string, gtc string, old_name string")
    of = lambda *ids: spark.createDataFrame([(i,) for i in ids], "sg_id string")
    assert [r.gtc for r in catalog.gtc_mapping(manifest, of("a")).collect()] == ["a.gtc"]
    with pytest.raises(ValueError, match="for: b, c"):
        catalog.gtc_mapping(manifest, of("a", "c", "b"))


def test_contigs_and_frequencies(spark, tmp_path):
    (tmp_path / "dump").write_text("Index,Name,Chr\n1,a,1\n2,b,X\n3,c,1\n[Controls]\n")
    assert cli.main(["contigs", "--manifest-dump", str(tmp_path / "dump"), "--output", str(tmp_path / "contigs")], spark) == 0
    assert gzip.open(next((tmp_path / "contigs").glob("part*")), "rt").read() == "1\nX\n1\n"
    assert [r.chrom for r in readers.bpm_chroms(spark, str(tmp_path / "contigs"), 2).orderBy("bpm_index").collect()] == ["1", "X"]
    calls = [("chr2:5:A:G", "chr2", 5, "A", "G", s, d) for s, d in (("a", 1), ("b", 2), ("c", None))] + [("chr10:5:A:T", "chr10", 5, "A", "T", "a", 0), ("chr1:7:C:T", "chr1", 7, "C", "T", "a", None)]
    spark.createDataFrame(calls, "variant_id string, chrom string, pos long, ref string, alt string, sample_id string, dosage int").write.parquet(str(tmp_path / "calls"))
    assert cli.main(["frequencies", "--calls", str(tmp_path / "calls"), "--output", str(tmp_path / "af")], spark) == 0
    assert {(r.chrom, r.alt): r.af for r in readers.af_reference(spark, str(tmp_path / "af")).collect()} == {("chr2", "G"): 0.75, ("chr10", "T"): 0.0, ("chr1", "T"): None}
    text = "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / "af").glob("part*")))
    assert [x.split("\t")[0] for x in text.splitlines() if not x.startswith("##")] == ["#CHROM", "chr1", "chr2", "chr10"]
    (tmp_path / "egt.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr1\t7\trs1\tC\tT\t.\t.\tGenTrain_Score=0.9;Cluster_Sep=.\n")
    row = readers.cluster_scores(spark, str(tmp_path / "egt.vcf")).collect()[0]
    assert (row.ID, row.GenTrain_Score, row.Cluster_Sep) == ("chr1:7:C:T", 0.9, None)
