"""Binary interchange round trips."""

import numpy as np

from loculoom.sources import binary, files, plink, readers, writers


def test_gtc(spark, tmp_path):
    g = np.array([0, 1, 2, 3])
    binary.write_gtc(str(tmp_path / "a.gtc"), "s" * 200, {"genotypes": g, "scores": g / 4, "baf": g / 3, "lrr": -g / 2, "x": g, "y": g * 1000})
    rows = binary.read_gtc(spark, str(tmp_path)).orderBy("bpm_index").collect()
    assert [r.dosage for r in rows] == [None, 0, 1, 2] and rows[3].y == 3000 and rows[0].sample_id == "s" * 200


def test_files_of_unlike_plates(spark, tmp_path):
    # v2 is not on s1's plate and nobody is called at v1; contigs sort by number, five samples need two bytes a site
    rows = [("v0", "chr2", 5, "s0", 2), ("v0", "chr2", 5, "s1", 1), ("v0", "chr2", 5, "s4", 0), ("v1", "chr10", 1, "s0", None), ("v2", "chr1", 9, "s3", 1)]
    calls = spark.createDataFrame([(v, c, p, "A", "G", s, d) for v, c, p, s, d in rows], "variant_id string, chrom string, pos long, ref string, alt string, sample_id string, dosage int")
    people = files.samples_in_order(spark.createDataFrame([(f"s{i}", None if i == 2 else 1) for i in range(5)] + [("s0", 1)], "sample_id string, sex int"))
    files.write_plink1(files.genotype_rows(calls, people), people, str(tmp_path / "f"))
    assert [r.variant_id for r in readers.bim(spark, str(tmp_path / "f.bim")).orderBy("ord").collect()] == ["v2", "v0", "v1"]
    assert [x.split("\t")[4] for x in (tmp_path / "f.fam").read_text().splitlines()] == ["1", "1", "0", "1", "1"]
    want = {(f"v{v}", f"s{s}"): None for v in range(3) for s in range(5)} | {(v, s): d for v, _, _, s, d in rows}
    assert {(r.variant_id, r.sample_id): r.dosage for r in plink.read_plink1(spark, str(tmp_path / "f")).collect()} == want


def test_no_relatives(spark, tmp_path):
    none = spark.createDataFrame([], "ID1 string, ID2 string, IBD1Seg double, IBD2Seg double, PropIBD double, InfType string")
    writers.segments(none, str(tmp_path / "seg"))
    assert "".join(p.read_text() for p in (tmp_path / "seg").glob("part*")) == "FID1\tID1\tFID2\tID2\tIBD1Seg\tIBD2Seg\tPropIBD\tInfType\n"
