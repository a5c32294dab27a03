"""Sample QC on literal rows."""

import pytest

from loculoom.operators import reports
from loculoom.sources import readers, writers

SEG = "ID1 string, ID2 string, IBD1Seg double, IBD2Seg double, PropIBD double, InfType string"


def test_report(spark, tmp_path):
    (tmp_path / "smiss").write_text("#FID IID  MISSING_CT OBS_CT\tF_MISS\nFAM1 S1 10 1000 0.01\nFAM2 S2 20 1000 0.02\n")
    (tmp_path / "het").write_text("#FID\tIID\tO_HOM\tF\nFAM1\tS1\t500\t0.02\nFAM2\tS2\t510\t0.04\n")
    (tmp_path / "sex").write_text("#FID IID PEDSEX STATUS F\nFAM1 S1 1 OK 0.99\nFAM2 S2 2 OK .\n")
    (tmp_path / "b1").write_text("sample_id LRR_mean\nS1 0.005\n")
    with pytest.warns(UserWarning):
        baf = readers.bafregress(spark, [str(tmp_path / "b1"), str(tmp_path / "absent")])
    read = lambda n: readers.whitespace_table(spark, str(tmp_path / n))
    seg = spark.createDataFrame([("S1", "S2", 0.5, 0.25, 0.75, "FS"), ("S1", "S3", 0.18, 0.0, 0.09, "3rd")], SEG)
    out = reports.sample_qc(read("smiss"), read("het").drop("ord"), read("sex").drop("ord"), reports.relatedness_wide(seg), baf)
    rows = {r.IID: r for r in out.collect()}
    assert rows["S1"].F == 0.02 and rows["S1"].F_sex == 0.99 and rows["S2"].F_sex is None
    assert rows["S1"].RELATED_1ST == "S2:0.25:FS" and rows["S2"].RELATED_1ST == "S1:0.25:FS" and rows["S1"].RELATED_3RD == "S3:0.045:3rd"
    assert rows["S1"].RELATED_2ND is None and rows["S1"].LRR_mean == 0.005 and rows["S2"].LRR_mean is None
    writers.sample_qc(out, str(tmp_path / "csv"))
    lines = "".join(p.read_text() for p in (tmp_path / "csv").glob("part*")).splitlines()
    assert lines[0].startswith("IID") or "FID" in lines[0] and len(lines) == 3
    assert readers.bafregress(spark, []).columns == ["IID"]


def test_relatives(spark):
    po = reports.relatedness_wide(spark.createDataFrame([("P", "C", 1.0, 0.0, 0.5, "PO")], SEG)).collect()
    assert {r.IID: r.RELATED_1ST for r in po} == {"P": "C:0.25:PO", "C": "P:0.25:PO"}
    assert reports.relatedness_wide(spark.createDataFrame([], SEG)).columns == ["IID", *reports.DEGREE_COLUMNS]
    with pytest.raises(ValueError, match="UN"):
        reports.relatedness_wide(spark.createDataFrame([("a", "b", 0.01, 0.0, 0.0, "UN")], SEG))
    with pytest.raises(ValueError, match="missing columns"):
        reports.relatedness_wide(spark.createDataFrame([("a",)], "COL_A string"))
