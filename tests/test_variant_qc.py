"""Variant QC on literal rows."""

import gzip
from pathlib import Path

import pytest

from loculoom.operators import reports
from loculoom.sources import readers, writers

ROWS = [
    ("chr1", 100, "A", "G", "rs1", "0.95", "0.80", 0.0), ("chr1", 200, "A", "T", "rs2", "0.90", "0.70", 0.01), ("chr1", 300, "C", "G", "rs3", "0.85", "0.60", 0.01),
    ("chr2", 100, "C", "T", "rs4", "0.65", "0.50", 0.01), ("chr2", 200, "G", "A", "rs5", "0.80", "0.30", 0.01), ("chr2", 300, "T", "C", "rs6", ".", ".", 0.01),
    ("chr3", 100, "CAG", "C", "rs7", "0.90", "0.55", 0.10), ("chr3", 200, "A", "G", "rs8", "0.95", "0.70", 0.0),
]


@pytest.fixture()
def inputs(spark, tmp_path):
    ident = [f"{r[0]}:{r[1]}:{r[2]}:{r[3]}" for r in ROWS]
    (tmp_path / "egt.tsv").write_text("".join("\t".join(map(str, r[:7])) + "\n" for r in ROWS))
    (tmp_path / "vmiss").write_text("#CHROM\tID\tMISSING_CT\tOBS_CT\tF_MISS\n" + "".join(f"{r[0]}\t{i}\t{int(r[7] * 100)}\t100\t{r[7]}\n" for r, i in zip(ROWS, ident)))
    (tmp_path / "pass").write_text("\n".join([*ident[:7], "", "   "]) + "\n")
    return readers.egt_info(spark, str(tmp_path / "egt.tsv")), readers.vmiss(spark, str(tmp_path / "vmiss")), readers.id_list(spark, str(tmp_path / "pass"))


def test_readers(inputs):
    egt, vmiss, ids = inputs
    rows = egt.collect()
    assert [r.ID for r in rows][:2] == ["chr1:100:A:G", "chr1:200:A:T"]
    assert rows[5].GenTrain_Score is None and rows[5].Cluster_Sep is None
    assert vmiss.columns == ["ID", "F_MISS"] and ids.count() == 7


def test_summary_and_sinks(inputs, tmp_path):
    flagged = reports.variant_qc(*inputs)
    got = {r.metric: r.value for r in reports.summary(flagged).collect()}
    assert got == {
        "total_variants": 8, "fail_gentrain": 2, "fail_cluster_sep": 2, "fail_fmiss": 1, "fail_hwe": 1, "first_fail_gentrain": 2, "first_fail_cluster_sep": 1, "first_fail_fmiss": 1,
        "first_fail_hwe": 1, "total_excluded": 5, "total_retained": 3,
    }
    writers.variant_qc(flagged, *(str(tmp_path / x) for x in ("audit", "incl", "sum")))
    lines = gzip.open(next((tmp_path / "audit").glob("*.gz")), "rt").read().splitlines()
    assert lines[0].split("\t") == writers.AUDIT and len(lines) == 9 and "True" in lines[1]
    assert len("".join(p.read_text() for p in (tmp_path / "incl").glob("part*")).split()) == 3
    assert "".join(p.read_text() for p in (tmp_path / "sum").glob("part*")).splitlines()[1] == "total_variants\t8"


def test_null_and_nan_never_pass(spark):
    df = spark.createDataFrame([("a", float("nan"), 1.0, 0.0), ("b", 1.0, 1.0, None), ("c", 0.7, 0.4, 0.02)], "ID string, GenTrain_Score double, Cluster_Sep double, F_MISS double")
    got = {r.ID: (r.pass_gentrain, r.pass_fmiss, r["pass"]) for r in reports.flag_variants(df, df.select("ID")).collect()}
    assert got == {"a": (False, True, False), "b": (True, False, False), "c": (True, True, True)}


def test_empty_inclusion(inputs, tmp_path):
    writers.inclusion(reports.variant_qc(*inputs, gentrain_min=2.0), str(tmp_path / "none"))
    assert not "".join(p.read_text() for p in Path(tmp_path / "none").glob("part*"))
