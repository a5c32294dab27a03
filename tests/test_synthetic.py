"""From synthetic intensity files to contamination, sex and sharing on chromosome X."""

import pytest
from pyspark.sql import functions as F

from loculoom.operators import ibd, stats
from loculoom.plans import stages
from loculoom.sources import binary, readers

from . import synthetic

CHROMS = ["chr1"] * 4000 + ["chrX"] * 600 + ["chrY"] * 200 + ["chrM"] * 20


@pytest.fixture(scope="module")
def plate(spark, tmp_path_factory):
    folder, held = tmp_path_factory.mktemp("gtc"), {}
    for k in range(8):
        held[f"s{k}"] = synthetic.write_sample(str(folder / f"{k}.gtc"), f"s{k}", CHROMS, male=k % 2 == 1, contamination=0.15 if k < 4 else 0.0, seed=k)
    af = synthetic.frequencies(len(CHROMS)).tolist()
    sites = spark.createDataFrame([(i + 1, c, i, "A", "G", a) for i, (c, a) in enumerate(zip(CHROMS, af))], "bpm_index int, chrom string, pos int, ref string, alt string, af double")
    return binary.read_gtc(spark, str(folder)), sites, held


def test_genotypes_by_sex(plate):
    calls, sites, held = plate
    got = calls.join(sites, "bpm_index").groupBy("sample_id", "chrom").agg(F.count("dosage").alias("called"), F.count_if(F.col("dosage") == 1).alias("het")).collect()
    by = {(r.sample_id, r.chrom): r for r in got}
    assert sum(r.called for r in got) == sum(int((g > 0).sum()) for g in held.values())
    for k in range(8):
        male = k % 2 == 1
        assert (by[f"s{k}", "chrY"].called, by[f"s{k}", "chrM"].het) == (200 if male else 0, 0)
        assert (by[f"s{k}", "chrX"].het == 0) == male and by[f"s{k}", "chr1"].het > 0


def test_contamination_is_recovered(plate):
    calls, sites, _ = plate
    heavy = calls.join(sites.drop("af"), "bpm_index").withColumn("variant_id", F.col("bpm_index")).filter("chrom = 'chr1'")
    found = {r.sample_id: r.contamination for r in stages.contamination(heavy, sites.select("chrom", "pos", "ref", "alt", "af")).collect()}
    assert min(found[f"s{k}"] for k in range(4)) > max(found[f"s{k}"] for k in range(4, 8)) + 0.04
    assert found["s0"] == pytest.approx(0.15, abs=0.06) and found["s5"] == pytest.approx(0.0, abs=0.05)


def test_sex_check(plate):
    calls, sites, _ = plate
    people = calls.select("sample_id").distinct().withColumn("sex", F.when(F.substring("sample_id", 2, 1).cast("int") % 2 == 1, 1).otherwise(2))
    c = calls.join(sites, "bpm_index").withColumn("variant_id", F.col("bpm_index"))
    for r in stats.sex_check(c, people, female_y=10, male_y=150).collect():
        assert r.ycount == (200 if r.pedsex == 1 else 0) and (r.pedsex == 2 or r.xf == pytest.approx(1.0, abs=1e-6))


def test_sharing_on_x(spark):
    rows = [(v, s, "chrX", v * 100, d) for v in range(30) for s, d in (("a", v % 3), ("b", v % 3), ("c", 2 if v % 3 == 0 and v > 14 else v % 3))]
    rows += [(100 + v, s, "chr1", v, 0) for v in range(30) for s in "abc"]
    calls = spark.createDataFrame(rows, "variant_id int, sample_id string, chrom string, pos int, dosage int")
    people = spark.createDataFrame([("a", 1), ("b", 2)], "sample_id string, sex int")
    got = {(r.ID1, r.ID2): r for r in ibd.sharing_x(calls, people, 3000, min_snps=5).collect()}
    same = got["a", "b"]
    assert (same.Sex1, same.Sex2, same.MaxIBD2, same.IBD2Seg) == (1, 2, 2901, pytest.approx(2901 / 3000))
    part = got["a", "c"]
    assert (part.Sex2, part.MaxIBD1) == (0, 1401) and part.PropIBD == pytest.approx(part.IBD1Seg / 2 + part.IBD2Seg)
    assert ibd.sharing_x(calls.filter("chrom = 'chr1'"), people, 3000).count() == 0


def test_bpm_errors(spark, tmp_path):
    head = "[Assay]\nIndex,Name,Chr\n"
    for k, body in enumerate(("1,a,1\n3,b,2\n", "x,y,z\n")):
        path = tmp_path / f"{k}.csv"
        path.write_text(head + body)
        with pytest.raises(Exception):  # noqa: B017
            readers.bpm_loci(spark, str(path)).collect()
