"""Statistics against brute force, transforms on literal rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loculoom.functions import float_text, hwe_exact
from loculoom.operators import ibd, samples, stats, variants


def brute_hwe(a, h, b, midp):
    n, r = a + h + b, min(2 * a + h, 2 * b + h)
    lf = lambda k: math.lgamma(k + 1)
    lp = {k: k * math.log(2) - lf(k) - lf((r - k) // 2) - lf(n - k - (r - k) // 2) for k in range(r % 2, r + 1, 2)}
    top = max(lp.values())
    w = {k: math.exp(v - top) for k, v in lp.items()}
    low = sum(v for v in w.values() if v <= w[h] * (1 + 1e-8))
    tied = sum(v for v in w.values() if abs(v - w[h]) <= 1e-8 * w[h])
    return (low - midp * 0.5 * tied) / sum(w.values())


def test_hwe(spark):
    random.seed(1)
    rows = [(0, 0, 5), (10, 0, 10), (1, 0, 0), (57, 78, 13), (1000, 0, 1000), (100_000, 0, 100_000), (0, 20_000, 0)] + [tuple(random.randint(0, 60) for _ in range(3)) for _ in range(40)]
    df = spark.createDataFrame([r for r in rows if sum(r)], "a long, h long, b long")
    for midp in (True, False):
        for r in df.withColumn("p", hwe_exact(F.col("a"), F.col("h"), F.col("b"), midp)).collect():
            assert r.p == pytest.approx(brute_hwe(r.a, r.h, r.b, midp), rel=1e-9, abs=1e-300)


def test_float_text(spark):
    df = spark.createDataFrame([(x,) for x in (0.25, 0.045, 0.0001, 0.0, 1.0, 0.00125)], "x double")
    assert [r[0] for r in df.select(float_text(F.col("x"))).collect()] == ["0.25", "0.045", "0.0001", "0.0", "1.0", "0.0012"]


def calls(spark, rows):
    return spark.createDataFrame(rows, "variant_id string, sample_id string, dosage int")


def test_missing_frequency_grid(spark):
    c = calls(spark, [("v1", "a", 0), ("v1", "b", 2), ("v1", "c", None), ("v2", "a", 1)])
    got = {r.variant_id: (r.missing_ct, r.obs_ct) for r in stats.missingness(samples.complete_grid(c), "variant_id").collect()}
    assert got == {"v1": (1, 3), "v2": (2, 3)}
    assert {r.variant_id: r.alt_freq for r in stats.allele_frequency(c).collect()} == {"v1": 0.5, "v2": 0.5}
    with pytest.raises(ValueError, match="samples"):
        stats.inbreeding(c, 50)


def test_baf_recovers_contamination(spark):
    random.seed(2)
    rows = []
    for _ in range(4000):
        af, aa = random.random(), random.random() < 0.5
        baf = 0.05 * af + 0.01 if aa else 1 - 0.05 * (1 - af) - 0.01
        rows.append(("s", 0 if aa else 2, baf + random.gauss(0, 0.01), af))
    r = stats.baf_regression(spark.createDataFrame(rows, "sample_id string, dosage int, baf double, af double")).collect()[0]
    assert r.contamination == pytest.approx(0.05, abs=0.005)


def test_variant_transforms(spark):
    v = spark.createDataFrame([("chrX", 20000, "A", "G,T", "x"), ("chr1", 5, "A", "G", "chr1:5:A:G"), ("chr1", 5, "A", "G", "chr1:5:A:G")], "chrom string, pos long, ref string, alt string, variant_id string")
    assert {r.variant_id for r in variants.canonical_ids(v).collect()} == {"chrX:20000:A:G,T", "chr1:5:A:G"}
    assert variants.biallelic(v).count() == 2 and variants.exclude_duplicates(v).count() == 1
    assert [r.alt for r in variants.split_multiallelic(v.limit(1)).collect()] == ["G", "T"]
    assert variants.split_par(v).filter("chrom = 'PAR1'").count() == 1
    assert [r[0] for r in v.select(variants.numeric_contig(F.col("chrom"))).distinct().orderBy(F.col("chrom")).collect()] in (["1", "23"], ["23", "1"])
    m = v.select("chrom", "pos", "ref", "alt", "variant_id").withColumn("gt", F.array(F.lit(1), F.lit(2))).limit(1)
    assert [r.gt for r in variants.split_multiallelic(m, "gt").collect()] == [1, 1]
    bases = spark.createDataFrame([("chr1", 5, "C"), ("chrX", 20000, "AC")], "chrom string, pos long, base string")
    assert variants.matching_reference(v, bases).select("chrom").distinct().collect()[0].chrom == "chrX"


def test_merge_and_keep(spark):
    a, b = calls(spark, [("v", "SG1", 0), ("v", "SG3", 1)]), calls(spark, [("v", "SG2", 2)])
    want = spark.createDataFrame([("SG2",), ("SG1",), ("SG2",)], "sample_id string")
    gone = spark.createDataFrame([("SG3",)], "sample_id string")
    out = samples.rolling_merge(a, gone, [b], want)
    assert sorted(r.sample_id for r in out.collect()) == ["SG1", "SG2"]
    assert {r.sample_id for r in samples.rolling_merge(None, None, [a.unionByName(b)], want).collect()} == {"SG1", "SG2"}
    for wrong, match in ((lambda: samples.merge_plates([]), "nothing"), (lambda: samples.keep(a, want.limit(0)), "empty"), (lambda: samples.keep(a, want), "kept 1 samples, expected 2"), (lambda: samples.merge_plates([a, a]), "more than one plate")):
        with pytest.raises(ValueError, match=match):
            wrong()


def test_segments(spark):
    rows = [(f"v{i:02}", s, d, 1, i) for i in range(12) for s, d in (("a", 0), ("b", 2 if i == 5 else 0))]
    c = spark.createDataFrame(rows, "variant_id string, sample_id string, dosage int, chrom int, pos int")
    assert sorted((r.start_pos, r.end_pos, r.n_snps) for r in ibd.segments(c, 5).collect()) == [(0, 4, 5), (6, 11, 6)]
    r = ibd.relatives(ibd.sharing(ibd.all_segments(c, {1: 5, 2: 5}), 12)).collect()
    assert len(r) == 1 and r[0].InfType == "Dup/MZ" and r[0].PropIBD == pytest.approx(11 / 12)


def test_missingness_after_a_merge_of_unlike_plates(spark):
    one = spark.createDataFrame([("v1", "a", 0), ("v2", "a", 1)], "variant_id string, sample_id string, dosage int")
    two = spark.createDataFrame([("v1", "b", 2), ("v3", "b", None)], one.schema)
    merged = samples.merge_plates([one, two])
    got = {r.variant_id: (r.missing_ct, r.obs_ct, r.f_miss) for r in stats.cohort_missingness(merged, "variant_id").collect()}
    assert got == {"v1": (0, 2, 0.0), "v2": (1, 2, 0.5), "v3": (2, 2, 1.0)}
    assert {r.sample_id: (r.missing_ct, r.obs_ct) for r in stats.cohort_missingness(merged, "sample_id").collect()} == {"a": (1, 3), "b": (2, 3)}


def test_repeated_ids_go_in_all_copies(spark):
    rows = [("v1", "a", 1), ("v1", "b", 2), ("v2", "a", 3), ("v2", "b", 3), ("v3", "a", 4), ("v3", "a", 4), ("v3", "b", 4)]
    calls = spark.createDataFrame(rows, "variant_id string, sample_id string, bpm_index int")
    # v1 stands for two positions whose copies have different samples
    assert {r.variant_id for r in variants.without_repeated_ids(calls).collect()} == {"v2"}
    assert {r.variant_id for r in variants.without_repeated_ids(calls.drop("bpm_index")).collect()} == {"v1", "v2"}


def brute_hwe_x(hom_ref, het, hom_alt, male_ref, male_alt, midp):
    from fractions import Fraction
    from math import factorial as f

    females, males, alt = hom_ref + het + hom_alt, male_ref + male_alt, 2 * hom_alt + het + male_alt
    mass = {}
    for m in range(males + 1):
        for h in range(females + 1):
            b, odd = divmod(alt - m - h, 2)
            if not odd and b >= 0 and females - b - h >= 0:
                mass[m, h] = Fraction(2**h, f(m) * f(males - m) * f(b) * f(h) * f(females - b - h))
    own = mass[male_alt, het]
    low, tied = sum(x for x in mass.values() if x <= own), sum(x for x in mass.values() if x == own)
    return float((low - tied * Fraction(int(midp), 2)) / sum(mass.values()))


def test_exact_test_on_chromosome_x(spark):
    import random

    from loculoom.operators.hwe_x import p_value

    random.seed(2)
    cases = [tuple(random.randint(0, 9) for _ in range(5)) for _ in range(150)] + [(0, 0, 0, 3, 2), (4, 0, 1, 0, 0), (0, 7, 0, 5, 5)]
    for c in cases:
        if sum(c):
            for midp in (True, False):
                assert p_value(*c, midp) == pytest.approx(brute_hwe_x(*c, midp)), c
    assert p_value(0, 0, 0, 0, 0, True) is None


def test_sweep_of_a_production_cohort(spark):
    """Counts over the whole space of 1,760 females and 897 males: every test ends, with a probability, and degenerate corners pass."""
    from loculoom.operators.hwe_x import hwe_x

    rows = set()
    for het in (0, 1, 50, 879, 1755, 1760):
        for share in (0.0, 0.01, 0.5, 0.9):
            for male in (0.0, 0.01, 0.5, 1.0):
                for gone, male_gone in ((0, 0), (35, 18), (176, 90)):
                    hom_alt = int((1760 - het - gone) * share)
                    if het + hom_alt + gone <= 1760 and hom_alt >= 0:
                        rows.add((1760 - het - hom_alt - gone, het, hom_alt, 897 - male_gone - int((897 - male_gone) * male), int((897 - male_gone) * male)))
    got = hwe_x(spark.createDataFrame(sorted(rows), "hom_ref long, het long, hom_alt long, male_ref long, male_alt long")).collect()
    assert len(got) == len(rows) and all(0 <= r.p_hwe <= 1 for r in got)
    assert all(r.p_hwe == 0.5 for r in got if not r.het + r.hom_alt + r.male_alt)
    assert all(r.p_hwe < 1e-9 for r in got if r.het == 1760)


def test_packed_calls():
    import numpy as np

    rng = np.random.default_rng(4)
    m = rng.integers(0, 4, (5, 21))
    at = np.argwhere(m != 3)
    data, width = ibd.pack(at[:, 0], at[:, 1], m[at[:, 0], at[:, 1]], 5)
    got = ibd.unpack(data, 5, width + 2)
    assert (got[:, :21] == m).all() and (got[:, 21:] == 3).all()


def test_comparison_in_blocks(spark, monkeypatch):
    """Several blocks of samples against all pairs by hand; no row for a pair and a variant is made."""
    monkeypatch.setattr(ibd, "BLOCK_SAMPLES", 3)
    monkeypatch.setattr(ibd, "PART_VARIANTS", 7)
    random.seed(21)
    calls = {(v, s): random.choice([0, 1, 2, 2, 2, None]) for v in range(30) for s in "abcdefghij" if random.random() < 0.9}
    df = spark.createDataFrame([(f"v{v:02}", s, d, "chr1" if v < 20 else "chr2", 10 * v) for (v, s), d in calls.items()], "variant_id string, sample_id string, dosage int, chrom string, pos long")
    counts, found = {}, set()
    for s in "abcdefghij":
        for t in "abcdefghij":
            if s < t:
                both = [(v, calls[v, s], calls[v, t]) for v in range(30) if calls.get((v, s)) is not None and calls.get((v, t)) is not None]
                d = [abs(x - y) for _, x, y in both]
                if both:
                    counts[s, t] = (d.count(2), d.count(1), d.count(0))
                for state in (1, 2):
                    for chrom, of in (("chr1", range(20)), ("chr2", range(20, 30))):
                        run = []
                        for v, x, y in [*(b for b in both if b[0] in of), (None, 0, 2)]:
                            if abs(x - y) == 2 or (state == 2 and x != y):
                                if len(run) >= 3:
                                    found.add((s, t, chrom, state, 10 * run[0], 10 * run[-1], len(run)))
                                run = []
                            else:
                                run.append(v)
    assert {(r.s1, r.s2): (r.ibs0, r.ibs1, r.ibs2) for r in ibd.ibs_counts(df).collect()} == counts
    assert {tuple(r) for r in ibd.all_segments(df, {1: 3, 2: 3}).select("s1", "s2", "chrom", "state", "start_pos", "end_pos", "n_snps").collect()} == found


def test_profile_of_one_aggregation(spark):
    """The same as missingness, genotype counts and test apart; untested contigs have no p-value, unlisted calls are no-calls of the cohort."""
    random.seed(3)
    rows = [(f"v{v}", f"s{s}", random.choice([0, 1, 1, 2, None]), "chrY" if v == 4 else "chr1") for v in range(5) for s in range(30) if (v + s) % 7]
    c = spark.createDataFrame([*rows, ("none", "s0", None, "chr1")], "variant_id string, sample_id string, dosage int, chrom string")
    tested = {r.variant_id: (r.hom_ref, r.het, r.hom_alt, r.p_hwe) for r in stats.hardy_weinberg(c).collect()}
    for cohort in (False, True):
        apart = stats.cohort_missingness(c, "variant_id") if cohort else stats.missingness(c, "variant_id")
        apart = {r.variant_id: (r.missing_ct, r.obs_ct, r.f_miss) for r in apart.collect()}
        got = stats.variant_profile(c, cohort, F.col("chrom") != "chrY").collect()
        assert {r.variant_id: (r.missing_ct, r.obs_ct, r.f_miss) for r in got} == apart
        for r in got:
            assert (r.hom_ref, r.het, r.hom_alt) == tested[r.variant_id][:3]
            assert r.p_hwe == (None if r.chrom == "chrY" else tested[r.variant_id][3])
    assert tested["none"][3] is None
