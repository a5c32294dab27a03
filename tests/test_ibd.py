"""Segments by screened blocks against a brute-force version; how many pairs are left to compare."""

import numpy as np
import pytest

from loculoom.operators import ibd

SCHEMA = "variant_id long, sample_id string, dosage int, chrom string, pos long"


def family(seed, samples, sites, missing=0.02):
    """Dosages of unrelated samples, the last two of whom share long stretches: one haplotype with the first, both with the second."""
    rng = np.random.default_rng(seed)
    freq = rng.uniform(0.1, 0.9, sites)
    haps = rng.random((samples, 2, sites)) < freq
    a, b = sites // 5, sites * 3 // 5
    haps[-2, 0, a:b] = haps[0, 0, a:b]
    haps[-1, :, a:b] = haps[1, :, a:b]
    d = haps.sum(1).astype(np.int8)
    d[rng.random(d.shape) < missing] = ibd.MISSING
    return d, np.cumsum(rng.integers(1, 20_000, sites))


def brute(d, pos, min_snps, min_bp):
    """(sample, sample, state, start, end, sites) of all pairs, site by site."""
    out = set()
    for i in range(len(d)):
        for j in range(i + 1, len(d)):
            both = np.flatnonzero((d[i] != ibd.MISSING) & (d[j] != ibd.MISSING))
            gap = np.abs(d[i][both].astype(int) - d[j][both])
            for state, least in min_snps.items():
                run = []
                for p, g in [*zip(pos[both].tolist(), gap.tolist()), (None, 2)]:
                    if g == 2 or (state == 2 and g):
                        if len(run) >= least and run[-1] - run[0] >= min_bp:
                            out.add((i, j, state, run[0], run[-1], len(run)))
                        run = []
                    else:
                        run.append(p)
    return out


def long_calls(spark, d, pos, chrom="chr1"):
    rows = [(v, f"s{k:03}", int(x) if x != ibd.MISSING else None, chrom, int(pos[v])) for k in range(len(d)) for v, x in enumerate(d[k])]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("least,min_bp,missing", [({1: 40, 2: 40}, 0, 0.02), ({1: 60, 2: 30}, 400_000, 0.0), ({1: 30, 2: 30}, 1_500_000, 0.1), ({1: 8, 2: 4}, 0, 0.7)])
def test_segments_are_those_of_all_pairs(spark, monkeypatch, least, min_bp, missing):
    monkeypatch.setattr(ibd, "BLOCK_SAMPLES", 7)
    d, pos = family(int(missing * 100), 17, 700, missing)
    got = ibd.all_segments(long_calls(spark, d, pos), least, min_bp).collect()
    assert {(int(r.s1[1:]), int(r.s2[1:]), r.state, r.start_pos, r.end_pos, r.n_snps) for r in got} == brute(d, pos, least, min_bp)
    assert len(got) == len(brute(d, pos, least, min_bp)) and any({r.s1, r.s2} == {"s001", "s016"} and r.state == 2 for r in got)


def test_few_unrelated_pairs_are_compared():
    """Of 300 unrelated samples under a tenth of the pairs are left; those that share a stretch are."""
    d, pos = family(3, 300, 4000)
    may = ibd.may_share(d, d, pos, 64, 2_500_000)
    pairs = np.triu(may, 1)
    assert pairs.sum() < 300 * 299 / 2 / 10, pairs.sum()
    assert may[0, 298] and may[1, 299] and may.diagonal().all()
    # by sites alone, as where no length is asked
    assert np.triu(ibd.may_share(d, d, pos, 200, 0), 1).sum() < 300 * 299 / 2 / 10


def test_screen_is_necessary_for_every_segment():
    rng = np.random.default_rng(8)
    for _ in range(40):
        d, pos = family(int(rng.integers(1e6)), 12, int(rng.integers(30, 400)), float(rng.choice([0, 0.05, 0.3])))
        pos = pos if rng.random() < 0.5 else np.repeat(pos, 3)[: len(pos)]  # sites at one position
        least, min_bp = int(rng.integers(1, 60)), int(rng.choice([0, 3, 50_000, 400_000]))
        may = ibd.may_share(d, d, pos, least, min_bp)
        assert {(i, j) for i, j, *_ in brute(d, pos, {1: least, 2: least}, min_bp)} <= {(int(i), int(j)) for i, j in zip(*np.nonzero(may))}
    assert ibd.may_share(np.zeros((2, 0)), np.zeros((3, 0)), np.zeros(0, np.int64), 5, 0).all()


def test_counts_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ibd, "BLOCK_SAMPLES", 5)
    monkeypatch.setattr(ibd, "PART_VARIANTS", 60)
    d, pos = family(4, 13, 150, 0.4)
    got = {(r.s1, r.s2): (r.ibs0, r.ibs1, r.ibs2) for r in ibd.ibs_counts(long_calls(spark, d, pos)).collect()}
    want = {}
    for i in range(13):
        for j in range(i + 1, 13):
            both = (d[i] != ibd.MISSING) & (d[j] != ibd.MISSING)
            gap = np.abs(d[i][both].astype(int) - d[j][both])
            want[f"s{i:03}", f"s{j:03}"] = tuple(int((gap == g).sum()) for g in (2, 1, 0))
    assert got == want


def blocks_of_their_own(samples=30, sites=200, called=0.06):
    """Sparse calls of three cohorts of other samples and other sites each, those of the last two at common sites here and there."""
    rng = np.random.default_rng(5)
    d = np.full((3 * samples, 3 * sites), ibd.MISSING, np.int8)
    for c in range(3):
        own = rng.integers(0, 3, (samples, sites)).astype(np.int8)
        d[c * samples : (c + 1) * samples, c * sites : (c + 1) * sites] = np.where(rng.random(own.shape) < called, own, ibd.MISSING)
    d[2 * samples + 3, sites : 2 * sites] = rng.integers(0, 3, sites)
    return d, np.cumsum(rng.integers(1, 9, 3 * sites))


def test_sparse_calls_are_joined_by_site(spark, monkeypatch):
    for name, value in (("BLOCK_SAMPLES", 10), ("TILE", 32), ("HELD", 50), ("PART_VARIANTS", 64)):
        monkeypatch.setattr(ibd, name, value)
    d, pos = blocks_of_their_own()
    assert ibd.few_in_common(d, d)
    calls = long_calls(spark, d, pos)
    got = {(int(r.s1[1:]), int(r.s2[1:]), r.state, r.start_pos, r.end_pos, r.n_snps) for r in ibd.all_segments(calls, {1: 3, 2: 2}).collect()}
    assert got == brute(d, pos, {1: 3, 2: 2}, 0) and {s for *_, s, _, _, _ in got} == {1, 2}
    counts = {(int(r.s1[1:]), int(r.s2[1:])): r.ibs0 + r.ibs1 + r.ibs2 for r in ibd.ibs_counts(calls).collect()}
    both = (d != ibd.MISSING).astype(int)
    assert counts == {(i, j): n for (i, j), n in np.ndenumerate(both @ both.T) if i < j and n}


def test_blocks_meet_in_common_tiles_alone(spark, monkeypatch):
    """Of cohorts without a common site no two blocks are compared, and a comparison holds the tiles of both blocks alone."""
    for name, value in (("BLOCK_SAMPLES", 10), ("TILE", 20)):
        monkeypatch.setattr(ibd, name, value)
    d, pos = blocks_of_their_own()
    d[63, 200:400] = ibd.MISSING
    for c in range(3):  # every site has a call, so that tiles begin where cohorts do
        d[30 * c, 200 * c : 200 * c + 200] = 1

    def compare(ones, others, pos):
        yield np.zeros(1, int), np.full(1, len(others) - 1), np.array([ones.shape[1]])

    met = ibd.compared(long_calls(spark, d, pos), compare, "width long").collect()
    # three blocks a cohort: three pairs of unlike ones, and three of a block with itself, each over the ten tiles of the cohort's own
    assert len(met) == 3 * 6 and {r.width for r in met} == {200} and all(int(r.s1[1:]) // 30 == int(r.s2[1:]) // 30 for r in met)


def test_sparse_tiles_are_packed_by_their_calls():
    """Few calls take two bytes each, many two bits; both come back."""
    rng = np.random.default_rng(2)
    for n, sites, called in ((256, 256, 0.03), (256, 256, 0.6), (7, 20, 0.1), (300, 512, 0.01), (1, 1, 1.0)):
        d = np.where(rng.random((n, sites)) < called, rng.integers(0, 3, (n, sites)), ibd.MISSING).astype(np.int8)
        d[-1, -1] = 2
        k, s = np.nonzero(d != ibd.MISSING)
        data, width = ibd.pack(k, s, d[k, s], n)
        back = ibd.unpack(data, n, 0)
        assert back.shape == (n, 4 * width) and (back[:, :sites] == d).all() and (back[:, sites:] == ibd.MISSING).all()
        assert len(data) <= ibd.HEAD.size + min(len(k) * (2 if n * width * 4 <= 1 << 16 else 4), n * width)


def test_pairs_of_one_part_are_not_summed(spark, monkeypatch):
    """Where no block has more tiles than a comparison holds, counts of pairs are shuffled no more; else they are summed, to the same."""
    monkeypatch.setattr(ibd, "BLOCK_SAMPLES", 5)
    monkeypatch.setattr(ibd, "TILE", 20)
    d, pos = family(6, 13, 150, 0.4)
    once = ibd.ibs_counts(long_calls(spark, d, pos))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "sum(ibs0" not in plan and "HashAggregate" not in plan.split("FlatMapGroups")[0]
    monkeypatch.setattr(ibd, "PART_VARIANTS", 60)
    summed = ibd.ibs_counts(long_calls(spark, d, pos))
    assert "sum(ibs0" in summed._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, summed.collect())) and once.columns == summed.columns


def mixed(samples=320, sites=3000, each=6, seed=9):
    """Calls of few samples at each site, drawn from all samples."""
    rng = np.random.default_rng(seed)
    d = np.full((samples, sites), ibd.MISSING, np.int8)
    for v in range(sites):
        d[rng.choice(samples, each, False), v] = rng.integers(0, 3, each)
    # two samples with a common stretch
    d[[3, 200], 500:540] = 1
    return d, np.cumsum(rng.integers(1, 9, sites))


def few_calls(spark, d, pos):
    rows = [(int(v), f"s{int(k):03}", int(d[k, v]), "chr1", int(pos[v])) for k, v in zip(*np.nonzero(d != ibd.MISSING))]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_mixed_sparse_calls_are_not_dealt_to_all_blocks(spark, monkeypatch):
    """Few samples a site, of any block: what is shuffled grows with the calls, not with the pairs of blocks, and results are those of all pairs."""
    for name, value in (("BLOCK_SAMPLES", 10), ("TILE", 32), ("PAIRS", 1 << 13), ("LEAST_PAIRS", 1 << 12), ("JOINED", 300), ("CHUNK", 700), ("ROWS", 50)):
        monkeypatch.setattr(ibd, name, value, raising=False)
    d, pos = mixed()
    calls = few_calls(spark, d, pos)
    written = lambda: sum(e.totalShuffleWrite() for e in [spark.sparkContext._jsc.sc().statusStore().executorSummary("driver")])
    before = written()
    got = {(int(r.s1[1:]), int(r.s2[1:])): (r.ibs0, r.ibs1, r.ibs2) for r in ibd.ibs_counts(calls).collect()}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    shuffled = written() - before
    want = {}
    for v in range(d.shape[1]):
        there = np.flatnonzero(d[:, v] != ibd.MISSING).tolist()
        for x, i in enumerate(there):
            for j in there[x + 1 :]:
                want.setdefault((i, j), [0, 0, 0])[2 - abs(int(d[i, v]) - int(d[j, v]))] += 1
    assert got == {k: tuple(n) for k, n in want.items()}
    assert shuffled < 150 * calls.count(), shuffled
    found = {(int(r.s1[1:]), int(r.s2[1:]), r.state, r.start_pos, r.end_pos, r.n_snps) for r in ibd.all_segments(calls, {1: 4, 2: 3}).collect()}
    assert found == brute(d, pos, {1: 4, 2: 3}, 0) and (3, 200, 2) in {r[:3] for r in found}


def test_pairs_by_site_are_those_of_the_blocks():
    """Pairs of calls at common sites, of one block and of two, in chunks that hold a sample's pairs together; a repeated call is one."""
    rng = np.random.default_rng(1)
    a, b = (np.where(rng.random((9, 40)) < 0.3, rng.integers(0, 3, (9, 40)), ibd.MISSING).astype(np.int8) for _ in range(2))
    a[4] = ibd.MISSING
    lists = lambda m: tuple(x.astype(np.int32) for x in (*reversed(np.nonzero(m.T != ibd.MISSING)), m.T[m.T != ibd.MISSING]))
    for others in (b, None):
        got, seen = [], []
        for one, other, site, gap in ibd.common_sites(lists(a), None if others is None else lists(others), 40):
            got += zip(one.tolist(), other.tolist(), site.tolist(), gap.tolist())
            seen.append(set(one.tolist()))
        m = a if others is None else others
        assert sorted(got) == sorted((i, j, v, abs(int(a[i, v]) - int(m[j, v]))) for i in range(9) for j in range(9) for v in range(40) if (others is not None or i < j) and a[i, v] != ibd.MISSING and m[j, v] != ibd.MISSING)
    batch = ibd.pa.RecordBatch.from_pydict({"chrom": ["1", "1", "1", "2"], "ord": [4, 5, 9, 10], "pos": [1, 2, 3, 1], "cells": ibd.pa.array([[9, 4], [8, 10], [], [1]], ibd.pa.list_(ibd.pa.int32()))})
    assert [(c.as_py(), o.tolist(), p.tolist(), x.tolist()) for c, o, _, p, x in ibd.chunks(batch)] == [("1", [4, 5], [0, 0, 1], [4, 9, 10]), ("1", [9], [], []), ("2", [10], [0], [1])]
