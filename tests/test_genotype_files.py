"""BED, PGEN, BCF and VCF: literal bytes of the formats, splits, regions, and round trips through Spark."""

import gzip
import os
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loculoom.sources import bcf, files, plink, readers, storage

SITE = "chrom string, pos long, variant_id string, ref string, alt string"


def cohort(spark, variants=300, samples=9, seed=1):
    pick = random.Random(seed)
    sites = [(f"chr{1 + v % 3}", 1000 + 5000 * v, f"v{v:05}", "A", pick.choice(["G", "GT"])) for v in range(variants)]
    rows = [(*s, f"s{k}", pick.choice([0, 0, 0, 1, 2, None])) for s in sites for k in range(samples) if pick.random() < 0.9]
    calls = spark.createDataFrame(rows, f"{SITE}, sample_id string, dosage int").repartition(5)
    people = files.samples_in_order(spark.createDataFrame([(f"s{k}", 1 + k % 2 if k else None) for k in range(samples)], "sample_id string, sex int"))
    present = {r[2] for r in rows}
    want = {(s[2], f"s{k}"): None for s in sites if s[2] in present for k in range(samples)} | {(r[2], r[5]): r[6] for r in rows}
    return calls, people, want, [s for s in sites if s[2] in present]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """All kinds of files of one cohort, written in one pass."""
    calls, people, want, sites = cohort(spark)
    at = tmp_path_factory.mktemp("files")
    path = lambda kind: str(at / f"c.{kind}")
    rows = files.genotype_rows(calls, people)
    rows.write.parquet(path("parquet"))
    files.write_files(spark.read.parquet(path("parquet")), people, {k: path(k) for k in ("bed", "bim", "pgen", "pvar", "vcf", "bcf")})
    files.write_fam(people, path("fam"))
    files.write_psam(people, path("psam"))
    assert not [p for p in os.listdir(at) if "parts" in p]
    return at, want, sites, people


def by_call(df):
    got = [((r.variant_id, r.sample_id), r.dosage) for r in df.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def test_round_trips(spark, written):
    at, want, sites, _ = written
    assert by_call(plink.read_plink1(spark, str(at / "c"))) == want
    assert by_call(plink.read_plink2(spark, str(at / "c"))) == want
    assert by_call(files.read_bcf(spark, str(at / "c.bcf"))) == want
    os.rename(at / "c.vcf", at / "c.vcf.gz")
    assert by_call(readers.vcf_calls(spark, str(at / "c.vcf.gz"))) == want
    head = gzip.open(at / "c.vcf.gz", "rt").read().split("\n")
    assert head[2:5] == ["##contig=<ID=chr1>", "##contig=<ID=chr2>", "##contig=<ID=chr3>"]
    order = sorted(sites, key=lambda s: (s[0], s[1]))
    assert [r.variant_id for r in readers.bim(spark, str(at / "c.bim")).orderBy("ord").collect()] == [s[2] for s in order]
    assert [r.variant_id for r in readers.pvar(spark, str(at / "c.pvar")).orderBy("ord").collect()] == [s[2] for s in order]
    got = spark.read.parquet(str(at / "c.parquet")).orderBy("ord").collect()
    assert [r.ord for r in got] == list(range(len(sites))) and [r.variant_id for r in got] == [s[2] for s in order]


def test_only_wanted_samples_are_decoded(spark, written):
    at, want, _, _ = written
    part = {k: d for k, d in want.items() if k[1] in ("s7", "s2")}
    assert by_call(plink.read_plink1(spark, str(at / "c"), ["s7", "s2"], split_bytes=50)) == part
    assert by_call(plink.read_plink2(spark, str(at / "c"), ["s7", "s2"], split_variants=7)) == part
    with pytest.raises(ValueError, match="nobody"):
        plink.read_plink1(spark, str(at / "c"), ["nobody"])


def test_bed_is_planned_by_byte_ranges(spark, tmp_path):
    """A sparse file of 3 GB is many tasks, and one of them reads its own rows alone."""
    samples, variants = 4000, 3_000_000
    with open(tmp_path / "x.bed", "wb") as f:
        f.write(plink.BED_MAGIC)
        f.truncate(3 + variants * 1000)
        f.seek(3 + 2_500_000 * 1000)
        f.write(bytes([0b11100100]))  # two A1 alleles, missing, one, none
    reader = plink.BedReader({"path": str(tmp_path / "x.bed"), "samples": samples, "keep": "0,1,2,3,4"})
    parts = reader.partitions()
    assert len(parts) > 80 and parts[0].begin == 0 and parts[-1].end == variants and all(a.end == b.begin for a, b in zip(parts, parts[1:]))
    part = next(p for p in parts if p.begin <= 2_500_000 < p.end)
    got = {o: g for b in reader.read(part) for o, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if o == 2_500_000}
    assert got == {2_500_000: [2, None, 1, 0, 2]}
    for data, text in ((b"\x6c\x1b\x00", "variant-major"), (plink.BED_MAGIC + b"\0" * 999, "whole number")):
        (tmp_path / "bad.bed").write_bytes(data)
        with pytest.raises(ValueError, match=text):
            plink.BedReader({"path": str(tmp_path / "bad.bed"), "samples": samples}).partitions()
    assert plink.registered(spark).read.format("bed").option("samples", samples).load(str(tmp_path / "x.bed")).rdd.getNumPartitions() == len(parts)


def test_bed_bytes(spark, tmp_path):
    rows = spark.createDataFrame([(0, [2, None, 1, 0, 1]), (1, [0, 0, 0, 0, None])], "ord long, gt array<tinyint>")
    plink.registered(spark)
    storage.in_ranges(rows).write.format("bed").option("samples", 5).mode("append").save(str(tmp_path / "x.bed"))
    assert (tmp_path / "x.bed").read_bytes() == plink.BED_MAGIC + bytes([0b11100100, 0b10, 0b11111111, 0b01])


#: Records of seven samples: kind, bytes and the dosages that they stand for.
RECORDS = [
    (0, bytes([0b11100100, 0b000110]), [0, 1, 2, None, 2, 1, 0]),
    (1, bytes([0 * 4 + 1, 0b0100101, 0]), [1, 0, 1, 0, 0, 1, 0]),  # codes 0 and 1, by one bit each; nobody differs
    (1, bytes([0 * 4 + 2, 0b0000010, 2, 3, 0b0111, 2]), [0, 2, 0, None, 0, 1, 0]),  # codes 0 and 2; samples 3 and 5 (two on) are 3 and 1
    (4, bytes([0]), [0] * 7),
    (4, bytes([1, 6, 0b01]), [0, 0, 0, 0, 0, 0, 1]),
    (2, bytes([1, 0, 0b10]), [2, 0, 0, 0, 0, 0, 1]),  # like the one before but sample 0
    (3, bytes([1, 1, 0b11]), [2, None, 2, 2, 2, 2, 1]),  # like the last of a kind of its own but sample 1, alleles exchanged
    (6, bytes([2, 0, 0b0011, 4]), [None, 2, 2, 2, 0, 2, 2]),
    (7, bytes([1, 2, 0b00]), [None, None, 0, None, None, None, None]),
    (2, bytes([0]), [None, None, 0, None, None, None, None]),
]


def variable_pgen(path, records, samples, length_bytes=1, wide=False):
    kinds = [r[0] for r in records]
    if wide:
        types = bytes(kinds)
    else:
        kinds += [0] * (len(kinds) % 2)
        types = bytes(a | b << 4 for a, b in zip(kinds[::2], kinds[1::2]))
    index = types + b"".join(len(r[1]).to_bytes(length_bytes, "little") for r in records)
    start = 12 + 8 + len(index)
    head = b"\x6c\x1b\x10" + struct.pack("<IIB", len(records), samples, (4 if wide else 0) | length_bytes - 1 | 1 << 6)
    path.write_bytes(head + struct.pack("<Q", start) + index + b"".join(r[1] for r in records))


def direct(path, **options):
    reader = plink.PgenReader({"path": str(path), **options})
    return [g for p in reader.partitions() for b in reader.read(p) for g in b.column(1).to_pylist()]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("split", [1, 3, 100])
def test_pgen_records(tmp_path, wide, split):
    variable_pgen(tmp_path / "x.pgen", RECORDS, 7, 1 + split % 3, wide)
    assert direct(tmp_path / "x.pgen", splitVariants=split) == [r[2] for r in RECORDS]
    assert direct(tmp_path / "x.pgen", splitVariants=split, keep="6,0") == [[r[2][6], r[2][0]] for r in RECORDS]


def test_pgen_of_fixed_width_and_bad_files(tmp_path):
    (tmp_path / "f.pgen").write_bytes(b"\x6c\x1b\x02" + struct.pack("<IIB", 2, 5, 1 << 6) + bytes([0b11100100, 0b01, 0b00000000, 0b11]))
    assert direct(tmp_path / "f.pgen", splitVariants=1) == [[0, 1, 2, None, 1], [0, 0, 0, 0, None]]
    (tmp_path / "g.pgen").write_bytes(b"\x6c\x1b\x01" + b"\0" * 20)
    with pytest.raises(ValueError, match="not a PGEN"):
        direct(tmp_path / "g.pgen")
    for kind, text in ((5, "reserved"), (2, "none in its block")):
        variable_pgen(tmp_path / "h.pgen", [(kind, b"\0", [])], 7)
        with pytest.raises(ValueError, match=text):
            direct(tmp_path / "h.pgen")


def test_difference_lists():
    rng = np.random.default_rng(2)
    for samples, n in ((7, 3), (300, 64), (300, 65), (300, 130), (70_000, 500), (1 << 20, 200)):
        at = np.sort(rng.choice(samples, n, replace=False))
        codes = rng.integers(0, 4, n).astype(np.uint8)
        data = plink.to_difference_list(at, codes, samples)
        got = plink.difference_list(b"xx" + data + b"more", 2, samples)
        assert got[0].tolist() == at.tolist() and got[1].tolist() == codes.tolist() and got[2] == 2 + len(data)


def test_pgen_over_blocks_of_the_index(spark, tmp_path):
    """More variants than a block of the index holds, written by many tasks, of every kind that is written."""
    n = 150_000
    plink.registered(spark)
    rows = spark.range(n).selectExpr("id AS ord", "transform(sequence(0, 39), k -> CAST(CASE WHEN hash(id, k) % 41 = 0 THEN 1 WHEN id % 4 = 3 THEN hash(k, id, 1) % 3 WHEN id % 4 = 2 THEN NULL ELSE id % 4 * 2 END AS TINYINT)) AS gt")
    rows = rows.selectExpr("ord", "transform(gt, x -> CAST(abs(x) AS TINYINT)) AS gt")
    storage.in_ranges(rows).write.format("pgen").option("samples", 40).mode("append").save(str(tmp_path / "x.pgen"))
    back = spark.read.format("pgen").option("splitVariants", 20_000).load(str(tmp_path / "x.pgen"))
    assert back.rdd.getNumPartitions() >= 8
    assert back.exceptAll(rows).isEmpty() and back.count() == n
    kinds = {int(k) for b in range(3) for k in plink.PgenHeader(str(tmp_path / "x.pgen")).index(str(tmp_path / "x.pgen"), b)[0]}
    assert kinds == {0, 4, 6, 7}


def test_failed_tasks_leave_nothing(spark, tmp_path):
    plink.registered(spark)
    good = spark.createDataFrame([(k, [0, 1]) for k in range(8)], "ord long, gt array<tinyint>")
    bad = {"gap": good.filter("ord <> 5"), "twice": good.union(good.filter("ord = 3")), "short": good.selectExpr("ord", "IF(ord = 6, slice(gt, 1, 1), gt) AS gt")}
    for name, rows in bad.items():
        with pytest.raises(Exception, match="missing|consecutive|samples"):
            storage.in_ranges(rows).write.format("bed").option("samples", 2).mode("append").save(str(tmp_path / f"{name}.bed"))
    assert not [p for p in os.listdir(tmp_path) if not p.startswith(".")]
    for _ in range(2):
        storage.in_ranges(good).write.format("bed").option("samples", 2).mode("overwrite").save(str(tmp_path / "x.bed"))
    with pytest.raises(Exception, match="exists"):
        storage.in_ranges(good).write.format("bed").option("samples", 2).mode("append").save(str(tmp_path / "x.bed"))
    assert os.listdir(tmp_path) == ["x.bed"] or sorted(p for p in os.listdir(tmp_path) if not p.startswith(".")) == ["x.bed"]
    empty = good.limit(0)
    storage.in_ranges(empty).write.format("bed").option("samples", 2).mode("append").save(str(tmp_path / "none.bed"))
    assert (tmp_path / "none.bed").read_bytes() == plink.BED_MAGIC


def test_bins():
    for begin, end in ((0, 1), (16_383, 16_384), (16_383, 16_385), (1 << 17, (1 << 17) + 5), ((1 << 26) - 1, (1 << 26) + 1), (250_000_000, 250_000_001)):
        number = bcf.bin_of(begin, end)
        assert bcf.bin_start(number) <= begin and number in bcf.bins_over(begin, end)
        assert number in bcf.bins_over(end - 1, end + 10) and number in bcf.bins_over(max(0, begin - 5), begin + 1)
    assert bcf.bin_of(0, 1) == 4681 and bcf.bin_of(0, 1 << 29) == 0 and bcf.bin_of(0, 1 << 14) == 4681 and bcf.bin_of(0, (1 << 14) + 1) == 585


def test_blocks():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 256, 300_000).astype(np.uint8).tobytes()
    writer = bcf.BlockWriter()
    packed = b"".join(writer.put(data[k : k + 7777]) for k in range(0, len(data), 7777)) + writer.flush()
    assert gzip.decompress(packed + bcf.LAST_BLOCK) == data
    places = np.array([0, 1, bcf.BLOCK - 1, bcf.BLOCK, 200_000, len(data)])
    for at, virtual in zip(places.tolist(), writer.virtual(places).tolist()):
        f = pa.BufferReader(packed + bcf.LAST_BLOCK)
        assert bcf.BlockReader(f, virtual).take(70_000) == data[at : at + 70_000]


def test_region_reads_its_blocks_alone(spark, tmp_path):
    """Long and short records over many blocks: a region gives what a scan and a filter give, from a few blocks."""
    pick = random.Random(8)
    samples = [f"s{k}" for k in range(400)]
    rows = []
    for c in ("chr1", "chr2"):
        for pos in sorted(pick.sample(range(1, 40_000_000), 900)):
            ref = "A" * (30_000 if pick.random() < 0.01 else pick.choice([1, 1, 1, 5]))
            rows.append((len(rows), c, pos, f"{c}:{pos}", ref, "G", [pick.choice([0, 1, 2, None]) for _ in samples]))
    frame = spark.createDataFrame(rows, f"ord long, {SITE}, gt array<tinyint>").repartition(4)
    people = spark.createDataFrame(list(enumerate(samples)), "i int, sample_id string")
    path = str(tmp_path / "x.bcf")
    files.write_files(frame, people, {"bcf": path})
    whole = bcf.BcfReader({"path": path, "splitBytes": 60_000})
    parts = whole.partitions()
    got = [r for p in parts for b in whole.read(p) for r in b.to_pylist()]
    assert len(parts) > 2 and [tuple(r.values()) for r in got] == [r[1:] for r in rows]
    for c, a, b in [("chr1", 1, 100_000), ("chr2", 20_000_000, 20_400_000), ("chr1", 39_000_000, 50_000_000), ("chr2", 5, 5), ("chr3", 1, 9)] + [("chr1", r[2] + 20_000, r[2] + 20_001) for r in rows if len(r[4]) > 1000 and r[1] == "chr1"][:3]:
        reader = bcf.BcfReader({"path": path, "region": f"{c}:{a}-{b}"})
        found = [r["variant_id"] for p in reader.partitions() for x in reader.read(p) for r in x.to_pylist()]
        assert found == [r[3] for r in rows if r[1] == c and r[2] <= b and r[2] + len(r[4]) > a], (c, a, b)
        assert reader.blocks <= 3 + whole.blocks * (0.1 if b - a < 1_000_000 else 0.5), (reader.blocks, whole.blocks)
    assert files.read_bcf(spark, path, "chr1").select("variant_id").distinct().count() == 900
    os.remove(path + ".csi")
    assert len(bcf.BcfReader({"path": path}).partitions()) == 1 and files.read_bcf(spark, path, "chr2:5-5").count() == 0


def test_bcf_fields_of_others():
    """Typed values of all widths, missing and haploid calls, several ALT alleles, and fields besides GT."""
    head = bcf.Header("##fileformat=VCFv4.2\n##contig=<ID=chr9>\n##contig=<ID=chr10>\n##INFO=<ID=AF,Number=A,Type=Float,Description=\"x\">\n##FORMAT=<ID=GQ,Number=1,Type=Integer,Description=\"q\">\n##FORMAT=<ID=GT,Number=1,Type=String,Description=\"g\">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb\tc\td\n\0")
    assert head.contigs == {0: "chr9", 1: "chr10"} and head.names == {0: "PASS", 1: "AF", 2: "GQ", 3: "GT"} and head.samples == ["a", "b", "c", "d"]
    shared = struct.pack("<iiifII", 1, 99, 1, 0.0, 3 << 16 | 1, 2 << 24 | 4) + bcf.typed_text("rs" * 10) + bcf.typed_text("A") + bcf.typed_text("C") + bcf.typed_text("G" * 300)
    shared += bcf.typed([0]) + bcf.typed([1]) + bcf.typed_size(1, 5) + struct.pack("<f", 0.5)
    gq = bcf.typed([2]) + bcf.typed_size(1, 3) + struct.pack("<4i", 1, 70_000, 3, 4)
    gt = bcf.typed([3]) + bcf.typed_size(2, 2) + struct.pack("<8h", 4, 7, 0, 3, 4, -32767, 6, 4)  # 1|2, .|0, haploid 1, 2/1
    assert bcf.decoded(shared, gq + gt, head)[:5] == ("chr10", 100, "rs" * 10, "A", "C," + "G" * 300)
    assert bcf.decoded(shared, gq + gt, head)[5].tolist() == [2, -1, 1, 2]
    assert bcf.typed([200]) == bytes([0x12, 200, 0]) and bcf.typed([70_000])[0] == 0x13 and bcf.typed_text("x" * 20)[:3] == bytes([0xF7, 0x11, 20])


def test_lines_are_numbered_over_splits(spark, tmp_path):
    lines = [f"line {k} " + "x" * (k % 90) for k in range(60_000)]
    (tmp_path / "a.txt").write_text("#head\n" + "\n".join(lines[:30_000]) + "\n\n" + "\n".join(lines[30_000:]) + "\n")
    got = storage.numbered_lines(spark, str(tmp_path / "a.txt"), "#")
    assert got.rdd.getNumPartitions() > 1 and {r.ord: r.value for r in got.collect()} == dict(enumerate(lines))


def test_places_are_counted_by_ranges(spark):
    rows = [(k * 7919 % 5000 // 2, k) for k in range(5000)]
    got = storage.ranked(spark.createDataFrame(rows, "a int, b int").repartition(6), "a", "b").orderBy("ord").collect()
    assert [(r.a, r.b, r.ord) for r in got] == [(*r, k) for k, r in enumerate(sorted(rows))]


def test_calls_alone(spark, written):
    """With ``called`` no-calls are no rows, in all formats; batches of writers are cut by genotypes, and a file has few splits however small they are asked."""
    at, want, _, _ = written
    told = {k: d for k, d in want.items() if d is not None}
    assert len(told) < len(want)
    assert by_call(plink.read_plink1(spark, str(at / "c"), called=True, split_bytes=50)) == told
    assert by_call(plink.read_plink2(spark, str(at / "c"), called=True, split_variants=7)) == told
    assert by_call(files.read_bcf(spark, str(at / "c.bcf"), called=True)) == told
    assert by_call(plink.read_plink1(spark, str(at / "c"), ["s7", "s2"], called=True)) == {k: d for k, d in told.items() if k[1] in ("s7", "s2")}
    counts = {r.ord: (r.called, r.obs_ct) for r in plink.called_counts(spark, str(at / "c")).collect()}
    order = {r.variant_id: r.ord for r in readers.bim(spark, str(at / "c.bim")).collect()}
    assert counts == {o: (sum(k[0] == v for k in told), 9) for v, o in order.items()}


def test_memory_of_many_samples(tmp_path):
    """A batch of 2,000 rows of 100,000 samples with few calls: writer and reader hold a slice of it, and the file is right."""
    import tracemalloc

    n, rows = 100_000, 2_000
    k = np.arange(rows)
    batch = plink.cell_batch(0, rows, np.repeat(k, 2), np.column_stack([k, n - 1 - k]).reshape(-1), np.column_stack([k % 3, (k + 1) % 3]).reshape(-1).astype(np.int8))
    path = str(tmp_path / "x.bed")
    writer = plink.BedWriter({"path": path, "samples": str(n)}, False)
    tracemalloc.start()
    writer.commit([writer.write(iter([batch]))])
    reader = plink.BedReader({"path": path, "samples": n, "splitbytes": 1, "cells": "1"})
    parts = reader.partitions()
    got = [c for p in parts for b in reader.read(p) for c in b.column(1).to_pylist()]
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == batch.column(1).to_pylist() and os.path.getsize(path) == 3 + rows * n // 4
    assert held < 60 << 20, held
    # as dense rows
    dense = plink.BedWriter({"path": path + "2", "samples": str(n)}, False)
    gt = plink.genotype_batch(0, plink.batch_dosages(batch.slice(0, 20), n))
    assert dense.encode(gt) == writer.encode(batch.slice(0, 20))
    large = plink.BedReader({"path": path, "samples": n, "splitbytes": 1})
    assert len(large.partitions()) == rows and plink.SPLITS < 10_000


def test_pieces_hold_what_their_samples_are_known_at(spark, tmp_path):
    """Of cohorts without a common site every piece has the sites of its own samples, so that files grow with the calls; read together they are the whole, in all formats."""
    rows = [(f"chr{1 + v % 3}", 10 * v, f"v{v:03}", "A", "G", f"s{k:02}", (v + k) % 4 if (v + k) % 4 < 3 else None) for k in range(11) for v in range(60) if v // 20 == k // 4 or (v, k) in ((7, 10), (59, 0))]
    calls, at = spark.createDataFrame(rows, f"{SITE}, sample_id string, dosage int").repartition(5), str(tmp_path / "c")
    people = files.samples_in_order(calls.select("sample_id").distinct().withColumn("sex", storage.F.lit(1)))
    files.genotype_rows(calls, people, 4).write.parquet(f"{at}.parquet")
    kept = spark.read.parquet(f"{at}.parquet")
    files.write_files(kept, people, {k: f"{at}.{k}" for k in ("bed", "bim", "pgen", "pvar", "bcf")}, piece=4)
    files.write_files(files.site_rows(kept), people, {"bim": f"{at}.bim"})
    files.write_fam(people, f"{at}.fam", 4)
    files.write_psam(people, f"{at}.psam", 4)
    assert [os.path.getsize(p) - 3 for p in storage.piece_paths(f"{at}.bed")] == [21, 20, 21] and not [p for p in os.listdir(tmp_path) if "parts" in p]
    told = {(r[2], r[5]): r[6] for r in rows if r[6] is not None}
    assert by_call(plink.read_pieces1(spark, at, split_bytes=5)) == told
    assert by_call(plink.read_pieces2(spark, at, split_variants=7)) == told
    assert by_call(files.read_bcf(spark, f"{at}.bcf", called=True, pieces=True)) == told
    assert by_call(files.read_bcf(spark, f"{at}.bcf", "chr2:100-300", called=True, pieces=True)) == {k: d for k, d in told.items() if int(k[0][1:]) % 3 == 1 and 10 <= int(k[0][1:]) <= 30}
    # a piece is a fileset of its own
    one = plink.read_plink1(spark, f"{at}.000001", called=True)
    assert by_call(one) == {k: d for k, d in told.items() if "s04" <= k[1] < "s08"}
    assert [r.variant_id for r in readers.bim(spark, f"{at}.bim").orderBy("ord").collect()] == sorted({r[2] for r in rows}, key=lambda v: (int(v[1:]) % 3, v))
    with pytest.raises(ValueError, match="exists"):
        files.write_files(kept, people, {"bed": f"{at}.bed"}, piece=4)


@pytest.mark.parametrize("name", ["bed_round_trip", "pgen_round_trip", "bcf_round_trip", "bcf_region", "bim_and_bed_missingness"])
def test_queries_do_not_depend_on_pieces(spark, monkeypatch, name):
    from loculoom.plans import interchange

    from .conftest import DATA

    want = sorted(map(tuple, interchange.QUERIES[name](spark, DATA).collect()))
    monkeypatch.setattr(files, "PIECE", 3)
    assert (want or name == "bcf_region") and sorted(map(tuple, interchange.QUERIES[name](spark, DATA).collect())) == want


def test_lines_pass_no_python(spark, tmp_path):
    """A file is numbered by Spark itself, and written where the thread that asks for it has no active session; blank is what has white space of any kind alone."""
    rows = [(k * 7919 % 5000, f"line {k * 7919 % 5000}") for k in range(5000)]
    frame, at = spark.createDataFrame(rows, "k int, value string").repartition(6), str(tmp_path / "a.txt")
    spark._jvm.org.apache.spark.sql.SparkSession.clearActiveSession()
    try:
        storage.write_lines(frame.withColumn("ord", F.col("k").cast("long")), at, "#head\n")
    finally:
        spark._jvm.org.apache.spark.sql.SparkSession.setActiveSession(spark._jsparkSession)
    assert (tmp_path / "a.txt").read_text() == "#head\n" + "".join(f"line {k}\n" for k in range(5000)) and {p.name for p in tmp_path.iterdir()} - {".a.txt.crc"} == {"a.txt"}
    with pytest.raises(ValueError, match="exists"):
        storage.write_lines(frame.withColumn("ord", F.col("k").cast("long")), at)
    got = storage.numbered_lines(spark, at, "#")
    assert {r.ord: r.value for r in got.collect()} == {k: f"line {k}" for k in range(5000)}
    assert "PythonRDD" not in got._jdf.queryExecution().toRdd().toDebugString()
    (tmp_path / "b.txt").write_text("a\n \t\n \n\x1c\n\n b \n")
    assert [(r.ord, r.value) for r in storage.numbered_lines(spark, str(tmp_path / "b.txt")).orderBy("ord").collect()] == [(0, "a"), (1, " b ")]
    (tmp_path / "c.txt").write_text("")
    assert storage.numbered_lines(spark, str(tmp_path / "c.txt")).collect() == []


def test_places_by_an_expression_are_sorted_by_a_column(spark, monkeypatch):
    """The order of contigs is computed once a row and not at every comparison of a sort; contigs without a number come last."""
    plans, dealt = [], storage.in_ranges

    def seen(df, *order):
        out = dealt(df, *order)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(storage, "in_ranges", seen)
    sites = spark.createDataFrame([(c, k) for k in range(3) for c in ("chr10", "chrUn", "chr9", "chrX")], "chrom string, pos int")
    got = [(r.ord, r.chrom, r.pos) for r in storage.ranked(sites, files.contig_order(), "chrom", "pos").orderBy("ord").collect()]
    assert got == [(3 * n + k, c, k) for n, c in enumerate(("chr9", "chr10", "chrX", "chrUn")) for k in range(3)]
    assert plans and not [x for p in plans for x in p.splitlines() if ("Sort " in x or "Repartition" in x) and "regexp" in x]


def test_pgen_records_are_made_together(monkeypatch):
    """Rows of one kind are packed and read together, to the same bytes and codes as one by one; others still one by one."""
    rng, one, told = np.random.default_rng(3), plink.to_record, []
    monkeypatch.setattr(plink, "to_record", lambda row: told.append(1) or one(row))
    for samples in (1, 3, 4, 7, 128, 300, 1024):
        rare = rng.choice([0.0, 0.01, 0.05, 0.3, 0.9], 400)
        codes = np.where(rng.random((400, samples)) < rare[:, None], rng.integers(0, 4, (400, samples)), rng.choice([0, 2, 3], 400)[:, None]).astype(np.uint8)
        want = [one(row) for row in codes]
        kinds, lengths, data = plink.packed_records(codes)
        assert data == b"".join(x for _, x in want) and kinds.tolist() == [k for k, _ in want] and lengths.tolist() == [len(x) for _, x in want]
        if samples == 128:
            assert not told
        ends = np.append(0, np.cumsum(lengths))
        got, left = plink.record_rows(np.frombuffer(data, np.uint8), kinds, ends, samples)
        assert (got[~left] == codes[~left]).all() and (left.sum() == 0 if samples <= 128 else left.mean() < 0.5)
        assert all((plink.record_codes(kinds[k], data[ends[k] : ends[k + 1]], samples, None) == codes[k]).all() for k in np.flatnonzero(left))
    assert [x.tolist() if k < 2 else x for k, x in enumerate(plink.packed_records(np.zeros((0, 5), np.uint8)))] == [[], [], b""]


def test_bcf_records_of_any_layout(spark, tmp_path):
    """Records are made and read together by their layout: lengths of texts change, some have several ALT alleles, and every dosage comes back."""
    rng = np.random.default_rng(4)
    rows = [(k, "chr1" if k < 300 else "chr2", 10 + k, "v" * int(rng.integers(1, 20)) + str(k), "A" if k % 5 else "ACG" * (1 + k % 7), "G" if k % 11 else "C,GG", [(i, int(rng.integers(0, 3))) for i in range(5) if rng.random() < 0.6]) for k in range(500)]
    batch = pa.RecordBatch.from_pydict({c: [r[k] for r in rows] for k, c in enumerate(("ord", "chrom", "pos", "variant_id", "ref", "alt"))})
    flat = [(row, i, d) for row, r in enumerate(rows) for i, d in r[6]]
    batch = batch.append_column("cells", plink.cell_lists(500, *(np.array(x) for x in zip(*flat))))
    whole = bcf.BcfWriter({"path": str(tmp_path / "a.bcf"), "contigs": "chr1\tchr2", "samples": "\t".join("abcde")}, False)
    whole.commit([whole.write(iter([batch.slice(0, 130), batch.slice(130)]))])
    for region, want in ((None, rows), ("chr2:400-450", [r for r in rows if r[1] == "chr2" and r[2] <= 450 and r[2] + len(r[4]) > 400])):
        reader, got = bcf.BcfReader({"path": str(tmp_path / "a.bcf"), "cells": "1", "splitBytes": "1", **({"region": region} if region else {})}), []
        for p in reader.partitions():
            for b in reader.read(p):
                got += [(r["chrom"], r["pos"], r["variant_id"], r["ref"], r["alt"], [(c["i"], c["d"]) for c in r["cells"]]) for r in b.to_pylist()]
        assert got == [r[1:] for r in want]


def test_calls_are_joined_to_their_sites(spark):
    """Lists go on over batches, the least site of a variant counts, and a variant without calls has an empty list."""
    rows = [(k % 3, f"v{k % 7}", "chr1", 5 + (k % 2 if k % 7 == 4 else 0), "A", "G", None if k % 7 == 2 else k) for k in range(400)] + [(0, None, "chr1", 1, "A", "G", 9)]
    frame = spark.createDataFrame(rows, "piece long, variant_id string, chrom string, pos long, ref string, alt string, cell int").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = files.site_cells(frame, "piece").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for piece, v, chrom, pos, ref, alt, cell in rows:
        held = want.setdefault((piece, v), [(chrom, pos, ref, alt), []])
        held[0] = min(held[0], (chrom, pos, ref, alt))
        held[1] += [] if cell is None else [cell]
    assert {(r.piece, r.variant_id): [(r.chrom, r.pos, r.ref, r.alt), sorted(r.cells)] for r in got} == {k: [s, sorted(c)] for k, (s, c) in want.items()} and len(got) == len(want)


def test_sparse_calls_ask_for_small_pieces():
    """Pieces of sparse cohorts take few genotypes that nobody has; dense cohorts and small ones stay in pieces of the most samples."""
    assert files.piece_size(60_000, 1_200_000, 36_000_000) == files.LEAST_PIECE
    assert files.piece_size(60_000, 1_200_000, 60_000 * 1_200_000) == files.PIECE == files.piece_size(1000, 20_000, 600_000)
    assert files.piece_size(0, 0, 0) == files.PIECE
