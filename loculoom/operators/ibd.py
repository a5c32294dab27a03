"""Sharing between samples: identity-by-state counts, segments without opposite homozygotes, relationship classes.

Samples are numbered and dealt to blocks, sites to tiles, and the calls of a block in a tile are packed to two bits each.  Two blocks meet
once a chromosome, with those tiles alone in which both have calls, so samples without a common site cost nothing.  Calls so sparse that
few pairs of a meeting share a site are joined by site; others are compared as matrices.  For segments these are screened first: a segment
has no opposite homozygotes in any window that it covers, the opposite homozygotes of all pairs in a window are one product of 0/1 matrices,
and only pairs with as many clean windows in a row as the shortest segment covers are compared site by site.  The screen never drops a
segment.  Only counts and segments leave a comparison; no row is made for a pair and a variant.  A comparison holds two blocks of one chromosome.

Where few samples have a call at a site, however they mix, blocks of 256 would all meet in all tiles.  Calls are then dealt to as few and large
blocks as the pairs of calls at common sites need, each as its site and its sample, and joined by site alone.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..sources import storage

#: Lower bounds of PropIBD and of IBD2 share per class, after the published defaults of the segment method; configurable.
DUPLICATE_IBD2, FIRST, SECOND, THIRD, FULL_SIB_IBD2 = 0.7, 0.35355, 0.17678, 0.08839, 0.08
#: Samples of a block, sites of a tile, variants of a comparison of counts and of one product in it, calls looked at at once, and what a missing call is packed as.
BLOCK_SAMPLES, TILE, PART_VARIANTS, STEP, HELD, MISSING = 256, 256, 1 << 17, 8_000, 4_000_000, 3
#: Width, whether places follow, and how many there are of dosages 0 and 1.
HEAD = struct.Struct("<4I")
#: Blocks whose pairs share less than one in so many of their cells are joined by site.
SPARSE = 64
#: Pairs of calls at common sites and calls of a block in a comparison by site at most, pairs that make a comparison worth a task of its own, and those looked at at once.
PAIRS, CALLS, LEAST_PAIRS, JOINED = 1 << 25, 12_000_000, 1 << 21, 1 << 21
#: Sites of a chunk, so that a place in it takes two bytes, and rows of results that leave at once.
CHUNK, ROWS = 1 << 16, 1 << 18
#: Calls that a pair must be expected to share in the shortest segment's windows for the screen to be worth its products.
SCREENED = 4


def place_type(n_samples: int, width: int) -> np.dtype:
    """The narrowest numbers for places in a matrix."""
    return np.dtype("<u2" if n_samples * width <= 1 << 16 else "<u4")


def pack(samples: np.ndarray, sites: np.ndarray, dosage: np.ndarray, n_samples: int) -> tuple[bytes, int]:
    """Calls (sample number, site number, dosage) as a matrix of two bits a call, or where that is shorter as the places of the calls, dosage by dosage; and the number of bytes a sample of the matrix."""
    width = (int(sites.max()) // 4 + 1) * 4 if len(sites) else 4
    kind = place_type(n_samples, width)
    if len(sites) * kind.itemsize < n_samples * width // 4:
        at = samples.astype(np.int64) * width + sites
        lists = [np.sort(at[dosage == d]).astype(kind) for d in range(3)]
        return HEAD.pack(width, 1, len(lists[0]), len(lists[1])) + b"".join(x.tobytes() for x in lists), width // 4
    m = np.full((n_samples, width), MISSING, np.uint8)
    m[samples, sites] = dosage
    m = m.reshape(n_samples, width // 4, 4)
    return HEAD.pack(width, 0, 0, 0) + (m[:, :, 0] | m[:, :, 1] << 2 | m[:, :, 2] << 4 | m[:, :, 3] << 6).tobytes(), width // 4


def unpack(data: bytes, n_samples: int, width: int) -> np.ndarray:
    """The matrix again, to at least ``width`` bytes a sample."""
    own, places, zeros, ones = HEAD.unpack_from(data)
    out = np.full((n_samples, max(width, own // 4) * 4), MISSING, np.int8)
    if places:
        for d, at in enumerate(np.split(np.frombuffer(data, place_type(n_samples, own), -1, HEAD.size), [zeros, zeros + ones])):
            out[at // own, at % own] = d
        return out
    m = np.frombuffer(data, np.uint8, -1, HEAD.size).reshape(n_samples, own // 4)
    for k in range(4):
        out[:, k:own:4] = m >> (2 * k) & 3
    return out


def numbered_samples(calls: DataFrame) -> DataFrame:
    """sample_id and i, its place in the order of ids."""
    return calls.select("sample_id").distinct().withColumn("i", (F.row_number().over(Window.orderBy("sample_id")) - 1).cast("int"))


def site_lists(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """chrom, pos, ord and cells (sample number and two bits of dosage) of the sites of calls(variant_id, sample_id, dosage, chrom, pos), numbered by chromosome and position;
    and the numbered samples, who are far fewer than calls and go to all tasks."""
    called = storage.kept(calls.filter("dosage IS NOT NULL AND chrom IS NOT NULL AND variant_id IS NOT NULL").select("variant_id", "sample_id", F.col("dosage").cast("tinyint").alias("dosage"), "chrom", "pos"))
    people = storage.kept(numbered_samples(called))
    # a call travels as one number, and is dealt by its site before lists are made
    cells = called.join(F.broadcast(people), "sample_id").select("chrom", "variant_id", "pos", (F.col("i") * 4 + F.col("dosage")).cast("int").alias("cell")).repartition("chrom", "variant_id")
    sites = cells.groupBy("chrom", "variant_id").agg(F.min("pos").cast("long").alias("pos"), F.collect_list("cell").alias("cells"))
    return storage.ranked(storage.kept(sites), "chrom", "pos", "variant_id").select("chrom", "pos", "ord", "cells"), people


def packed_tiles(sites: DataFrame) -> DataFrame:
    """chrom, tile, block, rows, pos (bytes) and data of ``site_lists``; a sample's row in its block is its number's rest."""
    rows = sites.select("chrom", "pos", "ord", F.explode("cells").alias("cell")).withColumn("i", F.shiftright("cell", 2))
    rows = rows.select(
        "chrom", F.expr(f"ord div {TILE}").alias("tile"), F.expr(f"CAST(i div {BLOCK_SAMPLES} AS LONG)").alias("block"), (F.col("i") % BLOCK_SAMPLES).cast("int").alias("k"), (F.col("ord") % TILE).cast("int").alias("site"), "pos",
        F.col("cell").bitwiseAND(F.lit(3)).cast("tinyint").alias("dosage"),
    )
    chrom = sites.schema["chrom"].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        k, site = t.column("k").to_numpy(), t.column("site").to_numpy()
        data, width = pack(k, site, t.column("dosage").to_numpy(), int(k.max()) + 1)
        pos = np.zeros(width * 4, np.int64)
        pos[site] = t.column("pos").to_numpy()
        one = t.slice(0, 1).select(["chrom", "tile", "block"])
        return one.append_column("rows", pa.array([int(k.max()) + 1], pa.int32())).append_column("pos", pa.array([pos.tobytes()], pa.binary())).append_column("data", pa.array([data], pa.binary()))

    return rows.groupBy("chrom", "tile", "block").applyInArrow(run, f"chrom {chrom}, tile long, block long, rows int, pos binary, data binary")


def chunks(b: pa.RecordBatch) -> Iterator[tuple[pa.Scalar, np.ndarray, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(chromosome, ord, sites, place, cell) of stretches of sites that follow each other on a chromosome; calls are ordered by site and sample, and a sample has one at a site."""
    if not b.num_rows:
        return
    chrom, ords = b.column("chrom").dictionary_encode().indices.to_numpy(), b.column("ord").to_numpy()
    cuts = np.flatnonzero((chrom[1:] != chrom[:-1]) | (ords[1:] != ords[:-1] + 1)) + 1
    for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ords)]):
        for k in range(a, z, CHUNK):
            part = b.slice(k, min(CHUNK, z - k))
            cells = part.column("cells")
            n, values = cells.value_lengths().to_numpy(), cells.flatten().to_numpy().astype(np.int64)
            key = np.sort(np.repeat(np.arange(len(n)), n) << 34 | values)
            key = key[np.append(key[1:] >> 2 != key[:-1] >> 2, True)[: len(key)]]
            yield part.column("chrom")[0], ords[k : k + part.num_rows], part, key >> 34, key & (1 << 34) - 1


def totals(sites: DataFrame) -> list:
    """Calls, pairs of calls at a site and pairs of cells that blocks of samples would compare in tiles, by chromosome."""
    block, tile = BLOCK_SAMPLES, TILE
    chrom = sites.schema["chrom"].dataType.simpleString()
    schema = f"chrom {chrom}, calls long, pairs long, cells double"
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chrom, ords, _, place, cell in chunks(b):
                n = np.bincount(place, minlength=len(ords))
                there = np.unique((ords[place] // tile - ords[0] // tile) << 32 | (cell >> 2) // block)
                k = np.bincount(there >> 32).astype(float)
                values = [chrom.as_py()], [len(cell)], [int((n * (n - 1) // 2).sum())], [float((k * k).sum()) / 2 * block * block * tile]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, shape)], schema=shape)

    return sites.mapInArrow(run, schema).groupBy("chrom").agg(*[F.sum(c).alias(c) for c in ("calls", "pairs", "cells")]).collect()


def block_size(found: list, samples: int, tasks: int) -> tuple[int, int]:
    """Samples of a block for the join by site, and blocks: so many that no comparison has much more than ``PAIRS`` or ``CALLS``, and that ``tasks`` have work."""
    pairs, calls = max(r.pairs for r in found), max(r.calls for r in found)
    alike = sum(r.pairs for r in found) / max(1, pairs)
    n = max((2 * pairs / PAIRS) ** 0.5, calls / CALLS, min((2 * pairs / LEAST_PAIRS) ** 0.5, (2 * tasks / max(1, alike)) ** 0.5))
    size = -(-samples // max(1, math.ceil(n)))
    return size, -(-samples // size)


def joined_by_site(sites: DataFrame, by_site: Callable[..., Iterator[tuple]], fields: str, size: int, groups: int) -> DataFrame:
    """i1, i2, chrom and ``fields`` of pairs of samples i1 < i2 who share a site: chunks of sites are cut to blocks of ``size`` samples, and two blocks meet once a chromosome with
    the chunks in which both have calls.  ``by_site`` takes (one, other, site, difference) of common sites by the one and then by site, all of a sample together, how many others
    there are, and positions of sites; it yields arrays as ``compare`` of ``compared``."""
    chrom = sites.schema["chrom"].dataType.simpleString()
    kind = np.dtype("<u2" if size <= 1 << 14 else "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chrom, ords, part, place, cell in chunks(b):
                block = (cell >> 2) // size
                order = np.argsort(block, kind="stable")
                there, first = np.unique(block[order], return_index=True)
                ends, pos = [*first[1:].tolist(), len(order)], part.column("pos").to_numpy().tobytes()
                own = [order[a:z] for a, z in zip(first.tolist(), ends)]
                data = [place[x].astype("<u2").tobytes() + (cell[x] - (k * size << 2)).astype(kind).tobytes() for k, x in zip(there.tolist(), own)]
                n = len(there)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chrom.as_py()] * n, part.column("chrom").type), pa.array([int(ords[0])] * n), pa.array(there, pa.int64()), pa.array([there.tolist()] * n, pa.list_(pa.int64())), pa.array([pos] * n, pa.binary()), pa.array(data, pa.binary())],
                    ["chrom", "first", "block", "there", "pos", "data"],
                )

    pieces = sites.mapInArrow(cut, f"chrom {chrom}, first long, block long, there array<long>, pos binary, data binary")
    dealt = pieces.select("*", F.explode("there").alias("k")).withColumns({"i": F.least("block", "k"), "j": F.greatest("block", "k")}).drop("k", "there")
    schema = f"i1 int, i2 int, chrom {chrom}, {fields}"
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, places, chrom, i, j = [], {}, None, 0, 0
        for b in batches:
            i, j, chrom = b.column("i")[0].as_py(), b.column("j")[0].as_py(), b.column("chrom")[0].as_py()
            for first, block, pos, data in zip(*(b.column(c).to_pylist() for c in ("first", "block", "pos", "data"))):
                held.append((block, first, data))
                places[first] = np.frombuffer(pos, np.int64)
        at = sorted(places)
        before, pos = dict(zip(at, np.cumsum([0, *(len(places[k]) for k in at)]).tolist())), np.concatenate([places[k] for k in at])
        calls_of = {}
        for b in {i, j}:
            parts = sorted((first, data) for block, first, data in held if block == b)
            n = [len(data) // (2 + kind.itemsize) for _, data in parts]
            site = np.concatenate([np.frombuffer(data, "<u2", k).astype(np.int32) + before[first] for k, (first, data) in zip(n, parts)])
            cell = np.concatenate([np.frombuffer(data, kind, k, 2 * k) for k, (_, data) in zip(n, parts)])
            calls_of[b] = (cell >> 2).astype(np.int32), site.astype(np.int32), (cell & 3).astype(np.int8)
        del held
        for common in common_sites(calls_of[i], calls_of[j] if i != j else None, len(pos)):
            for a, b, *values in by_site(*common, size, pos):
                for k in range(0, len(a), ROWS):
                    part = slice(k, k + ROWS)
                    columns = [a[part] + i * size, b[part] + j * size, np.full(len(a[part]), chrom), *(c[part] for c in values)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, shape)], schema=shape)

    # a comparison is a task of its own, few others beside it
    return dealt.repartition(min(4096, 4 * groups), "chrom", "i", "j").groupBy("chrom", "i", "j").applyInArrow(run, schema)


def common_sites(ones: tuple[np.ndarray, ...], others: tuple[np.ndarray, ...] | None, sites: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(one, other, site, difference) of the sites that two samples are both called at, by the one, then by site; about ``JOINED`` at once, never a sample of the ones in two parts.
    Calls are (sample, site, dosage) by site and sample; without ``others`` a sample meets those of its own that come after it."""
    row, site, d = ones
    their, at, e = others or ones
    n = np.bincount(at, minlength=sites)
    ends = np.cumsum(n)
    order = np.argsort(row, kind="stable").astype(np.int32)
    row, site, d = row[order], site[order], d[order]
    begin = (ends - n).astype(np.int32)[site] if others else order + 1
    each = ends.astype(np.int32)[site] - begin
    del order
    # where the samples' calls end, and how many pairs there are before them
    last, before, a = np.append(np.flatnonzero(row[1:] != row[:-1]) + 1, len(row)), np.concatenate([[0], np.cumsum(each)]), 0
    while a < len(row):
        k = int(np.searchsorted(before[last], before[a] + JOINED, "right"))
        z = max(int(last[max(k - 1, 0)]), int(last[np.searchsorted(last, a, "right")]))
        mine = np.repeat(np.arange(a, z), each[a:z])
        theirs = np.arange(len(mine)) + np.repeat(begin[a:z] - (before[a:z] - before[a]), each[a:z])
        if len(mine):
            yield row[mine], their[theirs], site[mine], np.abs(e[theirs] - d[mine])
        a = z


def named(found: DataFrame, people: DataFrame) -> DataFrame:
    """s1 and s2 for the samples' numbers i1 and i2."""
    values = [c for c in found.columns if c not in ("i1", "i2")]
    for k in "12":
        found = found.join(F.broadcast(people.select(F.col("i").alias(f"i{k}"), F.col("sample_id").alias(f"s{k}"))), f"i{k}")
    return found.select("s1", "s2", *values)


def compared(calls: DataFrame, compare: Callable[[np.ndarray, np.ndarray, np.ndarray], Iterator[tuple]], fields: str, part: int | None = None, by_site: Callable[..., Iterator[tuple]] | None = None) -> DataFrame:
    """s1, s2, chrom and ``fields`` of pairs of samples s1 < s2; with ``part`` a comparison holds so many tiles at most, and if a block has more
    there is a further column part.

    ``compare(ones, others, pos)`` takes the calls of two blocks, samples by sites, and yields arrays: numbers of the one sample,
    of the other, and values.  Within a block each pair comes both ways and is kept once.  With ``by_site`` calls that are sparse as a whole go to ``joined_by_site``.
    """
    sites, people = site_lists(calls)
    if by_site:
        found, samples = totals(sites), people.count()
        if found and sum(r.pairs for r in found) * SPARSE < sum(r.cells for r in found):
            width, blocks = block_size(found, samples, 2 * calls.sparkSession.sparkContext.defaultParallelism)
            return named(joined_by_site(sites, by_site, fields, width, len(found) * blocks * (blocks + 1) // 2), people)
    tiles, size = storage.kept(packed_tiles(sites)), BLOCK_SAMPLES
    if part and (tiles.groupBy("chrom", "block").count().agg(F.max("count")).head()[0] or 0) <= part:
        part = None
    # a tile of a block goes to the pairs of blocks that both have calls there
    there = tiles.groupBy("chrom", "tile").agg(F.collect_list("block").alias("there"))
    dealt = tiles.join(there, ["chrom", "tile"]).select("*", F.explode("there").alias("k")).withColumns({"i": F.least("block", "k"), "j": F.greatest("block", "k")}).drop("k", "there")
    dealt = dealt.withColumn("part", F.expr(f"tile div {part}") if part else F.lit(0))
    chrom = calls.schema["chrom"].dataType.simpleString()
    schema = f"i1 int, i2 int, chrom {chrom}, {fields}" + (", part long" if part else "")
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def run(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        block, (known, at) = t.column("block").to_numpy(), np.unique(t.column("tile").to_numpy(), return_inverse=True)
        calls_of = {b: np.full((0, 0), MISSING, np.int8) for b in (i, j)}
        pos = np.zeros(len(known) * TILE, np.int64)
        held = t.column("rows").to_numpy()
        for b in calls_of:
            calls_of[b] = np.full((int(held[block == b].max()), len(known) * TILE), MISSING, np.int8)
        for k, (b, place, rows) in enumerate(zip(block.tolist(), at.tolist(), held.tolist())):
            m = unpack(t.column("data")[k].as_py(), rows, 0)
            a = place * TILE
            calls_of[b][:rows, a : a + m.shape[1]] = m
            own = np.frombuffer(t.column("pos")[k].as_py(), np.int64)
            np.maximum(pos[a : a + len(own)], own, out=pos[a : a + len(own)])
        got = [np.concatenate(c) for c in zip(*compare(calls_of[i], calls_of[j], pos))]
        if not got:
            return shape.empty_table()
        keep = got[0] < got[1] if i == j else np.ones(len(got[0]), bool)
        a, b, *values = (c[keep] for c in got)
        columns = [a + i * size, b + j * size, np.full(len(a), t.column("chrom")[0].as_py()), *values, *([np.full(len(a), t.column("part")[0].as_py())] if part else [])]
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, shape)], schema=shape)

    return named(dealt.groupBy("chrom", "part", "i", "j").applyInArrow(run, schema), people)


def called_cells(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Samples and sites of the calls, sample by sample, and the calls of each site."""
    row, site = np.nonzero(m != MISSING)
    return row, site, np.bincount(site, minlength=m.shape[1])


def few_in_common(ones: np.ndarray, others: np.ndarray) -> bool:
    a, b = ((m != MISSING).sum(0) for m in (ones, others))
    return int(a @ b) * SPARSE < len(ones) * ones.shape[1] * len(others)


def common_calls(ones: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(one, other, site, difference) of the sites that two samples are both called at: by the one, then by site; about ``HELD`` at once, never a sample of the ones in two parts."""
    (row, site, _), (their, at, n) = called_cells(ones), called_cells(others)
    by_site = np.argsort(at, kind="stable")
    their, start = their[by_site], np.concatenate([[0], np.cumsum(n)])
    # ends of the samples' calls, and how many pairs there are before them
    ends = np.searchsorted(row, np.arange(len(ones)), "right")
    before, a = np.concatenate([[0], np.cumsum(n[site])]), 0
    while a < len(row):
        fits = int(np.searchsorted(before[ends], before[a] + HELD, "right"))
        z = max(int(ends[max(fits - 1, 0)]), int(ends[row[a]]))
        r, s = row[a:z], site[a:z]
        each = n[s]
        mine = np.repeat(np.arange(z - a), each)
        theirs = their[np.arange(len(mine)) - np.repeat(np.cumsum(each) - each, each) + start[s][mine]]
        one, where = r[mine], s[mine]
        yield one, theirs, where, np.abs(others[theirs, where] - ones[one, where])
        a = z


def pair_numbers(one: np.ndarray, other: np.ndarray, others: int, values: int = 1) -> tuple[np.ndarray, int]:
    """A number for each pair, in the narrowest type that holds so many values of each, and the first of the ones, which counts as 0."""
    first = int(one[0])
    kind = np.int32 if (int(one[-1]) - first + 1) * others * values < 1 << 31 else np.int64
    return (one - first).astype(kind) * kind(others) + other.astype(kind), first


def count_by_site(one: np.ndarray, other: np.ndarray, site: np.ndarray, gap: np.ndarray, others: int, pos: np.ndarray) -> Iterator[tuple]:
    """ibs0, ibs1 and ibs2 of pairs by their common sites."""
    pair, first = pair_numbers(one, other, others, 3)
    code = pair * 3 + gap
    if (int(one[-1]) - first + 1) * others <= 4 * len(code):
        counts = np.bincount(code, minlength=(int(one[-1]) - first + 1) * others * 3).reshape(-1, 3)
        pair = np.flatnonzero(counts.any(1))
        same, differ, opposite = counts[pair].T
    else:
        code = np.sort(code)
        pair = code // 3
        at = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        gap, pair = code - 3 * pair, pair[at]
        every = np.diff(np.append(at, len(code)))
        same, opposite = (np.add.reduceat(gap == g, at, dtype=np.int64) for g in (0, 2))
        differ = every - same - opposite
    yield pair // others + first, pair % others, opposite, differ, same


def ibs_counts(calls: DataFrame) -> DataFrame:
    """ibs0, ibs1 and ibs2 of every pair of samples that are both called at some variant; variants are counted in parts."""
    dealt = calls.select("variant_id", "sample_id", "dosage", F.lit(0).cast("long").alias("chrom"), F.lit(0).cast("long").alias("pos"))

    def compare(ones: np.ndarray, others: np.ndarray, pos: np.ndarray) -> Iterator[tuple]:
        size = len(ones), len(others)
        if few_in_common(ones, others):
            counts = np.zeros(size[0] * size[1] * 3, np.int64)
            for one, other, _, gap in common_calls(ones, others):
                counts += np.bincount((one * size[1] + other) * 3 + gap, minlength=len(counts))
            same, differ, opposite = np.moveaxis(counts.reshape(*size, 3), 2, 0)
            every = same + differ + opposite
        else:
            # counts as products of 0/1 matrices: calls of both, equal dosages, opposite homozygotes
            every, same, opposite = (np.zeros(size, np.int64) for _ in range(3))
            for p in range(0, len(pos), STEP):
                (a, b) = ([(m[:, p : p + STEP] == d).astype(np.float32) for d in range(3)] for m in (ones, others))
                every += (sum(a) @ sum(b).T).astype(np.int64)
                same += sum(x @ y.T for x, y in zip(a, b)).astype(np.int64)
                opposite += (a[0] @ b[2].T + a[2] @ b[0].T).astype(np.int64)
        k, o = np.nonzero(every)
        every, same, opposite = (m[k, o] for m in (every, same, opposite))
        yield k, o, opposite, every - same - opposite, same

    counts = compared(dealt, compare, "ibs0 long, ibs1 long, ibs2 long", max(1, PART_VARIANTS // TILE), count_by_site)
    if "part" not in counts.columns:  # every pair was compared once
        return counts.drop("chrom")
    return counts.groupBy("s1", "s2").agg(*[F.sum(f"ibs{k}").alias(f"ibs{k}") for k in range(3)])


def runs(breaks: np.ndarray, called: np.ndarray, pos: np.ndarray, min_snps: int, min_bp: int) -> tuple[np.ndarray, ...]:
    """(row, start, end, sites) of the stretches of called sites between breaks, row by row."""
    row, site = np.nonzero(called)
    return stretches(row, breaks[row, site], pos[site], min_snps, min_bp)


def stretches(row: np.ndarray, broken: np.ndarray, where: np.ndarray, min_snps: int, min_bp: int) -> tuple[np.ndarray, ...]:
    """``runs`` of called sites that are told by row, whether they break and position, in order."""
    # a stretch ends at a break and at a row's end
    island = np.cumsum(broken)
    open_ = ~broken
    row, where, island = row[open_], where[open_], island[open_]
    if not len(row):
        return row, row, row, row
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (island[1:] != island[:-1])]))
    last = np.append(first[1:], len(row)) - 1
    n, start, end = last - first + 1, where[first], where[last]
    keep = (n >= min_snps) & (end - start >= min_bp)
    return row[first[keep]], start[keep], end[keep], n[keep]


def window_edges(pos: np.ndarray, min_snps: int, min_bp: int) -> tuple[np.ndarray, int]:
    """The first sites of windows, and how many whole ones in a row the shortest segment covers: by position if that gives the longer stretch, else by sites."""
    w = max(1, (min_snps + 1) // 4)
    by_sites, need = np.arange(0, len(pos), w), max(1, (min_snps - w + 1) // w)
    if min_bp >= 4 and len(pos):
        cell = pos // (min_bp // 4)
        by_pos = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        # a segment covers three cells, but those without a site are no windows
        spread = len(by_pos) / max(1, int(cell[-1] - cell[0]) + 1)
        if spread == 1.0 and len(pos) / len(by_pos) * 3 > w * need:
            return by_pos, 3
    return by_sites, need


def may_share(ones: np.ndarray, others: np.ndarray, pos: np.ndarray, min_snps: int, min_bp: int) -> np.ndarray:
    """ones x others: whether a pair may have a segment; false only if every stretch that is long enough holds an opposite homozygote.

    Sparse calls, of which few pairs share enough for a window to tell anything, are not screened."""
    whole = np.ones((len(ones), len(others)), bool)
    edges, need = window_edges(pos, min_snps, min_bp)
    both = (ones != MISSING).mean(1).mean() * (others != MISSING).mean(1).mean() if len(pos) else 0.0
    if not len(pos) or both * len(pos) / len(edges) * need < SCREENED:
        return whole
    longest, now = (np.zeros((len(ones), len(others)), np.int32) for _ in range(2))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(pos)]):
        a0, a2, b0, b2 = ((m[:, a:b] == d).astype(np.float32) for m in (ones, others) for d in (0, 2))
        clean = (a0 @ b2.T + a2 @ b0.T) == 0
        now = np.where(clean, now + 1, 0)
        np.maximum(longest, now, out=longest)
    return longest >= need


def all_segments(calls: DataFrame, min_snps: dict[int, int], min_bp: int = 0) -> DataFrame:
    """Runs per pair, chromosome and state (the keys of ``min_snps``), both in one comparison.

    IBD1 runs (state 1) break at opposite homozygotes; IBD2 runs (state 2) break wherever the dosages differ, so they hold no opposite homozygote either.
    """

    def compare(ones: np.ndarray, others: np.ndarray, pos: np.ndarray) -> Iterator[tuple]:
        if few_in_common(ones, others):
            for one, other, site, gap in common_calls(ones, others):
                order = np.argsort(one * len(others) + other, kind="stable")
                pair, gap, where = (one * len(others) + other)[order], gap[order], pos[site[order]]
                for state, least in min_snps.items():
                    row, *values = stretches(pair, gap == 2 if state == 1 else gap != 0, where, least, min_bp)
                    yield row // len(others), row % len(others), np.full(len(row), state), *values
            return
        # sites that neither block is called at have no position here, and no segment needs them
        sited = np.flatnonzero((ones != MISSING).any(0) | (others != MISSING).any(0))
        may = may_share(ones[:, sited], others[:, sited], pos[sited], min(min_snps.values()), min_bp)
        for k, one in enumerate(ones):
            # only sites that this sample is called at, and samples that the screen leaves
            site, left = np.flatnonzero(one != MISSING), np.flatnonzero(may[k])
            step = max(1, HELD // max(1, len(site)))
            for a in range(0, len(left), step):
                theirs = others[np.ix_(left[a : a + step], site)]
                called, d = theirs != MISSING, np.abs(theirs - one[site])
                for state, least in min_snps.items():
                    row, *values = runs(d == 2 if state == 1 else d != 0, called, pos[site], least, min_bp)
                    yield np.full(len(row), k), left[row + a], np.full(len(row), state), *values

    def by_site(one: np.ndarray, other: np.ndarray, site: np.ndarray, gap: np.ndarray, others: int, pos: np.ndarray) -> Iterator[tuple]:
        pair, first = pair_numbers(one, other, others)
        if (least := min(min_snps.values())) > 1:
            # only pairs with as many common sites as the shortest segment has
            ordered = np.sort(pair)
            often = ordered[: len(ordered) - least + 1][ordered[least - 1 :] == ordered[: len(ordered) - least + 1]]
            if not len(often):
                return
            left = often[np.minimum(np.searchsorted(often, pair), len(often) - 1)] == pair
            pair, site, gap = pair[left], site[left], gap[left]
        order = np.argsort(pair, kind="stable")
        pair, gap, where = pair[order], gap[order], pos[site[order]]
        for state, least in min_snps.items():
            row, *values = stretches(pair, gap == 2 if state == 1 else gap != 0, where, least, min_bp)
            yield row // others + first, row % others, np.full(len(row), state), *values

    return compared(calls, compare, "state int, start_pos long, end_pos long, n_snps long", by_site=by_site)


def segments(calls: DataFrame, min_snps: int = 8, min_bp: int = 0, state: int = 1) -> DataFrame:
    """Runs per pair and chromosome of calls(variant_id, sample_id, dosage, chrom, pos) without a break of the state."""
    return all_segments(calls, {state: min_snps}, min_bp).drop("state")


def sharing(found: DataFrame, genome_length: int) -> DataFrame:
    """IBD1Seg, IBD2Seg, PropIBD and the largest segments per pair of ``all_segments``; IBD2 runs lie within IBD1 runs and are taken off them."""
    length = F.col("end_pos") - F.col("start_pos") + 1
    of = lambda state: F.when(F.col("state") == state, length)
    sums = [F.coalesce(agg(of(k)), F.lit(0)).alias(f"{name}{k}") for name, agg in (("l", F.sum), ("MaxIBD", F.max)) for k in (1, 2)]
    both = found.groupBy("s1", "s2").agg(*sums)
    g = F.lit(float(genome_length))
    both = both.withColumn("IBD2Seg", F.col("l2") / g).withColumn("IBD1Seg", F.greatest(F.lit(0.0), F.col("l1") / g - F.col("IBD2Seg")))
    return both.withColumn("PropIBD", F.col("IBD1Seg") / 2 + F.col("IBD2Seg")).select("s1", "s2", "IBD1Seg", "IBD2Seg", "PropIBD", "MaxIBD1", "MaxIBD2")


def segments_x(calls: DataFrame, min_snps: int = 8, min_bp: int = 0) -> DataFrame:
    """``all_segments`` of chromosome X without its pseudo-autosomal regions."""
    return all_segments(calls.filter(F.col("chrom").rlike("^(chr)?(X|23)$")), {1: min_snps, 2: min_snps}, min_bp)


def sharing_x(calls: DataFrame, people: DataFrame, length: int, min_snps: int = 8, min_bp: int = 0) -> DataFrame:
    """Sharing on chromosome X, with the sexes of ``people(sample_id, sex)``; 0 where unknown."""
    return sharing_with_sex(segments_x(calls, min_snps, min_bp), people, length)


def sharing_with_sex(found: DataFrame, people: DataFrame, length: int) -> DataFrame:
    """``sharing`` of segments, with the sexes of both samples."""
    found = sharing(found, length)
    for k in "12":
        sex = people.select(F.col("sample_id").alias(f"s{k}"), F.col("sex").cast("int").alias(f"Sex{k}"))
        found = found.join(sex, f"s{k}", "left")
    return found.na.fill(0, ["Sex1", "Sex2"]).select(
        F.col("s1").alias("ID1"), F.col("s2").alias("ID2"), "Sex1", "Sex2", "MaxIBD1", "MaxIBD2", "IBD1Seg", "IBD2Seg", "PropIBD"
    )


def relationship(prop: Column, ibd1: Column, ibd2: Column) -> Column:
    """Dup/MZ, FS, PO, 2nd, 3rd; null beyond the third degree."""
    return (
        F.when(ibd2 > DUPLICATE_IBD2, "Dup/MZ").when((prop >= FIRST) & (ibd2 >= FULL_SIB_IBD2), "FS").when(prop >= FIRST, "PO").when(prop >= SECOND, "2nd").when(prop >= THIRD, "3rd")
    )


def relatives(shared: DataFrame) -> DataFrame:
    """Classified pairs up to the third degree."""
    return shared.withColumn("InfType", relationship(F.col("PropIBD"), F.col("IBD1Seg"), F.col("IBD2Seg"))).filter("InfType IS NOT NULL")
