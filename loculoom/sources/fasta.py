"""The reference sequence by ranges of an indexed FASTA file, and variants in their normal form against it.

Sites are dealt to tasks by tiles of the reference and come in order within a task, so each task reads the stretches around its sites once,
with seeks; no table of bases is needed, and a REF may run across tiles.  An indel is moved to the left over a stretch at a time, and how far a
repeat goes is kept for the next site in it, so that a long repeat is read once a task and not once a site.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import opened

#: Bases that are read and held at once, and how many such pieces; bases of a tile; repeats that are remembered.
PIECE, HELD, TILE, REPEATS = 1 << 16, 8, 1 << 22, 64
BASES = set("ACGTN")


class Fasta:
    """Bases of a FASTA file by its index (<path>.fai: name, length, offset, bases and bytes of a line)."""

    def __init__(self, path: str, piece: int = PIECE):
        store, inner = opened(path)
        with store.open_input_file(f"{inner}.fai") as f:
            rows = [line.split("\t") for line in f.read().decode().splitlines() if line.strip()]
        self.index = {r[0]: tuple(map(int, r[1:5])) for r in rows}
        self.file, self.piece, self.held, self.reads = store.open_input_file(inner), piece, OrderedDict(), 0
        self.repeats: OrderedDict[tuple[str, int], tuple[int, int]] = OrderedDict()

    def name(self, chrom: str) -> str | None:
        """The contig as the file calls it, with or without chr."""
        bare = chrom.removeprefix("chr")
        other = {"M": "MT", "MT": "M"}.get(bare, bare)
        return next((n for n in (chrom, f"chr{bare}", bare, f"chr{other}", other) if n in self.index), None)

    def take(self, name: str, begin: int, end: int) -> str:
        """Bases [begin, end), from 0, in upper case; what lies outside the contig is left out."""
        begin, end, out = max(0, begin), min(end, self.index[name][0]), []
        for k in range(begin // self.piece, -(-end // self.piece)):
            text = self.stretch(name, k)
            out.append(text[max(0, begin - k * self.piece) : max(0, end - k * self.piece)])
        return "".join(out)

    def stretch(self, name: str, k: int) -> str:
        if (name, k) in self.held:
            self.held.move_to_end((name, k))
            return self.held[name, k]
        self.held[name, k] = text = self.span(name, k * self.piece, min(self.index[name][0], (k + 1) * self.piece))
        if len(self.held) > HELD:
            self.held.popitem(last=False)
        return text

    def span(self, name: str, begin: int, end: int) -> str:
        """Bases [begin, end) within the contig, by one read."""
        _, offset, bases, width = self.index[name]
        at = lambda p: offset + p // bases * width + p % bases
        self.reads += 1
        return "".join(self.file.read_at(at(end - 1) + 1 - at(begin), at(begin)).decode().split()).upper()

    def repeat_start(self, name: str, at: int, n: int) -> int:
        """The least p such that every base of [p, at) is the one that lies ``n`` further on; ``at + n`` lies within the contig.

        The last stretch that was found for a contig and length is kept, and one that begins further on stops where it meets it."""
        low, high = self.repeats.get((name, n), (0, -1))
        if low <= at <= high:
            return low
        met = 0 <= high < at
        floor, p, size = high if met else 0, at, 64
        while p > floor:
            a = max(floor, p - size)
            text = self.take(name, a, p + n) if size <= self.piece else self.span(name, a, p + n)
            here, there = text[: p - a], text[n:]
            if here != there:
                p = a + max(k for k, (x, y) in enumerate(zip(here, there)) if x != y) + 1
                break
            p, size = a, min(2 * size, PIECE)
        else:
            p = low if met else p
        self.repeats[name, n] = p, at
        self.repeats.move_to_end((name, n))
        if len(self.repeats) > REPEATS:
            self.repeats.popitem(last=False)
        return p


def normal_form(fasta: Fasta, chrom: str, pos: int, ref: str, alt: str) -> tuple[int, str, str] | None:
    """(pos, ref, alt), moved to the left and trimmed as far as they go; None if REF is not what the reference has there.

    An ALT that is not made of bases (``*``, ``.``, ``<DEL>``) is only checked."""
    name, ref, alt = fasta.name(chrom), ref.upper(), alt.upper()
    if name is None or not ref or pos < 1 or fasta.take(name, pos - 1, pos - 1 + len(ref)) != ref:
        return None
    if set(alt) - BASES or not alt or ref == alt:
        return pos, ref, alt
    while ref and alt and ref[-1] == alt[-1] and (pos > 1 or min(len(ref), len(alt)) > 1):
        ref, alt = ref[:-1], alt[:-1]
    if not ref or not alt:
        pos, unit = moved(fasta, name, pos - 1, ref or alt)
        # the base before it, or at the contig's first position the one that it is anchored to there
        ref, alt = (unit, "") if ref else ("", unit)
        base = fasta.take(name, pos - 1, pos)
        ref, alt = base + ref, base + alt
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def moved(fasta: Fasta, name: str, at: int, unit: str) -> tuple[int, str]:
    """An inserted or removed ``unit`` before or at base ``at`` (from 0), at least 1, as far to the left as leaves a base before it: where that is, and the unit there."""
    n = len(unit)
    # the first turns of the unit compare with its own bases
    step = 0
    while at - step > 1 and step < n and fasta.take(name, at - step - 1, at - step) == unit[-1 - step]:
        step += 1
    if step == n:
        start = max(1, fasta.repeat_start(name, at - n, n))
        step = at - start
    turn = step % n
    return at - step, unit[n - turn :] + unit[: n - turn]


def normalised(sites: DataFrame, path: str, tile: int = TILE, piece: int = PIECE) -> DataFrame:
    """The rows of ``sites(chrom, pos, ref, alt, ...)`` whose REF agrees with the FASTA file, one ALT a row, in their normal form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fasta = None
        for b in batches:
            fasta = fasta or Fasta(path, piece)
            place = {c: b.schema.get_field_index(c) for c in ("chrom", "pos", "ref", "alt")}
            rows = zip(*(b.column(k).to_pylist() for k in place.values()))
            got = [normal_form(fasta, *r) if None not in r else None for r in rows]
            mask = pa.array([g is not None for g in got], pa.bool_())
            good, kept = [g for g in got if g is not None], b.filter(mask)
            for k, c in enumerate(("pos", "ref", "alt")):
                kept = kept.set_column(place[c], b.schema.field(place[c]), pa.array([g[k] for g in good], b.schema.field(place[c]).type))
            yield kept

    dealt = sites.withColumn("tile_", F.expr(f"pos div {tile}")).repartition("chrom", "tile_").sortWithinPartitions("chrom", "pos").drop("tile_")
    return dealt.mapInArrow(run, sites.schema)
