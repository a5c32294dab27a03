"""BGZF, BCF and CSI as Spark sources and sinks.

A BGZF file is a row of gzip blocks of at most 64 KiB; a place in it is a virtual offset, the block's offset in the file and, in the low 16
bits, the place in the unpacked block.  The index of a coordinate-sorted file lists by contig and bin (of 2^14 positions, and five levels
above, eight times as wide each) the chunks of virtual offsets whose records lie in the bin.  ``bcf`` reads a region by the chunks
of its bins, or a whole file in ranges that begin at chunks; it writes one BCF with its index from many tasks.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .plink import CELLS, GT, HELD, SPLIT, PiecesReader, batch_dosages, cell_lists
from .storage import SPLITS, Part, SingleFile, opened, size_of

#: Fixed values of the formats: the head of a BGZF block, the empty block at the end, and the parameters of the binning.
BLOCK_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00"
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MIN_SHIFT, DEPTH = 14, 5
#: Unpacked bytes of a written block.
BLOCK = 0xFF00
#: numpy types of the typed values, and their values that stand for missing and for the end of a short vector.
TYPES = {1: "<i1", 2: "<i2", 3: "<i4", 5: "<f4", 7: "S1"}


def packed_block(data: bytes) -> bytes:
    raw = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = raw.compress(data) + raw.flush()
    return BLOCK_HEAD + struct.pack("<H", len(BLOCK_HEAD) + len(body) + 9) + body + struct.pack("<II", zlib.crc32(data), len(data))


class BlockWriter:
    """Packs a stream in blocks of equal unpacked size, so that the place of any byte follows from the blocks' sizes."""

    def __init__(self):
        self.held, self.sizes, self.length = bytearray(), [], 0

    def put(self, data: bytes) -> bytes:
        self.held += data
        self.length += len(data)
        out = bytearray()
        while len(self.held) >= BLOCK:
            out += self.block(bytes(self.held[:BLOCK]))
            del self.held[:BLOCK]
        return bytes(out)

    def block(self, data: bytes) -> bytes:
        done = packed_block(data)
        self.sizes.append(len(done))
        return done

    def flush(self) -> bytes:
        data, self.held = bytes(self.held), bytearray()
        return self.block(data) if data else b""

    def virtual(self, at: np.ndarray) -> np.ndarray:
        """Virtual offsets of places in the unpacked stream, after ``flush``; its end is the place behind the last block."""
        starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        return np.where(at == self.length, starts[-1] << 16, starts[np.minimum(at // BLOCK, len(self.sizes))] << 16 | at % BLOCK)


class BlockReader:
    """Reads on from a virtual offset; counts the blocks that it unpacks."""

    def __init__(self, f, virtual: int = 0):
        self.f, self.next, self.at, self.data, self.start, self.blocks = f, virtual >> 16, 0, b"", virtual >> 16, 0
        if virtual & 0xFFFF:
            self.more()
            self.at = virtual & 0xFFFF

    def more(self) -> bool:
        """Go on to the next block that is not empty."""
        while True:
            head = self.f.read_at(18, self.next)
            if len(head) < 18:
                return False
            if head[:4] != BLOCK_HEAD[:4] or head[12:14] != b"BC":
                raise ValueError("not a BGZF block")
            size = struct.unpack_from("<H", head, 16)[0] + 1
            body = self.f.read_at(size - 18, self.next + 18)
            self.data, self.start, self.at = zlib.decompress(body[:-8], -15), self.next, 0
            self.next += size
            self.blocks += 1
            if self.data:
                return True

    def tell(self) -> int:
        return self.next << 16 if self.at >= len(self.data) else self.start << 16 | self.at

    def take(self, n: int) -> bytes:
        """The next n bytes, fewer at the end."""
        out = bytearray()
        while len(out) < n:
            if self.at >= len(self.data) and not self.more():
                break
            piece = self.data[self.at : self.at + n - len(out)]
            self.at += len(piece)
            out += piece
        return bytes(out)

    def before(self, end: int | None, least: int) -> bytes:
        """The next bytes that lie before a virtual offset (None: all), ``least`` or a little more, fewer at the end."""
        out, n = [], 0
        while n < least:
            if self.at >= len(self.data) and ((end is not None and self.next << 16 >= end) or not self.more()):
                break
            stop = len(self.data) if end is None or self.start < end >> 16 else end & 0xFFFF if self.start == end >> 16 else 0
            if stop <= self.at:
                break
            out.append(self.data[self.at : stop])
            self.at, n = stop, n + len(out[-1])
        return b"".join(out)


def bins_of(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``bin_of`` of many records."""
    out, first = np.zeros(len(begin), np.int64), 0
    for level in range(1, DEPTH + 1):
        shift, first = MIN_SHIFT + 3 * (DEPTH - level), first + (1 << 3 * (level - 1))
        out = np.where(begin >> shift == (end - 1) >> shift, first + (begin >> shift), out)
    return out


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds [begin, end)."""
    shift, first = MIN_SHIFT, ((1 << 3 * DEPTH) - 1) // 7
    for level in range(DEPTH, 0, -1):
        if begin >> shift == (end - 1) >> shift:
            return first + (begin >> shift)
        shift, first = shift + 3, first - (1 << 3 * (level - 1))
    return 0


def bins_over(begin: int, end: int) -> set[int]:
    """All bins that may hold a record which overlaps [begin, end)."""
    out, first = set(), 0
    for level in range(DEPTH + 1):
        shift = MIN_SHIFT + 3 * (DEPTH - level)
        out |= set(range(first + (begin >> shift), first + ((end - 1) >> shift) + 1))
        first += 1 << 3 * level
    return out


def bin_start(number: int) -> int:
    """The first position of a bin."""
    first = 0
    for level in range(DEPTH + 1):
        if number < first + (1 << 3 * level):
            return (number - first) << (MIN_SHIFT + 3 * (DEPTH - level))
        first += 1 << 3 * level
    raise ValueError(f"no bin {number}")


class Index:
    """Chunks by contig and bin, and by contig and window the first record that overlaps the window."""

    def __init__(self):
        self.chunks: dict[tuple[int, int], list[list[int]]] = {}
        self.first: dict[tuple[int, int], int] = {}

    def add(self, contig: int, begin: int, end: int, where: tuple[int, int]) -> None:
        """A record at [begin, end) whose bytes lie at the virtual offsets ``where``; records come in the file's order."""
        held = self.chunks.setdefault((contig, bin_of(begin, end)), [])
        if held and held[-1][1] == where[0]:
            held[-1][1] = where[1]
        else:
            held.append(list(where))
        for window in range(begin >> MIN_SHIFT, ((end - 1) >> MIN_SHIFT) + 1):
            self.first.setdefault((contig, window), where[0])

    def add_all(self, contig: np.ndarray, begin: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """``add`` of records one behind the other: those of a bin that follow each other are one chunk."""
        if not len(contig):
            return
        changed = lambda *keys: np.append(True, np.any([k[1:] != k[:-1] for k in keys], 0))
        bins, low, high = bins_of(begin, end), begin >> MIN_SHIFT, (end - 1) >> MIN_SHIFT
        starts = np.flatnonzero(changed(contig, bins))
        for c, x, *where in zip(contig[starts].tolist(), bins[starts].tolist(), a[starts].tolist(), b[np.append(starts[1:], len(b)) - 1].tolist()):
            held = self.chunks.setdefault((c, x), [])
            if held and held[-1][1] == where[0]:
                held[-1][1] = where[1]
            else:
                held.append(where)
        at = np.flatnonzero(changed(contig, low) | (low != high))
        for c, w, z, first in zip(contig[at].tolist(), low[at].tolist(), high[at].tolist(), a[at].tolist()):
            for window in range(w, z + 1):
                self.first.setdefault((c, window), first)

    def to_bytes(self, contigs: int) -> bytes:
        out = b"CSI\x01" + struct.pack("<iiii", MIN_SHIFT, DEPTH, 0, contigs)
        windows: dict[int, list[tuple[int, int]]] = {}
        for (c, w), v in sorted(self.first.items()):
            windows.setdefault(c, []).append((w, v))
        by: dict[int, list] = {}
        for (c, b), held in sorted(self.chunks.items()):
            by.setdefault(c, []).append((b, held))
        for c in range(contigs):
            out += struct.pack("<i", len(by.get(c, [])))
            at = np.array([w for w, _ in windows.get(c, [])], np.int64)
            for b, held in by.get(c, []):
                k = max(0, int(np.searchsorted(at, bin_start(b) >> MIN_SHIFT, "right")) - 1)
                out += struct.pack("<IQi", b, windows[c][k][1], len(held)) + b"".join(struct.pack("<QQ", *x) for x in held)
        writer = BlockWriter()
        return writer.put(out) + writer.flush() + LAST_BLOCK


def read_index(path: str) -> dict[int, dict[int, tuple[int, list[tuple[int, int]]]]] | None:
    """Of every contig the bins, with their least offset and their chunks; None if there is no index."""
    store, inner = opened(path)
    if store.get_file_info(inner).type != fs.FileType.File:
        return None
    with store.open_input_file(inner) as f:
        reader = BlockReader(f)
        if reader.take(4) != b"CSI\x01":
            raise ValueError(f"{path} is not a CSI index")
        shift, depth, more = struct.unpack("<iii", reader.take(12))
        if (shift, depth) != (MIN_SHIFT, DEPTH):
            raise ValueError(f"{path}: bins of another width than 2^{MIN_SHIFT} are not read")
        reader.take(more)
        out: dict = {}
        for contig in range(struct.unpack("<i", reader.take(4))[0]):
            own = out.setdefault(contig, {})
            for _ in range(struct.unpack("<i", reader.take(4))[0]):
                number, least, n = struct.unpack("<IQi", reader.take(16))
                own[number] = least, [struct.unpack("<QQ", reader.take(16)) for _ in range(n)]
        return out


def typed(values: list[int]) -> bytes:
    """Integers as a typed vector of the narrowest width."""
    top = max((abs(v) for v in values), default=0)
    kind, form = (1, "b") if top < 120 else (2, "h") if top < 32_000 else (3, "i")
    return typed_size(len(values), kind) + struct.pack(f"<{len(values)}{form}", *values)


def typed_size(n: int, kind: int) -> bytes:
    return bytes([n << 4 | kind]) if n < 15 else bytes([15 << 4 | kind]) + typed([n])


def typed_text(text: str) -> bytes:
    data = text.encode()
    return typed_size(len(data), 7) + data


def read_typed(data: bytes, at: int) -> tuple[int, int, int]:
    """(type, number of values, where they begin)."""
    kind, n = data[at] & 15, data[at] >> 4
    at += 1
    if n == 15:
        k, _, at = read_typed(data, at)
        n = int(np.frombuffer(data, TYPES[k], 1, at)[0])
        at += np.dtype(TYPES[k]).itemsize
    return kind, n, at


class Header:
    """Contigs, field names and samples of a BCF's header text."""

    def __init__(self, text: str):
        lines = text.rstrip("\0\n").split("\n")
        self.samples, self.contigs, self.names = lines[-1].split("\t")[9:], {}, {0: "PASS"}
        for line in lines[:-1]:
            found = re.match(r"##(contig|FILTER|INFO|FORMAT)=<ID=([^,>]+)(.*)>$", line)
            if not found:
                continue
            place = re.search(r",IDX=(\d+)", found[3])
            held = self.contigs if found[1] == "contig" else self.names
            if place or found[2] not in held.values():
                held[int(place[1]) if place else len(held)] = found[2]

    @staticmethod
    def text(contigs: list[str], samples: list[str]) -> str:
        lines = ["##fileformat=VCFv4.2", '##FILTER=<ID=PASS,Description="All filters passed",IDX=0>', *(f"##contig=<ID={c},IDX={k}>" for k, c in enumerate(contigs))]
        lines += ['##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype",IDX=1>', "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])]
        return "\n".join(lines) + "\n"


def read_header(reader: BlockReader) -> Header:
    if reader.take(5) != b"BCF\x02\x02":
        raise ValueError("not a BCF file of version 2.2")
    return Header(reader.take(struct.unpack("<I", reader.take(4))[0]).decode())


#: Alleles of a dosage of ALT, in the coding of the GT field: (allele + 1) * 2, 0 where missing; dosages 0, 1, 2 and -1.
GT_CODES = np.array([[2, 2], [2, 4], [4, 4], [0, 0]], np.int8)


def record(contig: int, pos: int, variant_id: str, ref: str, alts: list[str], dosage: np.ndarray) -> bytes:
    """A record with hard calls alone; the position counts from 1."""
    shared = struct.pack("<iiifII", contig, pos - 1, len(ref), 0.0, (1 + len(alts)) << 16, 1 << 24 | len(dosage))
    shared = shared[:12] + b"\x01\x00\x80\x7f" + shared[16:]  # no quality
    shared += typed_text(variant_id) + b"".join(typed_text(a) for a in (ref, *alts)) + typed_size(0, 1)
    own = typed([1]) + typed_size(2, 1) + GT_CODES[dosage].tobytes()
    return struct.pack("<II", len(shared), len(own)) + shared + own


def decoded(shared: bytes, own: bytes, head: Header) -> tuple:
    """(chrom, pos, variant_id, ref, alt, gt): of every sample the number of alleles that are not REF, -1 if one is missing."""
    contig, pos, _, _, alleles, fields = struct.unpack_from("<iiifII", shared)
    at, texts = 24, []
    for _ in range(1 + (alleles >> 16)):
        _, n, at = read_typed(shared, at)
        texts.append(shared[at : at + n].decode())
        at += n
    gt, at = np.full(fields & 0xFFFFFF, -1, np.int8), 0
    for _ in range(fields >> 24):
        key, _, at = read_typed(own, at)
        name = head.names[int(np.frombuffer(own, TYPES[key], 1, at)[0])]
        kind, n, at = read_typed(own, at + np.dtype(TYPES[key]).itemsize)
        values = np.frombuffer(own, TYPES[kind], n * len(gt), at)
        at += values.nbytes
        if name == "GT":
            # allele by allele, in the width of the file
            codes = values.reshape(len(gt), n).T
            ended = [c == np.iinfo(np.dtype(TYPES[kind])).min + 1 for c in codes]
            missing = reduce(np.logical_or, [(c >> 1 == 0) & ~e for c, e in zip(codes, ended)], reduce(np.logical_and, ended, np.ones(len(gt), bool)))
            gt = np.where(missing, np.int8(-1), sum(((c >> 1 > 1) & ~e).astype(np.int8) for c, e in zip(codes, ended)))
    return head.contigs[contig], pos + 1, texts[0], texts[1], ",".join(texts[2:]), gt


#: Of the two alleles of a genotype in one byte each, as ``decoded`` reads them: how many are not REF, -1 where one is missing.
def pair_dosages() -> np.ndarray:
    codes = [(np.arange(1 << 16) >> s & 255).astype(np.uint8).view(np.int8) for s in (0, 8)]
    ended = [c == -127 for c in codes]
    missing = reduce(np.logical_or, [(c >> 1 == 0) & ~e for c, e in zip(codes, ended)], ended[0] & ended[1])
    return np.where(missing, np.int8(-1), sum(((c >> 1 > 1) & ~e).astype(np.int8) for c, e in zip(codes, ended))).astype(np.int8)


PAIR_DOSAGES = pair_dosages()


def texts_of(data: np.ndarray) -> pa.Array:
    """Texts of equal length, a row of bytes each."""
    n, length = data.shape
    return pa.StringArray.from_buffers(n, pa.py_buffer((np.arange(n + 1) * length).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def plain_layout(one: bytes, shared: int, head: Header) -> list[tuple[int, int]] | None:
    """Where id, REF and ALT of a record lie (begin, end) that has one ALT allele and hard calls of two one-byte alleles alone; None if it has more."""
    _, _, _, _, alleles, fields = struct.unpack_from("<iiifII", one, 8)
    if alleles != 2 << 16 or fields >> 24 != 1:
        return None
    at, places = 32, []
    for _ in range(3):
        _, n, at = read_typed(one, at)
        places.append((at, at + n))
        at += n
    key, _, at = read_typed(one, 8 + shared)
    name = head.names[int(np.frombuffer(one, TYPES[key], 1, at)[0])]
    kind, n, at = read_typed(one, at + np.dtype(TYPES[key]).itemsize)
    return places if name == "GT" and (TYPES[kind], n) == (TYPES[1], 2) and len(one) - at == 2 * (fields & 0xFFFFFF) else None


def decoded_all(data: np.ndarray, at: np.ndarray, shared: np.ndarray, own: np.ndarray, head: Header) -> tuple[list[pa.Array], np.ndarray]:
    """chrom, pos, variant_id, ref, alt and dosages (-1: missing) of records that begin at ``at``: those of one layout together, others by ``decoded``."""
    samples, place, columns, dosages = len(head.samples), [], [], np.full((len(at), len(head.samples)), -1, np.int8)
    names = pa.array([head.contigs.get(k) for k in range(max(head.contigs, default=-1) + 1)], pa.string())
    for size in np.unique(shared << 32 | own).tolist():
        s, o = size >> 32, size & 0xFFFFFFFF
        left = np.flatnonzero((shared == s) & (own == o))
        while len(left):
            one = data[at[left[0]] : at[left[0]] + 8 + s + o].tobytes()
            texts = plain_layout(one, s, head)
            if texts is None:
                chrom, pos, *told, dosages[left[0]] = decoded(one[8 : 8 + s], one[8 + s :], head)
                place.append(left[:1])
                columns.append([pa.array([chrom], pa.string()), pa.array([pos], pa.int64()), *(pa.array([x], pa.string()) for x in told)])
                left = left[1:]
                continue
            # all that is no number, text or genotype must be as in the first
            rows = data[at[left][:, None] + np.arange(8 + s + o)]
            fixed = np.ones(8 + s + o, bool)
            fixed[8:24] = fixed[8 + s + o - 2 * samples :] = False
            for a, z in texts:
                fixed[a:z] = False
            alike = (rows[:, fixed] == rows[0, fixed]).all(1)
            rows, now, left = rows[alike], left[alike], left[~alike]
            contig, pos = (np.ascontiguousarray(rows[:, k : k + 4]).view("<i4")[:, 0] for k in (8, 12))
            place.append(now)
            columns.append([names.take(pa.array(contig)), pa.array(pos.astype(np.int64) + 1), *(texts_of(rows[:, a:z]) for a, z in texts)])
            if samples:
                dosages[now] = PAIR_DOSAGES[np.ascontiguousarray(rows[:, 8 + s + o - 2 * samples :]).view("<u2")]
    order = pa.array(np.argsort(np.concatenate(place)))
    return [pa.concat_arrays(c).take(order) for c in zip(*columns)], dosages


class Chunk(InputPartition):
    def __init__(self, begin: int, end: int | None):
        self.begin, self.end = begin, end


class BcfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitbytes") or options.get("splitBytes") or SPLIT)
        self.region, self.blocks, self.cells, self.splits = None, 0, bool(options.get("cells")), int(options.get("splits") or SPLITS)
        if options.get("region"):
            found = re.fullmatch(r"(.+?)(?::(\d+)-(\d+))?", options["region"])
            self.region = found[1], int(found[2] or 1) - 1, int(found[3] or 1 << MIN_SHIFT + 3 * DEPTH)

    def counts(self) -> tuple[int, int]:
        """Samples; variants have no numbers."""
        store, inner = opened(self.path)
        with store.open_input_file(inner) as f:
            return 0, len(read_header(BlockReader(f)).samples)

    def partitions(self) -> list[Chunk]:
        store, inner = opened(self.path)
        with store.open_input_file(inner) as f:
            reader = BlockReader(f)
            head, first = read_header(reader), reader.tell()
        index = read_index(f"{self.path}.csi")
        if index is None:
            return [Chunk(first, None)]
        if self.region is None:
            # every chunk begins with a record; ranges between such beginnings cover the file
            split = max(self.split, -(-size_of(self.path) // self.splits))
            starts, begins = [first], sorted(b for bins in index.values() for _, held in bins.values() for b, _ in held)
            for b in begins:
                if (b >> 16) - (starts[-1] >> 16) >= split:
                    starts.append(b)
            return [Chunk(a, b) for a, b in zip(starts, [*starts[1:], None])]
        contig, begin, end = self.region
        number = next((k for k, c in head.contigs.items() if c == contig), None)
        bins = index.get(number, {})
        over = bins_over(begin, end)
        leaf = [b for b in bins if b >= ((1 << 3 * DEPTH) - 1) // 7 and bin_start(b) <= begin]
        least = bins[max(leaf)][0] if leaf else 0
        out: list[list[int]] = []
        for a, b in sorted(c for x in over & set(bins) for c in bins[x][1]):
            if b <= least:
                continue
            if out and a >> 16 <= out[-1][1] >> 16:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [Chunk(a, b) for a, b in out]

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        store, inner = opened(self.path)
        with store.open_input_file(inner) as f:
            head = read_header(BlockReader(f))
            reader, data, least = BlockReader(f, partition.begin), b"", 1 << 22
            while more := reader.before(partition.end, least):
                data += more
                at, places, sizes = 0, [], []
                while at + 8 <= len(data):
                    shared, own = struct.unpack_from("<II", data, at)
                    if at + 8 + shared + own > len(data):
                        break
                    places.append(at)
                    sizes.append((shared, own))
                    at += 8 + shared + own
                yield from self.batches(np.frombuffer(data, np.uint8), np.array(places, np.int64), np.array(sizes, np.int64).reshape(-1, 2), head)
                data = data[at:]
            self.blocks += reader.blocks

    def batches(self, data: np.ndarray, at: np.ndarray, sizes: np.ndarray, head: Header) -> Iterator[pa.RecordBatch]:
        if self.region and len(at):
            contig, pos, length = (data[at[:, None] + k + np.arange(4)].view("<i4")[:, 0].astype(np.int64) for k in (8, 12, 16))
            wanted = [k for k, c in head.contigs.items() if c == self.region[0]]
            inside = np.isin(contig, wanted) & (pos < self.region[2]) & (pos + np.maximum(1, length) > self.region[1])
            at, sizes = at[inside], sizes[inside]
        samples = len(head.samples)
        step = max(1, 2_000_000 // max(1, samples))
        for k in range(0, len(at), step):
            own = sizes[k : k + step]
            columns, dosages = decoded_all(data, at[k : k + step], own[:, 0], own[:, 1], head)
            if self.cells:
                row, i = np.nonzero(dosages >= 0)
                gt = cell_lists(len(own), row, i, dosages[row, i])
            else:
                flat = dosages.reshape(-1)
                gt = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * samples, pa.int32()), pa.array(flat, pa.int8(), mask=flat < 0))
            yield pa.RecordBatch.from_arrays([*columns, gt], names=["chrom", "pos", "variant_id", "ref", "alt", "cells" if self.cells else "gt"])


class Lines(SingleFile):
    """A text file of rows(ord, ...): ``fields`` by tabs, columns or constants."""

    columns = ("chrom", "pos", "variant_id", "ref", "alt")
    fields: tuple[str, ...] = columns

    def encode(self, batch: pa.RecordBatch) -> bytes:
        cells = [batch.column(k).cast(pa.string()) if (k := batch.schema.get_field_index(c)) >= 0 else c for c in self.fields]
        lines = pc.binary_join_element_wise(pc.binary_join_element_wise(*cells, "\t"), "\n", "")
        if lines.null_count:
            raise ValueError("a variant has no contig, position, id or alleles")
        return pc.binary_join(pa.ListArray.from_arrays([0, len(lines)], lines), "")[0].as_py().encode()


class BimWriter(Lines):
    """Variants of a PLINK 1 fileset: contig, id, 0, position, ALT (A1), REF (A2)."""

    fields = ("chrom", "variant_id", "0", "pos", "alt", "ref")


class PvarWriter(Lines):
    def head(self, parts: list[Part]) -> Iterable[bytes]:
        return (b"#CHROM\tPOS\tID\tREF\tALT\n",)


class Blocked(SingleFile):
    """A BGZF file; options contigs and samples, by tabs."""

    def begin(self) -> None:
        self.packer = BlockWriter()

    def names(self) -> tuple[list[str], list[str]]:
        if not hasattr(self, "told"):
            self.told = tuple(self.options[k].split("\t") if self.options[k] else [] for k in ("contigs", "samples"))
        return self.told

    def at_once(self) -> int:
        return HELD // max(1, len(self.names()[1]))

    def rows(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        held = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in Lines.columns]
        yield from zip(*held, batch_dosages(batch, len(self.names()[1])))

    def finish(self) -> bytes:
        return self.packer.flush()

    def packed_head(self, data: bytes) -> Iterable[bytes]:
        packer = BlockWriter()
        return (packer.put(data) + packer.flush(),)

    def tail(self) -> bytes:
        return LAST_BLOCK


class VcfWriter(Blocked):
    def head(self, parts: list[Part]) -> Iterable[bytes]:
        return self.packed_head(re.sub(r",IDX=\d+>", ">", Header.text(*self.names())).encode())

    def encode(self, batch: pa.RecordBatch) -> bytes:
        text = np.array(["0/0", "0/1", "1/1", "./."])
        lines = ("\t".join([c, str(p), v, r, a, ".", ".", ".", "GT", *text[d].tolist()]) + "\n" for c, p, v, r, a, d in self.rows(batch))
        return self.packer.put("".join(lines).encode())


class BcfWriter(Blocked):
    """A BCF with its CSI index; rows must come by contig (in the order of the option) and position."""

    def begin(self) -> None:
        super().begin()
        self.entries: list[np.ndarray] = []
        self.last = -1
        self.number = {c: k for k, c in enumerate(self.names()[0])}

    def head(self, parts: list[Part]) -> Iterable[bytes]:
        text = Header.text(*self.names()).encode() + b"\0"
        return self.packed_head(b"BCF\x02\x02" + struct.pack("<I", len(text)) + text)

    def encode(self, batch: pa.RecordBatch) -> bytes:
        cells = {c: batch.column(batch.schema.get_field_index(c)) for c in Lines.columns}
        contig = np.array([self.number[c] for c in cells["chrom"].to_pylist()], np.int64)
        begin, dosages = cells["pos"].to_numpy().astype(np.int64) - 1, batch_dosages(batch, len(self.names()[1]))
        texts = [cells[c].cast(pa.string()) for c in ("variant_id", "ref", "alt")]
        place = np.concatenate([[self.last], contig << 40 | begin])
        if (late := np.flatnonzero(place[1:] < place[:-1])).size:
            raise ValueError(f"{cells['chrom'][int(late[0])]}:{int(begin[late[0]]) + 1} comes after a later position")
        self.last = int(place[-1])
        # rows that follow each other with texts of equal lengths have records of one layout
        lengths = np.array([pc.binary_length(x).to_numpy() for x in texts])
        special = ~np.logical_and.reduce([pc.string_is_ascii(x).to_numpy(zero_copy_only=False) for x in texts]) | pc.match_substring(texts[2], ",").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((lengths[:, 1:] != lengths[:, :-1]).any(0) | special[1:] | special[:-1]) + 1
        out, sizes = [], np.zeros(len(contig), np.int64)
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(contig)]):
            own = [x.slice(a, z - a).to_pylist() for x in texts]
            data = record(int(contig[a]), int(begin[a]) + 1, own[0][0], own[1][0], own[2][0].split(","), dosages[a])
            sizes[a:z] = len(data)
            if z - a > 1:
                rows = np.tile(np.frombuffer(data, np.uint8), (z - a, 1))
                for k, values in ((8, contig), (12, begin)):
                    rows[:, k : k + 4] = values[a:z].astype("<i4")[:, None].view(np.uint8)
                at = 32
                for x, n in zip(own, lengths[:, a].tolist()):
                    at += len(typed_size(n, 7))
                    if n:
                        rows[:, at : at + n] = np.array(x, f"S{n}")[:, None].view(np.uint8)
                    at += n
                if dosages.shape[1]:
                    codes = GT_CODES[dosages[a:z]].reshape(z - a, -1).view(np.uint8)
                    rows[:, rows.shape[1] - codes.shape[1] :] = codes
                data = rows.tobytes()
            out.append(data)
        ends = np.array([max(1, len(x)) for x in texts[1].to_pylist()], np.int64)
        self.entries.append(np.column_stack([contig, begin, begin + ends, self.packer.length + np.cumsum(sizes) - sizes]))
        return self.packer.put(b"".join(out))

    def index(self) -> bytes:
        """(contig, begin, end, virtual offset, virtual end) of every record, within the part."""
        table = np.concatenate([np.zeros((0, 4), np.int64), *self.entries])
        at = self.packer.virtual(np.append(table[:, 3], self.packer.length))
        return np.column_stack([table[:, :3], at[:-1], at[1:]]).astype("<i8").tobytes()

    def beside(self, parts: list[Part], start: int) -> None:
        index, base, last = Index(), start, -1
        for p in parts:
            contig, begin, end, a, b = np.frombuffer(self.index_of(p), "<i8").reshape(-1, 5).T
            place = np.append(last, contig << 40 | begin)
            if (place[1:] < place[:-1]).any():
                raise ValueError("parts are not in the order of positions")
            last = int(place[-1])
            index.add_all(contig, begin, end, (base << 16) + a, (base << 16) + b)
            base += p.size
        store, inner = opened(f"{self.path}.csi")
        with store.open_output_stream(inner, compression=None) as out:
            out.write(index.to_bytes(len(self.names()[0])))


class BcfSource(DataSource):
    """Options: path (or paths, by tabs), region (contig or contig:from-to), splitBytes, cells (calls alone); for writing contigs and samples, by tabs.  Rows are those of the file; gt counts alleles that are not REF."""

    @classmethod
    def name(cls) -> str:
        return "bcf"

    def schema(self) -> str:
        return f"chrom string, pos long, variant_id string, ref string, alt string, {CELLS if self.options.get('cells') else GT}"

    def reader(self, schema) -> DataSourceReader:
        return PiecesReader(BcfReader, self.options) if self.options.get("paths") else BcfReader(self.options)

    def writer(self, schema, overwrite: bool) -> BcfWriter:
        return BcfWriter(self.options, overwrite)
