"""PLINK filesets as Spark sources and sinks.

``bed`` reads a variant-major BED file in byte ranges (a variant's bytes lie at 3 + ord x width) and decodes only the wanted samples;
``pgen`` reads a PLINK 2 file by ranges of variants, from its header's index of record types and lengths.  Both write one file from many
tasks (see ``storage``).  Genotypes are arrays of dosages in sample order, null where missing: of A1 in BED, of ALT in PGEN; or, as ``cells``,
lists of (sample, dosage) of the calls alone, so that a cohort of many no-calls costs what its calls do.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import readers
from .storage import SPLITS, Part, SingleFile, blocks, opened, piece_paths, read_at, size_of

#: Fixed values of the formats: the magic of a variant-major BED file and the dosages of its two-bit codes, lowest bits first (two A1 alleles, missing,
#: one, none); the magic of PGEN files, whose codes are dosages, 3 where missing.
BED_MAGIC, BED_DOSAGE = b"\x6c\x1b\x01", np.array([2, -1, 1, 0], np.int8)
PGEN_MAGIC, PGEN_FIXED, PGEN_VARIABLE = b"\x6c\x1b", 0x02, 0x10
PGEN_DOSAGE = np.array([0, 1, 2, -1], np.int8)
SHIFTS = np.array([0, 2, 4, 6], np.uint8)
#: A byte of four no-calls in BED.
NO_CALLS = 0x55
#: Variants of a block of the PGEN index, samples of a group of a difference list.
PGEN_BLOCK, GROUP = 1 << 16, 64
#: Bytes of a split; variants, and genotypes, that are decoded or encoded at once.
SPLIT, STEP, HELD = 32 << 20, 1_000, 4 << 20
GT, CELLS = "gt array<tinyint>", "cells array<struct<i:int,d:tinyint>>"


class Range(InputPartition):
    def __init__(self, begin: int, end: int):
        self.begin, self.end = begin, end


class InFile(InputPartition):
    """A range of one of several files, and the variants and samples of those before it."""

    def __init__(self, file: int, within: InputPartition, ord: int, sample: int):
        self.file, self.within, self.ord, self.sample = file, within, ord, sample


class PiecesReader(DataSourceReader):
    """The files of the option ``paths`` (by tabs), each by a reader of its own: variants and samples count on from file to file, so only cells can be told."""

    def __init__(self, of: type[DataSourceReader], options: dict):
        paths = options["paths"].split("\t")
        if not options.get("cells") or options.get("keep"):
            raise ValueError("several files are read as cells of all samples alone")
        counts = options.get("samples", "").split(",")
        self.readers = [of({**options, "path": p, "samples": counts[min(k, len(counts) - 1)], "splits": max(1, SPLITS // len(paths))}) for k, p in enumerate(paths)]

    def partitions(self) -> list[InFile]:
        out, ord, sample = [], 0, 0
        for k, r in enumerate(self.readers):
            out += [InFile(k, p, ord, sample) for p in r.partitions()]
            variants, samples = r.counts()
            ord, sample = ord + variants, sample + samples
        return out

    def read(self, partition: InFile) -> Iterator[pa.RecordBatch]:
        for b in self.readers[partition.file].read(partition.within):
            row, i, d = batch_cells(b)
            b = with_cells(b, cell_lists(b.num_rows, row, i + partition.sample, d))
            k = b.schema.get_field_index("ord")
            yield b if k < 0 else b.set_column(k, "ord", pa.array(b.column(k).to_numpy() + partition.ord))


def two_bit(data: bytes | np.ndarray, rows: int, samples: int, chosen: np.ndarray | None = None) -> np.ndarray:
    """rows x samples two-bit codes; of ``chosen`` samples alone if given."""
    raw = np.frombuffer(data, np.uint8).reshape(rows, (samples + 3) // 4)
    if chosen is not None:
        return raw[:, chosen // 4] >> SHIFTS[chosen % 4] & 3
    return (raw[:, :, None] >> SHIFTS & 3).reshape(rows, -1)[:, :samples]


def packed_codes(codes: np.ndarray) -> np.ndarray:
    """rows x bytes of rows x samples two-bit codes."""
    c = np.pad(codes, ((0, 0), (0, -codes.shape[1] % 4))).reshape(len(codes), -1, 4)
    return (c << SHIFTS).sum(2, dtype=np.uint8)


def genotype_batch(first: int, dosages: np.ndarray) -> pa.RecordBatch:
    """ord and gt of consecutive variants; -1 is a null."""
    n, samples = dosages.shape
    flat = pa.array(dosages.reshape(-1), pa.int8(), mask=dosages.reshape(-1) < 0)
    gt = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * samples, pa.int32()), flat)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + n), pa.int64()), gt], names=["ord", "gt"])


def cell_lists(rows: int, row: np.ndarray, i: np.ndarray, d: np.ndarray) -> pa.Array:
    """Lists of (i, d) of ``rows`` rows; calls come by row."""
    ends = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(i, pa.int32()), pa.array(d, pa.int8())], names=["i", "d"]))


def cell_batch(first: int, rows: int, row: np.ndarray, i: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    """ord and cells of consecutive variants."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + rows), pa.int64()), cell_lists(rows, row, i, d)], names=["ord", "cells"])


def called_batch(first: int, dosages: np.ndarray) -> pa.RecordBatch:
    row, i = np.nonzero(dosages >= 0)
    return cell_batch(first, len(dosages), row, i, dosages[row, i])


def batch_cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, sample, dosage) of a batch's cells."""
    got = batch.column(batch.schema.get_field_index("cells"))
    size, flat = got.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), got.flatten()
    return np.repeat(np.arange(len(got)), size), flat.field("i").to_numpy(), flat.field("d").to_numpy()


def with_cells(batch: pa.RecordBatch, cells: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index("cells"), "cells", cells)


def batch_dosages(batch: pa.RecordBatch, samples: int) -> np.ndarray:
    """rows x samples dosages of a batch with gt or cells, -1 where missing."""
    if "cells" not in batch.schema.names:
        return dosage_rows(batch.column(batch.schema.get_field_index("gt")), samples)
    out = np.full((batch.num_rows, samples), -1, np.int8)
    row, i, d = batch_cells(batch)
    out[row, i] = d
    return out


def dosage_rows(gt: pa.Array, samples: int) -> np.ndarray:
    """rows x samples dosages, -1 where null."""
    flat = gt.flatten()
    if len(flat) != len(gt) * samples:
        raise ValueError(f"a row does not have {samples} samples")
    return flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int8).reshape(len(gt), samples)


def wanted(options: dict) -> np.ndarray | None:
    """The places of the samples that are read, in the order given; none given is all."""
    return np.array([int(x) for x in options["keep"].split(",")], np.int64) if options.get("keep") else None


class BedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.samples, self.keep = options["path"], int(options["samples"]), wanted(options)
        self.split = int(options.get("splitbytes") or options.get("splitBytes") or SPLIT)
        self.width, self.cells, self.splits = (self.samples + 3) // 4, bool(options.get("cells")), int(options.get("splits") or SPLITS)

    def counts(self) -> tuple[int, int]:
        return (size_of(self.path) - len(BED_MAGIC)) // self.width, self.samples

    def partitions(self) -> list[Range]:
        size = size_of(self.path) - len(BED_MAGIC)
        if read_at(self.path, 0, 3) != BED_MAGIC:
            raise ValueError(f"{self.path} is not a variant-major BED file")
        if size % self.width:
            raise ValueError(f"{self.path} is no whole number of rows of {self.samples} samples")
        return [Range(a, b) for a, b in blocks(size // self.width, max(self.split, -(-size // self.splits)) // self.width)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, inner = opened(self.path)
        step = max(1, min(STEP, HELD // self.samples))
        with store.open_input_file(inner) as f:
            for a in range(partition.begin, partition.end, step):
                n = min(step, partition.end - a)
                data = f.read_at(n * self.width, len(BED_MAGIC) + a * self.width)
                if self.cells and self.keep is None:
                    yield cell_batch(a, n, *self.calls(data, n))
                else:
                    yield (called_batch if self.cells else genotype_batch)(a, BED_DOSAGE[two_bit(data, n, self.samples, self.keep)])

    def calls(self, data: bytes, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, sample, dosage) of the calls: bytes of no-calls alone are not unpacked."""
        raw = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(raw != NO_CALLS)
        dosage = BED_DOSAGE[raw[at][:, None] >> SHIFTS & 3].reshape(-1)
        row, i = np.repeat(at // self.width, 4), (at % self.width * 4)[:, None] + np.arange(4)
        told = (dosage >= 0) & (i.reshape(-1) < self.samples)
        return row[told], i.reshape(-1)[told], dosage[told]


class BedWriter(SingleFile):
    CODES = np.array([3, 2, 0, 1], np.uint8)  # of dosages 0, 1, 2 and -1

    def head(self, parts: list[Part]) -> Iterable[bytes]:
        return (BED_MAGIC,)

    def at_once(self) -> int:
        return HELD // max(1, int(self.options["samples"]))

    def encode(self, batch: pa.RecordBatch) -> bytes:
        n = int(self.options["samples"])
        if "cells" not in batch.schema.names:
            return packed_codes(self.CODES[batch_dosages(batch, n)]).tobytes()
        out = np.full((batch.num_rows, (n + 3) // 4), NO_CALLS, np.uint8)
        if n % 4:
            out[:, -1] &= (1 << 2 * (n % 4)) - 1
        row, i, d = batch_cells(batch)
        # a no-call's code turns into the call's
        np.bitwise_xor.at(out, (row, i // 4), (self.CODES[d] ^ self.CODES[-1]) << SHIFTS[i % 4])
        return out.tobytes()


class BedSource(DataSource):
    """Options: path, samples (their number), keep (places of the samples to read, by commas), splitBytes, cells (calls alone); or paths (by tabs), with samples by commas."""

    @classmethod
    def name(cls) -> str:
        return "bed"

    def schema(self) -> str:
        return f"ord long, {CELLS if self.options.get('cells') else GT}"

    def reader(self, schema) -> DataSourceReader:
        return PiecesReader(BedReader, self.options) if self.options.get("paths") else BedReader(self.options)

    def writer(self, schema, overwrite: bool) -> BedWriter:
        return BedWriter(self.options, overwrite)


class PgenHeader:
    """What the head of a PGEN file tells: counts, and where types and lengths of a block's records are."""

    def __init__(self, path: str):
        data = read_at(path, 0, 12)
        if data[:2] != PGEN_MAGIC or data[2] not in (PGEN_FIXED, PGEN_VARIABLE):
            raise ValueError(f"{path} is not a PGEN file of fixed or variable width")
        self.mode, (self.variants, self.samples) = data[2], struct.unpack_from("<II", data, 3)
        control = data[11]
        # low four bits: bytes of a length, and whether types take four or eight bits; then bytes of allele counts; then whether REF is marked provisional
        if self.mode == PGEN_VARIABLE and control & 15 > 7:
            raise ValueError(f"{path}: records of kind {control & 15} are not read")
        self.length_bytes, self.narrow, self.allele_bytes, self.flagged = (control & 3) + 1, not control & 4, control >> 4 & 3, control >> 6 == 3
        self.blocks = -(-self.variants // PGEN_BLOCK)

    def type_bytes(self, n: int) -> int:
        return -(-n // 2) if self.narrow else n

    def index_size(self, n: int) -> int:
        return self.type_bytes(n) + n * self.length_bytes + n * self.allele_bytes + (-(-n // 8) if self.flagged else 0)

    def index(self, path: str, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Types and file offsets (one more than types) of a block's records."""
        n = min(PGEN_BLOCK, self.variants - block * PGEN_BLOCK)
        start = struct.unpack("<Q", read_at(path, 12 + 8 * block, 8))[0]
        data = read_at(path, 12 + 8 * self.blocks + block * self.index_size(PGEN_BLOCK), self.index_size(n))
        raw, t = np.frombuffer(data, np.uint8), self.type_bytes(n)
        types = (raw[:t, None] >> np.array([0, 4], np.uint8) & 15).reshape(-1)[:n] if self.narrow else raw[:t]
        lengths = raw[t : t + n * self.length_bytes].reshape(n, self.length_bytes).astype(np.int64) @ (256 ** np.arange(self.length_bytes))
        return types, start + np.concatenate([[0], np.cumsum(lengths)])


def varint(data: bytes, at: int) -> tuple[int, int]:
    """A number of seven bits a byte, low bits first, and where it ends."""
    n = shift = 0
    while True:
        n |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return n, at


def to_varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def id_bytes(samples: int) -> int:
    """Bytes of a sample's number."""
    return max(1, ((samples - 1).bit_length() + 7) // 8)


def difference_list(data: bytes, at: int, samples: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(samples, codes, end): the number of entries; the first sample of each group of 64; the sizes of the groups' steps; the codes, two bits
    each; the steps from sample to sample within each group."""
    n, at = varint(data, at)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8), at
    groups, width = -(-n // GROUP), id_bytes(samples)
    first = np.frombuffer(data, np.uint8, groups * width, at).reshape(groups, width).astype(np.int64) @ (256 ** np.arange(width))
    at += groups * width + groups - 1
    codes = two_bit(data[at : at + (n + 3) // 4], 1, n)[0]
    at += (n + 3) // 4
    found = []
    for g in range(groups):
        sample = int(first[g])
        found.append(sample)
        for _ in range(min(GROUP, n - g * GROUP) - 1):
            step, at = varint(data, at)
            sample += step
            found.append(sample)
    return np.array(found, np.int64), codes, at


def to_difference_list(at: np.ndarray, codes: np.ndarray, samples: int) -> bytes:
    width, heads, sizes, steps = id_bytes(samples), b"", [], b""
    for g in range(0, len(at), GROUP):
        heads += int(at[g]).to_bytes(width, "little")
        own = b"".join(to_varint(int(s)) for s in np.diff(at[g : g + GROUP]))
        sizes.append(len(own) - (GROUP - 1))
        steps += own
    # the size of every group but the last, whose end is the record's
    return to_varint(len(at)) + (heads + bytes(sizes[:-1]) + packed_codes(codes[None, :]).tobytes() + steps if len(at) else b"")


def record_codes(kind: int, data: bytes, samples: int, base: np.ndarray | None) -> np.ndarray:
    """The codes of a record; tracks of phase, dosage or further alleles behind them are not needed for hard calls.

    Kinds 0: two bits a sample; 1: one bit a sample, which tells two codes apart, and a difference list; 2 and 3: a difference list to the record
    ``base``, 3 with the alleles exchanged; 4, 6 and 7: all have the code 0, 2 or 3 but those in a difference list."""
    kind &= 7
    if kind == 0:
        return two_bit(data[: (samples + 3) // 4], 1, samples)[0]
    if kind == 1:
        end = 1 + (samples + 7) // 8
        bits = np.unpackbits(np.frombuffer(data[1:end], np.uint8), bitorder="little")[:samples]
        out = (data[0] // 4 + bits * (data[0] & 3)).astype(np.uint8)
    elif kind in (2, 3):
        if base is None:
            raise ValueError("a record refers to one before it, and there is none in its block")
        end, out = 0, base.copy()
    elif kind == 5:
        raise ValueError("records of kind 5 are reserved")
    else:
        end, out = 0, np.full(samples, kind & 3, np.uint8)
    at, codes, _ = difference_list(data, end, samples)
    out[at] = codes
    return np.where(out == 3, out, 2 - out).astype(np.uint8) if kind == 3 else out


def to_record(codes: np.ndarray) -> tuple[int, bytes]:
    """The shorter of two bits a sample and a difference list to the most frequent of 0, 2 and 3."""
    width, count = (len(codes) + 3) // 4, np.bincount(codes, minlength=4)
    common = max((0, 2, 3), key=lambda c: count[c])
    rare = len(codes) - int(count[common])
    if rare * 5 < width * 4:
        at = np.flatnonzero(codes != common)
        short = to_difference_list(at, codes[at], len(codes))
        if len(short) < width:
            return 4 + common, short
    return 0, packed_codes(codes[None, :]).tobytes()


def packed_records(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Kinds, lengths and bytes of ``to_record`` of rows x samples codes: rows of one kind with as many samples in their list together."""
    rows, samples = codes.shape
    width, number = (samples + 3) // 4, id_bytes(samples)
    count = np.stack([(codes == c).sum(1) for c in (0, 2, 3)])
    common = np.array([0, 2, 3])[count.argmax(0)]
    rare = samples - count.max(0)
    kinds, lengths, made = np.zeros(rows, np.int64), np.full(rows, width, np.int64), []
    short = rare * 5 < width * 4
    for key in np.unique(common[short] << 32 | rare[short]).tolist():
        c, r = key >> 32, key & 0xFFFFFFFF
        now = np.flatnonzero(short & (common == c) & (rare == r))
        size = 1 + (number + (r + 3) // 4 + r - 1 if r else 0)
        at = np.nonzero(codes[now] != c)[1].reshape(len(now), r)
        steps = np.diff(at, axis=1) if r else at
        alike = (steps < 128).all(1) & (r < GROUP)
        for k in now[~alike].tolist():
            kinds[k], data = to_record(codes[k])
            lengths[k] = len(data)
            made.append((np.array([k]), np.frombuffer(data, np.uint8)[None, :]))
        now, at, steps = now[alike], at[alike], steps[alike]
        if size < width and len(now):
            parts = [np.full((len(now), 1), r)]
            if r:
                parts += [at[:, :1] >> (8 * np.arange(number)) & 255, packed_codes(codes[now[:, None], at]), steps]
            kinds[now], lengths[now] = 4 + c, size
            made.append((now, np.concatenate([x.astype(np.uint8) for x in parts], 1)))
    plain = np.ones(rows, bool)
    for now, _ in made:
        plain[now] = False
    if plain.any():
        made.append((np.flatnonzero(plain), packed_codes(codes[plain])))
    begin, out = np.cumsum(lengths) - lengths, np.empty(int(lengths.sum()), np.uint8)
    for now, data in made:
        out[begin[now][:, None] + np.arange(data.shape[1])] = data
    return kinds, lengths, out.tobytes()


def record_rows(data: np.ndarray, types: np.ndarray, ends: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """rows x samples codes, and which rows ``record_codes`` must read: all but two bits a sample, and lists of one group whose steps take a byte each, with no track behind."""
    width, number, size = (samples + 3) // 4, id_bytes(samples), np.diff(ends)
    out, left = np.empty((len(types), samples), np.uint8), np.ones(len(types), bool)
    entries = np.where(size > 0, data[np.minimum(ends[:-1], max(0, len(data) - 1))], 0).astype(np.int64) if len(data) else np.zeros(len(types), np.int64)
    listed = (types < 8) & (types >= 4) & (types != 5) & (entries < GROUP) & (size == np.where(entries > 0, number + (entries + 3) // 4 + entries, 1))
    for key in np.unique(types[listed] << 32 | entries[listed]).tolist():
        kind, n = key >> 32, key & 0xFFFFFFFF
        now = np.flatnonzero(listed & (types == kind) & (entries == n))
        out[now] = kind & 3
        if n:
            rows = data[ends[now][:, None] + np.arange(number + (n + 3) // 4 + n)]
            first = rows[:, 1 : 1 + number].astype(np.int64) @ (256 ** np.arange(number))
            codes, steps = two_bit(np.ascontiguousarray(rows[:, 1 + number : 1 + number + (n + 3) // 4]), len(now), n), rows[:, 1 + number + (n + 3) // 4 :].astype(np.int64)
            out[now[:, None], np.cumsum(np.column_stack([first, steps]), 1)] = codes
        left[now] = False
    now = np.flatnonzero((types == 0) & (size == width))
    if len(now) and width:
        out[now] = two_bit(np.ascontiguousarray(data[ends[now][:, None] + np.arange(width)]), len(now), samples)
        left[now] = False
    return out, left


class PgenReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.keep, self.cells = options["path"], wanted(options), bool(options.get("cells"))
        self.split, self.splits = int(options.get("splitvariants") or options.get("splitVariants") or PGEN_BLOCK), int(options.get("splits") or SPLITS)

    def counts(self) -> tuple[int, int]:
        head = PgenHeader(self.path)
        return head.variants, head.samples

    def partitions(self) -> list[Range]:
        variants = PgenHeader(self.path).variants
        # a range stays within a block of the index
        return [Range(a + b, a + c) for a, end in blocks(variants, PGEN_BLOCK) for b, c in blocks(end - a, max(self.split, -(-variants // self.splits)))]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        head = PgenHeader(self.path)
        store, inner = opened(self.path)
        with store.open_input_file(inner) as f:
            step = max(1, min(STEP, HELD // max(1, head.samples)))
            for a in range(partition.begin, partition.end, step):
                n = min(step, partition.end - a)
                codes = self.fixed(f, head, a, n) if head.mode == PGEN_FIXED else self.variable(f, head, a, n, partition)
                yield (called_batch if self.cells else genotype_batch)(a, PGEN_DOSAGE[codes if self.keep is None else codes[:, self.keep]])

    def fixed(self, f, head: PgenHeader, first: int, n: int) -> np.ndarray:
        width = (head.samples + 3) // 4
        return two_bit(f.read_at(n * width, 12 + first * width), n, head.samples)

    def variable(self, f, head: PgenHeader, first: int, n: int, partition: Range) -> np.ndarray:
        block, at = divmod(first, PGEN_BLOCK)
        if first == partition.begin:
            self.types, self.ends = head.index(self.path, block)
            self.base = None
            # a record that is told by its differences needs the last one before the range that is not
            own = np.flatnonzero((self.types[:at] & 6) != 2)
            if at < len(self.types) and len(own) and self.types[at] & 6 == 2:
                k = int(own[-1])
                self.base = record_codes(int(self.types[k]), f.read_at(int(self.ends[k + 1] - self.ends[k]), int(self.ends[k])), head.samples, None)
        data, start = f.read_at(int(self.ends[at + n] - self.ends[at]), int(self.ends[at])), int(self.ends[at])
        types, ends = self.types[at : at + n].astype(np.int64), self.ends[at : at + n + 1].astype(np.int64) - start
        out, left = record_rows(np.frombuffer(data, np.uint8), types, ends, head.samples)
        differ = types & 6 == 2
        # those that are told by their differences come last, when the records that they refer to are known
        for k in [*np.flatnonzero(left & ~differ).tolist(), *np.flatnonzero(differ).tolist()]:
            own = np.flatnonzero(~differ[:k])
            base = out[own[-1]] if len(own) else self.base
            out[k] = record_codes(int(types[k]), data[int(ends[k]) : int(ends[k + 1])], head.samples, base)
        if not differ.all():
            self.base = out[np.flatnonzero(~differ)[-1]].copy()
        return out


class PgenWriter(SingleFile):
    """Records of variable width, four bits a type; the index of a part is kept beside it until the commit."""

    CODES = np.array([0, 1, 2, 3], np.uint8)

    def __init__(self, options: dict, overwrite: bool):
        super().__init__(options, overwrite)
        self.samples = int(options["samples"])
        self.length_bytes = max(1, (((self.samples + 3) // 4).bit_length() + 7) // 8)

    def begin(self) -> None:
        self.kinds, self.lengths = bytearray(), []

    def index(self) -> bytes:
        return np.array(self.lengths, "<u4").tobytes() + bytes(self.kinds)

    def at_once(self) -> int:
        return HELD // max(1, self.samples)

    def encode(self, batch: pa.RecordBatch) -> bytes:
        kinds, lengths, data = packed_records(self.CODES[batch_dosages(batch, self.samples)])
        self.kinds += kinds.astype(np.uint8).tobytes()
        self.lengths += lengths.tolist()
        return data

    def head(self, parts: list[Part]) -> Iterable[bytes]:
        kinds, lengths = [], []
        for p in parts:
            n, data = p.last - p.first + 1, self.index_of(p)
            lengths.append(np.frombuffer(data, "<u4", n).astype(np.int64))
            kinds.append(np.frombuffer(data, np.uint8, n, 4 * n))
        kinds, lengths = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (kinds, lengths))
        # bits 6 and 7: no REF is provisional
        yield PGEN_MAGIC + bytes([PGEN_VARIABLE]) + struct.pack("<IIB", len(kinds), self.samples, self.length_bytes - 1 | 1 << 6)
        index = []
        for a, b in blocks(len(kinds), PGEN_BLOCK):
            four = np.pad(kinds[a:b].astype(np.uint8), (0, (b - a) % 2)).reshape(-1, 2)
            own = lengths[a:b, None] >> (8 * np.arange(self.length_bytes)) & 255
            index.append((four[:, 0] | four[:, 1] << 4).astype(np.uint8).tobytes() + own.astype(np.uint8).tobytes())
        start = 12 + 8 * len(index) + sum(map(len, index))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        yield (start + ends[:: PGEN_BLOCK][: len(index)]).astype("<u8").tobytes()
        yield from index


class PgenSource(DataSource):
    """Options: path, samples (their number, for writing), keep (places of the samples to read, by commas), splitVariants, cells (calls alone); or paths, by tabs."""

    @classmethod
    def name(cls) -> str:
        return "pgen"

    def schema(self) -> str:
        return f"ord long, {CELLS if self.options.get('cells') else GT}"

    def reader(self, schema) -> DataSourceReader:
        return PiecesReader(PgenReader, self.options) if self.options.get("paths") else PgenReader(self.options)

    def writer(self, schema, overwrite: bool) -> PgenWriter:
        return PgenWriter(self.options, overwrite)


def registered(spark: SparkSession) -> SparkSession:
    for source in (BedSource, PgenSource):
        spark.dataSource.register(source)
    return spark


def long_calls(genotypes: DataFrame, sites: DataFrame, people: DataFrame) -> DataFrame:
    """One row a call of genotypes(ord, gt or cells), with the columns of ``sites(ord, ...)`` and the sample_id of ``people(i, sample_id)``."""
    each = F.inline("cells") if "cells" in genotypes.columns else F.posexplode("gt")
    cells = genotypes.join(sites, "ord").select(*sites.columns, each.alias("i", "dosage"))
    return cells.join(people.select("i", "sample_id"), "i").select(*[c for c in sites.columns if c != "ord"], "sample_id", F.col("dosage").cast("int").alias("dosage"))


def kept_people(people: DataFrame, keep: list[str] | None) -> tuple[DataFrame, str]:
    """``people(i, sample_id)`` and the option ``keep`` for the wanted samples, whose places are then their own."""
    if keep is None:
        return people, ""
    rows = people.filter(F.col("sample_id").isin(keep)).orderBy("i").collect()
    if len(rows) != len(set(keep)):
        raise ValueError(f"samples that are not in the file: {sorted(set(keep) - {r.sample_id for r in rows})}")
    return people.sparkSession.createDataFrame([(k, r.sample_id) for k, r in enumerate(rows)], "i int, sample_id string"), ",".join(str(r.i) for r in rows)


def bed_cells(spark: SparkSession, prefix: str, split_bytes: int = SPLIT) -> DataFrame:
    """ord and cells of all pieces of a fileset in pieces; both count on from piece to piece."""
    fams = spark.read.text(f"{prefix}.*.fam").groupBy(F.input_file_name().alias("file")).count().orderBy("file").collect()
    source = registered(spark).read.format("bed").option("paths", "\t".join(piece_paths(f"{prefix}.bed"))).option("samples", ",".join(str(r["count"]) for r in fams))
    return source.option("splitBytes", split_bytes).option("cells", "1").load()


def called_counts(spark: SparkSession, prefix: str, pieces: bool = False) -> DataFrame:
    """ord, called and obs_ct of the variants of <prefix>.bed, or of its pieces: calls, and samples of the cohort; no row is made for a call."""
    n = readers.fam(spark, f"{prefix}.*.fam" if pieces else f"{prefix}.fam").count()
    bed = bed_cells(spark, prefix) if pieces else registered(spark).read.format("bed").option("samples", n).option("cells", "1").load(f"{prefix}.bed")
    return bed.select("ord", F.size("cells").cast("long").alias("called"), F.lit(n).cast("long").alias("obs_ct"))


def read_plink1(spark: SparkSession, prefix: str, keep: list[str] | None = None, split_bytes: int = SPLIT, called: bool = False) -> DataFrame:
    """Long calls of <prefix>.bed, .bim and .fam: chrom, variant_id, pos, ref, alt, sample_id, dosage of ALT (A1).

    Only the bytes of the samples in ``keep`` are decoded; with ``called`` no row is made for a no-call."""
    everyone = readers.fam(spark, f"{prefix}.fam").select("i", F.col("iid").alias("sample_id"))
    n = everyone.count()
    people, places = kept_people(everyone, keep)
    bed = registered(spark).read.format("bed").option("samples", n).option("keep", places).option("splitBytes", split_bytes).option("cells", "1" if called else "").load(f"{prefix}.bed")
    return long_calls(bed, readers.bim(spark, f"{prefix}.bim"), people)


def read_pieces1(spark: SparkSession, prefix: str, split_bytes: int = SPLIT) -> DataFrame:
    """``read_plink1`` of a fileset in pieces, without rows for no-calls."""
    people = readers.fam(spark, f"{prefix}.*.fam").select("i", F.col("iid").alias("sample_id"))
    return long_calls(bed_cells(spark, prefix, split_bytes), readers.bim(spark, f"{prefix}.*.bim"), people)


def read_pieces2(spark: SparkSession, prefix: str, split_variants: int = PGEN_BLOCK) -> DataFrame:
    """``read_plink2`` of a fileset in pieces, without rows for no-calls."""
    people = readers.psam(spark, f"{prefix}.*.psam").select(F.col("ord").cast("int").alias("i"), F.col("iid").alias("sample_id"))
    source = registered(spark).read.format("pgen").option("paths", "\t".join(piece_paths(f"{prefix}.pgen")))
    pgen = source.option("splitVariants", split_variants).option("cells", "1").load()
    return long_calls(pgen, readers.pvar(spark, f"{prefix}.*.pvar"), people)


def read_plink2(spark: SparkSession, prefix: str, keep: list[str] | None = None, split_variants: int = PGEN_BLOCK, called: bool = False) -> DataFrame:
    """Long calls of <prefix>.pgen, .pvar and .psam, as ``read_plink1``."""
    people, places = kept_people(readers.psam(spark, f"{prefix}.psam").select(F.col("ord").cast("int").alias("i"), F.col("iid").alias("sample_id")), keep)
    pgen = registered(spark).read.format("pgen").option("keep", places).option("splitVariants", split_variants).option("cells", "1" if called else "").load(f"{prefix}.pgen")
    return long_calls(pgen, readers.pvar(spark, f"{prefix}.pvar"), people)
