"""Repeated lines by a sharded minimal perfect hash.

The distinct 128-bit hashes of long lines are counted over all documents; those found often enough are dealt to
shards, and each shard stores them as a minimal perfect hash (levels of packed bits with sampled ranks, about half a byte a
line) that indexes arrays of 48-bit fingerprints, counts and owners.  A line that is not frequent is taken for one with
probability 2^-48.  Documents probe the arrays instead of joining lines: where all shards together are
within ``broadcast_bytes`` (their size is measured first) every task holds them; beyond that the line hashes of the
documents are routed to the shards, salted so that a line that is everywhere spreads over tasks, and only the hits
come back.

Defined results: null or empty text is one empty line; keys are stripped of space and U+0009 to U+000D and A-Z is
lower-cased; a line repeated within a document counts its document once, and all its copies go or stay together;
rows with one doc_id are one document, whatever their texts, and each is answered; a null doc_id counts for no document,
never owns a line and loses its frequent ones; an empty table gives an empty result; further columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, keyed, map_texts, slices

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS, BROADCAST_BYTES, ROUTED_ROWS = 200_000, 64 << 20, 500_000


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser with a seed."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


class RankedBits:
    """A bit array, packed, with the number of set bits before any place: per 512 bits in full, per 64 bits within these."""

    def __init__(self, bits: np.ndarray):
        self.words = np.packbits(np.pad(bits, (0, -len(bits) % 512)), bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64).reshape(-1, 8)
        self.before = np.concatenate([[0], np.cumsum(ones.sum(1))[:-1]]).astype(np.int64)
        self.within = (np.cumsum(ones, 1) - ones).astype(np.uint16).reshape(-1)

    def look(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the bit is set at each place, and how many are set before it."""
        word, shift = self.words[at >> 6], (at & 63).astype(np.uint64)
        below = np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1)))
        return (word >> shift & np.uint64(1)).astype(bool), self.before[at >> 9] + self.within[at >> 6] + below


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: at each level the keys that land alone are placed."""

    def __init__(self, keys: np.ndarray, gamma: float = 1.5):
        self.levels: list[tuple[int, int, RankedBits]] = []
        base, rest = 0, keys.astype(np.uint64)
        while len(rest):
            size = max(64, int(gamma * len(rest)))
            at = (mix(rest, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((size, base, RankedBits(alone)))
            base += int(alone.sum())
            rest = rest[~alone[at]]
        self.size = base

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or -1 where no level places it; a key that was not built in may get any index."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, base, bits) in enumerate(self.levels):
            hit, rank = bits.look((mix(keys[left], level) % np.uint64(size)).astype(np.int64))
            out[left[hit]] = base + rank[hit]
            left = left[~hit]
        return out


class Shard:
    """Frequent lines: perfect hash on the first half of the line hash, fingerprint on the second."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, count: np.ndarray, owner: np.ndarray):
        # equal first halves of different lines are told apart by a short list
        _, first = np.unique(hi, return_index=True)
        rest = np.setdiff1d(np.arange(len(hi)), first)
        self.twins = {(int(hi[i]), int(lo[i])): (int(count[i]), int(owner[i])) for i in rest}
        self.hash = PerfectHash(hi[first].view(np.uint64))
        at = self.hash.index(hi[first].view(np.uint64))
        self.low, self.high, self.count, self.owner = (np.empty(len(first), t) for t in (np.uint32, np.uint16, np.uint32, np.int64))
        self.low[at], self.high[at] = fingerprint(lo[first])
        self.count[at], self.owner[at] = np.minimum(count[first], 2**32 - 1), owner[first]

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(frequent or not, owner) of each line hash."""
        if not len(self.owner):
            return np.zeros(len(hi), bool), np.zeros(len(hi), np.int64)
        at = self.hash.index(hi.view(np.uint64))
        low, high = fingerprint(lo)
        found = (at >= 0) & (self.low[at] == low) & (self.high[at] == high)
        owner = self.owner[at]
        if self.twins:
            for i, key in enumerate(zip(hi.tolist(), lo.tolist())):
                if key in self.twins:
                    found[i], owner[i] = True, self.twins[key][1]
        return found, owner


def fingerprint(lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower 48 bits of the second half of line hashes."""
    bits = lo.view(np.uint64)
    return bits.astype(np.uint32), (bits >> np.uint64(32)).astype(np.uint16)


def line_hash(line: str, min_chars: int) -> tuple[int, int] | None:
    key = line.strip(SPACES)
    if len(key) < min_chars:
        return None
    d = xxhash.xxh3_128_digest(key.encode("utf-8").lower())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """file, at, doc_id, hi, lo of the distinct long lines of each row."""

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        out: list = [[], [], [], [], []]
        for (i, file, at), t in zip(ids, texts):
            keys = {h for x in t.split("\n") if len(x) >= min_chars and (h := line_hash(x, min_chars))}
            for column, values in zip(out, ([file] * len(keys), [at] * len(keys), [i] * len(keys), [k[0] for k in keys], [k[1] for k in keys])):
                column += values
        return dict(zip(("file", "at", "doc_id", "hi", "lo"), out))

    return map_texts(docs, each, "file long, at long, doc_id long, hi long, lo long", "file", "at")


def build_shards(frequent: DataFrame, n: int) -> DataFrame:
    """shard and blob (a pickled Shard) of the frequent lines (hi, lo, n_docs, owner)."""

    def build(rows: pa.Table) -> pa.Table:
        hi, lo, count, owner = (rows.column(c).to_numpy() for c in ("hi", "lo", "n_docs", "owner"))
        return pa.table({"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "blob": pa.array([pickle.dumps(Shard(hi, lo, count, owner))], pa.binary())})

    return frequent.withColumn("shard", F.pmod("hi", F.lit(n)).cast("int")).groupBy("shard").applyInArrow(build, "shard int, blob binary")


def drop_lines(text: str, min_chars: int, gone: set) -> tuple[int, int, str]:
    """n_lines, n_dropped, and the text of the lines that stay."""
    lines = text.split("\n")
    kept = [x for x in lines if not (len(x) >= min_chars and line_hash(x, min_chars) in gone)] if gone else lines
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def result(ids: list, done: list[tuple[int, int, str]]) -> dict[str, list]:
    return {"doc_id": ids, "n_lines": [x[0] for x in done], "n_dropped": [x[1] for x in done], "text": [x[2] for x in done]}


OUT = "doc_id long, n_lines long, n_dropped long, text string"


def probed(docs: DataFrame, blobs: list[bytes], min_chars: int) -> DataFrame:
    shards = docs.sparkSession.sparkContext.broadcast(blobs)
    held: dict[int, list[Shard]] = {}

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        if 0 not in held:
            held[0] = [pickle.loads(b) for b in shards.value]
        table = held[0]
        split = [t.split("\n") for t in texts]
        hashes = [[line_hash(x, min_chars) if len(x) >= min_chars else None for x in lines] for lines in split]
        flat = [(h[0], h[1], i) for i, per in zip(ids, hashes) for h in per if h]
        hi, lo = np.array([f[0] for f in flat], np.int64), np.array([f[1] for f in flat], np.int64)
        lost = np.zeros(len(flat), bool)
        of = hi % len(table) if table else hi
        for s, shard in enumerate(table):
            at = np.flatnonzero(of == s)
            found, owner = shard.probe(hi[at], lo[at])
            lost[at] = found & np.array([flat[k][2] != o for k, o in zip(at.tolist(), owner.tolist())], bool)
        go, done = iter(lost.tolist()), []
        for lines, per in zip(split, hashes):
            kept = [x for x, h in zip(lines, per) if not (h and next(go))]
            done.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
        return result(ids, done)

    return map_texts(docs, each, OUT)


def routed(docs: DataFrame, lines: DataFrame, shards: DataFrame, n: int, min_chars: int) -> DataFrame:
    """The hashes ``lines(file, at, doc_id, hi, lo)`` go to the shards; the hits come back to their rows, which are joined once."""
    salts = max(1, math.ceil(lines.count() / (ROUTED_ROWS * n)))
    asked = lines.withColumn("shard", F.pmod("hi", F.lit(n)).cast("int")).withColumn("salt", F.pmod(F.xxhash64("file", "at", "lo"), F.lit(salts)).cast("int"))
    held = shards.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            found, owner = pickle.loads(right.column("blob")[0].as_py()).probe(left.column("hi").to_numpy(), left.column("lo").to_numpy())
            ids = left.column("doc_id").to_pylist()
            left = left.filter(pa.array([bool(f) and i != o for f, i, o in zip(found, ids, owner.tolist())], pa.bool_()))
        else:
            left = left.slice(0, 0)
        return left.select(["file", "at", "hi", "lo"])

    hits = asked.groupBy("shard", "salt").cogroup(held.groupBy("shard", "salt")).applyInArrow(probe, "file long, at long, hi long, lo long")
    gone = hits.groupBy("file", "at").agg(F.collect_set(F.struct("hi", "lo")).alias("gone"))
    both = docs.join(gone, ["file", "at"], "left").select("doc_id", "gone", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            done = [drop_lines(t, min_chars, {(x["hi"], x["lo"]) for x in gone or ()}) for (_, gone), t in zip(ids, texts)]
            yield pa.RecordBatch.from_pydict(result([i for i, _ in ids], done), schema=pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())]))

    return both.mapInArrow(run, OUT)


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay) of every row of ``docs(doc_id, text)``."""
    docs = keyed(docs.select("doc_id", "text"))
    # narrow rows, written: the texts are cut into lines once for counting, however the probe goes
    lines = cut(line_hashes(docs, min_chars))
    frequent = cut(lines.groupBy("hi", "lo").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("owner")).filter(F.col("n_docs") >= min_docs))
    n = max(1, math.ceil(frequent.count() / SHARD_KEYS))
    shards = cut(build_shards(frequent, n))
    size = shards.agg(F.coalesce(F.sum(F.length("blob")), F.lit(0)).alias("b")).collect()[0].b
    if size > broadcast_bytes:
        return routed(docs, lines, shards, n, min_chars)
    blobs = {r.shard: r.blob for r in shards.collect()}
    empty = pickle.dumps(Shard(*(np.zeros(0, np.int64) for _ in range(4))))
    return probed(docs, [blobs.get(i, empty) for i in range(n)], min_chars)


def line_digest(done: DataFrame) -> DataFrame:
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
j AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.owner AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
