"""Near-duplicates by ProbMinHash, banding and verification.

A document is its set of five-word shingles (words: A-Z lower-cased, cut at white space; a shorter document is one
shingle), weighted by 1 + ln(occurrences).  In ProbMinHash each shingle is a Poisson process of arrivals, whose rate is
its weight; every arrival goes to a random register, a register keeps the first shingle that reaches it, and a shingle
stops as soon as its next arrival is later than all registers.  Two signatures agree in a register with the probability
Jaccard similarity of the documents, which falls below that of their sets where shingles repeat; so each document has a
second signature of weight 1 throughout, whose registers agree with the Jaccard similarity of the sets.  Registers are
banded; documents that share a band of either signature are candidates.

Documents with the same shingle set are one set from the start.  Band buckets give one edge per member (to the
bucket's smallest id), never all pairs, and the components of these edges are verified on whole shingle sets: sets of
0.8 Jaccard similarity or more are linked.  A component is checked in tasks of bounded size: blocks of it are clustered,
the classes' representatives are clustered again until one block holds them, and then the members of every bucket that
still spans classes are checked against those of the other classes, in blocks; so candidates are never capped and no
link between candidates is lost.  Only sets with candidates are ever shuffled.

Rows are known by the key of their place in the files; the table of signatures numbers them when it is written, and sets are told
apart by the number of their first row, never by doc_id.  The bands of a set are those of that row.

Defined results: null or empty texts have no shingle, are never linked and each stays; copies (also repeated rows) share
a class; the smallest doc_id names its class (null if the class has none) and exactly one row of a class stays, one with
that doc_id (of several the first in the files); different texts with one doc_id are separate documents; an empty table
gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, keyed, map_texts, slices

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 4
#: Sets and shingles of one verification task.
BLOCK_SETS, BLOCK_SHINGLES = 1_000, 2_000_000
WORD_MEMO = 1_000_000


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORD_MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


MEMO = WordHash()


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser with a seed."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1B873593CC9E2D51) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, n: int = SHINGLE) -> np.ndarray:
    """The hash of the shingle at every place of a text."""
    tokens = text.encode("utf-8").lower().split()
    words = np.fromiter(map(MEMO.__getitem__, tokens), np.uint64, len(tokens))
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9FB21C651E98DF25) + words[k : len(words) - n + 1 + k]
    return mix(h, n)


def prob_minhash(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """docs x registers signatures of weighted shingles: row i belongs to document doc[i]."""
    first, sig = np.full(docs * registers, np.inf), np.zeros(docs * registers, np.uint64)
    time, turn = np.zeros(len(doc)), 0
    while len(doc):
        r = mix(shingle, 2 * turn + 1)
        time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weight
        at = doc * registers + (mix(shingle, 2 * turn + 2) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        sig[at[won]] = shingle[won]
        alive = time < first.reshape(docs, registers).max(1)[doc]
        doc, shingle, weight, time, turn = doc[alive], shingle[alive], weight[alive], time[alive], turn + 1
    return sig.reshape(docs, registers)


def band_hashes(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.shape[1] // bands
    parts = sig.reshape(len(sig), bands, rows)
    h = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    for k in range(rows):
        h = mix(h ^ parts[:, :, k], k)
    return h.view(np.int64)


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, n: int = SHINGLE) -> DataFrame:
    """doc_id, file and at, the address (hi, lo) and size of the shingle set, and its bands: those of weight 1, then the weighted ones that differ.

    A document without words has a null address and no bands."""

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        every = [np.unique(h, return_counts=True) for h in (shingle_hashes(t, n) for t in texts)]
        keep = [k for k, s in enumerate(every) if len(s[0])]
        out = {"doc_id": [i[0] for i in ids], "file": [i[1] for i in ids], "at": [i[2] for i in ids], **{c: [None] * len(ids) for c in ("hi", "lo", "size", "bands")}}
        if not keep:
            return out
        sets = [every[k] for k in keep]
        size = np.array([len(s[0]) for s in sets])
        doc, shingle, count = np.repeat(np.arange(len(sets)), size), np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets])
        own = list(band_hashes(prob_minhash(doc, shingle, np.ones(len(doc)), len(sets), bands * rows), bands))
        # without a repeated shingle both signatures are the same
        uneven = np.array([(s[1] > 1).any() for s in sets])
        if uneven.any():
            at, number = uneven[doc], np.cumsum(uneven) - 1
            sig = prob_minhash(number[doc[at]], shingle[at], 1.0 + np.log(count[at]), int(uneven.sum()), bands * rows)
            for k, h in zip(np.flatnonzero(uneven).tolist(), band_hashes(sig, bands)):
                own[k] = np.concatenate([own[k], h[h != own[k]]])
        address = np.array([set_address(s[0]) for s in sets])
        for j, k in enumerate(keep):
            out["hi"][k], out["lo"][k], out["size"][k], out["bands"][k] = address[j, 0], address[j, 1], size[j], own[j]
        return out

    return map_texts(docs, each, "doc_id long, file long, at long, hi long, lo long, size long, bands array<long>", "file", "at")


def set_address(shingles: np.ndarray) -> np.ndarray:
    """The 128-bit hash of a sorted shingle set, as two integers."""
    return np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node) of every node that has an edge (a, b), by alternating large and small stars."""
    now, before = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join has a plain exchange on both sides and the edges of a hub can be split
        low = cut(both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m")))
        large = both.filter("v > u").join(low, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        low = large.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("at"))
        now = cut(small.select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct())
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).collect()[0])
        if mark == before:
            break
        before = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def linked(own: list[np.ndarray], label: list[int], threshold: float) -> list[int]:
    """Classes after linking all sets of at least the threshold; equal labels are linked from the start.  The smallest label names a class."""
    names = sorted(set(label))
    number = {x: i for i, x in enumerate(names)}
    cls = np.array([number[x] for x in label])
    size = np.array([len(x) for x in own])
    _, flat = np.unique(np.concatenate(own), return_inverse=True)
    ends = np.cumsum(size)
    starts, mark, left = ends - size, np.zeros(flat.max() + 1, np.int64), len(names)
    for i in range(len(own)):
        if left == 1:
            break
        if not (cls[i + 1 :] != cls[i]).any():
            continue
        part = flat[starts[i] : ends[i]]
        mark[part] = 1
        shared = np.add.reduceat(mark[flat], starts)
        mark[part] = 0
        near = np.flatnonzero((shared >= threshold * (size[i] + size - shared) - 1e-9) & (cls != cls[i]))
        for j in np.unique(cls[near]).tolist():
            if j != cls[i]:
                a, b = min(j, cls[i]), max(j, cls[i])
                cls[cls == b] = a
                left -= 1
    return [names[k] for k in cls.tolist()]


def verified(tasks: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """label and cls: how the labels of ``tasks(task, rep, label)`` are linked in each task by the shingle sets (rep, shingles)."""

    def check(rows: pa.Table) -> pa.Table:
        label = rows.column("label").to_pylist()
        cls = linked([np.array(x.as_py(), np.int64) for x in rows.column("shingles")], label, threshold)
        pairs = sorted(set(zip(label, cls)))
        return pa.table({"label": pa.array([p[0] for p in pairs], pa.int64()), "cls": pa.array([p[1] for p in pairs], pa.int64())})

    return tasks.join(sets, "rep").select("task", "label", "shingles").groupBy("task").applyInArrow(check, "label long, cls long")


def deal(members: DataFrame, turn: int, bands: int, block_sets: int, block_shingles: int) -> DataFrame:
    """Add task and blocks to ``members(comp, rep, size, bands, ...)``: a component, or blocks of it that share a band where they can.

    The right sides are written, so that both joins are plain exchanges and a large component or bucket can be split."""
    parts = F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("size") / block_shingles))
    # the first bands are those of weight 1, which every set has
    members = members.withColumn("key", F.element_at("bands", turn % bands + 1))
    total = cut(members.groupBy("comp").agg(parts.alias("blocks")))
    hot = cut(members.groupBy("comp", "key").agg(parts.alias("salts")).filter("salts > 1"))
    both = members.join(total, "comp").join(hot, ["comp", "key"], "left")
    salt = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("salts"))).otherwise(F.lit(-1))
    block = F.when(F.col("blocks") == 1, F.lit(0)).otherwise(F.when(salt >= 0, F.xxhash64("key", salt)).otherwise(F.pmod(F.xxhash64("key", F.lit(turn)), F.col("blocks"))))
    return both.withColumn("task", F.concat_ws(":", F.col("comp").cast("string"), block.cast("string"))).drop("key", "salts")


def shingle_sets(docs: DataFrame, reps: DataFrame, n: int) -> DataFrame:
    """rep and its sorted shingle set, for the rows of ``docs(file, at, text)`` that are named in ``reps(rep, file, at)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            for k in range(0, len(ids), 200):
                sets = [np.unique(shingle_hashes(t, n)).view(np.int64) for t in texts[k : k + 200]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[k : k + 200], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "shingles"])

    return docs.join(reps.select("rep", "file", "at"), ["file", "at"]).select("rep", "text").mapInArrow(run, "rep long, shingles array<long>")


def classified(
    docs: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """file, at, doc_id, class_id and kept of every row of ``docs(file, at, doc_id, text)``."""
    # the number is written with the row, so it is the same for all that follows
    signed = cut(signatures(docs, bands, rows, n).withColumn("row", F.monotonically_increasing_id()))
    worded = signed.filter("hi IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    own = F.min(F.struct("row", "file", "at", "size", "bands"))
    distinct = worded.groupBy("hi", "lo").agg(own.alias("own"), first.alias("first"))
    distinct = cut(distinct.select("hi", "lo", F.col("own.row").alias("rep"), "own.file", "own.at", "own.size", "own.bands", "first"))
    bucket = distinct.select("rep", F.explode("bands").alias("h"))
    heads = bucket.groupBy(F.col("h").alias("h2")).agg(F.min("rep").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = bucket.join(heads, F.col("h") == F.col("h2")).filter("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b"))
    found = components(edges).withColumnRenamed("node", "rep").withColumnRenamed("root", "comp")
    found = cut(found.join(distinct.select("rep", "file", "at", "size", "bands"), "rep"))
    sets = cut(shingle_sets(docs, found, n))
    dealt = cut(deal(found.drop("file", "at"), 0, bands, block_sets, block_shingles).withColumn("label", F.col("rep")))
    classes = cut(dealt.select("rep", "comp", "blocks", "bands", "size").join(verified(dealt, sets, threshold).withColumnRenamed("label", "rep"), "rep"))
    large = classes.filter("blocks > 1")
    if not large.isEmpty():
        classes = cut(classes.filter("blocks = 1").select("rep", "cls").unionByName(merged(large, sets, threshold, bands, block_sets, block_shingles)))
    # a class is named by its smallest doc_id; written, so that a hot class can be split in the join
    of = cut(distinct.select("hi", "lo", "rep", "first").join(classes.select("rep", "cls"), "rep", "left").withColumn("cls", F.coalesce("cls", "rep")))
    stays = cut(of.groupBy("cls").agg(F.min("first").alias("stay")).select("cls", F.col("stay.doc_id").alias("class_id"), F.col("stay.row").alias("keep")))
    # one row a set gets its class; the copies meet it once, in a join of two plain exchanges that can be split where a set is hot
    named = cut(of.select("hi", "lo", "cls").join(stays, "cls").drop("cls"))
    out = worded.select("file", "at", "row", "doc_id", "hi", "lo").join(named, ["hi", "lo"]).select("file", "at", "doc_id", "class_id", (F.col("row") == F.col("keep")).alias("kept"))
    empty = signed.filter("hi IS NULL").select("file", "at", "doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return out.unionByName(empty)


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, class_id and kept; ``how`` as in ``classified``."""
    return classified(keyed(docs.select("doc_id", "text")), **how).drop("file", "at")


def without_near_copies(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    file, at = fresh(docs, "file"), fresh(docs, "at")
    docs_ = keyed(docs, file, at)
    done = classified(docs_.select("doc_id", F.col(file).alias("file"), F.col(at).alias("at"), "text"), **how)
    stay = done.filter("kept").select(F.col("file").alias(file), F.col("at").alias(at))
    return docs_.join(stay, [file, at], "left_semi").select(docs.columns)


def merged(large: DataFrame, sets: DataFrame, threshold: float, bands: int, block_sets: int, block_shingles: int) -> DataFrame:
    """Classes (rep, cls) of the components that needed several blocks."""
    # representatives of the blocks' classes, block by block again, while that joins any
    now, turn = large.select("rep", "comp", "bands", "size", "cls"), 0
    left = now.select("cls").distinct().count()
    while True:
        turn += 1
        heads = now.filter("rep = cls").select("rep", "comp", "bands", "size").withColumn("label", F.col("rep"))
        dealt = cut(deal(heads, turn, bands, block_sets, block_shingles))
        single = dealt.filter("blocks > 1").isEmpty()
        step = verified(dealt, sets, threshold).select(F.col("label").alias("cls"), F.col("cls").alias("up"))
        now = cut(now.join(step, "cls").select("rep", "comp", "bands", "size", F.col("up").alias("cls")))
        count = now.select("cls").distinct().count()
        if single or count == left:
            break
        left = count
    # buckets that still span classes: the largest class in blocks, all others against each block and among themselves
    bucket = now.select("rep", "cls", "size", F.explode("bands").alias("h"))
    per = bucket.groupBy("h", "cls").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    open_ = per.groupBy("h").agg(F.count("*").alias("k"), F.max_by("cls", F.struct("n", "cls")).alias("main"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("n").alias("m")).filter("k > 1")
    half = lambda n, s: F.greatest(F.ceil(n / (block_sets / 2)), F.ceil(s / (block_shingles / 2)), F.lit(1)).cast("int")
    # written, so that the join has a plain exchange on both sides and a hot bucket can be split
    open_ = cut(open_.select("h", "main", half(F.col("n"), F.col("s")).alias("blocks"), half(F.col("n") - F.col("m"), F.col("s") * (F.col("n") - F.col("m")) / F.col("n")).alias("few")))
    spread = bucket.join(open_, "h")
    salt = F.xxhash64("rep", "h")
    mains = spread.filter("cls = main").select("*", F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("i")).select(
        "rep", "cls", F.concat_ws(":", F.lit("m"), "h", "i", F.pmod(salt, F.col("blocks")).cast("string")).alias("task"))
    others = spread.filter("cls <> main").withColumn("own", F.pmod(salt, F.col("few")).cast("int"))
    against = others.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j")).select("rep", "cls", F.concat_ws(":", F.lit("m"), "h", "own", F.col("j").cast("string")).alias("task"))
    among = others.select("*", F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("j")).select(
        "rep", "cls", F.concat_ws(":", F.lit("o"), "h", F.least("own", "j").cast("string"), F.greatest("own", "j").cast("string")).alias("task"))
    tasks = mains.unionByName(against).unionByName(among).withColumnRenamed("cls", "label")
    links = verified(tasks, sets, threshold).filter("label <> cls").select(F.col("label").alias("a"), F.col("cls").alias("b"))
    roots = components(links)
    return now.select("rep", "cls").join(roots, F.col("cls") == F.col("node"), "left").select("rep", F.coalesce("root", "cls").alias("cls"))
