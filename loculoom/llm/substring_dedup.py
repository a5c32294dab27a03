"""Repeated passages by phrase automata.

A window is ``WINDOW`` consecutive words of one document.  Every occurrence of a window but the first (by doc_id, then by start) is a
repeat, and the words that repeats cover go.

Recurring passages are proposed by anchors: in each window the phrase of ``ANCHOR`` words with the least hash.  Equal windows have equal
anchors, about one word in eight starts one, and only windows whose anchor occurs again can recur; the documents' stretches of
such windows are dealt to shards by the block of the anchor's first occurrence, so a copied passage stays in one piece.  In a shard the
windows that occur twice (by 128 bits of hash) are confirmed and compiled into an Aho-Corasick automaton over word numbers,
and the stretches stream through it.  It locates every occurrence of every confirmed window, word for word; the first one stays,
the others are cut out.

A shard is a few tens of thousands of words.  One whose passages are very frequent is salted: each part sends the first occurrence of
every window it has (one row a window, however often it occurs), these meet by hash, and each part's automaton then knows the
first occurrence of all.  The anchors that recur are sent to all executors if they measure under ``BROADCAST_BYTES``; beyond that
they meet the documents' anchors in a join, and the documents meet their marks by the key of the row.

Defined results: words are runs of anything but space and U+0009 to U+000D, unchanged; a null or empty text has no words; kept words are
joined by one space; a null doc_id comes after all others; rows of one doc_id are separate documents, of which the one that is stored
first comes first; windows are judged on the input, so all repeats go at once; an empty table gives an empty result;
further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, keyed, slices
from .near_dedup import mix

WINDOW, ANCHOR = 20, 5
#: Anchors of a block (a copied passage of that length stays in one stretch), and words of a shard.
BLOCK_ANCHORS, SHARD_WORDS = 64, 60_000
#: A shard of more than so many times its words is salted.
SALTED = 3
BROADCAST_BYTES = 32 << 20
#: Characters whose words are worked on at once; bytes from which on a word is hashed by itself.
CHARS, LONG_WORD = 1 << 20, 64
EMPTY = np.zeros(0, np.int64)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BYTES = mix(np.arange(256, dtype=np.uint64), 3)
#: Low bits of a phrase's hash that its place takes.
PLACE = np.uint64((1 << 20) - 1)


class Words:
    """The words of some texts one after the other: hash, first byte and end of each in ``data``, and how many each text has."""

    def __init__(self, texts: list[bytes]):
        self.data = b" " + b" ".join(texts) + b" "
        raw = np.frombuffer(self.data, np.uint8)
        gap = SPACE[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.begin, self.end = edge[0::2], edge[1::2]
        size = self.end - self.begin
        # byte by byte over all words that are that long; the few long ones whole
        self.hash, order = np.zeros(len(size), np.uint64), np.argsort(-size, kind="stable")
        upto, active = -size[order], len(size)
        for k in range(min(int(size.max(initial=0)), LONG_WORD)):
            active = int(np.searchsorted(upto, -k, "left"))
            at = order[:active]
            self.hash[at] = self.hash[at] * np.uint64(0x9FB21C651E98DF25) + BYTES[raw[self.begin[at] + k]]
        self.hash = mix(self.hash + size.astype(np.uint64), 7)
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            self.hash[i] = xxhash.xxh3_64_intdigest(self.data[self.begin[i] : self.end[i]])
        stops = np.cumsum([len(t) + 1 for t in texts])
        self.counts = np.diff(np.searchsorted(self.begin, stops + 1), prepend=0) if texts else EMPTY

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every window that lies in one text, the place of its first word among all, and its text."""
        return inner_windows(self.counts, window)


def inner_windows(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.maximum(counts - window + 1, 0)
    of = np.repeat(np.arange(len(n)), n)
    starts = np.cumsum(counts) - counts
    return starts[of] + np.arange(len(of)) - (np.cumsum(n) - n)[of], of


def rolled(words: np.ndarray, n: int, factor: int) -> np.ndarray:
    """The hash of the n words at every place."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(factor) + words[k : len(words) - n + 1 + k]
    return mix(h, n)


def anchors(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the phrases at all places, and the place of the anchor of every window: the phrase of the least hash, of equal ones the first.

    Minima over a width follow from those over half of it; the place rides in the low bits of the hash."""
    phrases = rolled(words, anchor, 0xC2B2AE3D27D4EB4F)
    if len(words) < window:
        return phrases, EMPTY
    place = np.arange(len(phrases), dtype=np.uint64)
    least, width, whole = phrases & ~PLACE | place & PLACE, 1, window - anchor + 1
    while 2 * width <= whole:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < whole:
        least = np.minimum(least[: len(least) - (whole - width)], least[whole - width :])
    place = place[: len(least)]
    return phrases, (place + (least - place & PLACE)).astype(np.int64)


def window_hashes(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return rolled(words, window, 0xC2B2AE3D27D4EB4F).view(np.int64), rolled(words, window, 0x9E3779B185EBCA87).view(np.int64)


def some(ids: list, texts: list[str]) -> Iterator[tuple[list, list[bytes]]]:
    """The texts in UTF-8, about ``CHARS`` at a time."""
    begin, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= CHARS or k + 1 == len(texts):
            yield ids[begin : k + 1], [x.encode() for x in texts[begin : k + 1]]
            begin, size = k + 1, 0


def spots(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """file, at, place and phrase of the anchors of ``docs(file, at, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in slices(batches):
            for ids, texts in some(*got):
                words = Words(texts)
                hashes, of = anchors(words.hash, window, anchor)
                first, text = words.windows(window)
                at, k = np.unique(of[first], return_index=True)
                text = text[k]
                keys = [np.array([i[c] for i in ids], np.int64)[text] for c in (0, 1)]
                place = at - (np.cumsum(words.counts) - words.counts)[text]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys, place, hashes[at].view(np.int64))], names=["file", "at", "place", "phrase"])

    return docs.select("file", "at", "text").mapInArrow(run, "file long, at long, place long, phrase long")


def recurring(found: DataFrame) -> DataFrame:
    """phrase and block of the anchors that occur more than once; blocks follow the order in which they are first met."""
    met = found.select("phrase", F.monotonically_increasing_id().alias("id")).groupBy("phrase").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return met.filter("n > 1").select("phrase", F.expr(f"id div {BLOCK_ANCHORS}").alias("block"))


STRETCH = "block long, unknown boolean, doc_id long, file long, at long, start long, n long, text string"


def stretches(docs: DataFrame, again: DataFrame, window: int, anchor: int, broadcast_bytes: int) -> DataFrame:
    """The stretches of windows whose anchors recur, one for each run of one block: its document, first word, number of words and text."""

    def run(batches: Iterator[pa.RecordBatch], blocks) -> Iterator[pa.RecordBatch]:
        """``blocks(ids, words, phrases, of)``: the block of every window in the texts, by its anchor's place; -1 where that does not recur."""
        for got in slices(batches):
            for ids, texts in some(*got):
                words = Words(texts)
                phrases, of = anchors(words.hash, window, anchor)
                first, text = words.windows(window)
                block = blocks(ids, words, phrases, of[first])
                # windows that follow each other in a text and a block
                edge = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (text[1:] != text[:-1])])) if len(block) else EMPTY
                n = np.diff(np.append(edge, len(block)))
                edge, n = edge[block[edge] >= 0], n[block[edge] >= 0]
                if not len(edge):
                    continue
                begin = first[edge]
                cuts = zip(words.begin[begin].tolist(), words.end[begin + n + window - 2].tolist())
                keys = [[ids[k][c] for k in text[edge].tolist()] for c in range(3)]
                start = begin - (np.cumsum(words.counts) - words.counts)[text[edge]]
                columns = [block[edge], [i is None for i in keys[0]], *keys, start, n + window - 1, [words.data[a:b].decode() for a, b in cuts]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, STRETCH_ARROW)], schema=STRETCH_ARROW)

    if again.count() * 16 <= broadcast_bytes:
        known = again.orderBy("phrase").toArrow()
        spread = docs.sparkSession.sparkContext.broadcast((known.column("phrase").to_numpy(), known.column("block").to_numpy()))

        def looked_up(ids: list, words: Words, phrases: np.ndarray, of: np.ndarray) -> np.ndarray:
            phrase, block = spread.value
            if not len(phrase) or not len(of):
                return np.full(len(of), -1)
            # windows that follow each other mostly have one anchor
            each, back = np.unique(of, return_inverse=True)
            mine = phrases[each].view(np.int64)
            k = np.minimum(np.searchsorted(phrase, mine), len(phrase) - 1)
            return np.where(phrase[k] == mine, block[k], -1)[back]

        return docs.select("doc_id", "file", "at", "text").mapInArrow(lambda b: run(b, looked_up), STRETCH)

    def told(ids: list, words: Words, phrases: np.ndarray, of: np.ndarray) -> np.ndarray:
        at, starts = np.full(len(phrases) + 1, -1), np.cumsum(words.counts) - words.counts
        for start, (*_, marks) in zip(starts.tolist(), ids):
            at[[start + m["place"] for m in marks]] = [m["block"] for m in marks]
        return at[of]

    marks = spots(docs, window, anchor).join(again, "phrase").groupBy("file", "at").agg(F.collect_list(F.struct("place", "block")).alias("marks"))
    both = docs.join(marks, ["file", "at"]).select("doc_id", "file", "at", "marks", "text")
    return both.mapInArrow(lambda b: run(b, told), STRETCH)


STRETCH_ARROW = pa.schema([(f.split()[0], {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[f.split()[1]]) for f in STRETCH.split(", ")])
ORDER = ("unknown", "doc_id", "file", "at", "start")


class Part:
    """The stretches of a shard, or of a salted part of one, as arrays, in the order of their documents: of two windows the first is the earlier one."""

    def __init__(self, rows: pa.Table, window: int):
        self.window = window
        self.key = [rows.column(c).fill_null(0).to_numpy() if c == "doc_id" else rows.column(c).to_numpy() for c in ORDER]
        by = np.lexsort(self.key[::-1])
        self.key, numbers = [k[by].astype(np.int64) for k in self.key], {}
        texts = [rows.column("text")[k].as_py().encode().split() for k in by.tolist()]
        counts = np.array([len(t) for t in texts], np.int64)
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(counts.sum()))
        flat, ends = ids.tolist(), np.cumsum(counts).tolist()
        self.words = [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]
        words = Words([b" ".join(numbers)]).hash[ids] if numbers else np.zeros(0, np.uint64)
        first, self.of = inner_windows(counts, window)
        self.hi, self.lo = (h[first] for h in window_hashes(words, window))
        self.place = first - (np.cumsum(counts) - counts)[self.of]

    def order(self, of: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """The order columns of windows: unknown, doc_id, file, at, start."""
        return [*(k[of] for k in self.key[:4]), self.key[4][of] + place]

    def firsts(self) -> tuple[np.ndarray, np.ndarray]:
        """The first window of each distinct one, and how often it occurs."""
        by = np.lexsort((self.lo, self.hi))
        hi, lo = self.hi[by], self.lo[by]
        first = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])) if len(by) else EMPTY
        return by[first], np.diff(np.append(first, len(by)))

    def occurrences(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, stretch, place) of every occurrence of the given windows in the stretches, in their order, by their automaton."""
        machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, (of, place) in enumerate(zip(self.of[windows].tolist(), self.place[windows].tolist())):
            machine.add_word(self.words[of][place : place + self.window], k)
        if not len(machine):
            return EMPTY, EMPTY, EMPTY
        machine.make_automaton()
        found = [np.fromiter(chain.from_iterable(machine.iter(words)), np.int64) for words in self.words]
        end, pattern = np.concatenate(found).reshape(-1, 2).T
        return pattern, np.repeat(np.arange(len(found)), [len(x) // 2 for x in found]), end - self.window + 1

    def covers(self, of: np.ndarray, place: np.ndarray) -> pa.Table:
        """(file, at, a, b): the runs of words that the windows cover, which come in order."""
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (place[1:] > place[:-1] + self.window)]) if len(of) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(of) - 1) if len(of) else EMPTY
        i = of[first]
        columns = [self.key[2][i], self.key[3][i], self.key[4][i] + place[first], self.key[4][i] + place[last] + self.window]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["file", "at", "a", "b"])


COVERS = "file long, at long, a long, b long"


def located(rows: pa.Table, window: int) -> pa.Table:
    """Where a whole shard's repeats lie: confirm, compile, locate; the first occurrence of every window stays."""
    part = Part(rows, window)
    first, n = part.firsts()
    pattern, of, place = part.occurrences(first[n > 1])
    again = np.ones(len(pattern), bool)
    again[np.unique(pattern, return_index=True)[1]] = False
    return part.covers(of[again], place[again])


def part_firsts(rows: pa.Table, window: int) -> pa.Table:
    """shard, salt and the first occurrence of every window of a salted part, with its number."""
    part = Part(rows, window)
    first, n = part.firsts()
    keys = [pa.array(np.repeat(rows.column(c).to_numpy()[:1], len(first))) for c in ("shard", "salt")]
    order = part.order(part.of[first], part.place[first])
    return pa.table([*keys, pa.array(part.hi[first]), pa.array(part.lo[first]), *(pa.array(o) for o in order), pa.array(n)], names=["shard", "salt", "hi", "lo", *ORDER, "n"])


def located_part(rows: pa.Table, known: pa.Table, window: int) -> pa.Table:
    """``located`` for a salted part, where ``known(hi, lo, first)`` has the first occurrences over all parts of the part's own windows that recur."""
    part = Part(rows, window)
    mine, _ = part.firsts()
    owner = {(h, lo): tuple(f.values()) for h, lo, f in zip(*(known.column(c).to_pylist() for c in ("hi", "lo", "first")))}
    mine = np.array([k for k, h, lo in zip(mine.tolist(), part.hi[mine].tolist(), part.lo[mine].tolist()) if (h, lo) in owner], np.int64)
    pattern, of, place = part.occurrences(mine)
    first = np.array([owner[h, lo] for h, lo in zip(part.hi[mine].tolist(), part.lo[mine].tolist())], np.int64).reshape(-1, 5)
    again = (np.stack(part.order(of, place), 1) != first[pattern]).any(1) if len(pattern) else np.zeros(0, bool)
    return part.covers(of[again], place[again])


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(file, at, a, b): the runs of words, from a to before b, that repeats cover in ``docs(file, at, doc_id, text)``; runs may overlap."""
    again = cut(recurring(spots(docs, window, anchor)))
    found = cut(stretches(docs, again, window, anchor, broadcast_bytes))
    shards = max(1, math.ceil((found.agg(F.sum("n")).collect()[0][0] or 0) / shard_words))
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)))
    hot = dealt.groupBy("shard").agg(F.sum("n").alias("words")).filter(F.col("words") > SALTED * shard_words)
    hot = cut(hot.select("shard", F.ceil(F.col("words") / shard_words).alias("salts")))
    cold = dealt.join(hot, "shard", "left_anti").groupBy("shard").applyInArrow(lambda t: located(t, window), COVERS)
    if hot.isEmpty():
        return cold
    salted = dealt.join(hot, "shard").withColumn("salt", F.pmod(F.xxhash64("file", "at", "start"), F.col("salts"))).drop("salts")
    firsts = cut(salted.groupBy("shard", "salt").applyInArrow(lambda t: part_firsts(t, window), "shard long, salt long, hi long, lo long, unknown long, doc_id long, file long, at long, start long, n long"))
    owners = firsts.groupBy("hi", "lo").agg(F.min(F.struct(*ORDER)).alias("first"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    known = firsts.select("shard", "salt", "hi", "lo").join(cut(owners), ["hi", "lo"])
    parts = salted.groupBy("shard", "salt").cogroup(known.groupBy("shard", "salt")).applyInArrow(lambda t, k: located_part(t, k, window), COVERS)
    return cold.unionByName(parts)


def without_repeats(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_removed and text (the words that stay) of every row of ``docs(doc_id, text)``; ``how`` as in ``repeats``."""
    docs = keyed(docs.select("doc_id", "text"))
    covers = cut(repeats(docs, **how).groupBy("file", "at").agg(F.collect_list(F.struct("a", "b")).alias("runs")))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            out = []
            for (doc, runs), t in zip(ids, texts):
                tokens = t.encode().split()
                gone = np.zeros(len(tokens), bool)
                for r in runs or ():
                    gone[r["a"] : r["b"]] = True
                kept = [w for w, g in zip(tokens, gone.tolist()) if not g] if runs else tokens
                out.append((doc, len(tokens), len(tokens) - len(kept), b" ".join(kept).decode()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return docs.join(covers, ["file", "at"], "left").select("doc_id", "runs", "text").mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")


def repeat_digest(done: DataFrame) -> DataFrame:
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id NULLS LAST, i) > 1 AS again FROM s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM g WHERE again),
o AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
k AS (SELECT o.doc_id, string_agg(word, ' ' ORDER BY o.i) AS kept, count(*) AS n FROM o ANTI JOIN c ON o.doc_id IS NOT DISTINCT FROM c.doc_id AND o.i = c.i GROUP BY o.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id IS NOT DISTINCT FROM k.doc_id
"""
