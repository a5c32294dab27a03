"""Benchmark decontamination: a BM25 inverted index of test items with block-max WAND, asked with every training passage.

Every posting (term, item) holds the item's BM25 impact as a share of that item's own threshold, so that one threshold, 1, holds
for all items.  Per term the index has the largest share, and per block of ``BLOCK`` items the block's largest.  Passages are
overlapping windows of a document that together cover it, each at least one item long on either side of any place.  As in WAND,
the terms of a passage are taken in a fixed order until their largest shares add up to 1 (the pivot): the terms before it cannot
lift any item over its threshold alone, so their lists are never walked.  The lists from the pivot on name the blocks that may
hold an item; a block is skipped unless the maxima of the passage's terms in this very block add up to 1, and an item in it unless
its own shares and the bound of the terms before the pivot do.  What is left is scored in full; nothing else can be above its
threshold.  Passages are asked many at a time, as arrays.

Short items have large shares of few words, which would loosen the bounds of all others; so items are indexed by length class,
each with maxima of its own.

Every item above its threshold is verified on the document's words: the shingles of the question part and of the
answer part must both overlap, or those of the whole item.  One edited word takes up to five shingles, so a text of
fewer than ``SHORT`` words may also be found by alignment: in one stretch of the passages that proposed the item, with
an edit distance in words of at most a fifth of its own.

The threshold of an item is a share of the score of its own text.  The question of an item is all but its last
sentence, the answer is that sentence (the last third of its words if there is one sentence only).  An item of more
than ``PIECE`` words is indexed in pieces; any piece above its threshold proposes the item.

Defined results: documents that hold no item have no row; a null or empty text holds none, a null or empty item is
never found; of repeated items each is reported; repeated documents are reported once a row; empty tables give an
empty result; further columns of the inputs are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, keyed, pa_schema, slices

K1, B = 1.2, 0.75
PIECE, SHINGLE, OVERLAP, SHARE = 64, 5, 0.8, 0.6
#: Items of a block, and window-block bounds that are held at once.
BLOCK, HELD = 16, 4_000_000
#: From this many words on, one edited word leaves at least OVERLAP of the shingles.
SHORT = 29
#: Characters of items that one index (one pass over the documents) holds.
INDEX_CHARS = 32 << 20
#: Words are runs of letters, digits and non-ASCII characters of the lower-cased text, in UTF-8.
BREAKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(BREAKS).split()


def shingles(tokens: list[bytes], n: int = SHINGLE) -> set[tuple]:
    return {tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)} if len(tokens) >= n else ({tuple(tokens)} if tokens else set())


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    parts = [w for s in SENTENCE.split(text) if (w := words(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    only = parts[0] if parts else []
    k = len(only) - max(1, len(only) // 3) if only else 0
    return only[:k], only[k:]


def aligned(part: list[bytes], text: list[bytes]) -> float:
    """1 less the least edit distance, in words, of a part to any stretch of a text, as a share of the part (bit-parallel)."""
    m = len(part)
    if not m:
        return 1.0
    at: dict[bytes, int] = {}
    for i, w in enumerate(part):
        at[w] = at.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, distance = full, 0, m
    least = m
    for w in text:
        eq = at.get(w, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(zero | up) & full, up & zero
        if plus & top:
            distance += 1
        elif minus & top:
            distance -= 1
            least = min(least, distance)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(zero | plus) & full, plus & zero
    return 1.0 - least / m


def runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(int(length.sum()))


class LengthClass:
    """Postings of the pieces of one length class: shares of the threshold, with maxima per term and per block."""

    def __init__(self, pieces: np.ndarray, term: np.ndarray, piece: np.ndarray, share: np.ndarray, terms: int):
        """``pieces`` are the numbers of the class's pieces; posting i says that ``term[i]`` stands in ``pieces[piece[i]]``."""
        order = np.lexsort((piece, term))
        term, piece, share = term[order], piece[order], share[order]
        self.pieces, self.n, self.blocks = pieces, len(pieces), len(pieces) // BLOCK + 1
        self.piece, self.share, self.key = piece, share, term * len(pieces) + piece
        self.most = np.zeros(terms)
        np.maximum.at(self.most, term, share)
        df = np.bincount(term, minlength=terms)
        # frequent terms of small shares come first: as many postings as possible lie before the pivot
        self.by_rank = np.argsort(self.most / np.maximum(df, 1), kind="stable")
        self.rank = np.empty(terms, np.int64)
        self.rank[self.by_rank] = np.arange(terms)
        # the block entries of a term are neighbours, and so are the postings of an entry
        where = term * self.blocks + piece // BLOCK
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else np.zeros(0, np.int64)
        self.entry, self.begin = where[first], np.append(first, len(where))
        self.bound = np.maximum.reduceat(share, first) if len(first) else np.zeros(0)
        self.starts = np.searchsorted(self.entry, np.arange(terms + 1) * self.blocks)
        self.has = self.starts[1:] > self.starts[:-1]

    @staticmethod
    def at(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The value of each wanted key, 0 where there is none."""
        k = np.searchsorted(keys, wanted)
        k[k == len(keys)] = 0
        return np.where(keys[k] == wanted, values[k], 0.0) if len(keys) else np.zeros(len(wanted))

    def ask(self, window: np.ndarray, term: np.ndarray, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, piece, share) of all pieces that reach their threshold; the pairs (window, term) are distinct and sorted by window."""
        here = self.has[term]
        terms = len(self.most)
        key = np.sort(window[here] * terms + self.rank[term[here]])
        window, term = key // terms, self.by_rank[key % terms]
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]])) if len(key) else np.zeros(0, np.int64)
        names, sizes = window[first], np.diff(np.append(first, len(key)))
        out = []
        step = max(1, HELD // self.blocks)
        for a in range(0, len(names), step):
            size = sizes[a : a + step]
            out.append(self.ask_some(names[a : a + step], size, term[first[a] : first[a] + int(size.sum())], counts))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*out))

    def ask_some(self, names: np.ndarray, sizes: np.ndarray, term: np.ndarray, counts: dict[str, int]):
        """``ask`` for windows whose terms, ``sizes`` of them each, come in the order of their ranks."""
        w, most = np.repeat(np.arange(len(names)), sizes), self.most[term]
        total = np.cumsum(most)
        ahead = np.concatenate([[0.0], total])[np.cumsum(sizes) - sizes]
        essential = total - np.repeat(ahead, sizes) >= 1 - 1e-9
        # what the terms before the pivot can add at most, per window
        rest = np.bincount(w[~essential], weights=most[~essential], minlength=len(names))
        ew, et = w[essential], term[essential]
        size = self.starts[et + 1] - self.starts[et]
        entries = runs(self.starts[et], size)
        at = np.repeat(ew, size) * self.blocks + self.entry[entries] % self.blocks
        bound = np.bincount(at, weights=self.bound[entries], minlength=len(names) * self.blocks)
        live = np.flatnonzero(bound + np.repeat(rest, self.blocks) >= 1 - 1e-9)
        live = live[bound[live] > 0]
        # the terms before the pivot by their maxima in this very block, from the pivot down, as long as the block may hold an item
        low_w, low_t = w[~essential], term[~essential]
        begin, end = (np.searchsorted(low_w, live // self.blocks, side) for side in ("left", "right"))
        low, known = rest[live // self.blocks], np.zeros(len(live))
        open_ = np.flatnonzero(end > begin)
        while len(open_):
            end[open_] -= 1
            t, b = low_t[end[open_]], live[open_] % self.blocks
            known[open_] += self.at(self.entry, t * self.blocks + b, self.bound)
            low[open_] -= self.most[t]
            may = bound[live[open_]] + known[open_] + low[open_] >= 1 - 1e-9
            known[open_[~may]] = -np.inf
            open_ = open_[may & (end[open_] > begin[open_])]
        kept = bound[live] + known >= 1 - 1e-9
        live, low = live[kept], known[kept]
        counts["blocks"] += len(names) * self.blocks
        counts["walked"] += len(live)
        # the postings of the terms from the pivot on, in the blocks that are left
        k = np.searchsorted(live, at)
        k[k == len(live)] = 0
        hit = live[k] == at if len(live) else np.zeros(len(at), bool)
        entries, k = entries[hit], k[hit]
        size = self.begin[entries + 1] - self.begin[entries]
        postings = runs(self.begin[entries], size)
        pair, place = np.unique(np.repeat(live[k] // self.blocks, size) * self.n + self.piece[postings], return_inverse=True)
        share = np.bincount(place, weights=self.share[postings], minlength=len(pair))
        block = np.searchsorted(live, pair // self.n * self.blocks + pair % self.n // BLOCK)
        kept = share + low[block] >= 1 - 1e-9 if len(pair) else np.zeros(0, bool)
        pair, share = pair[kept], share[kept]
        # what is left in full
        begin, end = (np.searchsorted(low_w, pair // self.n, side) for side in ("left", "right"))
        lows = runs(begin, end - begin)
        owner = np.repeat(np.arange(len(pair)), end - begin)
        share = share + np.bincount(owner, weights=self.at(self.key, low_t[lows] * self.n + pair[owner] % self.n, self.share), minlength=len(pair))
        kept = share >= 1 - 1e-9
        return names[pair[kept] // self.n], self.pieces[pair[kept] % self.n], share[kept]


def pieces_of(tokens: list[bytes]) -> Iterator[list[bytes]]:
    """The pieces in which an item is indexed; a short last one reaches back."""
    for a in range(0, len(tokens), PIECE):
        piece = tokens[a : a + PIECE]
        yield tokens[-PIECE:] if a and len(piece) < PIECE // 2 else piece


@dataclass
class Statistics:
    """What BM25 needs of the whole benchmark: its pieces, their mean length, and how many of them hold a term."""

    n: int
    mean: float
    df: dict[bytes, int]

    @staticmethod
    def of(texts: list[str]) -> Statistics:
        found = [p for t in texts for p in pieces_of(words(t))]
        return Statistics(len(found), sum(map(len, found)) / max(1, len(found)), Counter(w for p in found for w in set(p)))


class BenchmarkIndex:
    """Inverted index of (item_id, text) items with block maxima, by length class.  ``known`` are the statistics of the benchmark whose part they are."""

    def __init__(self, items: list[tuple[int, str]], share: float = SHARE, known: Statistics | None = None):
        known = known or Statistics.of([t for _, t in items])
        self.items = [(i, *question_answer(t)) for i, t in items]
        self.terms: dict[bytes, int] = {}
        self.counts = {"blocks": 0, "walked": 0}
        pieces, self.of = [], []
        for k, (_, t) in enumerate(items):
            for piece in pieces_of(words(t)):
                pieces.append(np.unique([self.terms.setdefault(w, len(self.terms)) for w in piece], return_counts=True) + (len(piece),))
                self.of.append(k)
        n, m = len(pieces), len(self.terms)
        sizes, lengths = np.array([len(p[0]) for p in pieces], np.int64), np.array([p[2] for p in pieces], np.int64)
        term = np.concatenate([p[0] for p in pieces]) if n else np.zeros(0, np.int64)
        tf = np.concatenate([p[1] for p in pieces]) if n else np.zeros(0)
        piece = np.repeat(np.arange(n), sizes)
        df = np.array([known.df[w] for w in self.terms], np.float64)
        idf = np.log1p((known.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths[piece] / known.mean) if n else tf
        impact = idf[term] * tf * (K1 + 1) / (tf + norm)
        self.own = np.bincount(piece, weights=impact, minlength=n)
        self.threshold = share * self.own
        self.classes = []
        level = np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
        for c in np.unique(level).tolist():
            mine = np.flatnonzero(level == c)
            at = np.isin(piece, mine)
            self.classes.append(LengthClass(mine, term[at], np.searchsorted(mine, piece[at]), impact[at] / self.threshold[piece[at]], m))
        self.parts = [(words(t), *parts) for (_, t), (_, *parts) in zip(items, self.items)]
        self.shingles = [[[b" %s " % b" ".join(x) for x in shingles(part)] for part in parts] for parts in self.parts]

    def passages(self, ids: np.ndarray, doc: np.ndarray, at: np.ndarray) -> dict[tuple[int, int], tuple[float, list[int]]]:
        """Best (document, piece) scores above the thresholds, and all windows above.  ids: terms found; doc, at: where (document, word)."""
        best: dict[tuple[int, int], tuple[float, list[int]]] = {}
        if not len(self.own) or not len(ids):
            return best
        # windows of 2 * PIECE words every PIECE words: each place is in window at // PIECE + 1 and the one before
        stride = int(at.max()) // PIECE + 2
        window = doc * stride + at // PIECE + 1
        seen = np.sort(np.concatenate([window, window - 1]) * len(self.terms) + np.tile(ids, 2))
        seen = seen[np.concatenate([[True], seen[1:] != seen[:-1]])]
        w, t = seen // len(self.terms), seen % len(self.terms)
        for group in self.classes:
            for win, k, share in zip(*(x.tolist() for x in group.ask(w, t, self.counts))):
                d, j = divmod(win, stride)
                top, windows = best.get((d, k), (-1.0, []))
                best[d, k] = (max(share * float(self.threshold[k]), top), [*windows, j])
        return best

    def search(self, texts: list[str]) -> list[tuple[int, int, float, float, float, float]]:
        """(text number, item_id, score, own score, question overlap, answer overlap) of every item that a text holds."""
        get = self.terms.get
        split = [words(t) for t in texts]
        found = [np.fromiter(map(get, tokens, itertools.repeat(-1)), np.int64, len(tokens)) for tokens in split]
        where = [np.flatnonzero(f >= 0) for f in found]
        docs = np.repeat(np.arange(len(texts)), [len(w) for w in where])
        ids = np.concatenate([f[w] for f, w in zip(found, where)]) if texts else np.zeros(0, np.int64)
        at = np.concatenate(where) if texts else np.zeros(0, np.int64)
        best: dict[tuple[int, int], tuple[float, float]] = {}
        near: dict[tuple[int, int], set[int]] = {}
        for (d, k), (s, windows) in self.passages(ids, docs, at).items():
            key = (d, self.of[k])
            near.setdefault(key, set()).update(windows)
            if s / self.own[k] > best.get(key, (0.0, 1.0))[0] / best.get(key, (0.0, 1.0))[1]:
                best[key] = (s, float(self.own[k]))
        out, last, whole = [], -1, b""
        for (d, k), (s, own) in sorted(best.items()):
            if d != last:
                last, whole = d, b" %s " % b" ".join(split[d])
            overlaps = [sum(x in whole for x in part) / len(part) if part else 1.0 for part in self.shingles[k]]
            if not confirmed(overlaps):
                stretches = self.stretches(split[d], near[d, k], len(self.parts[k][0]))
                overlaps = [max(o, *(aligned(p, x) for x in stretches)) if o < OVERLAP and len(p) < SHORT else o for o, p in zip(overlaps, self.parts[k])]
            if confirmed(overlaps):
                out.append((d, self.items[k][0], s, own, *overlaps[1:]))
        return out

    @staticmethod
    def stretches(tokens: list[bytes], windows: set[int], more: int) -> list[list[bytes]]:
        """The words of the windows, with as many as the item has before and after; windows that meet are one stretch."""
        ends: list[list[int]] = []
        for j in sorted(windows):
            a, b = max(0, (j - 1) * PIECE - more), (j + 1) * PIECE + more
            if ends and a <= ends[-1][1]:
                ends[-1][1] = b
            else:
                ends.append([a, b])
        return [tokens[a:b] for a, b in ends]


def confirmed(overlaps: list[float]) -> bool:
    """Overlaps of the whole item, of its question and of its answer."""
    return overlaps[0] >= OVERLAP or min(overlaps[1:]) >= OVERLAP


RESULT = "doc_id long, item_id long, score double, own_score double, question_overlap double, answer_overlap double"


def with_statistics(benchmark: DataFrame) -> tuple[DataFrame, int, float]:
    """(item_id, text, terms, df) of the items, with the number of pieces in the whole benchmark that hold each of an item's terms; the number of
    pieces, and their mean length.  The statistics are aggregated by term, so they do not depend on how the items are dealt to indexes."""
    items = keyed(benchmark.select("item_id", "text").filter(F.col("text").isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, at, text in zip(*(c.to_pylist() for c in b.columns)):
                found = list(pieces_of(words(text)))
                held = Counter(w for p in found for w in set(p))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * (len(held) + 1), t) for x, t in ((file, pa.int64()), (at, pa.int64()))]
                    + [pa.array([None, *held], pa.binary()), pa.array([len(found), *held.values()], pa.int64()), pa.array([sum(map(len, found)), *[0] * len(held)], pa.int64())],
                    names=["file", "at", "term", "n", "length"],
                )

    held = cut(items.select("file", "at", "text").mapInArrow(run, "file long, at long, term binary, n long, length long"))
    pieces, length = held.filter("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).collect()[0]
    df = held.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
    own = held.filter("term IS NOT NULL").select("file", "at", "term").join(df, "term").groupBy("file", "at").agg(F.collect_list(F.struct("term", "df")).alias("known"))
    told = items.join(own, ["file", "at"]).select("item_id", "text", "known")  # an item without words is never found
    return cut(told), pieces, length / max(1, pieces)


def chunks(items: Iterator, limit: int) -> Iterator[list]:
    got, size = [], 0
    for r in items:
        if got and size + len(r.text) > limit:
            yield got
            got, size = [], 0
        got.append(r)
        size += len(r.text)
    if got:
        yield got


Part = tuple[list[tuple[int, str]], Statistics]


def parts(benchmark: DataFrame, limit: int) -> Iterator[tuple[Part, bool]]:
    """The benchmark in parts of at most ``limit`` characters (or one item) with the statistics of the whole, and whether a part is the last; one part is held at a time."""
    told, n, mean = with_statistics(benchmark)
    before = None
    for rows in chunks(told.toLocalIterator(), limit):
        if before is not None:
            yield before, False
        before = [(r.item_id, r.text) for r in rows], Statistics(n, mean, {bytes(x.term): x.df for r in rows for x in r.known})
    if before is not None:
        yield before, True


class Asked:
    """The index of a broadcast part, built once a worker."""

    def __init__(self, docs: DataFrame, part: Part):
        self.spread, self.held = docs.sparkSession.sparkContext.broadcast(part), []

    def __getstate__(self) -> dict:
        return {"spread": self.spread, "held": []}

    def search(self, texts: list[str]) -> list[tuple]:
        if not self.held:
            items, known = self.spread.value
            self.held.append(BenchmarkIndex(items, known=known))
        return self.held[0].search(texts)


def contaminated(docs: DataFrame, benchmark: DataFrame, limit: int = INDEX_CHARS) -> DataFrame:
    """The (document, item) pairs of ``docs(doc_id, text)`` and ``benchmark(item_id, text)`` that are confirmed.

    An index holds at most ``limit`` characters of items (or one item); a larger benchmark takes several indexes, each asked with all
    documents: one after the other, so that the driver and the tasks never hold more than one.  All use the statistics of the whole
    benchmark, so the result is the same for every ``limit``.
    """
    shape = pa_schema(RESULT, docs)

    def ask(asked: Asked) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, texts in slices(batches):
                hits = asked.search(texts)
                if hits:
                    columns = list(zip(*hits))
                    columns[0] = [ids[k] for k in columns[0]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, shape)], schema=shape)

        return docs.select("doc_id", "text").mapInArrow(run, RESULT)

    found = docs.sparkSession.createDataFrame([], RESULT)
    for k, (part, last) in enumerate(parts(benchmark, limit)):
        asked = Asked(docs, part)
        if last and not k:
            return ask(asked)
        found = found.unionByName(cut(ask(asked)))
        asked.spread.destroy()
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame, limit: int = INDEX_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; each row is judged where it lies, so none is moved."""
    at = docs.columns.index("text")

    def drop(asked: Asked):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                done = 0
                for ids, texts in slices(iter([pa.RecordBatch.from_arrays([pa.array(range(b.num_rows)), b.column(at)], names=["row", "text"])])):
                    gone = {hit[0] for hit in asked.search(texts)}
                    part = b.slice(done, len(ids))
                    done += len(ids)
                    yield part.filter(pa.array([k not in gone for k in range(len(ids))], pa.bool_())) if gone else part

        return run

    for part, last in parts(benchmark, limit):
        asked = Asked(docs, part)
        left = docs.mapInArrow(drop(asked), docs.schema)
        if last:
            return left
        docs = cut(left)
        asked.spread.destroy()
    return docs


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document that holds an item: doc_id, its items, and the best score."""
    return contaminated(docs, benchmark).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("score").alias("score"))
