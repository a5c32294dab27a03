"""Language-model scores: marginal likelihood over a subword lattice.

An existing subword vocabulary gives the pieces.  Its stored scores rank the pieces' merges; their order drives the
library's own segmentation, whose counts over all training words turn the scores into unigram log probabilities (add
one, so each piece, byte piece and the end has some).  The probability of a word is the sum over all its
segmentations: a forward recursion over the lattice in log space (a scaled mantissa with a separate log).  Pieces never
span a word's start, so a text's log probability is the sum over its words and its end.

Words are counted over all training documents.  The lattice runs once per distinct word, in the word table; the most
frequent words (``head`` of them, of bounded length) are broadcast, all other words of a document are joined to the
table, so no word is dropped and a word that is everywhere never meets in one task.

Defined results: null or empty text is the end alone; A-Z is lower-cased; with no training documents N = V = 0, every
token is unknown, the base gives each log10(1/1) = 0 and pieces are uniform; repeated rows give repeated results; an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut, pa_schema, slices

HEAD, HEAD_CHARS = 200_000, 64
#: Distinct words that a task counts before it passes the counts on, and their bytes together.
LOCAL_WORDS, LOCAL_BYTES = 400_000, 64 << 20
START = "▁"
#: Words of at most this length are scored together.  The piece table's hash.
TOGETHER, SLOTS, SHIFT, FACTOR, SPREAD = 64, 1 << 20, 44, 0x5851F42D4C957F2D, 0x9E3779B97F4A7C15


def words(text: str) -> list[bytes]:
    """The words of a text in UTF-8: A-Z lower-cased, cut at space and U+0009 to U+000D alone (as bytes do both)."""
    return text.encode("utf-8").lower().split()


@functools.lru_cache(maxsize=2)
def pieces(path: str):
    """(library, pieces by text, byte pieces, number of pieces) of a sentencepiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
    return sp, plain, byte, n


class Lattice:
    """log10 of the summed probability of all segmentations of a word."""

    def __init__(self, path: str, counts: dict[int, int], ends: int):
        _, plain, byte, _ = pieces(path)
        total = sum(counts.values()) + ends + len(plain) + len(byte) + 1
        self.p = {t: (counts.get(i, 0) + 1) / total for t, i in plain.items()}
        self.byte = {b: (counts.get(i, 0) + 1) / total for b, i in byte.items()}
        self.end = math.log10((ends + 1) / total)
        self.longest = max(map(len, self.p), default=1)
        self.table()

    def table(self) -> None:
        """The pieces' log probabilities in an open-addressing table by 64-bit hash."""
        codes: dict[int, float] = {}
        for t, q in self.p.items():
            h = 0
            for c in t:
                h = (h * FACTOR + ord(c) + 1) % 2**64
            codes[h] = math.log(q)
        assert len(codes) == len(self.p), "two pieces have one hash"
        self.key, self.val = np.zeros(SLOTS, np.uint64), np.full(SLOTS, -np.inf)
        self.reach = 1
        for h, q in codes.items():
            at, k = (h * SPREAD % 2**64) >> SHIFT, 1
            while self.key[at]:
                at, k = (at + 1) % SLOTS, k + 1
            self.key[at], self.val[at], self.reach = h, q, max(self.reach, k)

    def look(self, h: np.ndarray) -> np.ndarray:
        at = ((h * np.uint64(SPREAD)) >> np.uint64(SHIFT)).astype(np.int64)
        out = np.where(self.key[at] == h, self.val[at], -np.inf)
        for k in range(1, self.reach):
            rest = np.flatnonzero(np.isneginf(out))
            rest = rest[self.key[at[rest] + k - SLOTS] != 0]
            if not len(rest):
                break
            slot = (at[rest] + k) % SLOTS
            out[rest] = np.where(self.key[slot] == h[rest], self.val[slot], -np.inf)
        return out

    def score_many(self, words: list[str]) -> np.ndarray:
        """``score`` of each word; short words of a length go through the recursion together."""
        out = np.empty(len(words))
        length = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(length).tolist():
            of = np.flatnonzero(length == n)
            if n > TOGETHER:
                out[of] = [self.score(words[i]) for i in of.tolist()]
                continue
            for k in range(0, len(of), 4096):
                part = of[k : k + 4096]
                text = np.frombuffer("".join([START + words[i] for i in part.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32)
                out[part] = self.forward(text.reshape(len(part), n + 1))
        return out

    def forward(self, text: np.ndarray) -> np.ndarray:
        rows, n = text.shape
        chars, place = np.unique(text, return_inverse=True)
        alone = np.array([-np.inf if chr(c) in self.p else sum(math.log(self.byte[b]) for b in chr(c).encode("utf-8")) for c in chars.tolist()])[place.reshape(text.shape)]
        alpha = np.full((n + 1, rows), -np.inf)
        alpha[0] = 0.0
        terms: list[list[np.ndarray]] = [[] for _ in range(n + 1)]
        step = text.astype(np.uint64) + np.uint64(1)
        for i in range(n):
            if i:
                got = np.stack(terms[i])
                top = got.max(0)
                safe = np.where(np.isneginf(top), 0.0, top)
                with np.errstate(divide="ignore"):
                    alpha[i] = safe + np.log(np.exp(got - safe).sum(0))
                terms[i] = []
            h = np.zeros(rows, np.uint64)
            terms[i + 1].append(alpha[i] + alone[:, i])
            for j in range(i, min(n, i + self.longest)):
                h = h * np.uint64(FACTOR) + step[:, j]
                terms[j + 1].append(alpha[i] + self.look(h))
        got = np.stack(terms[n])
        top = got.max(0)
        return (top + np.log(np.exp(got - top).sum(0))) / math.log(10)

    def score(self, word: str) -> float:
        s, p, longest = START + word, self.p, self.longest
        n = len(s)
        alpha, log = [0.0] * (n + 1), 0.0
        alpha[0] = 1.0
        for i in range(n):
            a = alpha[i]
            if a == 0.0:
                continue
            if a < 1e-200:  # rescale all that later positions can still see
                for j in range(i, min(n, i + longest) + 1):
                    alpha[j] /= a
                log += math.log10(a)
                a = 1.0
            if s[i] not in p:
                q = a
                for b in s[i].encode("utf-8", "replace"):
                    q *= self.byte[b]
                alpha[i + 1] += q
            for j in range(i + 1, min(n, i + longest) + 1):
                if (q := p.get(s[i:j])) is not None:
                    alpha[j] += a * q
        return math.log10(alpha[n]) + log


def count_words(docs: DataFrame, train) -> DataFrame:
    """word and c, its count in training texts (0: only elsewhere), over all texts of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        others: set = set()
        held = 0

        def out() -> pa.RecordBatch:
            keys = [*seen, *(others - seen.keys())]
            got = pa.RecordBatch.from_pydict({"word": pa.array(keys, pa.binary()).cast(pa.string()), "c": pa.array([seen.get(k, 0) for k in keys], pa.int64())})
            seen.clear()
            others.clear()
            return got

        for b in batches:
            for t, learns in zip(b.column(0), b.column(1).to_pylist()):
                tokens = words(t.as_py() or "")
                (seen if learns else others).update(tokens)
                # at most what the text adds: short words repeat, long ones hardly do
                held += sum(len(w) for w in tokens if len(w) > TOGETHER)
                if len(seen) + len(others) > LOCAL_WORDS or held > LOCAL_BYTES:
                    yield out()
                    held = 0
        yield out()

    counted = docs.select("text", train.alias("train")).mapInArrow(run, "word string, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def piece_counts(table: DataFrame, path: str) -> dict[int, int]:
    """Counts of pieces over all training words, each cut as the library cuts it.  At most one row a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, _, _, n = pieces(path)
        total = np.zeros(n, np.float64)
        for b in batches:
            for k in range(0, b.num_rows, 20_000):
                part = b.slice(k, 20_000)
                ids = sp.encode(part.column(0).to_pylist(), num_threads=1)
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((x for per in ids for x in per), np.int64, int(lengths.sum()))
                total += np.bincount(flat, weights=np.repeat(part.column(1).to_numpy().astype(np.float64), lengths), minlength=n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(at, pa.int64()), "n": pa.array(total[at].astype(np.int64), pa.int64())})

    got = table.filter("c > 0").select("word", "c").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r.piece: r.n for r in got.collect()}


def lattice_scores(docs: DataFrame, path: str, fold: int = 7, held: int = 2, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    train = crc_mod("doc_id", fold) != held
    table = cut(count_words(docs, train))
    ends = docs.filter(train).count()
    sums = table.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).collect()[0]
    n, v = sums.n + ends, sums.v + (ends > 0)
    floor = n + 1 * (v + 1)
    spread = spark.sparkContext.broadcast((piece_counts(table, path), ends))
    model: dict[int, Lattice] = {}

    def lattice() -> Lattice:
        if 0 not in model:
            model[0] = Lattice(path, *spread.value)
        return model[0]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = lattice().score_many
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(many(b.column(0).to_pylist()), pa.float64())], names=["word", "c", "lp"])

    scored = cut(table.select("word", "c").mapInArrow(score, "word string, c long, lp double"))
    top = spark.sparkContext.broadcast({r.word: (r.c, r.lp) for r in scored.filter(F.length("word") <= HEAD_CHARS).orderBy(F.desc("c"), "word").limit(head).toLocalIterator()})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document what the head words give, and its other words with their counts."""
        known = {w.encode("utf-8"): (c > 0, math.log10((c + 1) / floor), lp) for w, (c, lp) in top.value.items()}
        end = (ends > 0, math.log10((ends + 1) / floor) if floor > 0 else 0.0, lattice().end)
        for ids, texts in slices(batches):
            out: list = [[] for _ in range(5)]
            for i, t in zip(ids, texts):
                tf = Counter(words(t))
                size, have, base, own, rest = 1, int(end[0]), end[1], end[2], []
                for w, k in tf.items():
                    size += k
                    got = known.get(w)
                    if got is None:
                        rest.append((w, k))
                    else:
                        have += k * got[0]
                        base += k * got[1]
                        own += k * got[2]
                for x, y in zip(out, (size, have, base, own, rest)):
                    x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(ids, shape.field(0).type), *(pa.array(x, shape.field(k + 1).type) for k, x in enumerate(out))], schema=shape)

    ddl = "doc_id long, size long, known long, base double, own double, rest array<struct<word:binary,k:long>>"
    shape = pa_schema(ddl, docs)
    ids = docs.select("doc_id", "text")
    parts = cut(ids.mapInArrow(split, ddl).withColumn("row", F.monotonically_increasing_id()))
    rest = parts.select("row", F.explode("rest").alias("w")).select("row", F.col("w.word").cast("string").alias("word"), "w.k")
    log = F.log10((F.col("c") + 1) / F.lit(float(floor)))
    found = rest.join(scored, "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known2"), F.sum(F.col("k") * log).alias("base2"), F.sum(F.col("k") * F.col("lp")).alias("own2")
    )
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    return parts.drop("rest").join(found, "row", "left").select(
        "doc_id", (crc_mod("doc_id", fold) == held).alias("held_out"), F.col("size").alias("n_tokens"), (F.col("known") + more("known2")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + more("base2")).alias("base_score"), (F.col("own") + more("own2")).alias("score"),
    )
