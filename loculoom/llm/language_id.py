"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

The n-grams (1 to 3 characters of the lower-cased text, white space as one mark) of a whole text are hashed to
``BUCKETS`` features.  Document frequencies are counted over all learning documents; the weights are fitted by
follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties on a sample of rows whose number is bounded: about
``SAMPLE_PER_LANG`` learning documents of each language, drawn by a hash of the row's place in the table's files, ``SAMPLE_ROWS`` in all (of
many languages each has a smaller share, but not less than about ``LEAST_PER_LANG`` documents).  Every language is learned, and a sampled document
with all its n-grams; repeated rows are drawn one by one, and a table that is read again gives the same sample.  A part of the sample is not fitted; it sets the temperature that calibrates the probabilities.
The weights take BUCKETS numbers a language.

Defined results: ``und`` with score 0 if a text is null or has no letter, or if nothing could be learned; otherwise the
language with the highest probability, ties to the first by code point.  Repeated rows give repeated results; an empty
table gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, fresh, keyed, map_texts

BUCKETS, GRAMS = 1 << 14, 3
SAMPLE_PER_LANG, LEAST_PER_LANG, SAMPLE_ROWS, EPOCHS = 600, 20, 24_000, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: A filtering stage keeps languages of at least this share of the learning documents, predicted with at least this probability.
LEAST_SHARE, SURE = 0.01, 0.4
#: A letter is a code point of the category L; numbers such as fractions and circled digits are none.
LETTER = regex.compile(r"\p{L}")
PIECE = 1 << 20


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the character n-grams of a whole text, long texts in overlapping pieces."""
    total = np.zeros(BUCKETS, np.int64)
    text = f" {' '.join(text.lower().split())} "
    for a in range(0, len(text), PIECE):
        codes = np.frombuffer(text[max(0, a - GRAMS + 1) : a + PIECE].encode("utf-32-le", "replace"), np.uint32)
        fresh = 0 if a == 0 else GRAMS - 1
        h, grams = np.zeros(len(codes), np.uint32), []
        for n in range(1, GRAMS + 1):
            # an n-gram counts where it ends
            h = h[: len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1 :]
            grams.append(h[max(0, fresh - n + 1) :] + np.uint32(n * 0x3C6EF372 % 2**32))
        total += np.bincount((np.concatenate(grams) * np.uint32(0x9E3779B1)) >> np.uint32(18), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


def has_letter(text: str) -> bool:
    return LETTER.search(text) is not None


class Model:
    """Weights (features by classes), IDF, classes and temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf = langs, idf.astype(np.float32)
        self.weights = np.zeros((BUCKETS + 1, len(langs)), np.float32)
        self.temperature = 1.0
        #: Share of each language of the learning documents.
        self.shares: dict[str, float] = {}

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = np.log1p(n).astype(np.float32) * self.idf[at]
        return x / (np.sqrt((x * x).sum()) + 1e-9)

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.vector(at, n) @ self.weights[at] + self.weights[BUCKETS]

    def probabilities(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return softmax(self.logits(at, n).astype(np.float64) / self.temperature)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> None:
        """FTRL-proximal: z and n per weight, weights in closed form under L1 and L2."""
        z, g2 = (np.zeros((BUCKETS + 1, len(self.langs)), np.float64) for _ in range(2))
        for epoch in range(epochs):
            for k in np.random.default_rng(epoch).permutation(len(rows)).tolist():
                at, n, y = rows[k]
                x = np.append(self.vector(at, n), 1.0).astype(np.float64)
                at = np.append(at, BUCKETS)
                w = closed(z[at], g2[at])
                p = softmax(x @ w)
                p[y] -= 1.0
                g = x[:, None] * p
                z[at] += g - (np.sqrt(g2[at] + g * g) - np.sqrt(g2[at])) / ALPHA * w
                g2[at] += g * g
        self.weights = closed(z, g2).astype(np.float32)

    def calibrate(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """The temperature with the least log loss on rows that were not fitted, by golden section on its logarithm."""
        if not rows:
            return
        logits, y = np.array([self.logits(a, n) for a, n, _ in rows], np.float64), np.array([r[2] for r in rows])

        def loss(t: float) -> float:
            s = logits / math.exp(t)
            s -= s.max(1, keepdims=True)
            return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

        a, b, ratio = -3.0, 3.0, (math.sqrt(5) - 1) / 2
        for _ in range(40):
            c, d = b - ratio * (b - a), a + ratio * (b - a)
            a, b = (a, d) if loss(c) <= loss(d) else (c, b)
        self.temperature = math.exp((a + b) / 2)

    def predict(self, text: str) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        p = self.probabilities(*features(text))
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max())
    return e / e.sum()


def closed(z: np.ndarray, g2: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(g2)) / ALPHA + L2))


def train(learn: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on ``learn(doc_id, text, lang)``, whose text and lang are not null."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(BUCKETS + 1, np.int64), 0
        for b in batches:
            for t in b.column(0):
                df[features(t.as_py())[0]] += 1
                rows += 1
        df[BUCKETS] = rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(df[at], pa.int64())})

    df = np.zeros(BUCKETS + 1)
    for r in learn.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r.bucket] = r.n
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1.0
    langs = {r.lang: r.n for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(langs)
    if not names:
        return Model([], idf)
    quota = max(LEAST_PER_LANG, min(per_lang, SAMPLE_ROWS // len(names)))
    # a row comes in by a hash of its place, with the share that its language needs: copies one by one, and no language meets in one task
    file, at = fresh(learn, "file"), fresh(learn, "at")
    shares = learn.sparkSession.createDataFrame([(k, min(1.0, quota / n)) for k, n in langs.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64(F.lit("sample"), file, at), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = keyed(learn, file, at).withColumn("draw", draw).join(F.broadcast(shares), "lang").filter(F.col("draw") < F.col("share")).select("doc_id", "lang", "text")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                at, n = features(t.as_py())
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([i], pa.int64()), "lang": [lang], "at": [at.astype(np.uint16).tobytes()], "n": [n.astype(np.uint32).tobytes()]})

    got = sample.mapInArrow(collect, "doc_id long, lang string, at binary, n binary").toLocalIterator()
    number = {k: i for i, k in enumerate(names)}
    rows = sorted(((r.doc_id or 0, number[r.lang], np.frombuffer(r.at, np.uint16), np.frombuffer(r.n, np.uint32)) for r in got), key=lambda r: (r[0], r[1], r[3].tobytes(), r[2].tobytes()))
    rows = [(at, n, y) for _, y, at, n in rows]
    model = Model(names, idf)
    model.shares = {k: n / sum(langs.values()) for k, n in langs.items()}
    fitted, kept = [r for k, r in enumerate(rows) if k % 5], [r for k, r in enumerate(rows) if k % 5 == 0]
    model.fit(fitted or rows)
    model.calibrate(kept)
    return model


def learning_documents(docs: DataFrame, fold: int = 4, held: int = 2) -> DataFrame:
    return docs.select("doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod("doc_id", fold) != held))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs(doc_id, text)``."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        got = [spread.value.predict(t) for t in texts]
        return {"doc_id": ids, "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return map_texts(docs, each, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame, fold: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs(doc_id, text, lang)``; the fold ``held`` is not learned from."""
    return predicted(docs, train(learning_documents(docs, fold, held))).select("doc_id", (crc_mod("doc_id", fold) == held).alias("held_out"), "lang_pred", "score")


def wanted_languages(model: Model, least_share: float = LEAST_SHARE) -> list[str]:
    """The languages that a corpus is taken to be meant in: those of at least so much of its learning documents."""
    return [k for k in model.langs if model.shares.get(k, 1.0) >= least_share]


def identified(docs: DataFrame, model: Model, wanted: list[str] | None = None, sure: float = SURE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose predicted language is one of ``wanted`` (by default ``wanted_languages``) with a calibrated
    probability of at least ``sure``.  No row is moved.

    Texts without a letter are in no language.  Where none could be learned, rows with a letter stay."""
    spread = docs.sparkSession.sparkContext.broadcast((model, set(wanted_languages(model) if wanted is None else wanted)))
    at = docs.columns.index("text")

    def told(text: str) -> bool:
        model, names = spread.value
        if not model.langs:
            return has_letter(text)
        lang, score = model.predict(text)
        return lang in names and score >= sure

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([told(t.as_py() or "") for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
