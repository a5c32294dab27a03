"""Repeated passages against SQL and brute force."""

import random

import duckdb
import numpy as np
import pytest

from loculoom.llm import substring_dedup as sd

SPLIT = " \t\n\x0b\x0c\r"


def brute(rows, window=20):
    """Rows (doc_id, text) in the order of the table; of one doc_id the first comes first."""
    table = str.maketrans(SPLIT, " " * len(SPLIT))
    words = [[w for w in (t or "").translate(table).split(" ") if w] for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, gone = set(), [set() for _ in rows]
    for k in order:
        for i in range(len(words[k]) - window + 1):
            key = tuple(words[k][i : i + window])
            if key in seen:
                gone[k] |= set(range(i, i + window))
            seen.add(key)
    return sorted(((r[0], len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for r, w, g in zip(rows, words, gone)), key=repr)


def told(spark, rows, **how):
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, file int, at int, block string").coalesce(1)
    return sorted(map(tuple, sd.without_repeats(docs, **how).collect()), key=repr)


def passages(seed, n=60, vocabulary=400):
    pick = random.Random(seed)
    words = lambda k: [f"w{pick.randint(0, vocabulary)}" for _ in range(k)]
    common = [words(pick.randint(15, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(pick.randint(1, 4)):
            text += words(pick.randint(0, 40))
            p = pick.choice(common)
            a, b = sorted((pick.randint(0, len(p)), pick.randint(0, len(p))))
            text += p if pick.random() < 0.5 else p[a:b]
        rows.append((i * 3 % n, pick.choice([" ", "\n", "\t \r\n"]).join(text)))
    return rows


ODD = [(None, None), (1, None), (2, ""), (3, " \n\t"), (5, " ".join("abc"[i % 3] for i in range(100))), (6, "a " * 19), (7, "a " * 20), (8, "a " * 21), (9, "é x\x85 " * 12), (9, "é x\x85 " * 25)]


@pytest.mark.parametrize("how", [{}, {"shard_words": 200}, {"shard_words": 60, "broadcast_bytes": 0}, {"broadcast_bytes": 0}])
def test_brute_force(spark, how):
    rows = passages(1) + ODD + [(70, passages(1)[4][1])] * 3 + [(None, passages(1)[7][1])] * 2 + [(4, passages(2)[0][1])]
    assert told(spark, rows, **how) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_small_windows(spark, seed):
    """Windows of 4 words with anchors of 2 over few words: everything overlaps."""
    rows = passages(seed, 40, 12)
    assert told(spark, rows, window=4, anchor=2, shard_words=300) == brute(rows, 4)


def test_empty(spark):
    assert told(spark, []) == [] and told(spark, [(1, None), (2, "one two")]) == [(1, 0, 0, ""), (2, 2, 0, "one two")]


def test_given_tables(spark):
    for sf, how in (("sf0.001", {}), ("sf0.001", {"shard_words": 100, "broadcast_bytes": 0}), ("sf0.01", {})):
        path = f"/root/testdata/{sf}/documents.parquet"
        got = sorted(map(tuple, sd.repeat_digest(sd.without_repeats(spark.read.parquet(path), **how)).collect()))
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
        assert got == sorted(con.execute(sd.SQL).fetchall())
        assert any(r[2] for r in got)


def test_every_window_has_one_anchor_by_its_content():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 50, 3000).astype(np.uint64)
    for window, anchor in ((20, 5), (20, 8), (7, 7), (9, 2)):
        phrases, of = sd.anchors(words, window, anchor)
        seen: dict = {}
        for s, p in enumerate(of.tolist()):
            assert s <= p <= s + window - anchor and phrases[p] >> np.uint64(20) == phrases[s : s + window - anchor + 1].min() >> np.uint64(20)
            assert seen.setdefault(tuple(words[s : s + window].tolist()), p - s) == p - s
    assert len(np.unique(sd.anchors(words, 20, 5)[1])) < 3000 / 6


def test_words():
    texts = [b"", b"  ", b"one", b" two \t\n one\x0b\x0cthree\r", "é x\x85y".encode(), b"w" * 64, b"w" * 65 + b" one " + b"v" * 300, b"one"]
    words = sd.Words(texts)
    want = [w for t in texts for w in t.split()]
    assert words.counts.tolist() == [len(t.split()) for t in texts]
    assert [words.data[a:b] for a, b in zip(words.begin.tolist(), words.end.tolist())] == want
    assert len(set(words.hash.tolist())) == len(set(want)) and len({(w, h) for w, h in zip(want, words.hash.tolist())}) == len(set(want))
    assert not len(sd.Words([]).hash) and not len(sd.Words([b""]).hash)
