"""Operators over many documents against SQL or brute force, with odd rows and empty tables."""

import itertools

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from loculoom.llm import decontaminate, exact_dedup, language_id, line_dedup, mixing, near_dedup


def same(df, docs, sql):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    columns = sorted(df.columns)
    got = sorted(map(tuple, df.select(columns).collect()), key=repr)
    want = sorted(map(tuple, con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()), key=repr)
    assert got == want


def test_exact(odd, small, empty):
    for docs in (odd, small, empty):
        same(exact_dedup.exact_duplicates(docs), docs, exact_dedup.SQL)
    same(exact_dedup.exact_duplicates(small, limit=5_000), small, exact_dedup.SQL)  # subtrees spill


def test_trie():
    rng = np.random.default_rng(0)
    keys = [bytes(rng.integers(97, 100, rng.integers(0, 9)).astype(np.uint8)) for _ in range(3000)]
    for limit in (1 << 30, 2_000):
        got: dict = {}
        for k, o in exact_dedup.owners(((k, (i // 2, i, 1)) for i, k in enumerate(keys)), limit):
            got[k] = exact_dedup.merged(got[k], o) if k in got else o
        last = {k: i for i, k in enumerate(keys)}
        assert got == {k: (last[k] // 2, last[k], keys.count(k)) for k in set(keys)}
    assert exact_dedup.merged((None, 9, 1), (-5, 2, 1)) == (-5, 2, 2) and exact_dedup.merged((3, 1, 1), (3, 7, 2)) == (3, 7, 3)


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_copies_leave_one_row(spark):
    rows = [(None, "hello there"), (1, "A"), (1, "B"), (2, "a"), (2, "a"), (None, "B"), (None, "z"), (None, "Z"), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, row long, keep_row long").repartition(3)
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    got = texts_of(left)
    assert [x for x in got if x[1] not in ("z", "Z")] == sorted([(None, "hello there"), (1, "B"), (2, "a"), (4, "")], key=repr) and len(got) == 5


def test_lines(odd, small, empty, spark):
    line = "A line that is repeated in many documents, long enough"
    docs = spark.createDataFrame([(i, f"x{i}\n  {line.upper() if i % 2 else line}\t\n{line}\ntail", "l", "s", 0) for i in range(7)], small.schema)
    for d in (docs, small, empty):
        same(line_dedup.line_digest(line_dedup.repeated_lines(d)), d, line_dedup.SQL)
        same(line_dedup.line_digest(line_dedup.repeated_lines(d, broadcast_bytes=0)), d, line_dedup.SQL)  # hashes are routed to shards
    assert line_dedup.repeated_lines(odd).count() == odd.count()


def brute_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower()
    held: dict = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(i)
    gone = {k: max(ids - {None}) for k, ids in held.items() if len(k.decode()) >= 40 and len(ids - {None}) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if gone.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_lines_of_repeated_rows(spark):
    a, b = "one line that five rows of a document hold, again", "another line, which five documents hold, by ids"
    rows = [(1, a)] * 5 + [(2, a + "\n" + b)] + [(i, f"{b}\nx") for i in (3, 4, 5, 6, 6)] + [(6, "second text of six\n " + b.upper()), (None, b), (None, b), (7, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row long, hi long").repartition(3)
    for limit in (1 << 20, 0):
        got = line_dedup.repeated_lines(docs, broadcast_bytes=limit).select("doc_id", "n_lines", "n_dropped", "text").collect()
        assert sorted(map(tuple, got), key=repr) == brute_lines(rows)


def test_ranked_bits():
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 513, 5000):
        bits = rng.random(n) < 0.4
        hit, rank = line_dedup.RankedBits(bits).look(np.arange(n))
        assert (hit == bits).all() and (rank == np.cumsum(bits) - bits).all()


def test_perfect_hash():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(2**62), 2**62, 5000), rng.integers(-(2**62), 2**62, 5000)
    hi[10] = hi[11]  # equal first halves
    shard = line_dedup.Shard(hi, lo, np.full(5000, 9), np.arange(5000))
    assert sorted(shard.hash.index(np.unique(hi).view(np.uint64)).tolist()) == list(range(4999))
    found, owner = shard.probe(hi, lo)
    assert found.all() and (owner == np.arange(5000)).all()
    assert not shard.probe(rng.integers(-(2**62), 2**62, 5000), lo)[0].any() and not shard.probe(hi, lo + 1)[0].any()


def test_mixing(odd, small, empty, spark):
    for docs in (odd.dropDuplicates(["doc_id"]), small, empty):
        same(mixing.mix_digest(mixing.mixed(docs)), docs, mixing.SQL)
        same(mixing.mix_digest(mixing.mixed(docs, bucket_rows=3)), docs, mixing.SQL)
    blank = spark.createDataFrame([(1, None, "l", "s", 0), (2, "", "l", None, 0)], small.schema)
    assert [(r.target, r.taken) for r in mixing.mixed(blank).collect()] == [(0.0, 0)] * 2
    assert mixing.mixed(odd).count() == odd.count()
    mixed = mixing.mix_rows(odd.withColumn("taken", mixing.F.lit("x")))
    assert set(mixed.columns) == {*odd.columns, "taken"} and mixed.count() == mixing.mixed(odd).filter("taken > 0").count() == odd.filter("text <> ''").count()
    assert "Python" not in mixing.mixed(small)._jdf.queryExecution().toString()


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 40, None: 7}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:  # reshare the excess until none is above
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in sizes if x not in full) for s in sizes}
        more = {s for s in sizes if target[s] > 2 * sizes[s] + 1e-9}
        if not more:
            break
        full |= more
    assert got == pytest.approx(target)


def brute_shares(index, tokens):
    """Share of its threshold of every piece in every window of a text, by adding up all its terms."""
    held = [{} for _ in index.own]
    for group in index.classes:
        for key, share in zip(group.key.tolist(), group.share.tolist()):
            held[group.pieces[key % group.n]][key // group.n] = share
    out = {}
    for j in range(len(tokens) // decontaminate.PIECE + 2):
        window = {index.terms[w] for w in tokens[max(0, (j - 1) * decontaminate.PIECE) : (j + 1) * decontaminate.PIECE] if w in index.terms}
        for k, terms in enumerate(held):
            out[j, k] = sum(s for t, s in terms.items() if t in window)
    return out


def brute_contaminated(docs, items):
    out = set()
    index = decontaminate.BenchmarkIndex([(i, t) for i, t in items if t is not None])
    for d, t in docs:
        w = decontaminate.words(t or "")
        near = {}
        for (j, k), share in brute_shares(index, w).items():
            if share >= 1 - 1e-9:
                near.setdefault(index.of[k], set()).add(j)
        for k, windows in near.items():
            over = []
            for part in index.parts[k]:
                want = decontaminate.shingles(part)
                got = len(want & decontaminate.shingles(w, min(5, len(part)))) / len(want) if want else 1.0
                if len(part) < decontaminate.SHORT:
                    got = max(got, *(decontaminate.aligned(part, x) for x in index.stretches(w, windows, len(index.parts[k][0]))))
                over.append(got)
            if over[0] >= 0.8 or min(over[1:]) >= 0.8:
                out.add((d, index.items[k][0]))
    return out


def test_decontamination(odd, small, empty, spark):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    long = " ".join(f"q{i} z{i % 5}" for i in range(150)) + ". the answer is here now"
    extra = spark.createDataFrame([*items, (900, long), (901, None), (902, ""), (903, items[0][1])], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in small.collect()] + [(5000, "x " * 300 + items[1][1].upper() + " y" * 100), (5001, long), (5002, items[2][1][: len(items[2][1]) // 2]), (None, items[3][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    all_items = [(r.item_id, r.text) for r in extra.collect()]
    want = brute_contaminated(rows, all_items)
    assert (5000, items[1][0]) in want and (5001, 900) in want and (None, items[3][0]) in want
    whole = sorted(map(tuple, decontaminate.contaminated(docs, extra).collect()), key=repr)
    for limit in (decontaminate.INDEX_CHARS, 500, 3_000, 1):
        got = decontaminate.contaminated(docs, extra, limit).collect()
        # scores and all, since every index has the statistics of the whole benchmark
        assert [(*r[:2], *(pytest.approx(x) for x in r[2:])) for r in sorted(map(tuple, got), key=repr)] == whole
        assert {(r.doc_id, r.item_id) for r in got} == want and all(r.score >= decontaminate.SHARE * r.own_score - 1e-6 for r in got)
        assert texts_of(decontaminate.without_contaminated(docs, extra, limit)) == sorted([r for r in rows if r[0] not in {d for d, _ in want}], key=repr)
    assert decontaminate.contaminated(odd, extra).count() == 0 and decontaminate.contaminated(empty, extra).count() == 0
    assert decontaminate.contaminated(docs, extra.limit(0)).count() == 0 and decontaminate.without_contaminated(docs, extra.limit(0)).count() == len(rows)
    assert decontaminate.contaminated_documents(docs, extra).count() == len({d for d, _ in want})


def test_parts_propose_what_the_whole_index_proposes(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    whole, known = decontaminate.BenchmarkIndex(items), decontaminate.Statistics.of([t for _, t in items])
    told, n, mean = decontaminate.with_statistics(spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet"))
    df = {bytes(x.term): x.df for r in told.collect() for x in r.known}
    assert (n, df) == (known.n, dict(known.df)) and mean == pytest.approx(known.mean)
    split = [decontaminate.BenchmarkIndex(items[k : k + 7], known=known) for k in range(0, len(items), 7)]
    rng = np.random.default_rng(4)
    texts = []
    for _, t in items:  # edited passages, many of them near a threshold
        w = t.split()
        texts.append(" ".join(x if rng.random() < 0.7 else f"z{rng.integers(9)}" for x in w + items[int(rng.integers(len(items)))][1].split()[:20]))
    found = []
    for indexes in ([whole], split):
        got = {}
        for index in indexes:
            for d, t in enumerate(texts):
                tokens = decontaminate.words(t)
                at = np.array([k for k, w in enumerate(tokens) if w in index.terms], np.int64)
                ids = np.array([index.terms[tokens[k]] for k in at], np.int64)
                got |= {(d, index.items[index.of[k]][0]): s for (_, k), (s, _) in index.passages(ids, np.zeros(len(at), np.int64), at).items()}
        found.append(got)
    assert found[0].keys() == found[1].keys() and len(found[0]) > len(items) / 2
    assert all(found[1][k] == pytest.approx(s) for k, s in found[0].items())


def test_block_max_search_is_exhaustive_and_skips():
    rng = np.random.default_rng(12)
    weight = 1.0 / np.arange(1, 20_001)
    draw = lambda n: [f"v{k}" for k in rng.choice(20_000, n, p=weight / weight.sum())]
    items = [(i, " ".join(draw(int(rng.integers(1 if i % 50 == 0 else 30, 90))))) for i in range(10_000)]
    index = decontaminate.BenchmarkIndex(items)
    texts = [draw(120) + items[k][1].split() + draw(90) for k in range(0, 10_000, 4_000)] + [draw(300)]
    for tokens in texts:
        tokens = [w.encode() for w in tokens]
        at = np.array([k for k, w in enumerate(tokens) if w in index.terms])
        ids = np.array([index.terms[tokens[k]] for k in at])
        got = {(j, k) for (_, k), (_, windows) in index.passages(ids, np.zeros(len(at), np.int64), at).items() for j in windows}
        assert got == {key for key, share in brute_shares(index, tokens).items() if share >= 1 - 1e-9}
    assert index.counts["walked"] < index.counts["blocks"] / 10, index.counts
    whole = [items[k][0] for k in range(0, 10_000, 4_000)]
    assert set(whole) <= {hit[1] for hit in index.search([" ".join(t) for t in texts])}


def test_contamination_with_one_edited_word(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()][:40]
    index = decontaminate.BenchmarkIndex(items)
    for i, text in items:
        tokens = [w.decode() for w in decontaminate.words(text)]
        for p in range(len(tokens)):
            edited = ["qqedited" if k == p else w for k, w in enumerate(tokens)]
            assert i in {r[1] for r in index.search([" ".join(["x"] * 300 + edited + ["y"] * 100)])}, (i, p)


def test_alignment():
    rng = np.random.default_rng(9)
    for _ in range(300):
        part, text = [[bytes([97 + x]) for x in rng.integers(0, 4, rng.integers(1, n))] for n in (9, 25)]
        row = [0] * (len(text) + 1)
        for i, w in enumerate(part, 1):
            row, last = [i], row
            for j, x in enumerate(text, 1):
                row.append(min(last[j - 1] + (w != x), last[j] + 1, row[-1] + 1))
        assert decontaminate.aligned(part, text) == pytest.approx(1 - min(row) / len(part))


def brute_classes(rows):
    sets = {d: set(near_dedup.shingle_hashes(t or "").tolist()) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        i = len(sets[a] & sets[b])
        if i and i / len(sets[a] | sets[b]) >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize("blocks", [1000, 4])
def test_near_duplicates(odd, small, empty, spark, blocks):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    copies = []
    for k in range(60):  # a large group of near copies with a chain of edits
        words = list(base)
        for p in rng.integers(0, 300, 1 + k % 9):
            words[p] = f"e{rng.integers(0, 9)}"
        copies.append((10_000 + k, " ".join(words)))
    rows = [(r.doc_id, r.text) for r in small.collect()] + copies
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs, block_sets=blocks).collect()}
    assert got == brute_classes(rows)
    if blocks == 4:
        return
    classes = {r.doc_id: (r.class_id, r.kept) for r in near_dedup.near_duplicates(odd).collect()}
    assert classes[8] == (7, False) and classes[9] == (7, False) and classes[7] == (7, True) and classes[4] == (3, False) and classes[1] == (1, True) and classes[2] == (2, True)
    assert near_dedup.near_duplicates(empty).count() == 0
    few = near_dedup.near_duplicates(docs, bands=2, rows=1, block_sets=3).collect()
    assert len(few) == len(rows) and sum(r.kept for r in few) == len({r.class_id for r in few})


def test_near_duplicates_of_rows_without_ids(spark):
    rows = [(None, "a b c d e f g h"), (5, "A b c d e f g H"), (5, "another text with the same id here"), (5, "another text with the same id here"), (None, "q r s t u v"), (None, "q R s t u v"), (9, None), (9, "")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row long, cls long").repartition(3)
    got = sorted(map(tuple, near_dedup.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(None, 5, False), (5, 5, True), (5, 5, True), (5, 5, False), (None, None, True), (None, None, False), (9, 9, True), (9, 9, True)], key=repr)
    left = near_dedup.without_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(((i, (t or "").lower()) for i, t in texts_of(left)), key=repr) == sorted([(5, rows[1][1].lower()), rows[2], (None, "q r s t u v"), (9, ""), (9, "")], key=repr)


@pytest.mark.parametrize("repeats", [1, 5, 20, 100, 1000])
def test_recall_by_similarity(repeats):
    """Share of pairs with a common band, by the similarity of their sets and how often the shingles of one side repeat."""
    rng = np.random.default_rng(repeats)
    for shared, own, least in ((80, 10, 0.995), (90, 10, 0.995), (90, 5, 0.9999), (90, 2, 0.9999)):
        trials, found = 150, 0
        for _ in range(trials):
            ids = rng.integers(0, 2**63, shared + 2 * own).astype(np.uint64)
            sides = []
            for mine in (ids[shared : shared + own], ids[shared + own :]):
                shingles = np.concatenate([ids[:shared], mine])
                weight = np.concatenate([np.ones(shared), np.full(own, 1.0 + np.log(repeats))])
                doc = np.zeros(len(shingles), np.int64)
                even, uneven = (near_dedup.band_hashes(near_dedup.prob_minhash(doc, shingles, w, 1, 64), 16)[0] for w in (np.ones(len(doc)), weight))
                sides.append({*even.tolist(), *uneven.tolist()})
            found += bool(sides[0] & sides[1])
        assert shared / (shared + 2 * own) >= 0.8 and found / trials >= least - 0.01


def test_near_duplicates_with_repeated_shingles(spark):
    rng = np.random.default_rng(11)
    rows = []
    for k in range(12):  # a text, and the same with a paragraph pasted many times
        words = [f"p{k}w{i}" for i in rng.integers(0, 9000, 360)]
        rows += [(2 * k, " ".join(words[:300])), (2 * k + 1, " ".join(words[:300] + words[300:] * 50))]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows) == {d: d - d % 2 for d, _ in rows}


def test_prob_minhash_estimates_probability_jaccard():
    rng = np.random.default_rng(5)
    ids, a, b = rng.integers(0, 2**62, 60).astype(np.uint64), rng.random(60) + 0.1, rng.random(60) + 0.1
    a[:20] = 0
    b[40:] = 0
    want = sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in range(60)) for d in range(20, 40))
    sig = [near_dedup.prob_minhash(np.zeros((w > 0).sum(), np.int64), ids[w > 0], w[w > 0], 1, 4096)[0] for w in (a, b)]
    assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.03)


def test_pipeline(spark, odd, small):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == [*small.columns, "size", "taken"] and 0 < out.count() <= small.count()
    docs = odd.select(small.columns)
    left = docs
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, "/root/testdata/sf0.001")
    kept = {r.doc_id for r in left.collect()}
    # nothing but rows of these few texts is learned here, so the languages of most are guessed
    assert not kept & {1, 2, 3, 10} and len(kept & {7, 8, 9}) <= 1
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "/root/testdata/sf0.001")
    assert empty.count() == 0


def test_pipeline_against_brute_force(spark, odd, small):
    """Every stage on all rows: null ids, repeated ids with equal and with different texts, clashing columns."""
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    rows = [tuple(r) for r in small.collect()] + [tuple(r) for r in odd.select(small.columns).collect()]
    rows += [(None, "words of a document that has no id at all", None, "s1", 0), (None, "other words of one without an id either", None, None, 0)]
    rows += [(70_001, "first text of an id that comes twice", "en", "s1", 0), (70_001, "quite another text with this same id", "en", "s1", 0), (70_002, "first text of an id that comes twice", "en", "s1", 0)]
    rows += [(None, items[0][1], "en", "s1", 0)] + [(70_010 + k, " ".join(f"n{i}" for i in range(40)) + f" end{k}", "en", None, 0) for k in range(3)]
    docs = near_dedup.cut(spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, row long, kept long").repartition(3))

    # the first stage by its model, row by row
    model = language_id.train(language_id.learning_documents(docs))
    kept = [k for k in model.langs if model.shares[k] >= 0.01]
    told = [model.predict(r[1] or "") for r in rows]
    left = [r for r, (lang, score) in zip(rows, told) if lang in kept and score >= 0.4]
    best: dict = {}
    for r in left:
        k = r[1].encode().lower()
        if k not in best or (r[0] is not None, r[0] or 0) > (best[k][0] is not None, best[k][0] or 0):
            best[k] = r
    left = list(best.values())
    classes: dict = {}
    for k, root in brute_classes(list(enumerate(r[1] for r in left))).items():
        classes.setdefault(root, []).append(left[k])
    left = [min(c, key=lambda r: (r[0] is None, r[0] or 0)) for c in classes.values()]
    gone = {k for k, _ in brute_contaminated(list(enumerate(r[1] for r in left)), items)}
    left = [r for k, r in enumerate(left) if k not in gone]

    got = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = near_dedup.cut(stage(spark, got, "/root/testdata/sf0.001"))
        assert got.columns == docs.columns, name
    drop = lambda r: (r[0], (r[1] or "").lower())
    assert sorted(map(drop, got.collect()), key=repr) == sorted(map(drop, left), key=repr)
    mixed = corpus_pipeline.STAGES[-1][1](spark, got, "/root/testdata/sf0.001")
    assert mixed.columns == [*docs.columns, "size", "taken"]
    con = duckdb.connect()
    con.register("documents", got.select("doc_id", "text", "source").toArrow())
    want = con.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL}) WHERE taken > 0").fetchall()
    assert sorted((tuple(r) for r in mixed.select("doc_id", "size", "taken").collect()), key=repr) == sorted(want, key=repr)


def test_language_stage_where_nothing_is_learned(spark):
    docs = spark.createDataFrame([(1, "words", None), (2, "12 34", None), (None, "more words", None), (3, None, None)], "doc_id long, text string, lang string")
    assert texts_of(corpus_pipeline.keep_languages(spark, docs, "")) == [(1, "words"), (None, "more words")]
