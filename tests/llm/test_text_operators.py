"""Row-wise operators against their libraries or brute force, with odd rows and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from loculoom.llm import language_id, lattice_lm, licences, pii, queries, token_count
from loculoom.llm.common import cut

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def rows(df):
    return [r for r in df.select("doc_id", "text").collect()]


def test_token_counts(odd, small, empty):
    library = Tokenizer.from_file(WORDS)
    for docs in (odd, small):
        texts = rows(docs)
        want = Counter((r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 2048) for r in texts)
        assert Counter(map(tuple, token_count.token_counts(docs, WORDS).collect())) == want
    assert token_count.token_counts(empty, WORDS).count() == 0


def test_token_chunks_compose():
    c, library = token_count.compiled(WORDS), Tokenizer.from_file(WORDS)
    random.seed(5)
    pieces = ["the", "ing", "'s", "'", "'r", "'ll", "l", "re", " ", "\n", "é", "1", "!", "---", "Q", "ſ", "語", "½", "<|endoftext|>"]
    for _ in range(300):
        t = "".join(random.choice(pieces) for _ in range(random.randint(0, 60)))
        want = len(library.encode(t, add_special_tokens=False).ids)
        assert c.count(t) == want and all(c.count_in_chunks(t, k) == want for k in (1, 2, 5, 17)), t


def test_maps_of_one_long_run(monkeypatch):
    c, library = token_count.compiled(WORDS), Tokenizer.from_file(WORDS)
    random.seed(8)
    monkeypatch.setattr(token_count, "STATES", 3_000)
    for t in ("".join(random.choice("abcdefghijklmnop") for _ in range(12_000)), "-" * 900 + "=!" * 700, "a" * 5_000, "'" * 900 + "s" * 10):
        want = len(library.encode(t, add_special_tokens=False).ids)
        assert c.count(t) == want and c.count_in_chunks(t, 500) == want
    assert len(c.words.keys) <= 3_000 + token_count.STRIDE + 1
    # states inside a run meet: the map of a chunk leads from all its entries to few states
    m = c.state_map("ab" * 40, "cdefgh" * 200, False)
    assert len(m.to) > 1 and len({s for s, _ in m.to.values()}) == 1


def test_scanner_on_all_code_points():
    c, library = token_count.compiled(WORDS), Tokenizer.from_file(WORDS)
    for a in range(0, 0x110000, 0x800):
        if a == 0xD800:
            continue
        t = c.normalised(" ".join(f"a{chr(k)}!{chr(k)}{chr(k)}" for k in range(a, a + 0x800)))
        assert t == library.normalizer.normalize_str(t)
        want = [t[x:y] for _, (x, y) in library.pre_tokenizer.pre_tokenize_str(t)]
        got = [t[m.start() : m.end()] for m in c.scan_marks(t.translate(c.kinds))] if c.beyond(t) else c.scan_latin(t)
        assert got == want


def test_long_texts_are_dealt_in_chunks(spark):
    library = Tokenizer.from_file(WORDS)
    random.seed(9)
    texts = ["".join(random.choice(["word", " ", "x", "'s", "1", "<|endoftext|>", "é"]) for _ in range(n)) for n in (0, 40, 700, 2_000)] + ["qwertz" * 300, "qwertz" * 300, None]
    docs = spark.createDataFrame([(k // 2 if k else None, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, row long, part long").repartition(3)
    want = Counter((k // 2 if k else None, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 50) for k, t in enumerate(texts))
    assert Counter(map(tuple, token_count.token_counts(docs, WORDS, limit=50, long=300, chunk=64).collect())) == want


def brute_score(lattice, word):
    s = lattice_lm.START + word
    total = [0.0] * (len(s) + 1)
    total[0] = 1.0
    for j in range(1, len(s) + 1):
        total[j] = sum(total[i] * lattice.p[s[i:j]] for i in range(j) if s[i:j] in lattice.p)
        if s[j - 1] not in lattice.p:
            total[j] += total[j - 1] * math.prod(lattice.byte[b] for b in s[j - 1].encode())
    return math.log10(total[-1])


@pytest.mark.parametrize("head", [200_000, 5])
def test_lattice_scores(odd, small, empty, head):
    assert lattice_lm.lattice_scores(empty, PIECES).count() == 0
    for docs in (odd, small):
        texts = rows(docs)
        held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in texts}
        split = lambda t: (t or "").encode().lower().split()
        c = Counter(w for r in texts if not held[r.doc_id] for w in [*split(r.text), None])
        n, v = sum(c.values()), len(c)
        got = lattice_lm.lattice_scores(docs, PIECES, head=head).collect()
        assert len(got) == len(texts)
        text = {r.doc_id: r.text for r in texts}
        for r in got:
            tokens = [*split(text[r.doc_id]), None]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), sum(c[w] > 0 for w in tokens), n)
            assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9)
        # the model by hand: the library cuts every training word, the pieces are counted, and each text is the sum over its words and its end
        sp, _, _, _ = lattice_lm.pieces(PIECES)
        ends = c.pop(None)
        pieces = Counter()
        for w, k in c.items():
            for i in sp.encode(w.decode()):
                pieces[i] += k
        lattice = lattice_lm.Lattice(PIECES, dict(pieces), ends)
        for r in got[:40] if len(texts) > 50 else got:
            tf = Counter(split(text[r.doc_id]))
            if max(map(len, tf), default=0) < 200:
                assert r.score == pytest.approx(lattice.end + sum(k * brute_score(lattice, w.decode()) for w, k in tf.items()), rel=1e-9)


def test_words_are_counted_in_bounded_batches(spark, monkeypatch):
    rows = [(k, " ".join(["x" * (100 + k), "y", f"z{k % 3}"])) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lattice_lm, "LOCAL_BYTES", 300)
    want = Counter(w for _, t in rows for w in t.split())
    assert {r.word: r.c for r in lattice_lm.count_words(docs, lattice_lm.F.lit(True)).collect()} == want


def test_lattice_recursion():
    lattice = lattice_lm.Lattice(PIECES, {300: 5}, 3)
    words = ["the", "unbelievable", "x", "日本", "\U0001f926x", "a" * 70, "\x00b"]
    want = [brute_score(lattice, w) for w in words]
    assert [lattice.score(w) for w in words] == pytest.approx(want) and list(lattice.score_many(words)) == pytest.approx(want)
    assert lattice.score("語" * 500) < -1000  # far below the smallest double


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and pii.luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_personal_data(odd, small, empty):
    random.seed(4)
    for _ in range(4000):
        t = "".join(random.choice("a@.1 2-+()9") for _ in range(50))
        assert [s[:3] for s in pii.find_spans(t) if s[0] in pii.BASE] == base_spans(t)
    for docs in (odd, small):
        text = {r.doc_id: r.text or "" for r in rows(docs)}
        for r in pii.pii_digest(pii.personal_data(docs)).collect():
            want = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text[r.doc_id]))
            assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and r.n_email == want.count("email")
    assert pii.personal_data(empty).count() == 0


def test_personal_data_validators():
    assert [s[0] for s in pii.find_spans("IBAN GB82 WEST 1234 5698 7654 32 today")] == ["iban"] and not pii.find_spans("GB82 WEST 1234 5698 7654 33")
    near, far = pii.find_spans("call my phone +1 (724) 555-7058")[0], pii.find_spans("x +1 (724) 555-7058")[0]
    assert near[3] > far[3]
    assert pii.find_spans("1" * 300_000 + "." + "a" * 300_000 + "@") == []  # linear on long runs


def test_accounts_before_upper_case_words():
    one, two = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    for text, want in (
        (f"{one} BIC", [one]), (f"{one} EUR 250", [one]), ("DE89 3704 0044 0532 0130 00 BIC COBADEFF", ["DE89 3704 0044 0532 0130 00"]), (f"{one} {two} EUR", [one, two]),
        (f"AB12 {one} PAID", [one]), (f"{two} {one}", [two, one]), ("NO9386011117947 THE REST OF A LINE IN UPPER CASE", ["NO9386011117947"]), ("DE88370400440532013000 BIC", []),
        ("DE89370400440532013000X", []), ("X" + one, []),
    ):
        assert [text[a:b] for k, a, b, _ in pii.find_spans(text) if k == "iban"] == want, text
    for word in (f"{chr(65 + a)}{chr(65 + b)}" for a in range(26) for b in range(26)):  # also where the longer run passes by chance
        assert [text[a:b] for text in [f"{one} {word}"] for k, a, b, _ in pii.find_spans(text) if k == "iban"] == [one]


def test_licences(odd, small, empty):
    random.seed(6)
    index = licences.LicenceIndex(licences.templates())
    brute = lambda w: sorted((label, i) for p, label in licences.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    for _ in range(1500):
        t = " ".join(random.choice("mit license apache general public gnu x permission is hereby granted".split()) for _ in range(25))
        assert sorted(index.scan(t)[1]) == brute(licences.words(t))
    for docs in (odd, small):
        text = {r.doc_id: r.text or "" for r in rows(docs)}
        for r in licences.licence_digest(licences.licence_scan(docs)).collect():
            w = licences.words(text[r.doc_id])
            found = brute(w)
            assert (r.n_words, r.n_base) == (len(w), len(found)) and 0 <= r.score <= 1
            assert (r.first_word, r.last_word) == ((min(i for _, i in found), max(i for _, i in found)) if found else (None, None))
            assert r.base_labels == ",".join(sorted({x for x, _ in found}))
    assert licences.licence_scan(empty).count() == 0


def test_whole_licences_and_their_parts():
    index = licences.LicenceIndex(licences.templates())

    def named(text: str) -> dict[str, float]:
        return index.named(*index.scan(text)[2:])

    by_label: dict = {}
    for label, text in licences.templates():
        assert named(f"some words before {text} and behind") == {label: 1.0}, label
        by_label.setdefault(label, []).append(text)
    assert set(named(by_label["mit"][0].split("conditions:")[1])) == {"mit"}  # without its grant
    assert set(named(by_label["isc"][0].split("copies.")[1])) == {"isc"}
    apache, gpl = by_label["apache"][0].split(), by_label["gpl"][2].split()
    assert set(named(" ".join(apache[700:760]))) == {"apache"} and set(named(" ".join(gpl[2000:2060]))) == {"gpl"}
    assert set(named(" ".join(apache[700:760]) + " x " + " ".join(gpl[2000:2060]))) == {"apache", "gpl"}
    edited = by_label["mit"][0].replace("modify", "alter").replace("IN NO EVENT", "NEVER")
    _, _, spans, cover = index.scan(edited)
    assert named(edited).keys() == {"mit"} and 0.9 < max(cover.values()) < 1
    assert named("permission is hereby granted to all who ask for it, and nothing else in this text is known") == {}


def test_labels_and_score_against_brute_force(spark):
    """Matching statistics from all substrings, and the best chain from all pairs of matches."""
    random.seed(13)
    words_ = "a b c d e".split()
    known = [(f"l{k % 3}", " ".join(random.choice(words_) for _ in range(random.randint(6, 14)))) for k in range(5)]
    strings = [t.split() for _, t in known]
    texts = []
    for _ in range(120):
        t = [random.choice(words_) for _ in range(random.randint(0, 12))]
        s = random.choice(strings)
        a = random.randrange(len(s))
        texts.append(" ".join([*t, *s[a : a + random.randint(3, 14)], "zz", *random.choice(strings)[: random.randint(1, 9)]]))
    min_match, passage = 3, 8
    index = licences.LicenceIndex(known, {}, min_match, 0.6, passage)
    for t in texts:
        w = t.split()
        longest = [max([k for k in range(1, i + 2) if any(w[i + 1 - k : i + 1] == s[j : j + k] for s in strings for j in range(len(s) - k + 1))], default=0) for i in range(len(w))]
        maximal = [(i, n) for i, n in enumerate(longest) if n >= min_match and not (i + 1 < len(w) and longest[i + 1] == n + 1)]
        _, _, spans, cover = index.scan(t)
        for k, s in enumerate(strings):
            at = sorted((i, e, n) for i, n in maximal for e in range(n, len(s) + 1) if s[e - n : e] == w[i + 1 - n : i + 1])
            best = []
            for j, (_, e, n) in enumerate(at):
                best.append(n + max([best[m] for m in range(j) if at[m][1] <= e - n], default=0))
            assert cover.get(k, 0.0) == pytest.approx(max(best, default=0) / len(s))
            assert sum(x[2] - x[1] for x in spans if x[0] == k) == max(best, default=0)
        long = [x for x in spans if x[2] - x[1] >= passage]
        want = {known[k][0] for k, c in cover.items() if c >= 0.6}
        want |= {known[x[0]][0] for x in long if not any(y[1] <= x[1] and x[2] <= y[2] and y[2] - y[1] > x[2] - x[1] and known[y[0]][0] != known[x[0]][0] for y in long)}
        assert set(index.named(spans, cover)) == want


def test_matching_statistics():
    random.seed(7)
    strings = [[random.randint(0, 2) for _ in range(random.randint(1, 12))] for _ in range(6)]
    a = licences.SuffixAutomaton(strings)
    query = [random.randint(0, 2) for _ in range(200)]
    state = n = 0
    for i, c in enumerate(query):
        while state and c not in a.go[state]:
            state, n = a.link[state], a.length[a.link[state]]
        state, n = (a.go[state][c], n + 1) if c in a.go[state] else (0, 0)
        held = [k for k in range(i + 2) if any(query[i + 1 - k : i + 1] == s[j : j + k] for s in strings for j in range(len(s) - k + 1))]
        assert n == max(held)


def test_languages(odd, small, empty, spark):
    assert language_id.languages(empty).count() == 0
    got = {r.doc_id: r for r in language_id.languages(odd).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 10)) and got[5].lang_pred != "und"
    lang = {r.doc_id: r.lang for r in small.collect()}
    held = [r for r in language_id.languages(small).collect() if r.held_out]
    assert held and sum(lang[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.95
    assert language_id.has_letter("½ É") and not language_id.has_letter("½ ① ² _ 7")
    none = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language_id.languages(none).collect()[0].lang_pred == "und"


def test_features_of_long_texts():
    text = "Ab cdé  fgh\n" * 60
    want = language_id.features(text)
    whole, language_id.PIECE = language_id.PIECE, 37
    try:
        got = language_id.features(text)
    finally:
        language_id.PIECE = whole
    assert (want[0] == got[0]).all() and (want[1] == got[1]).all()


@pytest.mark.parametrize("name", ["personal_data_base", "licence_places_base", "lm_base_scores", "language_folds"])
def test_base_columns_in_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_language_model_against_loops(spark, small):
    """The sample, the weights, the temperature and the score by plain loops."""
    from collections import Counter

    from pyspark.sql import functions as F

    from loculoom.llm.common import keyed

    learn = language_id.learning_documents(small.filter("n_chars < 1500"))
    model = language_id.train(learn, per_lang=20)
    rows = [(r.doc_id, r.text, r.lang, r.file, r.at, r.draw) for r in keyed(learn).withColumn("draw", F.expr(f"pmod(xxhash64('sample', file, at), {1 << 30})") / float(1 << 30)).collect()]

    def grams(text):
        text, n = f" {' '.join(text.lower().split())} ", language_id.GRAMS
        out = Counter()
        for a in range(len(text)):
            h = 0
            for k in range(min(n, len(text) - a)):
                h = (h * 0x01000193 % 2**32) ^ ord(text[a + k])
                out[((h + (k + 1) * 0x3C6EF372) * 0x9E3779B1 % 2**32) >> 18] += 1
        return out

    counts = {r[:1] + r[3:5]: grams(r[1]) for r in rows}
    df = Counter(b for c in counts.values() for b in c)
    idf = lambda b: math.log((1 + len(rows)) / (1 + df[b])) + 1

    def vector(c):
        x = {b: math.log1p(n) * idf(b) for b, n in c.items()}
        size = math.sqrt(sum(v * v for v in x.values())) + 1e-9
        return {b: v / size for b, v in x.items()}

    names = sorted({r[2] for r in rows})
    per = Counter(r[2] for r in rows)
    sample = [r for r in rows if r[5] < 20 / per[r[2]]]
    assert 20 < len(sample) < len(rows)
    packed = {r[:1] + r[3:5]: (sorted(counts[r[:1] + r[3:5]].items())) for r in sample}
    sample.sort(key=lambda r: (r[0], names.index(r[2]), np.array([n for _, n in packed[r[:1] + r[3:5]]], np.uint32).tobytes(), np.array([b for b, _ in packed[r[:1] + r[3:5]]], np.uint16).tobytes()))
    fit, held = [r for k, r in enumerate(sample) if k % 5], [r for k, r in enumerate(sample) if k % 5 == 0]
    z, g2 = Counter(), Counter()

    def weight(b, k):
        if abs(z[b, k]) <= language_id.L1:
            return 0.0
        return -(z[b, k] - math.copysign(language_id.L1, z[b, k])) / ((language_id.BETA + math.sqrt(g2[b, k])) / language_id.ALPHA + language_id.L2)

    def softmax(s):
        e = [math.exp(v - max(s)) for v in s]
        return [v / sum(e) for v in e]

    for epoch in range(language_id.EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(fit)).tolist():
            x = vector(counts[fit[i][:1] + fit[i][3:5]]) | {language_id.BUCKETS: 1.0}
            w = {(b, k): weight(b, k) for b in x for k in range(len(names))}
            p = softmax([sum(x[b] * w[b, k] for b in x) for k in range(len(names))])
            for b in x:
                for k in range(len(names)):
                    g = x[b] * (p[k] - (names[k] == fit[i][2]))
                    z[b, k] += g - (math.sqrt(g2[b, k] + g * g) - math.sqrt(g2[b, k])) / language_id.ALPHA * w[b, k]
                    g2[b, k] += g * g
    for b, k in list(z)[::37]:
        assert model.weights[b, k] == pytest.approx(weight(b, k), abs=2e-3), (b, k)

    def logits(text):
        x = vector(grams(text)) | {language_id.BUCKETS: 1.0}
        return [sum(v * weight(b, k) for b, v in x.items()) for k in range(len(names))]

    loss = lambda t: -sum(math.log(max(1e-300, softmax([v / t for v in logits(r[1])])[names.index(r[2])])) for r in held) / len(held)
    assert loss(model.temperature) <= min(loss(math.exp(k / 4)) for k in range(-12, 13)) + 1e-3
    for r in rows[::9]:
        p = softmax([v / model.temperature for v in logits(r[1])])
        lang, score = model.predict(r[1])
        assert lang == names[p.index(max(p))] and score == pytest.approx(max(p), abs=0.02)


def test_repeated_rows_are_drawn_one_by_one(spark):
    rows = [(7, "the same words in every row", "en")] * 300 + [(k, f"mots français numéro {k}", "fr") for k in range(40)]
    learn = cut(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    first, again = (language_id.train(learn, per_lang=30) for _ in range(2))
    assert first.langs == ["en", "fr"] and (first.weights == again.weights).all() and first.predict("the same words")[0] == "en" and first.predict("mots français")[0] == "fr"


def test_languages_that_a_stage_keeps(spark):
    rows = [(k, f"{'these are english words' if k % 2 else 'voici quelques mots français'} {k}", "en" if k % 2 else "fr") for k in range(400)] + [(1000, "日本語の文章です", "ja"), (1001, "日本語の文章", "ja")]
    docs = spark.createDataFrame(rows + [(1002, "12 34", "en"), (1003, None, "en")], "doc_id long, text string, lang string").repartition(3)
    model = language_id.train(language_id.learning_documents(docs))
    kept = {r.doc_id for r in language_id.identified(docs, model).collect()}
    # the stage of the pipeline is this, and not what a look for letters gives
    assert {r.doc_id for r in corpus_pipeline.keep_languages(spark, docs, "").collect()} == kept != {r[0] for r in rows}
    assert kept == {r[0] for r in rows[:400]} and model.langs == ["en", "fr", "ja"] and language_id.wanted_languages(model) == ["en", "fr"]
    assert {r.doc_id for r in language_id.identified(docs, model, ["fr"]).collect()} == set(range(0, 400, 2))
    assert {1000, 1001} <= {r.doc_id for r in language_id.identified(docs, model, ["ja"], 0.0).collect()}
    unsure = language_id.Model(["en", "fr"], model.idf)  # all weights 0
    assert language_id.identified(docs, unsure, sure=0.6).isEmpty() and language_id.identified(docs, unsure, sure=0.5).count() == 402
