"""Repair of conversations against SQL, and against a search of all edits."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from loculoom.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, n int, part int, address string"
SPACE = " \t\n\x0b\x0c\r"


def told(spark, rows):
    table = spark.createDataFrame([(*r, 5, 6, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, cv.repair_digest(cv.damaged(table)).collect()), key=repr)


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(cv.SQL).fetchall(), key=repr)


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {c: sorted(mine, key=order) for c, mine in out.items()}


def search(rows):
    """All edits of a short conversation, up to two inserts at every place."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    inserts = [(), ("user:",), ("assistant:",), ("user:", "assistant:"), ("assistant:", "user:")]
    best = None
    ways = [[("K", 0), ("R", 2), ("r", 2), ("D", 3)] if f not in ("blank", "duplicate") else [("D", 3)] for f in faults]
    for edits in itertools.product(*ways):
        kept = []
        for (edit, cost), (_, role, text), fault in zip(edits, rows, faults):
            said = [] if edit == "D" else [f"{role if edit == 'K' else 'user' if edit == 'R' else 'assistant'}:{text}"]
            kept.append((cost + (fault == "truncated" and edit != "D"), edit.upper(), said))
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, said = 2 * sum(map(len, put)) + sum(k[0] for k in kept), "I" * len(put[0]), list(put[0])
            if best and cost > best[0]:
                continue
            for (_, edit, own), more in zip(kept, put[1:]):
                audit, said = audit + edit + "I" * len(more), [*said, *own, *more]
            if re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, said
    count = lambda f: sum(x == f for x in faults)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest()


def odd_rows(seed, convs, turns, roles=("system", "user", "assistant", "bot", "", None)):
    pick = random.Random(seed)
    texts = [None, "", " \t\n", "Yes.", "No!", "so what", "é?\r\n", "x\x85", " ", "Well.", "a:b\nuser:c."]
    return [(c if c % 7 else None, pick.choice([None, t, t, t, t * 3, 1]), pick.choice(roles), pick.choice(texts)) for c in range(convs) for t in range(pick.randint(1, turns))]


def test_against_search(spark):
    rows = odd_rows(1, 150, 3) + [(900 + k, t, r, f"{t}{r}.") for k, order in enumerate(itertools.product(("system", "user", "assistant"), repeat=3)) for t, r in enumerate(order)]
    rows = [r for r in rows if r[0] is not None]
    state = damage(rows)
    small = {c: mine for c, mine in state.items() if len(mine) <= 3}
    got = {r[0]: r[1:] for r in told(spark, rows)}
    assert set(got) == {r[0] for r in rows}
    assert {c: got[c] for c in small} == {c: search(mine) for c, mine in small.items()}


@pytest.mark.parametrize("seed", [2, 3])
def test_against_sql(spark, seed):
    rows = odd_rows(seed, 60, 9)
    assert told(spark, rows) == by_sql(rows)
    assert told(spark, []) == by_sql([]) == []


def test_given_tables(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    got = sorted(map(tuple, cv.repair_digest(cv.damaged(spark.read.parquet(path))).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    assert got == sorted(con.execute(cv.SQL).fetchall(), key=repr)


def test_long_conversation_across_partitions(spark):
    """One conversation of most rows, over forty ranges and two levels of the tree, with equal rows and equal texts."""
    pick = random.Random(5)
    rows = [(1, t // 2, pick.choice(["user", "assistant", "system"]), f"turn {t % 700}" + pick.choice([".", ""])) for t in range(1200)] + [(1, 3, "user", "Same.")] * 200
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in (0, 2, 3) for t in range(4)]
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "70")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = told(spark, rows)
        table = spark.createDataFrame([(*r, 5, 6, "x") for r in rows], SCHEMA)
        parts = cv.scanned(cv.flagged(cv.damaged(table))).filter("conv_id = 1").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert parts > 40
    assert got == by_sql(rows)


def test_product_is_associative():
    pick = random.Random(9)
    for _ in range(60):
        kinds = "".join(pick.choice("suaoSUAOx") for _ in range(pick.randint(1, 30)))
        left = cv.IDENTITY
        for k in kinds:
            left = cv.times(left, cv.turn_matrix(k))
        right = cv.IDENTITY
        for k in reversed(kinds):
            right = cv.times(cv.turn_matrix(k), right)
        assert left == right == cv.product(kinds)
    assert cv.times(cv.CLOSURE, cv.CLOSURE) == cv.CLOSURE


def test_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "bot", "cut"), (2, 0, "user", None), (None, 0, "user", "Hi.")]
    got = sorted(map(tuple, cv.repaired_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    # KIKD and KRR both cost 5
    assert got == sorted([(1, 1, "K", "system", "Be kind."), (1, 2, "I", "user", ""), (1, 3, "K", "assistant", "Hello."), (None, 1, "K", "user", "Hi."), (None, 2, "I", "assistant", "")], key=repr)
