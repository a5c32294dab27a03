"""Every catalogue query against its SQL on the small tables."""

import duckdb
import pytest

from loculoom.plans import catalogue, interchange, records

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


QUERIES = catalogue.QUERIES | interchange.QUERIES | records.QUERIES
SQL = catalogue.ORACLE_SQL | interchange.ORACLE_SQL | records.ORACLE_SQL


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(map(tuple, df.select([f"`{c}`" for c in columns]).collect()), key=repr)
    quoted = ", ".join('"' + c + '"' for c in columns)
    want = sorted(map(tuple, duck.execute(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()), key=repr)
    assert got == want


def test_whole_tables(spark):
    """All edges and all contamination inputs, by brute force."""
    import duckdb as db

    lines = db.sql(f"SELECT l_suppkey, l_partkey, l_linenumber FROM '{DATA}/lineitem.parquet'").fetchall()
    sums: dict = {}
    for s, p, n in lines:
        sums[s, p] = sums.get((s, p), 0) + n
    edges = [(s, p) for (s, p), n in sums.items() if s < p and n % 4 != 3]
    assert any(p >= 100 for _, p in edges)
    got = {r.IID: r for r in catalogue.QUERIES["relatedness_pivot"](spark, DATA).collect()}
    assert set(got) == {x for e in edges for x in e}
    columns = ("RELATED_MZ", "RELATED_1ST", "RELATED_2ND", "RELATED_3RD")
    pairs = {tuple(sorted((i, int(t.split(":")[0])))) for i, r in got.items() for c in columns if r[c] for t in r[c].split(";")}
    assert pairs == set(edges)
    report = catalogue.QUERIES["sample_qc_report"](spark, DATA).collect()
    assert {r["IID"] for r in report if r["F_baf"] is not None} == {r["IID"] for r in report} and any(r["IID"] % 2 for r in report)


def test_a_task_groups_a_bounded_number_of_lines(spark, duck, monkeypatch):
    """Of many lines there are more tasks than Spark's setting, each with its share; the calls are the same."""
    want = sorted(map(tuple, catalogue.calls(spark, DATA).collect()), key=repr)
    monkeypatch.setattr(catalogue, "TASK_ROWS", 100)
    lines = catalogue.read(spark, DATA, "lineitem").select("l_suppkey", "l_partkey", "l_linenumber")
    sizes = [len(p) for p in catalogue.dealt_pairs(lines).rdd.glom().collect()]
    assert len(sizes) == -(-lines.count() // 100) > 4 and max(sizes) < 200 and sum(sizes) == lines.count()
    assert sorted(map(tuple, catalogue.calls(spark, DATA).collect()), key=repr) == want
