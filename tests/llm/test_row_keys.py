"""Rows keep their key when a table is split otherwise in the next scan."""

import pytest

from loculoom.llm import exact_dedup, line_dedup, mixing, near_dedup
from loculoom.llm.common import keyed, one_scan

SPLIT = "spark.sql.files.minPartitionNum"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Three files of several row groups, so that splits differ with the number of cores."""
    line = "a line of more than forty characters that many documents hold, number"
    rows = [(i if i % 5 else None, f"text {i // 2} of words {i // 2 % 7}\n{line} {i // 2 % 30}\nend w{i // 2} x y z", "en", f"s{i % 3}", 0) for i in range(6000)]
    path = str(tmp_path_factory.mktemp("stored") / "documents.parquet")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    df.write.option("parquet.block.size", 20_000).option("parquet.page.size", 2_000).parquet(path)
    return path


@pytest.fixture
def split(spark):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def use(n):
        spark.conf.set(SPLIT, str(n))

    yield use
    spark.conf.unset(SPLIT)
    spark.conf.set("spark.sql.files.openCostInBytes", before)


def changed(spark, split, path, work):
    """The result of ``work`` on the table, which is split otherwise between the scans that are made at once and the last one."""
    split(2)
    docs = spark.read.parquet(path)
    n = docs.rdd.getNumPartitions()
    done = work(docs)
    split(40)
    assert spark.read.parquet(path).rdd.getNumPartitions() > n
    return sorted(map(tuple, done.collect()), key=repr)


def test_keys_do_not_depend_on_splits(spark, split, stored):
    found = []
    for n in (2, 40):
        split(n)
        found.append({tuple(r) for r in keyed(spark.read.parquet(stored)).select("file", "at", "text").collect()})
    assert found[0] == found[1] and len({r[:2] for r in found[0]}) == 6000


def test_only_plain_scans_are_keyed_in_place(spark, stored):
    docs = spark.read.parquet(stored)
    plain = [docs, docs.filter("doc_id > 3").select("text", "doc_id"), docs.withColumn("_metadata", docs.doc_id)]
    other = [docs.repartition(5), docs.union(docs), docs.selectExpr("*", "explode(array(1, 2))"), docs.dropDuplicates(["text"]), spark.read.parquet(stored, stored), docs.limit(9), docs.filter("rand() < 0.5")]
    assert all(one_scan(d) for d in plain) and not any(one_scan(d) for d in other)
    for d in plain + other[:-1]:
        got = keyed(d)
        assert got.columns == [*d.columns, "file", "at"]
        assert got.select("file", "at").distinct().count() == got.count() == d.count()
    text = spark.read.text(stored + "/_SUCCESS").union(spark.createDataFrame([("x",)], "value string"))
    assert keyed(text).count() == 1


def test_exact(spark, split, stored):
    texts = {r.text.lower() for r in spark.read.parquet(stored).collect()}
    done = changed(spark, split, stored, exact_dedup.exact_duplicates)
    assert len(done) == 6000 and sum(r[3] for r in done) == len(texts)
    assert {r[1].lower() for r in changed(spark, split, stored, exact_dedup.without_copies)} == texts


def test_lines(spark, split, stored):
    whole = sorted(map(tuple, line_dedup.repeated_lines(spark.read.parquet(stored)).collect()), key=repr)
    assert any(r[2] for r in whole)
    assert changed(spark, split, stored, lambda d: line_dedup.repeated_lines(d, broadcast_bytes=0)) == whole


def test_near(spark, split, stored):
    whole = {r.text for r in near_dedup.without_near_copies(spark.read.parquet(stored)).collect()}
    done = changed(spark, split, stored, near_dedup.near_duplicates)
    assert len(done) == 6000 and sum(r[2] for r in done) == len(whole) == 3000
    assert {r[1] for r in changed(spark, split, stored, near_dedup.without_near_copies)} == whole


def test_mixing(spark, split, stored):
    n = mixing.mixed(spark.read.parquet(stored)).filter("taken > 0").count()
    done = changed(spark, split, stored, mixing.mix_rows)
    assert len(done) == n
    # a row's own size and no other's
    size = len(spark.read.parquet(stored).columns)
    assert all(r[size] == len(r[1].split()) for r in done)


def test_one_id_in_many_buckets(spark):
    """Rows of one doc_id, or of none, are cut into parts; a source still gives exactly its target."""
    rows = [(7, f"w {'x ' * (i % 4)}", "a") for i in range(600)] + [(None, "w w", "a")] * 300 + [(i, "w w w", "a") for i in range(100)] + [(9, "q", "b")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    done = mixing.mixed(docs, bucket_rows=20)
    got = done.groupBy("source").agg({"taken": "sum", "target": "max", "size": "sum"}).collect()
    assert {r.source: r["sum(taken)"] for r in got} == {r.source: int(r["max(target)"]) for r in got}
    assert done.count() == len(rows) and done.filter("taken > 2 * size").count() == 0
    assert sorted(map(tuple, done.select("doc_id", "size").collect()), key=repr) == sorted([(i, len(t.split())) for i, t, _ in rows], key=repr)
    dealt = spark.createDataFrame([(1, k, 1, 0, key) for k, key in enumerate(["a"] * 10 + ["b"] * 90 + ["c"] * 5)], "file long, at long, rank int, bucket long, key string")
    placed = {(r.key, r.zone): r.n for r in mixing.places(dealt, 10).groupBy("key", "zone").agg(mixing.F.count_distinct("part").alias("n")).collect()}
    assert placed.keys() == {("a", 0), ("b", 1), ("c", 2)} and placed["b", 1] == 9
    assert "Python" not in mixing.mixed(docs)._jdf.queryExecution().toString()
