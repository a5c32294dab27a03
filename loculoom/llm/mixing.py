"""Mixing sources to target weights, with DataFrame operations alone.

Every document has a hash-random key.  Within its source a document is dealt to a bucket by key range (the keys are
uniform, so equal ranges are equal shares), bucket totals are summed up in key order, and the running sum inside a
bucket completes the distributed prefix sum.  A source whose target is e times its size is taken e whole times
(epochs) and then up to the exact word where its budget ends; the last document is taken in part.

Targets: sources in code-point order, null last, weigh 3, 1, 2, repeating, and share 150 % of all sizes; no target is
above 2 times its source's size, and the excess goes to the others by weight.  Sorted by the weight at which a source
is full, the full ones are a prefix, so one running sum finds them all.

A row whose doc_id is null has a hash of its own key, and the rows of a doc_id that fills a bucket alone are cut into parts by theirs, so
neither lands in one task.

Defined results: a null text has size 0; null is a source of its own; rows have a key of their own, so rows whose doc_id repeats or
is null are mixed one by one; equal keys are ordered by size, rows that are equal in both are taken in any order with the
same sums; if all sizes are 0, targets and takes are 0; an empty table gives an empty result; further columns of the
input are ignored, whatever their names (``mix_rows`` returns them, but for own columns ``size`` and ``taken``, which the
computed ones replace).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, keyed

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
#: Rows of a source to a bucket, and most buckets of a source (the key's leading hex digits bound it).
BUCKET_ROWS, KEY_DIGITS = 2_000, 12


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text (null: 0): every run becomes one mark, then only marks stay."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add rank, weight and target to ``sources(source, source_size)``, one row a source."""
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.lit(float(most)) * F.col("source_size")
    w = ranked.withColumn("weight", weight).withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    order = Window.orderBy("full_at", "rank")
    w = w.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
    # the level that the sources from this one on would have if all before it were full
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
    w = w.withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("full", F.col("full_at") <= F.col("left") / F.col("open"))
    level = F.min(F.when(~F.col("full"), F.struct("full_at", "rank", (F.col("left") / F.col("open")).alias("level")))).over(everything)
    w = w.withColumn("level", level["level"])
    return w.select("source", "source_size", "rank", "weight", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def mixed(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, share: float = SHARE, most: float = MOST, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row of ``docs(doc_id, text, source)``."""
    return mixed_rows(keyed(docs.select("doc_id", "source", "text")), seed, weights, share, most, bucket_rows).drop("file", "at")


def places(dealt: DataFrame, bucket_rows: int) -> DataFrame:
    """Add zone and part to the rows of the buckets: 0, but where one key alone would fill a bucket its rows are a zone of their own, cut into parts by row."""
    full = dealt.groupBy("rank", "bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 4 * bucket_rows).drop("n")
    heavy = dealt.join(full, ["rank", "bucket"], "left_semi").groupBy("rank", "bucket", "key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket_rows)
    parts = F.ceil(F.col("n") / F.lit(float(bucket_rows))).cast("long")
    heavy = cut(heavy.groupBy("rank", "bucket").agg(F.collect_list(F.struct("key", parts.alias("parts"))).alias("heavy")))
    own = F.filter("heavy", lambda x: x["key"] == F.col("key"))
    at = F.pmod(F.xxhash64("file", "at"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    zone = F.size(F.filter("heavy", lambda x: x["key"] < F.col("key"))) * 2 + F.size(own)
    return dealt.join(heavy, ["rank", "bucket"], "left").select(
        *dealt.columns, F.when(F.col("heavy").isNull(), 0).otherwise(zone).alias("zone"), F.coalesce(F.floor(at * F.get(own, F.lit(0))["parts"]), F.lit(0)).alias("part")
    )


def mixed_rows(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, share: float = SHARE, most: float = MOST, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``mixed``, with the key (file, at) of each row of ``docs(file, at, doc_id, source, text)``."""
    sized = cut(docs.select("file", "at", "doc_id", "source", word_count(F.col("text")).alias("size")))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.col("file").cast("string"), F.lit(":"), F.col("at").cast("string")))
    key = F.md5(F.concat(name, F.lit(f":{seed}")).cast("binary"))
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goal = targets(per.select("source", "source_size"), weights, share, most).withColumnRenamed("source", "of")
    goal = goal.join(per.select(F.col("source").alias("of2"), "rows"), F.col("of").eqNullSafe(F.col("of2"))).drop("of2")
    goal = cut(goal.withColumn("buckets", F.ceil(F.col("rows") / F.lit(float(bucket_rows)))))
    share_of = F.conv(F.substring("key", 1, KEY_DIGITS), 16, 10).cast("double") / F.lit(float(16**KEY_DIGITS))
    dealt = sized.withColumn("key", key).join(goal, F.col("source").eqNullSafe(F.col("of"))).withColumn("bucket", F.floor(share_of * F.col("buckets")))
    dealt = places(dealt.select("file", "at", "doc_id", "source", "size", "source_size", "target", "rank", "bucket", "key"), bucket_rows)
    place = ("rank", "bucket", "zone", "part")
    totals = dealt.groupBy(*place).agg(F.sum("size").alias("words"))
    below = Window.partitionBy("rank").orderBy("bucket", "zone", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*(F.col(c).alias(f"{c}_") for c in place), F.coalesce(F.sum("words").over(below), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*place).orderBy("key", "size", "doc_id", "file", "at").rowsBetween(Window.unboundedPreceding, -1)
    run = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    run = run.join(before, [F.col(c) == F.col(f"{c}_") for c in place])
    whole = F.floor(F.col("target"))
    epochs = F.coalesce(F.floor(whole / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    rest = whole - epochs * F.col("source_size") - F.col("before") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return run.select("file", "at", "doc_id", "source", "size", "source_size", "target", F.coalesce(taken, F.lit(0)).cast("long").alias("taken"))


def mix_rows(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` of which the mix takes words, with all their columns, ``size`` and ``taken``; ``how`` as in ``mixed``."""
    docs = docs.drop("size", "taken")
    file, at = fresh(docs, "file"), fresh(docs, "at")
    docs_ = keyed(docs, file, at)
    taken = mixed_rows(docs_.select(F.col(file).alias("file"), F.col(at).alias("at"), "doc_id", "source", "text"), **how).filter("taken > 0")
    return docs_.join(taken.select(F.col("file").alias(file), F.col("at").alias(at), "size", "taken"), [file, at]).drop(file, at)


def mix_digest(done: DataFrame) -> DataFrame:
    return done.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) AS rank FROM s),
w AS (SELECT *, CAST(CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM r),
l AS (SELECT *, CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
             sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM w),
f AS (SELECT *, cap / weight <= left_over / open_weight AS is_full FROM l),
g AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight * first_value(left_over / open_weight) OVER (ORDER BY is_full, cap / weight, rank) END AS target FROM f),
p AS (SELECT d.doc_id, d.size, g.source_size, g.target, floor(g.target) AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_it
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE floor(whole / source_size) * size + greatest(0, least(size, whole - floor(whole / source_size) * source_size - before_it)) END AS BIGINT) AS taken
FROM p
"""
