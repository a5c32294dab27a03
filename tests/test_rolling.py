"""The rolling stream against a recomputation, with withdrawals, replays and lost batches."""

from loculoom.streaming import rolling


def rows(plate, samples, shift=0, variants=6):
    return [(plate, f"v{v}", s, [0, 1, 2, None][(v + int(s[1:]) + shift) % 4]) for v in range(variants) for s in samples]


def want(spark, plates, samples):
    """``samples`` names the plate that each counted sample is on."""
    calls = {r for p in plates for r in p if samples.get(r[2]) == r[0]}
    df = spark.createDataFrame([r[1:] for r in calls], rolling.CALLS)
    return sorted(map(tuple, rolling.variant_totals(df).collect()))


def test_stream_equals_recomputation(spark, tmp_path):
    plates, gone, totals, ck = (str(tmp_path / x) for x in ("plates", "gone", "totals", "ck"))
    landed, held = [], {}

    def land(table):
        landed.append(table)
        spark.createDataFrame(table, rolling.PLATE_CALLS).repartition(2).write.mode("append").parquet(plates)

    def withdraw(*samples):
        spark.createDataFrame([(s,) for s in samples], rolling.WITHDRAWN).coalesce(1).write.mode("append").parquet(gone)

    def check():
        rolling.follow(spark, plates, gone, totals, ck)
        assert sorted(map(tuple, rolling.current(spark, totals).collect())) == want(spark, landed, held)
        assert {r.sample_id: r.plate for r in rolling.counted(spark, totals).collect()} == held

    withdraw("s99")  # nobody
    land(rows("p1", ["s0", "s1", "s2"]))
    held |= dict.fromkeys(["s0", "s1", "s2"], "p1")
    check()
    land(rows("p2", ["s2", "s3", "s4"], 1, 8))  # s2 is counted already
    withdraw("s1")
    held |= dict.fromkeys(["s3", "s4"], "p2")
    del held["s1"]
    check()
    land(rows("p1", ["s0", "s1", "s2"]))  # the first plate lands again: s1 is back, the others are there
    withdraw("s4", "s4", "s3")
    held["s1"] = "p1"
    del held["s4"], held["s3"]
    check()
    withdraw("s1", "s0", "s2")
    held.clear()
    check()
    check()  # nothing new
    land(rows("p3", ["s5"]) + rows("p0", ["s5"], 2))  # two plates at once: the first by name
    withdraw("s5")
    land(rows("p4", ["s6"], 0, 3))
    held["s6"] = "p4"
    check()


def test_a_batch_that_runs_again(spark, tmp_path):
    """The same batch twice, and after the loss of its ledger."""
    plates, totals = str(tmp_path / "plates"), str(tmp_path / "totals")
    first, second = rows("p1", ["s0", "s1"]), rows("p2", ["s1", "s2"], 1)
    spark.createDataFrame(first + second, rolling.PLATE_CALLS).write.parquet(plates)
    batch = lambda table, *gone: spark.createDataFrame(table + [(None, None, s, None) for s in gone], rolling.PLATE_CALLS)
    rolling.apply_batch(spark, plates, totals, batch(first), 0)
    for _ in range(3):
        rolling.apply_batch(spark, plates, totals, batch(second, "s0"), 1)
        assert sorted(map(tuple, rolling.current(spark, totals).collect())) == want(spark, [first, second], {"s1": "p1", "s2": "p2"})
    rolling.apply_batch(spark, plates, totals, batch([], "s2", "s0"), 2)
    assert sorted(map(tuple, rolling.current(spark, totals).collect())) == want(spark, [first, second], {"s1": "p1"})
