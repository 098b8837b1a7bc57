"""Distinct counts out of bitmaps that were made day by day."""

import random

from pyspark.sql import functions as F

from tidemark.operators import distinct


def test_days_add_up_while_the_dictionary_grows(spark, monkeypatch):
    monkeypatch.setattr(distinct, "LANES", 4)
    rng = random.Random(1)
    rows, ids, days = [], None, None
    for day in range(1, 13):
        some = [("acc", f"2024-01-{day:02}", rng.choice([None, *(f"m{i}" for i in range(day * 9))])) for _ in range(80)]
        rows += some
        frame = spark.createDataFrame(some, "account STRING, day STRING, merchant STRING").withColumn("day", F.to_date("day"))
        fresh = distinct.extend_dictionary(spark, frame.select("merchant"), ids)
        held = [tuple(r) for r in (fresh if ids is None else ids.unionByName(fresh)).collect()]
        assert len({i for _, i in held}) == len({m for m, _ in held}) == len(held)
        ids = spark.createDataFrame(held, "value STRING, id LONG")
        new = [tuple(r) for r in distinct.bitmaps(frame, ["account", "day"], "merchant", ids).collect()]
        days = new if days is None else days + new
    # every lane is dense
    known = {i for _, i in held}
    assert all(i < 4 or i - 4 in known for i in known)
    sets = spark.createDataFrame(days, "account STRING, day DATE, bucket LONG, bitmap BINARY")
    weeks = distinct.counted(sets.withColumn("week", F.date_trunc("week", "day")), ["account", "week"], "n")
    frame = spark.createDataFrame(rows, "account STRING, day STRING, merchant STRING")
    expected = frame.groupBy("account", F.date_trunc("week", "day").alias("week")).agg(F.count_distinct("merchant").alias("n"))
    assert sorted(map(tuple, weeks.collect())) == sorted(map(tuple, expected.collect()))
    # united sets can be united again
    month = distinct.counted(distinct.united(sets, ["account", "day"]), ["account"], "n").first().n
    assert month == len({m for _, _, m in rows if m})


def test_more_numbers_than_one_bitmap_holds(spark):
    rows = spark.range(70_000).select(F.lit("a").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    ids = distinct.extend_dictionary(spark, rows.select("v"))
    sets = distinct.bitmaps(rows.unionByName(rows), ["k"], "v", ids)
    assert sets.count() >= 3 and distinct.counted(sets, ["k"], "n").first().n == 70_000


def test_nothing(spark):
    rows = spark.createDataFrame([("a", None)], "k STRING, v STRING")
    ids = distinct.extend_dictionary(spark, rows.select("v"))
    assert ids.count() == 0 and distinct.counted(distinct.bitmaps(rows, ["k"], "v", ids), ["k"]).count() == 0
