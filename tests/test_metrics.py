import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics

# Divisible by every window length used below, as windows count from 1970.
START = datetime.fromtimestamp(86400 * 7 * 2800, timezone.utc)
SCHEMA = "ts TIMESTAMP, metric STRING, labels MAP<STRING, STRING>, value DOUBLE"


def samples(spark, *rows):
    return spark.createDataFrame([(START + timedelta(seconds=t), m, labels, float(v)) for t, m, labels, v in rows], SCHEMA)


def test_increase_counts_resets_and_crosses_windows(spark):
    host = {"h": "a"}
    data = samples(
        spark, (0, "c", host, 10), (100, "c", host, 15), (290, "c", host, 3), (310, "c", host, 4), (900, "c", host, 1),
        (10, "c", {"h": "b"}, 7),
    )
    out = {
        (r.labels["h"], int((r.window_start.replace(tzinfo=timezone.utc) - START).total_seconds())): r.increase
        for r in metrics.increase(data, 300).collect()
    }
    assert out == {("a", 0): 8.0, ("a", 300): 1.0, ("a", 900): 1.0, ("b", 0): 0.0}


@pytest.mark.parametrize("window", [300, 700, 86400, 60])
def test_rate_against_a_plain_loop(spark, window):
    rng = random.Random(7)
    rows, expected = [], {}
    for host in "xyz":
        at, value, before = 0, 0, None
        for _ in range(300):
            at += rng.randint(1, 90)
            value = rng.randint(0, 5) if rng.random() < 0.05 else value + rng.randint(0, 9)
            rows.append((at, "c", {"host": host}, value))
            grown = 0 if before is None else value - before if value >= before else value
            key = (host, at // window * window)
            expected[key] = expected.get(key, 0) + grown
            before = value
    rng.shuffle(rows)
    out = metrics.rate(samples(spark, *rows), window).collect()
    got = {(r.labels["host"], int((r.window_start.replace(tzinfo=timezone.utc) - START).total_seconds())): r.rate for r in out}
    assert got == pytest.approx({k: v / window for k, v in expected.items()})


def test_label_matchers(spark):
    data = samples(
        spark, (0, "up", {"host": "kafka-1"}, 1), (0, "up", {"host": "my-kafka-2"}, 1), (0, "up", {}, 1), (0, "down", {"host": "kafka-1"}, 1)
    )

    def count(**matchers):
        return metrics.select_series(data, "up", **matchers).count()

    assert count() == 3
    assert count(like={"host": "kafka-.*"}) == 1
    assert count(not_equal={"host": ""}) == 2
    assert count(equal={"host": ""}) == 1
    assert count(like={"host": "kafka-1|my-.*"}) == 2


def test_latest_and_topk(spark):
    data = samples(spark, *[(t, "m", {"s": str(s)}, s * 10 + t) for s in range(8) for t in (0, 5, 3)])
    newest = metrics.latest(data)
    assert newest.count() == 8 and newest.filter("value % 10 = 5").count() == 8
    assert [r.value for r in metrics.topk(newest, 3).collect()] == [75.0, 65.0, 55.0]


def test_sum_by(spark):
    data = samples(
        spark, (0, "idle", {"h": "a", "cpu": "0"}, 0), (150, "idle", {"h": "a", "cpu": "0"}, 150),
        (0, "idle", {"h": "a", "cpu": "1"}, 0), (150, "idle", {"h": "a", "cpu": "1"}, 75),
    )
    assert metrics.sum_by(metrics.rate(data, 300), "h").first().rate == pytest.approx(0.75)


def test_quantile_in_a_first_bucket_below_zero(spark):
    window = F.lit("2024-01-01").cast("timestamp").alias("window_start")
    buckets = spark.createDataFrame(
        [({"le": "-10", "h": "a"}, 5.0), ({"le": "+Inf", "h": "a"}, 8.0)], "labels MAP<STRING, STRING>, rate DOUBLE"
    ).select("labels", window, "rate")
    assert metrics.histogram_quantile(0.5, buckets, "h").first().quantile == -10.0


@pytest.mark.parametrize("q, expected", [(0.5, 10.0), (0.25, 5.0), (0.6, 46.0), (0.75, 100.0), (0.99, 100.0), (0.0, None)])
def test_histogram_quantile(spark, q, expected):
    window = F.lit("2024-01-01").cast("timestamp").alias("window_start")
    buckets = spark.createDataFrame(
        [({"le": "10", "h": "a"}, 5.0), ({"le": "100", "h": "a"}, 7.5), ({"le": "+Inf", "h": "a"}, 10.0)],
        "labels MAP<STRING, STRING>, rate DOUBLE",
    ).select("labels", window, "rate")
    rows = metrics.histogram_quantile(q, buckets, "h").collect()
    assert [r.quantile for r in rows] == ([] if expected is None else [pytest.approx(expected)])


def test_alerts(spark):
    data = samples(spark, (0, "mem", {"h": "a"}, 81), (0, "mem", {"h": "b"}, 80), (0, "lag", {}, 1))
    fired = metrics.alerts(metrics.latest(data), [("high", "mem", 80), ("very", "mem", 80.5), ("behind", "lag", 0)])
    assert sorted(r.alert for r in fired.collect()) == ["behind", "high", "very"]


def _grid(rows, step, reach):
    """Per series, the steps whose range holds a sample: (host, step end) -> (growth in it, newest value)."""
    series, out = {}, {}
    for at, _, labels, value in rows:
        series.setdefault(labels["host"], []).append((at, value))
    for host, points in series.items():
        points.sort()
        grown = [0] + [b - a if b >= a else b for (_, a), (_, b) in zip(points, points[1:])]
        for k in range(points[-1][0] // step + reach // step + 2):
            inside = [i for i, (at, _) in enumerate(points) if k * step - reach <= at < k * step]
            if inside:
                out[host, k * step] = (sum(grown[i] for i in inside), points[inside[-1]][1])
    return out


@pytest.mark.parametrize(("reach", "step"), [(300, 60), (600, 300), (60, 60), (3600, 900)])
def test_values_and_rates_at_steps(spark, reach, step):
    rng = random.Random(reach + step)
    rows = []
    for host in "xyz":
        at, value = rng.randint(0, 500), 0
        for _ in range(120):
            at += rng.choice((1, 7, 30, 60, 61, 400, 5000))
            value = rng.randint(0, 5) if rng.random() < 0.05 else value + rng.randint(0, 9)
            rows.append((at, "c", {"host": host}, value))
    expected = _grid(rows, step, reach)
    rng.shuffle(rows)
    data = samples(spark, *rows)

    def by_step(out, column):
        return {(r.labels["host"], int((r["at"].replace(tzinfo=timezone.utc) - START).total_seconds())): r[column] for r in out.collect()}

    assert by_step(metrics.rate_at_steps(data, reach, step), "rate") == pytest.approx({k: g / reach for k, (g, _) in expected.items()})
    assert by_step(metrics.values_at_steps(data, step, reach), "value") == {k: v for k, (_, v) in expected.items()}


def test_series_that_ended_have_no_current_value(spark):
    data = samples(spark, (0, "c", {"host": "old"}, 1), (500, "c", {"host": "new"}, 2), (900, "c", {"host": "later"}, 3))
    at = (START + timedelta(seconds=600)).strftime("%Y-%m-%d %H:%M:%S")
    assert [(r.labels["host"], r.value) for r in metrics.current(data, at).collect()] == [("new", 2.0)]
    assert metrics.latest(data).count() == 3
    with pytest.raises(ValueError, match="multiple"):
        metrics.rate_at_steps(data, 300, 70)
