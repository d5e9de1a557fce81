"""As-of and interval joins against plain loops, and the shape of their plans."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brindle.functions.timeline import seconds
from brindle.operators import asof
from brindle.operators.intervals import _in_bins, begun_within, overlaps
from brindle.plans import temporal
from brindle.sources.shared import settings


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


LEFT = "k string, t long, n int, bucket int, side int"
RIGHT = "k string, u long, tie int, v string"


def slow_as_of(left, right, within=None):
    out = []
    for row in left:
        k, t = row[:2]
        own = [r for r in right if r[0] is not None and r[1] is not None and r[0] == k and t is not None and r[1] <= t]
        r = max(own, key=lambda r: (r[1], r[2] is not None, r[2] or 0), default=(None,) * 4)
        out.append((*row, *((None,) * 3 if r[1] is None or within is not None and t - r[1] > within else r[1:])))
    return sorted(out, key=str)


def sides(seed, n, keys):
    r = random.Random(seed)
    key = lambda: r.choice(keys)
    left = [(key(), r.choice([None, *range(-50, 400)]), i, 1, 2) for i in range(n)]
    right = [(key(), r.choice([None, *range(-100, 350, 7)]), i, f"v{i}") for i in range(n // 2)]
    return left + left[:5], right


@pytest.mark.parametrize("bucket_rows", [10, 100, 10**6])
@pytest.mark.parametrize("within", [None, 3])
def test_as_of_against_a_loop(spark, bucket_rows, within):
    left, right = sides(1, 400, ["a"] * 20 + ["b", "c", "d", None, ""])
    got = asof.as_of(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "t", "u", ["tie"], None if within is None else F.lit(within), bucket_rows)
    assert got.columns == ["k", "t", "n", "bucket", "side", "u", "tie", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == slow_as_of(left, right, within)


def test_as_of_with_an_empty_side(spark):
    left, right = sides(2, 20, ["a", "b"])
    none_left, none_right = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    got = asof.as_of(spark.createDataFrame(left, LEFT), none_right, "k", "t", "u")
    assert sorted(map(tuple, got.collect()), key=str) == slow_as_of(left, [])
    assert asof.as_of(none_left, spark.createDataFrame(right, RIGHT), "k", "t", "u").collect() == []


def test_a_hot_key_is_split_over_buckets(spark):
    """Nine rows of ten have one key: groups of the window stay near the size asked for, and the plan has no join of the sides."""
    left = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id"))).otherwise("hot").alias("k"), (F.col("id") * 37 % 100_000).alias("t"), F.col("id").alias("n"))
    right = left.select("k", (F.col("t") + 11).alias("u"), F.col("n").alias("v"))
    times = left.select(F.col("t").alias("at")).unionByName(right.select(F.col("u").alias("at")))
    low, width = asof._cells(times)
    cells = dict(asof._buckets(times, F.floor((F.col("at") - low) / width), 1000))
    groups = Counter(cells[(r.t - low) // width] for r in left.where("k = 'hot'").collect())
    assert len(groups) >= 35 and max(groups.values()) <= 1000
    met = asof.as_of(left, right, "k", "t", "u", bucket_rows=1000)
    plan = plan_of(met)
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert "hashpartitioning(k" in plan and "bucket" in plan[plan.index("Window") :]
    assert met.agg(F.sum("v")).first()[0] > 0


def test_keys_that_are_not_hot_are_shuffled_once(spark):
    """One exchange of all rows for the window, no buckets, nothing carried over; one hot key among them, and only its rows are."""
    left, right = sides(3, 600, ["a", "b", "c", "d", None])
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    plan = plan_of(asof.as_of(l, r, "k", "t", "u", ["tie"], bucket_rows=1000))
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Aggregate" not in plan
    left, right = sides(4, 600, ["hot"] * 12 + ["a", "b", "c", None])
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    met = asof.as_of(l, r, "k", "t", "u", ["tie"], bucket_rows=100)
    assert "Aggregate" in plan_of(met) and sorted(map(tuple, met.collect()), key=str) == slow_as_of(left, right)


def test_clashing_columns_and_types(spark):
    left = spark.createDataFrame([("a", 1)], "k string, t long")
    with pytest.raises(ValueError):
        asof.as_of(left, left, "k", "t", "t")
    with pytest.raises(TypeError):
        asof.as_of(left, left.select("k", F.col("t").cast("int").alias("u")), "k", "t", "u")
    with pytest.raises(ValueError):
        overlaps(left, left, ("t", "t"), ("t", "t"))


def test_seconds_of_times(spark):
    days = [datetime(1969, 12, 31, 23, 59, 59, 500000), datetime(1970, 1, 1), datetime(1901, 5, 6, 7, 8, 9, 1), datetime(2024, 3, 31, 2, 30), datetime(1960, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # has no 2:30 on that day
    try:
        got = [r[0] for r in df.select(seconds(df.t, df.schema["t"].dataType)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [(d - datetime(1970, 1, 1)) // timedelta(seconds=1) for d in days]


def spans(seed, n, long):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a = r.choice([None, *([r.randrange(-1000, 2000)] * 12)])
        size = r.choice([0, 1, 2, 3, r.randrange(40), r.randrange(long), -1])
        out.append((i, r.choice("xy"), a, None if a is None or r.random() < 0.05 else a + size))
    return out + out[:3]


@pytest.mark.parametrize("on", [[], [("g", "h")]])
def test_overlaps_against_a_loop(spark, on):
    left, right = spans(3, 120, 3000), spans(4, 150, 300)
    got = overlaps(spark.createDataFrame(left, "i int, g string, a long, b long"), spark.createDataFrame(right, "j int, h string, c long, d long"), ("a", "b"), ("c", "d"), on)
    whole = lambda rows: [x for x in rows if x[2] is not None and x[3] is not None and x[2] <= x[3]]
    want = [(*x, *y) for x in whole(left) for y in whole(right) if x[2] <= y[3] and y[2] <= x[3] and (not on or x[1] == y[1])]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 300


def test_overlaps_of_moments_and_of_an_empty_side(spark):
    a = spark.createDataFrame([(1, datetime(2020, 1, 1)), (2, datetime(2020, 1, 1, 0, 0, 0, 300))], "i int, t timestamp_ntz")
    b = spark.createDataFrame([(7, datetime(2019, 1, 1), datetime(2020, 1, 1, 0, 0, 0, 200))], "j int, c timestamp_ntz, d timestamp_ntz")
    assert [(r.i, r.j) for r in overlaps(a, b, ("t", "t"), ("c", "d")).collect()] == [(1, 7)]
    assert overlaps(a, b.limit(0), ("t", "t"), ("c", "d")).collect() == []


def test_overlaps_are_joined_by_bins(spark):
    df = spark.range(1000).selectExpr("id AS i", "id * 3 AS a", "id * 3 + id % 50 AS b")
    plan = plan_of(overlaps(df, df.selectExpr("i AS j", "a AS c", "b AS d"), ("a", "b"), ("c", "d")))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "x_bin" in plan and ("HashJoin" in plan or "SortMergeJoin" in plan)


def test_sessions_touch_few_bins(spark):
    """No span is in more than two bins of a size, however long."""
    from brindle.operators.intervals import _binned, _classed

    df = spark.createDataFrame([(0, 10**9), (5, 5), (-7, 1), (3, 4), (2**40, 2**41)], "a1 long, b1 long")
    rows = _binned(_classed(df, ("a1", "b1")), F.array("size")).groupBy("a1").count().collect()
    assert {r["count"] for r in rows} <= {1, 2} and len(rows) == 5


@pytest.mark.parametrize("bin_rows", [1, 7, 1000])
def test_begun_within_against_a_loop(spark, bin_rows):
    rows, others = spans(5, 150, 2000), spans(6, 120, 10)
    x, y = spark.createDataFrame(rows, "i int, g string, a long, b long"), spark.createDataFrame(others, "j int, h string, c long, d long")
    got = begun_within(x, y, ("a", "b"), "c", bin_rows)
    want = [(*p, *q) for p in rows for q in others if None not in (p[2], p[3], q[2]) and p[2] <= q[2] <= p[3]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)) and len(want) > 300


@pytest.mark.parametrize("far", [0, 10**10])
def test_copies_of_spans_do_not_grow_with_their_lengths(spark, far):
    """Spans of all lengths over bursts of points, and one point far off: four copies of a span at most, on average, and one of a point. Each side is multiplied once a join."""
    x = spark.range(4000).selectExpr("id AS i", "id * 3 AS a", "id * 3 + shiftleft(1L, cast(id % 14 AS int)) AS b")
    y = spark.range(4000).selectExpr("id AS j", f"CASE WHEN id = 0 THEN {far} WHEN id % 3 = 0 THEN id % 5 ELSE id * 3 END AS c").withColumn("d", F.col("c") + F.col("j") % 100)
    of_x, of_y = _in_bins(x, y, ("a", "b"), "c", 8)
    assert of_y.count() == 4000 < of_x.count() <= 4 * 4000
    assert plan_of(overlaps(x, y, ("a", "b"), ("c", "d"))).count("Generate explode") == 2


@pytest.mark.parametrize("bin_rows, block_rows", [(1, 1), (7, 3), (1000, 50)])
def test_begun_within_in_blocks_against_a_loop(spark, bin_rows, block_rows):
    """Keys by which pairs are ordered may be null or equal: no pair is lost or found twice."""
    rows, others = ([(*r[:1], None if r[0] % 9 == 0 else r[0] % 5, *r[2:]) for r in spans(seed, n, long)] for seed, n, long in ((7, 150, 2000), (8, 120, 10)))
    x, y = spark.createDataFrame(rows, "i int, g int, a long, b long"), spark.createDataFrame(others, "j int, h int, c long, d long")
    got = begun_within(x, y, ("a", "b"), "c", bin_rows, ("g", "h"), block_rows)
    want = [(*p, *q) for p in rows for q in others if None not in (p[2], p[3], q[2]) and p[2] <= q[2] <= p[3]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)) and len(want) > 300
    assert begun_within(x, y.limit(0), ("a", "b"), "c", bin_rows, ("g", "h"), block_rows).collect() == []


def test_pairs_of_a_session_come_in_runs(spark, tmp_path):
    """Hundreds of sessions at one time: from a pair to the next one of both users stays, so that a file of pairs is small."""
    users = spark.range(400).select((F.col("id") * 7919 % 10007).alias("user_id"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("n"), "id")
    at = F.timestamp_seconds(1_700_000_000 + F.col("id") * 7919 % 18_000 + F.col("n") * 3000).cast("timestamp_ntz")
    users.select((F.col("user_id") * 10 + F.col("n")).alias("event_id"), "user_id", at.alias("ts")).write.parquet(str(tmp_path / "events.parquet"))
    with settings(spark, spark__sql__shuffle__partitions="40", spark__sql__adaptive__coalescePartitions__enabled="false"):  # sessions come from many tasks
        pairs = [(r.a_user, r.b_user) for r in temporal.t3_overlapping_sessions(spark, str(tmp_path)).collect()]
    both_change = sum(p[0] != q[0] and p[1] != q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(set(pairs)) == len(pairs) > 50_000 and both_change < len(pairs) / 10


def test_registered():
    assert set(temporal.QUERIES) == set(temporal.ORACLE_SQL)
