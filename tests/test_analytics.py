"""Sketches, multisets and clustered tables against plain computations."""

import random
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brindle.operators import multisets, sketches
from brindle.plans import analytics
from brindle.sources import clustered

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merged_sketches_are_within_their_bounds(spark):
    rows = spark.range(200_000).select((F.col("id") % 40).cast("int").alias("day"), (F.xxhash64("id") % 30_000).alias("who"), F.when(F.col("id") % 9 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**6)) / 7).alias("v"))
    stored = sketches.sketch(rows, F.col("day"), "who", "v")
    assert stored.count() == 40
    found = sketches.estimates(sketches.merge(stored, F.floor(F.col("period") / 20)), {"median": 0.5, "low": 0.05})
    for r in found.collect():
        own = [x for x in rows.where(F.floor(F.col("day") / 20) == r.period).collect()]
        values = sorted(x.v for x in own if x.v is not None)
        assert r.n == len(own) == 100_000
        exact = len({x.who for x in own})
        assert abs(r.distinct_estimate - exact) <= sketches.distinct_error() * exact
        for q, x in ((0.5, r.median), (0.05, r.low)):
            assert abs(sum(v <= x for v in values) / len(values) - q) <= sketches.rank_error()


def test_merging_reads_no_rows(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    sketches.sketch(events, F.to_date("ts"), "user_id", "value").write.parquet(str(tmp_path / "days"))
    weekly = sketches.estimates(sketches.merge(spark.read.parquet(str(tmp_path / "days")), F.date_trunc("week", "period")), {"m": 0.5})
    plan = plan_of(weekly)
    assert "days" in plan and "events.parquet" not in plan


def test_sketches_of_no_rows(spark):
    none = spark.createDataFrame([], "d int, who long, v double")
    assert sketches.estimates(sketches.merge(sketches.sketch(none, F.col("d"), "who", "v"), F.col("period")), {"m": 0.5}).collect() == []


def test_multisets_against_counters(spark):
    r = random.Random(2)
    bags = {name: [(r.choice([None, 1, 2, 3]), r.choice(["x", "y", None])) for _ in range(n)] for name, n in (("a", 60), ("b", 40), ("c", 9), ("d", 0))}
    bags["a"] += [(7, "hot")] * 3000
    bags["b"] += [(7, "hot")] * 2000
    frames = {name: spark.createDataFrame(rows, "k int, result_ string") for name, rows in bags.items()}
    got = multisets.combine(frames, {"i": multisets.intersect_all("a", "b"), "e": multisets.except_all("a", "b", "c"), "u": multisets.union_all("c", "b"), "n": multisets.intersect_all("a", "d")})
    a, b, c = (Counter(bags[x]) for x in "abc")
    want = Counter({("i", *k): n for k, n in (a & b).items()}) + Counter({("e", *k): n for k, n in (a - (b + c)).items()}) + Counter({("u", *k): n for k, n in (b + c).items()})
    assert Counter(map(tuple, got.collect())) == want
    counted = multisets.combine(frames, {"i": multisets.intersect_all("a", "b")}, expand=False).collect()
    assert {(r.k, r.result_): r.copies for r in counted} == dict(a & b)
    with pytest.raises(ValueError):
        multisets.combine({"a": spark.range(1).withColumn("result", F.lit(1))}, {})


def test_all_results_come_from_one_shuffle(spark):
    plan = plan_of(analytics.t6_set_algebra(spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


SCHEMA = "t timestamp_ntz, x long, y double, s string"


def points(n):
    r = random.Random(4)
    return [(datetime(2020, r.randrange(1, 13), r.randrange(1, 28), r.randrange(24)), r.choice([5, r.randrange(1000)]), r.choice([None, r.random()]), str(i)) for i in range(n)]


def test_a_clustered_table_reads_only_files_in_range(spark, tmp_path):
    rows = points(6000)
    folder = str(tmp_path / "t")
    clustered.write(spark.createDataFrame(rows, SCHEMA), folder, ["t", "x"], 64)
    ranges = {"t": (datetime(2020, 3, 1), datetime(2020, 4, 1)), "x": (400, 500)}
    got = clustered.read(spark, folder, ranges)
    want = [r for r in rows if ranges["t"][0] <= r[0] <= ranges["t"][1] and 400 <= r[1] <= 500]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and want
    files, n = clustered.files_for(spark, folder, ranges)
    assert n >= 48 and len(files) <= n / 4  # one range of the two alone would need more
    assert {Path(x).name for x in got.inputFiles()} == {Path(x).name for x in files}
    assert len(clustered.files_for(spark, folder, {"x": (400, 500)})[0]) <= n / 2
    assert len(clustered.files_for(spark, folder, {"y": (0.0, 0.1)})[0]) == n  # no bounds of this column
    assert clustered.read(spark, folder, {"x": (5000, 6000)}).collect() == []


def test_nulls_empty_tables_and_versions(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = [(None, None, None, "a"), (None, 3, 1.5, "b"), (datetime(2020, 1, 1), 4, None, "c")]
    clustered.write(spark.createDataFrame(rows, SCHEMA), folder, ["x", "y"], 4)
    assert sorted(r.s for r in clustered.read(spark, folder, {}).collect()) == ["a", "b", "c"]
    assert [r.s for r in clustered.read(spark, folder, {"y": (1.0, 2.0)}).collect()] == ["b"]
    before = clustered.read(spark, folder, {})
    clustered.write(spark.createDataFrame(rows[:1], SCHEMA), folder, ["x"], 4)
    assert [r.s for r in clustered.read(spark, folder, {}).collect()] == ["a"] and before.count() == 3  # an open reader keeps its version
    clustered.write(spark.createDataFrame([], SCHEMA), folder, ["x", "y"], 4)
    assert clustered.read(spark, folder, {"x": (0, 9)}).collect() == []
    assert not list(Path(folder).glob("current-*"))


def test_a_write_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    df = spark.createDataFrame(points(50), SCHEMA)
    clustered.write(df, folder, ["x"], 4)
    monkeypatch.setattr(clustered, "_replace", lambda *a: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        clustered.write(df.limit(1), folder, ["x"], 4)
    assert clustered.read(spark, folder, {}).count() == 50
    with pytest.raises(FileNotFoundError):
        clustered.read(spark, str(tmp_path / "none"), {})


def test_weighted_medians_against_sorting(spark):
    from brindle.operators.selection import weighted_median

    r = random.Random(6)
    rows = [(r.choice(["hot"] * 8 + ["a", "b", None]), r.choice([None, -5, 0, r.randrange(-(10**9), 10**12), r.randrange(50)]), r.choice([None, 0, -1, 1, 2, r.randrange(100)])) for _ in range(3000)]
    rows += [("one", 7, 3), ("two", 1, 1), ("two", 9, 1), ("none", 1, 0)]
    for bits in (3, 8, 16):
        got = weighted_median(spark.createDataFrame(rows, "g string, v long, w long"), "g", "v", "w", bits)
        want = {}
        for g in {x[0] for x in rows if x[0] is not None}:
            own = sorted((v, w) for k, v, w in rows if k == g and v is not None and w is not None and w > 0)
            total, upto = sum(w for _, w in own), 0
            for v, w in own:
                upto += w
                if 2 * upto >= total:
                    want[g] = v
                    break
        assert {x.g: x.median for x in got.collect()} == want and "none" not in want
    assert weighted_median(spark.createDataFrame([], "g string, v long, w long"), "g", "v", "w").collect() == []


def test_median_sums_before_the_shuffle(spark):
    """What a task sends is sums: a partial aggregate stands below every exchange of values."""
    from brindle.operators.selection import weighted_median

    rows = spark.range(10_000).selectExpr("id % 3 AS g", "id * 7919 % 250 AS v", "1 AS w")
    plan = plan_of(weighted_median(rows, "g", "v", "w", 8))
    assert plan.count("partial_sum") >= 2 and "collect_list" not in plan and "Python" not in plan


def test_a_hot_key_of_medians_is_spread(spark):
    """Only sums are shuffled by key: rows that are met with what is decided, and sums of bits, go by key and bits. More parts than usual change nothing."""
    from brindle.operators.selection import weighted_median
    from brindle.sources.shared import settings

    rows = spark.range(3000).selectExpr("IF(id % 10 = 0, id, 7) AS g", "id * 7919 % 251 AS v", "1 + id % 3 AS w")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        lines = plan_of(weighted_median(rows, "g", "v", "w")).splitlines()
        below = [after for line, after in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
        assert len(below) >= 3 and all("HashAggregate" in line for line in below)
        want = sorted(map(tuple, weighted_median(rows, "g", "v", "w").collect()))
        assert sorted(map(tuple, weighted_median(rows, "g", "v", "w", 3, 100).collect())) == want
    got = dict(want)
    own = sorted(x for r in rows.where("g = 7").collect() for x in [r.v] * r.w)
    assert got[7] == own[(len(own) - 1) // 2] and len(got) == 301


def test_gaps_of_any_table(spark):
    from brindle.functions.gaps import FillDays

    spark.udtf.register("fill_days", FillDays)
    days = [("a", "2024-01-01", 1, 0.5, "x"), ("a", "2024-01-04", 2, None, "y"), ("b", "2024-02-28", 5, 1.0, "z"), ("b", "2024-03-01", 6, 2.0, "z"), ("c", None, 1, 1.0, "n")]
    spark.createDataFrame(days, "who string, day string, n int, x double, s string").withColumn("day", F.to_date("day")).createOrReplaceTempView("gap_days")
    got = spark.sql("SELECT * FROM fill_days(TABLE(gap_days) PARTITION BY (who) ORDER BY (day), 'day', 'who, s')").collect()
    plain = sorted((r.who, str(r.day), r.n, r.x, r.s, r.filled) for r in got)
    assert plain == [
        ("a", "2024-01-01", 1, 0.5, "x", False), ("a", "2024-01-02", 0, 0.0, "x", True), ("a", "2024-01-03", 0, 0.0, "x", True), ("a", "2024-01-04", 2, None, "y", False),
        ("b", "2024-02-28", 5, 1.0, "z", False), ("b", "2024-02-29", 0, 0.0, "z", True), ("b", "2024-03-01", 6, 2.0, "z", False), ("c", "None", 1, 1.0, "n", False),
    ]
    with pytest.raises(Exception, match="no column of dates"):
        spark.sql("SELECT * FROM fill_days(TABLE(gap_days) PARTITION BY (who) ORDER BY (day), 'n', 'who')").collect()


def test_schemas_are_merged_over_rows(spark):
    from brindle.functions.semistructured import merged_schema, typed

    rows = spark.createDataFrame([('{"k": 1}',), ('{"k": 2.5, "s": "a"}',), ('{"o": {"x": 1}}',), ("broken {",), (None,), ("[1]",)], "j string")
    objects = rows.where("j IS NULL OR j LIKE '{%'")
    assert merged_schema(objects, "j").startswith("STRUCT<")
    got = typed(objects, "j", "p_").collect()
    assert [(r.p_k and float(r.p_k), r.p_s, r.p_o and r.p_o.x) for r in got] == [(1.0, None, None), (2.5, "a", None), (None, None, 1), (None, None, None)]
    assert typed(rows.where("j = '[1]'"), "j", "p_").columns == ["j"]
    with pytest.raises(ValueError):
        typed(objects.withColumn("p_k", F.lit(1)), "j", "p_")


def test_walks_of_many_turns(spark, tmp_path):
    """Beyond Spark's own limit of 100 steps; a walk stops at a gap, and repeated turns count once."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "x") for t in range(130)] + [(2, 0, "user", "x"), (2, 0, "user", "y"), (2, 2, "user", "x"), (3, 1, "user", "x"), (None, 0, "user", "x"), (4, 0, None, "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r.path, r.depth): r.n for r in analytics.t8_walks(spark, str(tmp_path)).collect()}
    path = ["user" if t % 2 == 0 else "assistant" for t in range(130)]
    want = Counter({(">".join(path[:k]), k): 1 for k in range(1, 131)}) + Counter({("user", 1): 2, (None, 1): 1})
    assert got == want
