"""Queries on stored sketches, multisets, clustered tables and hierarchies. They have no counterpart in the reference, which has no queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.gaps import FillDays
from brindle.functions.semistructured import typed
from brindle.operators import multisets, sketches
from brindle.operators.selection import weighted_median
from brindle.sources import clustered
from brindle.sources.shared import new_folder, settings
from brindle.sources.tables import table


def t5_weekly_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks, from sketches stored by day: whether their estimates of distinct users, median and ninth decile lie within the sketches' bounds."""
    events = table(spark, sf_dir, "events").select("ts", "user_id", "value")
    folder = new_folder(spark, "days")
    sketches.sketch(events, F.to_date("ts"), "user_id", "value").write.parquet(folder)
    weekly = sketches.merge(spark.read.parquet(folder), F.date_trunc("week", "period").cast("date"))
    found = sketches.estimates(weekly, {"median": 0.5, "decile": 0.9})
    # The exact figures, to compare with.
    week = F.date_trunc("week", "ts").cast("date")
    users = events.groupBy(week.alias("week")).agg(F.count_distinct("user_id").alias("n_users"))
    met = events.select(week.alias("week"), "value").join(found, F.col("week") == F.col("period"))
    below = {name: (F.count_if(F.col("value") < F.col(name)), F.count_if(F.col("value") <= F.col(name))) for name in ("median", "decile")}
    ranks = met.groupBy("week", "n", "distinct_estimate").agg(
        F.count("value").alias("n_values"), *(x.alias(f"{name}_{k}") for name, both in below.items() for k, x in zip(("less", "most"), both))
    )

    def within(name: str, q: float):
        slack = sketches.rank_error() * F.col("n_values") + 1
        return (F.col(f"{name}_less") <= q * F.col("n_values") + slack) & (F.col(f"{name}_most") >= q * F.col("n_values") - slack)

    off = F.abs(F.col("distinct_estimate") - F.col("n_users"))
    return ranks.join(users, "week").select(
        "week", "n", "n_users", (off <= 1 + sketches.distinct_error() * F.col("n_users")).alias("users_within"),
        within("median", 0.5).alias("median_within"), within("decile", 0.9).alias("decile_within"),
    )


def t6_set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four set operations with multiplicity on parts and quantities of returned, accepted and other lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_partkey").alias("part"), F.col("l_quantity").cast("long").alias("quantity"))
    sets = {flag: lines.where(F.col("l_returnflag") == flag).drop("l_returnflag") for flag in "ARN"}
    return multisets.combine(sets, {
        "a and r": multisets.intersect_all("A", "R"), "a without r": multisets.except_all("A", "R"),
        "n without a and r": multisets.except_all("N", "A", "R"), "all": multisets.intersect_all("A", "R", "N"),
    })


#: The ranges that :func:`t7_clustered_ranges` reads, and the files that it writes.
RANGES = {"l_shipdate": ("1997-01-01 00:00:00", "1997-09-30 00:00:00"), "l_partkey": (50, 150)}
FILES = 32


def t7_clustered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a range of days and parts, from a copy of the table that is clustered by both."""
    folder = new_folder(spark, "clustered")
    clustered.write(table(spark, sf_dir, "lineitem"), folder, list(RANGES), FILES)
    found = clustered.read(spark, folder, RANGES)
    return found.select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"))


T8 = """
    WITH RECURSIVE turns AS (SELECT conv_id, turn, min(role) AS role FROM conversations GROUP BY conv_id, turn),
    walk(conv_id, turn, path, depth) AS (
        SELECT conv_id, turn, CAST(role AS {text}), CAST(1 AS BIGINT) FROM turns WHERE turn = 0
        UNION ALL
        SELECT t.conv_id, t.turn, CAST(concat(w.path, '>', t.role) AS {text}), w.depth + 1
        FROM walk w JOIN turns t ON t.conv_id = w.conv_id AND t.turn = w.turn + 1)
    SELECT path, depth, count(*) AS n FROM walk GROUP BY path, depth"""


def t8_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many conversations take each path of roles, turn by turn from the first, without a gap. Spark's limits on recursion are lifted: a walk ends with its turns."""
    walks = T8.format(text="STRING").replace("FROM conversations", "FROM {conversations}")
    folder = new_folder(spark, "walks")
    with settings(spark, spark__sql__cteRecursionLevelLimit="-1", spark__sql__cteRecursionRowLimit="-1"):
        found = spark.sql(walks, conversations=table(spark, sf_dir, "conversations"))
        found.write.parquet(folder)
    return spark.read.schema(found.schema).parquet(folder)


def t9_filled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users by day, with the days in between on which they have none."""
    spark.udtf.register("fill_days", FillDays)
    return spark.sql(
        """SELECT user_id, day, n, filled FROM fill_days(
               TABLE(SELECT user_id, to_date(ts) AS day, count(*) AS n FROM {events} GROUP BY user_id, to_date(ts)) PARTITION BY (user_id) ORDER BY (day), 'day', 'user_id')""",
        events=table(spark, sf_dir, "events"),
    )


def t10_weighted_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median price of each part's lines in cents, weighted by quantity."""
    lines = table(spark, sf_dir, "lineitem")
    cents = lines.select(F.col("l_partkey").alias("part"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"), F.col("l_quantity").cast("long").alias("quantity"))
    return weighted_median(cents, "part", "cents", "quantity").withColumnRenamed("median", "median_cents")


def t11_typed_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by type of event over columns that come out of the events' JSON properties."""
    events = typed(table(spark, sf_dir, "events").select("event_type", "props"), "props", "p_")
    return events.groupBy("event_type").agg(F.count("p_k").alias("n"), F.sum("p_k").alias("total"), F.max("p_k").alias("largest"))


QUERIES = {f.__name__: f for f in (t5_weekly_sketches, t6_set_algebra, t7_clustered_ranges, t8_walks, t9_filled_days, t10_weighted_medians, t11_typed_props)}
ORACLE_SQL = {
    "t5_weekly_sketches": """
        SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n, count(DISTINCT user_id) AS n_users,
               true AS users_within, true AS median_within, true AS decile_within
        FROM events GROUP BY ALL""",
    "t6_set_algebra": """
        WITH a AS (SELECT l_partkey AS part, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem WHERE l_returnflag = 'A'),
        r AS (SELECT l_partkey AS part, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem WHERE l_returnflag = 'R'),
        n AS (SELECT l_partkey AS part, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem WHERE l_returnflag = 'N')
        SELECT 'a and r' AS result, * FROM (FROM a INTERSECT ALL FROM r)
        UNION ALL SELECT 'a without r', * FROM (FROM a EXCEPT ALL FROM r)
        UNION ALL SELECT 'n without a and r', * FROM ((FROM n EXCEPT ALL FROM a) EXCEPT ALL FROM r)
        UNION ALL SELECT 'all', * FROM ((FROM a INTERSECT ALL FROM r) INTERSECT ALL FROM n)""",
    "t7_clustered_ranges": """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem
        WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-09-30' AND l_partkey BETWEEN 50 AND 150""",
    "t8_walks": T8.format(text="VARCHAR"),
    "t9_filled_days": """
        WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
        days AS (
            SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily GROUP BY user_id)
        SELECT user_id, day, coalesce(n, 0) AS n, n IS NULL AS filled FROM days LEFT JOIN daily USING (user_id, day)""",
    "t10_weighted_medians": """
        WITH lines AS (SELECT l_partkey AS part, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS w FROM lineitem),
        sums AS (SELECT part, cents, sum(w) OVER (PARTITION BY part ORDER BY cents) AS upto, sum(w) OVER (PARTITION BY part) AS whole FROM lines WHERE w > 0)
        SELECT part, min(cents) AS median_cents FROM sums WHERE 2 * upto >= whole GROUP BY part""",
    "t11_typed_props": """
        SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS total, max(k) AS largest
        FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type""",
}
