"""The stream of sessions, cut into batches in several ways, against a plain loop."""

import random
from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from brindle.plans import streams
from brindle.sources.shared import settings
from brindle.streaming.sessions import SESSIONS, Sessions, sessions

HOUR = 3_600_000_000


def slow(rows, gap, lateness):
    """Sessions that are over when the stream ends, and late rows."""
    out = [(u, at, at, 1, True) for u, at, arrived in rows if arrived - at > lateness]
    mark = max(arrived for *_, arrived in rows) - lateness
    for user in {u for u, *_ in rows}:
        own = []
        for at in sorted(at for u, at, arrived in rows if u == user and arrived - at <= lateness):
            if own and at - own[-1][1] < gap:
                own[-1] = (own[-1][0], at, own[-1][2] + 1)
            else:
                own.append((at, at, 1))
        out += [(user, *s, False) for s in own if s[1] + gap <= mark]
    return sorted(out)


def some_rows(seed, n):
    r, out = random.Random(seed), []
    for _ in range(n):
        at = r.randrange(200 * HOUR)
        out.append((r.choice([1] * 8 + [2, 3]), at, at + r.choice([0, 0, 0, HOUR, 5 * HOUR, 30 * HOUR])))
    return out


@pytest.mark.parametrize("parts,files", [(1, 100), (6, 1)])
def test_any_batches_against_a_loop(spark, tmp_path, parts, files):
    rows = some_rows(1, 600)
    df = spark.createDataFrame(rows, "user_id long, at long, arrived long").withColumn("arrived", F.timestamp_micros("arrived"))
    streams.arrivals(df.coalesce(2), str(tmp_path / "in"), parts)
    with settings(spark, **streams.ROCKSDB):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
        found = sessions(stream, timedelta(hours=1), timedelta(hours=10))
        query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        assert len(query.recentProgress) >= (2 if parts == 1 else 6)
    got = sorted(map(tuple, spark.read.schema(SESSIONS).parquet(str(tmp_path / "out")).collect()))
    want = slow(rows, HOUR, 10 * HOUR)
    assert got == want and {late for *_, late in want} == {True, False}


def test_sessions_merge_whatever_their_order():
    own = Sessions(10)
    assert own.merged([(20, 25, 3), (0, 5, 2), (12, 14, 1), (40, 40, 1)]) == [(0, 25, 6), (40, 40, 1)]
    assert own.merged([(0, 30, 5), (3, 4, 1), (40, 41, 1)]) == [(0, 30, 6), (40, 41, 1)]
    assert own.merged([]) == []


class Store:
    """A state and its timers, which count what is asked of them."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None


def test_a_batch_costs_a_key_one_read_and_one_write(spark):
    """However many sessions are open; what rows find over goes at once, without a call by a timer."""
    store, own, at = Store(), Sessions(HOUR), lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    own.init(store)
    rows = [Row(at=k * 2 * HOUR + x, late=False) for k in range(2000) for x in (0, 5)]
    assert list(own.handleInputRows((7,), iter(rows), at(0))) == [] and store.calls == ["get", "update"] and store.timers == {HOUR // 1000 + 1}
    found = list(own.handleInputRows((7,), iter([Row(at=1998 * 2 * HOUR + 9, late=False), Row(at=3, late=True)]), at(1999 * 2 * HOUR // 1000)))
    assert found[0] == (7, 3, 3, 1, True) and found[1:] == [(7, k * 2 * HOUR, k * 2 * HOUR + (9 if k == 1998 else 5), 3 if k == 1998 else 2, False) for k in range(1999)]
    assert store.calls == ["get", "update"] * 2 and store.timers == {(1999 * 2 + 1) * HOUR // 1000 + 1}
    store.timers.clear()  # Spark deletes the timer that fires
    assert list(own.handleExpiredTimer((7,), at(4000 * HOUR // 1000), None)) == [(7, 1999 * 2 * HOUR, 1999 * 2 * HOUR + 5, 2, False)]
    assert store.value is None and store.timers == set()


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    assert streams.QUERIES["t4_sessions_of_a_stream"](spark, str(tmp_path)).collect() == []
