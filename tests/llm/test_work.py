import pytest

from brindle.llm import work


class Session:
    """As much of a session as work_dir() asks for."""

    def __init__(self, master, setting=None):
        self.sparkContext, self.conf, self.master, self.applicationId = self, self, master, f"app-{master}"
        self.setting = setting

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.setting


def test_the_shared_folder_is_the_session_s():
    assert work.work_dir(Session("spark://h", "hdfs://n/shared/")) == "hdfs://n/shared/brindle"


def test_only_local_sessions_do_without():
    assert work.work_dir(Session("local[2]")) == work.work_dir(Session("local[2]"))
    with pytest.raises(ValueError):
        work.work_dir(Session("spark://h"))


def test_workers_share_the_memory_beside_the_heap():
    mib = lambda x: int(x[:-1]) * {"m": 1, "g": 1024}[x[-1]]
    of = lambda master, executors=2, **conf: work._worker_memory({f"spark.{k.replace('_', '.')}": v for k, v in conf.items()}, master, 16, executors, mib)
    assert of("local-cluster[3,2,3000]", executor_memory="1800m") == (384, 2)
    assert of("yarn", executor_memory="40g", executor_cores="8") == (4096, 8)
    assert of("spark://h", executor_memory="40g", executor_memoryOverhead="6g") == (6144, 8)
    assert of("k8s://h", executor_memory="40g", executor_cores="4", executor_pyspark_memory="2g") == (4096 + 2048, 4)
    assert of("local[16]", driver_memory="8g") == (819, 16)


def test_tasks_of_a_written_table_follow_its_size(spark, monkeypatch):
    sums = spark.range(0, 100_000, 1, 50).groupBy("id").count()
    least = 4 * spark.sparkContext.defaultParallelism
    assert work.tasks_by_size(sums) == least
    monkeypatch.setattr(work, "TASK_BYTES", 1000)
    assert work.tasks_by_size(sums) >= 800 and work.tasks_by_size(spark.range(1_000_000).groupBy("id").count()) >= 8000
    assert work.materialize(sums, "s", small=True).count() == 100_000


def test_keep_rows_with_nulls_and_whole_repeats(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None), (3, "c"), (3, "d")], "doc_id long, text string")
    tagged = docs.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS tag", "text")
    verdicts = tagged.selectExpr("doc_id", "tag", "text = 'd' OR doc_id IS NULL AS kept").na.fill({"kept": False})
    assert sorted(map(str, work.keep_rows(docs, verdicts).collect())) == sorted(map(str, docs.where("text IN ('b', 'd')").collect()))
    one = verdicts.where("doc_id = 1").limit(1).selectExpr("doc_id", "tag", "true AS kept").unionByName(verdicts.where("doc_id = 1").limit(1))
    rest = one.unionByName(verdicts.where("doc_id <> 1 OR doc_id IS NULL"))
    assert work.keep_rows(docs, rest).where("doc_id = 1").count() == 1


def test_keep_rows_whose_verdicts_depend_on_another_column(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (1, "a", "de"), (1, "a", None), (1, "a", None), (2, "b", "en")], "doc_id long, text string, lang string")
    verdicts = docs.selectExpr("doc_id", "xxhash64(text) AS tag", "lang", "coalesce(lang, '') <> 'de' AS kept")
    got = work.keep_rows(docs, verdicts, ("lang",)).collect()
    assert sorted(map(str, got)) == sorted(map(str, docs.where("coalesce(lang, '') <> 'de'").collect()))
    assert work.keep_rows(docs, verdicts).where("doc_id = 1").count() == 3


def test_scratch_deletes_what_is_not_kept(spark):
    from pathlib import Path

    with work.scratch(spark) as outer:
        with work.scratch(spark) as kept:
            a, b = work.materialize(spark.range(3), "a"), work.materialize(spark.range(4), "b")
            kept.append(b)
        assert not Path(a.written_to).exists() and b.count() == 4
        c = work.materialize(spark.range(5), "c")
        work.discard(c)
        work.discard(spark.range(1))
        assert not Path(c.written_to).exists()
        d = work.materialize(spark.range(6), "d")
        outer.append(d)
    assert not Path(b.written_to).exists() and d.count() == 6


def test_numbers_follow_the_keys_for_any_partitioning(spark):
    for n in (1, 7):
        df, rows = work.numbered(spark.range(50).selectExpr("id * 7 % 50 AS x").repartition(n), ["x"], "n")
        assert rows == 50 and {(r.x, r.number) for r in df.collect()} == {(i, i) for i in range(50)}
    df, rows = work.numbered(spark.range(0).selectExpr("id AS x"), ["x"], "n")
    assert rows == 0 and df.collect() == []
