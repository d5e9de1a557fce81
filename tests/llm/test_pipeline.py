import itertools
import random
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
from brindle.llm import exact_dedup, quality, simhash, work
from tests.llm.common import documents, empty, prose


def corpus():
    rows = [(i, prose(200 + i % 60, i), ("en", "de", "fr", None)[i % 4]) for i in range(120)]
    rows += [(500 + i, prose(200 + i % 60, i), "en") for i in range(30)]  # exact copies of other languages' rows too
    rows += [(700, None), (701, ""), (702, "too short"), (703, "again and again and " * 40), (704, prose(200, 5) + " x"), (704, prose(200, 5) + " x")]
    return rows


def test_stages_in_order_keep_columns_and_clean_documents(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "exact dedup", "SimHash near-dedup", "best-fit packing"]
    docs = documents(spark, corpus())
    columns, texts = docs.columns, {}
    for (name, stage), reference in itertools.zip_longest(corpus_pipeline.STAGES[:3], (quality.judge, exact_dedup.duplicate_groups, simhash.near_groups)):
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), "t")
        assert docs.columns == columns
        assert docs.count() == reference(before).where("kept").count()
        texts[name] = sorted(r.text for r in docs.collect())
    kept = texts["quality rules"]
    assert "too short" not in kept and len(set(kept)) >= 115
    assert texts["exact dedup"] == sorted(set(kept))
    packed = corpus_pipeline.STAGES[3][1](spark, docs, "").collect()
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 1024


def test_run_reads_the_documents_table(spark, tmp_path):
    documents(spark, corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    folder = Path(work.work_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    found = corpus_pipeline.run(spark, str(tmp_path))
    left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before}
    assert not left & {"ngrams", "scored", "fingerprints", "simhash", "distinct", "quality-rules", "exact-dedup"}
    assert found.count() > 0


def test_texts_of_long_words_and_a_very_long_text_get_through(spark):
    r = random.Random(8)
    signs, weights = [chr(0x4E00 + k) for k in range(60)], range(1, 61)
    rows = [(i, " ".join("".join(r.choices(signs, weights, k=240)) for _ in range(30)), "zz") for i in range(60)]
    rows += [(100 + i, prose(300 + i, i), "en") for i in range(60)] + [(200, prose(300_000, 9), "en")]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), "t")
        left = {r.doc_id for r in docs.collect()}
        assert len(left & set(range(60))) >= 58 and len(left & set(range(100, 160))) >= 56 and 200 in left, name
    packed = corpus_pipeline.STAGES[3][1](spark, docs, "").collect()
    assert {r.doc_id for r in packed} == left
    assert sum(r.length for r in packed if r.doc_id == 200) > 300_000


def test_empty(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
