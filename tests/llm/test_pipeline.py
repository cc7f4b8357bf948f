from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from codetide.llm import quality, toxicity
from codetide.llm.common import DOCUMENT_COLUMNS, documents, materialise, read_table
from llm.test_decontamination import brute as brute_leaks
from llm.test_neardup import brute_classes
from llm.test_quality import by_hand

FOLDER = "/root/testdata/sf0.01"


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "quality_rules", "near_duplicates", "decontamination", "packing"]
    assert contract.queries()["pipeline"] is pipeline.run and pipeline.ORACLE_SQL is None
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in contract.queries() if q.startswith("op")}


@pytest.fixture(scope="module")
def packed(spark):
    return pipeline.run(spark, FOLDER)


def test_equals_brute_force(spark, packed):
    """Each decision in plain Python, on what the stage before left."""
    docs, labels = documents(spark, FOLDER), read_table(spark, FOLDER, "labels")
    lexicon = toxicity.learn(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, lexicon).collect()}
    rows = {r.doc_id: r for r in docs.collect() if scores[r.doc_id] < 0.5}

    lines = {i: [" ".join(x.lower().split()) for x in r.text.split("\n") if x.strip()] for i, r in rows.items()}
    bearers = {}
    for i in rows:
        for x in lines[i]:
            bearers.setdefault((rows[i].source, x), set()).add(i)

    def gone(i, x):
        own = bearers[rows[i].source, x]
        return len(own) > quality.MOST_DOCUMENTS and min(own) != i

    def fit(i):
        whole, lost = sum(map(len, lines[i])), sum(len(x) for x in lines[i] if gone(i, x))
        return not by_hand(rows[i].text)[5] and whole - lost >= quality.LEAST_LEFT * whole

    texts = {i: r.text for i, r in rows.items() if fit(i)}
    texts = {i: texts[i] for i, c in brute_classes(texts).items() if i == c}
    items = [(r.item_id, r.text) for r in read_table(spark, FOLDER, "benchmark").collect()]
    leaks = {i for i, _ in brute_leaks(texts.items(), items)}
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts) - leaks
    assert len(rows) < 1000 and leaks and len(texts) < sum(map(fit, rows))


def test_sequences_are_whole(packed):
    rows = packed.collect()
    ends = Counter()
    for r in sorted(rows, key=lambda r: r.offset):
        assert ends[r.sequence_id] == r.offset
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048


def test_stages_keep_the_columns(spark):
    docs = documents(spark, FOLDER).limit(30)
    for _, stage in pipeline.STAGES[:-1]:
        assert tuple(stage(spark, docs, FOLDER).columns) == DOCUMENT_COLUMNS


def test_empty_table(spark):
    docs = documents(spark, FOLDER).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_cases(spark, make_documents):
    """Nulls, a very long text, repeated rows and clashing names pass through all stages."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    docs = make_documents((1, None), (2, ""), (3, text(3)), (3, text(3)), (None, text(4)), (5, text(5)), (6, text(5)), (7, " ".join(text(k) for k in range(900, 2000))))
    docs = docs.unionByName(make_documents((8, text(8)), source=None)).selectExpr("*", "'x' as r_id", "'x' as row", "'x' as key", "'x' as node", "'x' as cell")
    for name, stage in pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, FOLDER), name)
        if name != "packing":
            assert docs.columns == before.columns
    assert sorted((r.doc_id or 0) for r in docs.select("doc_id").distinct().collect()) == [0, 3, 5, 7, 8]
    assert docs.where("doc_id = 3").count() == 1
