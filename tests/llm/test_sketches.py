import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
from codetide.llm import sketches
from conftest import SF_DIR


def hash_of(words):
    """The engine's 64-bit hash of several strings: each is the seed of the next."""
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed


def hashes(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [words[i : i + 5] for i in range(len(words) - 4)] or ([words] if words else [])
    return {int(np.uint64(hash_of(r)).astype(np.int64)) for r in runs}


def least(values, k=sketches.SIZE):
    return sorted(values)[:k]


def like(a, b, k=sketches.SIZE):
    union = least(set(a) | set(b), k)
    return sum(x in a and x in b for x in union) / len(union) if union else 1.0


def printed(values):
    return "".join(f"{np.int64(x).astype(np.uint64):016X}" for x in values)


def by_hand(pairs):
    """From (doc_id, text) pairs."""
    texts = [(i, t or "") for i, t in pairs]
    order = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0), int(np.uint64(xxhash.xxh64_intdigest(x[1].encode(), 42)).astype(np.int64)), x[1]))
    out = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, other = (least(hashes(x)) for x in (text, edited, following))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(own), printed(changed), like(own, changed), like(own, other)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def check(docs, **settings):
    got = sorted((tuple(r) for r in sketches.neighbour_query(docs, **settings).select(*COLUMNS).collect()), key=str)
    assert got == by_hand([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("cell", [3, 50, sketches.CELL])
def test_equals_brute_force(spark, cell):
    check(spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5, "text"), cell=cell)


def test_query(spark):
    query = contract.queries()["op12_fingerprints"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert sorted((tuple(r) for r in query.select(*COLUMNS).collect()), key=str) == by_hand([(r.doc_id, r.text) for r in docs])


@pytest.mark.parametrize("cell", [1, 2, 100])
def test_cases(make_documents, cell):
    long = "é wörd 𝒜 three\x0bfour " * 20_000
    pairs = [(5, "a b c d e f g h"), (3, None), (3, ""), (3, "x y"), (3, "x y"), (None, "null id " * 9), (-7, long), (9, " \n\t "), (9, "𝒜𝒷𝒸 d"), (12, "one"), (None, "z")]
    check(make_documents(*pairs), cell=cell)
    check(make_documents((1, "the only one")), cell=cell)
    check(make_documents((None, "x"), (None, "y y")), cell=cell)
    assert sketches.neighbour_query(make_documents((1, "x")).limit(0), cell).count() == 0


def test_equal_texts_have_equal_fingerprints(make_documents):
    docs = make_documents((1, "a b c d e f"), (2, "other words"), (3, "a b c d e f"), (4, ""), (5, None))
    prints = {r.doc_id: r.fingerprint for r in sketches.neighbour_query(docs).collect()}
    assert prints[1] == prints[3] != prints[2] and prints[4] == prints[5] == ""


def test_estimates(spark):
    """Against the true figures of sets that share a known part."""
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(6000)]
    for shared in (0.1, 0.5, 0.9):
        n = int(4000 * shared)
        a, b = " ".join(words[:4000]), " ".join(words[4000 - n : 4000] + [f"v{k}" for k in rng.integers(0, 10**9, 1000)])
        true_a, true_b = hashes(a), hashes(b)
        df = spark.createDataFrame([(a, b)], "a string, b string").select(sketches.sketch(F.col("a"), 512).alias("a"), sketches.sketch(F.col("b"), 512).alias("b"))
        got = df.select(sketches.resemblance(F.col("a"), F.col("b"), 512), sketches.containment(F.col("b"), F.col("a"), 512), sketches.distinct_shingles(F.col("a"), 512)).first()
        assert abs(got[0] - len(true_a & true_b) / len(true_a | true_b)) < 0.09
        assert abs(got[1] - len(true_a & true_b) / len(true_b)) < 0.15
        assert abs(got[2] / len(true_a) - 1) < 0.2


def test_sketches_of_parts_merge(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("source", "text", sketches.sketch(F.col("text")).alias("sketch"))
    got = {r.source: r.sketch for r in sketches.merged_sketches(docs, "source").collect()}
    want = {}
    for r in docs.collect():
        want.setdefault(r.source, set()).update(hashes(r.text))
    assert got == {s: least(h) for s, h in want.items()}
    both = docs.limit(2).collect()
    df = spark.createDataFrame([(both[0].text, both[1].text)], "a string, b string")
    one = df.select(sketches.merged(sketches.sketch(F.col("a")), sketches.sketch(F.col("b")))).first()[0]
    assert one == least(hashes(both[0].text) | hashes(both[1].text))


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = sketches.neighbour_query(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
