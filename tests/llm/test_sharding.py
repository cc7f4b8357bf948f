import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from codetide.llm import sharding
from codetide.llm.common import materialise
from conftest import SF_DIR


def least_capacity(sizes, shards):
    """Smallest capacity by trying the greedy walk in plain Python."""
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, n = (low + high) // 2, 0, 1
        for s in sizes:
            if used + s > middle:
                used, n = 0, n + 1
            used += s
        low, high = (low, middle) if n <= shards else (middle + 1, high)
    return low


def check(docs, shards):
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    rows = sharding.shard_documents(docs, shards).collect()
    assert len(rows) == len(texts)
    groups = defaultdict(int)
    for _, t in texts:
        groups[hashlib.sha256(t.encode()).hexdigest()] += len(t.encode()) + 1
    in_shard, shard_of, slots = defaultdict(int), {}, defaultdict(list)
    for r in rows:
        in_shard[r.shard] += r.size
        assert shard_of.setdefault(r.key, r.shard) == r.shard
        slots[r.shard].append(r.slot)
    ordered = [shard_of[k] for k in sorted(groups)]
    assert ordered == sorted(ordered) and set(ordered) <= set(range(shards))
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert max(in_shard.values()) == least_capacity([groups[k] for k in sorted(groups)], shards)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_smallest_capacity(spark, shards):
    check(spark.read.parquet(f"{SF_DIR}/documents.parquet"), shards)


@pytest.mark.parametrize("seed", range(3))
def test_groups_of_very_unequal_size(make_documents, monkeypatch, seed):
    monkeypatch.setattr(sharding, "INTERVALS", 4)
    monkeypatch.setattr(sharding, "SLICE", 20)
    rng = random.Random(seed)
    texts = ["x" * int(rng.paretovariate(0.7)) + str(i) for i in range(150)]
    check(make_documents(*((i, rng.choice(texts)) for i in range(400))), 5)


@pytest.mark.parametrize("copies", [220, 2000])
@pytest.mark.parametrize("text", ["one text of many copies", "z" * 40])
def test_a_group_of_a_third_leaves_no_shard_empty(make_documents, copies, text):
    """The documents before and after a large group are dealt out over the other shards alike."""
    rng = random.Random(3)
    docs = [(i, f"text {i} " + "w" * rng.randrange(20, 180)) for i in range(400 if copies < 1000 else 1200)]
    table = make_documents(*docs, *((10_000 + i, text) for i in range(copies)))
    check(table, 8)
    sizes, large = defaultdict(int), set()
    for r in sharding.shard_documents(table).collect():
        sizes[r.shard] += r.size
        if r.doc_id >= 10_000:
            large.add(r.shard)
    others = [n for s, n in sizes.items() if s not in large]
    assert len(sizes) == 8 and len(large) == 1 and max(others) < 3 * min(others)


def test_few_groups_are_spread(make_documents):
    table = make_documents(*((i, f"{i:02}a") for i in range(9)))
    check(table, 8)
    assert len({r.shard for r in sharding.shard_documents(table).collect()}) == 8


def test_a_very_long_text(make_documents):
    check(make_documents((1, "x" * 3_000_000), *((i, "y" * i) for i in range(2, 90))), 8)


def test_cases(make_documents):
    docs = make_documents((1, None), (2, ""), (3, "a"), (3, "a"), (None, "é"))
    check(docs, 8)
    rows = {(r.doc_id, r.size, r.text_crc32) for r in sharding.shard_query(docs).collect()}
    assert rows == {(1, 1, 0), (2, 1, 0), (3, 2, zlib.crc32(b"a")), (None, 3, zlib.crc32("é".encode()))}
    assert sharding.shard_query(docs.limit(0)).count() == 0


def test_summary_holds_little(spark):
    ends = materialise(spark.range(1, 20001).selectExpr("id * 7 as end"), "ends")
    summary = sharding.EndSummary(ends)
    exact = [min(140_000, 7 * (p // 7)) for p in (6, 7, 700, 99_999, 140_000, 200_000)]
    while [summary.floor(p) for p in (6, 7, 700, 99_999, 140_000, 200_000)] != exact:
        assert summary.unsure()
        summary.divide()
    assert len(summary.intervals) < 4 * sharding.INTERVALS
