import random
import re
import resource
import time
from collections import Counter

import numpy as np
import pytest

from codetide.llm import decontamination as dec
from codetide.llm.shingles import shingle_numbers, word_numbers
from conftest import SF_DIR


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items, threshold=0.8):
    """Best window of every pair, by counting the shingles of every window."""
    found = {}
    for doc, text in docs:
        ws = words(text)
        shingles = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
        for item, other in items:
            iw = words(other)
            own = Counter(tuple(iw[i : i + 5]) for i in range(len(iw) - 4))
            n = sum(own.values())
            if not n or not own.keys() & set(shingles):
                continue
            best = max(((sum((Counter(shingles[i : i + n]) & own).values()) / n, -i) for i in range(max(1, len(shingles) - n + 1))), default=(0, 0))
            if best[0] >= threshold:
                found[doc, item] = (pytest.approx(best[0]), -best[1])
    return found


def leaks(spark, docs, items, **settings):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    return {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in dec.find_leaks(docs, benchmark, **settings).collect()}


def test_equals_every_window(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items)
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in dec.find_leaks(docs, benchmark).collect()}
    assert got == want and got


def planted(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(5, 60)))) for i in range(30)]
    docs = []
    for d in range(120):
        _, text = rng.choice(items)
        inside = text.split()
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            inside[rng.randrange(len(inside))] = rng.choice(vocabulary)
        docs.append((d, " ".join([*rng.choices(vocabulary, k=40), *inside, *rng.choices(vocabulary, k=30)]).upper()))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_edited_items(spark, make_documents, seed):
    """Items in several blocks, each a pass of its own; also whole documents that are shorter than an item."""
    docs, items = planted(seed)
    for k, (_, text) in enumerate(items[:20]):
        cut = text.split()
        docs += [(1000 + k, " ".join(cut[: int(len(cut) * 0.9)])), (2000 + k, " ".join(cut[: int(len(cut) * 0.7)])), (3000 + k, " ".join(cut[2:]))]
    table = make_documents(*docs)
    want, got = brute(docs, items), leaks(spark, table, items, size=7)
    assert got == want and len(want) > 60 and sum(1000 <= d < 2000 for d, _ in want) >= 8
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (7, 100):
        kept = {r.doc_id for r in dec.without_leaks(table, benchmark, size=size).collect()}
        assert kept == {d for d, _ in docs} - {d for d, _ in want}


@pytest.mark.parametrize("edit", [False, True])
def test_repeated_passages_are_cheap(edit):
    """A long text that repeats an item, or one of its words changed each time."""
    rng = random.Random(5)
    item = [f"w{i}" for i in range(60)]
    index = dec.BenchmarkIndex([(1, " ".join(item)), *((i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(60))) for i in range(2, 600))])
    again = []
    while len(again) < 1_000_000:
        again += [*item[:30], f"x{len(again)}", *item[31:]] if edit else item
    text = " ".join(again)
    start, before = time.perf_counter(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (found,) = index.matches(text)
    assert found[0] == 1 and found[2] == 0 and found[1] == pytest.approx(51 / 56 if edit else 1.0)
    assert time.perf_counter() - start < 40 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500 << 10


def test_blocks_find_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(2)
    index = dec.BenchmarkIndex([(i, " ".join(f"{w:x}" for w in rng.integers(0, 99, 30))) for i in range(50)])
    (of_size, own, _), size = index.by_size[26], 26
    found = own[rng.integers(0, 50, 400)] ^ np.packbits(rng.random((400, 128)) < rng.random((400, 1)) * 0.5, axis=1)
    apart = np.bitwise_count(found[:, None, :] ^ own[None]).sum(axis=2)
    want = {(w, int(of_size[i])) for w, i in zip(*np.nonzero(apart <= dec.RADIUS), strict=True)}
    assert set(zip(*(x.tolist() for x in index.near(size, found)), strict=True)) == want and len(want) > 50


def test_fingerprint_is_the_sign_of_sums():
    shingles = shingle_numbers(word_numbers([b"a", b"b", b"c", b"d", b"e", b"f", b"g"]))
    assert dec.signs(shingles).shape == (3, 128) and set(np.unique(dec.signs(shingles))) == {-1, 1}


def test_cases(spark, make_documents):
    items = [(1, None), (2, "too short an item"), (3, "one two three four five six"), (4, "one two three four five six")]
    docs = make_documents((1, None), (2, ""), (3, "One, two; three\nfour FIVE six!"), (3, "one two three four five six"), (4, "one two three"), (None, "x one two three four five six y"), (5, "a b c d e f " * 5000))
    assert set(leaks(spark, docs, items)) == {(3, 3), (3, 4), (None, 3), (None, 4)}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(r.doc_id for r in dec.without_leaks(docs, benchmark).collect()) == [1, 2, 4, 5]
    assert dec.without_leaks(docs, benchmark).columns == docs.columns
    assert leaks(spark, docs.limit(0), items) == {} == leaks(spark, docs, [(1, None)])
    assert dec.without_leaks(docs, benchmark.limit(0)).count() == 7
