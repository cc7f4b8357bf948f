import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from codetide.llm import neardup
from codetide.llm.components import components
from codetide.llm.shingles import counted, multiset_similarity, text_shingles


def multiset(text):
    words = (text or "").encode().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(texts, threshold=0.8):
    """Least id per class, from the similarity of all pairs that share a shingle."""
    sets = {i: multiset(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bearers = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            bearers[x].append(i)
    pairs = {(a, b) for ids in bearers.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    same = defaultdict(list)
    for i, t in texts.items():
        same[t].append(i)
    links = {(ids[0], b) for ids in same.values() for b in ids[1:]}
    for a, b in pairs:
        both = sum((sets[a] & sets[b]).values())
        if both >= threshold * (sum(sets[a].values()) + sum(sets[b].values()) - both):
            links.add((a, b))
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def classes(docs):
    return {r.doc_id: r.class_id for r in neardup.near_query(docs).collect()}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_equals_all_pairs(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    assert classes(docs) == brute_classes({r.doc_id: r.text for r in docs.collect()})


def test_groups_passages_and_chains(make_documents):
    """A group of many near copies, chains of links, and a passage that unlike texts share."""
    rng = random.Random(3)
    word = lambda: "w" + str(rng.randrange(10**6))
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    texts = {}
    for i in range(60):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(120)] = word()
        texts[i] = " ".join(copy)
    chain = [word() for _ in range(100)]
    for i in range(60, 75):
        texts[i] = " ".join(chain)
        chain = chain[3:] + [word() for _ in range(3)]
    for i in range(75, 130):
        texts[i] = " ".join([*passage, *(word() for _ in range(rng.randrange(5, 60)))])
    assert classes(make_documents(*texts.items())) == brute_classes(texts)


def test_the_rest_of_large_buckets_is_compared(make_documents, monkeypatch):
    """Many unlike texts share a passage and so buckets; blocks hold two of them."""
    monkeypatch.setattr(neardup, "BLOCK", 2)
    monkeypatch.setattr(neardup, "SMALL", 2)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(50)]
    texts = {i: " ".join([*passage, *(f"u{rng.randrange(10**6)}" for _ in range(rng.choice((4, 6, 9, 20))))]) for i in range(60)}
    assert classes(make_documents(*texts.items())) == brute_classes(texts)


@pytest.mark.parametrize("small", [1, 10**6])
def test_small_and_large_buckets_find_the_same(make_documents, monkeypatch, small):
    """A group of copies with so many edits that some are near and some are not."""
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", 30)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(150)]
    texts = {}
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(150)] = rng.choice(base)
        texts[i] = " ".join(copy)
    want = brute_classes(texts)
    assert classes(make_documents(*texts.items())) == want and 1 < len(set(want.values())) < 100


def test_cases(make_documents):
    docs = make_documents((1, None), (2, ""), (3, " "), (4, "a b c"), (5, "a  b\nc"), (6, "a b"), (7, "x " * 9), (8, "x " * 10), (None, "a b c"), (4, "a b c"), (9, "q"))
    assert classes(docs) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, None: None, 9: 9}
    assert neardup.near_query(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in neardup.keep_one(docs).collect() if r.doc_id) == [1, 3, 4, 6, 7, 9]
    assert neardup.keep_one(docs).columns == docs.columns
    again = make_documents((1, "z y"), (1, "a b"), (1, "a b"), (2, "c"))
    assert sorted(r.text for r in neardup.keep_one(again).collect()) == sorted([min(("z y", "a b"), key=lambda t: hashlib.sha256(t.encode()).hexdigest()), "c"])


def test_signatures_are_unbiased():
    """Agreement of slots estimates the weighted similarity, also with high multiplicities."""
    rng = np.random.default_rng(5)
    for _ in range(6):
        values = rng.integers(0, 2**63, 40).astype(np.uint64)
        a, b = (np.repeat(values, rng.integers(0, 9, 40)) for _ in range(2))
        want = multiset_similarity(counted(a), counted(b))
        x, y = neardup.signatures([a, b], 6000)
        assert abs(np.mean(x == y) - want) < 4 * np.sqrt(want * (1 - want) / 6000) + 0.005


def test_signature_does_not_depend_on_company():
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 3, 500, 7)]
    together = neardup.signatures(texts)
    for one, text in zip(together, texts, strict=True):
        assert np.array_equal(one, neardup.signatures([text])[0])


def test_similarity_counts_multiplicity():
    a, b = "x y z u v w " * 3, "x y z u v w " * 4
    want = sum((multiset(a) & multiset(b)).values()) / sum((multiset(a) | multiset(b)).values())
    assert multiset_similarity(counted(text_shingles(a)), counted(text_shingles(b))) == pytest.approx(want)


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    root = {}
    find = lambda x: x if root.get(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = {x for e in edges for x in e}
    want = {n: find(n) for n in nodes if find(n) != n}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
