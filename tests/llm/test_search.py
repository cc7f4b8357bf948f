import math
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as contract
from codetide.llm import search, sql
from conftest import SF_DIR
from oracle_check import difference

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEM = "item_id long, text string, score string, terms string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, top=50):
    """From (id, text) pairs."""
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, all_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c, n in counted:
            m = 100 - 50 + 50 * n * n_docs // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, k, i if known else None, -s) for k, (s, known, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def check(docs, items, **settings):
    got = sorted((tuple(r) for r in search.ranked(docs, items, **settings).collect()), key=str)
    assert got == by_hand([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], settings.get("top", 50))


def test_terms():
    text = "Straße ÉTÉ a_b x-y 12.5 Größe Z\tk\x0bK𝒜 \x7f{q}"
    assert [t.decode() for t in search.terms_of(text)] == terms(text)


@pytest.mark.parametrize(("top", "size", "block", "leaf"), [(50, 2048, 8192, 32), (3, 5, 40, 1), (7, 2048, 16, 4)])
def test_equals_brute_force(spark, top, size, block, leaf):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    check(docs, items, top=top, size=size, block=block, leaf=leaf)


def test_equals_sql(spark):
    assert difference(contract.queries()["op11_search"](spark, SF_DIR), sql.OP11, SF_DIR) is None


def test_cases(spark, make_documents):
    long = "alpha Beta " * 30_000 + "gamma"
    docs = make_documents((1, None), (2, ""), (3, "?!"), (4, "alpha"), (5, "alpha"), (5, "alpha"), (None, "alpha"), (6, long), (7, "Émile ALPHA beta"), (-8, "alpha"), (9, "unlike"))
    rows = [(1, "alpha, BETA alpha", "x", "y"), (2, None, "x", "y"), (3, "", "", ""), (4, "no such words", "", ""), (1, "émile Émile", "", ""), (1, "émile Émile", "", ""), (None, "gamma", "", "")]
    items = spark.createDataFrame(rows, ITEM)
    for top in (2, 4, 50):
        check(docs, items, top=top, leaf=1)
    assert search.ranked(docs.limit(0), items).count() == 0
    assert search.ranked(docs, items.limit(0)).count() == 0
    assert search.ranked(make_documents((1, "?")), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_leaves_branches_out():
    """With many documents most are never scored, and the best are the same."""
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(300)]
    docs = [(i, " ".join(rng.choice(words, 20, p=np.arange(300, 0, -1) / 45150))) for i in range(3000)]
    items = [(0, "w200 w250 w299 w10"), (1, "w298 w297 w296")]
    own = search.Items(items)
    counted = [Counter(t for t in terms(text)) for _, text in docs]
    df = Counter(own.numbers[t.encode()] for c in counted for t in c if t.encode() in own.numbers)
    ranking = search.Ranking(own, df, len(docs))
    found = [{ranking.rank[own.numbers[t.encode()]]: n for t, n in c.items() if t.encode() in own.numbers} for c in counted]
    m = np.array([search.length_weight(20, len(docs), 20 * len(docs))] * len(docs))
    lengths = np.array([len(f) for f in found])
    flat = [(r, n) for f in found for r, n in f.items()]
    tree = search.DocumentTree([i for i, _ in docs], m, lengths, np.array([r for r, _ in flat], dtype=np.int32), np.array([n for _, n in flat]))
    best = search.Search(ranking, 5)
    best.add(tree)
    assert best.scored < len(docs) / 4
    got = sorted((r["item_id"], -r["score"], r["doc_id"]) for r in best.found())
    assert got == sorted((i, -s, d) for i, _, d, s in by_hand(docs, items, 5))
