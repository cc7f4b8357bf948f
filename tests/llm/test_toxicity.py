import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from codetide.llm import toxicity as tox
from codetide.llm.common import documents, read_table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_match(stems, word):
    """Fewest edits from a stem to a beginning of the word; of these the longest stem, then the first."""
    found = []
    for stem in stems:
        edits = min(distance(stem, word[:k]) for k in range(len(word) + 1))
        if edits <= tox.edits_allowed(stem):
            found.append((edits, -len(stem), stem))
    return (min(found)[2], min(found)[0]) if found else None


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_distances(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abc", k=rng.choice((3, 4, 5, 6, 9, 10)))) for _ in range(8)]
    trie = tox.FuzzyTrie(stems)
    for _ in range(1500):
        base = rng.choice([*stems, "".join(rng.choices("abcd", k=rng.randint(0, 12)))])
        word = list(base)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choices("abcd", k=rng.randint(0, 1))
        word = "".join(word) + "".join(rng.choices("abcd", k=rng.randint(0, 3)))
        assert trie.match(word) == brute_match(stems, word), (stems, word)


def test_whole_only_stems():
    trie = tox.FuzzyTrie(["moron", "loser"], whole_only=frozenset(["moron", "loser"]))
    assert trie.match("morron") == trie.match("maron") == trie.match("morrons") == ("moron", 1) and trie.match("loosers") == ("loser", 1)
    assert trie.match("moronic") == ("moron", 0) and trie.match("foronthe") is None and trie.match("losesra") is None


@pytest.mark.parametrize("copies", [1, 8])
def test_neighbours_do_not_switch_a_stem_off(make_documents, copies):
    """However many clean words lie near a stem, its other misspellings are found, and those words are not."""
    near = [f"{'aeiu'[i % 4]}oron{''.join('bcdfghjklm'[int(c)] for c in str(i))}" for i in range(100 * copies)]
    bad = [(i, f"wa{i} wb{i} moron wc{i} wd{i}") for i in range(100)]
    good = [(1000 + i, f"wa{i} wb{i} {word} wc{i} wd{i}") for i, word in enumerate(near)]
    labelled = make_documents(*bad, *good)
    labels = labelled.selectExpr("doc_id", "cast(doc_id < 1000 as int) as toxic")
    lexicon = tox.learn(labelled, labels)
    seen = next(word for i, word in enumerate(near) if zlib.crc32(str(1000 + i).encode()) % tox.HOLD_OUT)
    asked = make_documents((1, "xa xb morron xc"), (2, f"xa xb {seen} xc"), (3, "xa xb xc"), (4, "xa ioronunseen xc"), (5, "you moron"), (6, "such morrons"))
    score = {r.doc_id: r.score for r in tox.score_documents(asked, lexicon).collect()}
    assert min(score[1], score[5], score[6]) >= 0.5 > max(score[2], score[3], score[4])


def test_misspellings_and_context():
    match = tox.Matcher(tox.Lexicon({"stupid": 5.0, "idiot": 5.0, "worthless": 5.0}, frozenset(["stupip"])))
    found = lambda text: [(w, s, e) for w, s, e, _ in match(text)[1]]
    assert found("Stupid, id*ot st00pid 1d1ot wortless stupip plain") == [
        ("stupid", "stupid", 0), ("id*ot", "idiot", 1), ("1d1ot", "idiot", 1), ("wortless", "worthless", 1)]
    context = lambda text: match(text)[1][0][3]
    assert context("plain stupid words") == tox.PLAIN
    assert context("you stupid thing") == tox.ADDRESSED
    assert context('he "called it stupid stuff" then') == tox.QUOTED
    assert context("she said stupid") == tox.QUOTED


def test_context_is_learned(make_documents):
    """Quoted insults of clean documents teach that quotation is no abuse."""
    bad = [(i, f"wa{i} wb{i} you idiot wc{i} wd{i}") for i in range(150)]
    good = [(1000 + i, f"wa{i}x wb{i}x wc{i}x wd{i}x we{i}x") for i in range(600)] + [(2000 + i, f'wa{i} they wrote "idiot" wb{i}') for i in range(2)]
    labelled = make_documents(*bad, *good)
    lexicon = tox.learn(labelled, labelled.selectExpr("doc_id", "cast(doc_id < 1000 as int) as toxic"))
    asked = make_documents((1, "xa you idiot xb"), (2, 'xa he wrote "idiot" xb'), (3, "xa you idjot xb"))
    score = {r.doc_id: r.score for r in tox.score_documents(asked, lexicon).collect()}
    assert score[1] > score[2] and score[1] >= 0.5 and score[3] >= 0.5


@pytest.mark.parametrize(("n1", "n0", "share"), [(4, 0, 0.1), (4, 3, 0.25), (1, 0, 0.5), (30, 2, 0.3)])
def test_chance(n1, n0, share):
    n = n1 + n0
    assert math.isclose(tox.by_chance(n1, n0, share), sum(math.comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(n1, n + 1)))


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_no_stem_is_chance(spark, sf):
    """With the labels dealt out at random nothing is learned."""
    folder = f"/root/testdata/sf{sf}"
    labels = read_table(spark, folder, "labels")
    shuffled = labels.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(100)) < 11).cast("int").alias("toxic"))
    assert tox.learn_stems(tox.labelled_sample(documents(spark, folder), shuffled)) == {}


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_held_out_labels(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    labels = read_table(spark, folder, "labels")
    scored = tox.toxicity_query(documents(spark, folder), labels)
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    toxic, clean = ([r.score for r in held if r.toxic == k] for k in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a, b in itertools.product(toxic, clean)) / (len(toxic) * len(clean))
    bounds = (0.97, 0.9) if sf == "0.1" else (0.88, 0.7)  # few toxic documents to learn from
    assert right > bounds[0] and auc > bounds[1], (right, auc)


def test_held_out_labels_are_not_learned(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = documents(spark, folder), read_table(spark, folder, "labels")
    flipped = labels.selectExpr("doc_id", "quality", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0, 1 - toxic, toxic) as toxic")
    assert tox.learn(docs, labels) == tox.learn(docs, flipped)


def test_cases(spark, make_documents):
    bad = [(i, f"wa{i} wb{i} wc{i} idiot here wd{i} stupid we{i}") for i in range(1, 60)]
    good = [(i, f"wa{i} wb{i} wc{i} here wd{i} we{i}") for i in range(100, 220)]
    docs = make_documents(*bad, *good, (None, "idiot"), (300, None), (301, ""), (302, "x " * 40000 + "idiot"), (5, bad[4][1]))
    labels = spark.createDataFrame([(i, 1, int(i < 100), "x") for i, _ in bad + good] + [(400, 1, 1, "x"), (1, None, None, "x")], "doc_id long, quality int, toxic int, text string")
    rows = tox.toxicity_query(docs, labels).collect()
    assert len(rows) == docs.count()
    score = {r.doc_id: r.score for r in rows}
    assert all(score[i] >= 0.5 for i, _ in bad) and all(score[i] < 0.5 for i, _ in good) and score[300] == score[301] < 0.5
    assert tox.toxicity_query(docs.limit(0), labels).count() == 0
    assert {r.score for r in tox.toxicity_query(docs, labels.where("toxic = 0")).collect()} == {0.0}
    kept = tox.without_toxic(docs, tox.learn(docs, labels))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i, _ in good} | {300, 301}
