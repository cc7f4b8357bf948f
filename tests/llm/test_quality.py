import re
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as contract
from codetide.llm import quality, sql
from conftest import SF_DIR
from oracle_check import difference


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts(spark, make_documents):
    docs = make_documents(
        (1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (5, "a b a b a b a b"), (6, "x\ny\nx\n \n \nx"), (7, "a b c d a b c e b c d"),
        (8, "one\x0btwo\x0cthree four\r\nfive"), (9, "#a *b <c> | & %"), (10, "no break space em"), (11, "w " * 30000), (12, "𝒜𝒷 é"),
    )
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in quality.quality_query(docs).collect()}
    assert got == {r.doc_id: by_hand(r.text) for r in docs.collect()}


def test_hash_clashes_are_no_repeats(spark):
    """With all windows alike by hash the words decide."""
    words = [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(words + words[5:9],)], "w array<string>")
    assert df.select(quality.repeated_words(F.col("w"))).first()[0] == 8


def test_lines_above_limits_deplete(make_documents):
    shared = "a line that very many documents of this host bear " * 4
    docs = [(i, f"{shared}\n{'own words ' + str(i)}") for i in range(40)]
    rest = [(100 + i, " ".join(f"word{i}x{k}" for k in range(80))) for i in range(10)]
    rows = {r.doc_id: r for r in quality.quality_query(make_documents(*docs, *rest)).collect()}
    assert not rows[0].depleted and all(rows[i].depleted for i in range(1, 40))
    assert all(rows[i].kept for i, _ in rest)


def test_hosts_of_any_size_have_one_limit(make_documents):
    """The same lines are removed in a host of a few and in one of thousands of documents."""
    shared = "a line that some documents of this host bear " * 4
    bearers = lambda first: [(first + i, f"{shared}\n{'own words ' + str(i)}") for i in range(11)]
    others = [(100 + i, " ".join(f"word{i}x{k}" for k in range(60))) for i in range(3000)]
    docs = make_documents(*bearers(0)).unionByName(make_documents(*bearers(50), *others, source="hot"))
    rows = {r.doc_id: r for r in quality.quality_query(docs).collect()}
    assert [i for i in range(100) if i in rows and rows[i].depleted] == [*range(1, 11), *range(51, 61)]
    assert all(rows[i].kept for i, _ in others)
    assert not any(r.depleted for r in quality.quality_query(make_documents(*bearers(0)[:10])).collect())


def test_copies_are_documents(make_documents):
    text = "\n".join(f"line {k} " + " ".join(f"w{k}x{j}" for j in range(20)) for k in range(5))
    rows = quality.quality_query(make_documents(*((i, text) for i in range(7, 50)), (7, text))).collect()
    assert len(rows) == 44 and sorted(r.doc_id for r in rows if r.kept) == [7, 7]
    assert all(r.kept for r in quality.quality_query(make_documents(*((i, text) for i in range(10)))).collect())


def test_clashing_names(make_documents):
    docs = make_documents((1, "short"), (2, " ".join(f"w{k}" for k in range(60))), (None, "x"))
    for names in (("r_id", "r_host", "r_hash"), ("text_hash", "rejected", "mine")):
        for name in names:
            docs = docs.selectExpr("*", f"'x' as {name}")
    assert [r.doc_id for r in quality.kept_documents(docs).collect()] == [2]
    assert quality.kept_documents(docs).columns == docs.columns


def test_cases(make_documents):
    docs = make_documents((1, "a"), (1, "a"), (None, "b"), source=None)
    assert quality.quality_query(docs).count() == 3
    assert quality.quality_query(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = quality.base_statistics(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_equals_sql(spark):
    assert difference(contract.queries()["op1_quality_rules"](spark, SF_DIR), sql.OP1, SF_DIR) is None
