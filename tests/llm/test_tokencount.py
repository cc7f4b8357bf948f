import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from codetide.llm import tokencount as tc
from conftest import SF_DIR


@pytest.fixture(scope="module")
def vocabulary():
    return tc.read_vocabulary(tc.vocabulary_path())


@pytest.fixture(scope="module")
def reference(vocabulary):
    """The library's unigram tokenizer over the same pieces, untrained."""
    pieces, _ = vocabulary
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *((f"<0x{b:02X}>", -1e9) for b in range(256)), *pieces], 0, True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return tokenizer


def reference_over(pieces):
    tokenizer = Tokenizer(models.Unigram([("<unk>", min(s for _, s in pieces) - 0.0), *pieces], 0, False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return tokenizer


def brute(pieces, bytes_for_unknown, text):
    """Best score by recursion over all beginnings; of equal scores the earliest beginning of the last piece."""
    scores, single = dict(pieces), {p for p, _ in pieces if len(p) == 1}
    unknown = min(scores.values()) - 10
    marked = "▁" + text.replace(" ", "▁")
    best = [(0.0, 0, False)]
    for e in range(1, len(marked) + 1):
        top = None
        for s in range(e):
            piece = marked[s:e]
            if piece in scores:
                step = (best[s][0] + scores[piece], best[s][1] + 1, False)
                if top is None or step[0] > top[0]:
                    top = step
        if marked[e - 1] not in single:
            count = best[e - 1][1] + (len(marked[e - 1].encode()) if bytes_for_unknown else not best[e - 1][2])
            if top is None or best[e - 1][0] + unknown > top[0]:
                top = (best[e - 1][0] + unknown, count, True)
        best.append(top)
    return best[-1][1] if text else 0


@pytest.mark.parametrize("text", ["", "a", " ", "  a", "a  b ", "▁", "hello world", "Größe naïve", "x" * 300, "a\nb\tc", "日本語 𝒜", "1234 $$$ &&&", "the▁word"])
def test_counts_by_definition(vocabulary, text):
    assert tc.UnigramCounter(*vocabulary)(text) == brute(*vocabulary, text)


def test_ties_by_definition():
    rng = random.Random(1)
    for _ in range(60):
        pieces = list({"".join(rng.choices("ab▁", k=rng.randint(1, 4))): float(-rng.randint(0, 2)) for _ in range(rng.randint(1, 12))}.items())
        for flag in (False, True):
            count = tc.UnigramCounter(pieces, flag)
            for _ in range(20):
                text = "".join(rng.choices("abc ", k=rng.randint(0, 12)))
                assert count(text) == brute(pieces, flag, text), (pieces, flag, text)


def test_counts_of_documents_are_the_tokenizers(spark, reference):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(80)
    got = {r.doc_id: (r.n_chars, r.n_tokens) for r in tc.count_tokens(docs).collect()}
    want = {r.doc_id: (len(r.text), len(reference.encode(r.text, add_special_tokens=False).ids)) for r in docs.collect()}
    assert got == want


def test_cases(make_documents):
    rows = tc.count_tokens(make_documents((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "word " * 20000))).collect()
    by_id = {r.doc_id: r.n_tokens for r in rows}
    assert len(rows) == 6 and by_id[1] == by_id[2] == 0 and by_id[4] == 20000 * tc.counter(tc.vocabulary_path())("word") + 1
    assert tc.count_tokens(make_documents((1, "a")).limit(0)).count() == 0
