import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from codetide.llm import packing
from conftest import SF_DIR


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(reference, text):
    return np.array([*reference.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


@pytest.mark.parametrize(
    "text",
    ["", " ", "   ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "it's we'll", "x  y", "\t tab", "é è　 ü", "1 22  333", "日本 語 ", "!! ?? <|x|>", "a\x1c b"],
)
def test_ids_are_the_tokenizers(reference, text):
    found = np.frombuffer(packing.encoder(packing.ranks_path())(text), "<u4").tolist()
    assert found == reference.encode(text, add_special_tokens=False).ids


def test_every_document_is_packed_whole(spark, reference):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack_documents(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, pieces = ids_of(reference, texts[doc]), sorted(pieces, key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert len(pieces) == max(1, -(-len(ids) // 2048))
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids) and all(r.length == 2048 for r in pieces[1:])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= 1.02 * total / 2048 + 1


def test_cases(make_documents, spark):
    docs = make_documents((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "word " * 9000))
    rows = packing.pack_documents(docs).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows if r.doc_id != 4) == [(0, 2), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert [r.length for r in sorted((r for r in rows if r.doc_id == 4), key=lambda r: r.piece)][1:] == [2048] * 4
    assert packing.pack_documents(make_documents((1, "a")).limit(0)).count() == 0


def test_few_sequences_for_pieces_that_fit_exactly():
    rng = np.random.default_rng(1)
    cut = np.concatenate([np.diff(np.sort(np.concatenate([[0, 2048], rng.choice(2047, 3, replace=False) + 1]))) for _ in range(400)])
    places, offsets, used = packing.least_squares(cut, 2048)
    assert used.max() <= 2048 and used.sum() == cut.sum() and len(used) <= 1.03 * 400


def test_ids_on_request(make_documents, reference):
    row = packing.token_pieces(make_documents((1, "some words")), packing.ranks_path(), with_ids=True).first()
    assert row.ids == ids_of(reference, "some words").tolist()
