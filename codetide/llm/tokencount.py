"""Token counts by Viterbi over a unigram vocabulary.

Aho-Corasick lists the vocabulary pieces that end at each character; the dynamic programme carries the best score up to that
character and the number of pieces on the best path, and no path. The rules are the tokenizer's: of equal scores the piece that begins
first wins; a character that is no piece by itself may be unknown at ten below the least score; an unknown character
counts as its UTF-8 bytes where the vocabulary has byte pieces, else a run of them counts once.

Words are counted one by one and remembered, as long as no piece of the vocabulary goes on past the beginning of
a word; with such a vocabulary a text is counted as a whole. Scores of a word are summed from 0, which is exact for
whole-number scores.

Defined cases: null and empty texts have 0 tokens; spaces count as written, others than U+0020 are ordinary characters; repeated rows
get a row each; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
from pyspark.sql import DataFrame

from codetide.llm.common import Remembered, map_text, whole_text

# The mark of a space, the penalty of an unknown character.
SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: New words after which a worker forgets those not met lately.
REMEMBERED = 300_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Ordinary pieces with their scores, and whether there are byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain], any(model.is_byte(i) for i in ids)


class UnigramCounter:
    """Counts the pieces of the best segmentation."""

    _words = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]*")

    def __init__(self, vocabulary: Iterable[tuple[str, float]], bytes_for_unknown: bool):
        vocabulary = list(vocabulary)
        self._pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self._pieces.add_word(piece, (len(piece), score))
        self._pieces.make_automaton()
        self._single = {p for p, _ in vocabulary if len(p) == 1}
        self._unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self._bytes = bytes_for_unknown
        self._by_word = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p, _ in vocabulary)
        self._counts = Remembered(lambda word: self.best(SPACE_MARK + word), REMEMBERED)

    def best(self, marked: str) -> int:
        """Pieces of the best path over a text whose spaces are marks."""
        n = len(marked)
        score, pieces, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self._pieces.iter(marked):
            ending[end].append(match)
        for at, char in enumerate(marked):
            best = None
            for length, own in sorted(ending[at], reverse=True):  # the earliest beginning first
                here = score[at + 1 - length] + own
                if best is None or here > best:
                    best, count = here, pieces[at + 1 - length] + 1
            stray = False
            if char not in self._single:
                here = score[at] + self._unknown
                if best is None or here > best:
                    best, stray = here, True
                    if self._bytes:
                        count = pieces[at] + len(char.encode())
                    else:
                        count = pieces[at] + (not unknown[at])
            score[at + 1], pieces[at + 1], unknown[at + 1] = best, count, stray
        return pieces[n]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if not self._by_word or not self._bytes:
            return self.best(SPACE_MARK + text.replace(" ", SPACE_MARK))
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE_MARK in text:
            return sum(map(self.best, self._words.findall(SPACE_MARK + text.replace(" ", SPACE_MARK))))
        return sum(map(self._counts.__getitem__, text.split(" ")))


_counters: dict[str, UnigramCounter] = {}


def counter(path: str) -> UnigramCounter:
    if path not in _counters:
        _counters[path] = UnigramCounter(*read_vocabulary(path))
    return _counters[path]


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_chars, n_tokens of every document."""
    path = path or vocabulary_path()

    def run(rows: list[dict]) -> Iterator[dict]:
        count = counter(path)
        for row in rows:
            yield {"doc_id": row["doc_id"], "n_chars": len(row["text"]), "n_tokens": count(row["text"])}

    return map_text(docs.select("doc_id", whole_text().alias("text")), run, "doc_id long, n_chars long, n_tokens long")
