"""Toxicity by fuzzy lexicon matches in their context.

The lexicon is a set of word stems, each with a weight, learned from labelled documents. Levenshtein automata of the stems are
intersected with the stems' trie: a state is the set of (trie node, edits so far) that the letters read may stand for. States and
their successors are built when a word first needs them, so a word costs one look-up per letter and most words end after a few.

A match counts by its weight. Its context window says whether it stands within quotation marks or after a reporting word, or beside an
address ("you"); those shares of a document's matches, and that of misspelt ones, are features of their own. A logistic model learns from the labels how much each
counts, and turns them into a score. Where no label tells, a quoted match counts ``QUOTED_PRIOR`` of another.

A stem has to tell toxic documents by more than chance: were its bearers drawn at random from the labelled documents, so many toxic ones among them have to be so rare that
of all beginnings tried ``CHANCE`` would be expected to pass. Few labels thus teach the frequent words only.

Learning uses at most ``TOXIC_SAMPLE`` toxic and ``CLEAN_SAMPLE`` other labelled documents, chosen by hash; scoring is
the same for every document. A misspelling that sampled clean documents use is an innocent word, unless toxic ones tell it as surely
as they have to tell a stem. Words that one clean document alone uses say how often a further one brings a word not seen yet; where that is
too often for the stem's toxic bearers, a misspelling has to be the whole word, but for a plural ending. All of it are shares, alike for every sample size.

Defined cases: null and empty texts score as documents without a match; documents without a label are scored all the same; a document with
several labels or a repeated id learns from each row; a null label is left out; with no labels of one kind every score is 0; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.llm.common import Remembered, keep_rows, map_text, materialise, whole_text

HOLD_OUT = 5
TOXIC_SAMPLE = 4_000
CLEAN_SAMPLE = 12_000
STEM_LENGTHS = (3, 10)
#: A stem is in so many toxic documents at least, and in so large a share of them.
LEAST_BEARERS = 4
LEAST_SHARE = 0.01
#: Share of the toxic bearers among all, were both kinds equally frequent.
LEAST_PRECISION = 0.98
#: Stems expected to pass by chance alone.
CHANCE = 0.05
QUOTED_PRIOR = 0.4
CONTEXT_WORDS = 6
PLAIN, QUOTED, ADDRESSED = "plain", "quoted", "addressed"
#: New words after which a worker forgets those not met lately.
REMEMBERED = 50_000

# Reporting words, forms of address, endings that a misspelt word may have, letters written as digits or signs.
REPORTING = frozenset("said says wrote writes called quote quoted quotes word term phrase sagte schrieb wort dit mot terme dijo palabra".split())
ADDRESS = frozenset("you your youre u du dich dein ihr tu toi ton vous votre usted eres".split())
PLURALS = frozenset(["", "s", "es", "e", "en"])
LEET = str.maketrans("013457@$!", "oieastasi")
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’", "»": "«"}

_word = re.compile(r"[^\W_](?:[^\s|/,;:\-]*[^\W_])?")


def words_with_places(text: str) -> list[tuple[str, int, int]]:
    return [(m.group().lower(), m.start(), m.end()) for m in _word.finditer(text)]


@dataclass
class Lexicon:
    """Stems with their weights; words that only look like a misspelt stem; stems whose misspellings are whole words."""

    weights: dict[str, float]
    innocent: frozenset[str] = frozenset()
    whole_only: frozenset[str] = frozenset()
    coefficients: list[float] = field(default_factory=list)
    intercept: float = 0.0


def edits_allowed(stem: str) -> int:
    return 0 if len(stem) < 5 else 1 if len(stem) < 9 else 2


class FuzzyTrie:
    """Words within the allowed edits of a stem, or whose beginning is, where the word goes on after the stem.

    With an edit, a stem of ``whole_only`` has to be the word up to its plural ending.
    """

    def __init__(self, stems: list[str], whole_only: frozenset[str] = frozenset()):
        self._next: list[dict[str, int]] = [{}]
        self._stem: list[str | None] = [None]
        self._most = [0]
        for stem in sorted(stems):
            edits, node, path = edits_allowed(stem), 0, [0]
            for letter in stem:
                if letter not in self._next[node]:
                    self._next[node][letter] = len(self._next)
                    self._next.append({})
                    self._stem.append(None)
                    self._most.append(0)
                node = self._next[node][letter]
                path.append(node)
            self._stem[node] = stem
            for n in path:
                self._most[n] = max(self._most[n], edits)
        self._allowed = {s: edits_allowed(s) for s in stems}
        self._whole_only = whole_only
        self._states: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._found: list[tuple[int, int, str] | None] = []
        self._found_whole: list[tuple[int, int, str] | None] = []
        self._moves: list[dict[str, int]] = []
        self._start = self._state({(0, 0)})

    def _state(self, reached: set[tuple[int, int]]) -> int:
        """Number of the state, with the letters that a word may lack filled in."""
        todo, least = list(reached), {}
        while todo:
            node, edits = todo.pop()
            if edits > self._most[node] or least.get(node, 99) <= edits:
                continue
            least[node] = edits
            todo += [(child, edits + 1) for child in self._next[node].values()]
        key = frozenset(least.items())
        if key not in self._states:
            self._states[key] = len(self._sets)
            self._sets.append(key)
            ends = [(e, -len(s), s) for n, e in key if (s := self._stem[n]) and e <= self._allowed[s]]
            self._found.append(min((x for x in ends if not x[0] or x[2] not in self._whole_only), default=None))
            self._found_whole.append(min(ends, default=None))
            self._moves.append({})
        return self._states[key]

    def _move(self, state: int, letter: str) -> int:
        reached = set()
        for node, edits in self._sets[state]:
            reached.add((node, edits + 1))
            for other, child in self._next[node].items():
                reached.add((child, edits + (other != letter)))
        self._moves[state][letter] = to = self._state(reached) if reached else -1
        if to >= 0 and not self._sets[to]:
            self._moves[state][letter] = to = -1
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """The stem with the fewest edits, of these the longest, then the first."""
        state, best = self._start, None
        for at, letter in enumerate(word, 1):
            to = self._moves[state].get(letter)
            state = self._move(state, letter) if to is None else to
            if state < 0:
                break
            found = (self._found_whole if word[at : at + 3] in PLURALS else self._found)[state]
            if found and (best is None or found < best):
                best = found
        return (best[2], best[0]) if best else None


class Matcher:
    """Matches of a text as (word, stem, edits, context)."""

    def __init__(self, lexicon: Lexicon):
        self._trie = FuzzyTrie(list(lexicon.weights), whole_only=lexicon.whole_only)
        self._innocent = lexicon.innocent
        self._known = Remembered(self._look_up, REMEMBERED)

    def _look_up(self, word: str) -> tuple[str, int] | None:
        found = self._trie.match(word)
        if found is None and not word.isalpha():
            found = self._trie.match(word.translate(LEET))
            found = found and (found[0], max(1, found[1]))
        if found and found[1] and word in self._innocent:
            found = None
        return found

    def __call__(self, text: str) -> tuple[int, list[tuple[str, str, int, str]]]:
        words = _word.findall(text.lower())
        hits = {w: found for w in set(words) if (found := self._known[w])}
        if not hits:
            return len(words), []
        placed = words_with_places(text)
        names = [w for w, _, _ in placed]
        out = []
        for i, (word, start, end) in enumerate(placed):
            if word in hits:
                out.append((word, *hits[word], self._context(text, names, i, start, end)))
        return len(words), out

    @staticmethod
    def _context(text: str, names: list[str], i: int, start: int, end: int) -> str:
        left, right = text[max(0, start - 60) : start], text[end : end + 60]
        within = any(left.count(a) > (left.count(b) if a != b else left.count(a) // 2 * 2) and b in right for a, b in QUOTES.items())
        window = names[max(0, i - CONTEXT_WORDS) : i] + names[i + 1 : i + 1 + CONTEXT_WORDS]
        if within or REPORTING & set(names[max(0, i - 3) : i]):
            return QUOTED
        return ADDRESSED if ADDRESS & set(window) else PLAIN


def features_of(lexicon: Lexicon, n_words: int, matches: list[tuple[str, str, int, str]]) -> list[float]:
    """Strongest match, sum of matches, different stems, matches per 100 words; shares of misspelt, quoted and addressed ones."""
    weighted = [(lexicon.weights[stem] * (QUOTED_PRIOR if context == QUOTED else 1.0), edits, context) for _, stem, edits, context in matches]
    total = sum(w for w, _, _ in weighted)
    share = lambda kind: sum(w for w, edits, context in weighted if kind(edits, context)) / total if total else 0.0
    return [
        max((w for w, _, _ in weighted), default=0.0),
        math.log1p(total),
        math.log1p(len({stem for _, stem, _, _ in matches})),
        math.log1p(100 * total / max(50, n_words)),
        share(lambda edits, _: edits > 0),
        share(lambda _, context: context == QUOTED),
        share(lambda _, context: context == ADDRESSED),
    ]


def is_held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(HOLD_OUT)) == 0


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the sampled documents that are not held out.

    The kinds are thinned by hash to about twice the bound, then the first by hash are taken.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~is_held_out()).select("doc_id", "toxic")
    order = F.xxhash64("doc_id", F.lit(11))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for kind, bound in ((1, TOXIC_SAMPLE), (0, CLEAN_SAMPLE)):
        share = min(1.0, 2 * bound / max(1, sizes.get(kind, 0)))
        of_kind = known.where((F.col("toxic") == kind) & (F.pmod(F.shiftright(order, 8), F.lit(1_000_000)) < share * 1_000_000))
        of_kind = of_kind.orderBy(order, "doc_id").limit(bound)
        chosen = of_kind if chosen is None else chosen.unionByName(of_kind)
    chosen = materialise(chosen, "chosen")  # bounded, so Spark may broadcast it
    return materialise(docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id"), "sample")


def bearer_of(words: set[str]) -> int:
    """The least hash of a document's words, which copies have in common."""
    return min((zlib.crc32(w.encode()) * 0x9E3779B1 % 2**32 for w in words), default=0)


def learn_stems(sample: DataFrame) -> dict[str, float]:
    """The shortest word beginnings that tell toxic documents, each as long as it can be without losing one.

    Bearers are counted by ``bearer_of``: a word that one text and its copies bear is no evidence.
    """
    least, most = STEM_LENGTHS
    kinds = sample.select("toxic", "text")

    def beginnings(rows: list[dict]) -> Iterator[dict]:
        for row in rows:
            words = {w for w in _word.findall(row["text"].lower()) if len(w) >= least}
            bearer = bearer_of(words)
            for stem in {"", *(w[:k] for w in words for k in range(least, min(most, len(w)) + 1))}:
                yield {"stem": stem, "bearer": bearer}

    def counts(kind: int) -> DataFrame:
        own = map_text(kinds.where(F.col("toxic") == kind), beginnings, "stem string, bearer long")
        return own.distinct().groupBy("stem").agg(F.count(F.lit(1)).alias(f"n{kind}"))

    toxic, clean = materialise(counts(1), "toxic_stems"), materialise(counts(0), "clean_stems")
    n_toxic = toxic.where("stem = ''").first().n1  # the empty beginning is in every document
    n_clean = clean.where("stem = ''").first().n0
    tried = toxic.join(clean, "stem", "left_anti").count() + clean.count()
    share = n_toxic / (n_toxic + n_clean)
    # All bearers toxic is the rarest case, so this many are needed at least.
    needed = math.log(CHANCE / tried) / math.log(share)
    candidates = toxic.where((F.col("n1") >= max(LEAST_BEARERS, LEAST_SHARE * n_toxic, needed)) & (F.col("stem") != ""))
    joined = candidates.join(clean, "stem", "left").select("stem", "n1", F.coalesce("n0", F.lit(0)).alias("n0"))
    share1, share0 = F.col("n1") / n_toxic, F.col("n0") / n_clean
    precise = joined.where(share1 / (share1 + share0) >= LEAST_PRECISION)
    # Bounded by the beginnings that the sample's toxic documents have in common.
    found = {r.stem: (r.n1, r.n0) for r in precise.collect() if by_chance(r.n1, r.n0, share) * tried <= CHANCE}
    weights: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        if any(stem[:k] in found for k in range(least, len(stem))):
            continue
        longest = stem
        while more := [s for s in found if len(s) == len(longest) + 1 and s.startswith(longest) and found[s][0] == found[stem][0]]:
            longest = more[0]
        n1, n0 = found[longest]
        weights[longest] = math.log((n1 + 0.5) / (n_toxic + 1)) - math.log((n0 + 0.5) / (n_clean + 1))
    return weights


def by_chance(n1: int, n0: int, share: float) -> float:
    """Probability of at least ``n1`` toxic documents among ``n1 + n0`` drawn at random."""
    n = n1 + n0
    logs = (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
        for k in range(n1, n + 1)
    )
    return sum(map(math.exp, logs))


def innocent_words(sample: DataFrame, lexicon: Lexicon) -> tuple[frozenset[str], frozenset[str]]:
    """Misspellings that clean documents use, and the stems whose misspellings have to be whole words.

    What is collected is bounded by the words of the clean sample.
    """

    def found(rows: list[dict]) -> Iterator[dict]:
        match = Matcher(lexicon)
        for row in rows:
            bearer = bearer_of({w for w in _word.findall(row["text"].lower()) if len(w) >= STEM_LENGTHS[0]})
            for stem, word in {("", ""), *((s, w if edits else "") for w, s, edits, _ in match(row["text"])[1])}:
                yield {"toxic": int(row["toxic"]), "stem": stem, "word": word, "bearer": bearer}

    matches = map_text(sample.select("toxic", "text"), found, "toxic int, stem string, word string, bearer long").distinct()
    counts = matches.groupBy("stem", "word").agg(F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0"))
    bearers = {(r.stem, r.word): (r.n1, r.n0) for r in counts.where("n0 > 0 or word = ''").collect()}
    n_toxic, n_clean = bearers["", ""]

    def telling(n1: int, n0: int) -> bool:
        return n1 >= LEAST_BEARERS and n1 / n_toxic >= LEAST_PRECISION * (n1 / n_toxic + n0 / n_clean)

    innocent = {word for (_, word), n in bearers.items() if word and not telling(*n)}
    once = Counter(stem for (stem, word), (_, n0) in bearers.items() if word and n0 == 1)
    whole = {stem for stem, n0 in once.items() if not telling(bearers.get((stem, ""), (0, 0))[0], n0)}
    return frozenset(innocent), frozenset(whole)


def matched_features(docs: DataFrame, lexicon: Lexicon, *carried: str) -> DataFrame:
    """doc_id, features and the matched words of every document."""

    def run(rows: list[dict]) -> Iterator[dict]:
        match = _matcher(lexicon)
        for row in rows:
            n_words, matches = match(row["text"])
            terms = sorted({word for word, _, _, _ in matches})
            yield {**{c: row[c] for c in ("doc_id", *carried)}, "features": features_of(lexicon, n_words, matches), "terms": terms}

    kept = docs.select("doc_id", *carried, whole_text().alias("text"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text")
    return map_text(kept, run, f"{out}, features array<double>, terms array<string>")


_matchers: dict[tuple, Matcher] = {}


def _matcher(lexicon: Lexicon) -> Matcher:
    key = (tuple(lexicon.weights.items()), lexicon.innocent, lexicon.whole_only)
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(lexicon)
    return _matchers[key]


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon | None:
    """Lexicon and logistic model of the labelled sample; None where one kind is missing."""
    from pyspark.ml.classification import LogisticRegression  # workers do not need it
    from pyspark.ml.functions import array_to_vector

    sample = labelled_sample(docs, labels)
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    lexicon = Lexicon(learn_stems(sample))
    lexicon.innocent, lexicon.whole_only = innocent_words(sample, lexicon)
    rows = materialise(matched_features(sample, lexicon, "toxic"), "features")
    training = rows.select(array_to_vector("features").alias("features"), F.col("toxic").cast("double").alias("label"))
    model = LogisticRegression(regParam=0.001, maxIter=50).fit(training)
    lexicon.coefficients, lexicon.intercept = [float(x) for x in model.coefficients], float(model.intercept)
    return lexicon


def score_documents(docs: DataFrame, lexicon: Lexicon | None, *carried: str) -> DataFrame:
    """doc_id, score and matched words."""
    if lexicon is None:
        return docs.select("doc_id", *carried, F.lit(0.0).alias("score"), F.array().cast("array<string>").alias("terms"))
    scored = matched_features(docs, lexicon, *carried)
    linear = F.lit(lexicon.intercept)
    for k, c in enumerate(lexicon.coefficients):
        linear = linear + F.lit(c) * F.col("features")[k]
    return scored.select("doc_id", *carried, (1 / (1 + F.exp(-linear))).alias("score"), "terms")


def without_toxic(docs: DataFrame, lexicon: Lexicon | None, limit: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that score less than ``limit``."""
    if lexicon is None:
        return docs

    def passes() -> Callable[[str], bool]:
        match = _matcher(lexicon)

        def clean(text: str) -> bool:
            values = features_of(lexicon, *match(text))
            linear = lexicon.intercept + sum(c * v for c, v in zip(lexicon.coefficients, values, strict=True))
            return 1 / (1 + math.exp(-linear)) < limit

        return clean

    return keep_rows(docs, passes)


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(docs, learn(docs, labels))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "terms")
