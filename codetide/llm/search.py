"""Ranked lexical search for benchmark items with trees of documents.

A pass over the documents counts each one's terms and keeps its vector restricted to the items' terms. The documents of a block stand in an
FP-tree: their terms in the order of descending document frequency are paths of a trie, so documents share the nodes of the terms that they begin with.
A node knows the largest tf of every term and the least m among the documents below it. As a score grows with tf and falls with m, both
give an upper bound for every item; the search goes down, the most promising children first, with the items whose bound reaches their fiftieth best score so far,
and ends a branch where no item is left. What is left at the leaves is scored exactly, so nothing is lost but documents that cannot rank.

The best of a task are carried from block to block; tasks return ``TOP`` documents per item at most, and the last step ranks those.
Items are the stated query set: they are collected in blocks of about ``ITEMS``, each of which is one pass over the documents.

Terms are the runs of ASCII letters, digits and other than ASCII characters; only A-Z are lower-cased. A score is a sum of integers.

Defined cases: null and empty texts have no term and do not count; an item without a term, or with terms that no document has, gets no rows; rows with the same item_id are one
item with the terms of all; a null item_id is an item, too; equal scores rank by doc_id, a null one first; repeated documents are ranked each; other columns are ignored; no
documents or no items give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetide.llm.common import in_batches, item_blocks, materialise, whole_text

TOP = 50
ITEMS = 2048
#: Documents of a tree, and of its leaves.
BLOCK, LEAF = 8192, 32
#: Texts taken out of an Arrow batch at a time.
SLICE = 256

_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).replace(
    bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
)


def terms_of(text: str) -> list[bytes]:
    """In UTF-8 all bytes of other than ASCII characters are above 0x7F."""
    return text.encode().translate(_TERM_BYTES).split()


def term_weight(n_documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency + 1)))


def length_weight(n_terms: int, n_documents: int, all_terms: int) -> int:
    return 100 - 50 + (50 * n_terms * n_documents) // all_terms


def contribution(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Items:
    """Items with their distinct terms, numbered."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        terms: dict[int | None, set[bytes]] = {}
        for item_id, text in rows:
            terms.setdefault(item_id, set()).update(terms_of(text))
        self.ids = list(terms)
        self.numbers = {t: k for k, t in enumerate(sorted(set().union(*terms.values())))}
        self.of_item = [sorted(self.numbers[t] for t in own) for own in terms.values()]


class Ranking:
    """Terms by rank, the most frequent first: their weights and the items that have them."""

    def __init__(self, items: Items, frequency: dict[int, int], n_documents: int):
        by_rank = sorted(range(len(items.numbers)), key=lambda t: (-frequency.get(t, 0), t))
        self.rank = np.empty(len(by_rank), dtype=np.int32)
        self.rank[by_rank] = np.arange(len(by_rank), dtype=np.int32)
        self.weight = np.array([term_weight(n_documents, frequency.get(t, 0)) for t in by_rank], dtype=np.int64)
        pairs = sorted((int(self.rank[t]), i) for i, own in enumerate(items.of_item) for t in own)
        self.items = np.array([i for _, i in pairs], dtype=np.int64)
        self.first = np.searchsorted(np.array([r for r, _ in pairs]), np.arange(len(by_rank) + 1))
        self.ids = items.ids

    def spread(self, ranks: np.ndarray, values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        """Sums of the terms' values per row and item."""
        often = self.first[ranks + 1] - self.first[ranks]
        ends = np.cumsum(often)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - often - self.first[ranks], often)
        out = np.zeros(n_rows * len(self.ids), dtype=np.int64)
        np.add.at(out, np.repeat(row * len(self.ids), often) + self.items[place], np.repeat(values, often))
        return out.reshape(n_rows, -1)


class DocumentTree:
    """FP-tree of a block of restricted term vectors, as ranges of the documents in the order of their paths.

    A node stands for the documents ``low`` to ``high``, which share a path; its children are ranges that go on with the same term. Children of few
    documents next to each other are one leaf, as are documents of one path.
    """

    def __init__(self, ids: list, m: np.ndarray, lengths: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, leaf: int = LEAF):
        owner = np.repeat(np.arange(len(lengths)), lengths)
        order = np.lexsort((ranks, owner))
        ranks, tfs = ranks[order], tfs[order]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        coded, size = ranks.astype(">u4").tobytes(), 4
        paths = [coded[size * a : size * b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        by_path = sorted(range(len(paths)), key=paths.__getitem__)
        self.ids, self.m, self._lengths = [ids[i] for i in by_path], m[by_path], lengths[by_path]
        self.starts = np.concatenate([[0], np.cumsum(self._lengths)])
        place = np.arange(self.starts[-1]) - np.repeat(self.starts[:-1] - starts[by_path], self._lengths)
        self.ranks, self.tfs = ranks[place], tfs[place]
        self._leaf = leaf
        self.low, self.high, self.children = [], [], []
        self._grow()
        self.summary: list[tuple] = [()] * len(self.low)
        for node in reversed(range(len(self.low))):  # children come after their parents
            self.summary[node] = self._summary(node)

    def _shared(self, low: int, high: int) -> int:
        """Length of the path that the documents share: that of the first and the last."""
        a, b = (self.ranks[self.starts[i] : self.starts[i + 1]] for i in (low, high - 1))
        n = min(len(a), len(b))
        unlike = np.flatnonzero(a[:n] != b[:n])
        return int(unlike[0]) if len(unlike) else n

    def _grow(self) -> None:
        todo = [(0, len(self.ids), -1)]
        while todo:
            low, high, parent = todo.pop()
            node = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if high - low > self._leaf:
                todo += [(a, b, node) for a, b in self._ranges(low, high)]

    def _ranges(self, low: int, high: int) -> list[tuple[int, int]]:
        depth = self._shared(low, high)
        longer = self._lengths[low:high] > depth
        following = np.full(high - low, -1)
        following[longer] = self.ranks[self.starts[low:high][longer] + depth]
        cuts = [low, *(low + 1 + np.flatnonzero(np.diff(following))).tolist(), high]
        out: list[tuple[int, int]] = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == low and not longer[0]:  # documents that end here have one path
                out += [(k, min(k + self._leaf, b)) for k in range(a, b, self._leaf)]
            elif out and b - out[-1][0] <= self._leaf:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    def _summary(self, node: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Terms of the documents below, the largest tf of each, the least m."""
        if self.children[node]:
            below = [self.summary[c] for c in self.children[node]]
            ranks, tfs = np.concatenate([b[0] for b in below]), np.concatenate([b[1] for b in below])
            m = min(b[2] for b in below)
        else:
            low, high = self.low[node], self.high[node]
            ranks, tfs = (x[self.starts[low] : self.starts[high]] for x in (self.ranks, self.tfs))
            m = int(self.m[low:high].min())
        order = np.argsort(ranks, kind="stable")
        ranks, tfs = ranks[order], tfs[order]
        heads = np.flatnonzero(np.diff(ranks, prepend=-1))
        return ranks[heads], np.maximum.reduceat(tfs, heads) if len(heads) else tfs, m


class Search:
    """The best documents per item so far."""

    def __init__(self, ranking: Ranking, top: int = TOP):
        self._ranking, self._top = ranking, top
        self._best: list[list[tuple]] = [[] for _ in ranking.ids]
        self.least = np.ones(len(ranking.ids), dtype=np.int64)  #: score that a document has to reach
        self.scored = 0

    def _bound(self, tree: DocumentTree, node: int) -> np.ndarray:
        ranks, tfs, m = tree.summary[node]
        values = contribution(self._ranking.weight[ranks], tfs, m)
        return self._ranking.spread(ranks, values, np.zeros(len(ranks), dtype=np.int64), 1)[0]

    def add(self, tree: DocumentTree) -> None:
        todo = [(0, np.arange(len(self.least)), self._bound(tree, 0))]
        while todo:
            node, active, bound = todo.pop()
            active = active[bound[active] >= self.least[active]]
            if not len(active):
                continue
            if not tree.children[node]:
                self._score(tree, node, active)
                continue
            bounds = [(self._bound(tree, c), c) for c in tree.children[node]]
            bounds.sort(key=lambda x: int(x[0][active].max()))  # the most promising is taken first
            todo += [(c, active, b) for b, c in bounds]

    def _score(self, tree: DocumentTree, node: int, active: np.ndarray) -> None:
        low, high = tree.low[node], tree.high[node]
        inside = slice(tree.starts[low], tree.starts[high])
        row = np.repeat(np.arange(high - low), np.diff(tree.starts[low : high + 1]))
        values = contribution(self._ranking.weight[tree.ranks[inside]], tree.tfs[inside], tree.m[low + row])
        scores = self._ranking.spread(tree.ranks[inside], values, row, high - low)[:, active]
        self.scored += high - low
        for i, k in zip(*np.nonzero(scores >= self.least[active]), strict=True):
            self._offer(int(active[k]), int(scores[i, k]), tree.ids[low + i])

    def _offer(self, item: int, score: int, doc_id: int | None) -> None:
        own, entry = self._best[item], (score, math.inf if doc_id is None else -doc_id)
        if len(own) < self._top:
            heapq.heappush(own, entry)
        elif entry > own[0]:
            heapq.heapreplace(own, entry)
        if len(own) == self._top:
            self.least[item] = max(1, own[0][0])

    def found(self) -> Iterator[dict]:
        for item_id, own in zip(self._ranking.ids, self._best, strict=True):
            for score, key in own:
                yield {"item_id": item_id, "doc_id": None if key == math.inf else -key, "score": score}


VECTORS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def term_vectors(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, number of terms, and the items' terms with their counts, of the documents that have a term."""
    number = items.numbers.get

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for received in batches:
            for at in range(0, received.num_rows, SLICE):
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in received.slice(at, SLICE).columns), strict=True):
                    if words := terms_of(text):
                        counts = Counter(map(number, words))
                        counts.pop(None, None)
                        rows.append({"doc_id": doc_id, "n": len(words), "terms": list(counts), "tfs": list(counts.values())})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=VECTORS)

    return in_batches(docs.select("doc_id", whole_text().alias("text")), run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for received in batches:
        for at in range(0, received.num_rows, size):
            held.append(received.slice(at, size))
            n += held[-1].num_rows
            if n >= size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])


def best_documents(vectors: DataFrame, ranking: Ranking, n_documents: int, all_terms: int, top: int, block: int, leaf: int) -> DataFrame:
    """item_id, doc_id, score of the best documents of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(ranking, top)
        for table in _blocks(batches, block):
            lengths = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in table["terms"].chunks])
            m = np.array([length_weight(n, n_documents, all_terms) for n in table["n"].to_pylist()], dtype=np.int64)
            ranks, tfs = ranking.rank[_flat(table["terms"])], _flat(table["tfs"]).astype(np.int64)
            search.add(DocumentTree(table["doc_id"].to_pylist(), m, lengths.astype(np.int64), ranks, tfs, leaf))
        rows = list(search.found())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=FOUND)

    return in_batches(vectors, run, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, benchmark: DataFrame, top: int = TOP, size: int = ITEMS, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` documents of each item."""
    found = []
    for rows in item_blocks(benchmark.select("item_id", whole_text().alias("text")).distinct(), size, "item_id"):
        items = Items(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
        vectors = materialise(term_vectors(docs, items), "vectors")
        n_documents, all_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_documents or not items.numbers:
            continue
        counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        frequency = {r.term: r.df for r in counted.collect()}  # as many as the block's items have terms
        best = best_documents(vectors, Ranking(items, frequency, n_documents), n_documents, all_terms, top, block, leaf)
        found.append(materialise(best, "best"))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    ordered = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ordered.select("item_id", "rank", "doc_id", "score")
