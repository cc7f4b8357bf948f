"""Benchmark decontamination by SimHash of item-sized windows.

A benchmark item of n words is looked for in every window of n words of every document. Words are the runs of letters and digits, lower-cased; a
window is the multiset of its five-word shingles, and its fingerprint the signs of 128 sums over them. Fingerprints within
``RADIUS`` are found without loss by multi-index Hamming blocks: of 16 blocks of 8 bits at least one differs in two bits
at most, so each block has a table from its 256 values to the items within two bits. What the tables give is
compared in all bits, then by the exact weighted overlap: the share of the item's shingles, with their multiplicity, that the window has.

A window without ``THRESHOLD`` of its shingles among all the benchmark's cannot reach that share with any item; such windows
are left out before they are fingerprinted, which loses nothing. Fingerprints of an overlap at the threshold differ in 26 bits on
average with a deviation of 4.6, so the radius of 47 misses one of 300,000 of them, and none of higher overlap. A document shorter than an
item is one window, which may still hold that share of it.

Windows are worked on ``PIECE`` at a time, whatever the length of a text. Of an item's windows those with the most shingles of the item are compared first, and the rest
only as long as they could be better, so a text that repeats a passage costs little more than one that has it once.

The items are the stated query set: they are collected in blocks of about ``ITEMS`` by hash, and each block is one pass over the documents whose result is
stored before the next block is collected.

Defined cases: null and empty texts match nothing; items with fewer than five words have no shingle and are found nowhere; equal items are
found each; of equally good windows the first is reported; repeated documents are reported each; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.llm.common import item_blocks, keep_rows, map_text, materialise, text_key, whole_text
from codetide.llm.shingles import SHINGLE, mixed, shingle_numbers, word_numbers

THRESHOLD = 0.8
RADIUS = 47
BLOCKS = 16
BLOCK_ERRORS = RADIUS // BLOCKS
ITEMS = 2048
#: Windows fingerprinted at a time.
PIECE = 2048
#: Windows that are not worth looking for equal ones among.
FEW = 128

_word = re.compile(r"[^\W_]+")
_NEAR = np.array([[bin(a ^ b).count("1") <= BLOCK_ERRORS for b in range(256)] for a in range(256)])


def words_of(text: str) -> list[str]:
    return _word.findall(text.lower())


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 128 bits of each shingle."""
    words = np.stack([mixed(shingles), mixed(shingles ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """128 bits as 16 bytes, of sums over the signs."""
    return np.packbits(sums > 0, axis=1)


class BenchmarkIndex:
    """Items by size, and for each block of the fingerprint the items near each of its values."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.shingles = [], []
        for item_id, text in items:
            words = words_of(text or "")
            if len(words) >= SHINGLE:
                self.ids.append(item_id)
                self.shingles.append(shingle_numbers(word_numbers(words)))
        self.all = np.unique(np.concatenate(self.shingles)) if self.ids else np.zeros(0, dtype=np.uint64)
        self.counts = [np.unique(s, return_counts=True) for s in self.shingles]
        prints = np.concatenate([fingerprint(signs(s).sum(axis=0, dtype=np.int64)[None, :]) for s in self.shingles]) if self.ids else np.zeros((0, BLOCKS), np.uint8)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = {}
        sizes = np.array([len(s) for s in self.shingles])
        for size in np.unique(sizes):
            of_size = np.flatnonzero(sizes == size)
            own = prints[of_size]
            self.by_size[int(size)] = (of_size, own, [_NEAR[:, own[:, b]] for b in range(BLOCKS)])

    def near(self, size: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of window and item, item by item, of all fingerprints within the radius. Of many equal fingerprints are compared once."""
        of_size, own, tables = self.by_size[size]
        once, same = found, slice(None)
        if len(found) > FEW:
            once, same = np.unique(np.ascontiguousarray(found).view(f"V{BLOCKS}").ravel(), return_inverse=True)
            once = once.view(np.uint8).reshape(-1, BLOCKS)
        candidate = np.zeros((len(once), len(of_size)), dtype=bool)
        for b, table in enumerate(tables):
            candidate |= table[once[:, b]]
        mine, others = (np.ascontiguousarray(x).view(np.uint64) for x in (once, own))
        apart = np.zeros(candidate.shape, dtype=np.uint8)
        for k in range(mine.shape[1]):
            apart += np.bitwise_count(mine[:, k, None] ^ others[None, :, k])
        items, windows = np.nonzero((candidate & (apart <= RADIUS)).T[:, same])
        return windows, of_size[items]

    def covered(self, item: int, window: np.ndarray) -> float:
        values, counts = self.counts[item]
        got, often = np.unique(window, return_counts=True)
        _, mine, theirs = np.intersect1d(values, got, assume_unique=True, return_indices=True)
        return float(np.minimum(counts[mine], often[theirs]).sum() / counts.sum())

    def matches(self, text: str, threshold: float = THRESHOLD) -> list[tuple[int, float, int]]:
        """(item_id, overlap, first word) of the best window of each item found."""
        words = words_of(text)
        if len(words) < SHINGLE or not self.ids:
            return []
        shingles = shingle_numbers(word_numbers(words))
        place = np.searchsorted(self.all, shingles)
        place[place == len(self.all)] = 0
        known = self.all[place] == shingles
        if not known.any():
            return []
        sums = np.concatenate([[0], np.cumsum(known)])
        best: dict[int, tuple[float, int]] = {}
        for size in self.by_size:
            width = min(size, len(shingles))
            starts = np.flatnonzero(sums[width:] - sums[:-width] >= threshold * size)
            if not len(starts):
                continue
            for stretch in np.split(starts, np.flatnonzero(np.diff(starts) > width) + 1):
                for at in range(0, len(stretch), PIECE):
                    self._best_of(shingles, stretch[at : at + PIECE], size, width, threshold, best)
        return sorted((self.ids[i], share, -at) for i, (share, at) in best.items())

    def _best_of(self, shingles: np.ndarray, starts: np.ndarray, size: int, width: int, threshold: float, best: dict) -> None:
        """Compare the windows of ``width`` shingles at ``starts`` with the items of ``size``."""
        low = starts[0]
        here = shingles[low : starts[-1] + width]
        running = np.cumsum(signs(here), axis=0, dtype=np.int32)
        running = np.concatenate([np.zeros((1, running.shape[1]), dtype=np.int32), running])
        windows, items = self.near(size, fingerprint(running[starts - low + width] - running[starts - low]))
        for of_item in np.split(np.arange(len(items)), np.flatnonzero(np.diff(items)) + 1) if len(items) else ():
            item = int(items[of_item[0]])
            inside = np.concatenate([[0], np.cumsum(np.isin(here, self.counts[item][0]))])
            offsets = starts[windows[of_item]] - low
            most = (inside[offsets + width] - inside[offsets]) / size  # what a window could cover at best
            for k in np.argsort(-most, kind="stable"):
                at, held = int(offsets[k]), best.get(item, (threshold, -np.inf))
                if most[k] < held[0]:
                    break
                if (most[k], -(low + at)) > held:
                    share = self.covered(item, here[at : at + width])
                    best_here = (share, -int(low + at))
                    if share >= threshold and best_here > held:
                        best[item] = best_here


def _index(items: list[tuple[int, str]], known: dict) -> BenchmarkIndex:
    key = hash(tuple(items))
    if key not in known:
        known.clear()
        known[key] = BenchmarkIndex(items)
    return known[key]


_indexes: dict[int, BenchmarkIndex] = {}


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, size: int = ITEMS) -> DataFrame:
    """doc_id, item_id, similarity, first_word: the best window of every item found in a document."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    return _found(texts, benchmark, threshold, size, "doc_id long")


def _found(texts: DataFrame, benchmark: DataFrame, threshold: float, size: int, carried: str) -> DataFrame:
    """A row per item found, with the columns of ``carried``."""
    out, names = f"{carried}, item_id long, similarity double, first_word long", [c.split()[0] for c in carried.split(", ")]
    found = texts.sparkSession.createDataFrame([], out)
    for block in item_blocks(benchmark.select("item_id", whole_text().alias("text")), size, "item_id", "text"):

        def run(rows: list[dict], items: list[tuple[int, str]] = block) -> Iterator[dict]:
            index = _index(items, _indexes)
            for row in rows:
                for item_id, share, at in index.matches(row["text"], threshold):
                    yield {**{c: row[c] for c in names}, "item_id": item_id, "similarity": share, "first_word": at}

        found = found.unionByName(materialise(map_text(texts, run, out), "leaks"))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, size: int = ITEMS) -> DataFrame:
    """The documents, with all their columns, in which no item is found.

    One block of items is looked for where the documents are. With several, the texts that hold an item of any are listed by digest.
    """
    items = benchmark.select("item_id", whole_text().alias("text"))
    if items.distinct().count() > size:
        texts = docs.select(text_key().alias("key"), whole_text().alias("text"))
        listed = materialise(_found(texts, benchmark, threshold, size, "key string").select("key").distinct(), "listed")
        mine, leaked = docs.alias("mine"), listed.alias("leaked")
        return mine.join(leaked, text_key("mine.text") == F.col("leaked.key"), "left_anti")
    block = [tuple(r) for r in items.distinct().collect()]

    def passes() -> Callable[[str], bool]:
        index = _index(block, _indexes)
        return lambda text: not index.matches(text, threshold)

    return keep_rows(docs, passes)
