"""Best-fit packing by sums of squares.

A document is encoded once; only what is longer than a sequence is cut. Pieces are dealt evenly over
chunks of bounded size, and each chunk is packed on its own: a piece goes where the sum, over residual gaps, of the
squared number of open sequences with that gap becomes smallest. What a chunk leaves in badly filled sequences is
dealt anew, in fewer chunks, and packed once more.

Defined cases: a null text is an empty one; an empty text has one piece, the closing id alone; repeated rows are packed
as often as they come; other columns of the input are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.llm.common import Remembered, map_text, materialise, whole_text

SEQUENCE = 2048
#: Pieces a task packs together; some 200 open gaps are spread over as many.
CHUNK = 3000
#: Sequences filled less than this are packed again with those of other chunks.
WELL_FILLED = 0.98
#: New words after which a worker forgets those not met lately.
REMEMBERED = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<long>"


def ranks_path() -> str:
    """The rank file of the vocabulary that ``byte_bpe_50k.json`` holds."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteIds:
    """Token ids of a text as little-endian 32-bit words.

    The pattern that splits text before the merges never joins a space to what stands before it, unless that is white
    space, too. Texts without such runs are therefore encoded word by word from memory; the others as a whole.
    """

    _run = re.compile(r"\s ")

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._encode = encoding.encode_ordinary
        self._after = Remembered(lambda word: self.whole(f" {word}"), REMEMBERED)

    def whole(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()

    def __call__(self, text: str) -> bytes:
        if self._run.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self._after.__getitem__, rest))


_encoders: dict[str, ByteIds] = {}


def encoder(path: str) -> ByteIds:
    if path not in _encoders:
        _encoders[path] = ByteIds(path)
    return _encoders[path]


def cuts(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; of several, only the first may be short."""
    if length <= limit:
        return [(0, length)]
    head = length % limit
    return ([(0, head)] if head else []) + [(at, limit) for at in range(head, length, limit)]


def token_pieces(docs: DataFrame, path: str, limit: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of every document with the checksum, and on request the ids themselves."""

    def run(rows: list[dict]) -> Iterator[dict]:
        encode = encoder(path)
        for row in rows:
            ids = encode(row["text"]) + b"\0\0\0\0"
            for k, (start, length) in enumerate(cuts(len(ids) // 4, limit)):
                own = ids[4 * start : 4 * (start + length)]
                kept = np.frombuffer(own, "<u4").tolist() if with_ids else None
                yield {"doc_id": row["doc_id"], "piece": k, "start": start, "length": length, "ids_crc32": zlib.crc32(own), "ids": kept}

    return map_text(docs.select("doc_id", whole_text().alias("text")), run, PIECES)


def least_squares(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset per piece, and how full each sequence is. Long pieces go first."""
    open_bins = np.zeros(limit + 1, dtype=np.int64)
    waiting: dict[int, list[int]] = {}
    places, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    used: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        here, after = open_bins[size:], open_bins[: limit - size + 1]
        change = 2 * (after - here + 1)
        change[0] -= 1  # a full sequence is no open one
        change = np.where(here > 0, change, 1 << 40)
        best = int(np.argmin(change))
        if change[best] <= 2 * open_bins[limit - size] + 1:
            gap = best + size
            b = waiting[gap].pop()
            open_bins[gap] -= 1
        else:
            b, gap = len(used), limit
            used.append(0)
        places[i], offsets[i] = b, used[b]
        used[b] += size
        if gap > size:
            open_bins[gap - size] += 1
            waiting.setdefault(gap - size, []).append(b)
    return places, offsets, np.array(used, dtype=np.int64)


def _packed(pieces: DataFrame, level: int, chunks: int, limit: int, last: bool) -> DataFrame:
    """Adds sequence_id, offset and settled; sequences of one level and chunk share no number with others."""
    dealt = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(chunks)))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, settled boolean"

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        places, offsets, used = least_squares(rows["length"].to_numpy(), limit)
        first = ((level << 40) + int(rows["chunk"].iat[0])) << 20
        return pd.DataFrame({
            **{c: rows[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
            "sequence_id": first + places, "offset": offsets, "settled": last | (used[places] >= WELL_FILLED * limit),
        })

    return dealt.groupBy("chunk").applyInPandas(pack, out)


def pack_pieces(pieces: DataFrame, limit: int = SEQUENCE, chunk: int = CHUNK) -> DataFrame:
    """``pieces`` (stored) with sequence_id and offset."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    n = pieces.where(F.col("length") < limit).count()
    full = pieces.where(F.col("length") >= limit).select(
        *names,
        # A full piece is a sequence of its own; the number only has to be unlike any other.
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    first = materialise(_packed(pieces.where(F.col("length") < limit).select(*names), 1, -(-n // chunk) or 1, limit, False), "packed")
    rest = first.where(~F.col("settled")).select(*names)
    again = _packed(rest, 2, -(-rest.count() // chunk) or 1, limit, True)
    return full.unionByName(first.where("settled").drop("settled")).unionByName(again.drop("settled"))


def pack_documents(docs: DataFrame, path: str | None = None, limit: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all pieces."""
    pieces = materialise(token_pieces(docs, path or ranks_path(), limit).drop("ids"), "pieces")
    return pack_pieces(pieces, limit)
