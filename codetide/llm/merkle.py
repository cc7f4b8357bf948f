"""Merkle manifest of a data set, kept as a tree of SHA-256 midstates.

Every document is a leaf, every source a tree of runs of three, and the roots of the sources make one more tree. A parent does not only
have its digest: it keeps a copy of the hash state from before each child slot. Folding a changed leaf upwards resumes the state of its
slot with the replacement and the siblings to its right; what stands to its left is never hashed again.

Trees of any size are worked on in tiers. The nodes below a parent ``LEVELS`` levels up, 729 at most, are a subtree that one task holds; the roots of
the subtrees are the nodes of the next tier, so three tiers do for 10^8 documents of one source. States cannot leave the task that has them, so a subtree
gets the way above it as the siblings left and right of each slot and hashes each left part once, for all of its leaves. Nodes get
their places from one distributed sort and a count per sorted part; no source is ever in one task.

A document's fields are each ``-`` if null, else their UTF-8 length, ``:`` and the value. Digests are hashed as hexadecimal text.

Defined cases: a null source is a tree of its own, the first; a null doc_id is the first leaf and never tampered with; leaves with the same doc_id are ordered by
digest, so repeated rows are leaves next to each other; an empty text is a value, not a null; the proof of a lone leaf of the
only source is the digest of nothing; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetide.llm.common import map_text, materialise

#: Children of a parent; levels of a subtree that one task holds.
FAN = 3
LEVELS = 6
#: The fields of a leaf in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left: string, right: string>>"


def field_text(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """Digest of a document, some of whose fields may be replaced."""
    return F.unhex(F.sha2(F.concat(*(field_text(replaced.get(c, F.col(c))) for c in FIELDS)), 256))


def is_tampered() -> Column:
    """Whether a copy of the document without its line breaks is to be told from it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))


def document_leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, and the digest of the tampered document where it has changed."""
    changed = is_tampered() & F.contains("text", F.lit("\n"))
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("tree"),
        "doc_id",
        leaf_digest().alias("leaf"),
        F.when(changed, leaf_digest(text=F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"),
    )


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """Stored with place (from 0, by ``order`` within the tree) and size, the number of the tree's nodes.

    The sort deals equal rows out, too; a tree's rows stand together in its parts, so a count per tree and part tells the places.
    """
    salted = nodes.withColumn("salt", F.monotonically_increasing_id()).orderBy("tree", *order, "salt").drop("salt")
    stored = materialise(salted.withColumn("row", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("row", 33)
    parts = stored.groupBy("tree", part.alias("part")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    starts = parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("size"))
    starts = materialise(starts, "starts")
    joined = stored.withColumn("part", part).join(starts, ["tree", "part"])
    return joined.select(*nodes.columns, (F.col("row") + F.col("shift")).alias("place"), "size")


class Subtree:
    """Consecutive nodes and the parents above them.

    ``slots`` has for each level and node the state of the parent before the node's slot, and the siblings left and right of it. There
    are ``levels`` of them where the tree has nodes beyond these; where it is None, the subtree ends with one node.
    """

    def __init__(self, digests: list[bytes], levels: int | None = None):
        self.slots: list[list[tuple]] = []
        while len(digests) > 1 if levels is None else len(self.slots) < levels:
            slots, parents = [], []
            for at in range(0, len(digests), FAN):
                run = digests[at : at + FAN]
                state = hashlib.sha256()
                for k, child in enumerate(run):
                    slots.append((state.copy(), b"".join(run[:k]), b"".join(run[k + 1 :])))
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.slots.append(slots)
            digests = parents
        self.root = digests[0]

    def way(self, at: int) -> list[tuple]:
        """Slots from a node up to the subtree's root."""
        return [slots[at // FAN**level] for level, slots in enumerate(self.slots)]


def resumed(path: list[dict]) -> list[tuple]:
    """Slots of a way that comes from another task."""
    return [(hashlib.sha256(p["left"].encode()), p["left"].encode(), p["right"].encode()) for p in path]


def fold(digest: bytes, way: list[tuple]) -> bytes:
    """The root that results with ``digest`` in the place where the way begins."""
    for state, _, right in way:
        state = state.copy()
        state.update(digest + right)
        digest = state.hexdigest().encode()
    return digest


def proof_digest(way: list[tuple]) -> str:
    return hashlib.sha256(b"".join(left + right for _, left, right in way)).hexdigest()


def _hex(digest: bytes) -> bytes:
    return digest.hex().encode()


def _subtrees(nodes: DataFrame, levels: int, *carried: str) -> DataFrame:
    """A row per subtree: tree, place, size, and its nodes in their order, which ``levels`` bound."""
    members = F.array_sort(F.collect_list(F.struct("place", "leaf", *carried)))
    chunk = F.expr(f"place div {FAN**levels}")
    return nodes.groupBy("tree", chunk.alias("chunk")).agg(F.max("size").alias("size"), members.alias("nodes")).withColumnRenamed("chunk", "place")


def _subtree(row: dict, levels: int) -> Subtree:
    return Subtree([_hex(n["leaf"]) for n in row["nodes"]], levels if row["size"] > FAN**levels else None)


def climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tables of nodes (tree, place, size, leaf), tier by tier; in the last one each tree has one node, its root."""

    def roots(rows: list[dict]) -> Iterator[dict]:
        for row in rows:
            root = _subtree(row, levels).root
            yield {"tree": row["tree"], "place": row["place"], "size": -(-row["size"] // FAN**levels), "leaf": bytes.fromhex(root.decode())}

    tiers = [nodes]
    while len(tiers) < 2 or not tiers[-1].where("size > 1").isEmpty():
        above = map_text(_subtrees(tiers[-1], levels), roots, "tree string, place long, size long, leaf binary", 8)
        tiers.append(materialise(above, "tier"))
    return tiers


def descend(tiers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """tree, place, path, subroot of the nodes of the lowest tier, from those of the trees' roots."""

    def paths(rows: list[dict]) -> Iterator[dict]:
        for row in rows:
            subtree = _subtree(row, levels)
            for at, node in enumerate(row["nodes"]):
                own = [{"left": left.decode(), "right": right.decode()} for _, left, right in subtree.way(at)]
                yield {"tree": row["tree"], "place": node["place"], "path": own + row["path"], "subroot": row["subroot"]}

    for nodes in reversed(tiers):
        joined = _subtrees(nodes, levels).join(tops, ["tree", "place"])
        tops = materialise(map_text(joined, paths, f"tree string, place long, path {PATH}, subroot binary", 4), "paths")
    return tops


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    leaves = placed(materialise(document_leaves(docs), "leaves"), "doc_id", "leaf")
    tiers = climb(leaves.select("tree", "place", "size", "leaf"), levels)
    sources = placed(tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "leaf"), "source")
    source_tiers = climb(sources.select("tree", "place", "size", "leaf"), levels)
    top = source_tiers[-1].first()
    root = top.leaf if top else b""
    ends = source_tiers[-1].select("tree", "place", F.array().cast(PATH).alias("path"), F.col("leaf").alias("subroot"))
    # Place by place the ways of the sources, which the ways of their documents go on with.
    of_source = descend(source_tiers[:-1], ends, levels).select(F.col("place").alias("number"), "path")
    of_source = sources.select(F.col("source").alias("tree"), F.col("place").alias("number"), F.col("leaf").alias("subroot")).join(of_source, "number")
    tops = materialise(of_source.select("tree", F.lit(0).cast("long").alias("place"), "path", "subroot"), "tops")
    above = descend(tiers[1:-1], tops, levels)

    def judged(rows: list[dict]) -> Iterator[dict]:
        for row in rows:
            subtree, upper = _subtree(row, levels), resumed(row["path"])
            for at, node in enumerate(row["nodes"]):
                way = subtree.way(at) + upper
                folded = fold(_hex(node["tampered"] or node["leaf"]), way).decode()
                yield {
                    "doc_id": node["doc_id"], "leaf": node["leaf"].hex(), "subroot": row["subroot"].hex(), "root": root.hex(),
                    "proof_sha256": proof_digest(way), "folded_root": folded, "verified": folded == root.hex(),
                }

    out = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return map_text(_subtrees(leaves, levels, "doc_id", "tampered").join(above, ["tree", "place"]), judged, out, 4)
