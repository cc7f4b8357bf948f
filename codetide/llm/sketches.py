"""Bottom-k sketches of word shingles.

A text's shingles are its runs of five words, each hashed to 64 bits; the sketch is the ``SIZE`` least different hashes in ascending order. The sketch of
several texts is that of their sketches' union, so sketches are made per part and merged. Of two sketches the least ``SIZE`` hashes of
both together are a random sample of the union: the share of it that both have estimates the resemblance. A sketch that is not full has all
hashes, and estimates from such ones are exact; of a full one the largest hash tells how densely the hashes lie, and so how many there are.

``neighbour_query`` compares each document with the next one, by descending doc_id, and with a text whose end is replaced by the beginning of
the next one. Documents are dealt to cells of neighbouring ids, whose bounds come from a sample of the ids: it decides about the balance of the
cells only. The first document of the next cell joins each cell, so neighbours meet in one shuffle of the texts.

Words stand between the white space U+0020 and U+0009 to U+000D. Everything here is built-in expressions.

Defined cases: a null text is an empty one; a text without words has an empty sketch, as like another empty one as can be (1) and unlike all others
(0); fewer than five words are one shingle; a null doc_id comes last; documents with the same doc_id follow each other in the order of a hash of their texts, each being
the next of the one before it; the next of a lone document is itself; a document whose sketch is
full has its distinct shingles estimated; doc_id is taken for a key: rows of one doc_id are sorted in one task, which spills. Other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetide.llm.common import materialise, whole_text
from codetide.llm.quality import let, words_of

SHINGLE = 5
SIZE = 128
#: Documents of a cell, and ids of it that the sample of bounds has, on average.
CELL = 2_000
SAMPLED = 32


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """A hash per run of ``shingle`` words; of fewer words one, of none none."""

    def of(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (shingle - 1), F.least(F.size(w), F.lit(1))))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, shingle))))

    return let(words_of(text), of)


def least(hashes: Column, size: int = SIZE) -> Column:
    """The sketch of hashes or of the union of sketches: the least different ones, ascending."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, size)


def sketch(text: Column, size: int = SIZE) -> Column:
    return least(shingle_hashes(text), size)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    return least(F.concat(a, b), size)


def merged_sketches(sketched: DataFrame, *by: str, size: int = SIZE) -> DataFrame:
    """Sketch per group of rows with a column ``sketch``.

    A task keeps the least hashes of each group that it sees, so a hot group sends no more than a sketch per task.
    """
    order = Window.partitionBy(*by).orderBy("hash")
    hashes = sketched.select(*by, F.explode("sketch").alias("hash"))
    ranked = hashes.groupBy(*by, "hash").agg(F.lit(None)).withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return ranked.groupBy(*by).agg(F.array_sort(F.collect_list("hash")).alias("sketch"))


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the shingles of two texts that both have."""
    return let(
        merged(a, b, size),
        lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)),
    )


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimated number of different shingles; exact where the sketch is not full."""
    density = (F.element_at(a, -1).cast("double") + 2.0**63 + 0.5) / 2.0**64
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / density)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has.

    Of the least hashes of both together, those of ``a`` are a sample of its shingles.
    """
    return let(
        F.array_intersect(merged(a, b, size), a),
        lambda own: F.when(F.size(own) == 0, F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(
            F.size(F.array_intersect(own, b)) / F.size(own)
        ),
    )


def fingerprint(a: Column) -> Column:
    """The sketch as text, 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _cell(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are less than the id, by binary search; null ids have a cell of their own, -1."""
    if not bounds:
        return F.when(doc_id.isNull(), F.lit(-1)).otherwise(F.lit(0))
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))
    below = lambda at: F.coalesce(F.get(listed, at - 1) < doc_id, F.lit(False))
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at + step), at + step).otherwise(at))
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(found)


def cell_bounds(docs: DataFrame, cell: int = CELL) -> list[int]:
    """Ids that cut the documents into cells of about ``cell``, from a sample by hash."""
    n = docs.count()
    cells = math.ceil(n / cell)
    if cells < 2:
        return []
    one_of = max(1, cell // SAMPLED)
    sample = docs.select("doc_id").where(F.pmod(F.xxhash64("doc_id"), F.lit(one_of)) == 0)
    shares = [k / cells for k in range(1, cells)]
    found = sample.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * cells))).first()[0]
    return sorted(set(found or []))


def with_next(docs: DataFrame, cell: int = CELL, size: int = SIZE) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch of every document, by descending doc_id; the last one's next is the first."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    order = F.xxhash64("text")
    celled = texts.withColumn("cell", _cell(F.col("doc_id"), cell_bounds(docs, cell)))

    # The first document of each cell also ends the cell before it; the greatest id is the first of all and ends the last one.
    ids = materialise(celled.groupBy("cell").agg(F.max("doc_id").alias("doc_id")), "cells")
    around = Window.orderBy(F.desc("cell"))  # a row per cell
    last = Window.orderBy("cell")
    ends = ids.select("cell", "doc_id", F.coalesce(F.lag("cell").over(around), F.first("cell").over(last)).alias("to"))
    ends = materialise(ends, "ends").toDF("of", "first_id", "to")
    same = (F.col("cell") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    firsts = celled.join(ends, same).groupBy("to").agg(F.min(F.struct(order.alias("o"), "doc_id", "text")).alias("x"))
    guests = firsts.select("x.doc_id", "x.text", F.col("to").alias("cell"), F.lit(True).alias("guest"))

    met = celled.withColumn("guest", F.lit(False)).unionByName(guests).repartition("cell")
    met = met.withColumn("sketch", sketch(F.col("text"), size))
    following = Window.partitionBy("cell").orderBy("guest", F.col("doc_id").desc_nulls_last(), order, "text")
    paired = met.select(
        "doc_id", "text", "sketch", "guest", F.lead("text").over(following).alias("next_text"), F.lead("sketch").over(following).alias("next_sketch")
    )
    return paired.where("not guest").drop("guest")


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the code points, rounded down, replaced by as many of the beginning of the next text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def neighbour_query(docs: DataFrame, cell: int = CELL, size: int = SIZE) -> DataFrame:
    """The fingerprint of every document and of its edited text, and how like they are; the next document's, too."""
    edited = with_next(docs, cell, size).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch",
        edited_text(F.col("text"), F.col("next_text")).alias("edited"),
    ).withColumn("edited_sketch", sketch(F.col("edited"), size))
    own, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"), fingerprint(other).alias("edited_fingerprint"),
        resemblance(own, other, size).alias("near_edited"), resemblance(own, following, size).alias("near_next"),
        containment(own, other, size).alias("kept_in_edited"), distinct_shingles(own, size).alias("distinct_shingles"),
    )
