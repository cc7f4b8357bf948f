"""Near duplicates by BagMinHash signatures, banding, and the exact multiset overlap.

A text is the multiset of its five-word shingles. The weight axis of a shingle is cut into the blocks [0, 1), [1, 2), [2, 4), [4, 8) and so
on; each block has a Poisson process whose points have a time, a level within the block and a signature slot, all drawn from the hash of
shingle and block. A text takes the points whose level lies below the shingle's multiplicity, in the order of time, until no
later one can matter. The least time per slot is the signature; two texts agree in a slot with probability equal to their weighted Jaccard similarity.

``BANDS`` bands of ``ROWS`` slots give the buckets; a pair at the threshold has none in common with probability 3e-6.
First a text is compared with the least text of its buckets. Buckets whose texts then are of one class are settled, so a group of
thousands of copies costs a few comparisons per text. In what is left, only pairs of different classes are compared: those of small buckets are
candidates, at most ``SMALL`` per text and bucket; large buckets are dealt out in blocks, and a task returns the links that join classes, never its pairs. Texts of similar length alone can be near (the
shorter has at least the threshold's share of the longer's shingles). Every link is verified on the multisets.

Defined cases: equal texts are one node, so copies cost nothing more; fewer than five words are one shingle; texts without words are near only if
equal; null is the empty text; a document without an id is in a class of its own (null); several texts under one id count as one document, of
which the text with the least digest is compared; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.llm.common import in_batches, join_listed, map_text, materialise, text_key, whole_text
from codetide.llm.components import components
from codetide.llm.shingles import counted, mixed, multiset_similarity, text_shingles

THRESHOLD = 0.8
BANDS, ROWS = 42, 6
SLOTS = BANDS * ROWS
#: Texts of a bucket of which all pairs of different classes are candidates; texts of a larger one compared with as many others.
SMALL, BLOCK = 16, 512

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _number(k: int) -> np.uint64:
    return np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)


def _elements(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Text, seed, first level, levels and multiplicity of every block that a text reaches."""
    owner, seed, low, width, limit = [], [], [], [], []
    for i, shingles in enumerate(texts):
        values, counts = np.unique(shingles, return_counts=True)
        bottom, block = 0, 0
        while len(values):
            size = max(1, bottom)
            owner.append(np.full(len(values), i))
            seed.append(mixed(values + _number(block)))
            low.append(np.full(len(values), bottom))
            width.append(np.full(len(values), size))
            limit.append(counts)
            bottom, block = bottom + size, block + 1
            values, counts = values[counts > bottom], counts[counts > bottom]
    return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.uint64) for x in (owner, seed, low, width, limit))


def signatures(texts: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Least times, a row per text; infinite for texts without shingles."""
    least = np.full(len(texts) * slots, np.inf)
    owner, seed, low, width, limit = _elements(texts)
    owner = owner.astype(np.int64)
    time = np.zeros(len(owner))
    drawn, step = 0, 4
    with np.errstate(over="ignore"):
        while len(owner):
            number = np.arange(drawn, drawn + step, dtype=np.uint64)
            bits = mixed(seed[:, None] + (number[None, :] + np.uint64(1)) * _GOLDEN)
            gaps = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[:, None]
            times = time[:, None] + np.cumsum(gaps, axis=1)
            more = mixed(bits + _GOLDEN)
            slot = ((more >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
            place = owner[:, None] * slots + slot
            if (width > 1).any():
                level = low[:, None] + ((more & np.uint64(0xFFFFFFFF)) * width[:, None].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
                taken = level < limit[:, None]
                np.minimum.at(least, place[taken], times[taken])
            else:
                np.minimum.at(least, place.ravel(), times.ravel())
            last = least.reshape(-1, slots).max(axis=1)
            time = times[:, -1]
            going = time < last[owner]
            owner, seed, low, width, limit, time = (x[going] for x in (owner, seed, low, width, limit, time))
            drawn += step
            step = min(256, drawn)
    return least.reshape(len(texts), slots)


def band_numbers(signature: np.ndarray) -> np.ndarray:
    """A number per band, unlike for different bands."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.tile(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(signature), 1))
    for k in range(ROWS):
        out = mixed(out * _GOLDEN + bits[:, :, k])
    return out.view(np.int64)


def banded(docs: DataFrame) -> DataFrame:
    """doc_id, key, shingle count and bands of every document."""

    def run(rows: list[dict]) -> Iterator[dict]:
        texts = [text_shingles(r["text"]) for r in rows]
        bands = band_numbers(signatures(texts))
        for r, shingles, own in zip(rows, texts, bands, strict=True):
            yield {"doc_id": r["doc_id"], "key": r["key"], "n_shingles": len(shingles), "bands": own.tolist() if len(shingles) else []}

    return map_text(docs.select("doc_id", text_key().alias("key"), whole_text().alias("text")), run, "doc_id long, key string, n_shingles long, bands array<long>", 128)


def stored_shingles(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its counted shingles as bytes, for the nodes that have company in a bucket."""

    def run(rows: list[dict]) -> Iterator[dict]:
        for r in rows:
            yield {"node": r["node"], "shingles": counted(text_shingles(r["text"])).tobytes()}

    keyed = docs.select(F.col("doc_id").alias("node"), text_key().alias("key"), whole_text().alias("text"))
    once = keyed.join(nodes.select("node", "key"), ["node", "key"], "left_semi")
    return map_text(once, run, "node long, shingles binary").dropDuplicates(["node"])


def verified(pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) with their exact similarity, those below the threshold left out."""

    def run(rows: list[dict]) -> Iterator[dict]:
        for r in rows:
            similarity = multiset_similarity(np.frombuffer(r["of_a"], np.uint64), np.frombuffer(r["of_b"], np.uint64))
            if similarity >= threshold:
                yield {"a": r["a"], "b": r["b"], "similarity": similarity}

    of_a = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    of_b = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    return map_text(pairs.select("a", "b").join(of_a, "a").join(of_b, "b"), run, "a long, b long, similarity double", 512)


def _classed(members: DataFrame, classes: DataFrame) -> DataFrame:
    return members.join(classes, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")


def _unsettled(classed: DataFrame) -> DataFrame:
    """Members of the buckets with more than one class. Classes are combined in the tasks; a hot bucket's members stay where they are."""
    several = classed.groupBy("bucket").agg(F.min("class").alias("c"), F.max("class").alias("d")).where("c <> d").select("bucket")
    return join_listed(classed, materialise(several, "several"), "bucket")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, key, class_id of every document; the class is named by its least doc_id."""
    stored = materialise(banded(docs), "banded")
    nodes = stored.groupBy("key").agg(F.min("doc_id").alias("node"))
    named = materialise(nodes, "named")
    chosen = materialise(named.where("node is not null").groupBy("node").agg(F.min("key").alias("key")), "chosen")
    once = stored.withColumnRenamed("doc_id", "node").join(chosen, ["node", "key"])
    if once.select("node").count() > chosen.count():  # repeated rows
        once = once.dropDuplicates(["node"])
    in_bucket = once.select("node", "key", "n_shingles", F.explode("bands").alias("bucket"))
    in_bucket = materialise(in_bucket, "in_bucket")
    shared = in_bucket.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("other")).where("lead <> other").select("bucket", "lead")
    members = materialise(in_bucket.join(shared, "bucket"), "members")
    company = materialise(members.groupBy("node").agg(F.min("key").alias("key")), "company")
    shingles = materialise(stored_shingles(docs, company), "shingles")

    # Every text with the least of its leads, then the rest of the small buckets, then that of the large ones.
    first = members.where("node <> lead").groupBy("node").agg(F.min("lead").alias("lead"))
    links = materialise(verified(first.select(F.col("node").alias("a"), F.col("lead").alias("b")), shingles, threshold), "links")
    classes = components(links)
    unsettled = materialise(_unsettled(materialise(_classed(members, classes), "classed")), "unsettled")

    size = unsettled.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    sized = materialise(join_listed(unsettled, materialise(size, "sizes"), "bucket"), "sized")
    pairs = _pairs_of_small_buckets(sized.where(F.col("size") <= SMALL), threshold)
    links = materialise(links.unionByName(verified(pairs, shingles, threshold)), "links")
    classes = components(links)
    large = _unsettled(materialise(_classed(sized.where(F.col("size") > SMALL).drop("class"), classes), "classed"))
    bands = once.select("node", "bands")
    links = links.unionByName(materialise(_links_of_large_buckets(large, bands, shingles, threshold), "late_links"))
    classes = components(links)
    of_text = named.join(classes, "node", "left").select("key", F.coalesce("root", "node").alias("class_id"))
    return stored.select("doc_id", "key").join(of_text, "key").select(
        "doc_id", "key", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")
    )


def _pairs_of_small_buckets(members: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different classes in buckets of at most ``SMALL`` texts, each pair once."""
    left = members.select("bucket", F.col("node").alias("a"), F.col("class").alias("class_a"), F.col("n_shingles").alias("n_a"))
    right = members.select("bucket", F.col("node").alias("b"), F.col("class").alias("class_b"), F.col("n_shingles").alias("n_b"))
    alike = F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    pairs = left.join(right, "bucket").where((F.col("a") > F.col("b")) & (F.col("class_a") != F.col("class_b")) & alike)
    return pairs.select("a", "b").distinct()


def _links_of_large_buckets(members: DataFrame, bands: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Links between the classes of large buckets, found where the bucket's texts are together.

    A bucket is cut into blocks of some ``BLOCK`` texts, and every two blocks are a unit of work, so no task holds more than two
    blocks of a bucket. A unit compares the pairs of different classes for which the bucket is the first that they share, and returns
    no more links than join its classes; pairs are never written out.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    placed = members.select("bucket", "node", "class", blocks.alias("blocks"), block.alias("block"))
    units = placed.select(
        "bucket", "node", "class", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "bucket", "node", "class", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    loaded = units.join(bands, "node").join(shingles, "node")
    keys = ["bucket", "low", "high"]
    together = loaded.repartition(*keys).sortWithinPartitions(*keys, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[dict] = []
        links: list[dict] = []
        for received in batches:
            for at in range(0, received.num_rows, 256):
                for row in received.slice(at, 256).to_pylist():
                    if unit and any(unit[0][k] != row[k] for k in keys):
                        links += unit_links(unit, threshold)
                        unit = []
                    unit.append(row)
            if len(links) > 1000:
                yield pa.RecordBatch.from_pylist(links, schema=LINKS)
                links = []
        links += unit_links(unit, threshold)
        yield pa.RecordBatch.from_pylist(links, schema=LINKS)

    return in_batches(together, run, "a long, b long, similarity double")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])


def unit_links(unit: list[dict], threshold: float) -> list[dict]:
    """Links that join the classes of a unit, whose rows have node, class, block, low, high, bucket, bands and shingles."""
    if not unit:
        return []
    bucket, low, high = unit[0]["bucket"], unit[0]["low"], unit[0]["high"]
    bands = np.array([r["bands"] for r in unit], dtype=np.int64)
    texts = [np.frombuffer(r["shingles"], np.uint64) for r in unit]
    sizes, blocks = np.array([len(t) for t in texts]), np.array([r["block"] for r in unit])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, row in enumerate(unit):
        same = bands[:i] == bands[i]
        first = bands[i][same.argmax(axis=1)] == bucket
        alike = np.minimum(sizes[:i], sizes[i]) >= threshold * np.maximum(sizes[:i], sizes[i])
        here = blocks[:i] != blocks[i] if low != high else np.ones(i, dtype=bool)
        for j in np.flatnonzero(first & alike & here):
            mine, other = find(row["class"]), find(unit[j]["class"])
            if mine == other:
                continue
            similarity = multiset_similarity(texts[i], texts[j])
            if similarity >= threshold:
                root[max(mine, other)] = min(mine, other)
                out.append({"a": row["node"], "b": unit[j]["node"], "similarity": similarity})
    return out


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those whose class has a smaller doc_id; of rows with one id that with the least text digest, then the least row, stays."""
    found = materialise(near_classes(docs, threshold), "classes")
    dropped = materialise(found.where("doc_id <> class_id").select("doc_id").distinct(), "dropped")
    kept = docs.join(dropped, "doc_id", "left_anti")
    repeated = materialise(found.where("doc_id = class_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        comparable = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
        order = F.struct(text_key().alias("key"), *comparable)
        once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("kept")).select("kept.*")
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def near_query(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, and whether the document is the one that stays."""
    found = near_classes(docs)
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("stays"))
