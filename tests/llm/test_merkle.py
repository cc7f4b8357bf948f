import hashlib
import zlib

import pytest

import __spark_entry__ as contract
from codetide.llm import merkle, sql
from conftest import SF_DIR
from oracle_check import difference


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf_of(row, tampered=False):
    text = row["text"].replace("\n", "") if tampered and row["text"] is not None else row["text"]
    return digest(*(field(x) for x in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def folded(nodes):
    """Root of a list, and per node the siblings of its way as (before, after) lists."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // 3 * 3
            ways[i].append((nodes[run:k], nodes[k + 1 : run + 3]))
            at[i] = k // 3
        nodes = [digest(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], ways


def by_hand(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots, ways = [], []
    for s in names:
        trees[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        root, own = folded([leaf_of(r) for r in trees[s]])
        subroots.append(root)
        ways.append(own)
    root, upper = folded(subroots)
    out = []
    for s, subroot, own, above in zip(names, subroots, ways, upper, strict=True):
        for r, way in zip(trees[s], own, strict=True):
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            got = leaf_of(r, even)
            for before, after in way + above:
                got = digest(*before, got, *after)
            proof = digest(*(x for before, after in way + above for x in before + after))
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, got, got == root))
    return sorted(out, key=str)


def check(docs, **settings):
    got = sorted((tuple(r) for r in merkle.manifest(docs, **settings).collect()), key=str)
    assert got == by_hand([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_equals_plain_recomputation(spark, levels):
    """With small subtrees the work goes through many tiers."""
    check(spark.read.parquet(f"{SF_DIR}/documents.parquet"), levels=levels)


def test_equals_sql(spark):
    assert difference(contract.queries()["op13_merkle_manifest"](spark, SF_DIR), sql.OP13, SF_DIR) is None


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10])
def test_small_trees(make_documents, n):
    docs = make_documents(*((i, f"a\n{i}") for i in range(n)))
    check(docs)
    assert {r.verified for r in merkle.manifest(docs).collect()} == {zlib.crc32(str(i).encode()) % 2 == 1 for i in range(n)}


def test_cases(make_documents):
    long = "é line\n" * 50_000
    docs = make_documents((1, None), (1, ""), (1, "x"), (1, "x"), (None, "y\n"), (2, long), (-5, "\n"), (3, "no break"))
    docs = docs.unionByName(make_documents((4, "z\n"), (5, "u"), source=None)).unionByName(make_documents((6, "v"), source="ä"))
    docs = docs.unionByName(make_documents((7, "v"), source=""))
    check(docs)
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_states_are_resumed():
    """Folding agrees with hashing the whole run, for every slot and run length."""
    nodes = [hashlib.sha256(bytes([i])).hexdigest().encode() for i in range(8)]
    tree = merkle.Subtree(nodes)
    for i in range(8):
        changed = [*nodes[:i], b"0" * 64, *nodes[i + 1 :]]
        assert merkle.fold(b"0" * 64, tree.way(i)) == merkle.Subtree(changed).root
        assert merkle.fold(nodes[i], tree.way(i)) == tree.root
