"""Merkle manifest of a table, with the membership proofs of all its rows as octopus multiproofs.

A row's leaf is the hash of its fields. Per source the leaves, ascending by doc_id, form a tree
of runs of three; the sources' subroots form the top tree. Leaves are numbered within their
source by range partitions, so a large source lies over many tasks, and packed into blocks of
3**HEIGHT consecutive leaves of a source, one row each. Blocks fold to their roots, and block
roots are folded again in groups of as many, tier by tier, so that no task holds a whole tree.

Proofs: a leaf partition is a range of blocks. It computes the minimal union of node coordinates
that it needs and cannot derive from its own blocks (of every run that it touches, the members
it does not have, level by level), these are fetched by one join, and each partition then derives
the interior nodes that its proofs share and expands the proof of each leaf on the spot.

Defined results: a NULL field is "-", so NULL and empty texts differ; a NULL doc_id comes first
in its source and is not tampered with; a NULL source is the first source; rows that repeat an id
or a whole row are leaves of their own, ordered by id and then leaf; an empty table has no leaf
and an empty result. Only doc_id, source, lang, n_chars and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmodel.llm import scratch
from clickmodel.llm.ranges import running

ARITY = 3
HEIGHT = 7  # a block holds ARITY**HEIGHT = 2187 leaves
TOP = -1  # the number of the top tree; sources are numbered from 0
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def parents(level: list[str]) -> list[str]:
    return [digest(level[i : i + ARITY]) for i in range(0, len(level), ARITY)]


def levels(nodes: list[str], height: int | None = None) -> list[list[str]]:
    """All levels above ``nodes``: ``height`` of them, or up to a single node."""
    out = [nodes]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        out.append(parents(out[-1]))
    return out


def siblings(level: list[str], i: int) -> tuple[str, str]:
    """What stands left and right of node ``i`` in its run, joined."""
    a = i - i % ARITY
    return "".join(level[a:i]), "".join(level[i + 1 : a + ARITY])


def octopus(known: Iterable[int], n: int, level: int = 0) -> list[tuple[int, int]]:
    """The minimal union of (level, index) that folding the ``known`` nodes of a level of ``n``
    nodes to the root needs besides these nodes."""
    have, out = set(known), []
    while n > 1:
        runs = {i // ARITY for i in have}
        out += [(level, i) for r in sorted(runs) for i in range(r * ARITY, min(n, (r + 1) * ARITY)) if i not in have]
        have, n, level = runs, -(-n // ARITY), level + 1
    return out


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(df: DataFrame, text: Column) -> Column:
    return F.sha2(F.concat(*[_field(df[c]) for c in FIELDS[:-1]], _field(text)), 256)


# ------------------------------------------------------------------ blocks of leaves
ROW = "ids binary, known binary, leaves binary, changed binary"
BLOCKS = f"chunk int, place int, source string, block bigint, alone string, root string, {ROW}"


def _pack(height: int):
    """One row per block, with its place in the partition. Rows come sorted by (source, nth), and a
    block lies in one partition."""
    schema = pa.schema(
        [("chunk", pa.int32()), ("place", pa.int32()), ("source", pa.string()), ("block", pa.int64()), ("alone", pa.string()), ("root", pa.string())]
        + [(c, pa.binary()) for c in ("ids", "known", "leaves", "changed")]
    )

    def packed(chunk: int, place: int, key: tuple, held: list) -> pa.RecordBatch:
        ids, leaves, changed = (sum(x, []) for x in zip(*held, strict=True))
        up = levels(leaves)
        row = {
            "chunk": chunk, "place": place, "source": key[0], "block": key[1],
            "alone": up[-1][0], "root": levels(up[-1], height + 1 - len(up))[-1][0],
            "ids": np.array([x or 0 for x in ids], np.int64).tobytes(), "known": bytes(x is not None for x in ids),
            "leaves": bytes.fromhex("".join(leaves)), "changed": bytes.fromhex("".join(changed)),
        }
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, place, key, held = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            source, block = b.column("source").to_pylist(), b.column("block").to_pylist()
            ids, leaves, changed = (b.column(c).to_pylist() for c in ("doc_id", "leaf", "changed"))
            a = 0
            while a < len(ids):
                e = a + 1
                while e < len(ids) and block[e] == block[a] and source[e] == source[a]:
                    e += 1
                if key != (source[a], block[a]):
                    if held:
                        yield packed(chunk, place, key, held)
                        place += 1
                    key, held = (source[a], block[a]), []
                held.append((ids[a:e], leaves[a:e], changed[a:e]))
                a = e
        if held:
            yield packed(chunk, place, key, held)

    return run


# ------------------------------------------------------------------ upper nodes
NODES = "tree bigint, level int, idx bigint, digest string, n bigint, top boolean"


def _fold_groups(height: int):
    """All nodes above a group of consecutive nodes, up to its root. A group that is a whole tree
    ends at its only node, any other after ``height`` levels, at the next tier's nodes."""
    schema = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()), ("n", pa.int64()), ("top", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                members = [m["digest"] for m in sorted(r["members"], key=lambda m: m["idx"])]
                whole, n = r["n"] <= ARITY**height, -(-r["n"] // ARITY**height)
                for h, nodes in enumerate(levels(members, None if whole else height)[1:], 1):
                    first = r["grp"] * ARITY ** (height - h)
                    out += [{"tree": r["tree"], "level": r["level"] + h, "idx": first + i, "digest": x, "n": n, "top": h == height and not whole} for i, x in enumerate(nodes)]
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def climb(nodes: DataFrame, height: int, name: str) -> DataFrame:
    """All (tree, level, idx, digest) from ``nodes`` (one level of each tree, with the number n of
    nodes that its tree has there) up to the roots. The tiers are as many as the largest tree
    needs; only that tree's size comes to the driver."""
    below = scratch.written(nodes.select("tree", "level", "idx", "digest", "n"), name)
    found, most = below.drop("n"), below.agg(F.max("n")).first()[0] or 0
    while most > 1:
        grouped = below.where("n > 1").groupBy("tree", "level", F.floor(F.col("idx") / ARITY**height).cast("long").alias("grp"))
        groups = grouped.agg(F.max("n").alias("n"), F.collect_list(F.struct("idx", "digest")).alias("members"))
        made = scratch.written(groups.mapInArrow(_fold_groups(height), NODES), name)
        found = found.unionByName(made.drop("n", "top"))
        below, most = made.where("top"), -(-most // ARITY**height)
    return found


# ------------------------------------------------------------------ multiproofs
def _needs(height: int):
    """The coordinates that each leaf partition misses."""
    schema = pa.schema([("chunk", pa.int32()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                trees: dict[int, list] = {}
                for x in r["own"]:
                    trees.setdefault(x["tree"], []).append(x)
                wanted = [(t, lv, i) for t, own in trees.items() for lv, i in octopus((x["block"] for x in own), own[0]["n_blocks"], height)]
                wanted += [(TOP, lv, i) for lv, i in octopus(trees, r["n_trees"])]
                out += [{"chunk": r["chunk"], "tree": t, "level": lv, "idx": i} for t, lv, i in wanted]
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


class Partition:
    """A leaf partition's own block roots and fetched nodes, and the interiors derived from them."""

    def __init__(self, own: list[dict], fetched: list[dict], n_trees: int, height: int):
        self.blocks = {x["place"]: (x["tree"], x["block"], x["n_blocks"]) for x in own}
        self.nodes = {(x["tree"], x["level"], x["idx"]): x["digest"] for x in fetched or []}
        self.trees, self.n_trees, self.height = {}, n_trees, height
        for x in own:
            self.trees.setdefault(x["tree"], (x["n_blocks"], set()))[1].add(x["block"])
            self.nodes[x["tree"], height, x["block"]] = x["root"] if x["n_blocks"] > 1 else x["alone"]
        for t, (n, blocks) in self.trees.items():
            self.nodes[TOP, 0, t] = self.derive(t, height, blocks, n)
        self.root = self.derive(TOP, 0, set(self.trees), n_trees)

    def derive(self, tree: int, level: int, have: set[int], n: int) -> str:
        """Adds the nodes above ``have``; the root."""
        while n > 1:
            have, above = {i // ARITY for i in have}, level + 1
            for r in have:
                self.nodes[tree, above, r] = digest(self.nodes[tree, level, i] for i in range(r * ARITY, min(n, (r + 1) * ARITY)))
            n, level = -(-n // ARITY), above
        return self.nodes[tree, level, 0]

    def path(self, tree: int, level: int, i: int, n: int) -> list[tuple[str, str]]:
        out = []
        while n > 1:
            a, e = i - i % ARITY, min(n, i - i % ARITY + ARITY)
            at = lambda k: self.nodes[tree, level, k]  # noqa: E731, B023
            out.append(("".join(map(at, range(a, i))), "".join(map(at, range(i + 1, e)))))
            i, n, level = i // ARITY, -(-n // ARITY), level + 1
        return out


RESULT = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _hexes(raw: bytes) -> list[str]:
    text = raw.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _expand(height: int):
    """The proof of every leaf. Rows come sorted by (chunk, kind): what the partition has, then its blocks."""

    def proofs(part: Partition, r: dict) -> pa.RecordBatch:
        tree, block, n_blocks = part.blocks[r["place"]]
        leaves, changed = _hexes(r["leaves"]), _hexes(r["changed"])
        up = levels(leaves, height if n_blocks > 1 else None)
        rest = part.path(tree, height, block, n_blocks) + part.path(TOP, 0, tree, part.n_trees)
        proofs, folds = [], []
        for i, x in enumerate(changed):
            k, path = i, []
            for level in up[:-1]:
                path.append(siblings(level, k))
                k //= ARITY
            path += rest
            proofs.append(digest(s for pair in path for s in pair))
            for left, right in path:
                x = digest((left, x, right))
            folds.append(x)
        n, subroot = len(leaves), part.nodes[TOP, 0, tree]
        ids = pa.array(np.frombuffer(r["ids"], np.int64), pa.int64(), mask=np.frombuffer(r["known"], np.uint8) == 0)
        text = lambda v: pa.array(v, pa.string())
        return pa.RecordBatch.from_arrays(
            [ids, text(leaves), text([subroot] * n), text([part.root] * n), text(proofs), text(folds), pa.array([f == part.root for f in folds])],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            for k in range(batch.num_rows):  # one at a time, as Python objects take much room
                r = batch.slice(k, 1).to_pylist()[0]
                if r["kind"] == 0:
                    part = Partition(r["own"], r["fetched"], r["n_trees"], height)
                else:
                    yield proofs(part, r)

    return run


def manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(blocks, roots, nodes, number of sources): the packed leaves; each block's root, tree and
    place; and all (tree, level, idx, digest) from the blocks' roots (level ``height``) up to the
    subroots, and from these (tree TOP, level 0) up to the manifest's root."""
    spark = docs.sparkSession
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    text = docs["text"].cast("string")
    told = docs.select(
        docs["source"].cast("string").alias("source"), docs["doc_id"].cast("long").alias("doc_id"),
        leaf(docs, text).alias("leaf"), leaf(docs, F.when(tampered, F.translate(text, "\n", "")).otherwise(text)).alias("changed"),
    )
    leaves = running(scratch.written(told, "leaves"), "source", ["doc_id", "leaf", "changed"])
    leaves = leaves.withColumn("block", F.floor((F.col("nth") - 1) / ARITY**height).cast("long")).drop("chunk")
    dealt = leaves.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "source", "block").sortWithinPartitions("source", "nth")
    blocks = scratch.written(dealt.mapInArrow(_pack(height), BLOCKS), "blocks")
    # The sources' trees, numbered in the order of the top tree.
    sources = blocks.groupBy("source").agg(F.count("*").alias("n_blocks")).withColumn("all", F.lit(0))
    sources = scratch.written(running(sources, "all", ["source"]).select(F.col("source").alias("_s"), "n_blocks", (F.col("nth") - 1).alias("tree")), "sources")
    roots = blocks.select("chunk", "place", "source", "block", "alone", "root").join(sources, F.col("source").eqNullSafe(F.col("_s")))
    roots = scratch.written(roots.select("chunk", "place", "tree", "n_blocks", "block", "alone", "root"), "roots")
    whole = F.when(F.col("n_blocks") > 1, F.col("root")).otherwise(F.col("alone"))
    lower = roots.select("tree", F.lit(height).alias("level"), F.col("block").alias("idx"), whole.alias("digest"), F.col("n_blocks").alias("n"))
    nodes = climb(lower, height, "nodes")
    subroots = nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    n_trees = sources.count()
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "digest", F.lit(n_trees).cast("long").alias("n"))
    top = climb(top, height, "top")
    return blocks.drop("alone", "root"), roots, nodes.unionByName(top), n_trees


def prove(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: the digest
    of its proof's siblings, and the root that its leaf folds to with them after tampering."""
    blocks, roots, nodes, n_trees = manifest(docs, height)
    own = roots.groupBy("chunk").agg(F.collect_list(F.struct("place", "tree", "n_blocks", "block", "alone", "root")).alias("own"))
    own = own.withColumn("n_trees", F.lit(n_trees).cast("long"))
    missing = own.mapInArrow(_needs(height), "chunk int, tree bigint, level int, idx bigint")
    fetched = missing.join(nodes, ["tree", "level", "idx"]).groupBy("chunk").agg(F.collect_list(F.struct("tree", "level", "idx", "digest")).alias("fetched"))
    rows = own.join(fetched, "chunk", "left").withColumn("kind", F.lit(0)).unionByName(blocks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, "chunk").sortWithinPartitions("chunk", "kind", "place").mapInArrow(_expand(height), RESULT)
