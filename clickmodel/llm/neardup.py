"""Near-duplicate groups from a MinHash LSH forest.

Documents are sets of 5-word shingles; those with equal sets are one node. A node's signature
is cyclically ordered from many starting points, one tree each. The first ``DEPTH`` values of an
order make its region, small enough that any linked pair shares a region in some tree. Regions
of several nodes are sorted by the rest of the order, so neighbours have the longest common
prefixes; how deep the order parts a region depends on how many nodes it has, and a large region
lies over many tasks. Each node proposes the most similar of its neighbours.

Proposals are confirmed on full shingle sets in three rounds: every node with the least node of
its proposed group, then the proposals that still cross groups, and last, in each region with
several groups, all nodes outside its largest group against all others (in tasks of two blocks
of the region's nodes each, which return the links alone). Sketches (four bits of
each signature value) rule out pairs far below the threshold; nothing else is left out, and
nodes already in one group need no further test.

Recall: a pair at the threshold 0.75 shares a region with probability 1 - (1 - 0.75**4)**32,
which is 0.999995, and passes the sketch with 0.9999997; shingles are compared as 64-bit hashes.

Defined results: NULL and empty texts (and texts of white space) have no set and are linked with
nothing; texts under five words have one shingle, all their words; rows that repeat an id or a
text are nodes or members like any others; a NULL id is never the least of its group unless all
are NULL; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmodel.llm import scratch
from clickmodel.llm.components import connected
from clickmodel.llm.hashing import Words, mix
from clickmodel.llm.packed import CELLS, HITS, cells, per_document, unpack

SHINGLE, PERCENT = 5, 75
TREES, DEPTH = 32, 4
VALUES = TREES * DEPTH
NEIGHBOURS = 16  # earlier neighbours in an order that a node is compared with
LEAST_EQUAL = 74  # of the 128 sketch values; a pair at 0.75 has 98 on average
BLOCK_ROWS = 4096  # nodes of a region that a task holds, and that it compares them with
BATCH_TEXTS = 256
_FACTORS = mix(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)
_SAME = np.array([((x & 15) == 0) + ((x >> 4) == 0) for x in range(256)], np.int16)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first, hashes): the sorted distinct shingle hashes of text k are first[k] to first[k+1]."""
    words = Words(texts, lower=True)
    runs, at = words.runs(SHINGLE)
    doc = words.text_of(at)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    doc = np.r_[doc, short]
    runs = np.r_[runs, np.array([words.whole(int(k)) for k in short], np.uint64)]
    order = np.lexsort((runs, doc))
    doc, runs = doc[order], runs[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (runs[1:] != runs[:-1])] if len(doc) else np.zeros(0, bool)
    doc, runs = doc[new], runs[new]
    return np.searchsorted(doc, np.arange(len(texts) + 1)), runs


def _digests(first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One 64-bit number per set (sum and exclusive-or of its mixed hashes, with its size)."""
    n = len(first) - 1
    sums, size = np.zeros(n, np.uint64), np.diff(first)
    full = np.flatnonzero(size)
    if len(full):
        with np.errstate(over="ignore"):
            sums[full] = mix(np.add.reduceat(mix(hashes + np.uint64(7)), first[full]) + size[full].astype(np.uint64))
            sums[full] = mix(sums[full] ^ np.bitwise_xor.reduceat(mix(hashes ^ np.uint64(0x5BD1E995)), first[full]))
    return sums


def _signatures(first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """uint32 [sets with shingles, VALUES] minima."""
    out = np.empty((len(first), VALUES), np.uint32)
    with np.errstate(over="ignore"):
        for k, factor in enumerate(_FACTORS):
            out[:, k] = np.minimum.reduceat(((hashes * factor) >> np.uint64(32)).astype(np.uint32), first)
    return out


def _sketch(sig: np.ndarray) -> np.ndarray:
    low = (mix(sig.astype(np.uint64)) & np.uint64(15)).astype(np.uint8)
    return low[:, 0::2] | (low[:, 1::2] << 4)


def _regions(sig: np.ndarray) -> np.ndarray:
    """uint64 [sets, TREES]: the hash of the first DEPTH values of each order; low bits: the tree."""
    out = np.empty((len(sig), TREES), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(TREES):
            h = np.full(len(sig), t + 1, np.uint64)
            for d in range(DEPTH):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, DEPTH * t + d].astype(np.uint64))
            out[:, t] = (h & ~np.uint64(TREES - 1)) | np.uint64(t)
    return out


FEATURES = "_id bigint, n bigint, node bigint, sketch binary, regions binary, text_hash bigint"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for a in range(0, whole.num_rows, BATCH_TEXTS):
            b = whole.slice(a, BATCH_TEXTS)
            first, hashes = shingle_sets(b.column("text"))
            size = np.diff(first)
            full = np.flatnonzero(size)
            node = _digests(first, hashes).view(np.int64)
            sketch, regions = [None] * b.num_rows, [None] * b.num_rows
            if len(full):
                sig = _signatures(first[full], hashes)
                for k, s, r in zip(full.tolist(), _sketch(sig), _regions(sig), strict=True):
                    sketch[k], regions[k] = s.tobytes(), r.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(size, pa.int64()), pa.array(node, pa.int64(), mask=size == 0), pa.array(sketch, pa.binary()), pa.array(regions, pa.binary()), b.column("text_hash")],
                ["_id", "n", "node", "sketch", "regions", "text_hash"],
            )


def _region_cells(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                regions = np.frombuffer(b"".join(b.column("regions").to_pylist()), np.uint64)
                yield cells(np.repeat(b.column("node").to_numpy(), TREES), regions, parts, 0, True)

    return run


def _shared_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a part's regions, those with several nodes, per node. Rows come sorted by part."""
    part, held = None, []

    def close():
        if held:
            ids, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(prints, kind="stable")
            ids, prints = ids[order], prints[order]
            same = np.r_[False, prints[1:] == prints[:-1]]
            same |= np.r_[same[1:], False]
            if same.any():
                yield per_document(ids[same], prints[same])

    for b in batches:
        for row in b.to_pylist():
            if row["part"] != part:
                yield from close()
                part, held = row["part"], []
            held.append(unpack(row, True))
    yield from close()


MEMBERS = "region bigint, place binary, node bigint"


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(region, place, node): place is the sketch in the order of the region's tree."""
    for b in batches:
        region, place, node = [], [], []
        for k, sketch, hits in zip(b.column("node").to_pylist(), b.column("sketch").to_pylist(), b.column("hits").to_pylist(), strict=True):
            for r in np.frombuffer(b"".join(hits), np.uint64):
                at = (int(r) & (TREES - 1)) * DEPTH // 2
                region.append(int(r.view(np.int64)))
                place.append(sketch[at:] + sketch[:at])
                node.append(k)
        yield pa.RecordBatch.from_arrays([pa.array(region, pa.int64()), pa.array(place, pa.binary()), pa.array(node, pa.int64())], ["region", "place", "node"])


EDGES = "a bigint, b bigint, equal int"


def _edge_batch(edges: dict) -> pa.RecordBatch:
    a, b = (zip(*edges, strict=True)) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(edges.values(), pa.int32())], ["a", "b", "equal"])


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most similar of the NEIGHBOURS earlier nodes in the region's order, for each node."""
    old_r, old_n, old_p = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, VALUES // 2), np.uint8)
    for b in batches:
        if not b.num_rows:
            continue
        r = np.r_[old_r, b.column("region").to_numpy()]
        n = np.r_[old_n, b.column("node").to_numpy()]
        p = np.vstack([old_p, np.frombuffer(b"".join(b.column("place").to_pylist()), np.uint8).reshape(-1, VALUES // 2)])
        best, whom = np.zeros(len(r), np.int16), np.zeros(len(r), np.int64)
        for back in range(1, min(NEIGHBOURS, len(r) - 1) + 1):
            equal = _SAME[p[back:] ^ p[:-back]].sum(1, dtype=np.int16)
            equal[(r[back:] != r[:-back]) | (n[back:] == n[:-back])] = 0
            more = np.flatnonzero(equal > best[back:])
            best[back:][more], whom[back:][more] = equal[more], n[:-back][more]
        good = best >= LEAST_EQUAL
        good[: len(old_r)] = False
        a, c = np.minimum(n, whom)[good], np.maximum(n, whom)[good]
        yield _edge_batch(dict(zip(zip(a.tolist(), c.tolist(), strict=True), best[good].tolist(), strict=True)))
        old_r, old_n, old_p = r[-NEIGHBOURS:], n[-NEIGHBOURS:], p[-NEIGHBOURS:]


def enough(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


WIDE = 1 << 31  # a task is (first block * WIDE + second block)


class _Block:
    """Some rows of one region, as arrays."""

    def __init__(self, b: pa.RecordBatch, s: int, e: int):
        cut = b.slice(s, e - s)
        self.node, self.group = cut.column("node").to_pylist(), cut.column("group").to_pylist()
        self.place = np.frombuffer(b"".join(cut.column("place").to_pylist()), np.uint8).reshape(-1, VALUES // 2)
        self.regions = np.frombuffer(b"".join(cut.column("regions").to_pylist()), np.uint64).reshape(-1, TREES)
        self.items = [np.frombuffer(x, np.uint64) for x in cut.column("items").to_pylist()]


def _compare_rest(percent: int):
    """Links between different groups in a region; rows come sorted by (region, task, side).

    A task compares two blocks of a region's nodes: those of side 1 with those of side 0, or, if all
    are of side 0, each with each. A pair is tested on its full sets, in the first tree in which
    it shares a region, unless this task has already joined its groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, root = None, [], {}

        def find(g):
            while (up := root.get(g, g)) != g:
                root[g] = g = root.get(up, up)
            return g

        def links(x: _Block, y: _Block, tree: int) -> dict:
            out = {}
            for u in range(len(x.node)):
                near = _SAME[x.place[u] ^ y.place].sum(1, dtype=np.int16)
                first = (x.regions[u] == y.regions).argmax(1) == tree
                for v in np.flatnonzero((near >= LEAST_EQUAL) & first).tolist():
                    g, h = find(x.group[u]), find(y.group[v])
                    if g != h and enough(x.items[u], y.items[v], percent):
                        root[max(g, h)] = min(g, h)
                        out[min(x.node[u], y.node[v]), max(x.node[u], y.node[v])] = int(near[v])
            return out

        for b in batches:
            if not b.num_rows:
                continue
            region, task, side = (b.column(c).to_numpy() for c in ("region", "task", "side"))
            cut = np.flatnonzero(np.r_[True, (region[1:] != region[:-1]) | (task[1:] != task[:-1]) | (side[1:] != side[:-1])])
            for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(region)], strict=True):
                if (region[s], task[s]) != key:
                    key, held, root = (region[s], task[s]), [], {}
                tree, within = int(region[s]) & (TREES - 1), task[s] // WIDE == task[s] % WIDE
                for i in range(s, e, 256):
                    now, edges = _Block(b, i, min(e, i + 256)), {}
                    if within:
                        edges.update(links(now, now, tree))
                    if within or side[s] == 1:
                        for old in held:
                            edges.update(links(now, old, tree))
                    if side[s] == 0:
                        held.append(now)
                    if edges:
                        yield _edge_batch(edges)

    return run


SETS = "node bigint, items binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for a in range(0, whole.num_rows, BATCH_TEXTS):
            b = whole.slice(a, BATCH_TEXTS)
            first, hashes = shingle_sets(b.column("text"))
            node = _digests(first, hashes).view(np.int64)
            items = [hashes[s:e].tobytes() for s, e in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(items, pa.binary())], ["node", "items"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                good.append(enough(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(good, pa.bool_())], ["a", "b", "linked"])

    return run


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, linked) of each pair, from the full sets."""
    x = pairs.select("a", "b").distinct().join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    y = x.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")
    return scratch.written(y.mapInArrow(_confirm(percent), "a bigint, b bigint, linked boolean"), "confirmed")


def _grouped(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs with their nodes' groups ga and gb."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"g{c}"))
    out = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return out.select("a", "b", F.coalesce("ga", "a").alias("ga"), F.coalesce("gb", "b").alias("gb"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, node, component_id, root, text_hash) of every row; ``root`` is the least node
    of the group, which tells apart groups of one least id (rows without an id, texts sharing an
    id); ``text_hash`` is the xxhash64 of the text."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    features = scratch.written(rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_features, FEATURES), "features")
    nodes = features.where("n > 0").groupBy("node").agg(F.min("_id").alias("_id"), F.first("sketch").alias("sketch"), F.first("regions").alias("regions"))
    nodes = scratch.written(nodes, "nodes")
    # Candidates: regions with several nodes, each sorted by the rest of its order.
    met = nodes.select("node", "regions").mapInArrow(_region_cells(parts), CELLS).repartition(parts, "part").sortWithinPartitions("part")
    shared = met.mapInArrow(_shared_regions, HITS).groupBy(F.col("_id").alias("node")).agg(F.collect_list("prints").alias("hits"))
    members = nodes.select("node", "sketch").join(shared, "node").mapInArrow(_places, MEMBERS)
    members = scratch.written(members.select("node", "region", "place"), "members")
    ordered = members.select("region", "place", "node").repartitionByRange(parts, "region", "place", "node").sortWithinPartitions("region", "place", "node")
    proposed = ordered.mapInArrow(_propose, EDGES).groupBy("a", "b").agg(F.max("equal").alias("equal"))
    proposed = scratch.written(proposed, "proposed")
    # The full sets of all nodes in shared regions, one text each.
    wanted = members.select("node").distinct()
    carriers = nodes.join(wanted, "node", "left_semi").select(F.col("_id").alias("_c"))
    texts = rows.join(carriers.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_c")), "left_semi").select("text")
    sets = texts.mapInArrow(_sets, SETS).join(wanted, "node", "left_semi").dropDuplicates(["node"])
    sets = scratch.written(sets, "sets")
    # Round 1: each node with the least node of its proposed group.
    stars = connected(proposed).where("node <> root").select(F.least("node", "root").alias("a"), F.greatest("node", "root").alias("b"))
    tested = confirm(stars, sets, percent)
    # Round 2: proposals that still cross groups.
    labels = connected(tested.where("linked"))
    crossing = _grouped(proposed.join(tested, ["a", "b"], "left_anti"), labels).where("ga <> gb")
    tested = tested.unionByName(confirm(crossing, sets, percent))
    labels = connected(tested.where("linked"))
    # Round 3: regions with several groups, nodes outside the largest group against all.
    placed = members.join(labels.select("node", F.col("root").alias("group")), "node", "left").withColumn("group", F.coalesce("group", "node"))
    sizes = placed.groupBy("region", "group").agg(F.count("*").alias("c"))
    open_ = sizes.groupBy("region").agg(F.max_by("group", F.struct("c", "group")).alias("main"), F.max("c").alias("most"), F.sum("c").alias("m"), F.count("*").alias("k")).where("k > 1")
    blocks = lambda c: F.ceil(c / BLOCK_ROWS).cast("long")
    # Nodes outside the largest group lie in blocks 0 to n_out - 1, those of it in the blocks after.
    rest = placed.join(open_, "region").withColumns({"n_out": blocks(F.col("m") - F.col("most")), "n_main": blocks(F.col("most"))})
    in_main, dealt = F.col("group") == F.col("main"), F.xxhash64("node")
    rest = rest.withColumn("block", F.when(in_main, F.col("n_out") + F.pmod(dealt, "n_main")).otherwise(F.pmod(dealt, "n_out")))
    others = F.when(in_main, F.sequence(F.lit(0).cast("long"), F.col("n_out") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("n_out") + F.col("n_main") - 1))
    rest = rest.select("region", "place", "node", "group", "block", F.explode(others).alias("other"))
    rest = rest.select("region", "place", "node", "group", (F.least("block", "other") * WIDE + F.greatest("block", "other")).alias("task"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    rest = rest.join(nodes.select("node", "regions"), "node").join(sets, "node")
    rest = rest.repartition("region", "task").sortWithinPartitions("region", "task", "side", "node")
    last = rest.mapInArrow(_compare_rest(percent), EDGES).select("a", "b")
    labels = connected(tested.where("linked").select("a", "b").unionByName(last))
    # The least id of each group, then of each row.
    known = nodes.select("node", "_id").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = scratch.written(known, "grouped")
    least = scratch.written(known.groupBy("root").agg(F.min("_id").alias("component_id")), "least")  # so that Spark may split a large group in the join
    of_node = scratch.written(known.join(least, "root").select("node", "component_id", "root"), "components")
    out = features.select("_id", "n", "node", "text_hash").join(of_node, "node", "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "node", F.coalesce("component_id", "_id").alias("component_id"), "root", "text_hash")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """One document of each group, the one with the least id (NULL last, then the least node, then
    the least text hash), with the input's columns (stage form). Documents without words stay; of
    rows that repeat an id and a set one stays.

    Survivors are chosen on rows of (id, node, root, text hash). The documents themselves move
    once, dealt by (id, text hash), at most one row of each such key from a task."""
    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs["doc_id"].cast("long").alias("_id"), docs["text"].alias("_text"))
    worded = F.coalesce(F.col("_text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    judged = near_duplicates(docs.select(docs["doc_id"], docs["text"]), **how)
    carrier = F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), "node", "text_hash"))
    key = [F.col("_id").isNull().alias("_z"), F.coalesce("_id", F.lit(0)).alias("_i"), F.xxhash64("_text").alias("_h")]
    first = judged.where("node is not null").groupBy("root").agg(carrier.alias("c"))
    first = first.select(F.col("c.z").alias("_z"), F.coalesce("c.i", F.lit(0)).alias("_i"), F.col("c.text_hash").alias("_h"))
    keyed = rows.where(worded).select("_row", *key)
    one = keyed.withColumn("_k", F.row_number().over(Window.partitionBy("_z", "_i", "_h").orderBy("_h"))).where("_k = 1")
    kept = one.join(first.hint("shuffle_hash"), ["_z", "_i", "_h"], "left_semi").select("_row")
    out = kept.unionByName(rows.where(~worded).select("_row"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in names])
