"""Nearest neighbours by inner product from a permutation index.

A vector is represented by the pivots in order of nearness. Each row is posted in the inverted
files of its ``POSTED`` nearest pivots, with the places of all pivots (cut at half their number).
A query visits the files of its nearest pivots until these hold the share ``COVER`` of all posts
(``LEAST_POSTS`` at least, so a small table is searched whole), ranks the rows that it meets by
the footrule distance of the two orders, and compares the nearest ``RERANK`` of them
(``LEAST_RERANK`` at least) by the inner product of the original vectors in double precision.

Inner products of vectors of unlike lengths are made an order of angles by one more component:
sqrt(M**2 - |x|**2) for rows, with M the largest length, and 0 for queries.

Pivots come from the ``SAMPLE`` rows of least hash (a bound whatever the table's size), near copies
of earlier ones left out; every row is posted. The files are laid end to end, by hash within a
file, and cut into parts of about ``PART_ROWS`` posts: several small files or a slice of a large
one. One task compares a part's rows with the queries that visit it, in turn, and returns at
most ``k`` rows a query. A row that a query meets in several files is ranked in the first one only.

Recall, measured against brute force (mean over queries, 20 neighbours): README.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components take
no part, neither as rows nor as queries; a shorter vector counts as padded by zeros; rows that
repeat an id are rows of their own, none a candidate of a query of that id, and whole copies of
a query row are one query; a NULL id is no query and, as a candidate, comes after others in ties;
fewer candidates than ``k`` are all returned; an empty table gives an empty result. Extra columns
are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmodel.llm import scratch

PIVOTS, POSTED = 128, 2
ROWS_PER_PIVOT = 32
SAMPLE, TOO_NEAR = 4096, 0.9
COVER, LEAST_POSTS = 0.5, 8192
RERANK, LEAST_RERANK = 0.35, 1024
PART_ROWS = 8192
LAST = np.iinfo(np.int64).max  # stands for a NULL id in order


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec: array of double) of the rows that take part."""
    vec = df[vec_col].cast("array<double>")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    return df.where(F.coalesce(good, F.lit(False))).select(df[id_col].cast("long").alias("id"), vec.alias("vec"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that makes them all as long as the longest."""
    return np.hstack([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0.0))[:, None]])


def choose_pivots(rows: DataFrame, n: int, dim: int, longest: float) -> np.ndarray:
    """Lifted pivots, [number, dim + 1]: fewer for small tables or where the sample has few unlike vectors."""
    sample = rows.select("vec", F.xxhash64("id", "vec").alias("h")).orderBy("h", "vec").limit(SAMPLE).collect()
    lifted = _lifted(np.array([r["vec"] for r in sample], np.float64).reshape(len(sample), dim), longest)
    lifted /= np.sqrt(longest)
    most, chosen = max(1, min(PIVOTS, n // ROWS_PER_PIVOT)), [0]
    for k in range(1, len(lifted)):
        if len(chosen) == most:
            break
        if (lifted[chosen] @ lifted[k]).max() < TOO_NEAR:
            chosen.append(k)
    return lifted[chosen] * np.sqrt(longest)


def places(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, places) of the pivots by nearness; places are cut at half the pivots, all alike beyond."""
    order = np.argsort(-near, axis=1, kind="stable")
    at = np.empty(order.shape, np.uint8)
    np.put_along_axis(at, order, np.broadcast_to(np.minimum(np.arange(order.shape[1]), max(1, order.shape[1] // 2)).astype(np.uint8), order.shape), 1)
    return order, at


REPRESENTED = "id bigint, key bigint, query boolean, vec binary, files array<int>, places binary, q_order binary, q_places binary"


def _represent(pivots: np.ndarray, longest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("vec"), pivots.shape[1] - 1)
            order, at = places(_lifted(x, longest) @ pivots.T)
            asked = b.column("query").to_numpy(zero_copy_only=False).astype(bool)
            q_order, q_at = places(x @ pivots[:, :-1].T)
            raw = lambda m, mask=None: pa.array([r.tobytes() if mask is None or mask[k] else None for k, r in enumerate(m)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("key"), b.column("query"), raw(x), pa.array(order[:, :POSTED].tolist(), pa.list_(pa.int32())), raw(at), raw(q_order.astype(np.uint8), asked), raw(q_at, asked)],
                ["id", "key", "query", "vec", "files", "places", "q_order", "q_places"],
            )

    return run


POSTS = "part int, kind int, id bigint, key bigint, vec binary, places binary, file int, before binary, visits binary"


def _post(counts: np.ndarray, cover: float, least: int):
    """Posts of rows (kind 0) and visits of queries (kind 1), by part."""
    ends = np.cumsum(counts)
    first = ends - counts
    wanted = max(cover * ends[-1], least)

    names = ["part", "kind", "id", "key", "vec", "places", "file", "before", "visits"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def posts(r: dict) -> Iterator[tuple]:
        for k, f in enumerate(r["files"]):
            part = int(first[f] + r["key"] % counts[f]) // PART_ROWS
            yield part, 0, r["id"], r["key"], r["vec"], r["places"], f, np.array(r["files"][:k], np.int32).tobytes(), None
        if r["query"]:
            order = np.frombuffer(r["q_order"], np.uint8)
            visited = order[: int(np.searchsorted(np.cumsum(counts[order]), wanted)) + 1]
            visits = np.zeros(len(counts), bool)
            visits[visited] = True
            held = visited[counts[visited] > 0]
            for p in sorted({p for f in held for p in range(int(first[f]) // PART_ROWS, int(ends[f] - 1) // PART_ROWS + 1)}):
                yield p, 1, r["id"], r["key"], r["vec"], r["q_places"], None, None, visits.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = (p for r in b.to_pylist() for p in posts(r))
            while out := list(itertools.islice(rows, 4096)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return run


class Part:
    """The posts of a part as arrays."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches)
        n = len(t)
        self.ids = t["id"].fill_null(LAST).to_numpy()
        self.vec = np.frombuffer(b"".join(t["vec"].to_pylist()), np.float64).reshape(n, -1)
        self.places = np.frombuffer(b"".join(t["places"].to_pylist()), np.uint8).reshape(n, -1)
        self.file = t["file"].to_numpy()
        before = [np.frombuffer(x, np.int32) for x in t["before"].to_pylist()]
        self.before = np.full((n, POSTED - 1), self.places.shape[1])  # files where the row was met before this one
        for k, x in enumerate(before):
            self.before[k, : len(x)] = x

    def nearest(self, own: int, vec: np.ndarray, at: np.ndarray, visits: np.ndarray, k: int, share: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k nearest of the rows that the query meets here first."""
        visits = np.r_[visits, False]
        met = np.flatnonzero(visits[self.file] & ~visits[self.before].any(1) & (self.ids != own))
        most = max(least, int(np.ceil(share * len(met))))
        if len(met) > most:
            theirs = self.places[met]
            footrule = (np.maximum(theirs, at) - np.minimum(theirs, at)).sum(1, dtype=np.uint16)
            met = met[footrule <= np.partition(footrule, most - 1)[most - 1]]
        scores = self.vec[met] @ vec
        if len(met) > k:
            good = scores >= np.partition(scores, -k)[-k]
            met, scores = met[good], scores[good]
        order = np.lexsort((self.ids[met], -scores))[:k]
        return self.ids[met][order], scores[order]


FOUND = "query_id bigint, key bigint, vec_id bigint, score double"


def _search(k: int, share: float, least: int):
    """Rows come sorted by (part, kind): a part's posts, then the queries that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, part = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            p, kind = b.column("part").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (kind[1:] != kind[:-1])]).tolist()
            for s, e in zip(cuts, [*cuts[1:], len(p)], strict=True):
                if p[s] != at:
                    at, held, part = p[s], [], None
                if kind[s] == 0:
                    held.append(b.slice(s, e - s))
                    continue
                if part is None and held:
                    part, held = Part(held), []
                if part is None:
                    continue
                found = []
                for r in b.slice(s, e - s).select(["id", "key", "vec", "places", "visits"]).to_pylist():
                    ids, scores = part.nearest(r["id"], np.frombuffer(r["vec"], np.float64), np.frombuffer(r["places"], np.uint8), np.frombuffer(r["visits"], bool), k, share, least)
                    found.append((np.full(len(ids), r["id"]), np.full(len(ids), r["key"]), ids, scores))
                q, key, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(key, pa.int64()), pa.array(ids, pa.int64(), mask=ids == LAST), pa.array(scores, pa.float64())], ["query_id", "key", "vec_id", "score"])

    return run


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            cover: float = COVER, least_posts: int = LEAST_POSTS, rerank: float = RERANK, least_rerank: int = LEAST_RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each query, a row whose ``id`` meets
    the condition ``is_query`` (on the column "id")."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    n, dim, longest = rows.agg(F.count("*"), F.max(F.size("vec")), F.max(length)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.withColumn("vec", F.when(F.size("vec") < dim, F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vec")))).otherwise(F.col("vec")))
    pivots = choose_pivots(rows, n, dim, longest)
    keyed = rows.select("id", (F.xxhash64("id", "vec").bitwiseAND((1 << 62) - 1)).alias("key"), F.coalesce(is_query, F.lit(False)).alias("query"), "vec")
    index = scratch.written(keyed.mapInArrow(_represent(pivots, longest), REPRESENTED), "permutations")
    counts = np.zeros(len(pivots), np.int64)
    for r in index.select(F.explode("files").alias("f")).groupBy("f").count().collect():  # a number per pivot
        counts[r["f"]] = r["count"]
    queries = index.where("query").dropDuplicates(["id", "key"])
    posts = index.withColumn("query", F.lit(False)).unionByName(queries.withColumn("files", F.array().cast("array<int>")))
    parts = max(1, -(-int(counts.sum()) // PART_ROWS))
    dealt = posts.mapInArrow(_post(counts, cover, least_posts), POSTS).repartitionByRange(parts, "part").sortWithinPartitions("part", "kind")
    found = dealt.mapInArrow(_search(k, rerank, least_rerank), FOUND)
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
