"""Vector search, manifest proofs and the prefix trie, against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmodel.llm import merkle, permutation, queries, trie
from clickmodel.llm.ranges import powers, running
from tests_support import edge_docs


@pytest.fixture(autouse=True)
def _ready(spark):
    queries.ready(spark)


# ------------------------------------------------------------------ running positions and sums
def test_running_over_a_key_in_many_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None, "z"]), k, rng.randrange(-(2**63), 2**63), rng.randrange(100)) for k in range(4000)]
    rng.shuffle(rows)
    got = running(spark.createDataFrame(rows, "k string, o bigint, v bigint, x bigint").repartition(5), "k", ["o"], sums=["x"], polys=["v"]).collect()
    assert len({r.chunk for r in got if r.k == "hot"}) > 1
    want, base, state = {}, int(powers(np.array([1]))[0]), collections.defaultdict(lambda: (0, 0, 0))
    signed = lambda x: (x + 2**63) % 2**64 - 2**63
    for k, o, v, x in sorted(rows, key=lambda r: r[1]):
        n, s, p = state[k]
        state[k] = now = n + 1, s + x, (p + v * pow(base, n + 1, 2**64)) % 2**64
        want[o] = (now[0], now[1], signed(now[2]), signed(p))
    assert {r.o: (r.nth, r.x_run, r.v_run, r.v_before) for r in got} == want
    assert running(spark.createDataFrame([], "k string, o bigint"), "k", ["o"]).count() == 0


# ------------------------------------------------------------------ manifest
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes):
    """(root, the siblings left and right of each node level by level)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, path in enumerate(paths):
            a = at[k] // 3 * 3
            path.append(("".join(level[a : at[k]]), "".join(level[at[k] + 1 : a + 3])))
            at[k] //= 3
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return (level[0] if level else None), paths


def brute_proofs(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by_source = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        head = "".join(map(field, (doc_id, source, lang, n_chars)))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None
        by_source[source].append((doc_id, h(head, field(text)), h(head, field(text.replace("\n", "") if tampered else text))))
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    sources = sorted(by_source, key=first)
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda r: (first(r[0]), r[1], r[2]))
        trees[s] = brute_tree([x[1] for x in by_source[s]])
    root, tops = brute_tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops, strict=True):
        for (doc_id, leaf, changed), path in zip(by_source[s], trees[s][1], strict=True):
            path, x = path + top, changed
            for left, right in path:
                x = h(left, x, right)
            out.append((doc_id, leaf, trees[s][0], root, h(*[y for p in path for y in p]), x, x == root))
    return sorted(out, key=str)


DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize(("height", "n", "sources"), [(1, 130, 11), (2, 300, 100), (7, 5000, 3)])
def test_proofs_match_brute_force(spark, height, n, sources):
    rng = random.Random(n)
    rows = [(k * 7 % n, rng.choice(["a\nb", "tëxt", "", "x\n\n", None]), "en", "hot" if k % 3 == 0 else f"s{rng.randrange(sources)}", k) for k in range(n)]
    rows += [(None, "no id\n", None, None, None), (None, "no id\n", None, None, None), (3, "again\n", "en", "hot", 1), rows[5], (8, "lone\n", "en", "Ünder", 2)]
    got = merkle.prove(spark.createDataFrame(rows, DOC).repartition(6), height).collect()
    assert sorted(map(tuple, got), key=str) == brute_proofs(rows)
    assert {r.verified for r in got} == {True, False}


def test_proofs_of_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    assert sorted(map(tuple, merkle.prove(docs).collect()), key=str) == brute_proofs(rows)
    assert merkle.prove(docs.limit(0)).count() == 0
    one = merkle.prove(docs.where("doc_id = 5 and text like 'another%'")).collect()
    assert [(r.subroot, r.root, r.proof_sha256) for r in one] == [(one[0].leaf, one[0].leaf, h())]


def test_octopus_is_what_folding_needs_and_cannot_derive():
    rng = random.Random(3)
    for n in (1, 2, 3, 4, 10, 28, 100):
        for _ in range(20):
            known = set(rng.sample(range(n), rng.randrange(1, n + 1)))
            need = merkle.octopus(known, n)
            needed, level, size, lv = set(), set(known), n, 0  # all siblings of all paths, less those above a known node
            while size > 1:
                up = {i // 3 for i in level}
                needed |= {(lv, i) for r in up for i in range(3 * r, min(size, 3 * r + 3))} - {(lv, i) for i in level}
                level, size, lv = up, -(-size // 3), lv + 1
            assert len(need) == len(set(need)) and set(need) == needed


# ------------------------------------------------------------------ trie
def brute_trie(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            half = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            signed = lambda x: (int(x, 16) + 2**63) % 2**64 - 2**63
            turns[c].append(((t is not None, t or 0), signed(half[:16]), signed(half[16:]), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c in own:
        n = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(base, [])[:n] + own[c][n:])
    members = collections.defaultdict(list)
    for c, s in sorted(built.items()):
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = collections.defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    out = []
    for s, convs in members.items():
        below = [t for t in members if t[: len(s)] == s]
        saved = sum((len(members[t]) - 1) * len(t[-1][1]) for t in below if t)
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(s))
        out.append((convs[0], len(s), members[s[:-1]][0] if s else None, len(convs), len(kids[s]), sum(not kids[t] for t in below), saved, h(ends)))
    return sorted(out, key=str)


TURN = "conv_id bigint, turn bigint, role string, text string"


def test_trie_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(90, 330), -5, -100, -130, 10**12]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, rng.choice([t, t, 3]), rng.choice(["user", "assistant", None]), rng.choice(["hé", "yes", "", None, "a longer\ntext"])))
        rows += [(c, None, "user", "no turn")] * (c % 7 == 0)
    for c in range(1000, 1060):  # one conversation many times
        rows += [(c, t, "user", f"turn {t}") for t in range(4)]
    rows += [(None, 1, "user", "x"), (None, None, None, None), rows[3], rows[3]]
    rows += [(2000, t, "user", f"long {t % 7}") for t in range(1500)]  # a conversation over several partitions
    rng.shuffle(rows)
    got = trie.prefix_trie(spark.createDataFrame(rows, TURN).repartition(4)).collect()
    want = [r for r in brute_trie([x for x in rows if x[0] != 2000])]
    less = trie.prefix_trie(spark.createDataFrame([x for x in rows if x[0] != 2000], TURN)).collect()
    assert sorted(map(tuple, less), key=str) == want
    chain = [r for r in got if r.conv_id == 2000]
    assert max(r.depth for r in chain) in range(1494, 1501) and {r.n_convs for r in chain} == {1}


def test_trie_turnless_and_empty(spark):
    # conversations whose few turns all are replaced by those of a base that does not exist
    short = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1][:3]
    rows = [(c, 0, "user", "gone") for c in short]
    got = trie.prefix_trie(spark.createDataFrame(rows, TURN)).collect()
    assert sorted(map(tuple, got), key=str) == brute_trie(rows) == [(short[0], 0, None, 3, 0, 1, 0, h(",".join(map(str, short))))]
    assert trie.prefix_trie(spark.createDataFrame([], TURN)).count() == 0
    extra = spark.createDataFrame([(c, t, r, x, 1, 2, "k") for c, t, r, x in rows], TURN + ", depth int, p int, chunk string")
    assert sorted(map(tuple, trie.prefix_trie(extra).collect()), key=str) == brute_trie(rows)


# ------------------------------------------------------------------ nearest vectors
def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dim = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, dim - len(v)))) for i, v in good]
    out = []
    for i, v in good:
        if i is not None and i % 20 == 0:
            near = sorted((-float(v @ w), j is None, j) for j, w in good if j != i)[:k]
            out += [(i, n + 1, j, round(-s, 9)) for n, (s, _, j) in enumerate(near)]
    return sorted(out, key=str)


def found(df, **how):
    return sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in permutation.nearest(df, F.col("id") % 20 == 0, **how).collect()), key=str)


VEC = "vec_id bigint, embedding array<float>, label int, key int, part string"


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=6) * rng.choice([0.1, 1, 30])]) for k in range(300)]
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None]), (380, [float("nan")] * 6), (400, [float("inf"), 1.0]), (420, [1.0, 2.0]), (None, [3.0] * 6), (301, rows[40][1]), (302, rows[40][1])]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VEC)
    assert found(df) == brute_nearest(rows, 20)
    assert found(df.where("vec_id < 8")) == brute_nearest(rows[:8], 20)  # fewer candidates than neighbours
    assert found(df.where("vec_id = 0")) == [] == found(df.limit(0)) == found(df.where("vec_id = 300"))
    twice = df.where("vec_id in (0, 1)")
    assert found(twice.unionAll(twice)) == [(0, 1, 1, brute_nearest(rows[:2], 1)[0][3]), (0, 2, 1, brute_nearest(rows[:2], 1)[0][3])]


def test_recall_on_a_larger_table(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 32))
    x = centres[rng.integers(0, 8, 12000)] * 0.6 + rng.normal(size=(12000, 32))
    x[4000:8000] = x[3] + rng.normal(size=(4000, 32)) * 0.01  # a third of all rows near one place
    x *= rng.uniform(0.5, 2.0, (12000, 1))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(8)
    got = collections.defaultdict(list)
    for r in permutation.nearest(df, F.col("id") % 20 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    caught = []
    for q in range(0, 12000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        least = np.sort(s)[-20]
        rows = sorted(got[q])
        assert [r[0] for r in rows] == list(range(1, 21)) and len({r[1] for r in rows}) == 20 and q not in {r[1] for r in rows}
        assert all(abs(s[i] - v) < 1e-9 for _, i, v in rows) and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        caught.append(sum(v >= least - 1e-9 for _, _, v in rows) / 20)
    assert np.mean(caught) >= 0.9
