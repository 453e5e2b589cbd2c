"""Operators over the whole corpus, against brute force: repeats, chunks, groups, mixing, pipeline."""

import collections
import hashlib
import random

import numpy as np
import pytest

from clickmodel.llm import components, lines, mixing, neardup, queries, substring
from tests_support import edge_docs


@pytest.fixture(autouse=True)
def _ready(spark):
    queries.ready(spark)


def corpus(seed=1, n=60):
    """Texts with exact copies, near copies, shared passages and repeated lines."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnopqr") + rng.choice("stuv")
    passage = " ".join(word() for _ in range(70))
    base = [" ".join(word() for _ in range(rng.choice([3, 30, 60, 120, 200]))) for _ in range(n)]
    out = list(base)
    for k in range(n // 3):
        w = base[k].split()
        out.append(base[k])
        if len(w) > 20:
            out.append(" ".join([*w[:10], "edited", *w[11:]]))
            out.append(" ".join([*w[:7], passage, *w[7:]]))
            out.append("\n".join(" ".join(w[i : i + 6]) for i in range(0, len(w), 6)).upper())
    return out


# ------------------------------------------------------------------ substring dedup
def brute_repeats(rows, window):
    least = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "block", "parts"), [(50, 25, 4), (7, 3, 3)])
def test_substring_matches_brute_force(spark, window, block, parts):
    rows = [(i * 3, t) for i, t in enumerate(corpus())]
    rows += [(None, rows[4][1]), (6, rows[9][1]), (rows[5][0], rows[5][1]), (999, None), (998, ""), (997, " \n")]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, kept string")
    got = substring.remove_repeats(df, window=window, block=block, parts=parts).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str) == brute_repeats(rows, window)
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in got)


def test_substring_refuses_blocks_that_a_window_can_miss(spark):
    with pytest.raises(ValueError, match="block"):
        substring.remove_repeats(edge_docs(spark), window=10, block=6)
    assert substring.remove_repeats(edge_docs(spark).limit(0)).count() == 0


# ------------------------------------------------------------------ line dedup
def test_lines_remove_repeated_chunks_only(spark):
    block = [f"shared line number {k} of the block" for k in range(40)]
    docs = [(1, "\n".join(["own first line", *block, "end"])), (2, "\n".join(["another start", "and more", *block, "different end"])),
            (3, "only\none\nof a kind"), (4, ""), (5, None), (6, "single line"), (7, "single line"), (8, "\n\n\n\n"), (9, "\n\n\n\n")]
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id bigint, text string, n_lines int")
    got = {r.doc_id: r for r in lines.without_repeats(df).collect()}
    assert got[1].kept == docs[0][1] and got[2].n_lines_removed >= 30
    assert got[2].kept.startswith("another start") and got[2].kept.endswith("different end")
    assert all(got[i].n_lines_removed == 0 for i in (1, 3, 4, 5, 6, 7, 8, 9)) and got[5].kept is None and got[4].n_lines == 0
    edge = edge_docs(spark)
    assert lines.without_repeats(edge).count() == edge.count() and lines.without_repeats(edge.limit(0)).count() == 0
    whole = df.unionByName(spark.createDataFrame([(10, docs[0][1], 5)], df.schema)).withColumnRenamed("n_lines", "n_chars")
    kept = {r.doc_id: r for r in lines.deduplicated(whole).collect()}
    assert 10 not in kept and set(kept) == {1, 2, 3, 4, 5, 6, 7, 8, 9} and kept[2].n_chars == len(kept[2].text)


def test_lines_plan_has_no_python(spark):
    plan = lines.without_repeats(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ------------------------------------------------------------------ near duplicates
def brute_members(rows, percent=75):
    """(sets, the row numbers of each group); a row without words is a group of its own."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    return sets, list(groups.values())


def brute_group_count(rows):
    """Groups of documents with words; two groups may have one least id."""
    sets, groups = brute_members(rows)
    return sum(bool(sets[g[0]]) for g in groups)


def brute_groups(rows, percent=75):
    sets, groups = brute_members(rows, percent)
    out = []
    for members in groups:
        least = min((rows[k][0] for k in members if rows[k][0] is not None), default=None)
        out += [(rows[k][0], len(sets[k]), least) for k in members]
    return sorted(out, key=str)


def test_groups_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(corpus(3, 80))] + [(900, None), (901, ""), (902, " \n"), (903, "two words"), (904, "TWO  words"), (None, "two words"), (5, "same id other text here now")]
    rng = random.Random(4)
    words = "one large group of near copies with a long common text that differs in a few words here and there only".split() * 5
    for k in range(60):  # a chain of near copies: neighbours link, far ones do not
        words[rng.randrange(len(words))] = f"w{k}"
        rows.append((2000 - k, " ".join(words)))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, node int")
    got = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_groups(rows)
    kept = neardup.one_of_each(df).collect()
    empty = sum(not (t or "").split() for _, t in rows)
    assert len(kept) == brute_group_count(rows) + empty
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_one_of_each_keeps_every_group(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(20))
    rows = [(None, text(k)) for k in range(6)] + [(None, text(0)), (None, text(6)), (40, text(6)), (41, text(6))]  # no id: seven groups
    rows += [(5, text(7)), (5, text(8)), (50, text(7)), (51, text(8))]  # two groups under one id, copies under others
    got = neardup.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, text(k)) for k in range(6)] + [(40, text(6)), (5, text(7)), (5, text(8))], key=str)


def test_rest_round_finds_links_that_proposals_miss(spark, monkeypatch):
    # without proposals all links must come from the comparison of the regions' groups
    rows = [(i, t) for i, t in enumerate(corpus(5, 20))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = neardup.written if hasattr(neardup, "written") else neardup.scratch.written
    monkeypatch.setattr(neardup.scratch, "written", lambda d, n: plain(d.limit(0) if n == "proposed" else d, n))
    got = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_groups(rows)


def test_rest_round_over_many_blocks(spark, monkeypatch):
    # the same with regions of many blocks, in which every pair of blocks must meet once
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*words[:i], "x", *words[i + 1 :]])) for i in range(0, 60, 2)] + [(100 + i, t) for i, t in enumerate(corpus(6, 12))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = neardup.scratch.written
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 4)
    monkeypatch.setattr(neardup.scratch, "written", lambda d, n: plain(d.limit(0) if n == "proposed" else d, n))
    got = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_groups(rows)


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1300)] + [(7, 7), (2000, 1999)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 0 for k in range(61)) and all(got[k] == 1000 for k in range(1000, 1300)) and got[2000] == 1999
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_signature_equality_estimates_similarity():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    b = np.sort(np.r_[a[:750], rng.integers(0, 2**63, 250, dtype=np.uint64)])
    sig = neardup._signatures(np.array([0, 1000]), np.r_[a, b])
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.15


# ------------------------------------------------------------------ mixing
def brute_targets(sizes, weights, cap=3):
    total, target, capped = sum(sizes), [0.0] * len(sizes), [False] * len(sizes)
    while True:
        left = total - sum(cap * s for s, c in zip(sizes, capped, strict=True) if c)
        weight = sum(w for w, c in zip(weights, capped, strict=True) if not c)
        target = [cap * s if c else left * w / weight for s, w, c in zip(sizes, weights, capped, strict=True)]
        over = [t > cap * s + 1e-9 for t, s in zip(target, sizes, strict=True)]
        if not any(over):
            return target
        capped = [c or o for c, o in zip(capped, over, strict=True)]


def test_mix_meets_targets(spark):
    rng = random.Random(6)
    rows = [(i, rng.choices(["a", "b", "c", "Z", "é", None], [5, 90, 60, 40, 30, 2])[0], " ".join("w" for _ in range(rng.choice([0, 5, 40, 300])))) for i in range(3000)]
    rows += [(None, "a", None), (7, "b", "x y"), (7, "b", "x y")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(7)
    got = mixing.mix(df, keep=("doc_id", "source")).collect()
    assert len(got) == len(rows)
    names = sorted({r[1] for r in rows if r[1] is not None}, key=lambda s: s.encode()) + [None]
    size = collections.Counter()
    for _, s, t in rows:
        size[s] += len((t or "").split())
    target = dict(zip(names, brute_targets([size[s] for s in names], [1 + k % 3 for k in range(len(names))]), strict=True))
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source]) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 5 for s in names)
    again = mixing.mix(df.repartition(3), keep=("doc_id", "source")).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_edge_tables(spark):
    edge = edge_docs(spark)
    assert mixing.mix(edge).count() == edge.count() and mixing.mix(edge.limit(0)).count() == 0
    out = mixing.mixed_documents(edge)
    assert {"size_in", "target_in", "size", "target", "taken"} <= set(out.columns)


# ------------------------------------------------------------------ pipeline
def test_pipeline_runs_its_stages_in_order(spark):
    import corpus_pipeline as P
    d = "/root/testdata/sf0.001"
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "near-dedup", "benchmark decontamination", "mixing"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen, columns = docs, docs.columns
    for name, stage in P.STAGES[:-1]:
        after = neardup.scratch.written(stage(spark, seen, d), "stage")
        assert after.columns == columns and after.dtypes == docs.dtypes and 0 < after.count() <= seen.count(), name
        seen = after
    rows = P.run(spark, d).collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in seen.select("doc_id").collect()}
    assert all(1 <= r.copies <= 3 and r.taken == r.copies * r.size for r in rows if r.size)
    clean = {r.doc_id for r in spark.read.parquet(f"{d}/labels.parquet").where("quality = 1").collect()}
    left = {r.doc_id for r in P.STAGES[0][1](spark, docs, d).collect()}
    long = {r.doc_id for r in docs.collect() if len(r.text.split()) >= 10}
    assert len(clean & long - left) <= 0.05 * len(clean & long)


def test_stages_of_an_empty_table(spark):
    from clickmodel.llm import decontaminate, rules

    docs = edge_docs(spark).limit(0)
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    for stage in (rules.keep_good, lines.deduplicated, neardup.one_of_each, lambda d: decontaminate.drop_contaminated(d, benchmark)):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() == 0
    assert mixing.mixed_documents(docs).count() == 0
