"""The registered queries ``opN_<name>``: each operator over its whole table, with production
parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import functools
import os
import secrets
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmodel.llm import decontaminate, html, lines, merkle, mixing, neardup, permutation, pii, quality, rules, substring, tokens, trie

REG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed (local runs)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))


def register(name: str, sql: str | None = None):
    def add(f):
        @functools.wraps(f)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return f(spark, sf_dir)

        REG[name] = (query, sql)
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


KEY = "spark.clickmodel.surrogateKey"


def surrogate_key(spark: SparkSession) -> bytes:
    """The key of the surrogates, set in the session. Without one a random key is made for the
    session: surrogates then cannot be recomputed, nor agree with those of another session."""
    if spark.conf.get(KEY, None) is None:
        spark.conf.set(KEY, secrets.token_hex(32))
    return spark.conf.get(KEY).encode()


@register("op1_pii_surrogates")
def op1(spark, d):
    return pii.pseudonymize(_table(spark, d, "documents"), surrogate_key(spark))


@register("op2_quality_classifier")
def op2(spark, d):
    docs = _table(spark, d, "documents")
    model = quality.fit(docs, _table(spark, d, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@register("op3_mixing")
def op3(spark, d):
    return mixing.mix(_table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT r, doc_id, p, array_to_string(ws[p:p + 49], ' ') AS k
  FROM (SELECT r, doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS p FROM d WHERE len(ws) >= 50)),
c AS (SELECT r, p FROM (SELECT r, doc_id, p, min(doc_id) OVER (PARTITION BY md5(k)) AS m FROM g) WHERE doc_id > m),
gone AS (SELECT DISTINCT r, p + o AS p FROM c, (SELECT unnest(generate_series(0, 49)) AS o)),
w AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM w ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@register("op4_substring_dedup", OP4_SQL)
def op4(spark, d):
    out = substring.remove_repeats(_table(spark, d, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_STOPS = ", ".join(f"'{w}'" for w in sorted(set(rules.STOP_WORDS)))
OP5_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
win AS (SELECT r, unnest(generate_series(1, len(ws) - 4)) AS p, ws FROM w WHERE len(ws) >= 5),
g AS (SELECT r, p, array_to_string(ws[p:p+4], ' ') AS k FROM win),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c >= 2),
cov AS (SELECT r, count(DISTINCT p + o) AS n FROM rep, (SELECT unnest([0, 1, 2, 3, 4]) AS o) GROUP BY r),
words AS (SELECT r, count(*) AS n_words, sum(length(x)) AS word_chars,
  count(*) FILTER (WHERE rtrim(lower(x), ',.;:') IN ({_STOPS})) AS stops,
  count(*) FILTER (WHERE suffix(x, '!!')) AS shouts,
  count(*) FILTER (WHERE x = before) AS stutters,
  count(bare) FILTER (WHERE length(bare) <= 4 AND regexp_full_match(bare, '\p{{L}}+')) AS shorts,
  count(DISTINCT bare) FILTER (WHERE length(bare) <= 4 AND regexp_full_match(bare, '\p{{L}}+')) AS short_kinds
  FROM (SELECT r, x, rtrim(lower(x), ',.;:') AS bare, lag(x) OVER (PARTITION BY r ORDER BY p) AS before FROM u) GROUP BY r),
o AS (SELECT r, regexp_replace(t, '[\x{{0}}-\x{{24F}}\x{{1E00}}-\x{{1EFF}}\P{{L}}]+', '', 'g') AS o FROM d),
script AS (SELECT r, length(o) AS other,
  length(regexp_replace(o, '[^\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}\p{{Tibetan}}]+', '', 'g')) AS unspaced FROM o),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dups FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
s AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dups, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
  coalesce(stops, 0) AS stops, coalesce(shouts, 0) AS shouts, coalesce(stutters, 0) AS stutters, coalesce(n_lines, 0) AS n_lines,
  coalesce(shorts - short_kinds, 0) AS recurrences, 3 * other >= coalesce(word_chars, 0) AS other_script, 3 * unspaced >= coalesce(word_chars, 0) AS no_blanks
  FROM d JOIN script USING (r) LEFT JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (no_blanks OR word_chars / n_words BETWEEN 2.0 AND 14.0) AND n_symbols / n_words <= 0.10
  AND (n_words < 30 OR other_script OR recurrences >= 0.02 * n_words OR stops / n_words >= 0.02) AND shouts / n_words <= 0.30 AND stutters / n_words <= 0.30
  AND dups_ok AND n_repeat_words / n_words <= 0.20 AS kept
FROM (SELECT *, n_lines = 0 OR n_dup_lines / n_lines <= 0.50 AS dups_ok FROM b)
"""


@register("op5_quality_rules", OP5_SQL)
def op5(spark, d):
    judged = rules.judge(_table(spark, d, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op6_html_text")
def op6(spark, d):
    return html.extract_text(_table(spark, d, "pages"))


OP7_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, text, string_split(text, chr(10)) AS ls FROM documents WHERE text <> ''),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p, len(ls) AS n FROM d),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM l),
z AS (SELECT *, p >= 2 AND ((lag(h) OVER w * 31) % 1000003 + h) % 1000003 % 3 = 0 AS zero FROM h WINDOW w AS (PARTITION BY r ORDER BY p)),
e AS (SELECT *, p = n OR (zero AND NOT coalesce(lag(zero) OVER w, false)) AS ends FROM z WINDOW w AS (PARTITION BY r ORDER BY p)),
k AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM e),
ch AS (SELECT r, doc_id, c, min(p) AS pos, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS chunk FROM k GROUP BY r, doc_id, c),
rk AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) AS place FROM ch WHERE n > 1 AND trim(chunk, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
gone AS (SELECT r, c, n FROM rk WHERE place > 1),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY p) AS kept FROM k ANTI JOIN gone USING (r, c) GROUP BY r),
g AS (SELECT r, count(*) AS chunks, sum(n) AS lines FROM gone GROUP BY r)
SELECT doc_id, len(ls) AS n_lines, coalesce(chunks, 0) AS n_chunks_removed, coalesce(lines, 0)::BIGINT AS n_lines_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN g USING (r)
UNION ALL SELECT doc_id, 0, 0, 0, sha256('') FROM documents WHERE text IS NULL OR text = ''
"""


@register("op7_line_dedup", OP7_SQL)
def op7(spark, d):
    out = lines.without_repeats(_table(spark, d, "documents"))
    return out.select("doc_id", "n_lines", "n_chunks_removed", "n_lines_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[p:p + least(10, len(ws)) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS p FROM i WHERE len(ws) > 0)),
dw AS (SELECT r, p, k, array_to_string(ws[p:p + k - 1], ' ') AS g
  FROM (SELECT r, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)),
hit AS (SELECT r, p, k, item_id FROM dw JOIN iw USING (k, g)),
words AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + k - 1)) AS w FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS list FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@register("op8_decontamination", OP8_SQL)
def op8(spark, d):
    found = decontaminate.find_contamination(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    listed = F.concat_ws(",", F.sort_array(F.col("item_ids").cast("array<string>")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@register("op9_token_counts")
def op9(spark, d):
    """With a new cache for each call, so its figures are those of a first run over the table."""
    return tokens.count_tokens(_table(spark, d, "documents"), tokens.fresh_cache(spark), tokenizer_file())


@register("op10_near_duplicates")
def op10(spark, d):
    out = neardup.near_duplicates(_table(spark, d, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@register("op11_nearest_vectors")
def op11(spark, d):
    return permutation.nearest(_table(spark, d, "embeddings"), F.col("id") % 20 == 0)


def _sql_crc32(x: str) -> str:
    """Unsigned crc32 of the decimal text of ``x`` (not NULL): eight shifts a byte."""
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda z: CAST(ord(z) AS BIGINT))),
  lambda a, z: list_reduce([xor(a, z), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)"""


def _sql_field(x: str) -> str:
    return f"coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"


_HEAD = " || ".join(map(_sql_field, ("doc_id", "source", "lang", "n_chars")))
OP12_SQL = rf"""
WITH RECURSIVE f AS (SELECT doc_id, source, sha256({_HEAD} || {_sql_field("text")}) AS leaf,
  sha256({_HEAD} || CASE WHEN doc_id IS NOT NULL AND {_sql_crc32("coalesce(doc_id, 0)")} % 2 = 0 THEN {_sql_field("replace(text, chr(10), '')")} ELSE {_sql_field("text")} END) AS changed
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS i,
  count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t FROM f),
up AS (SELECT 0 AS lv, t, i, n, leaf AS h FROM l
  UNION ALL SELECT lv + 1, t, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lv, t, i // 3, n),
sub AS (SELECT t, h FROM up WHERE n = 1),
top AS (SELECT 0 AS lv, t AS i, (SELECT count(*) FROM sub) AS n, h FROM sub
  UNION ALL SELECT lv + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lv, i // 3, n),
nodes AS (SELECT 0 AS z, lv, t, i, n, h FROM up UNION ALL SELECT 1, lv, 0, i, n, h FROM top),
around AS (SELECT a.z, a.lv, a.t, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS x,
  coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS y
  FROM nodes a JOIN nodes b ON a.z = b.z AND a.lv = b.lv AND a.t = b.t AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL),
fold AS (SELECT row_number() OVER () AS r, doc_id, leaf, t AS src, 0 AS z, 0 AS lv, t, i, n, changed AS cur, '' AS sibs FROM l
  UNION ALL SELECT r, doc_id, leaf, src, CASE WHEN f.n > 1 THEN f.z ELSE 1 END, CASE WHEN f.n > 1 THEN f.lv + 1 ELSE 0 END,
  CASE WHEN f.n > 1 THEN f.t ELSE 0 END, CASE WHEN f.n > 1 THEN f.i // 3 ELSE src END,
  CASE WHEN f.n > 1 THEN (f.n + 2) // 3 ELSE (SELECT count(*) FROM sub) END,
  CASE WHEN f.n > 1 THEN sha256(x || cur || y) ELSE cur END, sibs || CASE WHEN f.n > 1 THEN x || y ELSE '' END
  FROM fold f LEFT JOIN around a ON a.z = f.z AND a.lv = f.lv AND a.t = f.t AND a.i = f.i WHERE f.n > 1 OR f.z = 0)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(sibs) AS proof_sha256, cur AS folded_root, cur = top.h AS verified
FROM fold JOIN sub ON sub.t = src JOIN top ON top.n = 1 WHERE fold.z = 1 AND fold.n = 1
"""


@register("op12_manifest_proofs", OP12_SQL)
def op12(spark, d):
    return merkle.prove(_table(spark, d, "documents"))


OP13_SQL = rf"""
WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(k)) AS i, md5(k) AS m, length(coalesce(text, '')) AS n
  FROM (SELECT *, CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '') AS k FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT c, {_sql_crc32("c")} % 6 AS h FROM (SELECT DISTINCT c FROM o)),
b AS (SELECT c.c, 0 AS own, o.i, m, n FROM c JOIN o ON o.c = c.c - c.c % 100 AND o.i <= h
  UNION ALL SELECT c.c, 1, o.i, m, n FROM c JOIN o ON o.c = c.c AND o.i > h),
p AS (SELECT c, row_number() OVER w AS d, md5(string_agg(m, ',') OVER w) AS k, n FROM b WINDOW w AS (PARTITION BY c ORDER BY own, i ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT c, 0, '', 0 FROM c),
q AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS final FROM p),
v AS (SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, max(n) AS n,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE final), '')) AS ends_sha256 FROM q GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM v WHERE d > 0 GROUP BY 1, 2),
below AS (SELECT a.d, a.k, sum((v.n_convs - 1) * v.n) AS saved, count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves
  FROM v LEFT JOIN kids USING (d, k) JOIN p AS a ON a.c = v.conv_id AND a.d <= v.d GROUP BY 1, 2)
SELECT v.conv_id, v.d AS depth, parent.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v LEFT JOIN kids USING (d, k) JOIN below USING (d, k) LEFT JOIN v AS parent ON parent.d = v.d - 1 AND parent.k = v.up
"""


@register("op13_prefix_trie", OP13_SQL)
def op13(spark, d):
    return trie.prefix_trie(_table(spark, d, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REG.items() if v[1]}
