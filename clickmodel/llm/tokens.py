"""Token counts through a digest cache.

A stored table holds (tokenizer digest, content digest) -> number of tokens. Counting joins
the documents' digests to it, encodes only the distinct contents it lacks, and appends those.

Normalised content is the text with NULL read as empty: any other normalisation would change
the count. The tokenizer digest covers the vocabulary file's bytes and the library version, so
another tokenizer or version never meets old counts.

Counts are those of the tokenizers library for the file. Where the file is a plain byte-level
BPE, texts of Latin letters are counted by tiktoken on the very same vocabulary, several times
faster; all other texts, and those with a special string, go to tokenizers itself. The first text
of every batch is counted both ways, and a difference turns the fast way off.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; repeated rows, also with one
doc_id, each get their row; NULL ids stay; an empty table gives an empty result. Extra columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmodel.llm import scratch

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"
BATCH_TEXTS = 256
# Fixed value: the split pattern of byte-level pre-tokenizers with use_regex.
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER_SCRIPT = re.compile("[^\x00-\u024f]")
_COUNTERS: dict[str, TokenCounter] = {}


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: a printable character for
    itself, the other bytes in order from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenCounter:
    """Counts the tokens of whole texts as the tokenizers library does."""

    def __init__(self, spec: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(spec)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._fast(json.loads(spec))

    @staticmethod
    def _fast(spec: dict):
        """The same vocabulary in tiktoken, where it is a plain byte-level BPE, else None."""
        import tiktoken

        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if not plain or spec.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return None
        special = {t["content"] for t in spec.get("added_tokens", [])}
        code = byte_alphabet()
        ranks = {bytes(code[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [model["vocab"].get("".join(m)) for m in merged]
        if None in order or order != sorted(order):  # ranks must rise with the merges
            return None
        return tiktoken.Encoding("same", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def slow(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if self.fast and texts:
            simple = [not _OTHER_SCRIPT.search(t) and not any(s in t for s in self.special) for t in texts]
            out = [len(self.fast.encode_ordinary(t)) if ok else None for t, ok in zip(texts, simple, strict=True)]
            first = next((i for i, ok in enumerate(simple) if ok), None)
            if first is None or self.slow([texts[first]]) == [out[first]]:
                rest = [i for i, ok in enumerate(simple) if not ok]
                for i in rest:
                    out[i] = self.slow([texts[i]])[0]
                return out
            self.fast = None
        return [n for t in texts for n in self.slow([t])]


def tokenizer_digest(spec: bytes) -> str:
    import tokenizers

    return hashlib.sha256(spec + tokenizers.__version__.encode()).hexdigest()


def _encode_misses(spec, version: str):
    """``spec``: broadcast vocabulary file (one file of fixed size, not corpus data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if version not in _COUNTERS:
            _COUNTERS[version] = TokenCounter(spec.value)
        seen: set[bytes] = set()  # rows alike in id and text meet in one task
        for whole in batches:
            for a in range(0, whole.num_rows, BATCH_TEXTS):
                b = whole.slice(a, BATCH_TEXTS)
                digests = b.column("digest").to_pylist()
                new = [k for k, x in enumerate(digests) if x not in seen and not seen.add(x)]
                b = b.take(pa.array(new, pa.int64())) if len(new) < len(digests) else b
                counts = _COUNTERS[version].count(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * b.num_rows, pa.string()), b.column("digest"), pa.array(counts, pa.int64())],
                    ["tokenizer", "digest", "n_tokens"],
                )

    return run


def _stored(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """The counts stored for this tokenizer; a content that two runs both appended counts once."""
    try:
        df = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], CACHE_SCHEMA)
    return df.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; new contents go to the cache first."""
    spark = docs.sparkSession
    spec = Path(tokenizer_path).read_bytes()
    version = tokenizer_digest(spec)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    # One carrier row per distinct content: copies meet as ids and digests, never as texts.
    carriers = rows.groupBy("digest").agg(F.min("_id").alias("_id"))
    misses = carriers.join(_stored(spark, cache_path, version), "digest", "left_anti")
    texts = rows.alias("r").join(
        misses.alias("m").hint("shuffle_hash"),
        (F.col("r.digest") == F.col("m.digest")) & F.col("r._id").eqNullSafe(F.col("m._id")),
        "left_semi",
    )
    encoded = texts.select("digest", "text").mapInArrow(_encode_misses(spark.sparkContext.broadcast(spec), version), CACHE_SCHEMA)
    encoded.write.mode("append").parquet(cache_path)
    slim = rows.select("_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    counts = scratch.written(_stored(spark, cache_path, version), "token-counts-now")  # so that Spark may split a text with many copies
    out = slim.join(counts, "digest", "left")
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def fresh_cache(spark: SparkSession) -> str:
    """A new cache folder in the shared folder."""
    return scratch.new_path(spark, "token-counts")
