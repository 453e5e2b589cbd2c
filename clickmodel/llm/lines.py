"""Line dedup over content-defined chunks of lines.

A text is cut into lines, and lines into chunks at content-defined boundaries: a line ends a
chunk when a rolling hash over the hashes of it and the line before it falls on one value in
``ONE_IN``, and that of the line before did not. Boundaries move with their lines, so an inserted line changes the chunk it falls
into and at most the next few. A chunk of several lines that stands elsewhere in the corpus too
is removed, all but its first place (least id, then earliest); chunks are found by hash and
removed after comparing bytes.

Hashes and places are grouped first; chunks meet the hashes that occur twice, and the others of a
hash the first place's bytes, in joins that Spark may split. Everything is DataFrame code; no
user functions.

Defined results: NULL and empty texts have no lines and stay as they are (a NULL text stays
NULL); a chunk of one line, or of white space alone, is never removed; a NULL id comes after all
others; rows that repeat an id are told apart by their text, and rows alike in id and text by
nothing: they share one fate, the first place, and stay; an empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmodel.llm import scratch
from clickmodel.llm.rules import SPACES

ONE_IN = 3  # chunks then have 4.5 lines on average
ROLL = 2  # lines in the rolling window
FACTOR, PRIME = 31, 1_000_003


def line_hash(line: Column) -> Column:
    """28 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def rolls_to_zero(hashes: Column, i: Column, one_in: int, roll: int) -> Column:
    """Whether the polynomial of the last ``roll`` hashes up to line ``i`` (from 1) falls on 0."""
    rolled = F.get(hashes, i - roll)
    for k in range(roll - 1, 0, -1):
        rolled = rolled * FACTOR % PRIME + F.get(hashes, i - k)
    return (i >= roll) & (rolled % PRIME % one_in == 0)


def ends_chunk(hashes: Column, i: Column, one_in: int, roll: int) -> Column:
    """Whether line ``i`` ends a chunk: the first line of each run of lines that roll to zero
    (so a chunk has two lines at least), and the last line."""
    return (i == F.size(hashes)) | (rolls_to_zero(hashes, i, one_in, roll) & ~rolls_to_zero(hashes, i - 1, one_in, roll))


def chunks(docs: DataFrame, one_in: int = ONE_IN, roll: int = ROLL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _x, pos, n, chunk): every chunk of every text, with its first line's position and
    its number of lines; ``_x`` hashes the whole text."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).where("_t is not null and _t <> ''")
    rows = rows.select("_id", F.xxhash64("_t").alias("_x"), F.split("_t", "\n").alias("_l"))
    rows = rows.withColumn("_h", F.transform("_l", line_hash))
    rows = rows.withColumn("_c", F.filter(F.sequence(F.lit(1), F.size("_h")), lambda i: ends_chunk(F.col("_h"), i, one_in, roll))).drop("_h")
    begin = lambda e, k: F.coalesce(F.get(F.col("_c"), k - 1), F.lit(0))
    parts = F.transform("_c", lambda e, k: F.struct((begin(e, k) + 1).alias("pos"), (e - begin(e, k)).alias("n"),
                        F.array_join(F.slice(F.col("_l"), begin(e, k) + 1, e - begin(e, k)), "\n").alias("chunk")))
    return rows.select("_id", "_x", F.inline(parts))


def repeated_chunks(docs: DataFrame, one_in: int = ONE_IN, roll: int = ROLL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _x, pos, n) of the chunks to remove."""
    multi = chunks(docs, one_in, roll, id_col, text_col).where((F.col("n") > 1) & (F.translate("chunk", SPACES, "") != ""))
    place = F.struct(F.col("_id").isNull().alias("z"), F.col("_id").alias("i"), F.col("_x").alias("x"), F.col("pos").alias("p"))
    keyed = multi.select(F.xxhash64("chunk").alias("_h"), F.length("chunk").alias("_len"), place.alias("_at"), "n", "chunk")
    heads = keyed.groupBy("_h", "_len").agg(F.min("_at").alias("_first"), F.count("*").alias("_k")).where("_k > 1").drop("_k")
    heads = scratch.written(heads, "heads")  # so that Spark may split the chunks of a frequent hash in the join
    twice = scratch.written(keyed.join(heads.hint("merge"), ["_h", "_len"]), "repeated-chunks")  # dealt alike at every size
    first = twice.where("_at = _first").select("_h", "_len", F.col("chunk").alias("_bytes")).dropDuplicates(["_h", "_len"])
    later = twice.where("_at <> _first").join(scratch.written(first, "first-chunks"), ["_h", "_len"])
    same = later.where("chunk = _bytes")
    return same.select(F.col("_at.i").alias("_id"), F.col("_at.x").alias("_x"), F.col("_at.p").alias("pos"), "n")


def without_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), one_in: int = ONE_IN, roll: int = ROLL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` plus n_lines, n_chunks_removed, n_lines_removed and the text left (``kept``)."""
    gone = repeated_chunks(docs, one_in, roll, id_col, text_col).distinct()
    gone = gone.groupBy("_id", "_x").agg(F.collect_list(F.struct("pos", "n")).alias("_gone")).select(F.col("_id").alias("_gid"), F.col("_x").alias("_gx"), "_gone")
    rows = docs.select(*keep, F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).withColumn("_x", F.xxhash64("_t"))
    rows = rows.join(gone.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_x") == F.col("_gx")), "left")
    line = F.split("_t", "\n")
    out = F.filter(line, lambda x, i: ~F.exists("_gone", lambda g: (i + 1 >= g["pos"]) & (i + 1 < g["pos"] + g["n"])))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return rows.select(
        *keep,
        F.when(F.coalesce(F.length("_t"), F.lit(0)) > 0, F.size(line)).otherwise(0).cast("long").alias("n_lines"),
        number(F.when(F.col("_gone").isNotNull(), F.size("_gone"))).alias("n_chunks_removed"),
        number(F.aggregate("_gone", F.lit(0), lambda a, g: a + g["n"])).alias("n_lines_removed"),
        F.when(F.col("_gone").isNull(), F.col("_t")).otherwise(F.array_join(out, "\n")).alias("kept"),
    )


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """The documents with their repeated chunks removed and exactly the input's columns; a
    document that loses all its words goes (stage form). ``n_chars`` follows the text."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    cut = without_repeats(packed, keep=("_row",), **how)
    cut = cut.where((F.col("n_lines_removed") == 0) | (F.translate("kept", SPACES, "") != ""))
    new = {"text": F.col("kept"), "n_chars": F.when(F.col("n_lines_removed") == 0, F.col("_row.n_chars")).otherwise(F.length("kept"))}
    kinds = dict(docs.dtypes)
    return cut.select(*[new[c].cast(kinds[c]).alias(c) if c in new else F.col("_row").getField(c).alias(c) for c in names])
