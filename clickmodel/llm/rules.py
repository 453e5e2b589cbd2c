"""Quality rules: a threshold table compiled into one Spark projection.

Every signal is a built-in Spark expression over the whole text; ``compile_rules`` turns the
table of (name, signal, low, high) rows into one projection with a boolean per rule and the
verdict. No user functions, no shuffle.

Defined results: NULL and empty texts have no words, all counts 0, ``base_failed`` true and
``kept`` false. Repeated rows are judged separately. An empty table gives an empty result.
Extra columns do not matter: signals are computed from one renamed copy of the text column.
A 5-word window is compared by its 64-bit hash inside one document.

Signals that cannot judge a text are NULL. Mean word length: texts with a third or more of their
characters in scripts without blanks between words (Han, kana, Thai, ...). Stop words: texts under
30 words, with a third or more of their characters in letters of other scripts than Latin, or with
few words of the list but short words that recur as function words of any language do. The word
count of ``base_failed`` is by white space in every script, so a text without blanks needs ten
stretches between white space.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = tuple(
    "the of and to in a is that it for on was with as by an be this are from or at "
    "le la les de des du et un une que qui dans en est pour au ou par sur "
    "der die das und ist ein eine den dem von zu mit auf nicht im für sich als "
    "el los las y del se con por para una es no su al lo como".split()
)


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= signal <= high`` (None: unbounded); a NULL signal passes."""

    name: str
    signal: str
    low: float | None = None
    high: float | None = None


# The production threshold table. Signals are the columns made by ``signals``.
RULES = (
    Rule("mean_word_length", "mean_word_length", 2.0, 14.0),
    Rule("symbol_ratio", "symbols_per_word", None, 0.10),
    Rule("stop_word_ratio", "stop_word_ratio", 0.02, None),  # judged from 30 words on
    Rule("shout_ratio", "shout_ratio", None, 0.30),
    Rule("stutter_ratio", "stutter_ratio", None, 0.30),
    Rule("duplicate_line_ratio", "dup_line_ratio", None, 0.50),
    Rule("repeated_word_ratio", "repeat_word_ratio", None, 0.20),
)

STOP_WORDS_FROM = 30
# Texts of other scripts and languages than the stop words'.
OTHER_SHARE = 1 / 3  # of the characters, from which a script counts as the text's
SHORT, RECURRING = 4, 0.02  # letters of a function word; least share of words that are recurrences of one
NOT_OTHER_LETTERS = r"[\x00-\u024F\u1E00-\u1EFF\P{L}]+"  # all but letters of other scripts than Latin
SPACED = r"[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]+"
BASE_MIN_WORDS, BASE_MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, as an array."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def signals(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus the counts and ratios of each document's whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*keep, t.alias("_t"))
    spoken = F.translate("_t", SPACES, "")
    df = df.select(
        *keep,
        "_t",
        words_of(F.col("_t")).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: F.translate(x, SPACES, "") != "").alias("_l"),
        F.length(spoken).cast("long").alias("word_chars"),
        F.regexp_replace("_t", NOT_OTHER_LETTERS, "").alias("_o"),
    )
    n = F.size("_w")
    w = F.col("_w")
    window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    starts = F.sequence(F.lit(0), n - WINDOW)
    bare = lambda x: F.rtrim(F.lower(x), F.lit(",.;:"))
    df = df.select(
        *keep,
        "word_chars",
        "_w",
        F.length("_o").alias("_other"),
        F.when(F.length("_o") > 0, F.length(F.regexp_replace("_o", SPACED, ""))).otherwise(0).alias("_unspaced"),
        n.cast("long").alias("n_words"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda x: bare(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_w", lambda x: F.endswith(x, F.lit("!!")))).cast("long").alias("n_shouts"),
        F.size(F.filter("_w", lambda x, i: x == F.get(w, i - 1))).cast("long").alias("n_stutters"),
        F.when(n >= WINDOW, F.transform(starts, window)).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )
    # Windows seen twice or more: equal neighbours after sorting (hash, position).
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    pairs = F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    df = df.withColumn("_s", F.when(repeats, F.sort_array(pairs))).drop("_h")
    s = F.col("_s")
    same = lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
    df = df.withColumn("_p", F.sort_array(F.transform(F.filter(s, same), lambda x: x["p"]))).drop("_s")
    p = F.col("_p")
    covered = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(x - F.get(p, i - 1), F.lit(WINDOW))))
    df = df.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long"),
    ).drop("_p")
    # Only texts with few stop words are searched for recurring short words.
    few = (F.col("n_words") >= STOP_WORDS_FROM) & (F.col("n_stop_words") < 0.02 * F.col("n_words"))
    short = F.filter(F.transform("_w", bare), lambda x: (F.length(x) <= SHORT) & x.rlike(r"^\p{L}+$"))
    df = df.withColumn("_short", F.when(few, short)).drop("_w")
    recurring = F.coalesce(F.size("_short") - F.size(F.array_distinct("_short")) >= RECURRING * F.col("n_words"), F.lit(False))
    other, unspaced = (F.col(c) >= OTHER_SHARE * F.col("word_chars") for c in ("_other", "_unspaced"))
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    df = df.select(
        "*",
        F.when(~unspaced, ratio("word_chars", "n_words")).alias("mean_word_length"),
        ratio("n_symbols", "n_words").alias("symbols_per_word"),
        F.when((F.col("n_words") >= STOP_WORDS_FROM) & ~other & ~recurring, ratio("n_stop_words", "n_words")).alias("stop_word_ratio"),
        ratio("n_shouts", "n_words").alias("shout_ratio"),
        ratio("n_stutters", "n_words").alias("stutter_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"),
    )
    return df.drop("_other", "_unspaced", "_short")


def compile_rules(rules: tuple[Rule, ...]) -> list[Column]:
    """One boolean column ``ok_<name>`` per row of the table."""
    out = []
    for r in rules:
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (F.col(r.signal) >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (F.col(r.signal) <= F.lit(r.high))
        out.append(F.coalesce(ok, F.lit(True)).alias(f"ok_{r.name}"))
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Signals, one boolean per rule, ``base_failed`` and ``kept``."""
    df = signals(docs, text, keep)
    base = (F.col("n_words") < BASE_MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.select("*", base.alias("base_failed"), *compile_rules(rules))
    verdict = ~F.col("base_failed")
    for r in rules:
        verdict = verdict & F.col(f"ok_{r.name}")
    return df.withColumn("kept", verdict)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass, with exactly the input's columns (stage form)."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs[text].alias("_text"))
    judged = judge(packed, rules, "_text", keep=("_row",))
    # A row generator instead of a filter: a filter on the verdict would be pushed below the
    # projections and repeat their expressions.
    good = judged.select(F.explode(F.when(F.col("kept"), F.array("_row"))).alias("_row"))
    return good.select(*[F.col("_row").getField(c).alias(c) for c in names])
