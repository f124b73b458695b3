"""Quality rules by distribution divergence, with DataFrame functions only.

Base counts and rule: see :func:`features` and ``base_failed``.  The method: a
document's histogram over character classes and its histogram over common
words are compared with its language's references by Jensen-Shannon distance
(base 2, 0 to 1).  A document fails if a distance is over its limit, and only
if it is long enough for that histogram (``min_chars``, ``min_words``).

References are built from the whole corpus: common words are the ``COMMON`` most
frequent words of at most ``WORD_LENGTH`` characters of a language (function
words are short, and so few that they are counted exactly); a reference sums
the histograms of the language's documents that pass the base rule.

The limit of characters is fixed.  That of words comes from the reference itself, as short texts stray further:
among a language's documents of one length class (powers of two) that pass the base rule, the median distance plus
``SPREADS`` times its gap to the lower quartile.  Both say nothing of the upper half, so documents that do diverge don't
lift their own limit.  A class of under ``ENOUGH`` documents takes the limit of the next shorter one that has enough.

Defined cases: a NULL or blank text has zero counts and fails the base rule;
each row is judged alone, also with a repeated or NULL doc_id; a language
without any passing document has no reference, and its documents pass the
method; NULL languages (and the empty one) share a reference; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqlens.llm.common import documents, load, staged, word_array

MIN_WORDS = 50
MIN_CHARS = 200
CHAR_LIMIT = 0.25
SPREADS = 5
ENOUGH = 20
COMMON = 16
WORD_LENGTH = 4
#: Distances are told apart by thousandths; a gap is so many at least.
LEAST_GAP = 20
REPEAT_WINDOW = 5
#: Words below which a document fails, and the percentage of repeated words above which it does.
LEAST_WORDS = 10
MOST_REPEATED = 20
POOLED = ""

#: Character classes of the histogram (a character is in one class; all others are the last class).
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PUNCTUATION = ".,;:!?'\"()-"
SPACES = " \t\n\x0b\x0c\r"


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _repeated(hashes: Column, k: int = REPEAT_WINDOW) -> Column:
    """Words in windows of ``k`` words that come up twice or more in the text, from the words' hashes.

    Sorted windows stand beside their equals; their places, sorted again, each
    cover what the next one doesn't.  Most texts repeat none and stop before that.
    """
    windows = hashes
    for j in range(1, k):  # a hash over one more word each time; the shorter side ends it
        windows = F.zip_with(F.slice(windows, 1, F.greatest(F.size(hashes) - j, F.lit(0))), F.slice(hashes, j + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))
    placed = lambda w: F.sort_array(F.transform(w, lambda h, i: F.named_struct(F.lit("h"), h, F.lit("i"), i)))
    doubled = lambda s: F.sort_array(
        F.transform(
            F.filter(s, lambda x, n: (F.get(s, n - 1)["h"] == x["h"]) | (F.get(s, n + 1)["h"] == x["h"])),
            lambda x: x["i"],
        )
    )
    covered = lambda p: F.aggregate(
        F.transform(p, lambda x, n: F.least(F.lit(k), F.coalesce(F.get(p, n + 1) - x, F.lit(k)))), F.lit(0), lambda a, x: a + x
    )
    # one-element arrays: each step is made once, and read by the next
    held = F.transform(F.array(windows), lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), F.transform(F.transform(F.array(placed(w)), lambda s: doubled(s)), lambda p: covered(p))[0]))
    return F.when(F.size(hashes) > k, F.coalesce(held[0], F.lit(0))).otherwise(F.lit(0)).cast("long")


def common_words(docs: DataFrame, k: int = COMMON) -> DataFrame:
    """key, common: each language's most frequent short words (those without a language under ``POOLED``)."""
    short = F.transform(F.filter(word_array(F.col("text")), lambda w: F.length(w) <= WORD_LENGTH), lambda w: F.lower(w))
    counted = docs.select("key", F.explode(short).alias("word")).groupBy("key", "word").agg(F.count(F.lit(1)).alias("n"))
    top = counted.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= k)
    return top.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("common"))


def features(docs: DataFrame, common: DataFrame) -> DataFrame:
    """Base counts and both histograms of every row (doc_id, text, key)."""
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "key").join(common, "key", "left")
    # exploding one array holds it, so that no expression below splits the text again
    worded = known.select(
        "*",
        # all but lower-case, white space and beyond ASCII: little is left, and the classes are counted in that
        F.regexp_replace("text", r"[^\x21-\x60\x7B-\x7F]+", "").alias("rest"),
        F.explode(F.array(word_array(F.col("text")))).alias("words"),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    short = F.transform(F.filter("words", lambda w: F.length(w) <= WORD_LENGTH), lambda w: F.lower(w))
    counted = worded.select(
        "doc_id",
        "key",
        "common",
        F.size("words").cast("long").alias("n_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(F.col("rest"), SYMBOLS).alias("n_symbols"),
        _count(F.col("rest"), UPPER).alias("upper"),
        _count(F.col("rest"), DIGITS).alias("digits"),
        _count(F.col("rest"), PUNCTUATION).alias("marks"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        F.transform(F.array(F.transform("words", lambda w: F.xxhash64(w))), lambda h: _repeated(h))[0].alias("n_repeat_words"),
        F.explode(F.array(F.coalesce(F.filter(short, lambda w: F.array_contains("common", w)), F.array().cast("array<string>")))).alias("frequent"),
    )
    spaces = F.col("n_chars") - F.col("word_chars")
    rest = F.col("word_chars") - F.col("upper") - F.col("digits") - F.col("marks") - F.col("n_symbols")
    of_each = F.transform("common", lambda c: F.size(F.filter("frequent", lambda w: w == c)).cast("long"))
    return counted.select(
        "doc_id",
        "key",
        "n_words",
        "n_chars",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).alias("base_failed"),
        F.array("upper", "digits", "marks", "n_symbols", spaces, rest).alias("chars"),
        F.concat(of_each, F.array(F.col("n_words") - F.size("frequent"))).alias("common"),
    )


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts, base 2 (0 if either is empty)."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    pairs = lambda a, b: F.zip_with(a, b, lambda x, y: F.struct((x / F.nullif(total(a), F.lit(0.0))).alias("p"), (y / F.nullif(total(b), F.lit(0.0))).alias("q")))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.transform(pairs(p, q), lambda x: (part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2)) / 2)
    # zip_with pads the shorter side with NULL: both sides always have the same bins here
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def word_limits(measured: DataFrame, spreads: int = SPREADS, enough: int = ENOUGH) -> DataFrame:
    """key, limits: (length class, limit in thousandths) of each class with enough documents, ascending.

    ``measured``: key, size (length class) and d (distance in thousandths) of the reference's documents.
    """
    counts = measured.groupBy("key", "size", "d").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("key", "size")  # a row per distance: 1,001 at most
    summed = counts.select("*", F.sum("n").over(of.orderBy("d")).alias("upto"), F.sum("n").over(of).alias("total"))
    at = lambda part: F.min(F.when(part * F.col("upto") >= F.col("total"), F.col("d")))
    marks = summed.groupBy("key", "size").agg(at(2).alias("median"), at(4).alias("lower"), F.max("total").alias("total"))
    limit = F.col("median") + spreads * F.greatest(F.col("median") - F.col("lower"), F.lit(LEAST_GAP))
    kept = marks.where(F.col("total") >= enough).select("key", F.struct("size", limit.alias("limit")).alias("x"))
    return kept.groupBy("key").agg(F.sort_array(F.collect_list("x")).alias("limits"))


def judge(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
    char_limit: float = CHAR_LIMIT,
    spreads: int = SPREADS,
) -> DataFrame:
    """Base counts, char_distance, word_distance, word_limit, base_failed and kept of every row."""
    rows = documents(docs, "lang").withColumn("key", F.coalesce(F.col("lang").cast("string"), F.lit(POOLED))).drop("lang")
    # the tables of languages are staged, so that Spark knows their size and joins them as it allows
    counted = staged(features(rows, staged(common_words(rows))))  # read for the references, the limits and the verdicts
    bins = {"chars": 6, "common": COMMON + 1}
    sums = [F.sum(F.get(c, F.lit(i))).cast("double").alias(f"{c}{i}") for c, n in bins.items() for i in range(n)]
    named = [F.filter(F.array(*[f"{c}{i}" for i in range(n)]), lambda x: x.isNotNull()).alias(f"ref_{c}") for c, n in bins.items()]
    references = staged(counted.where("NOT base_failed").groupBy("key").agg(*sums).select("key", *named))
    measured = counted.join(references, "key", "left").withColumns(
        {
            "char_distance": _distance(F.col("chars").cast("array<double>"), F.col("ref_chars")),
            "word_distance": _distance(F.col("common").cast("array<double>"), F.col("ref_common")),
            "size": F.length(F.bin("n_words")),
        }
    ).withColumn("d", F.floor(F.col("word_distance") * 1000))
    usual = measured.where(~F.col("base_failed") & (F.col("n_words") >= min_words))
    limits = staged(word_limits(usual.select("key", "size", "d"), spreads))
    reached = F.filter("limits", lambda x: x["size"] <= F.col("size"))
    judged = measured.join(limits, "key", "left").withColumn("word_limit", F.get(reached, F.size(reached) - 1)["limit"])
    odd = ((F.col("n_chars") >= min_chars) & (F.col("char_distance") > char_limit)) | (
        (F.col("n_words") >= min_words) & F.coalesce(F.col("d") > F.col("word_limit"), F.lit(False))
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id", *counts, "char_distance", "word_distance", (F.col("word_limit") / 1000).alias("word_limit"), "base_failed",
        (~F.col("base_failed") & ~F.coalesce(odd, F.lit(False))).alias("kept"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "documents")).drop("char_distance", "word_distance", "word_limit")
