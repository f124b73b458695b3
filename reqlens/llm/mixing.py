"""Mixing sources to target weights by Sainte-Laguë apportionment.

A document's size is its number of words `[^\\x20\\x09-\\x0D]+`.  Sources, by code
point with NULL last, weigh 5, 2, 1, repeating, and share the words of the whole
corpus; a target stops at ``MOST_TIMES`` times its source's words, and the excess
goes to the others by weight (water-filling: a target is the lesser of that
stop and a level times the weight).

1. **Quotas.**  The mix is cut into blocks of ``block`` words.  Sainte-Laguë gives
   each source its number of blocks (highest quotients target / 1, 3, 5, ...), and
   again each shard of a source its share of them by the blocks that begin in it.
   Only the quotients around the last seat are ranked: two divisors bound the
   seats of all others (``_seats``).
2. **Blocks.**  A source's documents stand in a seeded order (by md5 of seed and
   doc_id, whose first digits are the shard), end to end, and every ``block`` words
   make a block.  With q seats for n blocks a shard gives each block q div n
   times, and q mod n blocks in a row from a seeded one once more.
3. **Documents** take the words of theirs that the given blocks cover.

A seat count never passes MOST_TIMES per block: targets don't, and a block gets
its next seat only after all others of the source have as many.  Shards keep the
ordering local: a source with a third of all rows is ordered in 4,096 parts.

Defined cases: a NULL or blank text has size 0 and takes 0; a NULL source is a
source (last); rows with a repeated or NULL doc_id are rows like others, ordered
by size within one md5; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqlens.llm.common import documents, load, staged, word_array

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK = 64
SEED = "mix-1"
#: Leading hexadecimal digits of the md5 that make the shard.
SHARD_DIGITS = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """source, source_size, target for every source (source, source_size)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    # a row per source from here on
    weighed = sizes.withColumn("w", F.get(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights)))
    stop = F.lit(most) * F.col("source_size")
    # a source is at its stop if the level passes stop / w: the level when exactly those below it are stopped
    by_stop = Window.orderBy(stop / F.col("w"), F.col("source").asc_nulls_last())
    everyone = Window.partitionBy(F.lit(1))
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum(stop).over(before), F.lit(0))) / (
        F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0))
    )
    found = weighed.withColumn("level", level).withColumn("free", F.col("level") <= stop / F.col("w"))
    last = found.withColumn("water", F.max(F.when(F.col("free"), F.col("level"))).over(everyone))
    return last.select("source", "source_size", F.least(stop.cast("double"), F.coalesce(F.col("water") * F.col("w"), stop.cast("double"))).alias("target"))


def _seats(rows: DataFrame, group: list[str], votes: Column, seats: Column, order: list[Column]) -> DataFrame:
    """``rows`` with ``q``, the Sainte-Laguë seats of each row in its group, which has ``seats`` in all.

    Rounding votes to a divisor gives a group of n rows its seats up to n / 2
    more or less.  So the quotients over votes / (seats - n / 2) are certain, those
    under votes / (seats + n / 2) are out, and about n between them are ranked.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    known = rows.withColumns({"_v": votes.cast("double"), "_s": seats.cast("long")}).withColumns(
        {"_sum": F.sum("_v").over(whole), "_n": F.count(F.lit(1)).over(whole)}
    )
    low = F.greatest(2 * F.col("_s") - F.col("_n") - 2, F.lit(0)) / 2
    at = lambda seats: F.floor(F.coalesce(F.col("_v") * seats / F.nullif(F.col("_sum"), F.lit(0.0)), F.lit(0.0)) + 0.5)
    bounds = known.withColumns({"_sure": at(low).cast("long"), "_most": (at(F.col("_s") + F.col("_n") / 2 + 1) + 1).cast("long")})
    bounds = bounds.withColumn("_left", F.col("_s") - F.sum("_sure").over(whole))
    tried = bounds.withColumn("_k", F.explode(F.sequence(F.col("_sure"), F.col("_most"))))  # _k = _sure: no more seats
    quotient = F.when(F.col("_k") > F.col("_sure"), F.col("_v") / (2 * F.col("_k") - 1)).otherwise(F.lit(-1.0))
    ranked = tried.withColumn("_quotient", quotient).withColumn(
        "_rank", F.row_number().over((Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))).orderBy(F.desc("_quotient"), *order, "_k"))
    )
    won = (F.col("_rank") <= F.col("_left")) & (F.col("_quotient") > 0)
    kept = [c for c in rows.columns]
    return ranked.groupBy(*kept, "_sure").agg(F.sum(won.cast("long")).alias("_more")).select(*kept, (F.col("_sure") + F.col("_more")).alias("q"))


def _overlap(lo: Column, hi: Column, begin: Column, end: Column) -> Column:
    return F.greatest(F.least(hi, end) - F.greatest(lo, begin), F.lit(0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, seed: str = SEED, most: int = MOST_TIMES) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words that the mix takes of it) of every row."""
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = staged(  # narrow, and read for the totals, the quotas and the result
        documents(docs, "source").select(
            "doc_id", F.col("source").cast("string").alias("source"), F.size(word_array(F.col("text"))).cast("long").alias("size"), hashed.alias("h")
        )
    ).withColumn("shard", F.substring("h", 1, SHARD_DIGITS))
    # <=> joins keep the NULL source; the aggregates below have a row per source, or per source and shard
    cells = rows.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    goals = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    total = Window.partitionBy(F.lit(1))
    seats = F.round(F.sum("source_size").over(total) / block)
    quotas = _seats(goals.withColumn("_seats", seats), [], F.col("target"), F.col("_seats"), [F.col("source").asc_nulls_last()])
    quotas = quotas.withColumn("q", F.least("q", most * F.ceil(F.col("source_size") / block))).withColumnRenamed("q", "quota").drop("_seats")
    in_order = Window.partitionBy("source").orderBy("shard")
    placed = cells.withColumn("begin", F.coalesce(F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # the blocks that begin in a shard: the first, and how many
    first = F.ceil(F.col("begin") / block).cast("long")
    placed = placed.withColumn("first", first).withColumn("n", F.ceil((F.col("begin") + F.col("words")) / block).cast("long") - F.col("first"))
    q = quotas.select(F.col("source").alias("s"), "source_size", "target", "quota")
    shared = placed.join(q, placed["source"].eqNullSafe(q["s"])).drop("s")
    dealt = _seats(shared, ["source"], F.col("n"), F.col("quota"), [F.col("shard")])
    each, more = F.floor(F.col("q") / F.nullif(F.col("n"), F.lit(0))), F.col("q") % F.nullif(F.col("n"), F.lit(0))
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit("")), F.lit("/"), F.col("shard")).cast("binary")), 1, 12), 16, 10).cast("long") % F.nullif(F.col("n"), F.lit(0))
    dealt = dealt.withColumns({"each": F.coalesce(each, F.lit(0)).cast("long"), "more": F.coalesce(more, F.lit(0)), "start": F.coalesce(start, F.lit(0))})
    past = F.greatest(F.col("start") + F.col("more") - F.col("n"), F.lit(0))  # chosen blocks beyond the last begin again at the first
    chosen = dealt.withColumns({"past": past, "last_times": F.when(F.col("n") > 0, F.col("each") + ((F.col("more") > 0) & (F.col("start") + F.col("more") >= F.col("n"))).cast("long"))})
    # a block that began in an earlier shard runs on into this one
    carried = F.coalesce(F.last("last_times", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = chosen.withColumn("carried", carried).select(
        F.col("source").alias("s"), F.col("shard").alias("d"), "source_size", "target", "begin", "first", "n", "each", "more", "start", "past", "carried"
    )
    before = Window.partitionBy("source", "shard").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    lined = rows.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    joined = lined.join(chosen, lined["source"].eqNullSafe(chosen["s"]) & (lined["shard"] == chosen["d"]))
    lo = F.col("begin") + F.col("offset")
    hi = lo + F.col("size")
    own = F.col("first") * block
    end = F.least(F.col("start") + F.col("more"), F.col("n"))
    taken = (
        F.col("carried") * _overlap(lo, hi, F.lit(0), own)
        + F.col("each") * F.greatest(hi - F.greatest(lo, own), F.lit(0))
        + _overlap(lo, hi, own + F.col("start") * block, own + end * block)
        + _overlap(lo, hi, own, own + F.col("past") * block)
    )
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).drop("source")
