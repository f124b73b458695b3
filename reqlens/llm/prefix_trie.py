"""Conversation prefix trie with totals of every subtree, by depth-band rollup.

A node is a distinct sequence of first d turns of a conversation; its members are the conversations that begin with it.

1. **Keys.**  A turn becomes a digest of role and text, so texts cross no shuffle.  A node's key is the
   exclusive-or of two 64-bit hashes of (place, digest) over its turns: a running window over each conversation
   gives all its prefixes' keys, and those of the ``band`` nodes above each.  Nodes, their members and smallest
   members are counts per key with map-side sums.
2. **Bands.**  Depths are cut into bands of ``band`` levels.  A node's own values go to its ancestors *within its
   band* alone, at most ``band`` rows a node, and are summed there.  Then the roots of the deepest band are complete; a round
   per band adds completed roots to the root of the band above.  At last each band root's total goes to the
   ancestors within the band above.  So a node makes 2 * ``band`` rows at most, and there are depth / ``band`` rounds;
   ``band=None`` takes the square root of the depth (4 at least), which bounds both.
3. **Ends.**  The ids of the conversations that end in a node are sorted by range over all tasks, joined to
   pieces of bounded size there, and hashed piece by piece: no task holds a node's list.

Skew: a first turn that a third of all conversations share is summed map-side; a parent with very many children meets them in
a join that Spark can split.  A conversation's own turns pass one task as a sorted stream.

Defined cases: rows with a NULL conv_id are no conversation; NULL role or text is empty; turns stand by turn (NULL
first), ties by digest of role and text; repeated rows are turns of their own; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqlens.llm.common import load, staged

#: Bytes of joined ids in one piece.
PIECE = 1 << 20
MIN_BAND = 4

_KEY = "struct<a: long, b: long>"


def _key(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _root() -> Column:
    return _key(F.lit(0).cast("long"), F.lit(0).cast("long"))


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest (hex), bytes of every turn of ``turns`` (conv_id, turn, role, text)."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.sha2(said, 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "bytes")


def grafted(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, digest, bytes), and conversations (conv_id, length), of :func:`turn_digests`.

    Conversation c gets the first h = crc32(c) mod ``most`` turns of conversation c - c mod ``family`` before
    its own turns after its first h.
    """
    sized = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % family
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    kin = Window.partitionBy("base")  # few conversations have one base
    convs = (
        sized.withColumns({"base": base, "h": h})
        .withColumn("base_n", F.coalesce(F.max(F.when(F.col("conv_id") == F.col("base"), F.col("n"))).over(kin), F.lit(0)))
        .withColumn("head", F.least("h", "base_n"))
        .select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    )
    own = turns.join(convs.select("conv_id", "h", "head"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "digest", "bytes")
    first = turns.where(F.col("pos") < most).select(F.col("conv_id").alias("base"), "pos", "digest", "bytes")
    given = first.join(convs.select("conv_id", "base", "h"), "base").where("pos <= h")
    return own.unionByName(given.select("conv_id", "pos", "digest", "bytes")), convs.select("conv_id", "length")


def _ends(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: digest of the ascending, comma-joined conv_ids of each key of ``ends`` (key, conv_id)."""

    def joined(batches):
        key, held, size, first = None, [], 0, 0
        out: list[tuple] = []

        def flush():
            if held:
                out.append((*key, first, ",".join(held)))
                held.clear()

        def made():
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            batch = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "first", "ids"])
            out.clear()
            return batch

        for batch in batches:
            for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id")), strict=True):
                if (a, b) != key or size >= PIECE:
                    flush()
                    key, size, first = (a, b), 0, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield made()
        flush()
        if out:
            yield made()

    def hashed(batches):
        key, sha = None, None

        def made(done):
            return pa.record_batch(
                [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done])],
                ["a", "b", "ends_sha256"],
            )

        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
                if (a, b) == key:
                    sha.update(b",")
                else:
                    if sha is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (a, b), hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield made(done)
        if sha is not None:
            yield made([(*key, sha.hexdigest())])

    flat = ends.select("key.a", "key.b", "conv_id")
    spread = flat.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    pieces = spread.mapInArrow(joined, "a long, b long, first long, ids string")
    met = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return met.mapInArrow(hashed, "a long, b long, ends_sha256 string").select(_key(F.col("a"), F.col("b")).alias("key"), "ends_sha256")


def _summed(rows: DataFrame, columns: list[str], by: str) -> DataFrame:
    return rows.groupBy(F.col(by).alias("key")).agg(*[F.sum(c).alias(c) for c in columns])


def rollup(nodes: DataFrame, columns: list[str], band: int, depth: int) -> DataFrame:
    """key and, for each of ``columns``, its sum over the node's subtree.

    ``nodes``: key, depth, above (keys of up to ``band`` ancestors, nearest first) and the columns.
    """
    level = F.col("depth") % band
    inside = F.concat(F.array("key"), F.slice("above", F.lit(1), level.cast("int")))
    local = _summed(nodes.select(F.explode(inside).alias("to"), *columns), columns, "to")
    heads = nodes.where((level == 0) & (F.col("depth") > 0)).select("key", "depth", "above")
    # staged: every round reads the roots, the last step all of them
    roots = staged(heads.join(local, "key"))
    whole, last = None, None  # completed roots of all bands so far, from the deepest up, and of the last one
    for number in range(depth // band, 0, -1):
        here = roots.where(F.col("depth") == number * band)
        if last is not None:
            below = _summed(last.select(F.get("above", F.lit(band - 1)).alias("to"), *columns), columns, "to")
            added = below.select("key", *[F.col(c).alias(f"_{c}") for c in columns])
            here = here.join(added, "key", "left").select(
                "key", "depth", "above", *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in columns]
            )
        last = staged(here)
        whole = last if whole is None else whole.unionByName(last)
    if whole is None:
        return local
    across = whole.select(F.explode("above").alias("to"), *columns)
    return _summed(local.withColumnRenamed("key", "to").unionByName(across), columns, "to")


def trie(turns: DataFrame, convs: DataFrame, band: int | None = None) -> DataFrame:
    """Nodes of the prefix trie of conversations ``convs`` (conv_id, length) with ``turns`` (conv_id, pos, digest, bytes).

    key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    if band is None:
        deepest = convs.agg(F.max("length").alias("d")).first()["d"] or 0
        band = max(MIN_BAND, math.isqrt(deepest) + 1)
    order = Window.partitionBy("conv_id").orderBy("pos")
    sofar, near = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(-band, -1)
    parts = turns.withColumns({s: F.xxhash64(F.lit(n), "pos", "digest") for n, s in ((1, "a"), (2, "b"))})
    keyed = parts.select("conv_id", "pos", "bytes", _key(F.bit_xor("a").over(sofar), F.bit_xor("b").over(sofar)).alias("key"))
    above = F.reverse(F.collect_list("key").over(near))  # the root too, where it is that near
    above = F.when(F.col("pos") <= band, F.concat(above, F.array(_root()))).otherwise(above)
    # staged: nodes and ends both read them
    placed = staged(keyed.withColumn("above", above))
    members = placed.select("key", F.col("pos").alias("depth"), "above", "bytes", "conv_id")
    first = convs.select(
        _root().alias("key"), F.lit(0).cast("long").alias("depth"), F.array().cast(f"array<{_KEY}>").alias("above"), F.lit(0).cast("long").alias("bytes"), "conv_id"
    )
    counted = members.unionByName(first).groupBy("key", "depth").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"), F.first("above").alias("above")
    )
    nodes = staged(counted)
    depth = nodes.agg(F.max("depth").alias("d")).first()["d"] or 0
    parent = F.get("above", F.lit(0))
    children = nodes.where("depth > 0").groupBy(parent.alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    full = staged(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    valued = full.select(
        "key", "depth", "above",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = rollup(valued, ["n_leaves", "saved_tokens"], band, depth)
    last = placed.join(convs, "conv_id").where("pos = length").select("key", "conv_id")
    ended = last.unionByName(convs.where("length = 0").select(_root().alias("key"), "conv_id"))
    named = full.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = full.join(totals, "key").join(_ends(staged(ended)), "key", "left").withColumn("parent_key", parent)
    return out.join(named, "parent_key", "left").select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    # staged: the rebuilding reads turns three times
    turns, convs = grafted(staged(turn_digests(load(spark, sf_dir, "conversations"))))
    return trie(turns, staged(convs)).drop("key")
