"""A spelling map derived from the data, with a table for review.

Spellings of one category that differ only by case or surrounding spaces belong together
(:func:`reqlens.operators.quality.category_case_variants` finds them).  The commonest one is proposed for all of
them; of equally common ones that which is not all capitals, then the first by code point.  The proposals are a table, so
someone can look at them, change some, and hand the table (or the dict that :func:`spelling_map` makes
of it) to cleaning; the gate then holds the cleaned layer to the same map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqlens.functions.exact import share_pct
from reqlens.operators.quality import COUNT
from reqlens.roles import DEFAULT_ROLES, Roles

#: Spellings that a dict of corrections may hold; more belong in a join (:func:`apply_spelling`).
MOST_IN_DICT = 10_000


def spelling_review(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``normalized_complaint, complaint_variant, request_count, variant_share, proposed_spelling, replaced`` of
    each spelling that has another one beside it; blank categories are none.

    The spellings are counted with map-side sums; a category's spellings meet as one row of bounds, never as a list.
    """
    category = F.col(roles.category)
    counts = (
        df.where(category.isNotNull() & (F.trim(category) != ""))
        .groupBy(F.lower(F.trim(category)).alias("normalized_complaint"), category.alias("complaint_variant"))
        .agg(F.count(F.lit(1)).alias(COUNT))
    )
    v = F.col("complaint_variant")
    # the least of (fewest, capitals, spelling) is the proposal
    order = F.struct((-F.col(COUNT)).alias("n"), ((v == F.upper(v)) & (v != F.lower(v))).alias("capitals"), v.alias("v"))
    of = counts.groupBy(F.col("normalized_complaint").alias("_key")).agg(
        F.min(order)["v"].alias("proposed_spelling"), F.sum(COUNT).alias("_all"), F.count(F.lit(1)).alias("_variants")
    ).where(F.col("_variants") > 1)
    return counts.join(of, F.col("normalized_complaint") == F.col("_key")).select(
        "normalized_complaint", "complaint_variant", COUNT,
        share_pct(F.col(COUNT), F.col("_all")).alias("variant_share"),
        "proposed_spelling", (v != F.col("proposed_spelling")).alias("replaced"),
    ).orderBy("normalized_complaint", F.desc(COUNT), "complaint_variant")


def spelling_map(review: DataFrame, most: int = MOST_IN_DICT) -> dict[str, str]:
    """Replaced spelling -> proposed one, for ``clean_requests(..., spelling=...)`` and the gates.

    Raises ``ValueError`` for over ``most`` corrections.
    """
    rows = review.where("replaced").select("complaint_variant", "proposed_spelling").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} corrections: use apply_spelling")
    return {r[0]: r[1] for r in rows}


def apply_spelling(df: DataFrame, review: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``df`` with each replaced spelling as the proposed one, by a join: for any number of corrections."""
    fixes = review.where("replaced").select(F.col("complaint_variant").alias("_variant"), F.col("proposed_spelling").alias("_proposed"))
    joined = df.join(fixes, df[roles.category] == fixes["_variant"], "left")
    return joined.withColumn(roles.category, F.coalesce("_proposed", F.col(roles.category))).drop("_variant", "_proposed")
