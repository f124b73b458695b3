"""The whole quality profile from three scans, in parts that add up.

The checks of :mod:`reqlens.operators.quality` are declared here once more by what they need, and compiled to

* **scalars**: one aggregate of every count, minimum and maximum (one row);
* **groups**: one ``GROUPING SETS`` aggregate over status, region, category and (handler, handler name), with
  every conditional count that any check asks for (a row per key value);
* **rows**: one filter that keeps each row some listing wants, tagged with the listings it belongs to;
* **prints**: one ``GROUPING SETS`` aggregate over row fingerprints and keys, for duplicates.

Scalars are observed by the write of the tagged rows, so that is three scans of the table instead of one per check.  All four
parts *merge*: parts of two sets of rows, put together, are the parts of both (counts add up, bounds of
bounds are bounds).  So the parts of arriving batches are stored and read as one
(:mod:`reqlens.streaming.partials`), and :func:`checks` makes every check's result from them, the same as from the table.

Fingerprints here are 128 bits of values and NULL positions and stand for the row; the check over a whole table
(:func:`reqlens.operators.quality.full_row_duplicates`) compares the rows themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqlens.functions.exact import share_pct
from reqlens.operators import quality as Q
from reqlens.roles import DEFAULT_ROLES, PLACEHOLDER_TOKENS, RAW_DATE_PATTERN, Roles, with_optional

PARTS = ("scalars", "groups", "rows", "prints")


@dataclass(frozen=True)
class Layout:
    """What the parts of one table mean: its columns and roles."""

    fields: tuple[tuple[str, str], ...]
    roles: Roles = DEFAULT_ROLES
    pattern: str = RAW_DATE_PATTERN
    tokens: tuple[str, ...] = PLACEHOLDER_TOKENS
    kinds: dict[str, str] = field(default_factory=dict, compare=False)

    @staticmethod
    def of(df: DataFrame, roles: Roles = DEFAULT_ROLES, pattern: str = RAW_DATE_PATTERN) -> Layout:
        full = _full(df, roles)
        return Layout(tuple(df.dtypes), roles, pattern, kinds=dict(full.dtypes))

    def empty(self, spark: SparkSession) -> DataFrame:
        """No rows, all columns."""
        return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in self.kinds.items()])

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in self.fields]


def _full(df: DataFrame, roles: Roles) -> DataFrame:
    return with_optional(
        df, *roles.date_columns, *roles.location_columns, roles.handler_name, *roles.profiled_placeholders
    )


@dataclass(frozen=True)
class _Scalar:
    value: Column
    merge: Callable[[str], Column]


def _scalars(df: DataFrame, at: Layout) -> dict[str, _Scalar]:
    r = at.roles
    time = {c: Q._as_time(df, c, at.pattern) for c in r.date_columns}
    count = lambda cond: _Scalar(F.count_if(cond), F.sum)
    closed_there = F.col(r.closed).isNotNull()
    wrong = time[r.created] > time[r.closed]
    out = {
        "row_count": _Scalar(F.count(F.lit(1)), F.sum),
        "earliest": _Scalar(F.min(time[r.created]), F.min),
        "latest": _Scalar(F.max(time[r.created]), F.max),
        **{f"unparseable_{i}": count(F.col(c).isNotNull() & time[c].isNull()) for i, c in enumerate(r.date_columns)},
        **{f"missing_{i}": count(Q._is_missing(df.schema[c])) for i, c in enumerate(at.columns)},
        **{f"token_{i}_{j}": count(F.col(c) == t) for i, c in enumerate(r.profiled_placeholders) for j, t in enumerate(at.tokens)},
        "matching_rows": count(wrong & (F.col(r.closed) == F.col(r.resolution_updated))),
        "closed_without_closed_date": count((F.col(r.status) == r.closed_status) & ~closed_there),
        "open_with_closed_date": count((F.col(r.status) != r.closed_status) & closed_there),
        "created_after_closed": count(wrong),
        "missing_zip": count(F.col(r.zip).isNull()),
        "missing_coordinates": count(Q._both_coords_missing(r)),
        "coordinate_mismatches": count(F.col(r.latitude).isNull() != F.col(r.longitude).isNull()),
        "blank_complaints": count(Q._is_blank(r.category)),
        "blank_agencies": count(Q._is_blank(r.handler)),
        "unspecified_region": count(F.col(r.region) == r.unspecified_region),
    }
    return out


MEASURES = ("n", "missing_closed", "open_closed", "wrong_order", "missing_zip", "missing_coords")
_SETS = ("status", "region", "category", "handler")


def group_counts(df: DataFrame, at: Layout) -> DataFrame:
    """``kind, key, name`` and the measures, for each value of status, region, category and (handler, handler name)."""
    r, full = at.roles, _full(df, at.roles)
    flags = {
        "missing_closed": F.col(r.closed).isNull(),
        "open_closed": (F.col(r.status) != r.closed_status) & F.col(r.closed).isNotNull(),
        "wrong_order": Q._as_time(full, r.created, at.pattern) > Q._as_time(full, r.closed, at.pattern),
        "missing_zip": F.col(r.zip).isNull(),
        "missing_coords": Q._both_coords_missing(r),
    }
    keys = {"_status": r.status, "_region": r.region, "_category": r.category, "_handler": r.handler, "_name": r.handler_name}
    slim = full.select(*[F.col(c).cast("string").alias(k) for k, c in keys.items()], *[f.alias(m) for m, f in flags.items()])
    sets = [["_status"], ["_region"], ["_category"], ["_handler", "_name"]]
    grouped = slim.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        *[F.grouping(s[0]).alias(f"_not{i}") for i, s in enumerate(sets)],
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(m)).alias(m) for m in flags],
    )
    pick = lambda values: F.coalesce(*[F.when(F.col(f"_not{i}") == 0, v) for i, v in enumerate(values)])
    return grouped.select(pick(map(F.lit, _SETS)).alias("kind"), pick([F.col(s[0]) for s in sets]).alias("key"), F.col("_name").alias("name"), *MEASURES)


def _listings(df: DataFrame, at: Layout) -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Listing -> (which rows, which columns)."""
    r = at.roles
    wrong = Q._as_time(df, r.created, at.pattern) > Q._as_time(df, r.closed, at.pattern)
    status, place = r.status_check_columns, r.location_columns
    return {
        "closed_missing_closed_date": ((F.col(r.status) == r.closed_status) & F.col(r.closed).isNull(), status),
        "non_closed_with_closed_date": ((F.col(r.status) != r.closed_status) & F.col(r.closed).isNotNull(), status),
        "invalid_date_rows": (wrong, status),
        "invalid_date_details": (wrong, (r.key, r.created, r.closed, r.resolution_updated, r.handler, r.category, r.status, r.region)),
        "unspecified_borough_rows": (F.col(r.region) == r.unspecified_region, place),
        "missing_coord_rows": (Q._both_coords_missing(r), (r.key, r.region, *place)),
        "coord_mismatch_rows": (F.col(r.latitude).isNull() != F.col(r.longitude).isNull(), (r.key, r.region, r.zip, r.latitude, r.longitude, r.location)),
        "blank_complaints": (Q._is_blank(r.category), r.core_fields),
        "blank_agencies": (Q._is_blank(r.handler), r.core_fields),
    }


def tagged_rows(df: DataFrame, at: Layout) -> DataFrame:
    """``tags`` and the listed columns of every row that some listing wants; ``df`` must be :func:`_full`."""
    wanted = _listings(df, at)
    columns = list(dict.fromkeys(c for _, of in wanted.values() for c in of))
    tags = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, (cond, _) in wanted.items()]))
    return df.select(*columns, tags.alias("tags")).where(F.size("tags") > 0)


def row_prints(df: DataFrame, at: Layout) -> DataFrame:
    """``kind, a, b, key, n``: rows of each 128-bit row fingerprint (a, b), and of each key."""
    parts = [x for c in at.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    stamped = df.select(
        F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"), F.col(at.roles.key).cast("string").alias("key")
    )
    grouped = stamped.groupingSets([["a", "b"], ["key"]], "a", "b", "key").agg(F.grouping("a").alias("_key"), F.count(F.lit(1)).alias("n"))
    return grouped.select(F.when(F.col("_key") == 1, "key").otherwise("row").alias("kind"), "a", "b", "key", "n")


def write_parts(df: DataFrame, at: Layout, write: Callable[[str, DataFrame], None]) -> None:
    """Compute the parts of ``df`` and hand each to ``write(name, part)``: three scans."""
    spark, full = df.sparkSession, _full(df, at.roles)
    values = _scalars(full, at)
    seen = Observation(f"profile-{uuid.uuid4().hex[:12]}")
    write("rows", tagged_rows(full.observe(seen, *[v.value.alias(k) for k, v in values.items()]), at))
    kinds = full.agg(*[v.value.alias(k) for k, v in values.items()]).schema  # analysed, not run
    got = seen.get
    write("scalars", spark.createDataFrame([tuple(got[k] for k in values)], T.StructType([T.StructField(f.name, f.dataType) for f in kinds])))
    write("groups", group_counts(df, at))
    write("prints", row_prints(df, at))


def merged(parts: dict[str, DataFrame], at: Layout) -> dict[str, DataFrame]:
    """Stored parts of any number of batches as the parts of all their rows."""
    values = _scalars(at.empty(parts["scalars"].sparkSession), at)
    return {
        "scalars": parts["scalars"].agg(*[v.merge(k).alias(k) for k, v in values.items()]),
        "groups": parts["groups"].groupBy("kind", "key", "name").agg(*[F.sum(m).alias(m) for m in MEASURES]),
        "rows": parts["rows"],
        "prints": parts["prints"].groupBy("kind", "a", "b", "key").agg(F.sum("n").alias("n")),
    }


def _unpivoted(row: DataFrame, lines: list[tuple]) -> DataFrame:
    """One row of measures as lines of (literals by name, measures by name)."""
    structs = [
        F.struct(*[F.lit(v).alias(k) for k, v in fixed.items()], *[F.coalesce(F.col(c), F.lit(0)).alias(k) for k, c in from_row.items()])
        for fixed, from_row in lines
    ]
    return row.select(F.inline(F.array(*structs)))


def checks(parts: dict[str, DataFrame], at: Layout) -> dict[str, DataFrame]:
    """Every check of the profile, by name, from merged parts."""
    r, one, groups, rows, prints = at.roles, parts["scalars"], parts["groups"], parts["rows"], parts["prints"]
    kind = lambda c: at.kinds[c]
    n = F.coalesce(F.col("row_count"), F.lit(0))

    def ranked(which: str, column: str, measure: str = "n", name: str = Q.COUNT) -> DataFrame:
        of = groups.where((F.col("kind") == which) & (F.col(measure) > 0)).groupBy(F.col("key").cast(kind(column)).alias(column))
        return of.agg(F.sum(measure).alias(name)).orderBy(F.desc(name), F.asc_nulls_first(column))

    def missing(columns: list[str]) -> DataFrame:
        lines = [({"column_name": c, "column_position": i + 1}, {"missing_count": f"missing_{at.columns.index(c)}", "_rows": "row_count"}) for i, c in enumerate(columns)]
        share = share_pct(F.col("missing_count"), F.col("_rows"))
        return _unpivoted(one, lines).select("column_name", "column_position", "missing_count", share.alias("missing_percentage")).orderBy("column_position")

    tokens = [(c, t, f"token_{i}_{j}") for i, c in enumerate(r.profiled_placeholders) for j, t in enumerate(at.tokens)]
    seen = _unpivoted(one, [({"column_name": c, "placeholder_value": t}, {"placeholder_count": m}) for c, t, m in tokens])
    totals = seen.groupBy("column_name").agg(F.sum("placeholder_count").alias("total_placeholders"))
    handlers = groups.where("kind = 'handler'").select(
        F.col("key").cast(kind(r.handler)).alias(r.handler), F.col("name").cast(kind(r.handler_name)).alias(r.handler_name), F.col("n").alias(Q.COUNT)
    )
    spellings = groups.where("kind = 'category' AND key IS NOT NULL").groupBy(
        F.lower(F.trim("key")).alias("normalized_complaint"), F.col("key").cast(kind(r.category)).alias("complaint_variant")
    ).agg(F.sum("n").alias(Q.COUNT))
    distinct = lambda which, name: groups.where((F.col("kind") == which) & F.col("key").isNotNull()).agg(F.count_distinct("key").alias(name))
    repeats = lambda which, name: prints.where(F.col("kind") == which).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias(name))
    listed = {
        name: rows.where(F.array_contains("tags", name)).select(*columns)
        for name, (_, columns) in _listings(at.empty(rows.sparkSession), at).items()
    }
    headline = ("closed_without_closed_date", "open_with_closed_date", "created_after_closed", "missing_zip", "missing_coordinates",
                "coordinate_mismatches", "blank_complaints", "blank_agencies", "unspecified_region")
    return {
        "structure_profile": one.select(n.alias("row_count"), F.lit(len(at.columns)).alias("column_count")),
        "date_range": one.select(F.col("earliest").alias("earliest_date"), F.col("latest").alias("latest_date"), F.coalesce("unparseable_0", F.lit(0)).alias("unparseable_dates")),
        "unparseable_dates": _unpivoted(one, [({"column_name": c}, {"unparseable_count": f"unparseable_{i}"}) for i, c in enumerate(r.date_columns)]),
        "missing_profile": missing(at.columns),
        "core_completeness": missing([c for c in r.core_fields]),
        "placeholder_counts": seen.where("placeholder_count > 0").orderBy("column_name", F.desc("placeholder_count"), "placeholder_value"),
        "placeholder_totals": totals.orderBy(F.desc("total_placeholders"), "column_name"),
        "full_row_duplicates": repeats("row", "duplicate_rows"),
        "duplicate_keys": repeats("key", "duplicate_keys"),
        "status_counts": ranked("status", r.status),
        "missing_closed_by_status": ranked("status", r.status, "missing_closed", "missing_closed_count"),
        "non_closed_closed_by_status": ranked("status", r.status, "open_closed"),
        "invalid_date_by_status": ranked("status", r.status, "wrong_order"),
        "invalid_date_matching_resolution": one.select(F.coalesce("matching_rows", F.lit(0)).alias("matching_rows")),
        "borough_counts": ranked("region", r.region),
        "missing_zip_count": one.select(F.coalesce("missing_zip", F.lit(0)).alias("missing_zip_count")),
        "missing_zip_by_borough": ranked("region", r.region, "missing_zip", "missing_zip_count"),
        "missing_coords_by_borough": ranked("region", r.region, "missing_coords"),
        "distinct_complaints": distinct("category", "distinct_complaint_count"),
        "complaint_ranking": ranked("category", r.category),
        "distinct_agencies": distinct("handler", "distinct_agency_count"),
        "agency_ranking": ranked("handler", r.handler),
        "agency_name_consistency": Q._variants(handlers.where(F.col(r.handler_name).isNotNull()), r.handler, "distinct_agency_names")
        .select(r.handler, r.handler_name, Q.COUNT, "distinct_agency_names")
        .orderBy(F.asc_nulls_first(r.handler), r.handler_name),
        "complaint_case_variants": Q._variants(spellings, "normalized_complaint", "variant_count")
        .select("normalized_complaint", "complaint_variant", Q.COUNT, "variant_count")
        .orderBy("normalized_complaint", "complaint_variant"),
        "quality_counts": one.select(n.alias("row_count"), *[F.coalesce(c, F.lit(0)).alias(c) for c in headline]),
        **listed,
    }


def fused_profile(spark: SparkSession, df: DataFrame, out_dir: str, roles: Roles = DEFAULT_ROLES) -> dict[str, DataFrame]:
    """Every check of the profile of ``df``: three scans of it, whose parts are written under ``out_dir``."""
    at, out_dir = Layout.of(df, roles), out_dir.rstrip("/")

    def write(name: str, part: DataFrame) -> None:
        part.write.mode("overwrite").parquet(f"{out_dir}/{name}")

    write_parts(df, at, write)
    return checks(merged({name: spark.read.parquet(f"{out_dir}/{name}") for name in PARTS}, at), at)


__all__ = ["PARTS", "Layout", "checks", "fused_profile", "merged", "write_parts"]
