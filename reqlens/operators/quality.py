"""Data-quality profile of the raw table (each check returns a DataFrame).

Counting checks that share a scan are fused into one aggregate
(:func:`quality_counts`, :func:`missing_profile`, :func:`placeholder_counts`):
one pass, column-pruned, partially aggregated per task.  Grouped checks are a
single hash aggregate each.  Row listings are filters + projections and stay
distributed; nothing is collected here.

Dates are inspected as raw text (as exported); the checks that compare dates
parse them with :func:`reqlens.functions.parse_timestamp`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqlens.functions.dates import parse_timestamp
from reqlens.functions.exact import share_pct
from reqlens.roles import DEFAULT_ROLES, PLACEHOLDER_TOKENS, RAW_DATE_PATTERN, Roles, with_optional

COUNT = "request_count"


def _is_blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def _is_missing(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return _is_blank(field.name)
    return F.col(field.name).isNull()


def _count_by(df: DataFrame, key: str, name: str = COUNT) -> DataFrame:
    """``groupBy(key).count()`` descending, NULL key kept as a group, ties by key."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc_nulls_first(key))
    )


def _as_time(df: DataFrame, c: str, pattern: str) -> Column:
    """A date column as a timestamp: raw text is parsed, typed columns pass through."""
    if dict(df.dtypes)[c] != "string":
        return F.col(c)
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone", None)
    return parse_timestamp(F.col(c), pattern, zone)


# --- structure -------------------------------------------------------------


def structure_profile(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``row_count, column_count`` (schema: ``df.schema``)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """``column_position, column_name, data_type, nullable`` of the frame (metadata, no data is read)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "column_position int, column_name string, data_type string, nullable boolean"
    )


def date_range(df: DataFrame, pattern: str = RAW_DATE_PATTERN, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Earliest and latest parseable created time, plus how many did not parse."""
    created = _as_time(df, roles.created, pattern)
    return df.select(created.alias("_c"), F.col(roles.created).isNotNull().alias("_present")).agg(
        F.min("_c").alias("earliest_date"),
        F.max("_c").alias("latest_date"),
        F.count_if(F.col("_present") & F.col("_c").isNull()).alias("unparseable_dates"),
    )


def unparseable_dates(df: DataFrame, pattern: str = RAW_DATE_PATTERN, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``column_name, unparseable_count`` of every date column: texts that cleaning turns into NULL."""
    df = with_optional(df, *roles.date_columns)
    bad = {c: F.col(c).isNotNull() & _as_time(df, c, pattern).isNull() for c in roles.date_columns}
    row = df.agg(*[F.count_if(b).alias(f"d{i}") for i, b in enumerate(bad.values())])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("unparseable_count")) for i, c in enumerate(bad)]
    return row.select(F.inline(F.array(*pairs)))


# --- completeness ----------------------------------------------------------


def missing_profile(
    df: DataFrame, columns: Iterable[str] | None = None, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Per column: ``missing_count`` and ``missing_percentage`` of all rows.

    Text is missing when NULL or blank after trimming spaces; other types only
    when NULL (NaN is a value).  One aggregate over the table, then an
    ``unpivot`` of that single row.  An empty table gives NULL percentages.
    """
    wanted = list(columns) if columns is not None else df.columns
    fields = [f for f in df.schema.fields if f.name in set(wanted)]
    aliases = {f.name: f"m{i}" for i, f in enumerate(fields)}
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_is_missing(f)).alias(aliases[f.name]) for f in fields],
    )
    long = counts.unpivot("_rows", list(aliases.values()), "_alias", "missing_count")
    names = F.create_map(*[F.lit(x) for a, n in ((aliases[f.name], f.name) for f in fields) for x in (a, n)])
    order = F.create_map(*[F.lit(x) for i, f in enumerate(fields) for x in (aliases[f.name], i + 1)])
    return long.select(
        F.element_at(names, F.col("_alias")).alias("column_name"),
        F.element_at(order, F.col("_alias")).alias("column_position"),
        "missing_count",
        share_pct(F.col("missing_count"), F.col("_rows")).alias("missing_percentage"),
    ).orderBy("column_position")


def core_completeness(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """:func:`missing_profile` restricted to the core fields, all of them required."""
    return missing_profile(df.select(*roles.core_fields))


def placeholder_counts(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    tokens: Iterable[str] = PLACEHOLDER_TOKENS,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """``column_name, placeholder_value, placeholder_count`` for every token seen (exact match).

    One aggregate of ``columns x tokens`` conditional counts, unpivoted; no
    shuffle of the table and no per-column jobs.
    """
    cols = list(columns if columns is not None else roles.profiled_placeholders)
    df = with_optional(df, *cols)
    tokens = list(tokens)
    pairs = [(c, t) for c in cols for t in tokens]
    aliases = [f"p{i}" for i in range(len(pairs))]
    row = df.agg(*[F.count_if(F.col(c) == t).alias(a) for (c, t), a in zip(pairs, aliases)])
    long = row.withColumn("_one", F.lit(1)).unpivot("_one", aliases, "_alias", "placeholder_count")
    col_of = F.create_map(*[F.lit(x) for (c, _), a in zip(pairs, aliases) for x in (a, c)])
    tok_of = F.create_map(*[F.lit(x) for (_, t), a in zip(pairs, aliases) for x in (a, t)])
    return (
        long.where(F.col("placeholder_count") > 0)
        .select(
            F.element_at(col_of, F.col("_alias")).alias("column_name"),
            F.element_at(tok_of, F.col("_alias")).alias("placeholder_value"),
            "placeholder_count",
        )
        .orderBy("column_name", F.desc("placeholder_count"), "placeholder_value")
    )


def placeholder_totals(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    tokens: Iterable[str] = PLACEHOLDER_TOKENS,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """``column_name, total_placeholders`` for every inspected column (0 when none)."""
    cols = list(columns if columns is not None else roles.profiled_placeholders)
    df = with_optional(df, *cols)
    tokens = list(tokens)
    aliases = [f"t{i}" for i in range(len(cols))]
    row = df.agg(*[F.count_if(F.col(c).isin(tokens)).alias(a) for c, a in zip(cols, aliases)])
    long = row.withColumn("_one", F.lit(1)).unpivot("_one", aliases, "_alias", "total_placeholders")
    col_of = F.create_map(*[F.lit(x) for c, a in zip(cols, aliases) for x in (a, c)])
    return long.select(
        F.element_at(col_of, F.col("_alias")).alias("column_name"), "total_placeholders"
    ).orderBy(F.desc("total_placeholders"), "column_name")


# --- duplicates ------------------------------------------------------------


def full_row_duplicates(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``duplicate_rows``: rows beyond the first of each identical-row group (NULLs compare equal).

    Grouping by every column would shuffle the whole table at full width.
    Instead rows are counted per 64-bit fingerprint (values and NULL
    positions), only rows whose fingerprint repeats are kept, and those alone
    are grouped by every column, so the count is exact whatever the
    fingerprints.  One lazy plan: the optimizer picks the join from the
    measured size of the repeated fingerprints.
    """
    cols = df.columns
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    stamped = df.select(*cols, F.xxhash64(*parts).alias("_fp"))
    repeated = stamped.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_fp")
    groups = stamped.join(repeated, "_fp", "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``duplicate_keys``: rows beyond the first per key value (NULL key is one group)."""
    groups = df.groupBy(roles.key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_keys"))


# --- status ----------------------------------------------------------------


def status_counts(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(df, roles.status)


def missing_closed_by_status(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(df.where(F.col(roles.closed).isNull()), roles.status, "missing_closed_count")


def closed_missing_closed_date(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Closed requests without a closed time."""
    cond = (F.col(roles.status) == roles.closed_status) & F.col(roles.closed).isNull()
    return df.where(cond).select(*roles.status_check_columns)


def non_closed_with_closed_date(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Requests not Closed (NULL status excluded) that carry a closed time."""
    cond = (F.col(roles.status) != roles.closed_status) & F.col(roles.closed).isNotNull()
    return df.where(cond).select(*roles.status_check_columns)


def non_closed_closed_by_status(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(non_closed_with_closed_date(df, roles), roles.status)


def _invalid_order(df: DataFrame, pattern: str, roles: Roles) -> DataFrame:
    return df.where(_as_time(df, roles.created, pattern) > _as_time(df, roles.closed, pattern))


def invalid_date_rows(df: DataFrame, pattern: str = RAW_DATE_PATTERN, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Rows whose parsed created time is after the parsed closed time (NULL either side excluded)."""
    return _invalid_order(df, pattern, roles).select(*roles.status_check_columns)


def invalid_date_by_status(df: DataFrame, pattern: str = RAW_DATE_PATTERN, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(_invalid_order(df, pattern, roles), roles.status)


def invalid_date_matching_resolution(
    df: DataFrame, pattern: str = RAW_DATE_PATTERN, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Of the invalid-order rows, how many have closed == resolution-updated (raw values)."""
    bad = _invalid_order(with_optional(df, roles.resolution_updated), pattern, roles)
    return bad.agg(F.count_if(F.col(roles.closed) == F.col(roles.resolution_updated)).alias("matching_rows"))


def invalid_date_details(df: DataFrame, pattern: str = RAW_DATE_PATTERN, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    cols = (roles.key, roles.created, roles.closed, roles.resolution_updated, roles.handler, roles.category,
            roles.status, roles.region)
    return _invalid_order(with_optional(df, roles.resolution_updated), pattern, roles).select(*cols)


# --- geography -------------------------------------------------------------


def region_counts(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(df, roles.region)


def missing_zip_count(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return with_optional(df, roles.zip).agg(F.count_if(F.col(roles.zip).isNull()).alias("missing_zip_count"))


def missing_zip_by_region(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(with_optional(df, roles.zip).where(F.col(roles.zip).isNull()), roles.region, "missing_zip_count")


def unspecified_region_rows(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Location columns of rows whose region is the ``Unspecified`` sentinel."""
    return (
        with_optional(df, *roles.location_columns)
        .where(F.col(roles.region) == roles.unspecified_region)
        .select(*roles.location_columns)
    )


def _both_coords_missing(roles: Roles) -> Column:
    return F.col(roles.latitude).isNull() & F.col(roles.longitude).isNull()


def missing_coords_by_region(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    df = with_optional(df, roles.latitude, roles.longitude)
    return _count_by(df.where(_both_coords_missing(roles)), roles.region)


def missing_coord_rows(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    cols = (roles.key, roles.region, roles.zip, roles.city, roles.address, roles.latitude, roles.longitude,
            roles.location)
    return with_optional(df, *roles.location_columns).where(_both_coords_missing(roles)).select(*cols)


def coord_mismatch_rows(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Exactly one of latitude / longitude missing."""
    cond = F.col(roles.latitude).isNull() != F.col(roles.longitude).isNull()
    cols = (roles.key, roles.region, roles.zip, roles.latitude, roles.longitude, roles.location)
    return with_optional(df, *roles.location_columns).where(cond).select(*cols)


# --- categories and handlers ----------------------------------------------


def distinct_categories(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.agg(F.count_distinct(roles.category).alias("distinct_complaint_count"))


def category_ranking(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(df, roles.category)


def blank_categories(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.where(_is_blank(roles.category)).select(*roles.core_fields)


def distinct_handlers(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.agg(F.count_distinct(roles.handler).alias("distinct_agency_count"))


def handler_ranking(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return _count_by(df, roles.handler)


def blank_handlers(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.where(_is_blank(roles.handler)).select(*roles.core_fields)


def _variants(pairs: DataFrame, key: str, n_name: str) -> DataFrame:
    """Rows of ``pairs`` (distinct key/value, aggregated) whose key has more than one value.

    Keys are counted by a second aggregate and joined back, so a key with
    very many values is never gathered in one task.
    """
    several = pairs.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(n_name)).where(F.col(n_name) > 1)
    return pairs.join(several, pairs[key].eqNullSafe(several["_key"])).drop("_key")


def handler_name_consistency(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``agency, agency_name, distinct_agency_names`` for handlers with several names.

    One row per (handler, name) rather than an array per handler; NULL names
    are ignored, a NULL handler is a group.
    """
    pairs = (
        with_optional(df, roles.handler_name)
        .where(F.col(roles.handler_name).isNotNull())
        .groupBy(roles.handler, roles.handler_name)
        .agg(F.count(F.lit(1)).alias(COUNT))
    )
    return _variants(pairs, roles.handler, "distinct_agency_names").select(
        roles.handler, roles.handler_name, COUNT, "distinct_agency_names"
    ).orderBy(F.asc_nulls_first(roles.handler), roles.handler_name)


def category_case_variants(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Spellings of one category that differ only by case / surrounding spaces.

    ``normalized_complaint, complaint_variant, request_count, variant_count``.
    """
    pairs = (
        df.where(F.col(roles.category).isNotNull())
        .groupBy(F.lower(F.trim(F.col(roles.category))).alias("normalized_complaint"),
                 F.col(roles.category).alias("complaint_variant"))
        .agg(F.count(F.lit(1)).alias(COUNT))
    )
    return _variants(pairs, "normalized_complaint", "variant_count").select(
        "normalized_complaint", "complaint_variant", COUNT, "variant_count"
    ).orderBy("normalized_complaint", "complaint_variant")


# --- fused headline counts ----------------------------------------------------


def quality_counts(df: DataFrame, pattern: str = RAW_DATE_PATTERN, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Headline counts of the profile in one scan (one row)."""
    df = with_optional(df, roles.zip, roles.latitude, roles.longitude)
    created, closed = _as_time(df, roles.created, pattern), _as_time(df, roles.closed, pattern)
    closed_present = F.col(roles.closed).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if((F.col(roles.status) == roles.closed_status) & ~closed_present).alias("closed_without_closed_date"),
        F.count_if((F.col(roles.status) != roles.closed_status) & closed_present).alias("open_with_closed_date"),
        F.count_if(created > closed).alias("created_after_closed"),
        F.count_if(F.col(roles.zip).isNull()).alias("missing_zip"),
        F.count_if(_both_coords_missing(roles)).alias("missing_coordinates"),
        F.count_if(F.col(roles.latitude).isNull() != F.col(roles.longitude).isNull()).alias("coordinate_mismatches"),
        F.count_if(_is_blank(roles.category)).alias("blank_complaints"),
        F.count_if(_is_blank(roles.handler)).alias("blank_agencies"),
        F.count_if(F.col(roles.region) == roles.unspecified_region).alias("unspecified_region"),
    )
