"""Adapter: a raw request table derived from the supplied test tables.

No request table ships with the test data, so one is derived
deterministically from ``events ⋈ customer ⋈ nation ⋈ region``: one request
per event (plus a second copy of a few, to have duplicates), with every
quality defect the pipeline handles injected by modular arithmetic on the
event / user ids.  The table looks like the raw export: dates are text in
``RAW_DATE_PATTERN``.  The same definition exists as DuckDB SQL in
:mod:`reqlens.oracle` and both engines agree on it value for value.

Joins carry no hints: the optimizer broadcasts ``nation ⋈ region`` (25 rows)
by its measured size, and ``events ⋈ customer`` is a shuffle join unless a
side proves small, with AQE's skew handling splitting a hot ``user_id``.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.functions.dates import format_raw_timestamp
from reqlens.operators.clean import parse_timestamps
from reqlens.roles import PLACEHOLDER_TOKENS, SOURCE_HEADER_ROLES
from reqlens.session import shared_folder

# Fixed values of the test tables: the event types in ``events``.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

# Upper-cased variants the adapter injects, mapped back to their spelling.
CATEGORY_SPELLING = {f"{t}-{r}".upper(): f"{t}-{r}" for t in EVENT_TYPES for r in range(3)}

RAW_COLUMNS = (
    "unique_key",
    "created_date",
    "closed_date",
    "agency",
    "complaint_type",
    "status",
    "borough",
    "agency_name",
    "resolution_updated",
    "incident_zip",
    "taxi_company_borough",
    "detail",
    "additional_details",
    "facility_type",
    "resolution_description",
    "park_facility_name",
    "location_type",
    "road_ramp",
    "bridge_highway_segment",
    "location",
    "city",
    "address",
    "latitude",
    "longitude",
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _m(c: Column, d: int) -> Column:
    return c % d


def _with_placeholders(e: Column, step: int, value: Column) -> Column:
    """``value`` with each placeholder token, blanks and NULLs on some rows."""
    out = F.when(F.lit(False), F.lit(""))
    for i, token in enumerate(PLACEHOLDER_TOKENS):
        out = out.when(_m(e, step * 7 + i) == 1, token)
    return out.when(_m(e, step + 40) == 2, " ").when(_m(e, step + 50) == 3, F.lit(None)).otherwise(value)


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    customers = customer.join(places, customer.c_nationkey == places.n_nationkey, "left").select(
        "c_custkey", "c_name", "n_name", "r_name"
    )
    # an event of an unknown user stays, without a place
    base = events.join(customers, events.user_id == customers.c_custkey, "left")

    e, u = F.col("event_id"), F.col("user_id")
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    # two copies of a few events: exact duplicates (7) and same key, other detail (9)
    copies = F.when(_m(e, 400).isin(7, 9), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = base.select("*", k.alias("k"), F.explode(copies).alias("copy_no"))

    k = F.col("k")
    ts = F.col("ts")
    closed_ts = (
        F.when(_m(k, 20).isin(0, 1, 3) | (_m(e, 997) == 5), F.lit(None))
        .when(_m(e, 211) == 0, F.timestamp_add("SECOND", F.lit(-3600), ts))
        .otherwise(F.timestamp_add("SECOND", F.floor(F.col("value") * 360), ts))
    )
    category = F.concat(F.col("event_type"), F.lit("-"), _m(k, 3).cast("string"))
    slot = _m(u, 12).cast("string")
    # each timestamp is formatted once: the texts are reused in several CASE branches below
    zone = spark.conf.get("spark.sql.session.timeZone", None)
    rows = rows.withColumn("_closed", closed_ts).withColumns(
        {
            "_ts_text": format_raw_timestamp(ts, zone),
            "_closed_text": format_raw_timestamp(F.col("_closed"), zone),
        }
    )
    fmt = {"ts": F.col("_ts_text"), "closed": F.col("_closed_text")}
    return rows.select(
        e.alias("unique_key"),
        F.when(_m(e, 701) == 3, F.lit("not a date")).otherwise(fmt["ts"]).alias("created_date"),
        fmt["closed"].alias("closed_date"),
        F.when(_m(e, 409) == 0, F.lit(None)).otherwise(F.concat(F.lit("AG"), slot)).alias("agency"),
        F.when(_m(e, 389) == 0, F.lit(None))
        .when(_m(e, 397) == 0, F.lit("  "))
        .when(_m(e, 83) == 0, F.upper(category))
        .otherwise(category)
        .alias("complaint_type"),
        F.when(_m(e, 419) == 0, F.lit(None))
        .when(_m(k, 20) == 0, "Open")
        .when(_m(k, 20) == 1, "In Progress")
        .when(_m(k, 20) == 2, "Pending")
        .when(_m(k, 20) == 3, "Assigned")
        .otherwise("Closed")
        .alias("status"),
        F.when(_m(e, 50) == 0, "Unspecified").when(_m(e, 501) == 0, F.lit(None)).otherwise(F.col("r_name")).alias(
            "borough"
        ),
        F.when((_m(u, 12) == 0) & (_m(e, 2) == 0), "Agency 0 (old)")
        .otherwise(F.concat(F.lit("Agency "), slot))
        .alias("agency_name"),
        F.when(_m(e, 3) == 0, fmt["closed"]).otherwise(fmt["ts"]).alias("resolution_updated"),
        F.when(_m(e, 29) == 0, F.lit(None))
        .otherwise(F.concat(F.lit("0"), (F.lit(1000) + _m(u, 40)).cast("string")))
        .alias("incident_zip"),
        # a number in the source, as an identifier column can come out of a typed export
        F.when(_m(e, 3) == 0, F.lit(None)).otherwise(_m(u, 9) + 10).alias("taxi_company_borough"),
        F.when((F.col("copy_no") == 2) & (_m(e, 400) == 9), "duplicate report")
        .when(_m(e, 7) == 0, "N/A")
        .when(_m(e, 31) == 0, "NA")
        .when(_m(e, 37) == 0, "  ")
        .when(_m(e, 41) == 0, F.lit(None))
        .otherwise(F.concat(F.lit("detail "), k.cast("string")))
        .alias("detail"),
        _with_placeholders(e, 5, F.concat(F.lit("more "), _m(u, 7).cast("string"))).alias("additional_details"),
        _with_placeholders(e, 6, F.lit("facility")).alias("facility_type"),
        F.when(_m(e, 11) == 0, "NULL")
        .when(_m(e, 13) == 0, "None")
        .when(_m(e, 17) == 0, "NaN")
        .when(_m(e, 19) == 0, "N/A")
        .when(_m(e, 23) == 0, F.lit(None))
        .otherwise(F.concat(F.lit("resolved "), F.col("event_type")))
        .alias("resolution_description"),
        _with_placeholders(e, 8, F.concat(F.lit("park "), _m(u, 5).cast("string"))).alias("park_facility_name"),
        _with_placeholders(e, 9, F.lit("street")).alias("location_type"),
        _with_placeholders(e, 10, F.lit("ramp")).alias("road_ramp"),
        _with_placeholders(e, 12, F.lit("segment")).alias("bridge_highway_segment"),
        F.when(_m(e, 47) == 0, F.lit(None)).otherwise(F.concat(F.lit("("), _m(u, 10).cast("string"), F.lit(")"))).alias("location"),
        F.col("n_name").alias("city"),
        F.col("c_name").alias("address"),
        F.when(_m(e, 43) == 0, F.lit(None))
        .otherwise(F.lit(40.0) + _m(u, 10).cast("double") * 0.125)
        .alias("latitude"),
        F.when((_m(e, 43) == 0) | (_m(e, 601) == 0), F.lit(None))
        .otherwise(F.lit(-74.0) + _m(u, 10).cast("double") * 0.125)
        .alias("longitude"),
    )


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request table under the headers of a raw export.

    Some numbers are no numbers in it, so that the ingest report has something to count.
    """
    raw = raw_requests(spark, sf_dir)
    e = F.col("unique_key")
    raw = raw.withColumn("latitude", F.when(_m(e, 53) == 4, "unknown").otherwise(F.col("latitude").cast("string")))
    return raw.withColumnsRenamed({role: header for header, role in SOURCE_HEADER_ROLES.items()})


def raw_csv_copy(spark: SparkSession, sf_dir: str) -> str:
    """Path of the request table as a raw CSV export (source headers), in the folder that all executors share."""
    path = f"{shared_folder(spark)}/raw-csv-{uuid.uuid4().hex}"
    _export(spark, sf_dir).write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


def faulty_csv_copy(spark: SparkSession, sf_dir: str) -> str:
    """As :func:`raw_csv_copy`, with records cut short, with a field too many, and without a key."""
    export = _export(spark, sf_dir)
    e, header = F.col("`Unique Key`"), ",".join(export.columns)
    line = F.to_csv(F.struct(*[f"`{c}`" for c in export.columns]), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = F.when(_m(e, 193) == 11, F.regexp_replace(line, "^[^,]*", "")).otherwise(line)
    line = F.when(_m(e, 97) == 5, F.substring_index(line, ",", 5)).when(_m(e, 89) == 7, F.concat(line, F.lit(",extra"))).otherwise(line)

    def headed(batches):
        yield pa.record_batch([pa.array([header])], ["value"])  # each file begins with its header
        yield from batches

    path = f"{shared_folder(spark)}/faulty-csv-{uuid.uuid4().hex}"
    export.select(line.alias("value")).mapInArrow(headed, "value string").write.text(path)
    return path


def ungated_cleaned(raw: DataFrame) -> DataFrame:
    """A cleaned-shaped table that breaks every cleaning gate: nothing normalised, and wrong flags."""
    return parse_timestamps(raw).withColumn("invalid_date_order", _m(F.col("unique_key"), 5) == 0)


def ungated_transformed(transformed: DataFrame) -> DataFrame:
    """A transformed-shaped table that breaks every resolution gate: a time on all rows, some negative."""
    hours = F.when(_m(F.col("unique_key"), 3) == 0, F.lit(-1.5)).otherwise(F.lit(2.0))
    return transformed.withColumn("resolution_time_hours", hours)
