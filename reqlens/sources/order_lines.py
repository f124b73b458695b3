"""A second request table under its own column names: the lines of orders.

One request per row of ``lineitem``: opened when its order was placed, closed
when it was shipped, handled by a supplier, for a customer's region, of a
part's type.  Nothing is renamed: :data:`LINE_ROLES` tells every operator which
column plays which part.  Dates are typed here, the key repeats where a line
number does, and many lines are shipped before they were ordered, so the
date-order flag has work to do.

Lines of an unknown order, part or supplier stay, with NULL in what is unknown.
Joins carry no hints (see :mod:`reqlens.sources.testdata`): ``lineitem ⋈ orders``
shuffles by order, so a large order is spread by AQE's skew handling alone, and the
smaller tables are broadcast where they prove small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.roles import Roles
from reqlens.sources.testdata import load_table

LINE_ROLES = Roles(
    key="line_id",
    created="o_orderdate",
    closed="l_shipdate",
    resolution_updated="updated_at",  # optional, and absent here
    status="l_linestatus",
    category="p_type",
    region="r_name",
    handler="s_name",
    handler_name="s_name",
    invalid_flag="shipped_before_ordered",
    profiled_placeholders=(),
    cleaned_placeholders=(),
    closed_status="F",
)
#: One type is respelt, so that standardising has something to do.
LINE_SPELLING = {"ECONOMY": "Economy"}


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_id, o_orderdate, l_shipdate, l_linestatus, p_type, r_name, s_name of every line."""
    table = lambda name, *columns: load_table(spark, sf_dir, name).select(*columns)
    places = table("nation", "n_nationkey", "n_regionkey").join(
        table("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    customers = table("customer", "c_custkey", "c_nationkey").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    orders = table("orders", "o_orderkey", "o_custkey", "o_orderdate").join(
        customers.select("c_custkey", "r_name"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    lines = table("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_shipdate")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(table("part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(table("supplier", "s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_id"),
            "o_orderdate",
            "l_shipdate",
            "l_linestatus",
            "p_type",
            "r_name",
            "s_name",
        )
    )
