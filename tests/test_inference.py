import itertools
import random

from reqlens.sources.files import read_raw_csv
from reqlens.sources.inference import cast_columns, infer_types, inferred_schema, merge_type_counts, settled_types, type_counts, with_types
from tests.fixtures import write_raw_csv

DATE = "01/02/2024 03:04:05 PM"
VALUES = {
    "bigint": ["0", "-7", "12345678901", None],
    "double": ["1", "2.5", "-0.125", "1e3", None],
    "timestamp_ntz": [DATE, "12/31/2023 11:59:59 AM", None],
    "string": ["abc", "", " ", "00123", "+5", "1.", ".5", "NaN", "Infinity", "99999999999999999999x", "1 ", "2024-01-02", None],
}


def kinds(df):
    return settled_types(inferred_schema(df))


def test_each_kind(spark):
    columns = {f"c{i}": [v, v] for i, v in enumerate(VALUES["string"]) if v is not None}
    columns |= {"n": VALUES["bigint"][:2], "d": ["1", "2.5"], "t": [DATE, None], "mixed": ["1", DATE], "empty": [None, None]}
    columns |= {"zip": ["01234", "11111"], "big": ["99999999999999999999", "1"], "huge": ["1" + "0" * 400, "1"], "incident_zip": ["1", "2"]}
    rows = list(zip(*columns.values(), strict=True))
    got = kinds(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)))
    want = dict.fromkeys(columns, "string") | {"n": "bigint", "d": "double", "t": "timestamp_ntz", "big": "double"}
    assert got == want  # an identifier and a code with leading zeros stay text; a number beyond doubles is none


def test_counts_of_parts_add_up_in_any_order(spark):
    rng = random.Random(4)
    pool = list(itertools.chain(*VALUES.values()))
    rows = [tuple(rng.choice(pool[: 4 * (k + 1)]) for k in range(4)) for _ in range(300)]
    schema = "a string, b string, c string, d string"
    whole = sorted(type_counts(spark.createDataFrame(rows, schema)).collect())
    parts = [type_counts(spark.createDataFrame(rows[lo : lo + 100], schema)) for lo in (200, 0, 100)]
    assert sorted(merge_type_counts(*parts).collect()) == whole
    one = with_types(merge_type_counts(type_counts(spark.createDataFrame([("1",)], "a string")), type_counts(spark.createDataFrame([("x",)], "a string"))))
    assert settled_types(one) == {"a": "string"}  # a later batch widens the type


def test_typed_table_has_every_value(spark, tmp_path):
    path = write_raw_csv(str(tmp_path))
    text, typed = read_raw_csv(spark, path, numeric_types={}), read_raw_csv(spark, path, numeric_types={}, infer=True)
    types = dict(typed.dtypes)
    assert types["incident_zip"] == "string" and types["unique_key"] == "bigint" and types["latitude"] == "double"
    for c in text.columns:
        assert text.where(text[c].isNotNull()).count() == typed.where(typed[c].isNotNull()).count(), c


def test_typed_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 2.0, "3")], "a long, b double, c string")
    assert kinds(df) == {"c": "bigint"} and infer_types(df).dtypes == [("a", "bigint"), ("b", "double"), ("c", "bigint")]
    assert kinds(df.select("a")) == {}
    assert kinds(df.limit(0)) == {"c": "string"}
    late = cast_columns(spark.createDataFrame([("x",), ("4",)], "c string"), {"c": "bigint"})
    assert sorted(r.c or 0 for r in late.collect()) == [0, 4]  # what the settled type does not take is NULL


def test_odd_column_names(spark):
    df = spark.createDataFrame([("1", "2.5")], "`a.b` string, `c d` string")
    assert infer_types(df).dtypes == [("a.b", "bigint"), ("c d", "double")]
