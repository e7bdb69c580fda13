import datetime
import decimal
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from segmill.operators.project import align, flatten_names, json_safe, training_columns
from segmill.sinks import to_json_rows

NAN, INF = float("nan"), float("inf")
NAMES = "product_name array<struct<lang:string,text:string>>"


def test_array_of_names_is_joined_without_nulls(spark):
    df = spark.createDataFrame(
        [([("en", "tea"), ("fr", None), (None, "té")],), ([],), (None,), ([None, ("de", "Tee")],)], NAMES
    )
    assert [tuple(r) for r in flatten_names(df).collect()] == [
        ("en | fr", "tea | té"), ("", ""), ("", ""), ("de", "Tee"),
    ]


def test_only_known_fields_of_an_array_are_used(spark):
    df = spark.createDataFrame([([("tea", 1)],)], "product_name array<struct<text:string,weight:int>>")
    assert flatten_names(df).columns == ["product_name_texts"]
    df = spark.createDataFrame([([(1,)],)], "product_name array<struct<weight:int>>")
    assert flatten_names(df).columns == []


def test_struct_gives_one_text_per_field(spark):
    df = spark.createDataFrame([(("tea", 7),), (None,)], "product_name struct<main:string,`a.b`:int>")
    assert flatten_names(df).columns == ["product_name_main", "product_name_a.b"]
    assert [tuple(r) for r in flatten_names(df).collect()] == [("tea", "7"), (None, None)]


def test_other_types_are_cast_and_absent_column_gives_nothing(spark):
    df = spark.createDataFrame([(["a", "b"], 5)], "product_name array<string>, x int")
    assert [tuple(r) for r in flatten_names(df).collect()] == [("[a, b]",)]
    assert flatten_names(df.drop("product_name")).columns == []
    assert flatten_names(df, column="x").first() == ("5",)


def test_training_columns(spark):
    df = spark.createDataFrame([("tea", 1, decimal.Decimal("2.50"), "x")], "product_name string, a int, b decimal(5,2), c string")
    out = training_columns(df, ["a", "b"])
    assert out.dtypes == [("product_name", "string"), ("a", "double"), ("b", "double")]
    assert tuple(out.first()) == ("tea", 1.0, 2.5)
    with pytest.raises(ValueError, match="both text and feature: product_name"):
        training_columns(df.withColumn("product_name", F.lit(1)), ["product_name"])


def test_align_to_recorded_schema(spark):
    df = spark.createDataFrame([("tea", 1, "2.5", 9, "k")], "product_name string, b int, a string, extra int, id string")
    out = align(df, ["a", "b", "gone"], ["product_name", "product_name_langs"], keep=["id"])
    assert out.dtypes == [
        ("id", "string"), ("product_name", "string"), ("product_name_langs", "string"),
        ("a", "double"), ("b", "double"), ("gone", "double"),
    ]
    assert tuple(out.first()) == ("k", "tea", None, 2.5, 1.0, None)


def test_align_with_text_that_is_no_number(spark):
    df = spark.createDataFrame([("1.5",), ("many",)], "a string")
    with pytest.raises(PySparkException):
        align(df, ["a"]).collect()
    assert [r.a for r in align(df, ["a"], on_bad="null").collect()] == [1.5, None]
    with pytest.raises(ValueError, match="on_bad"):
        align(df, ["a"], on_bad="skip")


def test_json_safe_at_every_depth(spark):
    moment = datetime.datetime(2024, 1, 2, 3, 4, 5)
    row = (
        NAN, -INF, 1.5, 2.5, decimal.Decimal("1.25"), moment, moment.replace(microsecond=70), datetime.date(2024, 1, 2),
        (NAN, [(INF, decimal.Decimal("0.50")), (2.0, None)]), {"a": NAN, "b": 1.0}, None, "t", True, 3,
    )
    schema = (
        "nan double, inf float, num double, f float, dec decimal(5,2), at timestamp, at_ntz timestamp_ntz, day date, "
        "s struct<v:double,items:array<struct<w:double,d:decimal(4,2)>>>, m map<string,double>, "
        "none struct<v:double>, t string, flag boolean, i int"
    )
    out = json_safe(spark.createDataFrame([row], schema)).first().asDict(recursive=True)
    assert out == {
        "nan": None, "inf": None, "num": 1.5, "f": 2.5, "dec": 1.25, "at": "2024-01-02T03:04:05",
        "at_ntz": "2024-01-02T03:04:05.000070", "day": "2024-01-02",
        "s": {"v": None, "items": [{"w": None, "d": 0.5}, {"w": 2.0, "d": None}]},
        "m": {"a": None, "b": 1.0}, "none": None, "t": "t", "flag": True, "i": 3,
    }
    json.dumps(out, allow_nan=False)


def test_json_rows_leave_out_nulls(spark):
    df = spark.createDataFrame([(1, None, "é")], "a int, b int, c string")
    assert to_json_rows(df).first().value == '{"a":1,"c":"é"}'
