import pytest
from pyspark.sql import functions as F

from nestweave.functions import text as T
from nestweave.functions.geometry import centroid_y_of_json


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


def test_whitespace_is_what_strip_removes():
    assert sorted(T.WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


@pytest.mark.parametrize("value", ["  a b ", "\x1c a\x1f", " x　", "\xa0", "", "a", "\n\t"])
def test_strip(spark, value):
    assert one(spark, T.strip(F.col("v")), v=value) == value.strip()
    assert one(spark, T.lstrip(F.col("v")), v=value) == value.lstrip()
    assert one(spark, F.expr(f"btrim(v, {T.SQL_WHITESPACE})"), v=value) == value.strip()


@pytest.mark.parametrize(
    ("value", "blank", "number"),
    [
        ("", True, False),
        (None, True, False),
        ("  ", True, False),
        ("12", False, True),
        (" ٣ ", False, True),
        ("\x1c7\n", False, True),
        ("12a", False, False),
        ("1 2", False, False),
        ("-1", False, False),
    ],
)
def test_blank_and_page_numbers(spark, value, blank, number):
    assert one(spark, T.is_blank(F.col("v")), v=value) is blank
    assert one(spark, T.is_page_number(F.col("v")), v=value) is number
    assert one(spark, T.is_blank_or_page_number(F.col("v")), v=value) is (blank or number)


def test_phrase_ignores_case(spark):
    assert one(spark, T.contains_phrase(F.col("v")), v="An INSPECTION Report 2020")
    assert not one(spark, T.contains_phrase(F.col("v")), v="inspection  report")
    assert one(spark, T.contains_phrase(F.col("v"), "a.b"), v="xA.Bx")
    assert not one(spark, T.contains_phrase(F.col("v"), "a.b"), v="acb")


def test_path_and_level(spark):
    columns = F.col("a"), F.col("b"), F.col("c")
    cases = [
        (("A", None, None), "A", 1),
        (("A", "", "C"), "A > C", 3),
        ((None, "B", ""), "B", 2),
        (("", None, None), "", 0),
    ]
    for (a, b, c), path, level in cases:
        assert one(spark, T.section_path(*columns), a=a, b=b, c=c) == path
        assert one(spark, T.section_level(*columns), a=a, b=b, c=c) == level


def test_urls(spark):
    signed = T.signed_url(F.col("u"), F.col("t"))
    assert one(spark, signed, u="http://x/a", t="s") == "http://x/a?s"
    assert one(spark, signed, u="http://x/a?b", t="s") == "http://x/a?b&s"
    assert one(spark, signed, u="http://x/a", t="") == "http://x/a"
    assert one(spark, signed, u="http://x/a", t=None) == "http://x/a"
    url = T.resource_url("https://h/", "tickets", F.col("i"))
    assert one(spark, url, i="7") == "https://h/tickets/7"


@pytest.mark.parametrize(
    ("polygons", "y"),
    [
        ('[[{"y":0.9},{"y":0.7}]]', 0.8),
        ('[[{"y":0.9}],"junk"]', 0.9),
        ('[[{"y":1}]]', 1.0),
        ('[[{"y":true}]]', 1.0),
        ('[[{"y":9e-1,"x":"a"}]]', 0.9),
        ("[]", 0.5),
        ("[[]]", 0.5),
        ('[[{"x":1}]]', 0.5),
        ('"abc"', 0.5),
        ("notjson", 0.5),
        ('[[{"y":"s"}]]', 0.5),
        ('[[{"y":"0.9"}]]', 0.5),
        ('[[{"y":null}]]', 0.5),
        ('[[{"y":0.9},{"x":1}]]', 0.5),
        ('[[{"y":0.9},3]]', 0.5),
        ('[{"y":1}]', 0.5),
        ('{"0":[{"y":1}]}', 0.5),
        ('"[[{\\"y\\":0.9}]]"', 0.5),
        (None, 0.5),
    ],
)
def test_centroid(spark, polygons, y):
    assert one(spark, centroid_y_of_json(F.col("p")), p=polygons) == pytest.approx(y)
