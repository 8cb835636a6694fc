import math
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from fieldgrant.functions import links
from fieldgrant.functions.amounts import cents, comma_amount, exact_sum, parse_failed, plain_amount
from fieldgrant.functions.fingerprints import dataset_fingerprint
from fieldgrant.functions.names import misread_as_latin1, normalise_columns, normalise_name, unique_names

AMOUNTS = ["1234,56", "1.234,56", "", None, " 7 ", "NaN", "Infinity", "1e3", "-5,0"]


def values(df, c):
    return [r[c] for r in df.collect()]


def test_comma_amount(spark):
    df = spark.createDataFrame([(a,) for a in AMOUNTS], "a string")
    got = values(df.select(comma_amount("a").alias("v")), "v")
    assert got[:5] == [1234.56, None, None, None, 7.0]
    assert math.isnan(got[5]) and got[6:] == [math.inf, 1000.0, -5.0]
    assert values(df.select(comma_amount("a", thousands_sep=".").alias("v")), "v")[1] == 1234.56


def test_plain_amount_and_failures(spark):
    df = spark.createDataFrame([("1.5",), ("1,5",), ("N/A",), ("  ",), (None,)], "a string")
    got = df.select(plain_amount("a").alias("v"), parse_failed("a", plain_amount("a")).alias("f")).collect()
    assert [(r.v, r.f) for r in got] == [(1.5, False), (None, True), (None, True), (None, False), (None, False)]


def test_fill_turns_nan_into_zero(spark):
    df = spark.createDataFrame([(a,) for a in AMOUNTS], "a string").select(comma_amount("a").alias("v"))
    assert values(df.fillna(0.0, ["v"]), "v") == [1234.56, 0.0, 0.0, 0.0, 7.0, 0.0, math.inf, 1000.0, -5.0]


def test_exact_sum_does_not_depend_on_order(spark):
    amounts = [0.1 + 0.2, 0.7, 1e11, -1e11, 0.05] * 300
    up = spark.createDataFrame([(a,) for a in amounts], "a double")
    down = spark.createDataFrame([(a,) for a in sorted(amounts)], "a double").repartition(7)
    assert up.agg(exact_sum("a").alias("s")).first().s == 315.0
    assert down.agg(exact_sum("a").alias("s")).first().s == 315.0


@pytest.mark.parametrize(
    "amounts, expected",
    [([], None), ([None], None), ([None, 1.5], 1.5), ([0.001, 0.002], 0.003), ([math.inf, 1.0], math.inf),
     ([1e300, 1.0], 1e300), ([-0.01, 0.01], 0.0)],
)
def test_exact_sum_edges(spark, amounts, expected):
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    got = df.agg(exact_sum("a").alias("s")).first().s
    assert got == expected if expected is None else got == pytest.approx(expected)


def test_exact_sum_keeps_nan(spark):
    df = spark.createDataFrame([(math.nan,), (1.0,)], "a double")
    assert math.isnan(df.agg(exact_sum("a").alias("s")).first().s)


def test_cents_snaps_large_amounts(spark):
    amounts = [k / 100 for k in (123456789012345, 99999999999, 1, 29, 57, 10**14 + 7)]
    df = spark.createDataFrame([(a,) for a in amounts], "a double").select(cents(F.col("a")).alias("c"))
    assert values(df, "c") == [123456789012345.0, 99999999999.0, 1.0, 29.0, 57.0, 10.0**14 + 7]


def test_names(spark):
    assert normalise_name("  Fondo - A/B ") == "fondo___a_b"
    assert normalise_name("a  b") == "a__b"
    assert unique_names(["a", "a", "a_2", "a"]) == ["a", "a_3", "a_2", "a_4"]
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], ["a b", "a-b", "A", "a", "x/y", "w`z.q"])
    assert normalise_columns(df).columns == ["a_b", "a_b_2", "a", "a_2", "x_y", "w`z.q"]
    assert normalise_columns(df).first()[5] == 6


def test_misread_name_keeps_invisible_character():
    assert misread_as_latin1("maßnahme") == "maã\u009fnahme"
    assert misread_as_latin1("begünstigten") == "begã¼nstigten"


HTML = """<p><A class="x" HREF='b.html'>b</A><!-- <a href="no.xls">no</a> -->
<a data-href="no" href=c.xls>c</a><script>var t='<a href="no2.xls">';</script>
<a title="2024" href="/files/2024.XLSX?a=1&amp;b=2">x</a><abbr href="no3">q</abbr></p>"""


def test_hrefs(spark):
    df = spark.createDataFrame([(HTML,)], "html string")
    found = df.select(links.hrefs(F.col("html")).alias("h")).first().h
    assert found == ["b.html", "c.xls", "/files/2024.XLSX?a=1&b=2"]


def test_first_href(spark):
    df = spark.createDataFrame([(HTML,), ("<a href='2023.xls'>",)], "html string")
    first = links.first_href(links.hrefs(F.col("html")), "2024", (".xls", ".xlsx"))
    assert values(df.select(first.alias("f")), "f") == ["/files/2024.XLSX?a=1&b=2", None]


@pytest.mark.parametrize("base", ["http://h.org/a/b/c.html?q=1#top", "https://h.org", "http://h.org/a/"])
def test_absolute_url_agrees_with_the_standard_library(spark, base):
    hrefs = ["x.xls", "/x.xls", "../x.xls", "../../../x", "./y/./z", "//o.org/p", "http://o.org/x?y=1", "?p=2",
             "#f", "", "d/../e.xls?x=/../y", "..", "mailto:a@b.c"]
    df = spark.createDataFrame([(base, h) for h in hrefs], "base string, href string")
    got = values(df.select(links.absolute_url(F.col("base"), F.col("href")).alias("u")), "u")
    assert dict(zip(hrefs, got)) == {h: urljoin(base, h) for h in hrefs}


def test_dataset_fingerprint_ignores_order_but_not_content(spark):
    rows = [(i, f"t{i % 7}" if i % 5 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, t string")
    first = dataset_fingerprint(df).first()
    assert first.row_count == 500
    assert dataset_fingerprint(df.repartition(5, "t")).first() == first
    assert dataset_fingerprint(df.fillna("")).first().fingerprint != first.fingerprint
    assert dataset_fingerprint(df.union(df.limit(1))).first().fingerprint != first.fingerprint
    assert dataset_fingerprint(df.limit(0)).first().row_count == 0


def test_row_digests_differ_where_rows_do(spark):
    from fieldgrant.functions.fingerprints import dataset_fingerprint

    def found(*row):
        return dataset_fingerprint(spark.createDataFrame([row], "a string, b string")).first().fingerprint

    rows = [("a\x1fb", "c"), ("a", "b\x1fc"), (None, "x"), ("\x00", "x"), ("", "x"), ("-", "x"), ("1:a", ""), ("", "1:a")]
    assert len({found(*r) for r in rows}) == len(rows)
