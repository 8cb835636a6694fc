import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from fieldgrant.functions.amounts import plain_amount
from fieldgrant.operators import payments, profile, quality, repair, shape
from fieldgrant.plans import master
from fieldgrant.spec import AMOUNT_COLUMNS, DATASETS, SILVER_SCHEMA, FieldSpec
from fieldgrant.taxonomy import SCHEMES, slugs

SILVER = "beneficiary string, intervention_code string, municipality string, country string, year string, " + ", ".join(
    f"{c} double" for c in AMOUNT_COLUMNS
)
few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- shape -------------------------------------------------------------------------------------


def test_promote_header_finds_the_row_anywhere(spark):
    data = [("Report 2024", "x", "IE"), ("Name", "Town", "IE"), ("Ann", "Cork", "IE"), (None, "Total", "IE")]
    df = spark.createDataFrame(data, "title string, `unnamed:_1` string, source_country string").repartition(3)
    got = shape.promote_header(df, "Name")
    assert got.columns == ["Name", "Town", "source_country"]
    assert rows(got) == [("Ann", "Cork", "IE"), ("Report 2024", "x", "IE")]
    assert len(rows(shape.promote_header(df, "Name", keep_null_rows=True))) == 3
    with pytest.raises(ValueError):
        shape.promote_header(df, "Nobody")


def test_union_casts_to_text_first(spark):
    a = spark.createDataFrame([("x", 1)], "a string, b int")
    b = spark.createDataFrame([(7, [1, 2])], "a bigint, c array<int>")
    got = shape.union_by_name([shape.as_text(a), shape.as_text(b)])
    assert got.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert rows(got) == [("7", None, "[1,2]"), ("x", "1", None)]


@few
@given(st.lists(st.integers(0, 5), min_size=1, max_size=4))
def test_union_keeps_every_row(spark, sizes):
    frames = [spark.range(n).withColumn(f"c{i}", F.lit(i)) for i, n in enumerate(sizes)]
    assert shape.union_by_name(frames).count() == sum(sizes)


def test_fill_leaves_empty_text(spark):
    df = spark.createDataFrame([("", math.nan), (None, None), ("a", math.inf)], "t string, v double")
    assert rows(shape.fill_missing(df, ["t"], ["v"])) == [("", 0.0), ("UNKNOWN", 0.0), ("a", math.inf)]


@pytest.mark.parametrize("dataset", sorted(DATASETS))
def test_every_spec_maps_to_the_contract(spark, dataset):
    spec = DATASETS[dataset]
    for misread in (False, True):
        names = [f.aliases[0] if misread and f.aliases else f.source for f in spec.fields]
        values = [f"{1 + i}.5" if f.parse else f.target for i, f in enumerate(spec.fields)]
        titled = dataset == "IRELAND_2024"  # its header is a row of the data
        data = [tuple(names), tuple(values)] if titled else [tuple(values)]
        raw = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))
        if titled:
            raw = raw.toDF("title", *names[1:])
        got = shape.to_silver(raw, spec)
        assert quality.schema_findings(got.schema, SILVER_SCHEMA) == []
        assert [got.first()[f.target] for f in spec.fields] == [
            float(v) if f.parse else v for f, v in zip(spec.fields, values)
        ]


def test_spec_keeps_extra_columns(spark):
    spec = DATASETS["SPAIN_2024"].with_fields(FieldSpec("province", "provincia"))
    raw = spark.createDataFrame(
        [("b", "m", "ES", "2024", "I.1", "1,5", "2", None, "p")],
        "beneficiario string, municipio string, source_country string, source_year string, medida string, "
        "feaga string, feader string, importecofin string, provincia string",
    )
    got = shape.map_columns(raw, spec)
    assert got.columns[-1] == "province" and got.first()[5:] == (1.5, 2.0, None, "p")


# --- repair ------------------------------------------------------------------------------------


def test_repair_shift(spark):
    data = [("12.5", "0"), ("12.5", None), ("12.5", "3"), ("2023-01-01", "0"), (None, "0"), ("20230101", "0")]
    df = spark.createDataFrame(data, "d string, a string")
    got = [(r.d, r.a) for r in repair.repair_shift(df, "d", "a").collect()]
    assert got[:5] == [(None, "12.5"), (None, "12.5"), ("12.5", "3"), ("2023-01-01", "0"), (None, "0")]
    assert got[5][0] is None
    guarded = repair.repair_shift(df, "d", "a", date_digits=8).collect()[5]
    assert (guarded.d, guarded.a) == ("20230101", "0")
    assert repair.shift_suspects(df, "d").count() == 4
    fixed = repair.repair_shift(df, "d", "a").withColumn("a", plain_amount("a"))
    assert repair.shift_repaired_rows(fixed, "d", "a").count() == 3


# --- profile -----------------------------------------------------------------------------------


def test_missing_profile(spark):
    df = spark.createDataFrame(
        [(" N/A ", 1.0, 1), ("  ", math.nan, 2), (None, None, 3), ("x", 2.0, None)], "t string, v double, `odd name` int"
    )
    got = [tuple(r) for r in profile.missing_profile(df).collect()]
    assert got == [("odd name", 1, 25.0, 3, "int"), ("v", 2, 50.0, 2, "double"), ("t", 3, 75.0, 1, "string")]
    empty = profile.missing_profile(df.limit(0)).first()
    assert empty.missing_count == 0 and empty.missing_percentage is None


@few
@given(st.lists(st.tuples(st.sampled_from([None, "", "a", "NA"]), st.sampled_from([None, 0.0, math.nan])), max_size=9))
def test_profile_invariant(spark, data):
    df = spark.createDataFrame(data, "t string, v double")
    for r in profile.missing_profile(df).collect():
        assert r.missing_count + r.non_null_count == len(data)


def test_distinct_profile_equals_count_distinct(spark):
    data = [(1, "a", 0.0, b"x"), (2, "a", -0.0, b"y"), (2, None, math.nan, None), (None, "", math.nan, b"x")]
    df = spark.createDataFrame(data, "i int, t string, v double, b binary").withColumn("none", F.lit(None).cast("int"))
    expected = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert {r.column_name: r.distinct_count for r in profile.distinct_profile(df).collect()} == expected
    close = {r.column_name: r.distinct_count for r in profile.distinct_profile(df.drop("v"), approximate=True).collect()}
    assert close == {c: n for c, n in expected.items() if c != "v"}
    assert all(r.distinct_count == 0 for r in profile.distinct_profile(df.limit(0)).collect())


# --- quality -----------------------------------------------------------------------------------


def test_schema_findings_lists_everything(spark):
    off = StructType([f for f in SILVER_SCHEMA if f.name != "year"] + [StructField("year", TimestampType())])
    off = off.add("more", "integer").add("country", "string")
    rules = [(r, c) for r, c, _, _ in quality.schema_findings(off, SILVER_SCHEMA)]
    assert rules == [
        ("duplicate_column", "country"), ("extra_column", "more"), ("column_order", ""), ("column_type", "year")
    ]
    df = spark.createDataFrame([], off)
    assert quality.schema_report(df).count() == 4
    with pytest.raises(quality.SchemaViolation, match="country.*more.*year"):
        quality.enforce_schema(df)


def test_matching_schema_has_no_findings(spark):
    df = spark.createDataFrame([], SILVER_SCHEMA)
    assert quality.schema_report(df).count() == 0 and quality.enforce_schema(df) is df


def test_quality_report_and_enforcement(spark):
    df = spark.createDataFrame([("a", 1.0), ("", math.inf), (None, math.nan), ("  ", None)], "t string, v double")
    report = quality.quality_report(df, ["t", "v"], ["v"])
    assert rows(report) == [("finite", "v", 2), ("not_blank", "t", 1), ("not_empty", "", 0), ("not_null", "t", 1),
                            ("not_null", "v", 1)]
    assert ("not_blank", "t", 2) in rows(quality.quality_report(df, ["t", "v"], ["v"], trim=True))
    with pytest.raises(quality.QualityViolation, match="finite v: 2.*not_null v: 1"):
        quality.enforce_quality(report)
    empty = quality.quality_report(df.limit(0), ["t", "v"], ["v"])
    with pytest.raises(quality.QualityViolation, match="not_empty"):
        quality.enforce_quality(empty)
    quality.enforce_quality(quality.quality_report(df.limit(1), ["t", "v"], ["v"]))


def test_guard_passes_good_rows_and_stops_bad_ones(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", math.inf)], "t string, v double")
    good = quality.guard(df.filter("t = 'a'"), ["t", "v"], ["v"])
    assert rows(good) == [("a", 1.0)]
    with pytest.raises(Exception, match="quality rule broken: finite v"):
        quality.guard(df, ["t", "v"], ["v"]).collect()


# --- payments ----------------------------------------------------------------------------------

payment = st.tuples(
    st.sampled_from([None, "UNKNOWN", "hot", "a", "b"]),
    st.sampled_from([None, "nothing listed", *[s.raw_code for s in SCHEMES[:4]], SCHEMES[39].raw_code]),
    st.sampled_from([None, "m1", "m2"]),
    st.just("ES"),
    st.sampled_from(["2023", "2024"]),
    *[st.integers(-300, 10**9).map(lambda k: k / 100)] * 3,
)


@few
@given(st.lists(payment, max_size=40))
def test_salted_merge_equals_plain_merge(spark, data):
    df = spark.createDataFrame(data, SILVER)
    assert rows(payments.merge_payments_salted(df, salts=3)) == rows(payments.merge_payments(df))


@few
@given(st.lists(payment, max_size=40))
def test_fused_master_equals_joined_master(spark, data):
    df = spark.createDataFrame(data, SILVER)
    fused = master.build_master(df)
    assert rows(fused) == rows(master.build_master_join(df).select(*fused.columns))


def test_master_against_brute_force_with_a_hot_key(spark):
    labels = [s.raw_code for s in SCHEMES] + ["else"]
    slug_of = {s.raw_code: s.slug for s in SCHEMES}
    data = [
        ("hot" if i % 3 == 0 else f"b{i % 50}", labels[i * 7 % len(labels)], "m", "ES", "2024",
         (i % 997) / 100, (i % 89) / 10, -0.05 if i % 2 else 0.1)
        for i in range(3000)
    ]
    merged = {}
    for b, code, _, _, _, *amounts in data:
        sums = merged.setdefault((b, code), [0, 0, 0])
        for i, a in enumerate(amounts):
            sums[i] += round(a * 100)
    expected = {}
    for (b, code), (eagf, eafrd, co) in merged.items():
        if eagf + eafrd + co:
            row = expected.setdefault(b, dict.fromkeys(slugs(), 0) | {"eagf": 0, "eafrd": 0, "public": 0})
            row["eagf"] += eagf
            row["eafrd"] += eafrd
            row["public"] += eagf + eafrd + co
            row[slug_of.get(code, "other_rural_development")] += eagf + eafrd + co
    got = {r.beneficiary: r for r in master.build_master(spark.createDataFrame(data, SILVER)).collect()}
    assert set(got) == set(expected)
    for b, row in expected.items():
        assert got[b].total_eagf_income_support == row["eagf"] / 100
        assert got[b].grand_total_public_payout == row["public"] / 100
        assert {s: got[b][s] for s in slugs()} == {s: row[s] / 100 for s in slugs()}


def test_null_beneficiary_is_in_no_master(spark):
    df = spark.createDataFrame([(None, "s", 1.0, 1.0, 1.0), ("a", "s", 1.0, 2.0, 3.0)],
                               "beneficiary string, scheme_token string, total_eagf_income_support double, "
                               "total_eafrd_income_support double, grand_total_public_payout double")
    for build in (payments.beneficiary_master, payments.beneficiary_master_join):
        assert [r.beneficiary for r in build(df).collect()] == ["a"]


def test_taxonomy_matches_labels_exactly(spark):
    labels = [SCHEMES[0].raw_code, SCHEMES[0].raw_code.replace("   ", " "), None, "22400 - Monzón", "22400 - Monzon"]
    df = spark.createDataFrame([(c,) for c in labels], "intervention_code string")
    got = {r.intervention_code: r.scheme_token for r in payments.classify_schemes(df).collect()}
    assert [got[c] for c in labels] == [
        "direct_payment_biss", "other_rural_development", "other_rural_development", "physical_capital_investments",
        "other_rural_development",
    ]


def test_taxonomy_size():
    assert len(SCHEMES) == len({s.raw_code for s in SCHEMES}) == 58
    assert len(slugs()) == 35 and len({s.group_name for s in SCHEMES}) == 8


def test_distinct_schemes_leaves_out_markers(spark):
    df = spark.createDataFrame([(c,) for c in ("x", "x", "N/A", "", None, "UNKNOWN")], "intervention_code string")
    assert rows(payments.distinct_schemes(df)) == [("UNKNOWN",), ("x",)]
