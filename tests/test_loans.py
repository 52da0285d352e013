"""Null rules, defaults and report rules of the loan operators."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions import columns as C
from tallyforge.functions.text import join_rows, money, short_number
from tallyforge.operators import dashboard, filters, joins
from tallyforge.operators.filters import NoDataError, Selection
from tallyforge.sources import lookups, views

LOAN_SCHEMA = (
    "member_id long, zip_code string, addr_state string, grade string, sub_grade string, loan_amnt string,"
    " funded_amnt string, term string, int_rate string, emp_title string, emp_length string, annual_inc string,"
    " loan_status string, purpose string, title string, dti string, out_prncp string"
)


def loan(i, zip_code="123xx", state="NY", grade="A", sub="A1", status="Current", purpose="car", principal="100", amount="10"):
    return (i, zip_code, state, grade, sub, amount, amount, " 36 months", "10%", "t", "1 year", "1", status, purpose, "x", "1", principal)


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_region_of_every_digit(spark):
    df = spark.createDataFrame([(f"{d}00xx",) for d in range(10)] + [("x00",), (None,)], "z string")
    assert values(df, C.derive_region("z")) == [
        "East", "East", "South", "South", "Midwest", "Midwest", "Midwest", "South", "West", "West", None, None,
    ]


def test_text_to_numbers(spark):
    df = spark.createDataFrame([("13.5%",), ("n/a",), (None,), ("7",), ("1%2%",)], "r string")
    assert values(df, C.parse_rate("r")) == [13.5, None, None, 7.0, None]
    df = spark.createDataFrame([(" 36 months",), ("36 months",), (" 60 months",), (None,)], "t string")
    assert values(df, C.term_to_months("t")) == [36, None, 60, None]


def test_rounding_rules(spark):
    df = spark.createDataFrame([(0.25,), (0.75,), (3.1,), (-0.25,)], "x double")
    assert values(df, C.bucket_half("x")) == [0.5, 1.0, 3.0, -0.5]
    df = spark.createDataFrame([(14.9,), (15.0,), (0.125,), (None,), (12345678.0,)], "x double")
    assert values(df, short_number("x")) == ["14.9", "15", "0.12", None, "12345678"]
    df = spark.createDataFrame([(251400.5,), (2.5,), (3.5,)], "x double")
    assert values(df, money("x")) == ["$251,400", "$2", "$4"]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("Current",), ("Default",), (None,)], "s string")
    kept = df.where(C.not_in_keep_null("s", lookups.SETTLED_STATUSES))
    assert {r[0] for r in kept.collect()} == {"Default", None}


def test_join_rows_orders_by_key(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 1.5), (2, 2.5)], "k int, v double")
    assert join_rows(df, "k", "v", "text").first()["text"] == "1.5, 2.5, 0.5"


def test_base_drops_unknown_places(spark):
    rows = [loan(1), loan(2, state=None), loan(3, zip_code=None), loan(4, zip_code="xx")]
    base = filters.loan_base(spark.createDataFrame(rows, LOAN_SCHEMA))
    assert [r["member_id"] for r in base.collect()] == [1]


def test_empty_selection_means_all_listed_values(spark):
    offices = spark.createDataFrame([("East", "123xx", "123"), ("West", "123xx", "123"), ("West", "900xx", "900")], "region string, zip_code string, office_no string")
    rows = [loan(1), loan(2, purpose="wedding"), loan(3, sub="H1"), loan(4, zip_code="555xx"), loan(5, zip_code="900xx")]
    loans = spark.createDataFrame(rows, LOAN_SCHEMA)

    def picked(**chosen):
        found = filters.filter_multiselect(loans, offices, Selection(**chosen)).collect()
        return sorted(r["member_id"] for r in found)

    assert picked() == [1, 5]  # zip 123xx is listed twice and its loan appears once
    assert picked(regions=("West",)) == [5]
    assert picked(zip_codes=("555xx",)) == [4]
    assert picked(purposes=("house",)) == []
    with pytest.raises(NoDataError, match="No data available"):
        filters.guard_nonempty(filters.filter_multiselect(loans, offices, Selection(purposes=("house",))))


def test_risk_share_rules(spark):
    rows = [
        loan(1, status="Default", principal="25"),
        loan(2, status="Current", principal="75"),
        loan(3, status=None, grade=None, principal="10"),
        loan(4, status="Current", grade=None, principal="30"),
        loan(5, status="Current", grade="B"),
        loan(6, status="Default", grade="C", principal="0"),
    ]
    base = filters.loan_base(spark.createDataFrame(rows, LOAN_SCHEMA))
    found = {r["grade"]: r["prncp_per_risk"] for r in dashboard.risk_share(base).collect()}
    assert found == {"A": 25.0, None: 25.0, "C": None}


def test_null_sums(spark):
    base = filters.loan_base(spark.createDataFrame([loan(1, principal="n/a"), loan(2, grade="B")], LOAN_SCHEMA))
    assert {r["grade"]: r["out_prncp"] for r in dashboard.principal(base).collect()} == {"A": None, "B": 100.0}
    assert {r["grade"]: r["out_prncp"] for r in dashboard.principal_chart(base).collect()} == {"A": 0.0, "B": 100.0}


@pytest.mark.parametrize("limit", [0, 10_000])
def test_group_total_equals_window(spark, base, limit):
    """Both ways of bringing totals back, with and without a broadcast, equal the window form."""
    rows = filters.loan_base(views.loans(spark, base)).select("member_id", "region", "grade", "out_prncp")
    joined = joins.with_group_total(rows, ("region", "grade"), F.col("out_prncp"), "total", limit)
    total = F.coalesce(F.sum("out_prncp").over(Window.partitionBy("region", "grade")), F.lit(0.0))
    assert sorted(map(str, joined.collect())) == sorted(map(str, rows.withColumn("total", total).collect()))


def test_checked_broadcast_falls_back(spark):
    df = spark.range(11)
    assert joins.checked_broadcast(df, 10) is df
    small = joins.checked_broadcast(df, 11)
    assert sorted(r[0] for r in small.collect()) == list(range(11))


@pytest.mark.parametrize("limit", [0, 10_000])
def test_semi_join_never_adds_rows(spark, base, limit):
    loans = views.loans(spark, base)
    kept = joins.semi_lookup(loans, views.office_lookup(spark, base), "zip_code", limit)
    assert kept.count() == kept.select("member_id").distinct().count() < loans.count()


def test_truncation_flag(spark):
    df = spark.range(20)
    assert {r["truncated"] for r in filters.limit_flagged(df, "id", 10).collect()} == {True}
    exact = filters.limit_flagged(df, "id", 20).collect()
    assert len(exact) == 20 and {r["truncated"] for r in exact} == {False}
    assert [r["id"] for r in filters.limit_flagged(df, "id", 3).collect()] == [0, 1, 2]


def test_region_choice_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "loans")
    spark.createDataFrame([loan(1), loan(2, zip_code="900xx")], LOAN_SCHEMA).write.parquet(path)
    stored = spark.read.parquet(path)
    offices = spark.createDataFrame([("West", "900xx", "900")], "region string, zip_code string, office_no string")
    df = filters.filter_multiselect(stored, offices, Selection(regions=("West",)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "StringStartsWith(zip_code,9)" in plan and "BroadcastHashJoin" in plan
    assert [r["member_id"] for r in df.collect()] == [2]


def test_one_kept_base_serves_a_refresh(spark, base):
    offices = views.office_lookup(spark, base)
    rows = filters.filter_multiselect(views.loans(spark, base), offices)
    with dashboard.shared(rows) as kept:
        figures = dashboard.key_figures(kept).first()
        assert figures["loans"] == kept.count() == dashboard.detail_rows(kept).count()
        assert figures["avg_rate"] == dashboard.avg_rate(kept).first()["avg_rate"]
        total = dashboard.principal_chart(kept).agg(F.sum("out_prncp")).first()[0]
        assert total == kept.agg(F.sum("out_prncp")).first()[0]
        shares = [r["prncp_per_risk"] for r in dashboard.risk_share(kept).collect()]
        assert all(0 <= s <= 100 for s in shares)
    assert not rows.storageLevel.useMemory
