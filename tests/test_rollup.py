"""Figures from a rollup equal those of the loans, for any selection, and the loans are not read for them."""

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import dashboard, rollup
from tallyforge.operators.filters import Selection, filter_multiselect, loan_base
from tallyforge.session import work_path
from tallyforge.sources import views

SELECTIONS = [
    Selection(),
    Selection(regions=("West", "East")),
    Selection(purposes=("car", "house"), sub_grades=("A1", "B2", "C3")),
    Selection(zip_codes=("111xx", "222xx", "301xx")),
    Selection(regions=("Nowhere",)),
]


@pytest.fixture(scope="module")
def rolled(spark, base):
    path, loans = work_path(spark, "rollup"), views.loans(spark, base)
    loans = loans.unionByName(loans.where("member_id % 50 = 1"))  # repeated rows count again
    third = F.col("member_id") % 3
    rollup.append_batch(loans.where(third == 0), path, "a")
    rollup.append_batch(loans.where(third == 2), path, "b")  # wrong rows, replaced below
    rollup.append_batch(loans.where(third == 1), path, "b")
    before = rollup.Rollup(spark, path, views.office_lookup(spark, base)).key_figures(None).first()["loans"]
    rollup.append_batch(loans.where(third == 2), path, "c")
    report = rollup.Rollup(spark, path, views.office_lookup(spark, base))
    assert before < report.key_figures(None).first()["loans"]
    return report, loans


def rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("selection", SELECTIONS)
def test_equal_to_the_detail(spark, base, rolled, selection):
    report, loans = rolled
    detail = filter_multiselect(loans, views.office_lookup(spark, base), selection)
    assert rows(report.principal(selection)) == rows(dashboard.principal(detail))
    assert rows(report.principal_chart(selection)) == rows(dashboard.principal_chart(detail))
    assert rows(report.risk_share(selection)) == rows(dashboard.risk_share(detail))
    assert rows(report.median_amount(selection)) == rows(dashboard.median_amount(detail))
    assert rows(report.key_figures(selection)) == rows(dashboard.key_figures(detail))


def test_without_a_selection(rolled):
    report, loans = rolled
    assert rows(report.principal(None)) == rows(dashboard.principal(loan_base(loans)))


def test_plans_read_the_rollup_alone(spark, rolled):
    report, _ = rolled
    few = Selection(regions=("West",), zip_codes=("811xx", "822xx"))
    for df in (report.principal(few), report.risk_share(few), report.key_figures(few)):
        plan = df._jdf.queryExecution().toString()
        assert "orders.parquet" not in plan and "/rollup-" in plan
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = report.median_amount(few)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(bin" in plan and "/amounts" in plan


def test_bins_never_fall(spark):
    values = [-1e300, -5.5, -1.0, -0.2, 0.0, 1e-9, 0.5, 1.0, 2.0, 2.1, 1e5, 1e5 + 1, 1e300]
    found = spark.createDataFrame([(v,) for v in values], "v double").select(rollup.amount_bin(F.col("v")).alias("b")).collect()
    assert [r.b for r in found] == sorted(r.b for r in found)
