"""Queries over the loan table: columns, filters, joins and dashboard frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.functions.frames import rounded
from tallyforge.functions.text import json_row
from tallyforge.operators import dashboard, filters, joins, rollup
from tallyforge.operators.filters import Selection, filter_multiselect, loan_base
from tallyforge.plans.registry import query
from tallyforge.session import work_path
from tallyforge.sources import lookups, tables, views

REGION_SQL = """CASE WHEN substr(zip_code,1,1) IN ('8','9') THEN 'West' WHEN substr(zip_code,1,1) IN ('4','5','6') THEN 'Midwest'
  WHEN substr(zip_code,1,1) IN ('2','3','7') THEN 'South' WHEN substr(zip_code,1,1) IN ('0','1') THEN 'East' END"""


def picked(spark: SparkSession, base: str, selection: Selection = Selection()) -> DataFrame:
    return filter_multiselect(views.loans(spark, base), views.office_lookup(spark, base), selection)


@query("derive_region", f"SELECT member_id, zip_code, {REGION_SQL} AS region FROM loans", ("loans",))
def derive_region(spark, base):
    return views.loans(spark, base).select("member_id", "zip_code", C.derive_region("zip_code").alias("region"))


@query("derive_office", "SELECT member_id, left(zip_code,3) AS office_no FROM loans", ("loans",))
def derive_office(spark, base):
    return views.loans(spark, base).select("member_id", C.derive_office("zip_code").alias("office_no"))


@query(
    "term_to_months",
    "SELECT member_id, CAST(CASE term WHEN ' 36 months' THEN 36 WHEN ' 60 months' THEN 60 END AS INT) AS months FROM loans",
    ("loans",),
)
def term_to_months(spark, base):
    return views.loans(spark, base).select("member_id", C.term_to_months("term").alias("months"))


@query(
    "parse_rate",
    "SELECT member_id, try_cast(CASE WHEN strpos(int_rate,'%') > 0 THEN left(int_rate, strpos(int_rate,'%')-1) || substr(int_rate, strpos(int_rate,'%')+1)"
    " ELSE int_rate END AS DOUBLE) AS rate FROM loans",
    ("loans",),
)
def parse_rate(spark, base):
    return views.loans(spark, base).select("member_id", C.parse_rate("int_rate").alias("rate"))


@query(
    "to_numeric",
    "SELECT member_id, try_cast(loan_amnt AS DOUBLE) AS loan_amnt, try_cast(bc_util AS DOUBLE) AS bc_util,"
    " try_cast(bc_open_to_buy AS DOUBLE) AS bc_open_to_buy FROM loans",
    ("loans",),
)
def to_numeric(spark, base):
    return views.loans(spark, base).select(
        "member_id", *[C.to_numeric(c).alias(c) for c in ("loan_amnt", "bc_util", "bc_open_to_buy")]
    )


@query(
    "filter_not_null",
    "SELECT member_id, addr_state, zip_code FROM loans WHERE addr_state IS NOT NULL AND zip_code IS NOT NULL",
    ("loans",),
)
def filter_not_null(spark, base):
    kept = filters.filter_not_null(views.loans(spark, base), "addr_state", "zip_code")
    return kept.select("member_id", "addr_state", "zip_code")


@query(
    "filter_not_in",
    "SELECT member_id, loan_status FROM loans EXCEPT ALL SELECT member_id, loan_status FROM loans"
    " WHERE loan_status IN ('Current','Fully Paid','Charged Off')",
    ("loans",),
)
def filter_not_in(spark, base):
    at_risk = C.not_in_keep_null("loan_status", lookups.SETTLED_STATUSES)
    return views.loans(spark, base).where(at_risk).select("member_id", "loan_status")


@query(
    "drop_na",
    "SELECT member_id, grade, term, loan_status FROM loans WHERE NOT (grade IS NULL OR term IS NULL OR loan_status IS NULL)",
    ("loans",),
)
def drop_na(spark, base):
    return filters.drop_na(views.loans(spark, base).select("member_id", "grade", "term", "loan_status"))


@query(
    "select_cols",
    "SELECT member_id, region, grade, office_no, out_prncp, purpose, dti FROM base",
    ("base",),
)
def select_cols(spark, base):
    return loan_base(views.loans(spark, base)).select(
        "member_id", "region", "grade", "office_no", "out_prncp", "purpose", "dti"
    )


@query("agg_count", "SELECT count(*) AS n FROM base", ("base",))
def agg_count(spark, base):
    return loan_base(views.loans(spark, base)).agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_multiselect",
    "SELECT member_id, region, office_no, purpose, sub_grade, out_prncp FROM picked",
    ("picked",),
)
def multiselect_all(spark, base):
    return picked(spark, base).select("member_id", "region", "office_no", "purpose", "sub_grade", "out_prncp")


@query(
    "filter_multiselect_region",
    "SELECT member_id, region, office_no, purpose, sub_grade, out_prncp FROM picked WHERE region = 'West'",
    ("picked",),
)
def multiselect_region(spark, base):
    rows = picked(spark, base, Selection(regions=("West",)))
    return rows.select("member_id", "region", "office_no", "purpose", "sub_grade", "out_prncp")


@query(
    "filter_multiselect_two",
    "SELECT member_id, region, office_no, purpose, sub_grade, out_prncp FROM picked"
    " WHERE purpose IN ('car','house') AND sub_grade IN ('A1','B2','C3')",
    ("picked",),
)
def multiselect_two(spark, base):
    rows = picked(spark, base, Selection(purposes=("car", "house"), sub_grades=("A1", "B2", "C3")))
    return rows.select("member_id", "region", "office_no", "purpose", "sub_grade", "out_prncp")


@query(
    "join_semi_lookup",
    "SELECT member_id, zip_code FROM loans l WHERE EXISTS (SELECT 1 FROM office_lookup o WHERE o.zip_code = l.zip_code)",
    ("office_lookup",),
)
def join_semi_lookup(spark, base):
    rows = views.loans(spark, base).select("member_id", "zip_code")
    return joins.semi_lookup(rows, views.office_lookup(spark, base), "zip_code").select("member_id", "zip_code")


@query(
    "join_code_label",
    "SELECT l.member_id, l.purpose, p.title AS purpose_title FROM loans l LEFT JOIN purpose_lookup p ON p.purpose = l.purpose",
    ("loans", "purpose_lookup"),
)
def join_code_label(spark, base):
    rows = views.loans(spark, base).select("member_id", "purpose")
    return joins.code_label(rows, lookups.purpose_lookup(spark), "purpose", "title", "purpose_title")


@query(
    "choices_cascade",
    "SELECT office_no AS label, zip_code AS value FROM office_lookup WHERE region IN ('West','South') GROUP BY 1, 2",
    ("office_lookup",),
)
def choices_cascade(spark, base):
    return filters.choices_cascade(views.office_lookup(spark, base), ("West", "South"))


@query(
    "choices_labels",
    "SELECT title AS label, purpose AS value FROM purpose_lookup WHERE purpose IN (SELECT purpose FROM loans)",
    ("loans", "purpose_lookup"),
)
def choices_labels(spark, base):
    return filters.choices_labels(lookups.purpose_lookup(spark), views.loans(spark, base))


@query("agg_principal", "SELECT region, grade, sum(out_prncp) AS out_prncp FROM base GROUP BY region, grade", ("base",))
def agg_principal(spark, base):
    return dashboard.principal(loan_base(views.loans(spark, base)))


@query(
    "agg_principal_chart",
    "SELECT region, grade, coalesce(sum(out_prncp),0) AS out_prncp, round(coalesce(sum(out_prncp),0)/1e6, 6) AS out_prncp_m"
    " FROM picked GROUP BY region, grade",
    ("picked",),
)
def agg_principal_chart(spark, base):
    chart = dashboard.principal_chart(picked(spark, base))
    return chart.withColumn("out_prncp_m", F.round("out_prncp_m", 6))


RISK_SQL = """
WITH totals AS (SELECT region, grade, coalesce(sum(out_prncp),0) AS total FROM picked GROUP BY region, grade)
SELECT p.region, p.grade, round(coalesce(sum(p.out_prncp),0) / nullif(any_value(t.total),0) * 100, 6) AS prncp_per_risk
FROM picked p LEFT JOIN totals t ON t.region = p.region AND t.grade IS NOT DISTINCT FROM p.grade
WHERE p.loan_status IS NULL OR p.loan_status NOT IN ('Current','Fully Paid','Charged Off')
GROUP BY p.region, p.grade
"""


@query("agg_risk_share", RISK_SQL, ("picked",))
def agg_risk_share(spark, base):
    share = dashboard.risk_share(picked(spark, base))
    return share.withColumn("prncp_per_risk", F.round("prncp_per_risk", 6))


TOTAL_SQL = """
SELECT member_id, region, grade, out_prncp, coalesce(sum(out_prncp) OVER (PARTITION BY region, grade), 0) AS region_prncp_total
FROM picked
"""


@query("join_left_totals", TOTAL_SQL, ("picked",))
def join_left_totals(spark, base):
    rows = picked(spark, base).select("member_id", "region", "grade", "out_prncp")
    return joins.with_group_total(rows, ("region", "grade"), F.col("out_prncp"), "region_prncp_total")


@query(
    "win_group_total",
    "SELECT member_id, round(out_prncp / nullif(sum(out_prncp) OVER (PARTITION BY grade), 0), 12) AS share FROM base",
    ("base",),
)
def win_group_total(spark, base):
    rows = loan_base(views.loans(spark, base)).select("member_id", "grade", "out_prncp")
    total = joins.with_group_total(rows, ("grade",), F.col("out_prncp"), "total")
    return total.select("member_id", F.round(F.try_divide("out_prncp", "total"), 12).alias("share"))


@query(
    "kpi_avg_rate",
    r"""SELECT round(m, 6) AS avg_rate, regexp_replace(format('{:.2f}', round_even(m, 2)), '\.?0+$', '') || ' %' AS label
FROM (SELECT avg(try_cast(replace(int_rate,'%','') AS DOUBLE)) AS m FROM picked)""",
    ("picked",),
)
def kpi_avg_rate(spark, base):
    return dashboard.avg_rate(picked(spark, base)).withColumn("avg_rate", F.round("avg_rate", 6))


@query(
    "kpi_median_amount",
    "SELECT m AS median_amt, '$' || format('{:,}', CAST(round_even(m, 0) AS BIGINT)) AS label"
    " FROM (SELECT median(try_cast(loan_amnt AS DOUBLE)) AS m FROM picked)",
    ("picked",),
)
def kpi_median_amount(spark, base):
    return dashboard.median_amount(picked(spark, base))


@query(
    "kpi_avg_tenor",
    r"""SELECT round(m, 6) AS avg_years, regexp_replace(format('{:.2f}', round_even(m, 2)), '\.?0+$', '') || ' years' AS label
FROM (SELECT avg(CASE term WHEN ' 36 months' THEN 36 WHEN ' 60 months' THEN 60 END)/12 AS m FROM picked)""",
    ("picked",),
)
def kpi_avg_tenor(spark, base):
    return dashboard.avg_tenor(picked(spark, base)).withColumn("avg_years", F.round("avg_years", 6))


@query(
    "kpi_row",
    """SELECT count(*) AS loans, round(avg(try_cast(replace(int_rate,'%','') AS DOUBLE)), 6) AS avg_rate,
  round(avg(CASE term WHEN ' 36 months' THEN 36 WHEN ' 60 months' THEN 60 END)/12, 6) AS avg_years,
  median(try_cast(loan_amnt AS DOUBLE)) AS median_amt FROM picked""",
    ("picked",),
)
def kpi_row(spark, base):
    return rounded(dashboard.key_figures(picked(spark, base)), 6, "avg_rate", "avg_years")


DETAIL_SQL = """
SELECT region AS "Region", office_no AS "Office", grade AS "Grade", sub_grade AS "Sub Grade",
  try_cast(loan_amnt AS DOUBLE) AS "Loan Amt", term AS "Term", int_rate AS "Rate", emp_title AS "Emp Title",
  emp_length AS "Emp Length", try_cast(annual_inc AS DOUBLE) AS "Ann Income", loan_status AS "Status",
  title AS "Purpose", addr_state AS "State", out_prncp AS "Principal", member_id
"""


@query("rename_cols", DETAIL_SQL + " FROM picked", ("picked",))
def rename_cols(spark, base):
    return dashboard.detail_rows(picked(spark, base))


@query(
    "limit_flagged",
    DETAIL_SQL + ", (SELECT count(*) > 1000 FROM picked) AS truncated FROM picked ORDER BY member_id LIMIT 1000",
    ("picked",),
)
def limit_flagged(spark, base):
    return dashboard.detail_table(picked(spark, base))


@query(
    "row_slice",
    "SELECT member_id, region, grade FROM base ORDER BY member_id LIMIT 5",
    ("base",),
)
def row_slice(spark, base):
    return filters.row_slice(loan_base(views.loans(spark, base)), "member_id").select("member_id", "region", "grade")


@query(
    "drop_cols",
    "SELECT * EXCLUDE (emp_title, emp_length, title, dti) FROM picked",
    ("picked",),
)
def drop_cols(spark, base):
    return picked(spark, base).drop("emp_title", "emp_length", "title", "dti")


@query(
    "json_encode",
    """SELECT member_id, '{' || '"member_id":' || member_id || ',"purpose":"' || purpose || '","sub_grade":"' || sub_grade || '"}' AS json FROM loans""",
    ("loans",),
)
def json_encode(spark, base):
    return views.loans(spark, base).select("member_id", json_row("member_id", "purpose", "sub_grade").alias("json"))


@query("guard_nonempty", "SELECT member_id, region FROM picked WHERE region = 'South'", ("picked",))
def guard_nonempty(spark, base):
    rows = filters.guard_nonempty(picked(spark, base, Selection(regions=("South",))))
    return rows.select("member_id", "region")


TITLE_COUNT_SQL = """
SELECT p.title, count(l.member_id) AS n FROM purpose_lookup p LEFT JOIN loans l ON l.purpose = p.purpose GROUP BY p.title
"""


@query("src_literal", TITLE_COUNT_SQL, ("loans", "purpose_lookup"))
def src_literal(spark, base):
    """Loans per listed purpose; the counts are joined to the short list, not the loans."""
    counts = views.loans(spark, base).groupBy("purpose").agg(F.count(F.lit(1)).alias("n"))
    listed = lookups.purpose_lookup(spark).join(counts, "purpose", "left")
    return listed.select("title", F.coalesce("n", F.lit(0)).alias("n"))


@query("src_local", TITLE_COUNT_SQL, ("loans", "purpose_lookup"))
def src_local(spark, base):
    """The same over a registered view of local rows and SQL text."""
    tables.register_rows(spark, list(lookups.PURPOSE_TITLES.items()), "purpose string, title string", "purpose_titles")
    return tables.run_sql(
        spark,
        "SELECT t.title, coalesce(c.n, 0) AS n FROM purpose_titles t"
        " LEFT JOIN (SELECT purpose, count(*) AS n FROM {loans} GROUP BY purpose) c ON c.purpose = t.purpose",
        loans=views.loans(spark, base),
    )


# The same figures from a rollup


def rolled_up(spark, base) -> rollup.Rollup:
    """A rollup of the loans, refreshed in two batches, the second of them twice."""
    path, loans = work_path(spark, "rollup"), views.loans(spark, base)
    odd = F.col("member_id") % 2 == 1
    for batch, rows in (("first", loans.where(~odd)), ("second", loans.where(odd)), ("second", loans.where(odd))):
        rollup.append_batch(rows, path, batch)
    return rollup.Rollup(spark, path, views.office_lookup(spark, base))


@query("rollup_principal", "SELECT region, grade, sum(out_prncp) AS out_prncp FROM base GROUP BY region, grade", ("base",))
def rollup_principal(spark, base):
    return rolled_up(spark, base).principal(None)


@query("rollup_risk_share", RISK_SQL, ("picked",))
def rollup_risk_share(spark, base):
    return rolled_up(spark, base).risk_share().withColumn("prncp_per_risk", F.round("prncp_per_risk", 6))


@query(
    "rollup_key_figures",
    """SELECT count(*) AS loans, round(avg(try_cast(replace(int_rate,'%','') AS DOUBLE)), 6) AS avg_rate,
  round(avg(CASE term WHEN ' 36 months' THEN 36 WHEN ' 60 months' THEN 60 END)/12, 6) AS avg_years,
  median(try_cast(loan_amnt AS DOUBLE)) AS median_amt FROM picked WHERE region = 'West' AND purpose IN ('car','house')""",
    ("picked",),
)
def rollup_key_figures(spark, base):
    return rounded(rolled_up(spark, base).key_figures(Selection(regions=("West",), purposes=("car", "house"))), 6, "avg_rate", "avg_years")
