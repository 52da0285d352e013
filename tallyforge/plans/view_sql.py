"""The sample views as SQL text for the DuckDB side of the comparison.

They are written independently of :mod:`tallyforge.sources.views`, which builds the same rows with the
DataFrame API. :func:`with_views` puts the needed ones in front of a query.
"""

from __future__ import annotations

VIEWS = {
    "loans": """
SELECT o_orderkey AS member_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE lpad(CAST((o_orderkey*37) % 1000 AS STRING),3,'0')||'xx' END AS zip_code,
  CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE 'S'||CAST(o_custkey % 50 AS STRING) END AS addr_state,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE substr('ABCDEFG',CAST(1+o_custkey % 7 AS INT),1) END AS grade,
  substr('ABCDEFG',CAST(1+o_custkey % 7 AS INT),1)||CAST(1+o_orderkey % 5 AS STRING) AS sub_grade,
  CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS loan_amnt,
  CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS funded_amnt,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
  CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE CAST(5+o_custkey % 20 AS STRING)||'.'||lpad(CAST(o_orderkey % 100 AS STRING),2,'0')||'%' END AS int_rate,
  'title '||CAST(o_custkey % 30 AS STRING) AS emp_title,
  CAST(o_custkey % 10 AS STRING)||' years' AS emp_length,
  CAST(20000 + (o_custkey*131) % 150000 AS STRING) AS annual_inc,
  CASE WHEN o_orderstatus='F' THEN 'Fully Paid' WHEN o_orderstatus='O' THEN 'Current'
       WHEN o_orderpriority='1-URGENT' THEN 'Charged Off' WHEN o_orderpriority='2-HIGH' THEN 'Late (31-120 days)'
       WHEN o_orderpriority='3-MEDIUM' THEN 'In Grace Period' WHEN o_orderpriority='4-NOT SPECIFIED' THEN NULL ELSE 'Default' END AS loan_status,
  CASE o_orderkey % 13 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'medical' WHEN 2 THEN 'major_purchase' WHEN 3 THEN 'renewable_energy'
       WHEN 4 THEN 'small_business' WHEN 5 THEN 'debt_consolidation' WHEN 6 THEN 'vacation' WHEN 7 THEN 'house' WHEN 8 THEN 'other'
       WHEN 9 THEN 'home_improvement' WHEN 10 THEN 'moving' WHEN 11 THEN 'car' ELSE 'wedding' END AS purpose,
  'loan '||CAST(o_orderkey % 13 AS STRING) AS title,
  CAST(o_custkey % 40 AS STRING) AS dti,
  CASE WHEN o_orderstatus='F' THEN '0' ELSE CAST(CAST(floor(o_totalprice/2) AS BIGINT) AS STRING) END AS out_prncp,
  CASE WHEN o_orderkey % 41 = 0 THEN 'NA' ELSE CAST((o_custkey*7) % 100 AS STRING) END AS bc_util,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST((o_custkey*311) % 50000 AS STRING) END AS bc_open_to_buy,
  CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE CAST((o_orderkey*3) % 110 AS STRING) END AS all_util
FROM orders
""",
    # Titles of the purpose codes.
    "purpose_lookup": """
SELECT * FROM (SELECT * FROM (VALUES ('credit_card','Credit card refinancing'),('medical','Medical expenses'),('major_purchase','Major purchase'),
 ('renewable_energy','Green loan'),('small_business','Business'),('debt_consolidation','Debt consolidation'),('vacation','Vacation'),
 ('house','Home buying'),('other','Other'),('home_improvement','Home improvement'),('moving','Moving and relocation'),
 ('car','Car financing'),(NULL,NULL)) AS v(purpose,title)) WHERE purpose IS NOT NULL
""",
    "office_lookup": """
WITH z AS (SELECT DISTINCT zip_code, CAST(substr(zip_code,1,3) AS INT) AS n FROM loans WHERE zip_code IS NOT NULL)
SELECT CASE WHEN n >= 800 THEN 'West' WHEN n >= 700 THEN 'South' WHEN n >= 400 THEN 'Midwest' WHEN n >= 200 THEN 'South' ELSE 'East' END AS region,
       zip_code, substr(zip_code,1,3) AS office_no FROM z WHERE n % 50 <> 0
UNION ALL
SELECT CASE WHEN n >= 800 THEN 'East' WHEN n >= 400 AND n < 700 THEN 'South' ELSE 'West' END, zip_code, substr(zip_code,1,3)
FROM z WHERE n % 50 <> 0 AND n % 12 = 0
""",
    "wine": """
SELECT o_orderkey AS wine_id, CASE WHEN o_orderstatus='F' THEN 'red' ELSE 'white' END AS color,
  o_totalprice/CAST(100000 AS DOUBLE) AS alcohol,
  CAST(o_custkey % 97 AS DOUBLE)/CAST(10 AS DOUBLE) AS ph,
  CAST(extract(month FROM o_orderdate) AS DOUBLE) AS sulphates,
  CAST(o_custkey % 53 AS DOUBLE)/CAST(10 AS DOUBLE) AS fixed_acidity,
  CAST(o_orderkey % 31 AS DOUBLE)/CAST(20 AS DOUBLE) AS volatile_acidity,
  CASE WHEN o_orderkey % 59 <> 0 THEN CAST(o_custkey % 13 AS DOUBLE)/CAST(15 AS DOUBLE) END AS citric_acid,
  CAST(o_orderkey % 101 AS DOUBLE)/CAST(7 AS DOUBLE) AS residual_sugar,
  CAST(o_custkey % 7 AS DOUBLE)/CAST(70 AS DOUBLE) AS chlorides,
  CAST(o_orderkey % 61 AS DOUBLE) AS free_so2,
  CAST(o_custkey % 41 AS DOUBLE) AS total_so2,
  CAST(0.99 AS DOUBLE) + CAST(o_orderkey % 17 AS DOUBLE)/CAST(1000 AS DOUBLE) AS density,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 END AS cellar,
  CAST(3 + floor(o_totalprice/CAST(100000 AS DOUBLE)) + o_custkey % 2 AS INT) AS quality
FROM orders
""",
    "partsupp": """
SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey,
  CAST((l_partkey*7 + l_suppkey*13) % 1000 AS DOUBLE)/CAST(10 AS DOUBLE) AS ps_supplycost
FROM lineitem
""",
    "iris_like": """
SELECT p_partkey AS id, p_type AS species, CAST(p_size AS DOUBLE)/CAST(10 AS DOUBLE) AS sepal_width,
  p_retailprice/CAST(100 AS DOUBLE) AS sepal_length FROM part
""",
    "breast_like": "SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {name}" for i, name in enumerate(("mean_radius", "mean_texture", "mean_area", *(f"measure_{i}" for i in range(3, 64)))))
    + ", label % 2 AS target FROM embeddings",
    "kidney_like": """
SELECT o_orderkey AS id, o_custkey AS patient, o_totalprice/CAST(1000 AS DOUBLE) AS time,
  CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS censored, CAST(20 + o_custkey % 60 AS INT) AS age,
  CASE WHEN o_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
  CASE o_orderkey % 5 WHEN 0 THEN 'GN' WHEN 1 THEN 'AN' WHEN 2 THEN 'PKD' ELSE 'other' END AS disease
FROM orders
""",
    "draws": """
SELECT o_orderkey % 4 AS chain, CAST(floor(o_orderkey/32) AS BIGINT) AS iter,
  CAST(floor(o_orderkey/4) AS BIGINT) % 8 AS param, o_totalprice/CAST(10000 AS DOUBLE) AS value FROM orders
""",
    "loglik": """
SELECT o_orderkey % 50 AS draw, CAST(floor(o_orderkey/50) AS BIGINT) AS obs, -o_totalprice/CAST(100000 AS DOUBLE) AS ll FROM orders
""",
    "base": """
SELECT * FROM (
  SELECT member_id,
    CASE WHEN substr(zip_code,1,1) IN ('8','9') THEN 'West' WHEN substr(zip_code,1,1) IN ('6','5','4') THEN 'Midwest'
         WHEN substr(zip_code,1,1) IN ('7','3','2') THEN 'South' WHEN substr(zip_code,1,1) IN ('1','0') THEN 'East' END AS region,
    grade, sub_grade, loan_amnt, funded_amnt, term, int_rate, emp_title, emp_length, annual_inc, loan_status,
    purpose, title, zip_code, addr_state, dti, try_cast(out_prncp AS DOUBLE) AS out_prncp, substr(zip_code,1,3) AS office_no
  FROM loans WHERE addr_state IS NOT NULL) WHERE region IS NOT NULL
""",
    "picked": """
SELECT * FROM base
WHERE zip_code IN (SELECT zip_code FROM office_lookup) AND purpose IN (SELECT purpose FROM purpose_lookup)
  AND sub_grade IN (SELECT g || CAST(s AS STRING) FROM (SELECT unnest(['A','B','C','D','E','F','G']) AS g) AS gs, (SELECT unnest([1,2,3,4,5]) AS s) AS ss)
""",
    "customer_effects": """
SELECT id, y, sqrt(CASE WHEN v > 0 THEN v ELSE sum((n - 1) * v) OVER () / sum(CASE WHEN v IS NOT NULL THEN n - 1 END) OVER () END / n) AS sigma
FROM (SELECT o_custkey AS id, avg(o_totalprice/1000.0) AS y, var_samp(o_totalprice/1000.0) AS v, count(*) AS n FROM orders GROUP BY o_custkey)
""",
}

NEEDS = {"office_lookup": ["loans"], "base": ["loans"], "picked": ["base", "office_lookup", "purpose_lookup"]}


def with_views(sql: str, views: tuple[str, ...]) -> str:
    """``sql`` with the named views, and those they need, as leading common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return sql.strip()
    heads = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads}, {body[15:]}"
    return f"WITH {heads}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {heads} {body}"
