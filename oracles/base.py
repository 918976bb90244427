"""Shared CTEs: the derived applications, tradelines and model frame, and output rounding."""

K = "application_id, customer_id"

APP = """
app AS (
  SELECT 'APP_' || app_no AS application_id, 'CUST_' || c_custkey AS customer_id,
         CASE WHEN c_custkey % 14 = 1 THEN 'CO_APPLICANT' ELSE 'PRIMARY' END AS applicant_type,
         CAST(DATE '1999-01-01' + CAST((app_no * 37) % 900 AS INTEGER) AS DATE) AS application_date,
         CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS target
  FROM (SELECT *, CASE WHEN c_custkey % 14 = 1 THEN c_custkey - 1 ELSE c_custkey END AS app_no
        FROM customer)
)"""

BUR = """
bur0 AS (
  SELECT 'APP_' || app_no AS application_id, 'CUST_' || o_custkey AS customer_id,
         o_orderkey AS tradeline_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'CASH_FACILITY' WHEN '2-HIGH' THEN 'INSTALLMENT_LOAN'
              WHEN '3-MEDIUM' THEN 'INSTALLMENT_SALE' WHEN '4-NOT SPECIFIED' THEN 'MORTGAGE'
              ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'NON_AUTH_OVERDRAFT' ELSE 'OVERLIMIT' END
         END AS product_type,
         round(o_totalprice) AS total_amount,
         CAST(o_orderdate AS DATE) AS opening_date,
         CAST(DATE '1999-01-01' + CAST((app_no * 37) % 900 AS INTEGER) AS DATE) AS ref,
         o_orderstatus, o_orderpriority
  FROM (SELECT *, CASE WHEN o_custkey % 14 = 1 THEN o_custkey - 1 ELSE o_custkey END AS app_no
        FROM orders)
),
bur1 AS (
  SELECT *, CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
                  AND opening_date + CAST(30 + tradeline_id % 335 AS INTEGER) <= ref
                 THEN CAST(opening_date + CAST(30 + tradeline_id % 335 AS INTEGER) AS DATE) END AS default_date
  FROM bur0 WHERE opening_date <= ref + 30
),
bur AS (
  SELECT application_id, customer_id, tradeline_id, product_type, total_amount, opening_date, default_date,
         CASE WHEN default_date IS NOT NULL AND tradeline_id % 2 = 0
               AND default_date + CAST(30 + tradeline_id % 200 AS INTEGER) <= ref
              THEN CAST(default_date + CAST(30 + tradeline_id % 200 AS INTEGER) AS DATE) END AS recovery_date,
         duration_months, total_amount / duration_months AS monthly_payment,
         CASE WHEN o_orderstatus = 'O' AND tradeline_id % 5 = 0 AND default_date IS NULL
              THEN CAST(ref - CAST(tradeline_id % 90 AS INTEGER) AS DATE) END AS closure_date
  FROM (SELECT *, CASE WHEN product_type IN ('INSTALLMENT_LOAN', 'INSTALLMENT_SALE', 'MORTGAGE')
                       THEN CAST(12 + tradeline_id % 100 AS INTEGER) END AS duration_months FROM bur1)
)"""

# credit tradelines with their measures
T = """
t AS (
  SELECT b.application_id, b.customer_id, a.application_date AS ref, product_type AS product,
         CASE product_type WHEN 'INSTALLMENT_LOAN' THEN 'il' WHEN 'INSTALLMENT_SALE' THEN 'is'
              WHEN 'CASH_FACILITY' THEN 'cf' WHEN 'MORTGAGE' THEN 'mg' END AS p,
         total_amount AS amt, opening_date AS opening, default_date AS dflt, recovery_date AS rec,
         closure_date AS closure, duration_months AS duration, monthly_payment AS payment,
         tradeline_id AS tid, a.application_date - opening_date AS age_d,
         (a.application_date - opening_date) / 30.44 AS age_m,
         default_date - opening_date AS ttd, recovery_date - default_date AS rec_d
  FROM bur b JOIN app a USING (application_id, customer_id)
  WHERE product_type NOT IN ('NON_AUTH_OVERDRAFT', 'OVERLIMIT')
)"""

# the same in opening order
S = f"""
s AS (
  SELECT t.*, count(*) OVER w AS n, row_number() OVER o AS rn, opening - lag(opening) OVER o AS gap,
         lag(p) OVER o AS prev_p
  FROM t WINDOW w AS (PARTITION BY {K}), o AS (PARTITION BY {K} ORDER BY opening, amt, product, tid)
)"""

MODEL = """
lines AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty,
         round(avg(l_discount), 6) AS avg_discount, round(avg(l_tax), 6) AS avg_tax,
         round(sum(l_extendedprice), 2) AS sum_price
  FROM lineitem GROUP BY 1
),
m0 AS (
  SELECT o_orderkey AS uid, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target, c_mktsegment AS segment,
         o_totalprice, c_acctbal, n_lines, sum_qty, avg_discount, avg_tax, sum_price,
         CAST(1 AS DOUBLE) AS const_1,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END * (o_orderkey % 7) + o_orderkey % 11 AS DOUBLE) AS signal
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = l_orderkey
),
m AS (
  SELECT *, (signal + 1) / 20.0::DOUBLE AS score,
         year(date) || 'Q' || quarter(date) AS quarter,
         CAST('0x' || substr(md5(uid || '|42'), 1, 15) AS BIGINT) AS h
  FROM m0
),
strat AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY h, uid) AS hr, count(*) OVER (PARTITION BY target) AS hn
  FROM m WHERE date <= DATE '2000-06-30'
),
sp AS (
  SELECT * EXCLUDE (hr, hn), CASE WHEN hr <= floor(hn * 0.2::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM strat
  UNION ALL
  SELECT *, 'oot_' || quarter AS split FROM m WHERE date > DATE '2000-06-30'
)"""

FEATURES = ["o_totalprice", "c_acctbal", "n_lines", "sum_qty", "avg_discount", "avg_tax",
            "sum_price", "const_1", "signal"]


def long(source: str = "m", keep: str = "uid, target", features=FEATURES) -> str:
    """Long form of the model frame as a CTE body."""
    return " UNION ALL ".join(
        f"SELECT {keep}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source}" for f in features
    )


def rnd(x: str) -> str:
    """Six decimals for small values, two for large ones (off the decimal ties); no negative zero."""
    return f"CASE WHEN abs({x}) < 1000 THEN round({x}, 6) ELSE round({x} + 0.00137::DOUBLE, 2) END + 0.0::DOUBLE"


def out(body: str, doubles: list[str], others: list[str], ctes: list[str]) -> str:
    """Full statement: CTEs, body as the last one, doubles rounded, other columns as they are."""
    cols = [f"{c}" for c in others] + [f"{rnd(f'CAST({c} AS DOUBLE)')} AS {c}" for c in doubles]
    return f"WITH {', '.join(ctes)}, res AS ({body}) SELECT {', '.join(cols)} FROM res"
