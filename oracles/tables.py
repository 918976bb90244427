"""Sources, joins, the compact feature set and data quality."""

from oracles.base import APP, BUR, FEATURES, K, MODEL, T, long, out
from oracles.families import div0, flag, z

PRODUCTS = ["INSTALLMENT_LOAN", "INSTALLMENT_SALE", "CASH_FACILITY", "MORTGAGE"]
CREDIT = "product_type NOT IN ('NON_AUTH_OVERDRAFT', 'OVERLIMIT')"


def _extractor() -> dict[str, str]:
    age = """CASE WHEN day(application_date) = day(opening_date)
        OR (application_date = last_day(application_date) AND opening_date = last_day(opening_date))
      THEN CAST((year(application_date) - year(opening_date)) * 12 + month(application_date) - month(opening_date) AS DOUBLE)
      ELSE round((year(application_date) - year(opening_date)) * 12 + month(application_date) - month(opening_date)
        + (day(application_date) - day(opening_date)) / 31.0::DOUBLE, 8) END"""
    x = f"x AS (SELECT b.*, application_date, {CREDIT} AS cr, {age} AS age FROM bur b JOIN app USING ({K}))"
    m = {
        "total_credit_amount": "sum(total_amount) FILTER (cr)", "avg_credit_amount": "avg(total_amount) FILTER (cr)",
        "max_credit_amount": "max(total_amount) FILTER (cr)", "min_credit_amount": "min(total_amount) FILTER (cr)",
        "std_credit_amount": "stddev_samp(total_amount) FILTER (cr)", "total_exposure": "sum(total_amount)",
        "total_credit_count": "count(*) FILTER (cr)", "distinct_product_count": "count(DISTINCT product_type) FILTER (cr)",
        "active_credit_count": "count(*) FILTER (cr AND default_date IS NULL)",
        "defaulted_credit_count": "count(*) FILTER (cr AND default_date IS NOT NULL AND recovery_date IS NULL)",
        "recovered_credit_count": "count(recovery_date) FILTER (cr)", "ever_defaulted_count": "count(default_date) FILTER (cr)",
        "total_record_count": "count(*)",
        "total_defaulted_amount": "sum(total_amount) FILTER (cr AND default_date IS NOT NULL AND recovery_date IS NULL)",
        "oldest_credit_age_months": "max(age) FILTER (cr)", "newest_credit_age_months": "min(age) FILTER (cr)",
        "avg_credit_age_months": "avg(age) FILTER (cr)",
        "avg_time_to_default_days": "avg(default_date - opening_date) FILTER (cr)",
        "avg_recovery_time_days": "avg(recovery_date - default_date) FILTER (cr)",
        "days_since_last_default": "min(application_date - default_date) FILTER (cr)",
        "non_auth_overdraft_count": "count(*) FILTER (product_type = 'NON_AUTH_OVERDRAFT')",
        "non_auth_overdraft_amount": "sum(total_amount) FILTER (product_type = 'NON_AUTH_OVERDRAFT')",
        "overlimit_count": "count(*) FILTER (product_type = 'OVERLIMIT')",
        "overlimit_amount": "sum(total_amount) FILTER (product_type = 'OVERLIMIT')",
    }
    for p in PRODUCTS:
        m[f"{p}_count"] = f"count(*) FILTER (product_type = '{p}')"
        m[f"{p}_total_amount"] = f"sum(total_amount) FILTER (product_type = '{p}')"
        m[f"{p}_avg_amount"] = f"avg(total_amount) FILTER (product_type = '{p}')"
        m[f"{p}_default_count"] = f"count(default_date) FILTER (product_type = '{p}')"
    for n in (3, 6, 12, 24):
        m[f"credits_opened_last_{n}m"] = f"count(*) FILTER (cr AND age <= {n})"
        m[f"amount_opened_last_{n}m"] = f"sum(total_amount) FILTER (cr AND age <= {n})"
        m[f"defaults_last_{n}m"] = f"count(default_date) FILTER (cr AND age <= {n})"
        m[f"overdraft_events_last_{n}m"] = f"count(*) FILTER (NOT cr AND age <= {n})"
    n, total = "total_credit_count", "total_credit_amount"
    d = {
        "has_current_default": flag("defaulted_credit_count > 0"), "has_ever_defaulted": flag("ever_defaulted_count > 0"),
        "has_non_auth_overdraft": flag("non_auth_overdraft_count > 0"), "has_overlimit": flag("overlimit_count > 0"),
        "financial_stress_flag": flag("non_auth_overdraft_count + overlimit_count > 0"),
        "default_ratio": div0("defaulted_credit_count", n), "recovery_ratio": div0("recovered_credit_count", "ever_defaulted_count"),
        "default_amount_ratio": div0("total_defaulted_amount", total), "secured_ratio": div0("MORTGAGE_count", n),
        "revolving_ratio": div0("CASH_FACILITY_count", n), "high_risk_product_ratio": div0("INSTALLMENT_SALE_count", n),
        "credit_velocity": div0("credits_opened_last_3m", n), "amount_velocity": div0("amount_opened_last_3m", total),
        "product_diversity_ratio": "distinct_product_count / 4.0::DOUBLE", "credit_history_length_months": "oldest_credit_age_months",
        "credit_count_trend_6m_vs_12m": "2 * credits_opened_last_6m - credits_opened_last_12m",
        "credit_amount_trend_6m_vs_12m": "2 * amount_opened_last_6m - amount_opened_last_12m",
        "default_trend_6m_vs_12m": "2 * defaults_last_6m - defaults_last_12m",
    }
    for p in PRODUCTS:
        d[f"{p}_ratio"] = div0(f"{p}_count", n)
        d[f"{p}_amount_ratio"] = div0(f"{p}_total_amount", total)
    groups = {
        "x1_amounts": ["total_credit_amount", "avg_credit_amount", "max_credit_amount", "min_credit_amount",
                       "std_credit_amount", "total_exposure"],
        "x2_counts": ["total_credit_count", "distinct_product_count", "active_credit_count", "defaulted_credit_count",
                      "recovered_credit_count", "ever_defaulted_count", "total_record_count"],
        "x3_products": [f"{p}_{s}" for p in PRODUCTS for s in ("count", "total_amount", "avg_amount", "default_count")],
        "x4_defaulted": ["total_defaulted_amount"],
        "x5_temporal": ["oldest_credit_age_months", "newest_credit_age_months", "avg_credit_age_months",
                        "avg_time_to_default_days", "days_since_last_default"],
        "x6_periods": [f"{s}_last_{k}m" for k in (3, 6, 12, 24)
                       for s in ("credits_opened", "amount_opened", "defaults", "overdraft_events")],
        "x7_non_credit": ["non_auth_overdraft_count", "non_auth_overdraft_amount", "overlimit_count", "overlimit_amount"],
        "x8_derived": list(d),
        "x9_recovery_time": ["avg_recovery_time_days"],
    }
    g = f"g AS (SELECT app.application_id, app.customer_id, {', '.join(f'{z(k)} AS {k}' for k in m)} FROM app LEFT JOIN (SELECT {K}, {', '.join(f'{e} AS {k}' for k, e in m.items())} FROM x GROUP BY ALL) USING ({K}))"
    return {
        name: out(f"SELECT {K}, {', '.join(f'{d.get(k, k)} AS {k}' for k in cols)} FROM g", cols, K.split(", "), [APP, BUR, x, g])
        for name, cols in groups.items()
    }


def _check(name, kind, severity, observed, threshold):
    return (f"SELECT '{name}' AS check_name, '{kind}' AS check_type, '{severity}' AS severity, ({observed}) <= {threshold} AS passed, "
            f"CAST(({observed}) AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold")


def _checks(parts, ctes):
    return out(" UNION ALL ".join(parts), ["observed", "threshold"], ["check_name", "check_type", "severity", "passed"], ctes)


def oracles() -> dict[str, str]:
    q = _extractor()
    AB = [APP, BUR]
    q["f36_reconciliation"] = f"""WITH {APP} SELECT count(*) AS output_rows, count(DISTINCT {K.replace(', ', " || '||' || ")}) AS distinct_uids,
        CAST(0 AS BIGINT) AS null_uids, CAST(0 AS BIGINT) AS null_application_ids, CAST(0 AS BIGINT) AS null_customer_ids,
        CAST(0 AS BIGINT) AS all_null_rows, count(*) AS input_rows, CAST(0 AS BIGINT) AS lost_rows, TRUE AS unique_uids FROM app"""
    q["s1_file_scan"] = out("SELECT * FROM customer", ["c_acctbal"], ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], ["one AS (SELECT 1)"])
    q["s2_pruned_scan"] = out("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'", ["o_totalprice"], ["o_orderkey"], ["one AS (SELECT 1)"])
    q["s3_value_list"] = out("""SELECT tradeline_id, total_amount FROM bur WHERE product_type IN ('MORTGAGE', 'CASH_FACILITY')
        AND application_id IN (SELECT application_id FROM app WHERE target = 1)""", ["total_amount"], ["tradeline_id"], AB)
    q["s4_date_range"] = f"""WITH {BUR} SELECT tradeline_id, opening_date FROM bur WHERE total_amount > 50000
        AND opening_date >= DATE '1997-01-01' AND opening_date <= DATE '1998-06-30'"""
    q["s5_named_readers"] = f"""WITH {APP}, {BUR} SELECT tradeline_id, {K} FROM bur WHERE application_id IN
        (SELECT application_id FROM app WHERE application_date BETWEEN DATE '1999-06-01' AND DATE '1999-12-31')"""
    q["s6_renamed_columns"] = f"WITH {APP} SELECT application_id AS app, customer_id FROM app"
    q["s7_split_joined"] = f"""WITH {APP}, {BUR} SELECT {K}, application_date, target, tradelines FROM app
        LEFT JOIN (SELECT {K}, count(*) AS tradelines FROM bur GROUP BY ALL) USING ({K})"""
    q["s8_partitioned_write"] = out("SELECT product_type, count(*) AS n, sum(total_amount) AS amount FROM bur GROUP BY 1", ["amount"], ["product_type", "n"], [BUR])
    q["p1_credit_split"] = f"WITH {BUR} SELECT tradeline_id, CASE WHEN {CREDIT} THEN 'credit' ELSE 'signal' END AS kind FROM bur"
    q["p2_dimension_filter"] = f"""WITH {APP}, {BUR}, {T} SELECT tid, amt FROM t WHERE p = 'cf' AND dflt IS NOT NULL
        AND opening >= CAST(ref - INTERVAL 24 MONTH AS DATE)"""
    cols = ["application_id", "customer_id", "tradeline_id", "product_type", "total_amount", "opening_date", "default_date",
            "recovery_date", "duration_months", "monthly_payment", "closure_date"]
    extra = {"tradeline_id", "duration_months", "monthly_payment", "closure_date"}
    q["p3_schema_issues"] = out(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_ratio, "
        f"count({c}) AS non_null_count, {chr(39) + 'extra' + chr(39) if c in extra else 'NULL'} AS issue FROM bur" for c in cols),
        ["null_ratio"], ['"column"', "null_count", "non_null_count", "issue"], [BUR])
    q["p5_date_coercion"] = "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS opening_date FROM orders"
    kept = [f for f in FEATURES if f != "const_1"]
    q["p7_kept_columns"] = out(f"SELECT uid, {', '.join(kept)} FROM m", kept, ["uid"], [MODEL])
    q["j1_applicants_with_tradelines"] = out(f"SELECT app.application_id, app.customer_id, tradeline_id, total_amount FROM app LEFT JOIN bur USING ({K})",
                                             ["total_amount"], [*K.split(", "), "tradeline_id"], AB)
    q["j2_dated_tradelines"] = f"WITH {APP}, {BUR} SELECT tradeline_id, application_date FROM bur JOIN app USING ({K})"
    q["j3_full_outer_groups"] = f"""WITH {BUR} SELECT {K}, count(*) FILTER ({CREDIT}) AS credits, count(*) FILTER (NOT ({CREDIT})) AS signals FROM bur GROUP BY ALL"""
    q["j4_restored_target"] = f"""WITH {APP}, {BUR} SELECT app.*, COALESCE(credits, 0) AS credits FROM app LEFT JOIN
        (SELECT {K}, count(*) AS credits FROM bur WHERE {CREDIT} GROUP BY ALL) USING ({K})"""
    q["j5_orphans"] = f"""WITH {APP}, {BUR} SELECT tradeline_id FROM bur b WHERE NOT EXISTS (SELECT 1 FROM app a WHERE a.target = 0
        AND a.application_id = b.application_id AND a.customer_id = b.customer_id)"""
    q["u1_combined_oot"] = f"""WITH {MODEL} SELECT CASE WHEN split LIKE 'oot%' THEN 'oot' ELSE split END AS period, count(*) AS n,
        CAST(sum(target) AS BIGINT) AS bads FROM sp GROUP BY 1"""
    q["u2_first_per_uid"] = f"WITH {APP} SELECT application_id || '||' || customer_id AS uid, application_date, target FROM app"
    q["u3_exact_dedup"] = f"WITH {BUR} SELECT tradeline_id, product_type FROM bur"
    q["u4_invalid_values"] = f"WITH {BUR} SELECT DISTINCT product_type FROM bur WHERE product_type <> 'MORTGAGE' ORDER BY 1 LIMIT 5"
    q["t1_ordered_tradelines"] = f"""WITH {APP}, {BUR}, {T} SELECT tid, row_number() OVER (PARTITION BY {K} ORDER BY opening, amt, product, tid) AS position FROM t"""
    q["t2_top_values"] = """SELECT l_partkey AS value, count(*) AS n, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS cardinality
        FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
    q["q1_null_checks"] = _checks([_check(f"null_{c}", "null", "error", f"SELECT (count(*) - count({c})) / CAST(count(*) AS DOUBLE) FROM bur", t)
                                   for c, t in (("product_type", 0), ("default_date", 0.5), ("closure_date", 0.99))], [BUR])
    q["q2_range_checks"] = _checks([
        _check("range_total_amount", "range", "warning", "SELECT count(*) FROM bur WHERE total_amount < 0 OR total_amount > 100000000", 0),
        _check("range_duration_months", "range", "warning", "SELECT count(*) FROM bur WHERE duration_months < 24 OR duration_months > 100", 0)], [BUR])
    q["q3_allowed_values"] = _checks([
        _check("allowed_product_type", "allowed", "error", f"SELECT count(*) FROM app JOIN bur USING ({K}) WHERE NOT ({CREDIT})", 0),
        _check("allowed_applicant_type", "allowed", "error", "SELECT count(*) FROM app WHERE applicant_type NOT IN ('PRIMARY', 'CO_APPLICANT')", 0)], AB)
    q["q4_duplicates"] = _checks([_check("duplicate_rows", "duplicate", "warning",
        f"SELECT 1 - CAST((SELECT count(*) FROM (SELECT DISTINCT {K}, product_type FROM bur)) AS DOUBLE) / count(*) FROM bur", 0.01)], [BUR])
    dated = f"d AS (SELECT * FROM bur JOIN app USING ({K}))"
    bad = lambda c: f"SELECT count(*) FILTER (NOT ({c})) / CAST(count(*) AS DOUBLE) FROM d"
    q["q5_date_rules"] = _checks([
        _check("opening_date_before_application", "date", "error", bad("opening_date <= application_date"), 0.01),
        _check("default_after_opening", "date", "error", bad("default_date IS NULL OR default_date >= opening_date"), 0.001),
        _check("recovery_after_default", "date", "error", bad("recovery_date IS NULL OR (default_date IS NOT NULL AND recovery_date >= default_date)"), 0.001)], [*AB, dated])
    rep = lambda t, c: f"SELECT count(*) FROM (SELECT {c} FROM {t} GROUP BY ALL HAVING count(*) > 1)"
    q["q6_uniqueness"] = _checks([_check("unique_application_id_customer_id", "uniqueness", "error", rep("app", K), 0),
                                  _check("unique_application_id", "uniqueness", "error", rep("bur", "application_id"), 0)], AB)
    q["q7_report"] = f"""WITH {BUR} SELECT CAST(5 AS BIGINT) AS checks, CAST(0 AS BIGINT) AS errors,
        CAST(CASE WHEN count(*) FILTER (duration_months < 24 OR duration_months > 100) > 0 THEN 1 ELSE 0 END AS BIGINT) AS warnings, TRUE AS passed FROM bur"""
    def o(c):
        return f"""SELECT '{c}' AS feature, count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
          count(*) FILTER (abs({c} - mean) > 2 * sd) AS z_outliers, count({c}) AS n FROM bur,
          (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, avg({c}) AS mean, stddev_samp({c}) AS sd FROM bur)"""
    q["q12_outliers"] = f"WITH {BUR} {o('total_amount')} UNION ALL {o('monthly_payment')}"
    from oracles.families import TEMPORAL, temporal_body

    unit = lambda f: "months" if f.endswith("_months") else "days" if f.endswith("_days") else "numeric"
    names = list(TEMPORAL[1])
    tl = "tl AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, target, CAST({f} AS DOUBLE) AS value FROM tmp" for f in names) + ")"
    # five bins between the quantiles, half a row added to each side
    g, b = "(good + 0.5::DOUBLE) / (goods + 0.5::DOUBLE)", "(bad + 0.5::DOUBLE) / (bads + 0.5::DOUBLE)"
    tiv = f"""ti AS (SELECT feature, sum(CASE WHEN goods > 0 AND bads > 0 THEN ({g} - {b}) * ln(({g}) / ({b})) END) AS iv FROM (
        SELECT *, sum(good) OVER (PARTITION BY feature) AS goods, sum(bad) OVER (PARTITION BY feature) AS bads FROM (
          SELECT feature, len(list_filter(q, lambda e: e < value)) AS bin, count(*) FILTER (target = 0) AS good, count(*) FILTER (target = 1) AS bad
          FROM tl JOIN (SELECT feature, quantile_cont(value, [0.2, 0.4, 0.6, 0.8]) AS q FROM tl GROUP BY 1) USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2)) GROUP BY 1)"""
    cat = ("CASE WHEN iv IS NULL THEN 'unknown' WHEN iv < 0.02 THEN 'useless' WHEN iv < 0.10 THEN 'weak' WHEN iv < 0.30 THEN 'medium' "
           "WHEN iv < 0.50 THEN 'strong' ELSE 'suspicious' END")
    q["q15_data_dictionary"] = out(f"""SELECT feature, count(value) AS n, count(*) - count(value) AS nulls, (count(*) - count(value)) / CAST(count(*) AS DOUBLE) AS null_ratio,
          count(DISTINCT value) AS distinct_n, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_samp(value) AS std, var_samp(value) AS variance,
          {', '.join(f'quantile_cont(value, {x}) AS p{k}' for x, k in ((0.25, 25), (0.5, 50), (0.75, 75), (0.95, 95), (0.99, 99)))},
          any_value(iv) AS iv, any_value({cat}) AS iv_category, 'temporal_feature' AS category,
          CASE {' '.join(f"WHEN feature = '{f}' THEN '{unit(f)}'" for f in names)} END AS unit, TRUE AS has_formula FROM tl LEFT JOIN ti USING (feature) GROUP BY 1""",
        ["null_ratio", "min", "max", "mean", "std", "variance", "p25", "p50", "p75", "p95", "p99", "iv"],
        ["feature", "n", "nulls", "distinct_n", "iv_category", "category", "unit", "has_formula"], [APP, BUR, T, f"tmp AS ({temporal_body()})", tl, tiv])
    lf = f"l AS ({long()})"
    u = "SELECT feature, max(greatest(a, 1 - a)) AS a, max(n) AS n FROM au GROUP BY 1"
    au = """au AS (SELECT feature, (sum(r) FILTER (target = 1) - count(*) FILTER (target = 1) * (count(*) FILTER (target = 1) + 1) / 2.0::DOUBLE)
        / (CAST(count(*) FILTER (target = 1) AS DOUBLE) * count(*) FILTER (target = 0)) AS a, count(*) AS n
      FROM (SELECT feature, target, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS r
            FROM l WHERE value IS NOT NULL) GROUP BY 1)"""
    rows = [
        ("non_empty", "CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END", "critical"), ("target_exists", "'PASS'", "critical"),
        ("target_binary", "'PASS'", "critical"), ("target_no_nulls", "'PASS'", "critical"),
        ("bad_rate_range", "CASE WHEN r < 0.01 OR r > 0.5 THEN 'FAIL' WHEN r < 0.03 OR r > 0.4 THEN 'WARNING' ELSE 'PASS' END", "warning"),
        ("date_exists", "'PASS'", "critical"), ("date_coverage", "CASE WHEN k < 2 THEN 'FAIL' ELSE 'PASS' END", "critical"),
        ("features_numeric", "'PASS'", "warning"), ("duplicate_ids", "CASE WHEN dup > 0 THEN 'WARNING' ELSE 'PASS' END", "warning"),
        ("sample_size", "CASE WHEN n < 500 THEN 'WARNING' ELSE 'PASS' END", "warning"),
        ("leakage", f"CASE WHEN (SELECT count(*) FROM ({u}) WHERE a > 0.95 AND n >= 50) > 0 THEN 'WARNING' ELSE 'PASS' END", "warning"),
    ]
    base = "(SELECT count(*) AS n, avg(target) AS r, count(DISTINCT quarter) AS k, count(*) - count(DISTINCT uid) AS dup FROM m)"
    q["q13_pre_model_checks"] = f"WITH {MODEL}, {lf}, {au} " + " UNION ALL ".join(
        f"SELECT '{a}' AS check_name, {b} AS status, '{s}' AS severity FROM {base}" for a, b, s in rows)
    return q
