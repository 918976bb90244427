"""Feature families."""

from oracles.base import APP, BUR, K, S, T, out

P = {"il": "installment_loan", "is": "installment_sale", "cf": "cash_facility", "mg": "mortgage"}
N0 = "COALESCE(n, 0)"


def z(x):
    return f"COALESCE({x}, 0)"


def div(a, b):
    return f"CASE WHEN ({b}) <> 0 THEN CAST(({a}) AS DOUBLE) / ({b}) END"


def div0(a, b):
    return f"COALESCE({div(a, b)}, 0)"


def flag(x):
    return f"CASE WHEN {x} THEN 1 ELSE 0 END"


def family(aggs: dict, cols: dict, source: str = "t", extra: tuple = (), joins: str = "", app: str = "app") -> str:
    """app LEFT JOIN (aggregates per applicant), then the feature expressions."""
    inner = ", ".join(f"{e} AS {k}" for k, e in aggs.items())
    body = (
        f"SELECT app.application_id, app.customer_id, {', '.join(f'{e} AS {k}' for k, e in cols.items())} "
        f"FROM app LEFT JOIN (SELECT {K}, {inner} FROM {source} GROUP BY ALL) g USING ({K}) {joins}"
    )
    return out(body, list(cols), K.split(", "), [APP, BUR, T, S, *extra])


def temporal_body() -> str:
    """The temporal features, unrounded."""
    inner = ", ".join(f"{e} AS {k}" for k, e in TEMPORAL[0].items())
    cols = ", ".join(f"{e} AS {k}" for k, e in TEMPORAL[1].items())
    return f"SELECT app.application_id, app.customer_id, target, {cols} FROM app LEFT JOIN (SELECT {K}, {inner} FROM t GROUP BY ALL) g USING ({K})"


TEMPORAL = (
    {"o": "max(age_m)", "w": "min(age_m)", "a": "CAST(sum(age_d) AS DOUBLE) / count(age_d) / 30.44::DOUBLE", "sd": "min(ref - dflt)", "sc": "min(age_d)", "t1": "avg(ttd)", "r1": "avg(rec_d)"},
    {"oldest_credit_age_months": "o", "newest_credit_age_months": "w", "avg_credit_age_months": "a",
     "credit_history_length_months": z("o"),
     "days_since_last_default": "CASE WHEN sd < 0 THEN 0 ELSE sd END",
     "days_since_last_credit": "CASE WHEN sc < 0 THEN 0 ELSE sc END",
     "avg_time_to_default_days": "t1", "avg_recovery_time_days": "r1"})


def W(m):
    return f"opening >= CAST(ref - INTERVAL {m} MONTH AS DATE)"


COUNTS = {
    "n": "count(*)", "nd": "count(dflt)", "nr": "count(rec)", "total": "sum(amt)",
    "sumd": "COALESCE(sum(amt) FILTER (dflt IS NOT NULL), 0)",
    **{f"n_{p}": f"count(*) FILTER (p = '{p}')" for p in P},
    **{f"nd_{p}": f"count(dflt) FILTER (p = '{p}')" for p in P},
    **{f"sum_{p}": f"COALESCE(sum(amt) FILTER (p = '{p}'), 0)" for p in P},
    **{f"nw{m}": f"count(*) FILTER ({W(m)})" for m in (3, 6, 12, 24)},
    **{f"sw{m}": f"COALESCE(sum(amt) FILTER ({W(m)}), 0)" for m in (3, 6, 12, 24)},
    **{f"dw{m}": f"count(dflt) FILTER ({W(m)})" for m in (6, 12)},
}
DISTINCT = " + ".join(flag(f"n_{p} > 0") for p in P)

GAPS = {
    "n": "count(*)", "gavg": "avg(gap)", "gmin": "min(gap)", "gmax": "max(gap)",
    "gstd": "stddev_pop(gap)", "gmed": "median(gap)", "rapid": "count(*) FILTER (gap <= 14)",
    "glast": "max(gap) FILTER (rn = n)", "gprev": "avg(gap) FILTER (rn < n)",
    "gearly": "avg(gap) FILTER (rn - 1 <= (n - 1) // 2)",
    "glate": "avg(gap) FILTER (rn - 1 > (n - 1) // 2)",
}
TREND = "CASE WHEN n >= 4 THEN glate - gearly ELSE 0 END"
CV = f"COALESCE({div('gstd', 'gavg')}, 0)"


def _cube_columns() -> tuple[dict, dict]:
    """Aggregates and readable columns of the whole wide cube."""
    stems = {"cnt": "count", "sum": "total_amount", "avg": "average_amount", "max": "max_amount", "min": "min_amount", "std": "amount_std"}
    calls = {"cnt": "count(*)", "sum": "sum(amt)", "avg": "avg(amt)", "max": "max(amt)", "min": "min(amt)", "std": "stddev_pop(amt)"}
    gone = {"total_credit_max_amount", "total_credit_min_amount", "defaulted_average_amount", "defaulted_max_amount", "defaulted_count", "recovered_count"}
    aggs, cols = {}, {}
    for p, pn in {"all": "", **P}.items():
        for w in ("all", "3m", "6m", "12m", "24m"):
            for st, cond in (("all", "TRUE"), ("active", "dflt IS NULL"),
                             ("defaulted", "dflt IS NOT NULL"), ("recovered", "rec IS NOT NULL")):
                parts = [cond] + ([f"p = '{p}'"] if p != "all" else []) + ([W(int(w[:-1]))] if w != "all" else [])
                for a, stem in stems.items():
                    if p == w == st == "all":
                        name = "total_credit_" + stem.replace("total_", "")
                    else:
                        name = "_".join(x for x in (pn, "" if st == "all" else st, stem) if x)
                        name += "" if w == "all" else f"_last_{w}"
                    if name not in gone:
                        aggs[f"c{len(aggs)}"] = f"{calls[a]} FILTER ({' AND '.join(parts)})"
                        cols[name] = z(f"c{len(aggs) - 1}")
    return aggs, cols


def wide(q: dict[str, str]) -> str:
    """Core columns, the whole cube and every family, joined by applicant."""
    parts = [family(*_cube_columns())]
    parts += [q[k] for k in q if k not in ("f1_amount_cube", "f2_count_cube", "f22_amount_tier")]
    parts.append(q["f22_amount_tier"].replace("amt / 25", "amt"))
    joins = " ".join(f"JOIN ({s}) USING ({K})" for s in parts)
    return (f"WITH {APP} SELECT * FROM (SELECT application_id || '||' || customer_id AS uid, * FROM app) {joins}")


def oracles() -> dict[str, str]:
    q = _families()
    q["f35_wide_frame"] = wide(q)
    # the same results by another path
    for k in ("f10_sequence", "f13_interval", "f17_relative", "f26_anomaly", "f33_payment_behavior"):
        q[f"{k}_over_full"] = q[k]
    return q


def _families() -> dict[str, str]:
    q: dict[str, str] = {}
    cells = f"""
      SELECT {K}, pd.p AS cube_product, wd.w AS cube_window, st.s AS cube_status, count(*) AS cnt, sum(amt) AS sum,
             avg(amt) AS avg, max(amt) AS max, min(amt) AS min, stddev_pop(amt) AS std
      FROM t JOIN (VALUES ('all'), ('il'), ('is'), ('cf'), ('mg')) pd(p) ON pd.p = 'all' OR pd.p = t.p
      JOIN (VALUES ('all', 0), ('3m', 3), ('6m', 6), ('12m', 12), ('24m', 24)) wd(w, m)
        ON wd.w = 'all' OR opening >= CAST(ref - to_months(wd.m) AS DATE)
      JOIN (VALUES ('all'), ('active'), ('defaulted'), ('recovered')) st(s)
        ON st.s = 'all' OR (st.s = 'active' AND dflt IS NULL) OR (st.s = 'defaulted' AND dflt IS NOT NULL)
           OR (st.s = 'recovered' AND rec IS NOT NULL)
      GROUP BY ALL"""
    q["f1_amount_cube"] = out(
        cells, ["sum", "avg", "max", "min", "std"],
        [*K.split(", "), "cube_product", "cube_window", "cube_status", "cnt"], [APP, BUR, T],
    )
    names = {"all": "", **P}
    counts, aggs = {}, {}
    for p, pn in names.items():
        for w in ("all", "3m", "6m", "12m", "24m"):
            for st, cond in (("all", "TRUE"), ("active", "dflt IS NULL"),
                             ("defaulted", "dflt IS NOT NULL"), ("recovered", "rec IS NOT NULL")):
                if p == w == st == "all":
                    name = "total_credit_count"
                else:
                    name = "_".join(x for x in (pn, "" if st == "all" else st, "count") if x)
                    name += "" if w == "all" else f"_last_{w}"
                if name in ("defaulted_count", "recovered_count"):
                    continue
                parts = [cond] + ([f"p = '{p}'"] if p != "all" else []) + ([W(int(w[:-1]))] if w != "all" else [])
                key = f"c{len(aggs)}"
                aggs[key] = f"count(*) FILTER ({' AND '.join(parts)})"
                counts[name] = z(key)
    q["f2_count_cube"] = family(aggs, counts)
    q["f3_ratio"] = family(COUNTS, {
        **{f"{p}_to_total_ratio": div(f"n_{p}", "n") for p in P},
        **{f"{p}_amt_to_total_ratio": div(f"sum_{p}", "total") for p in P},
        "active_ratio": div("n - nd", "n"), "defaulted_ratio": div("nd", "n"), "recovered_ratio": div("nr", "n"),
        **{f"{m}m_concentration_ratio".replace(f"{m}m", f'"{m}m', 1) + '"': div(f"nw{m}", "n") for m in (3, 6, 12, 24)},
    })
    q["f4_temporal"] = family(*TEMPORAL)
    q["f5_trend"] = family(COUNTS, {
        **{f"credit_velocity_{m}m": div0(z(f"nw{m}"), N0) for m in (3, 6)},
        **{f"amount_velocity_{m}m": div0(z(f"sw{m}"), z("total")) for m in (3, 6)},
        "cnt_trend_6m_vs_12m": f"2 * {z('nw6')} - {z('nw12')}",
        "amt_trend_6m_vs_12m": f"2 * {z('sw6')} - {z('sw12')}",
        "default_trend_6m_vs_12m": f"2 * {z('dw6')} - {z('dw12')}"})
    q["f6_risk_signal"] = out(f"""
        SELECT app.application_id, app.customer_id, {flag('od > 0')} AS has_overdraft, {z('od')} AS overdraft_count,
          {z('oda')} AS overdraft_amount, {flag('ol > 0')} AS has_overlimit, {z('ol')} AS overlimit_count,
          {z('ola')} AS overlimit_amount, {flag('od > 0 OR ol > 0')} AS financial_stress_flag,
          {flag('cur > 0')} AS has_current_default, {flag('nd > 0')} AS ever_defaulted
        FROM app LEFT JOIN (SELECT {K}, count(*) FILTER (product_type = 'NON_AUTH_OVERDRAFT') AS od,
          sum(total_amount) FILTER (product_type = 'NON_AUTH_OVERDRAFT') AS oda,
          count(*) FILTER (product_type = 'OVERLIMIT') AS ol, sum(total_amount) FILTER (product_type = 'OVERLIMIT') AS ola,
          count(*) FILTER (default_date IS NOT NULL AND recovery_date IS NULL) AS cur, count(default_date) AS nd
          FROM bur GROUP BY ALL) g USING ({K})""",
        ["has_overdraft", "overdraft_count", "overdraft_amount", "has_overlimit", "overlimit_count", "overlimit_amount",
         "financial_stress_flag", "has_current_default", "ever_defaulted"], K.split(", "), [APP, BUR])
    shares = " + ".join(f"pow({div0(z(f'n_{p}'), N0)}, 2)" for p in P)
    q["f7_diversity"] = family(COUNTS, {
        "distinct_product_count": DISTINCT, "product_diversity_ratio": f"({DISTINCT}) / 4.0::DOUBLE",
        "hhi_product": shares, "secured_ratio": div("n_mg", "n"), "unsecured_ratio": f"1 - {div('n_mg', 'n')}",
        "revolving_ratio": div("n_cf", "n")})
    q["f8_behavioral"] = family(
        {**COUNTS, "a1": "min(ttd)", "a2": "max(ttd)", "a3": "stddev_samp(ttd)", "a4": "min(rec_d)", "a5": "max(rec_d)",
         "a6": "count(*) FILTER (age_m > 24)", "a7": "count(*) FILTER (age_m < 6)",
         **{f"x{st}_{p}": f"{st}(ttd) FILTER (p = '{p}')" for p in P for st in ("min", "max", "avg")}},
        {"min_time_to_default_days": "a1", "max_time_to_default_days": "a2", "std_time_to_default_days": "a3",
         "min_recovery_time_days": "a4", "max_recovery_time_days": "a5", "recovery_success_rate": div0("nr", "nd"),
         "mature_credit_ratio": div0("a6", "n"), "new_credit_ratio": div0("a7", "n"),
         **{f"{p}_time_to_default_{st}_days": f"x{st}_{p}" for p in P for st in ("min", "max", "avg")}})
    q["f9_default_pattern"] = family(
        {**COUNTS, "avd": "avg(amt) FILTER (dflt IS NOT NULL)", "mxd": "max(amt) FILTER (dflt IS NOT NULL)"},
        {"default_count_ever": z("nd"), "default_recurrence_count": f"greatest({z('nd')} - 1, 0)",
         "has_multiple_defaults": flag("nd > 1"), "has_recovered_default": flag("nr > 0"),
         "all_defaults_recovered": flag("nd > 0 AND nr = nd"), "default_amount_ratio": div0("sumd", "total"),
         "avg_default_severity": z("avd"), "max_default_severity": z("mxd"),
         "default_to_active_ratio": div0("nd", "n - nd"), **{f"{p}_default_rate": div0(f"nd_{p}", f"n_{p}") for p in P}})
    runs = f""" runs AS (SELECT {K}, max(len) AS streak FROM (SELECT {K}, isl, count(*) AS len FROM (
        SELECT {K}, sum(CASE WHEN prev_p IS NULL OR prev_p <> p THEN 1 ELSE 0 END) OVER (PARTITION BY {K} ORDER BY rn) AS isl
        FROM s) GROUP BY ALL) GROUP BY ALL)"""
    q["f10_sequence"] = family(
        {"n": "count(*)", "fp": "max(p) FILTER (rn = 1)", "lp": "max(p) FILTER (rn = n)",
         "tr": "count(*) FILTER (rn > 1 AND p <> prev_p)", "mg": "min(rn) FILTER (p = 'mg')",
         "other": "min(rn) FILTER (p <> 'mg')"},
        {**{f"first_product_{v}": flag(f"fp = '{k}'") for k, v in P.items()},
         **{f"last_product_{v}": flag(f"lp = '{k}'") for k, v in P.items()},
         "product_transition_count": z("tr"), "moved_to_secured": flag("other < mg"),
         "moved_to_unsecured": flag("fp = 'mg' AND lp <> 'mg'"), "same_product_streak": z("streak")},
        "s", (runs,), f"LEFT JOIN runs USING ({K})")
    q["f11_size_pattern"] = family(
        {"n": "count(*)", "sm": "count(*) FILTER (amt < 5000)", "lg": "count(*) FILTER (amt > 50000)",
         "vl": "count(*) FILTER (amt > 100000)", "mx": "max(amt)", "mn": "min(amt)", "av": "avg(amt)",
         "sd": "stddev_samp(amt)", "md": "median(amt)", "sk": "CASE WHEN count(*) > 2 THEN CASE WHEN max(amt) = min(amt) THEN 0 ELSE skewness(amt) END END",
         **{f"av_{p}": f"avg(amt) FILTER (p = '{p}')" for p in P}},
        {"has_small_credit": flag("sm > 0"), "has_large_credit": flag("lg > 0"), "has_very_large_credit": flag("vl > 0"),
         "small_credit_count": z("sm"), "large_credit_count": z("lg"), "small_credit_ratio": div("sm", "n"),
         "large_credit_ratio": div("lg", "n"), "max_to_avg_amount_ratio": div("mx", "av"),
         "max_to_min_amount_ratio": div("mx", "mn"), "amount_coefficient_of_variation": div("sd", "av"),
         "amount_range": "mx - mn", "median_credit_amount": "md", "amount_skewness": "sk",
         **{f"{p}_avg_amount": f"av_{p}" for p in P}})
    near = f""" near AS (SELECT a.application_id, a.customer_id, a.tid,
          count(*) FILTER (b.opening - a.opening <= 30) AS c30, count(*) FILTER (b.opening - a.opening <= 60) AS c60, count(*) AS c90,
          sum(b.amt) FILTER (b.opening - a.opening <= 30) AS a30, sum(b.amt) FILTER (b.opening - a.opening <= 60) AS a60
        FROM t a JOIN t b ON a.application_id = b.application_id AND a.customer_id = b.customer_id
          AND b.opening BETWEEN a.opening AND a.opening + 90 GROUP BY ALL),
      peak AS (SELECT {K}, max(k) AS peak FROM (SELECT {K}, date_trunc('month', opening) AS mo, count(*) AS k FROM t GROUP BY ALL) GROUP BY ALL),
      cnt AS (SELECT {K}, count(*) AS n, {', '.join(f"count(*) FILTER (p = '{p}') AS n_{p}" for p in P)} FROM t GROUP BY ALL)"""
    two = lambda x: f"CASE WHEN n >= 2 THEN {x} ELSE 0 END"
    q["f12_burst"] = family(
        {k: f"max({k})" for k in ("c30", "c60", "c90", "a30", "a60")},
        {"credits_in_30_days": two("c30"), "credits_in_60_days": two("c60"), "credits_in_90_days": two("c90"),
         "has_credit_burst_30d": flag("n >= 2 AND c30 >= 2"), "has_credit_burst_60d": flag("n >= 2 AND c60 >= 3"),
         "max_credits_same_month": z("peak"), "amount_in_30_days": two("a30"), "amount_in_60_days": two("a60"),
         "burst_intensity_30d": two("c30"), "burst_intensity_60d": two("c60 / 2.0::DOUBLE"),
         **{f"{p}_burst_count": f"CASE WHEN n_{p} >= 2 THEN n_{p} ELSE 0 END" for p in P}},
        "near", (near,), f"LEFT JOIN peak USING ({K}) LEFT JOIN cnt USING ({K})")
    pg = f""" pg AS (SELECT {K}, {', '.join(f"avg(g) FILTER (p = '{p}') AS g_{p}" for p in P)} FROM (
        SELECT {K}, p, opening - lag(opening) OVER (PARTITION BY {K}, p ORDER BY opening) AS g FROM t) GROUP BY ALL)"""
    q["f13_interval"] = family(GAPS, {
        "avg_inter_credit_days": "gavg", "min_inter_credit_days": "gmin", "max_inter_credit_days": "gmax",
        "std_inter_credit_days": "gstd", "median_inter_credit_days": "gmed", "inter_credit_cv": CV,
        "has_rapid_succession": flag("rapid > 0"), "rapid_succession_count": z("rapid"), "longest_credit_gap_days": "gmax",
        "recent_vs_historical_interval": f"CASE WHEN n >= 4 THEN {div0('glast', 'gprev')} ELSE 0 END",
        "interval_trend": TREND, "is_accelerating": flag(f"({TREND}) < -7"), "is_decelerating": flag(f"({TREND}) > 7"),
        **{f"{p}_avg_interval_days": f"g_{p}" for p in P}}, "s", (pg,), f"LEFT JOIN pg USING ({K})")
    qs = [f"q{i}" for i in range(1, 5)]
    q["f14_seasonal"] = family(
        {"n": "count(*)", **{f"q{i}": f"count(*) FILTER (quarter(opening) = {i})" for i in range(1, 5)},
         "dec": "count(*) FILTER (month(opening) = 12)", "mo": "count(DISTINCT month(opening))"},
        {"most_common_opening_month": z("mm"), "most_common_opening_quarter": z("mq"),
         **{f"credits_in_q{i}": z(f"q{i}") for i in range(1, 5)}, "credits_in_december": z("dec"),
         "is_year_end_heavy": flag(f"{div0('q4', 'n')} > 0.25"), "is_summer_heavy": flag(f"{div0('q2 + q3', 'n')} > 0.5"),
         "monthly_spread": f"{z('mo')} / 12.0::DOUBLE",
         "quarterly_concentration": " + ".join(f"pow({div0(x, 'n')}, 2)" for x in qs)},
        "t", (f""" mode_m AS (SELECT {K}, v AS mm FROM (SELECT {K}, month(opening) AS v, row_number() OVER (PARTITION BY {K}
              ORDER BY count(*) DESC, month(opening)) AS r FROM t GROUP BY {K}, month(opening)) WHERE r = 1),
            mode_q AS (SELECT {K}, v AS mq FROM (SELECT {K}, quarter(opening) AS v, row_number() OVER (PARTITION BY {K}
              ORDER BY count(*) DESC, quarter(opening)) AS r FROM t GROUP BY {K}, quarter(opening)) WHERE r = 1)""",),
        f"LEFT JOIN mode_m USING ({K}) LEFT JOIN mode_q USING ({K})")
    q["f15_weighted"] = family(
        {**COUNTS, "wa": "sum(age_m * amt)", "wd": "sum(age_m * amt) FILTER (dflt IS NOT NULL)",
         "ws": "sum(amt * CASE p WHEN 'is' THEN 3 WHEN 'cf' THEN 2 WHEN 'il' THEN 1 ELSE 0 END)",
         "big": "COALESCE(sum(amt) FILTER (amt > 50000), 0)"},
        {"amount_weighted_default_rate": div0("sumd", "total"), "amount_weighted_age_months": div0("wa", "total"),
         "amount_weighted_product_score": div0("ws", "total"), "recent_amount_weight": div0("sw6", "total"),
         "large_credit_weight": div0("big", "total"), "defaulted_amount_weighted_age": div0("wd", "sumd")})
    pair = f""" per AS (SELECT a.*, COALESCE(n, 0) AS n, COALESCE(nd, 0) AS nd, COALESCE(amt, 0) AS amt, COALESCE(amtd, 0) AS amtd
          FROM app a LEFT JOIN (SELECT {K}, count(*) AS n, count(dflt) AS nd, sum(amt) AS amt,
            sum(amt) FILTER (dflt IS NOT NULL) AS amtd FROM t GROUP BY ALL) USING ({K})),
        co AS (SELECT x.application_id, x.customer_id, count(y.customer_id) AS others, COALESCE(sum(y.n), 0) AS cn,
            COALESCE(sum(y.nd), 0) AS cd, COALESCE(sum(y.amt), 0) AS ca, x.amtd + COALESCE(sum(y.amtd), 0) AS exposure,
            greatest(x.nd, COALESCE(max(y.nd), 0)) AS most, least(x.nd, COALESCE(min(y.nd), x.nd)) AS least_nd,
            COALESCE(sum(y.amt) FILTER (y.applicant_type = 'PRIMARY'), 0) + CASE WHEN x.applicant_type = 'PRIMARY' THEN x.amt ELSE 0 END AS pa,
            COALESCE(sum(y.amt) FILTER (y.applicant_type <> 'PRIMARY'), 0) + CASE WHEN x.applicant_type <> 'PRIMARY' THEN x.amt ELSE 0 END AS qa
          FROM per x LEFT JOIN per y ON x.application_id = y.application_id AND x.customer_id <> y.customer_id
          GROUP BY x.application_id, x.customer_id, x.amtd, x.nd, x.applicant_type, x.amt)"""
    q["f16_co_applicant"] = family(
        {"n": "count(*)"},
        {"is_primary_applicant": flag("applicant_type = 'PRIMARY'"), "is_co_applicant": flag("applicant_type = 'CO_APPLICANT'"),
         "application_has_co_applicant": flag("others > 0"), "co_applicant_credit_count": "cn",
         "co_applicant_default_count": "cd", "co_applicant_default_rate": div0("cd", "cn"), "co_applicant_total_amount": "ca",
         "primary_vs_co_amount_ratio": div0("pa", "qa"), "combined_default_exposure": "exposure",
         "either_has_default": flag("most > 0"), "both_have_default": flag("others > 0 AND least_nd > 0")},
        "t", (pair,), f"LEFT JOIN co USING ({K})")
    late = f""" lt AS (SELECT {K}, max(amt) FILTER (rn = n) AS la, max(amt) FILTER (rn = 1) AS fa FROM s GROUP BY ALL),
        mx AS (SELECT {K}, max(age_d) AS mage FROM (SELECT t.*, max(amt) OVER (PARTITION BY {K}) AS top FROM t) WHERE amt = top GROUP BY ALL),
        bl AS (SELECT s.application_id, s.customer_id, count(*) FILTER (amt < la) AS below FROM s JOIN lt USING ({K}) GROUP BY ALL)"""
    q["f17_relative"] = family(
        {"n": "count(*)", "av": "avg(amt)", "mxa": "max(amt)", "mna": "min(amt)", "rmx": f"max(amt) FILTER ({W(6)})",
         "rmn": f"min(amt) FILTER ({W(6)})", "e": "avg(amt) FILTER (rn <= n // 2)", "l": "avg(amt) FILTER (rn > n // 2)",
         "nw12": f"count(*) FILTER ({W(12)})", "nw24": f"count(*) FILTER ({W(24)})",
         "dw6": f"count(dflt) FILTER ({W(6)})", "dw12": f"count(dflt) FILTER ({W(12)})"},
        {"latest_amount_vs_average": div0("la", "av"), "latest_amount_vs_max": div0("la", "mxa"),
         "is_largest_credit_recent": flag("rmx = mxa"), "is_smallest_credit_recent": flag("rmn = mna"),
         "amount_growth_rate": f"CASE WHEN n >= 2 THEN {div0('l - e', 'e')} ELSE 0 END",
         "credit_count_growth_rate": f"2 * {z('nw12')} - {z('nw24')}", "default_rate_trend": f"2 * {z('dw6')} - {z('dw12')}",
         "amount_percentile_latest": div0("below", "n"), "recency_of_max_amount": "mage / 30.44",
         "latest_vs_first_amount_ratio": div0("la", "fa")},
        "s", (late,), f"LEFT JOIN lt USING ({K}) LEFT JOIN mx USING ({K}) LEFT JOIN bl USING ({K})")
    ent = f""" pe AS (SELECT {K}, -sum(x * log2(x)) AS pent FROM (SELECT {K}, p, CAST(count(*) AS DOUBLE) / max(n) AS x FROM s GROUP BY ALL) GROUP BY ALL),
        ae AS (SELECT {K}, -sum(x * log2(x)) AS aent FROM (SELECT {K}, b, CAST(count(*) AS DOUBLE) / max(n) AS x FROM (
            SELECT {K}, n, CASE WHEN hi = lo THEN 1 ELSE greatest(ceil((amt - lo) / (hi - lo) * 5), 1) END AS b FROM (
              SELECT s.*, min(amt) OVER (PARTITION BY {K}) AS lo, max(amt) OVER (PARTITION BY {K}) AS hi FROM s)) GROUP BY ALL) GROUP BY ALL),
        combo AS (SELECT {K}, count(*) AS combos FROM (SELECT DISTINCT {K}, p, dflt IS NULL FROM t) GROUP BY ALL)"""
    q["f18_complexity"] = family(
        {**GAPS, "dp": "count(DISTINCT p)", "sd": "stddev_samp(amt)", "av": "avg(amt)"},
        {"product_entropy": z("pent"), "amount_entropy": z("aent"), "has_all_product_types": flag("dp >= 4"),
         "single_product_customer": flag("dp = 1"), "dual_product_customer": flag("dp = 2"),
         "product_status_combinations": z("combos"), "portfolio_complexity_score": f"least(10, 2 * {z('dp')} + 2 * {z('pent')})",
         "credit_frequency_regularity": f"CASE WHEN n > 0 THEN 1 / (1 + {CV}) ELSE 0 END",
         "amount_regularity": f"CASE WHEN n > 0 THEN 1 / (1 + {div('sd', 'av')}) ELSE 0 END"},
        "s", (ent,), f"LEFT JOIN pe USING ({K}) LEFT JOIN ae USING ({K}) LEFT JOIN combo USING ({K})")
    w = "exp(-0.693 * age_d / 180)"
    q["f19_time_decay"] = family(
        {"n": "count(*)", "w1": f"sum({w}) FILTER (dflt IS NOT NULL)", "w2": f"sum(amt * {w}) FILTER (dflt IS NOT NULL)",
         "w3": f"sum({w})", "w4": f"sum(amt * {w})", "n180": "count(*) FILTER (age_d <= 180)",
         "d1": "sum(amt / (1 + age_d / 365.0::DOUBLE))", "d2": "sum(amt * exp(-age_d / 365.0::DOUBLE)) FILTER (dflt IS NOT NULL)",
         "d3": "sum(amt * pow(2, -age_d / 30.0::DOUBLE))", "d4": "sum(amt * pow(2, -age_d / 90.0::DOUBLE))",
         "mx": "max(age_d)", "mn": "min(age_d)"},
        {"recency_weighted_default_count": z("w1"), "recency_weighted_default_amount": z("w2"),
         "time_decay_total_amount": div0("w4", "w3"), "time_decay_default_severity": z("w2"),
         "recent_activity_score": div0("n180", "n"), "historical_activity_score": div0("n - n180", "n"),
         "recency_weighted_amount": z("d1"), "exponential_decay_default_score": z("d2"), "half_life_30d_amount": z("d3"),
         "half_life_90d_amount": z("d4"),
         "recency_score": "CASE WHEN n IS NULL THEN 0 WHEN mx > 0 THEN 1 - CAST(mn AS DOUBLE) / mx ELSE 1 END",
         "stale_portfolio_flag": flag("n IS NULL OR mn > 365"), "fresh_portfolio_flag": flag("mn < 90")})
    r1 = f" r AS (SELECT t.*, min(rec) OVER (PARTITION BY {K}) AS r1 FROM t)"
    q["f20_default_lifecycle"] = family(
        {"n": "count(*)", "nr": "count(rec)", "nd": "count(dflt)", "ar": "count(*) FILTER (opening > r1)",
         "dr": "count(*) FILTER (dflt > r1)", "nx": "min(opening) FILTER (opening > r1) - min(r1)", "lr": "min(ref - rec)",
         "clean": "CASE WHEN count(dflt) > 0 THEN min(dflt) - min(opening) ELSE max(age_d) END",
         "fd": "max(ref - dflt)", "ld": "min(ref - dflt)"},
        {"credits_after_first_recovery": z("ar"), "defaulted_again_after_recovery": flag("dr > 0"),
         "days_clean_before_first_default": "clean", "time_since_last_recovery_days": "lr", "recovery_to_new_credit_days": "nx",
         "multiple_recovery_cycles": flag("nr > 1"), "recovery_cycle_count": z("nr"),
         "clean_after_recovery": flag("(nr > 0 AND dr = 0) OR (nr = 0 AND nd = 0)"),
         "first_default_age_months": "fd / 30.44", "last_default_age_months": "ld / 30.44"}, "r", (r1,))
    q["f21_early_default"] = family(
        {**COUNTS, **{f"e{d}": f"count(*) FILTER (ttd <= {d})" for d in (90, 180, 365)}, "f": "min(ttd)", "sl": "max(ttd)",
         "ea": "COALESCE(sum(amt) FILTER (ttd <= 180), 0)"},
        {**{f"has_early_default_{d}d": flag(f"e{d} > 0") for d in (90, 180, 365)}, "early_default_count_90d": z("e90"),
         "early_default_count_180d": z("e180"), "early_default_ratio": div0("e180", "nd"), "fastest_default_days": "f",
         "slowest_default_days": "sl", "early_default_amount": z("ea"), "early_default_amount_ratio": div0("ea", "sumd")})
    tiers = ["micro", "small_tier", "medium_tier", "large_tier"]
    tier = f""" tt AS (SELECT {K}, dflt, CASE WHEN amt / 25 < 1000 THEN 0 WHEN amt / 25 < 10000 THEN 1 WHEN amt / 25 < 50000 THEN 2 ELSE 3 END AS tier FROM t),
        tc AS (SELECT {K}, tier, count(*) AS k, count(dflt) AS kd FROM tt GROUP BY ALL),
        pick AS (SELECT {K}, arg_min(tier, (-kd, tier)) AS by_d, arg_min(tier, (-CAST(kd AS DOUBLE) / k, tier)) AS by_r,
                 arg_min(tier, (-k, tier)) AS by_n, count(*) AS spread FROM tc GROUP BY ALL)"""
    q["f22_amount_tier"] = family(
        {**{f"t{i}": f"count(*) FILTER (tier = {i})" for i in range(4)},
         **{f"d{i}": f"count(dflt) FILTER (tier = {i})" for i in range(4)}},
        {**{f"{x}_count": z(f"t{i}") for i, x in enumerate(tiers)},
         **{f"{x}_default_rate": div0(f"d{i}", f"t{i}") for i, x in enumerate(tiers)},
         "micro_credit_count": z("t0"), "micro_credit_default_rate": div0("d0", "t0"),
         "tier_with_most_defaults": f"CASE WHEN {' + '.join(f'd{i}' for i in range(4))} > 0 THEN by_d ELSE 0 END",
         "tier_with_highest_default_rate": z("by_r"), "tier_spread": z("spread"), "dominant_tier": z("by_n")},
        "tt", (tier,), f"LEFT JOIN pick USING ({K})")
    ds = f""" ds AS (SELECT {K}, p, lag(p) OVER (PARTITION BY {K} ORDER BY dflt, amt, product, tid) AS pp FROM t WHERE dflt IS NOT NULL),
        dd AS (SELECT {K}, max(CASE WHEN pp = 'cf' AND p = 'il' THEN 1 ELSE 0 END) AS ci, max(CASE WHEN pp = 'il' AND p = 'cf' THEN 1 ELSE 0 END) AS ic FROM ds GROUP BY ALL)"""
    hit = " + ".join(flag(f"nd_{p} > 0") for p in P)
    q["f23_cross_product"] = family(COUNTS, {
        "cf_default_then_il_default": z("ci"), "il_default_then_cf_default": z("ic"),
        "multi_product_default": flag(f"({hit}) > 1"), "multi_product_default_count": hit,
        "mortgage_with_default_elsewhere": flag("n_mg > 0 AND nd - nd_mg > 0"), "all_products_clean": flag(f"{z('nd')} = 0"),
        "unsecured_default_rate": div0("nd - nd_mg", "n - n_mg"), "secured_default_rate": div0("nd_mg", "n_mg"),
        "high_risk_product_only": flag("n > 0 AND n_il + n_mg = 0"), "low_risk_product_only": flag("n > 0 AND n_mg = n"),
        "cross_product_default_spread": div0(hit, DISTINCT)}, "t", (ds,), f"LEFT JOIN dd USING ({K})")
    q["f24_freshness"] = family(
        {**GAPS, "mn": "min(age_d)", "nb": "count(*) FILTER (opening >= ref - 30 AND opening < ref)",
         "na": "count(*) FILTER (opening > ref AND opening <= ref + 30)",
         "ab": "sum(amt) FILTER (opening >= ref - 30 AND opening < ref)"},
        {"newest_credit_age_at_app_days": "mn", "applied_with_fresh_credit_30d": flag("mn <= 30"),
         "applied_with_fresh_credit_60d": flag("mn <= 60"), "credits_near_application_before": z("nb"),
         "credits_near_application_after": z("na"), "amount_near_application_before": z("ab"),
         "credit_surge_at_application": flag("nb + na > 2"), "application_timing_score": f"least(1, {z('gavg')} / 365)"}, "s")
    top = f" tk AS (SELECT t.*, row_number() OVER (PARTITION BY {K} ORDER BY amt DESC) AS k FROM t)"
    t1 = div0("mx", "total")
    prod = div0("greatest(sum_il, sum_is, sum_cf, sum_mg)", "total")
    q["f25_concentration"] = family(
        {**COUNTS, "mx": "max(amt)", "mn": "min(amt)", "s2": "sum(amt) FILTER (k <= 2)", "s3": "sum(amt) FILTER (k <= 3)"},
        {"single_large_exposure_flag": flag(f"{t1} > 0.5"), "top_credit_concentration": t1, "top_2_concentration": div0("s2", "total"),
         "top_3_concentration": div0("s3", "total"), "max_single_credit_amount": z("mx"), "min_single_credit_amount": z("mn"),
         "defaulted_concentration": div0("sumd", "total"), "active_concentration": div0("total - sumd", "total"),
         "single_product_concentration": prod,
         "concentration_risk_score": f"least(10, ({t1} * 3 + {div0('sumd', 'total')} * 5 + {prod} * 2) * 10)"}, "tk", (top,))
    an = f""" qq AS (SELECT {K}, quantile_cont(amt, 0.25) AS q1, quantile_cont(amt, 0.75) AS q3 FROM t GROUP BY ALL),
        io AS (SELECT t.application_id, t.customer_id, count(*) FILTER (amt < q1 - 1.5 * (q3 - q1) OR amt > q3 + 1.5 * (q3 - q1)) AS outl
               FROM t JOIN qq USING ({K}) GROUP BY ALL),
        lp AS (SELECT a.application_id, a.customer_id, count(*) AS same FROM s a JOIN s b ON a.application_id = b.application_id AND a.customer_id = b.customer_id
               AND b.rn = b.n AND a.p = b.p AND a.rn < a.n GROUP BY ALL)"""
    zz = div0("la - ap", "CASE WHEN sp > 0 THEN sp END")
    newp = "(n >= 2 AND same IS NULL)"
    outl = f"(n >= 2 AND abs({zz}) > 2)"
    q["f26_anomaly"] = family(
        {**GAPS, "la": "max(amt) FILTER (rn = n)", "ap": "avg(amt) FILTER (rn < n)", "sp": "stddev_samp(amt) FILTER (rn < n)",
         "w1": f"sum({w}) FILTER (dflt IS NOT NULL)"},
        {"latest_amount_zscore": two(zz), "is_latest_amount_outlier": flag(outl), "amount_iqr_outlier_count": two("outl"),
         "behavior_change_flag": flag(f"{outl} OR {newp}"), "sudden_large_credit_flag": flag("n >= 2 AND la > 3 * ap"),
         "sudden_product_change": flag(newp), "unusual_timing_flag": flag(f"n >= 2 AND (rapid > 0 OR ({TREND}) < -7)"),
         "risk_score_change": two(z("w1")), "velocity_anomaly_flag": flag(f"n >= 2 AND ({TREND}) < -7"),
         "dormancy_break_flag": flag("glast > 365")}, "s", (an,), f"LEFT JOIN io USING ({K}) LEFT JOIN lp USING ({K})")
    pay = {"ps": "sum(payment)", "pa": "avg(payment)", "px": "max(payment)", "pn": "min(payment)", "psd": "stddev_samp(payment)",
           "pm": "median(payment)", "np": "count(payment)",
           **{f"pay_{p}": f"COALESCE(sum(payment) FILTER (p = '{p}'), 0)" for p in P},
           "pact": "sum(payment) FILTER (dflt IS NULL AND closure IS NULL)", "phi": "count(*) FILTER (payment > 2000)",
           "plo": "count(*) FILTER (payment < 500)", "ptiny": "count(*) FILTER (payment < 100)"}
    q["f27_payment"] = family({**COUNTS, **pay}, {
        "total_monthly_payment": z("ps"), "avg_monthly_payment": z("pa"), "max_monthly_payment": z("px"),
        "min_monthly_payment": z("pn"), "std_monthly_payment": z("psd"), "il_monthly_payment_total": z("pay_il"),
        "mg_monthly_payment_total": z("pay_mg"), "is_monthly_payment_total": z("pay_is"), "active_monthly_payment": z("pact"),
        "payment_count": z("np"), "payment_concentration": div0("px", "ps"),
        "largest_payment_product": """CASE WHEN COALESCE(np, 0) = 0 THEN 0
            WHEN pay_il > 0 AND pay_il >= greatest(pay_is, pay_mg) THEN 0
            WHEN pay_is > 0 AND pay_is >= greatest(pay_il, pay_mg) THEN 2 ELSE 1 END""",
        "high_payment_credit_count": z("phi"), "low_payment_credit_count": z("plo"), "median_monthly_payment": z("pm")})
    live = f""" lv AS (SELECT {K}, amt, greatest(duration - age_m, 0) AS rem FROM t WHERE duration IS NOT NULL AND closure IS NULL AND dflt IS NULL)"""
    q["f28_remaining_term"] = family(
        {"a": "avg(rem)", "x": "max(rem)", "i": "min(rem)", "su": "sum(rem)", "wr": "sum(rem * amt)", "sa": "sum(amt)",
         **{f"n{m}": f"count(*) FILTER (rem <= {m})" for m in (3, 6, 12)},
         **{f"s{m}": f"sum(amt) FILTER (rem <= {m})" for m in (3, 6)}},
        {"avg_remaining_months": z("a"), "max_remaining_months": z("x"), "min_remaining_months": z("i"),
         "total_remaining_months": z("su"), **{f"has_maturing_{m}m": flag(f"n{m} > 0") for m in (3, 6, 12)},
         "maturing_amount_3m": z("s3"), "maturing_amount_6m": z("s6"), "maturing_count_6m": z("n6"),
         "weighted_remaining_term": div0("wr", "sa"), "remaining_term_spread": z("x - i")}, "lv", (live,))
    ob = {"fut": "COALESCE(sum(greatest(duration - age_m, 0) * COALESCE(payment, 0)) FILTER (duration IS NOT NULL), 0)",
          "past": "COALESCE(sum(age_m * COALESCE(payment, 0)) FILTER (duration IS NOT NULL), 0)", "mx": "max(amt)"}
    bur = f"({z('total')} + {z('fut')})"
    q["f29_obligation"] = family({**COUNTS, **pay, **ob}, {
        "total_credit_burden": bur, "future_payment_obligation": z("fut"), "past_payment_made": z("past"),
        "single_credit_burden_ratio": div0("mx", bur), "mortgage_burden_ratio": div0("sum_mg", bur),
        "unsecured_burden_ratio": div0("total - sum_mg", bur), "new_burden_12m": z("sw12"),
        "burden_growth_rate": div0("sw12", "total"), "burden_per_credit": div0(bur, "n"),
        "monthly_burden_intensity": div0("ps", "np"), "high_burden_flag": flag(f"{bur} > 200000"),
        "burden_to_amount_ratio": div0(bur, "total")})
    ann = div0("12 * ps", "total")
    q["f30_dti_proxy"] = family({**COUNTS, **pay, "mx": "max(amt)"}, {
        "payment_to_amount_ratio": div0("ps", "total"), "payment_intensity": div0("ps", "n"),
        "avg_payment_per_credit": div0("ps", "n"), "payment_to_exposure_ratio": div0("ps", "mx"),
        "high_payment_credit_ratio": div0("phi", "n"), "unsustainable_payment_flag": flag(f"{ann} > 0.5"),
        "payment_vs_historical_avg": "1", "payment_growth_rate": "0", "annualized_payment_ratio": ann,
        "payment_efficiency_score": f"least(10, {ann} * 10)"})
    rate = div0("cc", "nc")
    q["f31_maturity"] = family(
        {"nc": "count(closure)", "sc": "sum(amt) FILTER (closure IS NOT NULL)", "cc": "count(*) FILTER (closure IS NOT NULL AND dflt IS NULL)"},
        {"recently_closed_count": z("nc"), "recently_closed_amount": z("sc"), "closed_without_default": z("cc"),
         "closed_with_default": z("nc - cc"), "closure_success_rate": rate, "avg_closure_to_plan": "1", "early_closure_count": "0",
         "on_time_closure_count": z("nc"), "maturity_behavior_score": f"least(10, {rate} * 10)", "has_recent_closure": flag("nc > 0")})
    du = {"nu": "count(duration)", "da": "avg(duration)", "dx": "max(duration)", "dn": "min(duration)", "dsd": "stddev_samp(duration)",
          "dsum": "sum(duration)", "dsq": "sum(CAST(duration AS BIGINT) * duration)", "g60": "count(*) FILTER (duration > 60)", "l24": "count(*) FILTER (duration < 24)",
          "l12": "count(*) FILTER (duration < 12)", "su": "sum(amt) FILTER (duration IS NOT NULL)",
          "hb": "count(*) FILTER (duration > 60 AND amt > 50000)", "da_": "sum(duration * amt)"}
    q["f32_duration_risk"] = family(du, {
        "avg_duration_months": z("da"), "max_duration_months": z("dx"), "min_duration_months": z("dn"), "duration_spread": z("dx - dn"),
        "duration_cv": f"CASE WHEN COALESCE(nu, 0) = 0 THEN 0 ELSE {div('dsd', 'da')} END",
        "prefers_long_term": flag(f"{div('g60', 'nu')} > 0.5"), "prefers_short_term": flag(f"{div('l24', 'nu')} > 0.5"),
        "mixed_duration_portfolio": flag("4 * nu * (nu * dsq - dsum * dsum) > (nu - 1) * dsum * dsum"), "duration_to_amount_ratio": div0("dsum", "su / 10000"),
        "high_duration_high_amount": flag("hb > 0")})
    pr = f""" pr AS (SELECT s.*, row_number() OVER (PARTITION BY {K} ORDER BY rn) AS pn_, count(*) OVER (PARTITION BY {K}) AS pc FROM s WHERE payment IS NOT NULL)"""
    pcv = div0(z("psd"), "pa")
    q["f33_payment_behavior"] = family(
        {**pay, "f": "max(payment) FILTER (pn_ = 1)", "l": "max(payment) FILTER (pn_ = pc)", "slope": "CASE WHEN count(*) > 1 THEN regr_slope(payment, pn_) END",
         "sk": "CASE WHEN count(*) > 2 THEN CASE WHEN max(payment) = min(payment) THEN 0 ELSE skewness(payment) END END"},
        {"payment_amount_cv": pcv, "payment_consistency_score": f"CASE WHEN np > 0 THEN 1 / (1 + {pcv}) ELSE 0 END",
         "has_minimum_payments": flag("ptiny > 0"), "first_payment_vs_last": f"CASE WHEN np >= 2 THEN {div0('f', 'l')} ELSE 0 END",
         "payment_trend_slope": z("slope"), "avg_payment_by_vintage": z("pa"), "payment_spread": z("px - pn"),
         "payment_skewness": z("sk")}, "pr", (pr,))
    sh = [div0("l12", "nu"), div0("nu - l12 - g60", "nu"), div0("g60", "nu")]
    hhi = " + ".join(f"pow({x}, 2)" for x in sh)
    div1 = f"CASE WHEN nu > 0 THEN 1 - ({hhi}) ELSE 0 END"
    q["f34_term_structure"] = family({**du, "n": "count(*)"}, {
        "weighted_avg_term": div0("da_", "su"), "term_concentration_hhi": hhi, "term_diversity_score": div1,
        "short_term_ratio": sh[0], "medium_term_ratio": sh[1], "long_term_ratio": sh[2], "amortizing_ratio": div0("nu", "n"),
        "term_structure_score": f"({div1}) * 10"})
    return q
