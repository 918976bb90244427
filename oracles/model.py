"""Binning, stability, elimination, metrics, cut-offs and scorecard."""

import math

from oracles.base import APP, BUR, FEATURES, K, MODEL, T, long, out, rnd
from oracles.families import div0, flag

LF = f"l AS ({long()})"
PAIRED = [f for f in FEATURES if f != "const_1"]
CAT = ("CASE WHEN iv IS NULL THEN 'unknown' WHEN iv < 0.02 THEN 'useless' WHEN iv < 0.10 THEN 'weak' WHEN iv < 0.30 THEN 'medium' "
       "WHEN iv < 0.50 THEN 'strong' ELSE 'suspicious' END")
PROBS = "[" + ", ".join(f"{i / 10!r}::DOUBLE" for i in range(11)) + "]"


def edges(name: str, source: str, by: str = "feature", n: int = 10) -> str:
    """CTE with the distinct quantile edges per group.

    Whole numbers tell whether an edge is a value: (n - 1) * 0.7 may be just below a whole number, and the edge then just below the value.
    """
    probs = "[" + ", ".join(f"{i / n!r}" for i in range(n + 1)) + "]"
    at = f"list_transform(range({n + 1}), lambda i: CASE WHEN (n - 1) * i % {n} = 0 THEN CAST(d[i + 1] AS DOUBLE) ELSE q[i + 1] END)"
    return (f"{name} AS (SELECT {by}, n, list_sort(list_distinct({at})) AS edges FROM (SELECT {by}, count(value) AS n, "
            f"quantile_cont(value, {probs}) AS q, quantile_disc(value, {probs}) AS d FROM {source} WHERE value IS NOT NULL GROUP BY {by}))")


def bin_of(x: str, op: str = "<") -> str:
    return f"CASE WHEN {x} IS NOT NULL AND len(edges) >= 2 THEN len(list_filter(edges[2:len(edges) - 1], lambda e: e {op} {x})) END"


BINNED = f"b AS (SELECT l.*, {bin_of('value')} AS bin FROM l JOIN ed USING (feature))"


def woe(good: str, bad: str, goods: str, bads: str) -> tuple[str, str]:
    pg, pb = f"greatest(CAST({good} AS DOUBLE) / {goods}, 1e-6::DOUBLE)", f"greatest(CAST({bad} AS DOUBLE) / {bads}, 1e-6::DOUBLE)"
    return f"ln({pg} / {pb})", f"({pg} - {pb}) * ln({pg} / {pb})"


W, IV = woe("good", "bad", "goods", "bads")
WT = f"""w AS (SELECT feature, bin, n, good, bad, {W} AS woe, {IV} AS iv FROM (
    SELECT *, sum(good) OVER (PARTITION BY feature) AS goods, sum(bad) OVER (PARTITION BY feature) AS bads FROM (
      SELECT feature, bin, count(*) AS n, count(*) FILTER (target = 0) AS good, count(*) FILTER (target = 1) AS bad
      FROM b WHERE bin IS NOT NULL GROUP BY ALL)))"""
INFO = """info AS (SELECT feature, CASE WHEN n >= 50 THEN COALESCE(iv, 0) END AS iv, n FROM
    (SELECT feature, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY 1) LEFT JOIN (SELECT feature, sum(iv) AS iv FROM w GROUP BY 1) USING (feature))"""


def auc(name: str, source: str, by: str, score: str = "score") -> str:
    """CTE with rank-sum AUC and KS per group."""
    part = f"PARTITION BY {by}"
    return f"""{name}_r AS (SELECT {by}, target, {score} AS sc, rank() OVER ({part} ORDER BY {score}) AS rk,
        count(*) OVER ({part}, {score}) AS tie, count(*) OVER ({part}) AS tot, sum(target) OVER ({part}) AS pos,
        sum(target) OVER ({part} ORDER BY {score} RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS pos_up,
        count(*) OVER ({part} ORDER BY {score} RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n_up
      FROM {source} WHERE {score} IS NOT NULL),
    {name} AS (SELECT {by}, max(tot) AS n, CAST(max(pos) AS BIGINT) AS n_bads, max(pos) / CAST(max(tot) AS DOUBLE) AS bad_rate,
        CASE WHEN max(pos) > 0 AND max(pos) < max(tot) THEN (sum(CASE WHEN target = 1 THEN rk + (tie - 1) / 2.0::DOUBLE END) - max(pos) * (max(pos) + 1) / 2.0::DOUBLE)
          / (CAST(max(pos) AS DOUBLE) * (max(tot) - max(pos))) END AS auc,
        max(abs(d)) AS ks, max(CASE WHEN abs(d) = dm THEN sc END) AS ks_threshold, greatest(max(d), 0) AS ks_signed
      FROM (SELECT *, max(abs(d)) OVER ({part}) AS dm FROM (SELECT *, CASE WHEN pos > 0 AND pos < tot THEN (tot - n_up - (pos - pos_up)) / CAST(tot - pos AS DOUBLE)
        - (pos - pos_up) / CAST(pos AS DOUBLE) END AS d FROM {name}_r)) GROUP BY {by})"""


def psi(base: str, cmp: str, bins_out: bool = False) -> list[str]:
    """CTEs: base (feature, base_id, value), cmp (feature, base_id, label, value) to res rows."""
    e = "greatest(CAST(e AS DOUBLE) / et, 1e-4::DOUBLE)"
    a = "greatest(CAST(a AS DOUBLE) / at_, 1e-4::DOUBLE)"
    return [
        f"pb AS ({base})", f"pc AS ({cmp})", edges("pe", "pb", "feature, base_id"),
        f"pslot AS (SELECT feature, base_id, {bin_of('value')} AS bin0, value FROM pb JOIN pe USING (feature, base_id) WHERE value IS NOT NULL)",
        "pbase AS (SELECT feature, base_id, COALESCE(bin0, 0) AS bin, count(*) AS e FROM pslot GROUP BY ALL)",
        f"pcmp AS (SELECT feature, base_id, label, COALESCE({bin_of('value')}, 0) AS bin, count(*) AS a FROM pc JOIN pe USING (feature, base_id) WHERE value IS NOT NULL GROUP BY ALL)",
        """pgrid AS (SELECT feature, base_id, label, unnest(range(greatest(len(edges) - 1, 1))) AS bin FROM (SELECT DISTINCT feature, base_id, label FROM pc)
            JOIN pe USING (feature, base_id))""",
        """pfull AS (SELECT *, sum(e) OVER g AS et, sum(a) OVER g AS at_ FROM (SELECT feature, base_id, label, bin, COALESCE(e, 0) AS e, COALESCE(a, 0) AS a
            FROM pgrid LEFT JOIN pbase USING (feature, base_id, bin) LEFT JOIN pcmp USING (feature, base_id, label, bin)) WINDOW g AS (PARTITION BY feature, base_id, label))""",
        f"prow AS (SELECT feature, base_id, label, bin, et, at_, {e} AS expected_share, {a} AS actual_share, ({a} - {e}) * ln({a} / {e}) AS psi FROM pfull)",
        "ptab AS (SELECT feature, base_id, label, sum(CASE WHEN et >= 10 AND at_ >= 10 THEN psi END) AS psi FROM prow GROUP BY ALL)",
    ]


TRAIN = "mt AS (SELECT * FROM m WHERE date <= DATE '2000-06-30')"


def confusion(by: str, n: str = "n", bad: str = "bad") -> str:
    p, r = div0("tp", "tp + fp"), div0("tp", "tp + fn")
    return (f"SELECT {by}, threshold, tp, fp, tn, fn, {p} AS precision, {r} AS recall, {div0(f'2 * ({p}) * ({r})', f'({p}) + ({r})')} AS f1, "
            f"{div0('fp', 'fp + tn')} AS type_i_error, {div0('fn', 'fn + tp')} AS type_ii_error, {div0('tp + tn', 'tp + fp + tn + fn')} AS accuracy")


def counts(by: str, source: str, thresholds: str) -> str:
    return f"""(SELECT {by}, threshold, count(*) FILTER (score >= threshold AND target = 1) AS tp, count(*) FILTER (score >= threshold AND target = 0) AS fp,
      count(*) FILTER (score < threshold AND target = 0) AS tn, count(*) FILTER (score < threshold AND target = 1) AS fn
      FROM {source}, (SELECT unnest({thresholds}) AS threshold) GROUP BY ALL)"""


CONF = ["threshold", "precision", "recall", "f1", "type_i_error", "type_ii_error", "accuracy"]
CNT = ["tp", "fp", "tn", "fn"]


# the tail of the chi-squared distribution by the series of the incomplete gamma function, whose terms are largest at k = chi2 / 2
CHI2_TAIL = ("greatest(0, 1 - list_sum(list_transform(range(CAST(ceil(chi2 / 2 + 40 * sqrt(chi2 / 2)) AS BIGINT) + 200), "
             "lambda k: exp(-chi2 / 2 + (dof / 2.0::DOUBLE + k) * ln(chi2 / 2) - lgamma(dof / 2.0::DOUBLE + k + 1)))))")


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    M = [MODEL, LF, edges("ed", "l"), BINNED, WT, INFO]
    q["a1_qcut"] = out("SELECT feature, bin, count(*) AS n, min(value) AS lo, max(value) AS hi FROM b GROUP BY ALL", ["lo", "hi"], ["feature", "bin", "n"], M[:4])
    q["a4_woe_table"] = out("SELECT * FROM w", ["woe", "iv"], ["feature", "bin", "n", "good", "bad"], M[:5])
    # bins adapt to the number of values: 3000 rows each
    sizes = "nb AS (SELECT feature, count(*) AS n, least(10, greatest(2, count(*) // 3000)) AS k FROM l WHERE value IS NOT NULL GROUP BY 1)"
    ad = """ed AS (SELECT feature, any_value(n) AS n, list_sort(list_distinct(list(q))) AS edges FROM (
        SELECT feature, n, lo + (hi - lo) * (pos - floor(pos)) AS q FROM (
          SELECT feature, n, pos, max(CASE WHEN rn = floor(pos) THEN value END) AS lo, max(CASE WHEN rn = ceil(pos) THEN value END) AS hi FROM (
            SELECT feature, nb.n, value, i, least(i / CAST(k AS DOUBLE), 1) * (nb.n - 1) AS pos, row_number() OVER (PARTITION BY feature, i ORDER BY value) - 1 AS rn
            FROM l JOIN nb USING (feature), (SELECT unnest(range(11)) AS i) WHERE value IS NOT NULL) GROUP BY feature, n, i, pos)) GROUP BY 1)"""
    q["a4_adaptive_iv"] = out(f"""SELECT feature, iv, {CAT} AS iv_category, n FROM (SELECT nb.feature, CASE WHEN nb.n >= 6000 AND kb >= 2 THEN iv END AS iv, nb.n
        FROM nb LEFT JOIN (SELECT feature, sum(iv) AS iv, count(*) AS kb FROM w GROUP BY 1) USING (feature))""",
        ["iv"], ["feature", "iv_category", "n"], [MODEL, LF, sizes, ad, BINNED, WT])
    q["a5_information_value"] = out(f"SELECT feature, iv, {CAT} AS iv_category, n FROM info", ["iv"], ["feature", "iv_category", "n"], M)
    q["t4_ranked_features"] = out("SELECT feature, iv, row_number() OVER (ORDER BY round(iv, 6) DESC NULLS LAST, feature) AS position FROM info", ["iv"], ["feature", "position"], M)
    def cat(c):
        g, b = "(good + 0.5::DOUBLE) / (goods + 0.5::DOUBLE)", "(bad + 0.5::DOUBLE) / (bads + 0.5::DOUBLE)"
        return f"""SELECT '{c}' AS feature, sum(({g} - {b}) * ln(({g}) / ({b}))) AS iv FROM (SELECT *, sum(good) OVER () AS goods, sum(bad) OVER () AS bads FROM
            (SELECT {c}, count(*) FILTER (target = 0) AS good, count(*) FILTER (target = 1) AS bad FROM m GROUP BY 1))"""
    q["a6_categorical_iv"] = out(f"SELECT *, {CAT} AS iv_category FROM ({cat('segment')} UNION ALL {cat('quarter')})", ["iv"], ["feature", "iv_category"], [MODEL])
    sg, sb = "(good + 0.5::DOUBLE) / (goods + 0.5::DOUBLE)", "(bad + 0.5::DOUBLE) / (bads + 0.5::DOUBLE)"
    smooth = f"""sm AS (SELECT feature, sum(CASE WHEN goods > 0 AND bads > 0 THEN ({sg} - {sb}) * ln(({sg}) / ({sb})) END) AS iv FROM (
        SELECT *, sum(good) OVER (PARTITION BY feature) AS goods, sum(bad) OVER (PARTITION BY feature) AS bads FROM (
          SELECT feature, CASE WHEN dn > 10 THEN CAST(bin AS DOUBLE) ELSE value END AS grp, count(*) FILTER (target = 0) AS good, count(*) FILTER (target = 1) AS bad
          FROM b JOIN (SELECT feature, count(DISTINCT value) AS dn FROM b GROUP BY 1) USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2)) GROUP BY 1)"""
    q["a6_smoothed_iv"] = out(f"SELECT feature, iv, {CAT} AS iv_category FROM sm", ["iv"], ["feature", "iv_category"], [*M[:4], smooth])
    BW, BIV = woe("good", "bad", "goods", "bads")
    bins = f"""bins AS (SELECT feature, bin_id, lower, upper, n, good, bad, {BW} AS woe, {BIV} AS iv FROM (
        SELECT feature, CASE WHEN value IS NULL THEN -1 ELSE bin END AS bin_id, min(value) AS lower, max(value) AS upper, count(*) AS n,
          count(*) FILTER (target = 0) AS good, count(*) FILTER (target = 1) AS bad FROM b WHERE value IS NULL OR bin IS NOT NULL GROUP BY ALL),
        (SELECT count(*) FILTER (target = 0) AS goods, count(*) FILTER (target = 1) AS bads FROM m))"""
    B = [*M[:4], bins]
    dbl, oth = ["lower", "upper", "woe", "iv"], ["feature", "bin_id", "n", "good", "bad"]
    q["a8_woe_bins"] = out("SELECT * FROM bins", dbl, oth, B)
    q["s10_saved_bins"] = q["a8_woe_bins"]
    # a bin below the minimum share joins the run started by the last bin that stays
    MW, MIV = woe("good", "bad", "goods", "bads")
    merged = f"""SELECT feature, CAST(bin_id AS INTEGER) AS bin_id, lower, upper, n, good, bad, {MW} AS woe, {MIV} AS iv FROM (
        SELECT feature, min(bin_id) AS bin_id, min(lower) AS lower, max(upper) AS upper, CAST(sum(n) AS BIGINT) AS n, CAST(sum(good) AS BIGINT) AS good, CAST(sum(bad) AS BIGINT) AS bad FROM (
          SELECT *, CASE WHEN bin_id < 0 THEN -1 ELSE sum(CASE WHEN bin_id >= 0 AND (k <= 2 OR first OR n >= floor(tot * 0.05)) THEN 1 ELSE 0 END) OVER (PARTITION BY feature ORDER BY bin_id) END AS grp FROM (
            SELECT *, count(*) OVER (PARTITION BY feature) AS k, sum(n) FILTER (bin_id >= 0) OVER (PARTITION BY feature) AS tot,
              bin_id = min(bin_id) FILTER (bin_id >= 0) OVER (PARTITION BY feature) AS first FROM bins))
        GROUP BY feature, grp), (SELECT count(*) FILTER (target = 0) AS goods, count(*) FILTER (target = 1) AS bads FROM m)"""
    q["a9_merged_bins"] = out(merged, dbl, oth, B)
    # the first pair of neighbours against the direction of the ends is joined, until none is left or two bins are
    JW, _ = woe("(x.good + y.good)", "(x.bad + y.bad)", "goods", "bads")
    runs = f"""WITH RECURSIVE {', '.join(B)}, mg AS ({merged}), tot AS (SELECT count(*) FILTER (target = 0) AS goods, count(*) FILTER (target = 1) AS bads FROM m),
      st(feature, bins, step) AS (
        SELECT feature, list({{'bin_id': bin_id, 'lower': lower, 'upper': upper, 'n': n, 'good': good, 'bad': bad, 'woe': woe}} ORDER BY bin_id), 0 FROM mg WHERE bin_id >= 0 GROUP BY 1
        UNION ALL
        SELECT feature, list_concat(list_concat(bins[1:hit - 1], [{{'bin_id': x.bin_id, 'lower': least(x.lower, y.lower), 'upper': greatest(x.upper, y.upper), 'n': x.n + y.n,
            'good': x.good + y.good, 'bad': x.bad + y.bad, 'woe': {JW}}}]), bins[hit + 2:len(bins)]), step + 1
        FROM (SELECT *, bins[hit] AS x, bins[hit + 1] AS y FROM (SELECT *, list_position(list_transform(range(1, len(bins)),
            lambda i: (CASE WHEN bins[len(bins)].woe - bins[1].woe >= 0 THEN 1 ELSE -1 END) * (bins[i + 1].woe - bins[i].woe) < 0), true) AS hit FROM st)), tot
        WHERE len(bins) > 2 AND hit > 0),
      fin AS (SELECT feature, unnest(bins) AS b FROM (SELECT feature, arg_max(bins, step) AS bins FROM st GROUP BY 1))"""
    FW, FIV = woe("good", "bad", "goods", "bads")
    cols = ", ".join(f"b.{k} AS {k}" for k in ("bin_id", "lower", "upper", "n", "good", "bad"))
    whole = f"""SELECT feature, bin_id, lower, upper, n, good, bad, {FW} AS woe, {FIV} AS iv FROM (SELECT feature, {cols} FROM fin
        UNION ALL SELECT feature, bin_id, lower, upper, n, good, bad FROM mg WHERE bin_id < 0), tot"""
    q["a10_monotonic_bins"] = f"{runs} SELECT {', '.join(oth)}, {', '.join(f'{rnd(x)} AS {x}' for x in dbl)} FROM ({whole})"
    lookup = """lk AS (SELECT l.uid, l.feature, bins.bin_id, bins.woe FROM l LEFT JOIN bins ON l.feature = bins.feature AND
        (l.value BETWEEN bins.lower AND bins.upper OR (l.value IS NULL AND bins.bin_id = -1)))"""
    q["j7_bin_lookup"] = out("SELECT * FROM lk", ["woe"], ["uid", "feature", "bin_id"], [*B, lookup])
    enc = PAIRED
    q["a11_woe_encode"] = out("SELECT uid, " + ", ".join(f"COALESCE(max(woe) FILTER (feature = '{f}'), 0) AS {f}_woe" for f in enc) + " FROM lk GROUP BY 1",
                              [f"{f}_woe" for f in enc], ["uid"], [*B, lookup])
    lt = f"lt AS ({long('mt', 'uid, date, quarter, target')})"
    before = psi("SELECT feature, 'x' AS base_id, value FROM lt WHERE date <= DATE '1997-12-31'",
                 "SELECT feature, 'x' AS base_id, 'before_vs_after_1997-12-31' AS label, value FROM lt WHERE date > DATE '1997-12-31'")
    q["a12_psi"] = out("SELECT * FROM prow", ["expected_share", "actual_share", "psi"], ["feature", "label", "bin"], [MODEL, TRAIN, lt, *before])
    def plan(base, cmp):
        return out("SELECT * FROM ptab", ["psi"], ["feature", "base_id", "label"], [MODEL, TRAIN, lt, *psi(base, cmp)])
    every = "SELECT feature, 'all' AS base_id, value FROM lt"
    quarters = "SELECT quarter FROM mt GROUP BY 1 HAVING count(*) >= 10"
    byq = f"SELECT feature, 'all' AS base_id, 'Q_' || quarter || '_vs_All' AS label, value FROM lt WHERE quarter IN ({quarters})"
    q["a15_psi_by_quarter"] = plan(every, byq)
    q["a15_psi_by_year"] = plan(every, "SELECT feature, 'all' AS base_id, 'Y_' || year(date) || '_vs_All' AS label, value FROM lt")
    pairs = """(SELECT quarter AS q2, lag(quarter) OVER (ORDER BY quarter) AS q1, n, lag(n) OVER (ORDER BY quarter) AS n1 FROM (SELECT quarter, count(*) AS n FROM mt GROUP BY 1))"""
    q["a15_psi_consecutive"] = plan(
        f"SELECT feature, quarter AS base_id, value FROM lt JOIN {pairs} p ON p.q1 = quarter WHERE n >= 10 AND n1 >= 10",
        f"SELECT feature, q1 AS base_id, q1 || '_vs_' || q2 AS label, value FROM lt JOIN {pairs} p ON p.q2 = quarter WHERE n >= 10 AND n1 >= 10")
    med = "(SELECT quantile_cont(CAST(date - DATE '1970-01-01' AS DOUBLE), 0.5) FROM mt)"
    day = "CAST(date - DATE '1970-01-01' AS DOUBLE)"
    half = "'first_half_vs_second_half'"
    q["a15_psi_halves"] = plan(f"SELECT feature, {half} AS base_id, value FROM lt WHERE {day} <= {med}",
                               f"SELECT feature, {half} AS base_id, {half} AS label, value FROM lt WHERE {day} > {med}")
    q["e4_psi_filter"] = out(f"SELECT feature, max(psi) AS max_psi, avg(psi) AS mean_psi, CASE WHEN max(psi) >= 0.05 THEN 'Eliminated' ELSE 'Kept' END AS status FROM ptab GROUP BY 1",
                             ["max_psi", "mean_psi"], ["feature", "status"], [MODEL, TRAIN, lt, *psi(every, byq)])
    lm = f"lm AS ({long('m', 'uid, date, target')})"
    early = "date <= DATE '1997-12-31'"
    mon = [MODEL, lm, f"le AS (SELECT * FROM lm WHERE {early})", edges("me", "le"),
           f"mb AS (SELECT feature, {bin_of('value', '<=')} AS bin, {early} AS old, count(*) AS k FROM lm JOIN me USING (feature) WHERE value IS NOT NULL AND len(edges) >= 2 AND n >= 50 GROUP BY ALL)",
           "mg AS (SELECT feature, unnest(range(len(edges) - 1)) AS bin FROM me WHERE len(edges) >= 2 AND n >= 50)",
           """mr AS (SELECT feature, bin, greatest(COALESCE(o.k, 0) / CAST(sum(o.k) OVER g AS DOUBLE), 1e-6::DOUBLE) AS e, greatest(COALESCE(c.k, 0) / CAST(sum(c.k) OVER g AS DOUBLE), 1e-6::DOUBLE) AS a
              FROM mg LEFT JOIN (SELECT * FROM mb WHERE old) o USING (feature, bin) LEFT JOIN (SELECT * FROM mb WHERE NOT old) c USING (feature, bin) WINDOW g AS (PARTITION BY feature))""",
           "mn AS (SELECT feature, e / sum(e) OVER g AS e, a / sum(a) OVER g AS a FROM mr WINDOW g AS (PARTITION BY feature))",
           "mo AS (SELECT feature, psi, CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.10 THEN 'warning' ELSE 'stable' END AS status FROM (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM mn GROUP BY 1))"]
    q["a13_monitor_bins"] = out("SELECT feature, CAST(bin AS INTEGER) AS bin, e AS expected, a AS actual, (a - e) * ln(a / e) AS psi FROM (SELECT feature, bin, e / sum(e) OVER g AS e, a / sum(a) OVER g AS a FROM mr WINDOW g AS (PARTITION BY feature))",
                                ["expected", "actual", "psi"], ["feature", "bin"], mon)
    old = "date <= DATE '1995-12-31'"
    hist = [MODEL, lm, f"le AS (SELECT * FROM lm WHERE {old})", edges("me", "le"),
            f"""hb AS (SELECT feature, {bin_of('value', '<=')} AS bin, CASE WHEN {old} THEN 0 ELSE year(date) END AS y, count(*) AS k FROM lm JOIN me USING (feature)
              WHERE value IS NOT NULL AND len(edges) >= 2 AND n >= 50 AND ({old} OR year(date) IN (1996, 1997, 1998)) GROUP BY ALL)""",
            "hg AS (SELECT feature, unnest(range(len(edges) - 1)) AS bin, y FROM me, (SELECT unnest([1996, 1997, 1998]) AS y) WHERE len(edges) >= 2 AND n >= 50)",
            """hr AS (SELECT feature, bin, hg.y, greatest(COALESCE(o.k, 0) / CAST(sum(o.k) OVER g AS DOUBLE), 1e-6::DOUBLE) AS e, greatest(COALESCE(COALESCE(c.k, 0) / CAST(sum(c.k) OVER g AS DOUBLE), 0), 1e-6::DOUBLE) AS a
              FROM hg LEFT JOIN (SELECT feature, bin, k FROM hb WHERE y = 0) o USING (feature, bin) LEFT JOIN hb c USING (feature, bin, y) WINDOW g AS (PARTITION BY feature, hg.y))""",
            "hn AS (SELECT feature, y, e / sum(e) OVER g AS e, a / sum(a) OVER g AS a FROM hr WINDOW g AS (PARTITION BY feature, y))",
            """ho AS (SELECT make_date(y, 12, 31) AS run_date, feature, psi, CASE WHEN psi >= 0.005 THEN 'critical' WHEN psi >= 0.001 THEN 'warning' ELSE 'stable' END AS status
              FROM (SELECT feature, y, sum((a - e) * ln(a / e)) AS psi FROM hn GROUP BY 1, 2))"""]
    level = lambda s: f"list_position(['stable', 'warning', 'critical'], {s})"
    q["a14_run_history"] = out("""SELECT run_date, count(*) AS features, count(*) FILTER (status = 'stable') AS stable, count(*) FILTER (status = 'warning') AS warning,
        count(*) FILTER (status = 'critical') AS critical, max(psi) AS max_psi, avg(psi) AS mean_psi FROM ho GROUP BY 1""", ["max_psi", "mean_psi"], ["run_date", "features", "stable", "warning", "critical"], hist)
    q["a14_status_changes"] = out(f"""SELECT *, CASE WHEN previous_status IS NULL THEN 'new' WHEN {level('status')} > {level('previous_status')} THEN 'worse' ELSE 'better' END AS change
        FROM (SELECT *, lag(psi) OVER w AS previous_psi, lag(status) OVER w AS previous_status FROM ho WINDOW w AS (PARTITION BY feature ORDER BY run_date)) WHERE status <> COALESCE(previous_status, 'stable')""",
        ["psi", "previous_psi"], ["run_date", "feature", "status", "previous_status", "change"], hist)
    q["a13_psi_monitor"] = out("SELECT * FROM mo", ["psi"], ["feature", "status"], mon)
    q["a14_alerts"] = f"""WITH {', '.join(mon)} SELECT feature, status, upper(status) || ': ' || feature || ' PSI = ' || format('{{:.4f}}', psi) AS message
        FROM mo WHERE status <> 'stable'"""
    q["a14_monitoring_record"] = f"""WITH {', '.join(mon)} SELECT DATE '2001-01-01' AS run_date, count(*) AS features, count(*) FILTER (status = 'stable') AS stable,
        count(*) FILTER (status = 'warning') AS warning, count(*) FILTER (status = 'critical') AS critical FROM mo"""
    stats = f"""st AS (SELECT feature, count(value) AS n, count(*) - count(value) AS nulls, (count(*) - count(value)) / CAST(count(*) AS DOUBLE) AS null_ratio,
        count(DISTINCT value) AS distinct_n, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_samp(value) AS std, var_samp(value) AS variance,
        {', '.join(f'quantile_cont(value, {x}) AS p{n}' for x, n in ((0.25, 25), (0.5, 50), (0.75, 75), (0.95, 95), (0.99, 99)))} FROM l GROUP BY 1)"""
    SD = ["null_ratio", "min", "max", "mean", "std", "variance", "p25", "p50", "p75", "p95", "p99"]
    q["a16_numeric_stats"] = out("SELECT * FROM st", SD, ["feature", "n", "nulls", "distinct_n"], [MODEL, LF, stats])
    q["a17_categorical_stats"] = f"WITH {MODEL} SELECT segment AS value, count(*) AS n, (SELECT count(DISTINCT segment) FROM m) AS cardinality FROM m GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
    q["a18_histogram"] = out("""SELECT g.segment, CAST(g.bin AS INTEGER) AS bin, lo + (hi - lo) / 50 * g.bin AS bin_lower, lo + (hi - lo) / 50 * (g.bin + 1) AS bin_upper, count(v.segment) AS n,
          count(v.segment) / CAST(any_value(total) AS DOUBLE) AS density
        FROM (SELECT *, unnest(range(50)) AS bin FROM sg) g LEFT JOIN (SELECT m.segment, least(floor((o_totalprice - lo) / ((hi - lo) / 50)), 49) AS bin FROM m JOIN sg USING (segment)) v
          ON g.segment = v.segment AND g.bin = v.bin GROUP BY g.segment, g.bin, lo, hi""", ["bin_lower", "bin_upper", "density"], ["segment", "bin", "n"],
        [MODEL, "sg AS (SELECT segment, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS total FROM m GROUP BY 1)"])
    one = "v1 AS (SELECT 'x' AS feature, o_totalprice AS value, target FROM m)"
    q["a19_score_bands"] = out(f"""SELECT band, score_min, score_max, n, bads, bads / CAST(n AS DOUBLE) AS bad_rate, CAST(sum(n) OVER o AS BIGINT) AS cum_n, CAST(sum(bads) OVER o AS BIGINT) AS cum_bads,
          sum(bads) OVER o / CAST(sum(n) OVER o AS DOUBLE) AS cum_bad_rate, sum(bads) OVER o / CAST(sum(bads) OVER () AS DOUBLE) AS capture_rate FROM (
          SELECT {bin_of('value')} AS band, min(value) AS score_min, max(value) AS score_max, count(*) AS n, CAST(sum(target) AS BIGINT) AS bads FROM v1 JOIN e1 USING (feature) GROUP BY 1) WINDOW o AS (ORDER BY band)""",
        ["score_min", "score_max", "bad_rate", "cum_bad_rate", "capture_rate"], ["band", "n", "bads", "cum_n", "cum_bads"], [MODEL, one, edges("e1", "v1")])
    q["a19_score_distribution"] = out("SELECT split, count(score) AS n, avg(score) AS mean, stddev_samp(score) AS std, min(score) AS min, max(score) AS max, "
        + ", ".join(f"quantile_cont(score, {x}) AS p{n}" for x, n in ((0.1, 10), (0.25, 25), (0.5, 50), (0.75, 75), (0.9, 90))) + " FROM sp GROUP BY 1",
        ["mean", "std", "min", "max", "p10", "p25", "p50", "p75", "p90"], ["split", "n"], [MODEL])
    # quality and elimination
    q["q8_feature_quality"] = out(f"SELECT feature, null_ratio, distinct_n, variance, iv, {CAT} AS iv_category FROM st LEFT JOIN sm USING (feature)",
                                  ["null_ratio", "variance", "iv"], ["feature", "distinct_n", "iv_category"], [*M, stats, smooth])
    cp = "cp AS (" + " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS correlation FROM m"
                                       for i, a in enumerate(PAIRED) for b in PAIRED[i + 1:]) + ")"
    q["e6_correlation_pairs"] = out("SELECT * FROM cp", ["correlation"], ["feature_a", "feature_b"], [MODEL, cp])
    q["q10_high_correlations"] = out("SELECT * FROM cp WHERE abs(correlation) >= 0.5", ["correlation"], ["feature_a", "feature_b"], [MODEL, cp])
    zero = "mz AS (SELECT " + ", ".join(f"COALESCE({f}, 0) AS {f}" for f in PAIRED) + " FROM m)"
    q["q9_correlation_matrix"] = out(" UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {'1.0' if a == b else f'corr({a}, {b})'} AS correlation FROM mz {'LIMIT 1' if a == b else ''}".replace("FROM mz LIMIT 1", "")
                                     for a in PAIRED for b in PAIRED), ["correlation"], ["feature_a", "feature_b"], [MODEL, zero])
    sn = PAIRED
    rk = "rk AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0::DOUBLE AS {f}" for f in sn) + " FROM mz)"
    q["q9_spearman"] = out(" UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS correlation FROM rk"
                           for i, a in enumerate(sn) for b in sn[i + 1:]), ["correlation"], ["feature_a", "feature_b"], [MODEL, zero, rk])
    ua = auc("ua", "l", "feature", "value")
    reasons = """concat_ws(';', CASE WHEN null_ratio > 0.7 THEN 'missing' END, CASE WHEN iv < 0.02 THEN 'useless' WHEN iv > 0.5 THEN 'suspicious' END,
        CASE WHEN COALESCE(variance, 0) < 0.001 THEN 'near_constant' END, CASE WHEN distinct_n <= 1 THEN 'constant' END)"""
    q["q11_univariate"] = out(f"SELECT *, reasons = '' AS recommended FROM (SELECT st.*, iv, {CAT} AS iv_category, auc, 2 * auc - 1 AS gini, ks_signed AS ks, {reasons} AS reasons "
                              "FROM st JOIN info USING (feature) JOIN ua USING (feature))".replace("st.*", "st.* EXCLUDE (feature), feature"), [*SD, "iv", "auc", "gini", "ks"],
                              ["feature", "nulls", "distinct_n", "n", "iv_category", "reasons", "recommended"], [*M, stats, ua])
    q["e3_iv_filter"] = out(f"""SELECT feature, iv, {CAT} AS iv_category, auc, 2 * auc - 1 AS gini, ks_signed AS ks, CASE WHEN iv < 0.02 OR iv > 0.5 THEN 'Eliminated' ELSE 'Kept' END AS status,
        CASE WHEN iv < 0.02 THEN 'useless' WHEN iv > 0.5 THEN 'suspicious' END AS reason FROM info JOIN ua USING (feature)""",
        ["iv", "auc", "gini", "ks"], ["feature", "iv_category", "status", "reason"], [*M, ua])
    q["e1_constant"] = out("SELECT feature, distinct_n AS unique_count, variance, CASE WHEN distinct_n < 2 THEN 'Eliminated' ELSE 'Kept' END AS status FROM st",
                           ["variance"], ["feature", "unique_count", "status"], [MODEL, LF, stats])
    ls = f"ls AS ({long('sp', 'uid, target, split, quarter')})"
    miss = lambda g: f"avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0 END) FILTER (split {g})"
    q["e2_missing"] = out("SELECT *, CASE WHEN train_missing_rate > 0.01 THEN 'Eliminated' ELSE 'Kept' END AS status FROM (SELECT feature, " + miss("= 'train'") + " AS train_missing_rate, "
        + miss("= 'test'") + " AS test_missing_rate, " + miss("LIKE 'oot%'") + " AS oot_missing_rate FROM ls GROUP BY 1)",
        ["train_missing_rate", "test_missing_rate", "oot_missing_rate"], ["feature", "status"], [MODEL, ls])
    qa = auc("qa", "(SELECT * FROM ls WHERE split <> 'test')", "feature, split, quarter", "value")
    qf = """qf AS (SELECT feature, split LIKE 'oot%' AS o, round(greatest(auc, 1 - auc), 4) AS auc, row_number() OVER (PARTITION BY feature, split LIKE 'oot%' ORDER BY quarter) - 1 AS x
        FROM qa WHERE n >= 30 AND auc IS NOT NULL)"""
    q["e5_temporal_filter"] = out("""SELECT *, CASE WHEN slope < -0.02 OR degradation > 0.05 THEN 'Eliminated' ELSE 'Kept' END AS status FROM (SELECT feature, train_auc, oot_auc, train_auc - oot_auc AS degradation, slope FROM (
        SELECT feature, COALESCE(avg(auc) FILTER (NOT o), 0.5) AS train_auc, COALESCE(avg(auc) FILTER (o), avg(auc) FILTER (NOT o), 0.5) AS oot_auc,
          COALESCE(regr_slope(auc, x) FILTER (NOT o), 0) AS slope FROM qf GROUP BY 1))""", ["train_auc", "oot_auc", "degradation", "slope"], ["feature", "status"], [MODEL, ls, qa, qf])
    q["e7_pairwise_filter"] = out("""SELECT feature, iv, CASE WHEN feature IN (SELECT CASE WHEN a.iv >= b.iv THEN feature_b ELSE feature_a END FROM cp JOIN info a ON a.feature = feature_a
        JOIN info b ON b.feature = feature_b WHERE abs(correlation) >= 0.5) THEN 'Eliminated' ELSE 'Kept' END AS status FROM info WHERE feature <> 'const_1'""",
        ["iv"], ["feature", "status"], [*M, cp])
    q["e11_stratified_split"] = f"WITH {MODEL} SELECT uid, split FROM sp"
    q["e12_temporal_split"] = f"""WITH {MODEL} SELECT uid, CASE WHEN row_number() OVER (ORDER BY date, uid) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split
        FROM m WHERE date <= DATE '2000-06-30' UNION ALL SELECT uid, 'oot_' || quarter FROM m WHERE date > DATE '2000-06-30'"""
    own = "CAST('0x' || substr(md5(uid || '|42'), 1, 15) AS BIGINT)"
    q["e13_random_split"] = f"""WITH {MODEL} SELECT uid, CASE WHEN {own} / 1152921504606846976.0::DOUBLE < 0.2 THEN 'test' WHEN {own} / 1152921504606846976.0::DOUBLE < 0.3 THEN 'validation' ELSE 'train' END AS split FROM m"""
    q["s9_bounded_sample"] = f"WITH {MODEL} SELECT uid, target FROM m ORDER BY {own}, uid LIMIT 5000"
    q["s1_csv_scan"] = "SELECT * FROM customer"
    q["p6_feature_columns"] = f"WITH {MODEL}, pl AS ({long()}) SELECT feature, count(*) AS n, count(value) AS known FROM pl GROUP BY 1"
    q["e14_split_metadata"] = out("SELECT split, count(*) AS n, CAST(sum(target) AS BIGINT) AS n_bads, avg(target) AS bad_rate, min(date) AS first_date, max(date) AS last_date FROM sp GROUP BY 1",
                                  ["bad_rate"], ["split", "n", "n_bads", "first_date", "last_date"], [MODEL])
    q["t3_top_share"] = f"WITH {MODEL} SELECT uid FROM (SELECT uid, row_number() OVER (ORDER BY score DESC, uid) AS r, count(*) OVER () AS n FROM m) WHERE r <= greatest(1, floor(n * 0.05))"
    # metrics
    q["m1_auc_by_feature"] = out("SELECT feature, n, n_bads, auc, 2 * auc - 1 AS gini FROM ua", ["auc", "gini"], ["feature", "n", "n_bads"], [MODEL, LF, ua])
    q["m1b_auc_chunked"] = out("SELECT auc FROM oa", ["auc"], [], [MODEL, auc("oa", "(SELECT 1 AS k, target, o_totalprice AS score FROM m)", "k")])
    q["m2_ks_by_feature"] = out("SELECT feature, ks, ks_threshold, ks_signed FROM ua", ["ks", "ks_threshold", "ks_signed"], ["feature"], [MODEL, LF, ua])
    seg = "vs AS (SELECT segment AS feature, o_totalprice AS value, target FROM m)"
    br = "bads / CAST(n AS DOUBLE)"
    ov = "(sum(bads) OVER w / CAST(sum(n) OVER w AS DOUBLE))"
    cb = "(sum(bads) OVER o / CAST(sum(n) OVER o AS DOUBLE))"
    q["m3_lift_table"] = out(f"""SELECT segment, decile, score_min, score_max, score_mean, n, bads, {br} AS bad_rate, {br} / {ov} AS lift, CAST(sum(n) OVER o AS BIGINT) AS cum_n, CAST(sum(bads) OVER o AS BIGINT) AS cum_bads,
        {cb} AS cum_bad_rate, {cb} / {ov} AS cum_lift, sum(bads) OVER o / CAST(sum(bads) OVER w AS DOUBLE) AS capture_rate FROM (
          SELECT feature AS segment, CAST(max(len(edges)) - 1 - {bin_of('value')} AS INTEGER) AS decile, min(value) AS score_min, max(value) AS score_max, avg(value) AS score_mean, count(*) AS n, CAST(sum(target) AS BIGINT) AS bads
          FROM vs JOIN e1 USING (feature) GROUP BY feature, {bin_of('value')}) WINDOW w AS (PARTITION BY segment), o AS (PARTITION BY segment ORDER BY decile)""",
        ["score_min", "score_max", "score_mean", "bad_rate", "lift", "cum_bad_rate", "cum_lift", "capture_rate"], ["segment", "decile", "n", "bads", "cum_n", "cum_bads"], [MODEL, seg, edges("e1", "vs")])
    topk = lambda by, src: f"""tk AS (SELECT {by}, count(*) FILTER (r <= greatest(1, floor(n * 0.1))) AS top_n, avg(target) FILTER (r <= greatest(1, floor(n * 0.1))) AS precision,
        avg(target) FILTER (r <= greatest(1, floor(n * 0.1))) / avg(target) AS lift FROM (SELECT {by}, target, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, uid) AS r, count(*) OVER (PARTITION BY {by}) AS n FROM {src}) GROUP BY 1)"""  # noqa: E731
    q["m4_precision_at_k"] = out("SELECT * FROM tk", ["precision", "lift"], ["split", "top_n"], [MODEL, topk("split", "sp")])
    ts = "[0.1::DOUBLE, 0.2, 0.3, 0.4, 0.5]"
    q["m5_confusion"] = out(confusion("segment") + " FROM " + counts("segment", "m", ts), CONF, ["segment", *CNT], [MODEL])
    q["m6_log_loss"] = out("SELECT split, avg(CASE WHEN target = 1 THEN -ln(score) ELSE -ln(1 - score) END) AS log_loss FROM sp GROUP BY 1", ["log_loss"], ["split"], [MODEL])
    def perf(period, src):
        return out("SELECT period, n, n_bads, bad_rate, auc, 2 * auc - 1 AS gini, ks, precision, lift FROM pa JOIN tk USING (period) WHERE auc IS NOT NULL AND n >= 1",
                   ["bad_rate", "auc", "gini", "ks", "precision", "lift"], ["period", "n", "n_bads"],
                   [MODEL, f"pm AS (SELECT *, {period} AS period FROM {src})", auc("pa", "pm", "period"), topk("period", "pm")])
    q["m7_performance_by_period"] = perf("split", "sp")
    q["m7_performance_by_quarter"] = perf("quarter", "m").replace("n >= 1", "n >= 30")
    lq = f"lq AS ({long('m', 'uid, target, quarter')})"
    q["m8_variable_quarterly_auc"] = out("""SELECT feature, avg(auc) AS avg_auc, min(auc) AS min_auc, CASE WHEN count(*) >= 2 THEN regr_slope(auc, x) END AS trend_slope FROM (
        SELECT feature, greatest(auc, 1 - auc) AS auc, row_number() OVER (PARTITION BY feature ORDER BY quarter) - 1 AS x FROM va WHERE n >= 30 AND auc IS NOT NULL) GROUP BY 1""",
        ["avg_auc", "min_auc", "trend_slope"], ["feature"], [MODEL, lq, auc("va", "lq", "feature, quarter", "value")])
    sa = auc("sa", "sp", "split")
    q["m9_quarterly_trend"] = out("""SELECT *, CASE WHEN delta_auc > 0.01 THEN 'Improving' WHEN delta_auc < -0.01 THEN 'Degrading' ELSE 'Stable' END AS trend FROM (
        SELECT split AS period, auc, 2 * auc - 1 AS gini, ks, auc - lag(auc) OVER (ORDER BY split) AS delta_auc, (SELECT auc FROM sa WHERE split = 'train') - auc AS auc_vs_train FROM sa WHERE split LIKE 'oot%')""",
        ["auc", "gini", "ks", "delta_auc", "auc_vs_train"], ["period", "trend"], [MODEL, sa])
    q["m11_score_psi"] = out("SELECT label AS period, psi, CASE WHEN psi IS NULL THEN 'N/A' WHEN psi < 0.1 THEN 'Stable' WHEN psi < 0.25 THEN 'Moderate' ELSE 'Significant' END AS status FROM ptab",
        ["psi"], ["period", "status"], [MODEL, *psi("SELECT 's' AS feature, 'train' AS base_id, o_totalprice AS value FROM sp WHERE split = 'train'",
                                                    "SELECT 's' AS feature, 'train' AS base_id, split AS label, o_totalprice AS value FROM sp WHERE split <> 'train'")])
    q["m12_segment_performance"] = out("SELECT segment, split, n, n_bads, bad_rate, auc, 2 * auc - 1 AS gini, ks FROM ga WHERE n >= 10", ["bad_rate", "auc", "gini", "ks"],
                                       ["segment", "split", "n", "n_bads"], [MODEL, auc("ga", "sp", "segment, split")])
    q["m12_segment_confusion"] = out(confusion("segment, split") + " FROM " + counts("segment, split", "sp", "[0.1, 0.2, 0.3, 0.4, 0.5]::DOUBLE[]") + " WHERE tp + fn > 0 AND fp + tn > 0 AND tp + fp + tn + fn >= 10",
                                     CONF, ["segment", "split", *CNT], [MODEL])
    two = "mm AS (SELECT 'score' AS model, score, target FROM m UNION ALL SELECT 'flat', (uid % 97) / 100.0::DOUBLE, target FROM m)"
    q["m13_model_comparison"] = out(f"SELECT model, auc, 2 * auc - 1 AS gini, ks, accuracy, precision, recall, f1, row_number() OVER (ORDER BY auc DESC, model) AS rank FROM ma JOIN ({confusion('model')} FROM {counts('model', 'mm', '[0.5::DOUBLE]')}) USING (model)",
                                    ["auc", "gini", "ks", "accuracy", "precision", "recall", "f1"], ["model", "rank"], [MODEL, two, auc("ma", "mm", "model")])
    curve = "cc AS (SELECT CAST(least(len(list_filter([0.1::DOUBLE, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9], lambda e: e <= score)), 9) AS INTEGER) AS bin, count(*) AS n, avg(score) AS mean_predicted, avg(target) AS fraction_positive FROM m GROUP BY 1)"
    q["m15_calibration_curve"] = out("SELECT * FROM cc", ["mean_predicted", "fraction_positive"], ["bin", "n"], [MODEL, curve])
    sc = "v1 AS (SELECT 'x' AS feature, score AS value, target FROM m)"
    hl = f"hl AS (SELECT {bin_of('value')} AS bin, count(*) AS n, sum(target) AS o, sum(value) AS e FROM v1 JOIN e1 USING (feature) GROUP BY 1)"
    q["m15_calibration_quality"] = out(f"""SELECT *, {CHI2_TAIL} AS p_value FROM (SELECT (SELECT avg(pow(score - target, 2)) FROM m) AS brier, (SELECT sum(n * abs(fraction_positive - mean_predicted)) / sum(n) FROM cc) AS ece,
        (SELECT sum(pow(o - e, 2) / e + pow(o - e, 2) / (n - e)) FROM hl) AS chi2, (SELECT greatest(count(*) - 2, 1) FROM hl) AS dof)""", ["brier", "ece", "chi2", "p_value"], ["dof"], [MODEL, curve, sc, edges("e1", "v1"), hl])
    # a step's value is the largest, over starts up to the score, of the least mean from there to an end at or beyond it
    q["m14_isotonic_steps"] = out("""SELECT s.score, s.n, s.bad, v AS calibrated FROM lv s JOIN (
          SELECT i, max(low) AS v FROM (SELECT a, i, min(mean) OVER (PARTITION BY a ORDER BY i DESC) AS low FROM (
            SELECT x.i AS a, y.i AS i, (y.cb - x.cb + x.bad) / CAST(y.cn - x.cn + x.n AS DOUBLE) AS mean FROM lv x JOIN lv y ON y.i >= x.i)) GROUP BY i) USING (i)""",
        ["score", "calibrated"], ["n", "bad"], [MODEL, """lv AS (SELECT *, CAST(sum(n) OVER o AS BIGINT) AS cn, CAST(sum(bad) OVER o AS BIGINT) AS cb, row_number() OVER o AS i
          FROM (SELECT score, count(*) AS n, CAST(sum(target) AS BIGINT) AS bad FROM m GROUP BY 1) WINDOW o AS (ORDER BY score))"""])
    # draws from the generator of the query: a key per score, a counter per draw, Poisson by inversion
    two64 = "18446744073709551616::UHUGEINT"
    mix = lambda x, shift, by: f"CAST((CAST(xor({x}, {x} >> {shift}) AS UHUGEINT) * {by}::UHUGEINT) % {two64} AS UBIGINT)"
    q["m10_bootstrap"] = out("""SELECT g.split, auc, n, lo AS ci_lower, hi AS ci_upper, iterations FROM ba g LEFT JOIN (
          SELECT split, quantile_cont(v, 0.025) AS lo, quantile_cont(v, 0.975) AS hi, count(v) AS iterations FROM (
            SELECT split, it, CASE WHEN sum(b) > 0 AND sum(g) > 0 THEN sum(b * (gb + g / 2)) / (sum(b) * sum(g)) END AS v FROM (
              SELECT *, COALESCE(sum(g) OVER (PARTITION BY split, it ORDER BY below ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gb FROM dr) GROUP BY ALL) GROUP BY 1) c ON g.split = c.split WHERE auc IS NOT NULL""",
        ["auc", "ci_lower", "ci_upper"], ["split", "n", "iterations"], [MODEL, auc("ba", "sp", "split"),
        """lv AS (SELECT split, score, n, bad, n - bad AS good, CAST(sum(n) OVER (PARTITION BY split ORDER BY score) - n AS BIGINT) AS below FROM (
          SELECT split, score, count(*) AS n, CAST(sum(target) AS BIGINT) AS bad FROM sp GROUP BY 1, 2))""",
        """un AS (SELECT split, below, bad, good, it, side, CAST((CAST(CAST('0x' || substr(md5('42|' || split || '|' || below), 1, 15) AS BIGINT) AS UHUGEINT) + CAST(2 * it + side AS UHUGEINT) * 11400714819323198485::UHUGEINT)
          % 18446744073709551616::UHUGEINT AS UBIGINT) AS h0 FROM lv, (SELECT unnest(range(1000)) AS it), (SELECT unnest([1, 2]) AS side))""",
        f"u1 AS (SELECT *, {mix('h0', 30, '13787848793156543929')} AS h1 FROM un)", f"u2 AS (SELECT *, {mix('h1', 27, '10723151780598845931')} AS h2 FROM u1)",
        "u3 AS (SELECT split, below, it, side, CASE WHEN side = 1 THEN bad ELSE good END AS mean, (xor(h2, h2 >> 31) >> 11) / 9007199254740992.0::DOUBLE AS u FROM u2)",
        "mw AS (SELECT DISTINCT mean, CAST(greatest(0, floor(mean - (12 * sqrt(mean) + 40))) AS BIGINT) AS lo, CAST(ceil(mean + 12 * sqrt(mean) + 40) AS BIGINT) AS hi FROM u3 WHERE mean > 0)",
        """cdf AS (SELECT mean, x, sum(exp(-mean + x * ln(mean) - lgamma(x + 1))) OVER (PARTITION BY mean ORDER BY x) AS upto
          FROM (SELECT mean, unnest(range(lo, hi + 1)) AS x FROM mw))""",
        # the least value whose distribution function is above u
        "dn AS (SELECT u3.*, CASE WHEN u3.mean = 0 THEN 0 ELSE COALESCE(a.x + 1, lo) END AS d FROM u3 LEFT JOIN mw USING (mean) ASOF LEFT JOIN cdf a ON u3.mean = a.mean AND u3.u >= a.upto)",
        "dr AS (SELECT split, below, it, CAST(sum(d) FILTER (side = 1) AS DOUBLE) AS b, CAST(sum(d) FILTER (side = 2) AS DOUBLE) AS g FROM dn GROUP BY ALL)"])
    safe = "sf AS (SELECT uid, target, 1 - score + (uid % 10) / 200.0::DOUBLE AS score FROM m)"
    def cut(probs):
        return f"(SELECT DISTINCT c AS cutoff FROM (SELECT unnest(quantile_cont(score, [{', '.join(repr(p) for p in probs)}])) AS c FROM sf))"
    ana = lambda probs: f"""an AS (SELECT cutoff, count(*) AS total, sum(target) AS bads, count(*) FILTER (score >= cutoff) AS ok, COALESCE(sum(target) FILTER (score >= cutoff), 0) AS okb
        FROM sf, {cut(probs)} GROUP BY 1)"""  # noqa: E731
    p, r = "CASE WHEN ok > 0 AND ok < total THEN " + div0("bads - okb", "total - ok") + " ELSE 0 END", "CASE WHEN ok > 0 AND ok < total THEN " + div0("bads - okb", "bads") + " ELSE 0 END"
    step = 90 / 19
    q["m17_cutoff_table"] = out(f"""SELECT cutoff, ok / CAST(total AS DOUBLE) AS approval_rate, (total - ok) / CAST(total AS DOUBLE) AS rejection_rate, {div0('okb', 'ok')} AS bad_rate_approved,
        {div0('bads - okb', 'total - ok')} AS bad_rate_rejected, {p} AS precision, {r} AS recall, {div0(f'2 * ({p}) * ({r})', f'({p}) + ({r})')} AS f1,
        CAST(bads - okb AS BIGINT) AS tp, CAST(total - ok - bads + okb AS BIGINT) AS fp, CAST(ok - okb AS BIGINT) AS tn, CAST(okb AS BIGINT) AS fn FROM an""",
        ["cutoff", "approval_rate", "rejection_rate", "bad_rate_approved", "bad_rate_rejected", "precision", "recall", "f1"], CNT, [MODEL, safe, ana([(5 + i * step) / 100 for i in range(20)])])
    q["m16_cutoffs"] = out("""SELECT 'ks' AS method, max(CASE WHEN d = dm THEN sc END) AS cutoff FROM (SELECT *, max(d) OVER () AS dm FROM (SELECT sc, pos_up / CAST(pos AS DOUBLE) - (n_up - pos_up) / CAST(tot - pos AS DOUBLE) AS d FROM ka_r))
        UNION ALL SELECT 'cost', arg_min(cutoff, (5 * okb + (total - ok - bads + okb), cutoff)) FROM an
        UNION ALL SELECT 'approval', quantile_cont(score, 0.4) FROM sf
        UNION ALL SELECT 'bad_rate', CASE WHEN hit IS NULL THEN low ELSE COALESCE(above, top) END FROM (SELECT hit, low, top, (SELECT min(sc) FROM br WHERE sc > hit) AS above FROM
          (SELECT max(CASE WHEN rate > 0.1 THEN sc END) AS hit, min(sc) AS low, max(sc) AS top FROM br))""", ["cutoff"], ["method"],
        [MODEL, safe, auc("ka", "(SELECT 1 AS k, target, score FROM sf)", "k"), ana([i / 100 for i in range(1, 100)]), "br AS (SELECT DISTINCT sc, pos_up / CAST(n_up AS DOUBLE) AS rate FROM ka_r)"])
    q["m17_several_cutoffs"] = out(f"""SELECT method, cutoff, ok / CAST(total AS DOUBLE) AS approval_rate, (total - ok) / CAST(total AS DOUBLE) AS rejection_rate, {div0('okb', 'ok')} AS bad_rate_approved,
        {div0('bads - okb', 'total - ok')} AS bad_rate_rejected, {p} AS precision, {r} AS recall, {div0(f'2 * ({p}) * ({r})', f'({p}) + ({r})')} AS f1,
        CAST(bads - okb AS BIGINT) AS tp, CAST(total - ok - bads + okb AS BIGINT) AS fp, CAST(ok - okb AS BIGINT) AS tn, CAST(okb AS BIGINT) AS fn FROM (
          SELECT method, cutoff, count(*) AS total, sum(target) AS bads, count(*) FILTER (score >= cutoff) AS ok, COALESCE(sum(target) FILTER (score >= cutoff), 0) AS okb FROM sf, cs GROUP BY ALL)""",
        ["cutoff", "approval_rate", "rejection_rate", "bad_rate_approved", "bad_rate_rejected", "precision", "recall", "f1"], ["method", *CNT],
        [MODEL, safe, auc("ka", "(SELECT 1 AS k, target, score FROM sf)", "k"), "br AS (SELECT DISTINCT sc, pos_up / CAST(n_up AS DOUBLE) AS rate FROM ka_r)",
         """cs AS (SELECT 'ks' AS method, max(CASE WHEN d = dm THEN sc END) AS cutoff FROM (SELECT *, max(d) OVER () AS dm FROM (SELECT sc, pos_up / CAST(pos AS DOUBLE) - (n_up - pos_up) / CAST(tot - pos AS DOUBLE) AS d FROM ka_r))
           UNION ALL SELECT 'approval_50', quantile_cont(score, 0.5) FROM sf UNION ALL SELECT 'approval_70', quantile_cont(score, 1 - 0.7::DOUBLE) FROM sf
           UNION ALL SELECT 'bad_rate_5', CASE WHEN hit IS NULL THEN low ELSE COALESCE(above, top) END FROM (SELECT hit, low, top, (SELECT min(sc) FROM br WHERE sc > hit) AS above FROM
             (SELECT max(CASE WHEN rate > 0.05 THEN sc END) AS hit, min(sc) AS low, max(sc) AS top FROM br)))"""])
    q["a2_sketch_rank_errors"] = f"WITH {MODEL}, {LF} SELECT feature, i / 10.0::DOUBLE AS prob, count(value) AS n, TRUE AS within FROM l, (SELECT unnest(range(1, 10)) AS i) GROUP BY ALL"
    # scorecard
    q["l3_stability_objective"] = out("SELECT feature, mean_auc, std_auc, mean_auc - std_auc AS score FROM (SELECT feature, avg(auc) AS mean_auc, stddev_pop(auc) AS std_auc FROM fa WHERE feature <> 'const_1' GROUP BY 1)",
                                      ["mean_auc", "std_auc", "score"], ["feature"], [MODEL, ls, auc("fa", "ls", "feature, split", "value")])
    coef, mean, scale, b0 = {"signal": -0.9, "o_totalprice": -0.4}, {"signal": -0.1, "o_totalprice": 0.05}, {"signal": 1.5, "o_totalprice": 0.5}, -0.7
    f1 = 20 / math.log(2)
    base = (600 - f1 * math.log(50) - f1 * b0) / 2
    case = lambda d: "CASE feature " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in d.items()) + " END"
    only = "feature IN ('signal', 'o_totalprice')"
    card = f"card AS (SELECT *, {case(coef)} AS coefficient, CAST(round_even({base!r}::DOUBLE - {f1!r}::DOUBLE * {case(coef)} * woe, 0) AS INTEGER) AS points FROM bins WHERE {only})"
    q["l4_scorecard"] = out("SELECT * FROM card", ["woe", "coefficient"], ["feature", "bin_id", "points"], [*B, card])
    f2 = 50 / math.log(2)
    off = 600 - f2 * math.log(20)
    slope = {k: coef[k] / scale[k] for k in coef}
    share = {k: b0 / 2 - coef[k] * mean[k] / scale[k] for k in coef}
    q["l5_scaled_scorecard"] = out(f"SELECT feature, bin_id, woe, {case(slope)} AS coefficient, CAST(round_even(-({case(slope)} * woe + {case(share)}) * {f2!r}::DOUBLE + {off / 2!r}::DOUBLE, 0) AS INTEGER) AS points FROM bins WHERE {only}",
                                   ["woe", "coefficient"], ["feature", "bin_id", "points"], B)
    q["l6_scored_rows"] = f"""WITH {', '.join([*B, card])} SELECT l.uid, CAST(least(greatest(COALESCE(sum(points), 0), 300), 850) AS INTEGER) AS scorecard_score FROM l LEFT JOIN card
        ON l.feature = card.feature AND (l.value BETWEEN card.lower AND card.upper OR (l.value IS NULL AND card.bin_id = -1)) GROUP BY 1"""
    q["l7_joint_scores"] = out(f"""SELECT application_id, min(s) AS min_score, avg(s) AS avg_score, sum(w * s) / sum(w) AS weighted_score, count(*) AS applicants FROM (
        SELECT application_id, 850 - 10 * COALESCE(n, 0) AS s, CASE WHEN applicant_type = 'PRIMARY' THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END AS w FROM app LEFT JOIN (SELECT {K}, count(*) AS n FROM t GROUP BY ALL) USING ({K})) GROUP BY 1""",
        ["min_score", "avg_score", "weighted_score"], ["application_id", "applicants"], [APP, BUR, T])
    # checks on result tables
    rows = [("discrimination_auc", "CASE WHEN (SELECT min(auc) FROM pa) < 0.65 THEN 'FAIL' ELSE 'PASS' END", "critical"),
            ("discrimination_gini", "CASE WHEN (SELECT min(2 * auc - 1) FROM pa) < 2 * 0.65 - 1 THEN 'WARNING' ELSE 'PASS' END", "warning"),
            ("overfitting", "CASE WHEN (SELECT max(auc) FILTER (period = 'train') - max(auc) FILTER (period = 'test') FROM pa) > 0.05 THEN 'WARNING' ELSE 'PASS' END", "warning"),
            ("oot_stability", "CASE WHEN (SELECT max(auc) FILTER (period = 'test') - min(auc) FILTER (period LIKE 'oot%') FROM pa) > 0.08 THEN 'WARNING' ELSE 'PASS' END", "warning"),
            ("score_psi", "CASE WHEN (SELECT max(psi) FROM ptab) > 0.25 THEN 'WARNING' ELSE 'PASS' END", "warning"),
            ("concentration", "CASE WHEN (SELECT max(iv) / sum(iv) FROM info) > 0.5 THEN 'WARNING' ELSE 'PASS' END", "warning"),
            ("woe_monotonicity", "CASE WHEN (SELECT count(*) FROM (SELECT feature, min(s) AS lo, max(s) AS hi FROM (SELECT feature, woe - lag(woe) OVER (PARTITION BY feature ORDER BY bin_id) AS s FROM bins WHERE bin_id >= 0) GROUP BY 1) WHERE lo < 0 AND hi > 0) > 0 THEN 'WARNING' ELSE 'PASS' END", "info"),
            ("oot_sample_size", "CASE WHEN (SELECT min(n_bads) FROM pa WHERE period LIKE 'oot%') < 50 THEN 'WARNING' ELSE 'PASS' END", "warning")]
    ctes = [*B, WT, INFO, "pm AS (SELECT *, split AS period FROM sp)", auc("pa", "pm", "period"),
            *psi("SELECT 's' AS feature, 'train' AS base_id, score AS value FROM sp WHERE split = 'train'", "SELECT 's' AS feature, 'train' AS base_id, split AS label, score AS value FROM sp WHERE split <> 'train'")]
    q["q14_post_model_checks"] = f"WITH {', '.join(ctes)} " + " UNION ALL ".join(f"SELECT '{a}' AS check_name, {b} AS status, '{s}' AS severity" for a, b, s in rows)
    return q
