"""DuckDB SQL for every deterministic catalogue query (the correctness oracle).

Tables ``lineitem orders part ...`` are views over the same Parquet files.
Column names and types line up with the Spark output: counts and day
differences are BIGINT, money aggregates are DOUBLE cast from exact decimal
sums, and doubles that depend on summation order are rounded to 6 places on
both sides.
"""

from __future__ import annotations

from clientele.sources.transactions import transactions_sql_cte

TXN = transactions_sql_cte()

# NA-counting distinct count (a missing value counts as one more value)
def _nd(col: str) -> str:
    return (f"CAST(count(DISTINCT {col}) + max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END)"
            f" AS BIGINT)")


APP = "app AS (SELECT * FROM txn WHERE order_status = 'Approved')"

LRFMPV = f"""
lrfmpv_agg AS (
  SELECT customer_id,
         min(transaction_date) AS first_order,
         max(transaction_date) AS last_order,
         {_nd('transaction_id')} AS F,
         CAST(coalesce(sum(net_revenue), 0) AS DOUBLE) AS M,
         {_nd('category')} AS V
  FROM app GROUP BY customer_id
),
lrfmpv AS (
  SELECT customer_id, first_order, last_order, F, M, V,
         CAST(date_diff('day', first_order, last_order) AS BIGINT) AS L,
         CAST(date_diff('day', last_order,
              (SELECT max(transaction_date) + 1 FROM app)) AS BIGINT) AS R,
         CASE WHEN F > 1 THEN CAST(date_diff('day', first_order, last_order) AS DOUBLE)
                              / CAST(F - 1 AS DOUBLE) END AS P
  FROM lrfmpv_agg
)"""

GROUP = ("CASE WHEN category IN ('Dresses','Tops','Skirts','Outerwear') THEN 'fashion' "
         "WHEN category IN ('Shoes','Bags','Accessories') THEN 'accessory' ELSE 'other' END")

CHURN_BASE = """
churn_base AS (
  SELECT *, CAST(recency_days > 180 AS INTEGER) AS churn_flag FROM (
    SELECT l.*, CAST(date_diff('day', l.last_order,
                (SELECT max(transaction_date) FROM txn)) AS BIGINT) AS recency_days
    FROM lrfmpv l))"""

DEPENDENCY = """
cat_rev AS (
  SELECT customer_id, category, coalesce(sum(net_revenue), 0) AS rev
  FROM txn GROUP BY customer_id, category
),
cat_share AS (
  SELECT customer_id, category, rev,
         CASE WHEN sum(rev) OVER (PARTITION BY customer_id) = 0 THEN NULL
              ELSE CAST(rev AS DOUBLE) / CAST(sum(rev) OVER (PARTITION BY customer_id) AS DOUBLE)
         END AS share
  FROM cat_rev
),
dependency AS (
  SELECT customer_id, category AS dominant_category, CAST(rev AS DOUBLE) AS category_revenue,
         share AS dominant_category_share
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                 ORDER BY share DESC NULLS LAST, category ASC NULLS LAST) AS rk
        FROM cat_share) WHERE rk = 1
)"""


def _decline(threshold: float) -> str:
    return f"""
decline_src AS (
  SELECT t.*, t.transaction_date > a.d - INTERVAL 3 MONTH AS is_recent
  FROM txn t, (SELECT max(transaction_date) AS d FROM txn) a
  WHERE t.transaction_date > a.d - INTERVAL 6 MONTH
),
decline AS (
  SELECT category, recent_3m, previous_3m,
         recent_3m / greatest(previous_3m, 1.0) AS category_decline_ratio,
         CAST(recent_3m / greatest(previous_3m, 1.0) < {threshold} AS INTEGER)
           AS category_decline_flag
  FROM (SELECT category,
               CAST(coalesce(sum(CASE WHEN is_recent THEN net_revenue END), 0) AS DOUBLE) AS recent_3m,
               CAST(coalesce(sum(CASE WHEN NOT is_recent THEN net_revenue END), 0) AS DOUBLE)
                 AS previous_3m
        FROM decline_src GROUP BY category)
)"""


def _signal(decline_threshold: float, share_threshold: float) -> str:
    return f"""WITH {TXN}, {APP}, {LRFMPV}, {CHURN_BASE}, {DEPENDENCY}, {_decline(decline_threshold)},
signal AS (
  SELECT *, CAST(churn_flag = 1 AND high_category_dependency = 1
                 AND category_decline_flag = 1 AS INTEGER) AS possible_dependency_failure
  FROM (
    SELECT b.*, d.dominant_category, d.category_revenue, d.dominant_category_share,
           c.recent_3m, c.previous_3m, c.category_decline_ratio, c.category_decline_flag,
           CAST(d.dominant_category_share >= {share_threshold} AS INTEGER) AS high_category_dependency
    FROM churn_base b
    LEFT JOIN dependency d ON b.customer_id IS NOT DISTINCT FROM d.customer_id
    LEFT JOIN decline c ON d.dominant_category IS NOT DISTINCT FROM c.category))
"""


FRICTION = f"""WITH {TXN}, {APP}, {LRFMPV}, {CHURN_BASE},
recent AS (
  SELECT customer_id,
         CAST(coalesce(sum(quantity), 0) AS DOUBLE) AS recent_quantity,
         CAST(coalesce(sum(returned_qty), 0) AS DOUBLE) AS recent_returned_qty,
         CAST(coalesce(sum(refund_amount), 0) AS DOUBLE) AS recent_refund_amount,
         CAST(coalesce(sum(returned_qty), 0) AS DOUBLE)
           / greatest(CAST(coalesce(sum(quantity), 0) AS DOUBLE), 1.0) AS recent_return_ratio
  FROM (SELECT t.* FROM txn t JOIN churn_base b ON t.customer_id IS NOT DISTINCT FROM b.customer_id
        WHERE t.transaction_date >= b.last_order - INTERVAL 180 DAY
          AND t.transaction_date <= b.last_order)
  GROUP BY customer_id
),
signal AS (
  SELECT *, CAST(churn_flag = 1 AND high_return_flag = 1 AS INTEGER) AS possible_operational_friction
  FROM (SELECT b.*, r.recent_quantity, r.recent_returned_qty, r.recent_refund_amount,
               r.recent_return_ratio,
               CAST(r.recent_return_ratio >= 0.25 AS INTEGER) AS high_return_flag
        FROM churn_base b LEFT JOIN recent r ON b.customer_id IS NOT DISTINCT FROM r.customer_id))
"""

BASE = f"""
customer_base AS (
  SELECT customer_id,
         CAST(coalesce(sum(net_revenue), 0) AS DOUBLE) AS total_revenue,
         CAST(coalesce(sum(gross_profit), 0) AS DOUBLE) AS total_profit,
         {_nd('transaction_id')} AS total_orders,
         CAST(coalesce(sum(quantity), 0) AS DOUBLE) AS total_items,
         CASE WHEN count(*) > count(transaction_date) THEN NULL ELSE min(transaction_date) END
           AS first_order,
         CASE WHEN count(*) > count(transaction_date) THEN NULL ELSE max(transaction_date) END
           AS last_order,
         CASE WHEN coalesce(sum(quantity), 0) = 0 THEN NULL
              ELSE CAST(coalesce(sum(returned_qty), 0) AS DOUBLE)
                   / CAST(coalesce(sum(quantity), 0) AS DOUBLE) END AS return_rate
  FROM txn GROUP BY customer_id
),
base AS (
  SELECT customer_id, total_revenue, total_profit, total_orders, total_items, first_order,
         last_order,
         CAST(date_diff('day', last_order, (SELECT max(transaction_date) FROM txn)) AS BIGINT)
           AS recency,
         total_revenue / CAST(total_orders AS DOUBLE) AS avg_order_value,
         return_rate
  FROM customer_base
),
seg AS (
  SELECT *,
    CASE WHEN profit_segment IN (4,5) AND revenue_segment IN (1,2) THEN 'Profit Core'
         WHEN profit_segment IN (4,5) AND revenue_segment = 3 THEN 'Rising Stars'
         WHEN profit_segment IN (4,5) AND revenue_segment IN (4,5) THEN 'MVC'
         ELSE 'Mass' END AS segment
  FROM (SELECT *,
          CAST(ntile(5) OVER (ORDER BY total_revenue, customer_id NULLS LAST) AS INTEGER)
            AS revenue_segment,
          CAST(ntile(5) OVER (ORDER BY total_profit, customer_id NULLS LAST) AS INTEGER)
            AS profit_segment
        FROM base)
)"""

COHORT = f"""
cm AS (
  SELECT customer_id, transaction_month,
         min(transaction_month) OVER (PARTITION BY customer_id) AS cohort_month
  FROM (SELECT DISTINCT customer_id, date_trunc('month', transaction_date)::DATE AS transaction_month
        FROM app)
),
counts AS (
  SELECT cohort_month,
         CAST((year(transaction_month) * 12 + month(transaction_month))
              - (year(cohort_month) * 12 + month(cohort_month)) AS BIGINT) AS cohort_index,
         count(*) AS customers
  FROM cm GROUP BY ALL
),
sized AS (
  SELECT *, max(CASE WHEN cohort_index = 0 THEN customers END)
              OVER (PARTITION BY cohort_month) AS cohort_size
  FROM counts
),
tenths AS (
  SELECT *, CASE WHEN cohort_size > 0 THEN
              (customers * 1000) // cohort_size
              + CASE WHEN 2 * ((customers * 1000) % cohort_size) > cohort_size
                       OR (2 * ((customers * 1000) % cohort_size) = cohort_size
                           AND ((customers * 1000) // cohort_size) % 2 = 1) THEN 1 ELSE 0 END
            END AS t
  FROM sized
),
retention AS (
  SELECT cohort_month, cohort_index, customers, cohort_size,
         CAST(customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) AS retention_rate,
         CASE WHEN t IS NULL THEN NULL
              WHEN t % 10 = 0 THEN CAST(t // 10 AS VARCHAR) || '%'
              ELSE CAST(t // 10 AS VARCHAR) || '.' || CAST(t % 10 AS VARCHAR) || '%' END
           AS retention_label,
         CAST(t AS DOUBLE) / 10.0 AS retention_pct
  FROM tenths
)"""

DM = f"""
dm AS (
  SELECT customer_id,
    min(transaction_date) AS first_order,
    max(transaction_date) AS last_order,
    {_nd('transaction_id')} AS F,
    CAST(coalesce(sum(net_revenue), 0) AS DOUBLE) AS M,
    CAST(coalesce(sum(gross_profit), 0) AS DOUBLE) AS profit,
    CAST(date_diff('day', max(transaction_date), (SELECT max(transaction_date) FROM txn)) AS BIGINT) AS R,
    CAST(date_diff('day', min(transaction_date), max(transaction_date)) AS BIGINT) AS L,
    {_nd('grp')} AS V,
    CASE WHEN count(net_revenue) = 0 THEN NULL
         ELSE CAST(sum(net_revenue) AS DOUBLE) / CAST(count(net_revenue) AS DOUBLE) END AS avg_basket,
    {_nd('grp')} AS category_diversity,
    {_nd('brand')} AS brand_diversity,
    avg(CAST(isodow(transaction_date) >= 6 AS DOUBLE)) AS weekend_ratio,
    CAST(avg(CAST(isodow(transaction_date) >= 6 AS DOUBLE)) > 0.5 AS DOUBLE) AS weekend_shopper,
    CASE WHEN coalesce(sum(quantity), 0) > 0
         THEN coalesce(sum(returned_qty), 0) / coalesce(sum(quantity), 0) ELSE 0.0 END AS return_ratio,
    CASE WHEN coalesce(sum(gross_revenue), 0) > 0
         THEN CAST(coalesce(sum(refund_amount), 0) AS DOUBLE) / CAST(coalesce(sum(gross_revenue), 0) AS DOUBLE)
         ELSE 0.0 END AS refund_ratio,
    CASE WHEN coalesce(sum(net_revenue), 0) > 0
         THEN CAST(coalesce(sum(gross_profit), 0) AS DOUBLE) / CAST(coalesce(sum(net_revenue), 0) AS DOUBLE)
         ELSE 0.0 END AS profit_margin,
    CAST(greatest(count(CASE WHEN grp = 'fashion' THEN 1 END),
                  count(CASE WHEN grp = 'accessory' THEN 1 END),
                  count(CASE WHEN grp = 'other' THEN 1 END)) AS DOUBLE) / CAST(count(*) AS DOUBLE)
      AS top_category_ratio,
    avg(CAST(sold_price_level <= 2 AS DOUBLE)) AS bargain_ratio,
    avg(CAST(sold_price_level >= 4 AS DOUBLE)) AS premium_ratio,
    CAST(count(CASE WHEN grp = 'fashion' THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cat_ratio_fashion,
    CAST(count(CASE WHEN grp = 'accessory' THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cat_ratio_accessory,
    CAST(count(CASE WHEN grp = 'other' THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cat_ratio_other
  FROM (SELECT *, {GROUP} AS grp FROM txn) GROUP BY customer_id
)"""

ORACLE: dict[str, str] = {
    "txn_clean": f"WITH {TXN} SELECT * FROM txn",
    "analysis_dates": f"""WITH {TXN}
        SELECT max(CASE WHEN order_status = 'Approved' THEN transaction_date END) + 1 AS lrfmpv_date,
               max(transaction_date) AS last_date,
               max(CASE WHEN order_status = 'Approved' THEN transaction_date END) AS last_approved
        FROM txn""",
    "lrfmpv_base": f"WITH {TXN}, {APP}, {LRFMPV} SELECT * FROM lrfmpv",
    "lrfmpv_features": f"WITH {TXN}, {APP}, {LRFMPV} SELECT customer_id, L, R, F, M, P, V FROM lrfmpv",
    "category_group": f"""WITH {TXN}
        SELECT category, {GROUP} AS category_group, count(*) AS lines FROM txn GROUP BY ALL""",
    "customer_dm": f"WITH {TXN}, {DM} SELECT * FROM dm",
    "category_ratio": f"""WITH {TXN}, {DM}
        SELECT customer_id, cat_ratio_fashion, cat_ratio_accessory, cat_ratio_other FROM dm""",
    "cohort_assignment": f"""WITH {TXN}, {APP}
        SELECT customer_id, min(transaction_date) AS first_purchase_date,
               date_trunc('month', min(transaction_date))::DATE AS cohort_month
        FROM app GROUP BY customer_id""",
    "cohort_counts": f"WITH {TXN}, {APP}, {COHORT} SELECT * FROM counts",
    "cohort_retention": f"WITH {TXN}, {APP}, {COHORT} SELECT * FROM retention",
    "cohort_matrix": f"""WITH {TXN}, {APP}, {COHORT},
        grid AS (SELECT DISTINCT r.cohort_month, i.i AS cohort_index FROM retention r,
                 (SELECT unnest(range(0, (SELECT max(cohort_index) FROM retention) + 1)) AS i) i)
        SELECT g.cohort_month, CAST(g.cohort_index AS BIGINT) AS cohort_index, r.retention_rate
        FROM grid g LEFT JOIN retention r ON g.cohort_month IS NOT DISTINCT FROM r.cohort_month
                                         AND g.cohort_index = r.cohort_index""",
    "cohort_matrix_pct": f"""WITH {TXN}, {APP}, {COHORT},
        grid AS (SELECT DISTINCT r.cohort_month, i.i AS cohort_index FROM retention r,
                 (SELECT unnest(range(0, (SELECT max(cohort_index) FROM retention) + 1)) AS i) i)
        SELECT g.cohort_month, CAST(g.cohort_index AS BIGINT) AS cohort_index, r.retention_pct
        FROM grid g LEFT JOIN retention r ON g.cohort_month IS NOT DISTINCT FROM r.cohort_month
                                         AND g.cohort_index = r.cohort_index""",
    "customer_base": f"WITH {TXN}, {BASE} SELECT * FROM base",
    "customer_seg_5x5": f"WITH {TXN}, {BASE} SELECT * FROM seg",
    "segment_summary": f"""WITH {TXN}, {BASE}
        SELECT segment, count(*) AS customers, round(avg(total_revenue), 6) AS avg_revenue,
               round(avg(total_profit), 6) AS avg_profit FROM seg GROUP BY segment""",
    "segment_grid": f"""WITH {TXN}, {BASE},
        counts AS (SELECT revenue_segment, profit_segment, count(*) AS n FROM seg GROUP BY ALL),
        grid AS (SELECT CAST(r AS INTEGER) AS revenue_segment, CAST(p AS INTEGER) AS profit_segment
                 FROM range(1, 6) a(r), range(1, 6) b(p))
        SELECT g.revenue_segment, g.profit_segment, coalesce(c.n, 0) AS n
        FROM grid g LEFT JOIN counts c USING (revenue_segment, profit_segment)
        UNION ALL
        SELECT * FROM counts WHERE revenue_segment IS NULL OR profit_segment IS NULL""",
    "customer_churn_base": f"WITH {TXN}, {APP}, {LRFMPV}, {CHURN_BASE} SELECT * FROM churn_base",
    "customer_category_dependency": f"WITH {TXN}, {DEPENDENCY} SELECT * FROM dependency",
    "category_decline": f"WITH {TXN}, {_decline(0.70)} SELECT * FROM decline",
    "category_decline_wide": f"WITH {TXN}, {_decline(1.00)} SELECT * FROM decline",
    "dependency_failure_signal": _signal(0.70, 0.60) + " SELECT * FROM signal",
    "dependency_failure_counts": _signal(0.70, 0.60)
        + " SELECT possible_dependency_failure, count(*) AS n FROM signal GROUP BY ALL",
    "dependency_failure_customers": _signal(0.70, 0.60) + """
        SELECT customer_id, dominant_category, dominant_category_share, recent_3m, previous_3m,
               category_decline_ratio, churn_flag, possible_dependency_failure
        FROM signal WHERE possible_dependency_failure = 1""",
    "dependency_failure_signal_wide": _signal(1.00, 0.30) + " SELECT * FROM signal",
    "dependency_failure_counts_wide": _signal(1.00, 0.30)
        + " SELECT possible_dependency_failure, count(*) AS n FROM signal GROUP BY ALL",
    "dependency_failure_customers_wide": _signal(1.00, 0.30) + """
        SELECT customer_id, dominant_category, dominant_category_share, recent_3m, previous_3m,
               category_decline_ratio, churn_flag, possible_dependency_failure
        FROM signal WHERE possible_dependency_failure = 1""",
    "customer_recent_returns": FRICTION + " SELECT * FROM recent",
    "return_ratio_distribution": FRICTION + """
        SELECT round(quantile_cont(recent_return_ratio, 0.50), 9) AS p50,
               round(quantile_cont(recent_return_ratio, 0.75), 9) AS p75,
               round(quantile_cont(recent_return_ratio, 0.90), 9) AS p90,
               round(quantile_cont(recent_return_ratio, 0.95), 9) AS p95,
               round(quantile_cont(recent_return_ratio, 0.99), 9) AS p99,
               round(max(recent_return_ratio), 9) AS max_return_ratio
        FROM recent""",
    "operational_friction_signal": FRICTION + " SELECT * FROM signal",
    "friction_counts": FRICTION
        + " SELECT possible_operational_friction, count(*) AS n FROM signal GROUP BY ALL",
    "friction_top25": FRICTION + """
        SELECT customer_id, recent_quantity, recent_returned_qty, recent_return_ratio, churn_flag,
               possible_operational_friction
        FROM signal WHERE possible_operational_friction = 1
        ORDER BY recent_return_ratio DESC NULLS LAST, customer_id ASC NULLS LAST LIMIT 25""",
    "churned_vs_active_returns": FRICTION + """
        SELECT churn_flag, round(avg(recent_return_ratio), 6) AS avg_return_ratio,
               round(quantile_cont(recent_return_ratio, 0.5), 9) AS median_return_ratio,
               count(*) AS customer_count
        FROM signal GROUP BY churn_flag""",
}


# --- lifetime value and churn score ----------------------------------------------------------

def _d(v: float) -> str:
    """A double literal that parses to exactly the same IEEE value as in Python."""
    return f"CAST({float(v)!r} AS DOUBLE)"


def _clv_sql() -> str:
    from clientele.operators.btyd import CDNOW_BGNBD as bg, CDNOW_GAMMA_GAMMA as gg
    t = 30.0
    xd = "CAST(x AS DOUBLE)"
    jd = "CAST(j AS DOUBLE)"
    step = f"(term * (ha + {jd}) * (hb + {jd}) / ((hc + {jd}) * ({jd} + {_d(1.0)})) * hz)"
    return f"""
bg_in AS (
  SELECT customer_id, CAST(F - 1 AS BIGINT) AS x, CAST(L AS DOUBLE) AS t_x,
         CAST(L + R AS DOUBLE) AS t_cal FROM lrfmpv
),
ser_in AS (
  SELECT customer_id, {xd} + {_d(bg.r)} AS ha, {xd} + {_d(bg.b)} AS hb,
         {xd} + {_d(bg.a + bg.b - 1.0)} AS hc, {_d(t)} / (t_cal + {_d(bg.alpha + t)}) AS hz
  FROM bg_in
),
ser(customer_id, ha, hb, hc, hz, j, term, total, moving) AS (
  SELECT customer_id, ha, hb, hc, hz, 0, {_d(1.0)}, {_d(1.0)}, true FROM ser_in
  UNION ALL
  SELECT customer_id, ha, hb, hc, hz, j + 1, {step}, total + {step},
         (total + {step}) <> total AND isfinite(total + {step})
  FROM ser WHERE moving
),
hyp AS (SELECT customer_id, max(total) AS h FROM ser GROUP BY customer_id),
bg_alive AS (
  SELECT b.*, CASE WHEN x > 0 THEN {_d(1.0)} / (({_d(bg.a)} / ({xd} + {_d(bg.b - 1.0)}))
              * pow((t_cal + {_d(bg.alpha)}) / (t_x + {_d(bg.alpha)}), {xd} + {_d(bg.r)})
              + {_d(1.0)}) ELSE {_d(1.0)} END AS p_alive
  FROM bg_in b
),
bg_score AS (
  SELECT a.customer_id, a.x, a.t_x, a.t_cal,
         (({xd} + {_d(bg.a + bg.b - 1.0)}) / {_d(bg.a - 1.0)})
         * ({_d(1.0)} - pow((t_cal + {_d(bg.alpha)}) / (t_cal + {_d(bg.alpha + t)}), {xd} + {_d(bg.r)})
            * h.h) * a.p_alive AS pred_30d,
         a.p_alive
  FROM bg_alive a JOIN hyp h ON a.customer_id IS NOT DISTINCT FROM h.customer_id
),
gg_in AS (
  SELECT customer_id, CAST(F - 1 AS BIGINT) AS x, M / CAST(F AS DOUBLE) AS m_x
  FROM lrfmpv WHERE F - 1 > 0
),
gg_score AS (
  SELECT customer_id, x, m_x,
         CASE WHEN m_x > 0 THEN ((m_x * {xd} + {_d(gg.gamma)}) * {_d(gg.p)})
                               / ({xd} * {_d(gg.p)} + {_d(gg.q - 1.0)}) END AS exp_avg_value
  FROM gg_in
),
clv AS (
  SELECT b.customer_id, b.pred_30d, b.p_alive, b.t_cal, b.t_x, g.exp_avg_value, l.F, l.M,
         b.pred_30d * g.exp_avg_value AS clv_30d, b.t_cal - b.t_x AS recency_days
  FROM bg_score b
  LEFT JOIN gg_score g ON b.customer_id IS NOT DISTINCT FROM g.customer_id
  LEFT JOIN lrfmpv l ON b.customer_id IS NOT DISTINCT FROM l.customer_id
)"""


CLV_WITH = f"WITH RECURSIVE {TXN}, {APP}, {LRFMPV}, {_clv_sql()}"

CHURN = CLV_WITH + f""",
ci AS (
  SELECT c.*, l.L, l.R, l.P, l.V,
         CASE WHEN l.P IS NULL OR l.P = 0 THEN NULL ELSE CAST(l.R AS DOUBLE) / l.P END AS recency_ratio
  FROM clv c LEFT JOIN lrfmpv l ON c.customer_id IS NOT DISTINCT FROM l.customer_id
),
ranked AS (
  SELECT *,
    CASE WHEN recency_ratio IS NULL THEN NULL
         ELSE percent_rank() OVER (PARTITION BY recency_ratio IS NULL ORDER BY recency_ratio) END
      AS recency_risk,
    CASE WHEN F IS NULL THEN NULL
         ELSE percent_rank() OVER (PARTITION BY F IS NULL ORDER BY F) END AS f_rank
  FROM ci
),
scored AS (
  SELECT * EXCLUDE (f_rank),
    {_d(1.0)} - p_alive AS p_alive_risk,
    {_d(1.0)} - f_rank AS frequency_risk,
    {_d(0.6)} * ({_d(1.0)} - p_alive) + {_d(0.25)} * recency_risk
      + {_d(0.15)} * ({_d(1.0)} - f_rank) AS churn_score
  FROM ranked
),
churn AS (
  SELECT *,
    CASE WHEN churn_score >= 0.75 THEN 'Critical' WHEN churn_score >= 0.55 THEN 'High Risk'
         WHEN churn_score >= 0.35 THEN 'Medium Risk' ELSE 'Healthy' END AS churn_segment,
    CASE WHEN churn_score >= 0.75 THEN 'Immediate winback campaign'
         WHEN churn_score >= 0.55 THEN 'Targeted retention campaign'
         WHEN churn_score >= 0.35 THEN 'Engagement / reminder campaign'
         ELSE 'Maintain / loyalty nurturing' END AS churn_action
  FROM scored
)"""


def _r(cols: list[str], table: str, all_cols: list[str], digits: int = 9) -> str:
    sel = [f"round({c}, {4 if c == 'clv_30d' else digits}) AS {c}" if c in cols else c
           for c in all_cols]
    return f"SELECT {', '.join(sel)} FROM {table}"


_CLV_COLS = ["customer_id", "pred_30d", "p_alive", "t_cal", "t_x", "exp_avg_value", "F", "M",
             "clv_30d", "recency_days"]
_CLV_R = ["pred_30d", "p_alive", "clv_30d"]
_CHURN_COLS = _CLV_COLS + ["L", "R", "P", "V", "recency_ratio", "recency_risk", "p_alive_risk",
                           "frequency_risk", "churn_score", "churn_segment", "churn_action"]

ORACLE.update({
    "bgnbd_inputs": f"""WITH {TXN}, {APP}, {LRFMPV}
        SELECT customer_id, CAST(F - 1 AS BIGINT) AS x, CAST(L AS DOUBLE) AS t_x,
               CAST(L + R AS DOUBLE) AS t_cal FROM lrfmpv""",
    "bgnbd_score": CLV_WITH + " " + _r(["pred_30d", "p_alive"], "bg_score",
                                       ["customer_id", "x", "t_x", "t_cal", "pred_30d", "p_alive"]),
    "bgnbd_averages": CLV_WITH + """
        SELECT round(avg(pred_30d), 9) AS avg_pred, round(avg(p_alive), 9) AS avg_alive
        FROM bg_score""",
    "gg_inputs": f"""WITH {TXN}, {APP}, {LRFMPV}
        SELECT customer_id, CAST(F - 1 AS BIGINT) AS x, M / CAST(F AS DOUBLE) AS m_x
        FROM lrfmpv WHERE F - 1 > 0""",
    "gg_score": CLV_WITH + " SELECT * FROM gg_score",
    "clv_30d": CLV_WITH + " " + _r(_CLV_R, "clv", _CLV_COLS),
    "target_customers": CLV_WITH + ", tgt AS (SELECT * FROM clv WHERE "
        "clv_30d > (SELECT quantile_cont(clv_30d, 0.75) FROM clv) AND p_alive < 0.6 "
        "AND recency_days < 180 AND F >= 2 AND M > (SELECT quantile_cont(M, 0.5) FROM clv)) "
        + _r(_CLV_R, "tgt", _CLV_COLS),
    "target_customers_wide": CLV_WITH + ", tgt AS (SELECT * FROM clv WHERE "
        "clv_30d > (SELECT quantile_cont(clv_30d, 0.5) FROM clv) AND p_alive < 0.999 "
        "AND recency_days < 2000 AND F >= 2 AND M > (SELECT quantile_cont(M, 0.5) FROM clv)) "
        + _r(_CLV_R, "tgt", _CLV_COLS),
    "p_alive_summary": CLV_WITH + """
        SELECT round(min(p_alive), 9) AS min, round(quantile_cont(p_alive, 0.25), 9) AS q1,
               round(quantile_cont(p_alive, 0.5), 9) AS median, round(avg(p_alive), 9) AS mean,
               round(quantile_cont(p_alive, 0.75), 9) AS q3, round(max(p_alive), 9) AS max,
               count(*) - count(p_alive) AS na_count
        FROM clv""",
    "bgnbd_log_likelihood": f"""WITH {TXN}, {APP}, {LRFMPV},
        i AS (SELECT F - 1 AS x, CAST(L AS DOUBLE) AS t, CAST(L + R AS DOUBLE) AS tc FROM lrfmpv
              WHERE F IS NOT NULL AND L IS NOT NULL AND R IS NOT NULL),
        p AS (SELECT {_d(0.243)} AS r, {_d(4.414)} AS alpha, {_d(0.793)} AS a, {_d(2.426)} AS b),
        l AS (SELECT lgamma(x + r) - lgamma(r) + lgamma(x + b) - lgamma(b) + lgamma(a + b) - lgamma(x + a + b)
                     + r * ln(alpha) AS g, (x + r) * ln(tc + alpha) AS u, (x + r) * ln(t + alpha) AS w, x, a, b
              FROM i CROSS JOIN p),
        m AS (SELECT g - u AS la, CASE WHEN x > 0 THEN g + ln(a) - ln(x + b - 1) - w END AS lb FROM l)
        SELECT count(*) AS customers, round(sum(CASE WHEN lb IS NULL THEN la
               ELSE greatest(la, lb) + ln(1 + exp(-abs(la - lb))) END), 4) AS log_likelihood FROM m""",
    "gg_log_likelihood": f"""WITH {TXN}, {APP}, {LRFMPV},
        i AS (SELECT CAST(F - 1 AS DOUBLE) AS x, M / CAST(F AS DOUBLE) AS m FROM lrfmpv WHERE F - 1 > 0 AND M / CAST(F AS DOUBLE) > 0),
        p AS (SELECT {_d(6.25)} AS p, {_d(3.74)} AS q, {_d(15.44)} AS g)
        SELECT count(*) AS customers, round(sum(lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * ln(g)
               + (p * x - 1) * ln(m) + p * x * ln(x) - (p * x + q) * ln(g + m * x)), 4) AS log_likelihood
        FROM i CROSS JOIN p""",
    "clv_top10": CLV_WITH + ", top AS (SELECT * FROM clv ORDER BY clv_30d DESC NULLS LAST, "
        "customer_id ASC NULLS LAST LIMIT 10) " + _r(_CLV_R, "top", _CLV_COLS),
    "churn_risk": CHURN + " " + _r(_CLV_R + ["p_alive_risk", "churn_score"], "churn", _CHURN_COLS),
    "churn_segment_counts": CHURN + """
        SELECT churn_segment, count(*) AS n FROM churn GROUP BY churn_segment""",
    "score_summary": CHURN + """
        SELECT round(min(churn_score), 9) AS min,
               round(quantile_cont(churn_score, 0.25), 9) AS q1,
               round(quantile_cont(churn_score, 0.5), 9) AS median,
               round(avg(churn_score), 9) AS mean,
               round(quantile_cont(churn_score, 0.75), 9) AS q3,
               round(max(churn_score), 9) AS max,
               count(*) - count(churn_score) AS na_count
        FROM churn""",
})


# --- baskets and association rules -------------------------------------------------------------

BASKETS = f"""WITH {TXN}, {APP},
baskets AS (
  SELECT transaction_id, list_sort(list_distinct(list(category))) AS items
  FROM app WHERE transaction_id IS NOT NULL AND category IS NOT NULL GROUP BY transaction_id
)"""

RULES = BASKETS + """,
nb AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM baskets),
cats AS (
  SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS BIGINT) AS bit
  FROM (SELECT DISTINCT unnest(items) AS category FROM baskets)
),
masks AS (SELECT m FROM range(1, (SELECT CAST(1 AS BIGINT) << count(*) FROM cats)) t(m)),
itemsets AS (
  SELECT m, list_sort(list(category)) AS items, count(*) AS k
  FROM masks JOIN cats ON ((m >> bit) & 1) = 1 GROUP BY m
),
counted AS (
  SELECT i.items, i.k,
         (SELECT count(*) FROM baskets b WHERE list_has_all(b.items, i.items)) AS freq
  FROM itemsets i
),
freq AS (SELECT * FROM counted WHERE freq >= 0.001 * (SELECT n FROM nb) AND k <= 10),
whole AS (
  SELECT f.items AS s_items, f.freq AS s_freq, u.rhs_item,
         list_sort(list_filter(f.items, lambda e: e <> u.rhs_item)) AS lhs_items
  FROM freq f, unnest(f.items) AS u(rhs_item) WHERE f.k >= 2
),
rules AS (
  SELECT '{' || array_to_string(w.lhs_items, ',') || '}' AS lhs,
         '{' || w.rhs_item || '}' AS rhs,
         CAST(w.s_freq AS DOUBLE) / (SELECT n FROM nb) AS support,
         CAST(w.s_freq AS DOUBLE) / CAST(l.freq AS DOUBLE) AS confidence,
         CAST(l.freq AS DOUBLE) / (SELECT n FROM nb) AS coverage,
         (CAST(w.s_freq AS DOUBLE) / CAST(l.freq AS DOUBLE))
           / (CAST(r.freq AS DOUBLE) / (SELECT n FROM nb)) AS lift,
         w.s_freq AS count
  FROM whole w
  JOIN freq l ON l.items = w.lhs_items
  JOIN freq r ON r.k = 1 AND r.items[1] = w.rhs_item
  WHERE CAST(w.s_freq AS DOUBLE) / CAST(l.freq AS DOUBLE) >= 0.1
)"""

ORACLE.update({
    "basket_items": BASKETS + """
        SELECT transaction_id, '{' || array_to_string(items, ',') || '}' AS items,
               CAST(len(items) AS BIGINT) AS n_items FROM baskets""",
    "assoc_rules": RULES + " SELECT * FROM rules",
    "assoc_rules_top20": RULES + " SELECT * FROM rules ORDER BY lift DESC, lhs, rhs LIMIT 20",
})


# --- k-means inputs --------------------------------------------------------------------------

_KM_COLS = ["F", "M", "profit", "R", "V", "avg_basket", "category_diversity", "brand_diversity",
            "weekend_ratio", "weekend_shopper", "return_ratio", "refund_ratio", "profit_margin",
            "top_category_ratio", "bargain_ratio", "premium_ratio", "cat_ratio_fashion",
            "cat_ratio_accessory", "cat_ratio_other"]


def _km_scaled() -> str:
    """Fill, drop zero-variance features, z-score — with the kept column set
    decided by the data, in long form."""
    clean = ", ".join(
        f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0 "
        f"ELSE CAST({c} AS DOUBLE) END AS {c}" for c in _KM_COLS)
    long = " UNION ALL ".join(f"SELECT customer_id, '{c}' AS feature, {c} AS v FROM filled" for c in _KM_COLS)
    return f"""WITH {TXN}, {DM},
filled AS (SELECT customer_id, {clean} FROM dm),
long AS ({long}),
stats AS (SELECT feature, avg(v) AS m, stddev_samp(v) AS s FROM long GROUP BY feature),
scaled AS (SELECT l.customer_id, l.feature, (l.v - st.m) / st.s AS z
           FROM long l JOIN stats st ON l.feature = st.feature WHERE st.s > 0)"""


ORACLE["kmeans_features"] = _km_scaled() + " SELECT customer_id, feature, round(z, 6) AS z FROM scaled"


def _km_lloyd(k: int, steps: int) -> str:
    """Lloyd's steps from the k smallest customer ids, one pair of CTEs a step."""
    sql = _km_scaled() + f""",
starts AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS cluster
           FROM (SELECT DISTINCT customer_id FROM dm) ORDER BY customer_id LIMIT {k}),
centers0 AS (SELECT cluster, feature, z AS v FROM scaled JOIN starts USING (customer_id))"""
    for i in range(steps + 1):
        sql += f""",
apart{i} AS (SELECT customer_id, cluster, sum((z - v) * (z - v)) AS d
             FROM scaled JOIN centers{i} USING (feature) GROUP BY ALL),
labels{i} AS (SELECT customer_id, cluster FROM apart{i}
              QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY d, cluster) = 1)"""
        if i < steps:
            sql += f""",
means{i} AS (SELECT cluster, feature, avg(z) AS v FROM scaled JOIN labels{i} USING (customer_id) GROUP BY ALL),
centers{i + 1} AS (SELECT c.cluster, c.feature, coalesce(m.v, c.v) AS v
                   FROM centers{i} c LEFT JOIN means{i} m ON m.cluster = c.cluster AND m.feature = c.feature)"""
    names = [(f"avg_{c}", c) for c in ("F", "M", "profit", "R", "V", "weekend_ratio", "return_ratio", "refund_ratio",
                                       "profit_margin", "top_category_ratio", "bargain_ratio", "premium_ratio")]
    names += [(c, c) for c in ("avg_basket", "cat_ratio_fashion", "cat_ratio_accessory", "cat_ratio_other")]
    means = ", ".join(f"round(avg({c}), 6) AS {name}" for name, c in names)
    return sql + f"""
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS customers, {means}
FROM dm JOIN labels{steps} USING (customer_id) GROUP BY cluster"""


ORACLE["kmeans_lloyd_profile"] = _km_lloyd(5, 5)
