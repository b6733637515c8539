"""The SQL each registered query must equal, over the same tables.

The statements are written on their own: plain joins, native windows and native distinct counts at
line level, so that they check the aggregations and global windows of the library.
"""

from __future__ import annotations


def half_up(numerator: str, denominator: str) -> str:
    """Whole-number quotient of non-negative numbers, rounded half up."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def cents(whole: str, type_: str = "DECIMAL(16,2)") -> str:
    return f"CAST(({whole}) / 100 AS {type_})"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def ratio(numerator: str, denominator: str) -> str:
    return f"({dbl(numerator)} / NULLIF({dbl(denominator)}, 0))"


def pct(numerator: str, denominator: str) -> str:
    return f"({ratio(numerator, denominator)} * 100)"


def mean(column: str) -> str:
    return ratio(f"SUM({column})", f"COUNT({column})")


CHANNEL = "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'On-Premise' ELSE 'Off-Premise' END"
QUARTER = "(CAST(year({d}) AS VARCHAR) || '-Q' || CAST(quarter({d}) AS VARCHAR))"

REPS = """
reps AS (
  SELECT CAST(n_nationkey AS BIGINT) AS rep_id, 'Rep ' || n_name AS rep_name, r_name AS division,
         CASE WHEN n_nationkey % 2 = 0 THEN 'On-Premise' ELSE 'Off-Premise' END AS channel,
         CAST(DATE '1990-01-01' + CAST(n_nationkey * 100 AS INTEGER) AS DATE) AS hire_date,
         lower(n_name || '@example.com') AS email
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

ACCOUNTS = f"""
accounts AS (
  SELECT c_custkey AS account_id, c_name AS account_name, c_mktsegment AS account_type,
         {CHANNEL} AS channel, n_name AS town, left(r_name, 2) AS state, r_name AS division,
         CAST(c_nationkey AS BIGINT) AS rep_id, c_acctbal >= 0 AS is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS sku_id, p_name AS product_name, CAST(p_size AS BIGINT) AS supplier_id,
         p_type AS category, p_brand AS sub_category, CAST(p_size * 50 AS BIGINT) AS size_ml,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CASE WHEN CAST(p_retailprice AS DECIMAL(10,2)) < 925 THEN 'Value'
              WHEN CAST(p_retailprice AS DECIMAL(10,2)) < 950 THEN 'Mid-Range'
              WHEN CAST(p_retailprice AS DECIMAL(10,2)) < 975 THEN 'Premium'
              ELSE 'Ultra-Premium' END AS price_tier
  FROM part)"""

SUPPLIERS = """
suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
         CASE s_suppkey % 3 WHEN 0 THEN 'Wine' WHEN 1 THEN 'Spirits' ELSE 'Wine & Spirits' END
           AS category,
         CASE WHEN r_name = 'AMERICA' THEN 'USA' ELSE n_name END AS country,
         CASE WHEN r_name = 'AMERICA' THEN 'Domestic' ELSE 'Import' END AS origin_type
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

SALES = f"""
lines AS (
  SELECT l_orderkey AS txn_id, o_custkey AS account_id, CAST(c_nationkey AS BIGINT) AS rep_id,
         l_partkey AS sku_id, l_suppkey AS supplier_id, CAST(o_orderdate AS DATE) AS order_date,
         {CHANNEL} AS channel, CAST(l_quantity AS INTEGER) AS cases,
         CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS disc,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))), 2)
              AS DECIMAL(12,2)) AS revenue,
         CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(14,2))
           AS gross
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey),
fs AS (
  SELECT *, {cents(half_up("CAST(revenue * 100 AS BIGINT)", "cases"))} AS rpc,
         round(revenue * 0.30, 2) AS margin,
         round(gross * disc * 0.01, 2) AS discount
  FROM lines WHERE revenue > 0 AND cases > 0)"""

QUOTAS = f"""
monthly AS (
  SELECT rep_id, strftime(order_date, '%Y-%m') AS month_year, CAST(SUM(cases) AS BIGINT) AS actual_cases,
         SUM(revenue) AS actual_revenue
  FROM fs GROUP BY ALL),
goals AS (
  SELECT rep_id, {half_up("CAST(SUM(actual_cases) AS BIGINT)", "COUNT(*)")} AS quota_cases,
         {cents(half_up("CAST(SUM(actual_revenue) * 100 AS BIGINT)", "COUNT(*)"))} AS quota_revenue
  FROM monthly GROUP BY rep_id),
quotas AS (
  SELECT m.*, quota_cases, quota_revenue, rep_name, division, channel,
         {cents(half_up("actual_cases * 10000", "quota_cases"))} AS attainment_pct
  FROM monthly m JOIN goals USING (rep_id) JOIN reps USING (rep_id))"""

PROGRAMS = f"""
volumes AS (
  SELECT supplier_id, {QUARTER.format(d="order_date")} AS quarter, rep_id,
         CAST(SUM(cases) AS BIGINT) AS cases,
         supplier_id * 100000 + year(order_date) * 4 + quarter(order_date) AS program_id
  FROM fs GROUP BY ALL),
programs AS (
  SELECT program_id, supplier_id, quarter,
         make_date(CAST(left(quarter, 4) AS BIGINT), CAST(right(quarter, 1) AS BIGINT) * 3 - 2, 1)
           AS start_date,
         {half_up("CAST(SUM(cases) AS BIGINT) * 100", "COUNT(*)")} AS goal_cents
  FROM volumes GROUP BY ALL),
scored AS (
  SELECT v.*, goal_cents, {cents("goal_cents")} AS goal,
         {cents(half_up("v.cases * 1000000", "goal_cents"))} AS attainment_pct
  FROM volumes v JOIN programs USING (program_id)),
attainments AS (
  SELECT program_id * 1000 + rep_id AS attainment_id, program_id, supplier_id, quarter, rep_id,
         goal, CAST(cases AS DECIMAL(12,2)) AS actual, attainment_pct,
         CASE WHEN attainment_pct >= 100 THEN 'Achieved' WHEN attainment_pct >= 75 THEN 'At Risk'
              ELSE 'Behind' END AS status,
         CASE WHEN attainment_pct >= 100 THEN 5000 WHEN attainment_pct >= 75 THEN 2500 ELSE 0 END
           AS earned,
         CASE WHEN attainment_pct >= 100 THEN 0 WHEN attainment_pct >= 75 THEN 2500 ELSE 5000 END
           AS missed
  FROM scored)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def analysis_sql() -> dict[str, str]:
    years = "year(order_date)"
    segment = """
      CASE WHEN r = 4 AND f >= 3 AND m >= 3 THEN 'Champions'
           WHEN f >= 3 AND m >= 3 THEN 'Loyal Customers'
           WHEN r <= 2 AND f >= 3 AND m >= 3 THEN 'At Risk'
           WHEN r <= 2 AND m = 4 THEN 'Cannot Lose Them'
           WHEN r >= 3 AND f <= 2 THEN 'Potential Loyalists'
           ELSE 'Hibernating' END"""
    return {
        "customer_ltv": with_(SALES, ACCOUNTS, REPS) + f"""
SELECT account_name, account_type, a.channel, town, rep_name,
       COUNT(DISTINCT txn_id) AS total_orders, MIN(order_date) AS first_order,
       MAX(order_date) AS last_order,
       CAST(MAX(order_date) - MIN(order_date) AS BIGINT) AS relationship_days,
       CAST(SUM(cases) AS BIGINT) AS lifetime_cases, {dbl("SUM(revenue)")} AS lifetime_revenue,
       {dbl("SUM(margin)")} AS lifetime_margin, {mean("revenue")} AS avg_order_value,
       {ratio("SUM(revenue)", "datediff('month', MIN(order_date), MAX(order_date))")} AS monthly_ltv,
       CASE WHEN SUM(revenue) >= 3000000 THEN 'Platinum' WHEN SUM(revenue) >= 2000000 THEN 'Gold'
            WHEN SUM(revenue) >= 1000000 THEN 'Silver' ELSE 'Bronze' END AS ltv_tier
FROM fs JOIN accounts a USING (account_id) JOIN reps r ON fs.rep_id = r.rep_id
GROUP BY account_id, account_name, account_type, a.channel, town, fs.rep_id, rep_name""",
        "account_retention": with_(SALES, ACCOUNTS, REPS) + f""",
yearly AS (
  SELECT account_id, account_name, a.channel, town, fs.rep_id, rep_name,
         SUM(CASE WHEN {years} = 1999 THEN revenue ELSE 0 END) AS old,
         SUM(CASE WHEN {years} = 2000 THEN revenue ELSE 0 END) AS new,
         COUNT(DISTINCT CASE WHEN {years} = 1999 THEN txn_id END) AS orders_1999,
         COUNT(DISTINCT CASE WHEN {years} = 2000 THEN txn_id END) AS orders_2000
  FROM fs JOIN accounts a USING (account_id) JOIN reps r ON fs.rep_id = r.rep_id
  GROUP BY account_id, account_name, a.channel, town, fs.rep_id, rep_name)
SELECT account_name, channel, town, rep_name, {dbl("old")} AS revenue_1999,
       {dbl("new")} AS revenue_2000, {dbl("new - old")} AS yoy_change,
       {pct("new - old", "old")} AS yoy_growth_pct, orders_1999, orders_2000,
       CASE WHEN old > 0 AND new = 0 THEN 'Churned' WHEN old = 0 AND new > 0 THEN 'New'
            WHEN new > old * 1.10 THEN 'Growing' WHEN new < old * 0.90 THEN 'Declining'
            ELSE 'Stable' END AS retention_status,
       {dbl("CASE WHEN old > 0 AND new = 0 THEN old ELSE 0 END")} AS at_risk_revenue
FROM yearly""",
        "revenue_pareto": with_(SALES, ACCOUNTS) + f""",
per_account AS (
  SELECT account_id, account_name, account_type, a.channel, SUM(revenue) AS revenue
  FROM fs JOIN accounts a USING (account_id)
  GROUP BY account_id, account_name, account_type, a.channel),
ranked AS (
  SELECT *, RANK() OVER (ORDER BY revenue DESC) AS revenue_rank, SUM(revenue) OVER () AS total,
         SUM(revenue) OVER (ORDER BY revenue DESC, account_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM per_account)
SELECT revenue_rank, account_name, account_type, channel, {dbl("revenue")} AS account_revenue,
       {pct("revenue", "total")} AS pct_of_total, {pct("running", "total")} AS cumulative_pct,
       CASE WHEN running <= total * 0.80 THEN 'Top Revenue' ELSE 'Tail Revenue' END AS pareto_group
FROM ranked""",
        "order_gaps": with_(SALES, ACCOUNTS, REPS) + f""",
gaps AS (
  SELECT account_id, rep_id, revenue,
         order_date - LAG(order_date) OVER (PARTITION BY account_id
                                            ORDER BY order_date, rep_id, txn_id, revenue) AS gap
  FROM fs),
rhythm AS (
  SELECT account_name, a.channel, rep_name, COUNT(*) AS n, SUM(revenue) AS revenue,
         CAST(SUM(gap) AS BIGINT) // COUNT(gap) AS mean_gap, MAX(gap) AS longest
  FROM gaps JOIN accounts a USING (account_id) JOIN reps r ON gaps.rep_id = r.rep_id
  WHERE gap IS NOT NULL GROUP BY account_id, account_name, a.channel, gaps.rep_id, rep_name)
SELECT account_name, channel, rep_name, n AS total_orders, {dbl("revenue")} AS total_revenue,
       mean_gap AS avg_days_between_orders, CAST(longest AS BIGINT) AS longest_gap_days,
       CASE WHEN mean_gap <= 14 THEN 'Weekly Buyer' WHEN mean_gap <= 30 THEN 'Monthly Buyer'
            WHEN mean_gap <= 60 THEN 'Occasional' ELSE 'Infrequent' END AS engagement_health
FROM rhythm""",
        "discount_leakage": with_(SALES, REPS) + f""",
rates AS (
  SELECT rep_id, rep_name, division, r.channel, SUM(revenue) AS net, SUM(gross) AS gross,
         SUM(discount) AS given, {pct("SUM(discount)", "SUM(gross)")} AS rate
  FROM fs JOIN reps r USING (rep_id) GROUP BY rep_id, rep_name, division, r.channel),
company AS (SELECT AVG(rate) AS company_avg FROM rates)
SELECT rep_name, division, channel, {dbl("net")} AS net_revenue, {dbl("given")} AS total_discounts,
       round(rate, 4) AS rep_disc_rate, round(company_avg, 4) AS company_avg,
       round(rate - company_avg, 4) AS above_avg_by,
       round(CASE WHEN rate > company_avg THEN {dbl("gross")} * (rate - company_avg) / 100 ELSE 0 END, 4)
         AS recoverable_revenue,
       CASE WHEN rate > company_avg * 1.4 THEN 'Investigate Now'
            WHEN rate > company_avg * 1.15 THEN 'Monitor Closely' ELSE 'Within Policy' END AS action
FROM rates CROSS JOIN company""",
        "kpi_card": with_(SALES) + f"""
SELECT MIN(order_date) AS data_from, MAX(order_date) AS data_to,
       COUNT(DISTINCT txn_id) AS total_transactions, COUNT(DISTINCT account_id) AS active_accounts,
       COUNT(DISTINCT rep_id) AS active_reps, CAST(SUM(cases) AS BIGINT) AS total_cases,
       {dbl("SUM(revenue)")} AS total_net_revenue, {dbl("SUM(gross)")} AS total_gross_revenue,
       {dbl("SUM(discount)")} AS total_discounts, {dbl("SUM(margin)")} AS total_est_margin,
       {pct("SUM(margin)", "SUM(revenue)")} AS overall_margin_pct,
       {pct("SUM(discount)", "SUM(gross)")} AS overall_discount_rate,
       {mean("rpc")} AS avg_rev_per_case
FROM fs""",
        "monthly_trend": with_(SALES) + f""",
months AS (
  SELECT strftime(order_date, '%Y-%m') AS year_month, year(order_date) AS year,
         month(order_date) AS month_num, strftime(order_date, '%B') AS month_name,
         {QUARTER.format(d="order_date")} AS year_quarter,
         CASE WHEN month(order_date) IN (11, 12) THEN 'Holiday Season'
              WHEN month(order_date) IN (6, 7, 8) THEN 'Summer Peak' ELSE 'Standard' END AS season,
         COUNT(DISTINCT txn_id) AS transactions, CAST(SUM(cases) AS BIGINT) AS cases_sold,
         SUM(revenue) AS net, SUM(margin) AS margin, SUM(discount) AS discount
  FROM fs
  GROUP BY 1, 2, 3, 4, 5, 6)
SELECT year_month, year, month_num, month_name, year_quarter, season, transactions, cases_sold,
       {dbl("net")} AS net_revenue, {dbl("margin")} AS est_margin, {dbl("discount")} AS discounts,
       {dbl("FIRST(net) OVER (ORDER BY year * 12 + month_num RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)")} AS prev_month_revenue,
       {dbl("net - FIRST(net) OVER (ORDER BY year * 12 + month_num RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)")} AS mom_change,
       {ratio("SUM(net) OVER (ORDER BY year * 12 + month_num RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)",
              "COUNT(net) OVER (ORDER BY year * 12 + month_num RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)")}
         AS rolling_3mo_avg,
       {dbl("FIRST(net) OVER (ORDER BY year * 12 + month_num RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING)")} AS same_month_prior_year
FROM months""",
        "rep_scorecard": with_(SALES, REPS, QUOTAS) + f""",
attained AS (SELECT rep_id, {mean("attainment_pct")} AS attained FROM quotas GROUP BY rep_id),
per_rep AS (
  SELECT rep_id, COUNT(DISTINCT txn_id) AS transactions, COUNT(DISTINCT account_id) AS accounts,
         CAST(SUM(cases) AS BIGINT) AS cases_sold, SUM(revenue) AS net, SUM(margin) AS margin,
         SUM(discount) AS discount, SUM(gross) AS gross, {mean("rpc")} AS per_case
  FROM fs GROUP BY rep_id)
SELECT rep_name, division, channel, 2001 - year(hire_date) AS years_tenure, transactions,
       accounts AS accounts_covered, cases_sold, {dbl("net")} AS net_revenue,
       {dbl("margin")} AS est_margin, {dbl("discount")} AS discounts_given,
       {pct("discount", "gross")} AS discount_rate_pct, per_case AS avg_rev_per_case,
       RANK() OVER (ORDER BY net DESC) AS revenue_rank, attained AS avg_quota_attainment_pct,
       CASE WHEN net >= 95000000 THEN 'Top Performer' WHEN net >= 85000000 THEN 'On Track'
            ELSE 'Needs Support' END AS performance_status
FROM per_rep JOIN reps USING (rep_id) LEFT JOIN attained USING (rep_id)""",
        "supplier_mix": with_(SALES, SUPPLIERS) + f""",
per_supplier AS (
  SELECT supplier_id, COUNT(DISTINCT txn_id) AS transactions, CAST(SUM(cases) AS BIGINT) AS cases_sold,
         SUM(revenue) AS net, SUM(margin) AS margin, SUM(discount) AS discount
  FROM fs GROUP BY supplier_id)
SELECT supplier_name, category, origin_type, transactions, cases_sold, {dbl("net")} AS net_revenue,
       {dbl("margin")} AS est_margin, {dbl("discount")} AS discounts,
       {pct("net", "SUM(net) OVER ()")} AS revenue_share_pct,
       RANK() OVER (ORDER BY net DESC) AS revenue_rank
FROM per_supplier JOIN suppliers USING (supplier_id)""",
        "channel_split": with_(SALES) + f"""
SELECT channel, year(order_date) AS year, COUNT(DISTINCT txn_id) AS transactions,
       COUNT(DISTINCT rep_id) AS reps, COUNT(DISTINCT account_id) AS accounts,
       CAST(SUM(cases) AS BIGINT) AS cases_sold, {dbl("SUM(revenue)")} AS net_revenue,
       {dbl("SUM(margin)")} AS est_margin, {pct("SUM(margin)", "SUM(revenue)")} AS margin_pct,
       {ratio("SUM(revenue)", "COUNT(DISTINCT rep_id)")} AS revenue_per_rep,
       {ratio("SUM(revenue)", "COUNT(DISTINCT account_id)")} AS revenue_per_account
FROM fs GROUP BY 1, 2""",
        "bonus_tracker": with_(SALES, REPS, SUPPLIERS, PROGRAMS) + f"""
SELECT supplier_name, rep_name, r.division, quarter, 'Volume (cases)' AS program_type,
       {dbl("attainment_pct")} AS attainment_pct, {dbl("goal - actual")} AS gap_to_goal,
       {dbl("earned")} AS bonus_earned_usd, {dbl("missed")} AS bonus_missed_usd, status,
       CAST(CASE status WHEN 'Achieved' THEN 1 WHEN 'At Risk' THEN 2 WHEN 'Behind' THEN 3 ELSE 9 END AS BIGINT)
         AS status_sort_order,
       CASE WHEN attainment_pct >= 100 THEN '1_Achieved' WHEN attainment_pct >= 85 THEN '2_Push_Now'
            WHEN attainment_pct >= 60 THEN '3_Focus' ELSE '4_At_Risk' END AS urgency_bucket,
       {dbl("SUM(earned + missed) OVER (PARTITION BY supplier_id, quarter)")} AS supplier_total_pool
FROM attainments JOIN suppliers USING (supplier_id) JOIN reps r USING (rep_id)""",
        "price_tier_mix": with_(SALES, PRODUCTS) + f""",
mix AS (
  SELECT price_tier, category, sub_category, channel, year(order_date) AS year,
         COUNT(DISTINCT txn_id) AS transactions, CAST(SUM(cases) AS BIGINT) AS cases_sold,
         {dbl("SUM(revenue)")} AS net_revenue, {dbl("SUM(margin)")} AS est_margin,
         {mean("rpc")} AS avg_rev_per_case
  FROM fs JOIN products USING (sku_id) GROUP BY 1, 2, 3, 4, 5)
SELECT *, {pct("cases_sold", "SUM(cases_sold) OVER (PARTITION BY channel, year)")}
       AS pct_of_channel_volume FROM mix""",
        "geo_density": with_(SALES, ACCOUNTS) + f""",
towns AS (
  SELECT town, state, division, COUNT(DISTINCT account_id) AS accounts,
         COUNT(DISTINCT txn_id) AS transactions, CAST(SUM(cases) AS BIGINT) AS cases_sold,
         {dbl("SUM(revenue)")} AS net_revenue, {dbl("SUM(margin)")} AS est_margin,
         {ratio("SUM(revenue)", "COUNT(DISTINCT account_id)")} AS revenue_per_account
  FROM fs JOIN accounts a USING (account_id) GROUP BY town, state, division)
SELECT *, round({pct("revenue_per_account", "AVG(revenue_per_account) OVER (PARTITION BY division)")}, 4)
       AS pct_of_division_avg FROM towns""",
        "rfm_segments": with_(SALES, ACCOUNTS, REPS) + f""",
base AS (
  SELECT account_id, rep_id, CAST(DATE '2001-12-31' - MAX(order_date) AS BIGINT) AS recency_days,
         COUNT(DISTINCT txn_id) AS frequency, SUM(revenue) AS monetary, SUM(margin) AS margin,
         {mean("revenue")} AS avg_order_value
  FROM fs GROUP BY account_id, rep_id),
scored AS (
  SELECT *, NTILE(4) OVER (ORDER BY recency_days, account_id, rep_id) AS r,
         NTILE(4) OVER (ORDER BY frequency DESC, account_id, rep_id) AS f,
         NTILE(4) OVER (ORDER BY monetary DESC, account_id, rep_id) AS m
  FROM base),
seg AS (SELECT *, {segment} AS segment FROM scored)
SELECT account_name, account_type, a.channel, town, a.division, rep_name, recency_days, frequency,
       {dbl("monetary")} AS lifetime_revenue, {dbl("margin")} AS lifetime_margin, avg_order_value,
       CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_code,
       r + f + m AS rfm_total, segment, r AS r_score, f AS f_score, m AS m_score,
       CASE segment
         WHEN 'Champions' THEN 'Reward + upsell premium SKUs. Request referrals. Invite to tasting events.'
         WHEN 'Loyal Customers' THEN 'Offer exclusive supplier programs. Increase visit frequency to weekly.'
         WHEN 'At Risk' THEN 'URGENT: Call this week. Find out why orders dropped. Offer incentive deal.'
         WHEN 'Cannot Lose Them' THEN 'Personal VP visit required. Major revenue exposure if churned.'
         WHEN 'Potential Loyalists' THEN 'Introduce to new products. Increase order frequency with targeted promotions.'
         WHEN 'Hibernating' THEN 'Low-cost re-engagement: email campaign + new product sample.'
       END AS action_playbook,
       {dbl("CASE segment WHEN 'Champions' THEN monetary * 0.5 WHEN 'Loyal Customers' THEN monetary * 0.4 "
            "WHEN 'At Risk' THEN monetary * 0.6 WHEN 'Cannot Lose Them' THEN monetary * 0.7 ELSE 0 END")}
         AS revenue_at_risk_if_churned
FROM seg JOIN accounts a USING (account_id) JOIN reps r ON seg.rep_id = r.rep_id""",
        "rfm_summary": with_(SALES) + f""",
base AS (
  SELECT account_id, CAST(DATE '2001-12-31' - MAX(order_date) AS BIGINT) AS recency_days,
         COUNT(DISTINCT txn_id) AS frequency, SUM(revenue) AS monetary, SUM(margin) AS margin
  FROM fs GROUP BY account_id),
scored AS (
  SELECT *, NTILE(4) OVER (ORDER BY recency_days, account_id) AS r,
         NTILE(4) OVER (ORDER BY frequency DESC, account_id) AS f,
         NTILE(4) OVER (ORDER BY monetary DESC, account_id) AS m
  FROM base),
seg AS (SELECT *, {segment} AS segment FROM scored)
SELECT segment, COUNT(*) AS account_count, {dbl("SUM(monetary)")} AS total_revenue,
       {mean("monetary")} AS avg_revenue_per_account, {dbl("SUM(margin)")} AS total_margin,
       {mean("recency_days")} AS avg_recency, {mean("frequency")} AS avg_frequency,
       CASE segment WHEN 'Cannot Lose Them' THEN 'P1' WHEN 'At Risk' THEN 'P1'
            WHEN 'Champions' THEN 'P2' WHEN 'Loyal Customers' THEN 'P2'
            WHEN 'Potential Loyalists' THEN 'P3' ELSE 'P4' END AS priority
FROM seg GROUP BY segment""",
        "ab_channel": with_(SALES) + f""",
groups AS (
  SELECT channel AS test_group, COUNT(DISTINCT txn_id) AS n_transactions,
         COUNT(DISTINCT account_id) AS n_accounts, {dbl("SUM(revenue)")} AS total_revenue,
         {mean("revenue")} AS avg_order_value,
         CASE WHEN COUNT(revenue) > 1 THEN sqrt({dbl(
             "CAST((COUNT(revenue) * SUM(CAST(revenue * 100 AS HUGEINT) * CAST(revenue * 100 AS HUGEINT))"
             " - SUM(CAST(revenue * 100 AS HUGEINT)) * SUM(CAST(revenue * 100 AS HUGEINT))) * 10000"
             " // (COUNT(revenue) * (COUNT(revenue) - 1)) AS BIGINT)")}) / 10000 END AS stdev_order_value,
         {mean("rpc")} AS avg_rev_per_case, {dbl("SUM(margin)")} AS total_margin,
         {pct(mean("margin"), mean("revenue"))} AS avg_margin_pct,
         {pct("SUM(discount)", "SUM(gross)")} AS discount_rate,
         {ratio("SUM(revenue)", "COUNT(DISTINCT account_id)")} AS revenue_per_account
  FROM fs GROUP BY channel)
SELECT *, CASE WHEN avg_margin_pct = MAX(avg_margin_pct) OVER () THEN 'Winner' ELSE 'Comparison' END
       AS margin_winner FROM groups""",
        "ab_discount_lift": with_(SALES) + f"""
SELECT CASE WHEN disc = 0 THEN 'A_Control: No Discount'
            WHEN disc BETWEEN 1 AND 5 THEN 'B_Low Discount (1-5%)'
            WHEN disc BETWEEN 6 AND 15 THEN 'C_Mid Discount (6-15%)'
            ELSE 'D_High Discount (>15%)' END AS test_group,
       COUNT(*) AS n_transactions, {mean("disc")} AS avg_discount_applied,
       {mean("cases")} AS avg_cases_per_order, {mean("revenue")} AS avg_net_revenue_per_order,
       {mean("gross")} AS avg_gross_per_order, {mean("discount")} AS avg_discount_given,
       {mean("rpc")} AS avg_rev_per_case, {mean("margin")} AS avg_margin_per_order,
       {dbl("SUM(discount)")} AS total_discounts_given,
       {mean("cases")} / (SELECT {mean("cases")} FROM fs WHERE disc = 0) * 100 - 100
         AS case_uplift_vs_no_discount,
       {ratio("SUM(revenue)", "SUM(NULLIF(discount, 0))")} AS revenue_per_dollar_discounted
FROM fs GROUP BY 1""",
        "ab_discount_roi": with_(SALES) + f"""
SELECT {dbl("SUM(CASE WHEN disc = 0 THEN revenue ELSE 0 END)")} AS full_price_revenue,
       {dbl("SUM(CASE WHEN disc > 0 THEN revenue ELSE 0 END)")} AS discounted_revenue,
       {dbl("SUM(discount)")} AS total_discounts_given,
       {dbl("SUM(gross) - SUM(revenue)")} AS revenue_left_on_table,
       {pct("SUM(discount)", "SUM(gross)")} AS overall_discount_rate,
       {pct("SUM(discount)", "SUM(gross - discount)")} AS breakeven_uplift_needed
FROM fs""",
        "ab_premium_mix": with_(SALES, REPS, PRODUCTS) + f""",
mixes AS (
  SELECT rep_id, SUM(cases) AS cases, SUM(revenue) AS net, SUM(margin) AS margin,
         {pct("SUM(CASE WHEN price_tier IN ('Premium', 'Ultra-Premium') THEN cases ELSE 0 END)", "SUM(cases)")}
           AS mix,
         {half_up("CAST(SUM(CASE WHEN price_tier IN ('Premium', 'Ultra-Premium') THEN cases ELSE 0 END) AS HUGEINT) * 10000000000",
                  "SUM(cases)")} AS mix_units,
         {half_up("CAST(SUM(rpc) * 100 AS HUGEINT) * 1000000", "COUNT(rpc)")} AS per_case_units
  FROM fs JOIN products USING (sku_id) JOIN reps USING (rep_id) GROUP BY rep_id),
groups AS (
  SELECT CASE WHEN mix >= 50 THEN 'Treatment' ELSE 'Control' END AS ab_group, COUNT(*) AS n_reps,
         {mean("mix_units")} / 1e8 AS mix, {mean("net")} AS net,
         {mean("per_case_units")} / 1e8 AS per_case, {mean("margin")} AS margin,
         SUM(cases) AS cases
  FROM mixes GROUP BY 1),
lift AS (
  SELECT MAX(CASE WHEN ab_group = 'Treatment' THEN per_case END)
         - MIN(CASE WHEN ab_group = 'Control' THEN per_case END) AS lift,
         SUM(CASE WHEN ab_group = 'Control' THEN cases ELSE 0 END) AS control_cases
  FROM groups)
SELECT ab_group, n_reps, round(mix, 4) AS avg_premium_mix, net AS avg_rep_revenue,
       round(per_case, 4) AS avg_rev_per_case, margin AS avg_rep_margin,
       round(lift, 4) AS rev_per_case_lift,
       round(lift * CAST(control_cases AS DOUBLE), 4) AS potential_incremental_revenue
FROM groups CROSS JOIN lift""",
        "global_running_sum": with_(SALES) + f""",
per_sku AS (SELECT sku_id, SUM(revenue) AS revenue FROM fs GROUP BY sku_id)
SELECT sku_id, {dbl("revenue")} AS revenue_usd,
       {dbl("SUM(revenue) OVER (ORDER BY revenue DESC, sku_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")}
         AS running_revenue,
       RANK() OVER (ORDER BY revenue DESC) AS revenue_rank
FROM per_sku""",
    }


QUOTA_FACT = f"""
SELECT {{key}}, month_year, quota_cases, actual_cases,
       {dbl("attainment_pct")} AS attainment_pct, {dbl("quota_revenue")} AS quota_revenue_usd,
       {dbl("actual_revenue")} AS actual_revenue_usd, actual_cases - quota_cases AS cases_variance,
       {dbl("actual_revenue - quota_revenue")} AS revenue_variance_usd,
       CAST(SUM(actual_cases) OVER ytd AS BIGINT) AS ytd_actual_cases,
       CAST(SUM(quota_cases) OVER ytd AS BIGINT) AS ytd_quota_cases,
       CASE WHEN attainment_pct >= 100 THEN 'Achieved' WHEN attainment_pct >= 75 THEN 'At Risk'
            ELSE 'Behind' END AS performance_flag, rep_name, division, channel,
       DATE '2001-12-31' AS dwh_create_date
FROM quotas
WINDOW ytd AS (PARTITION BY rep_id, left(month_year, 4) ORDER BY month_year
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def star_sql() -> dict[str, str]:
    return {
        "dim_reps": with_(REPS) + """
SELECT ROW_NUMBER() OVER (ORDER BY rep_id) AS rep_key, rep_id AS rep_src_id, rep_name, division,
       channel, hire_date, 2001 - year(hire_date) AS years_tenure, email FROM reps""",
        "dim_accounts": with_(ACCOUNTS) + """
SELECT ROW_NUMBER() OVER (ORDER BY account_id) AS account_key, account_id AS account_src_id,
       account_name, account_type, channel, town, state, division, rep_id AS rep_src_id,
       CAST(is_active AS BIGINT) AS is_active,
       CASE WHEN is_active THEN 'Active' ELSE 'Inactive' END AS account_status FROM accounts""",
        "dim_products": with_(PRODUCTS) + f"""
SELECT ROW_NUMBER() OVER (ORDER BY sku_id) AS product_key, sku_id AS sku_src_id,
       supplier_id AS supplier_src_id, product_name, category, sub_category, size_ml,
       {dbl("price")} AS price_per_case_usd, price_tier FROM products""",
        "dim_suppliers": with_(SUPPLIERS) + """
SELECT ROW_NUMBER() OVER (ORDER BY supplier_id) AS supplier_key, supplier_id AS supplier_src_id,
       supplier_name, category, country, origin_type FROM suppliers""",
        "dim_programs": with_(SALES, PROGRAMS) + f"""
SELECT ROW_NUMBER() OVER (ORDER BY program_id) AS program_key, program_id AS program_src_id,
       supplier_id AS supplier_src_id, quarter, CAST(start_date AS DATE) AS start_date,
       CAST(start_date + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS end_date,
       'Volume (cases)' AS program_type, {dbl(cents("goal_cents"))} AS goal_value,
       CAST(5000 AS DOUBLE) AS bonus_usd, 'All' AS division,
       CAST(CAST(start_date + INTERVAL 3 MONTH AS DATE) - start_date AS BIGINT) AS program_duration_days
FROM programs""",
        "dim_date": """
WITH bounds AS (SELECT year(MIN(o_orderdate)) AS y0, year(MAX(o_orderdate)) AS y1 FROM orders),
days AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY))
                     AS DATE) AS d FROM bounds)
SELECT d AS full_date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, year(d) AS year,
       month(d) AS month_num, strftime(d, '%B') AS month_name, left(strftime(d, '%B'), 3) AS month_short,
       strftime(d, '%Y-%m') AS year_month, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week_num,
       strftime(d, '%A') AS day_of_week_name, quarter(d) AS quarter_num,
       'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_label,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
       CAST(dayofweek(d) IN (0, 6) AS BIGINT) AS is_weekend,
       CASE WHEN month(d) IN (11, 12) THEN 'Holiday Season' WHEN month(d) IN (6, 7, 8) THEN 'Summer Peak'
            ELSE 'Standard' END AS season
FROM days""",
        "fact_sales": with_(SALES) + f""",
rk AS (SELECT n_nationkey AS id, ROW_NUMBER() OVER (ORDER BY n_nationkey) AS rep_key FROM nation),
ak AS (SELECT c_custkey AS id, ROW_NUMBER() OVER (ORDER BY c_custkey) AS account_key FROM customer),
pk AS (SELECT p_partkey AS id, ROW_NUMBER() OVER (ORDER BY p_partkey) AS product_key FROM part),
sk AS (SELECT s_suppkey AS id, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS supplier_key FROM supplier)
SELECT txn_id, rep_key, account_key, product_key, supplier_key, order_date,
       CAST(cases AS BIGINT) AS cases_sold,
       {dbl("disc")} AS discount_pct, {dbl("revenue")} AS revenue_usd, {dbl("rpc")} AS revenue_per_case,
       {dbl("gross")} AS gross_revenue_usd, {dbl("discount")} AS discount_usd,
       {dbl("margin")} AS estimated_margin_usd, channel, CAST(1 AS BIGINT) AS is_valid,
       DATE '2001-12-31' AS dwh_create_date
FROM fs LEFT JOIN rk ON rep_id = rk.id LEFT JOIN ak ON account_id = ak.id
     LEFT JOIN pk ON sku_id = pk.id LEFT JOIN sk ON supplier_id = sk.id""",
        "fact_quota": with_(SALES, REPS, QUOTAS) + QUOTA_FACT.format(key="rep_id + 1 AS rep_key"),
        "fact_attainment": with_(SALES, REPS, SUPPLIERS, PROGRAMS) + f""",
pk AS (SELECT program_id, ROW_NUMBER() OVER (ORDER BY program_id) AS program_key FROM programs),
sk AS (SELECT supplier_id, ROW_NUMBER() OVER (ORDER BY supplier_id) AS supplier_key FROM suppliers)
SELECT rep_id + 1 AS rep_key, supplier_key, program_key, quarter, {dbl("goal")} AS goal_value,
       {dbl("actual")} AS actual_value, {dbl("attainment_pct")} AS attainment_pct,
       {dbl("earned")} AS bonus_earned_usd, {dbl("goal - actual")} AS gap_to_goal,
       {dbl("missed")} AS bonus_missed_usd, status,
       CAST(CASE status WHEN 'Achieved' THEN 1 WHEN 'At Risk' THEN 2 ELSE 3 END AS BIGINT)
         AS status_sort_order,
       'Volume (cases)' AS program_type, r.division, rep_name, channel, supplier_name,
       category AS supplier_category, DATE '2001-12-31' AS dwh_create_date
FROM attainments JOIN suppliers USING (supplier_id) JOIN reps r USING (rep_id)
     JOIN pk USING (program_id) JOIN sk USING (supplier_id)""",
        "quota_by_attainment": with_(SALES, REPS, QUOTAS) + QUOTA_FACT.format(key="rep_id"),
        "attainment_behind": with_(SALES, REPS, SUPPLIERS, PROGRAMS) + f"""
SELECT rep_id, supplier_id, program_id, quarter, {dbl("goal")} AS goal_value,
       {dbl("actual")} AS actual_value, {dbl("attainment_pct")} AS attainment_pct,
       {dbl("earned")} AS bonus_earned_usd, {dbl("goal - actual")} AS gap_to_goal,
       {dbl("missed")} AS bonus_missed_usd, status, CAST(3 AS BIGINT) AS status_sort_order,
       'Volume (cases)' AS program_type, r.division, rep_name, channel, supplier_name,
       category AS supplier_category, DATE '2001-12-31' AS dwh_create_date
FROM attainments JOIN suppliers USING (supplier_id) JOIN reps r USING (rep_id)
WHERE attainment_pct < 75""",
        "row_count_summary": with_(SALES, REPS, QUOTAS, PROGRAMS) + """
SELECT 'dim_reps' AS table_name, COUNT(*) AS row_count FROM nation UNION ALL
SELECT 'dim_accounts', COUNT(*) FROM customer UNION ALL
SELECT 'dim_products', COUNT(*) FROM part UNION ALL
SELECT 'dim_suppliers', COUNT(*) FROM supplier UNION ALL
SELECT 'dim_programs', COUNT(*) FROM programs UNION ALL
SELECT 'dim_date', datediff('day', make_date(year(MIN(o_orderdate)), 1, 1), make_date(year(MAX(o_orderdate)), 12, 31)) + 1 FROM orders UNION ALL
SELECT 'fact_sales', COUNT(*) FROM fs UNION ALL
SELECT 'fact_quota', COUNT(*) FROM quotas UNION ALL
SELECT 'fact_attainment', COUNT(*) FROM attainments""",
    }


def _pick(selector: str, *choices: str | None) -> str:
    cases = " ".join(
        f"WHEN {i} THEN " + ("NULL" if c is None else f"'{c}'") for i, c in enumerate(choices)
    )
    return f"CASE ({selector}) % {len(choices)} {cases} END"


QTY = "CAST(l_quantity AS INTEGER)"
LINE_ID = "CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)"
PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
SHIP = "CAST(l_shipdate AS DATE)"


def _day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


# Raw feeds: (source table, keys, [(column, expression)], load order).
FEEDS: dict[str, tuple[str, list[str], list[tuple[str, str]], str]] = {
    "sales_reps": (
        "customer",
        ["rep_id"],
        [
            ("rep_id", "CAST(c_nationkey AS VARCHAR)"),
            ("rep_name", "'  ' || c_name || ' '"),
            ("division", "c_mktsegment"),
            ("channel", _pick("c_custkey", " on-premise ", "OFF-PREMISE", "Online", None)),
            (
                "hire_date",
                "CASE WHEN c_custkey % 5 = 0 THEN 'not a date' ELSE "
                + _day("DATE '1990-01-01' + CAST(c_custkey % 9000 AS INTEGER)")
                + " END",
            ),
            ("email", "' ' || c_name || '@EXAMPLE.COM'"),
        ],
        "DATE '1995-01-01' + CAST(c_custkey % 200 AS INTEGER)",
    ),
    "suppliers": (
        "lineitem",
        ["supplier_id"],
        [
            ("supplier_id", "CASE WHEN l_linenumber % 2 = 0 THEN '0' ELSE '' END || CAST(l_suppkey AS VARCHAR)"),
            ("supplier_name", "' Supplier ' || CAST(l_suppkey AS VARCHAR) || ' '"),
            (
                "category",
                "CASE l_returnflag WHEN 'A' THEN ' WINE ' WHEN 'N' THEN 'wines and spirits' "
                "ELSE 'spirits' END",
            ),
            ("country", "CASE WHEN l_linenumber % 3 = 0 THEN ' USA ' ELSE l_linestatus END"),
        ],
        "l_shipdate",
    ),
    "products": (
        "lineitem",
        ["sku_id"],
        [
            ("sku_id", "CAST(l_partkey AS VARCHAR)"),
            ("product_name", "' Part ' || CAST(l_partkey AS VARCHAR)"),
            ("supplier_id", "' ' || CAST(l_suppkey AS VARCHAR)"),
            ("category", "l_returnflag"),
            ("sub_category", "l_linestatus || ' '"),
            ("size_ml", f"CASE WHEN {QTY} % 7 = 0 THEN 'n/a' ELSE CAST({QTY} AS VARCHAR) END"),
            ("price_per_case_usd", f"CASE WHEN {QTY} % 11 = 0 THEN 'tbd' ELSE {PRICE} END"),
        ],
        "l_shipdate",
    ),
    "accounts": (
        "orders",
        ["account_id"],
        [
            ("account_id", "CAST(o_custkey AS VARCHAR)"),
            ("account_name", "'Account ' || CAST(o_custkey AS VARCHAR) || '  '"),
            ("account_type", "o_orderpriority"),
            ("channel", _pick("o_orderkey", "On-Premise", " off-premise", "ON-PREMISE ", "Online")),
            ("town", "'Town ' || o_orderstatus"),
            ("state", "' ct '"),
            ("division", "'Division ' || o_orderstatus"),
            ("rep_id", "CAST(o_custkey % 28 AS VARCHAR)"),
            ("active", _pick("o_orderkey", "1", "0", None, "2", "true", "  ")),
        ],
        "o_orderdate",
    ),
    "supplier_programs": (
        "lineitem",
        ["program_id"],
        [
            ("program_id", LINE_ID),
            ("supplier_id", "CAST(l_suppkey AS VARCHAR)"),
            ("quarter", "' ' || CAST(year(l_shipdate) AS VARCHAR) || '-Q' || CAST(quarter(l_shipdate) AS VARCHAR)"),
            ("start_date", f"CASE WHEN {QTY} % 13 = 0 THEN 'soon' ELSE {_day(SHIP)} END"),
            (
                "end_date",
                f"CASE WHEN {QTY} % 17 = 0 THEN 'later' WHEN l_linenumber = 7 THEN {_day(SHIP + ' - 10')} "
                f"ELSE {_day(SHIP + ' + ' + QTY)} END",
            ),
            ("program_type", "' Type ' || l_returnflag"),
            ("goal_value", f"CASE WHEN {QTY} % 5 = 0 THEN NULL ELSE CAST({QTY} AS VARCHAR) END"),
            ("bonus_usd", PRICE),
            ("division", "l_linestatus"),
        ],
        "l_shipdate",
    ),
    "sales_transactions": (
        "lineitem",
        ["txn_id"],
        [
            ("txn_id", LINE_ID),
            ("txn_date", f"CASE WHEN {QTY} = 13 THEN '31/12/99' ELSE {_day(SHIP)} END"),
            ("account_id", "CAST(l_orderkey % 1000 AS VARCHAR)"),
            ("rep_id", "CAST(l_partkey % 30 AS VARCHAR)"),
            ("division", "' Division ' || l_linestatus"),
            ("sku_id", "CAST(l_partkey AS VARCHAR)"),
            ("supplier_id", "CAST(l_suppkey AS VARCHAR)"),
            ("cases_sold", f"CASE WHEN {QTY} = 17 THEN '0' ELSE CAST({QTY} AS VARCHAR) END"),
            (
                "discount_pct",
                f"CASE WHEN {QTY} % 19 = 0 THEN NULL ELSE "
                "CAST(CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS VARCHAR) END",
            ),
            ("revenue_usd", f"CASE WHEN {QTY} = 23 THEN '0.00' WHEN {QTY} = 29 THEN NULL ELSE {PRICE} END"),
            ("channel", _pick("l_partkey", " on-premise", "OFF-PREMISE ", "Online")),
        ],
        "l_shipdate",
    ),
    "rep_quota_actuals": (
        "lineitem",
        ["rep_id", "month"],
        [
            ("rep_id", "CAST(l_suppkey AS VARCHAR)"),
            ("rep_name", "' Rep ' || CAST(l_suppkey AS VARCHAR)"),
            ("division", "l_linestatus || ' '"),
            ("month", "strftime(l_shipdate, '%Y-%m')"),
            ("quota_cases", "'25'"),
            ("actual_cases", f"CAST({QTY} AS VARCHAR)"),
            ("attainment_pct", f"CASE WHEN {QTY} % 10 = 9 THEN 'n/a' ELSE CAST({QTY} * 4 AS VARCHAR) END"),
            ("quota_revenue_usd", PRICE),
            ("actual_revenue_usd", PRICE),
        ],
        "l_shipdate",
    ),
    "program_attainments": (
        "lineitem",
        ["attainment_id"],
        [
            ("attainment_id", LINE_ID),
            ("program_id", "CAST(l_orderkey AS VARCHAR)"),
            ("supplier_id", "CAST(l_suppkey AS VARCHAR)"),
            ("quarter", "CAST(year(l_shipdate) AS VARCHAR) || '-Q1 '"),
            ("rep_id", "CAST(l_partkey % 25 AS VARCHAR)"),
            ("rep_name", "' Rep ' || CAST(l_partkey % 25 AS VARCHAR)"),
            ("division", "l_linestatus"),
            ("program_type", "' Volume (cases)'"),
            ("goal_value", f"CASE WHEN {QTY} % 6 = 0 THEN '0' ELSE '25' END"),
            ("actual_value", f"CAST({QTY} AS VARCHAR)"),
            ("attainment_pct", f"CAST({QTY} * 4 + CASE WHEN l_linenumber = 1 THEN 2 ELSE 0 END AS VARCHAR)"),
            ("status", _pick("l_linenumber", " achieved", "AT RISK", "Behind ", "Unknown")),
            ("bonus_earned_usd", PRICE),
        ],
        "l_shipdate",
    ),
}

CHANNEL_TEXT = (
    "CASE upper(trim(channel)) WHEN 'ON-PREMISE' THEN 'On-Premise' WHEN 'OFF-PREMISE' THEN 'Off-Premise' "
    "ELSE trim(channel) END"
)


def big(column: str) -> str:
    return f"CAST(trim({column}) AS BIGINT)"


def money(column: str, type_: str = "DECIMAL(12,2)") -> str:
    return f"CAST(TRY_CAST({column} AS {type_}) AS DOUBLE)"


# Cleansed columns per feed, over its deduplicated rows.
CLEANSED: dict[str, str] = {
    "sales_reps": f"""{big("rep_id")} AS rep_id, trim(rep_name) AS rep_name, trim(division) AS division,
       {CHANNEL_TEXT} AS channel, TRY_CAST(hire_date AS DATE) AS hire_date, lower(trim(email)) AS email""",
    "suppliers": f"""{big("supplier_id")} AS supplier_id, trim(supplier_name) AS supplier_name,
       CASE WHEN upper(trim(category)) = 'WINE' THEN 'Wine' WHEN upper(trim(category)) = 'SPIRITS' THEN 'Spirits'
            WHEN upper(trim(category)) LIKE '%WINE%SPIRIT%' THEN 'Wine & Spirits' ELSE trim(category) END
         AS category, trim(country) AS country""",
    "products": f"""{big("sku_id")} AS sku_id, trim(product_name) AS product_name,
       {big("supplier_id")} AS supplier_id, trim(category) AS category, trim(sub_category) AS sub_category,
       CAST(TRY_CAST(size_ml AS INTEGER) AS BIGINT) AS size_ml,
       {money("price_per_case_usd", "DECIMAL(10,2)")} AS price_per_case_usd""",
    "accounts": f"""{big("account_id")} AS account_id, trim(account_name) AS account_name,
       trim(account_type) AS account_type, {CHANNEL_TEXT} AS channel, trim(town) AS town,
       upper(trim(state)) AS state, trim(division) AS division, {big("rep_id")} AS rep_id,
       CASE WHEN active IS NULL OR trim(active) = '' THEN 0 WHEN active = 'true' THEN 1
            ELSE CAST(CAST(active AS INTEGER) <> 0 AS BIGINT) END AS is_active""",
    "supplier_programs": f"""{big("program_id")} AS program_id, {big("supplier_id")} AS supplier_id,
       trim(quarter) AS quarter, TRY_CAST(start_date AS DATE) AS start_date,
       TRY_CAST(end_date AS DATE) AS end_date, trim(program_type) AS program_type,
       {money("goal_value")} AS goal_value, {money("bonus_usd")} AS bonus_usd, trim(division) AS division""",
    "sales_transactions": f"""{big("txn_id")} AS txn_id, TRY_CAST(txn_date AS DATE) AS txn_date,
       {big("account_id")} AS account_id, {big("rep_id")} AS rep_id, trim(division) AS division,
       {big("sku_id")} AS sku_id, {big("supplier_id")} AS supplier_id, {big("cases_sold")} AS cases_sold,
       COALESCE({money("discount_pct", "DECIMAL(5,2)")}, 0) AS discount_pct,
       {money("revenue_usd")} AS revenue_usd, {CHANNEL_TEXT} AS channel,
       CASE WHEN TRY_CAST(revenue_usd AS DECIMAL(12,2)) IS NULL THEN 0
            WHEN TRY_CAST(revenue_usd AS DECIMAL(12,2)) <= 0 THEN 0
            WHEN CAST(cases_sold AS INTEGER) <= 0 THEN 0
            WHEN TRY_CAST(txn_date AS DATE) IS NULL THEN 0 ELSE CAST(1 AS BIGINT) END AS is_valid""",
    "rep_quota_actuals": f"""{big("rep_id")} AS rep_id, trim(rep_name) AS rep_name,
       trim(division) AS division, trim(month) AS month_year, {big("quota_cases")} AS quota_cases,
       {big("actual_cases")} AS actual_cases, {money("attainment_pct", "DECIMAL(6,2)")} AS attainment_pct,
       {money("quota_revenue_usd", "DECIMAL(14,2)")} AS quota_revenue_usd,
       {money("actual_revenue_usd", "DECIMAL(14,2)")} AS actual_revenue_usd,
       CASE WHEN TRY_CAST(attainment_pct AS DECIMAL(6,2)) >= 100 THEN 'Achieved'
            WHEN TRY_CAST(attainment_pct AS DECIMAL(6,2)) >= 75 THEN 'At Risk' ELSE 'Behind' END
         AS performance_flag""",
    "program_attainments": f"""{big("attainment_id")} AS attainment_id, {big("program_id")} AS program_id,
       {big("supplier_id")} AS supplier_id, trim(quarter) AS quarter, {big("rep_id")} AS rep_id,
       trim(rep_name) AS rep_name, trim(division) AS division, trim(program_type) AS program_type,
       {money("goal_value")} AS goal_value, {money("actual_value")} AS actual_value,
       {money("attainment_pct", "DECIMAL(6,2)")} AS attainment_pct,
       CASE upper(trim(status)) WHEN 'ACHIEVED' THEN 'Achieved' WHEN 'AT RISK' THEN 'At Risk'
            WHEN 'BEHIND' THEN 'Behind' ELSE trim(status) END AS status,
       {money("bonus_earned_usd")} AS bonus_earned_usd""",
}

VALID_RANGE = (
    "TRY_CAST(start_date AS DATE) IS NOT NULL AND TRY_CAST(end_date AS DATE) IS NOT NULL "
    "AND TRY_CAST(start_date AS DATE) <= TRY_CAST(end_date AS DATE)"
)


def raw_cte(feed: str) -> str:
    source, _, columns, load_order = FEEDS[feed]
    selected = ",\n         ".join(f"{expression} AS {name}" for name, expression in columns)
    return f"""
raw_{feed} AS (
  SELECT {selected},
         {load_order} AS loaded
  FROM {source})"""


def latest_cte(feed: str) -> str:
    _, keys, columns, _ = FEEDS[feed]
    numbers = [k if k == "month" else f"CAST({k} AS BIGINT)" for k in keys]
    ties = ", ".join(f"{name} ASC NULLS FIRST" for name, _ in columns if name not in keys)
    return raw_cte(feed) + f""",
latest_{feed} AS (
  SELECT * FROM raw_{feed}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY {", ".join(numbers)} ORDER BY loaded DESC NULLS LAST, {ties}) = 1)"""


def clean_cte(feed: str) -> str:
    where = f" WHERE {VALID_RANGE}" if feed == "supplier_programs" else ""
    return latest_cte(feed) + f""",
clean_{feed} AS (SELECT {CLEANSED[feed]} FROM latest_{feed}{where})"""


def cleansing_sql() -> dict[str, str]:
    keys = {
        "silver_reps": "sales_reps",
        "silver_suppliers": "suppliers",
        "silver_products": "products",
        "silver_accounts": "accounts",
        "silver_programs": "supplier_programs",
        "silver_transactions": "sales_transactions",
        "silver_quota": "rep_quota_actuals",
        "silver_attainments": "program_attainments",
    }
    result = {key: with_(clean_cte(feed)) + f"\nSELECT * FROM clean_{feed}" for key, feed in keys.items()}
    result["silver_programs_rejected"] = with_(latest_cte("supplier_programs")) + f"""
SELECT program_id, start_date, end_date,
       CASE WHEN TRY_CAST(start_date AS DATE) IS NULL THEN 'start_date is not a date'
            WHEN TRY_CAST(end_date AS DATE) IS NULL THEN 'end_date is not a date'
            ELSE 'start_date is after end_date' END AS reject_reason
FROM latest_supplier_programs WHERE NOT ({VALID_RANGE})"""
    return result


def quality_sql() -> dict[str, str]:
    def count(check: str, feed: str, failure: str) -> str:
        return (
            f"SELECT '{check}' AS check_id, '{feed}' AS table_name, COUNT(*) AS failures "
            f"FROM clean_{feed} WHERE {failure}"
        )

    def labels(check: str, feed: str, column: str) -> str:
        return (
            f"SELECT '{check}' AS check_id, '{feed}' AS table_name, {column} AS value, COUNT(*) AS cnt "
            f"FROM clean_{feed} GROUP BY {column}"
        )

    def repeated(check: str, feed: str, key: str) -> str:
        return (
            f"SELECT '{check}' AS check_id, '{feed}' AS table_name, {key} AS key, COUNT(*) AS cnt "
            f"FROM raw_{feed} GROUP BY 3 HAVING COUNT(*) > 1"
        )

    union = "\nUNION ALL ".join
    clean = lambda *names: with_(*[clean_cte(name) for name in names]) + "\n"
    return {
        "qc_nulls": clean("sales_reps", "sales_transactions", "products", "supplier_programs")
        + union(
            [
                count("1a", "sales_reps", "rep_id IS NULL"),
                count("1b", "sales_transactions", "txn_date IS NULL"),
                count("1c", "sales_transactions", "revenue_usd IS NULL OR revenue_usd <= 0"),
                count("1d", "products", "price_per_case_usd IS NULL"),
                count("1e", "supplier_programs", "goal_value IS NULL OR bonus_usd IS NULL"),
            ]
        ),
        "qc_ranges": clean("sales_reps", "sales_transactions", "supplier_programs")
        + union(
            [
                count(
                    "3a",
                    "sales_transactions",
                    "txn_date < DATE '1996-01-01' OR txn_date > DATE '2000-12-31'",
                ),
                count("3b", "supplier_programs", "start_date > end_date"),
                count("3c", "sales_reps", "hire_date > DATE '2010-01-01'"),
            ]
        ),
        "qc_counts": clean("sales_reps", "sales_transactions", "products", "supplier_programs")
        + union(
            [
                count("1a", "sales_reps", "rep_id IS NULL"),
                count("1b", "sales_transactions", "txn_date IS NULL"),
                count("1c", "sales_transactions", "revenue_usd IS NULL OR revenue_usd <= 0"),
                count("1d", "products", "price_per_case_usd IS NULL"),
                count("1e", "supplier_programs", "goal_value IS NULL OR bonus_usd IS NULL"),
                count("3a", "sales_transactions", "txn_date < DATE '1996-01-01' OR txn_date > DATE '2000-12-31'"),
                count("3b", "supplier_programs", "start_date > end_date"),
                count("3c", "sales_reps", "hire_date > DATE '2010-01-01'"),
                count("5a", "sales_transactions", "is_valid = 0"),
            ]
        ),
        "qc_domains": clean("accounts", "suppliers", "rep_quota_actuals", "program_attainments")
        + union(
            [
                labels("4a", "accounts", "channel"),
                labels("4b", "suppliers", "category"),
                labels("4c", "rep_quota_actuals", "performance_flag"),
                labels("4d", "program_attainments", "status"),
            ]
        ),
        "qc_duplicates": with_(
            *[raw_cte(f) for f in ("sales_reps", "sales_transactions", "products", "rep_quota_actuals")]
        )
        + "\n"
        + union(
            [
                repeated("2a", "sales_reps", "' ' || rep_id"),
                repeated("2b", "sales_transactions", "txn_id"),
                repeated("2c", "products", "sku_id"),
                repeated("2d", "rep_quota_actuals", "rep_id || '|' || month"),
            ]
        ),
        "qc_invalid_sales": clean("sales_transactions")
        + "SELECT txn_id, txn_date, cases_sold, revenue_usd, is_valid FROM clean_sales_transactions "
        "WHERE is_valid = 0",
        "qc_pct_gap": clean("program_attainments")
        + f""", gaps AS (
  SELECT attainment_id, goal_value, actual_value, attainment_pct AS stored_pct,
         {dbl(cents(half_up("CAST(actual_value AS BIGINT) * 10000", "NULLIF(CAST(goal_value AS BIGINT), 0)")))}
           AS calc_pct
  FROM clean_program_attainments)
SELECT *, abs(stored_pct - calc_pct) AS gap FROM gaps WHERE abs(stored_pct - calc_pct) > 1""",
        "qc_row_counts": clean(*FEEDS)
        + union(
            [f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM clean_{name}" for name in FEEDS]
        ),
        "qc_orphans": clean("sales_reps", "sales_transactions", "accounts")
        + """SELECT DISTINCT '5c' AS check_id, t.rep_id, CAST(NULL AS VARCHAR) AS account_name
FROM clean_sales_transactions t LEFT JOIN clean_sales_reps r ON t.rep_id = r.rep_id WHERE r.rep_id IS NULL
UNION ALL
SELECT DISTINCT '5d', a.rep_id, a.account_name
FROM clean_accounts a LEFT JOIN clean_sales_reps r ON a.rep_id = r.rep_id WHERE r.rep_id IS NULL""",
    }


def load_sql() -> dict[str, str]:
    columns = ", ".join(name for name, _ in FEEDS["accounts"][2])
    return {
        "bronze_accounts": with_(raw_cte("accounts")).replace(
            "CAST(o_custkey AS VARCHAR) AS account_id", "CAST(o_custkey AS VARCHAR) || ' ' AS account_id"
        )
        + f"\nSELECT {columns} FROM raw_accounts",
        # Files carry no load time: all rows of a load have the same one.
        "load_audit": with_(*[clean_cte(feed).replace(f"{FEEDS[feed][3]} AS loaded", "0 AS loaded") for feed in FEEDS])
        + "\n"
        + " UNION ALL ".join(
            [_loaded("bronze", feed, f"raw_{feed}") for feed in FEEDS]
            + [_loaded("silver", feed, f"clean_{feed}") for feed in FEEDS]
            + [
                _loaded("gold", name, f"clean_{feed}", where)
                for name, feed, where in (
                    ("dim_reps", "sales_reps", ""),
                    ("dim_accounts", "accounts", ""),
                    ("dim_products", "products", ""),
                    ("dim_suppliers", "suppliers", ""),
                    ("dim_programs", "supplier_programs", ""),
                    ("fact_sales", "sales_transactions", " WHERE is_valid = 1"),
                    ("fact_quota", "rep_quota_actuals", ""),
                    ("fact_attainment", "program_attainments", ""),
                )
            ]
        )
        + """ UNION ALL
SELECT 'gold', 'dim_date', datediff('day', make_date(year(MIN(txn_date)), 1, 1), make_date(year(MAX(txn_date)), 12, 31)) + 1, 1
FROM clean_sales_transactions""",
        "load_isolated": with_(*[raw_cte(feed) for feed in FEEDS])
        + "\n"
        + " UNION ALL ".join(
            f"SELECT '{feed}' AS table_name, CAST(NULL AS BIGINT) AS rows, CAST(0 AS BIGINT) AS ok, "
            "CAST(1 AS BIGINT) AS failed, CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS BIGINT) AS one_stamp"
            if feed in ("products", "suppliers")
            else f"SELECT '{feed}' AS table_name, COUNT(*) AS rows, CAST(1 AS BIGINT) AS ok, CAST(0 AS BIGINT) AS failed, "
            f"COUNT(*) AS row_count, CAST(1 AS BIGINT) AS one_stamp FROM raw_{feed}"
            for feed in FEEDS
        ),
        "load_fail_fast": with_(*[clean_cte(feed) for feed in ("sales_reps", "suppliers", "products", "accounts")])
        + """
SELECT 'sales_reps' AS table_name, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS raised FROM clean_sales_reps WHERE rep_id % 2 = 0
UNION ALL SELECT 'suppliers', COUNT(*), 1 FROM clean_suppliers WHERE supplier_id % 2 = 0
UNION ALL SELECT 'products', COUNT(*), 1 FROM clean_products
UNION ALL SELECT 'accounts', COUNT(*), 1 FROM clean_accounts""",
        "silver_stamps": with_(*[clean_cte(feed) for feed in FEEDS])
        + "\n"
        + " UNION ALL ".join(
            f"SELECT '{feed}' AS table_name, 'bronze.{feed}' AS first_source, 'bronze.{feed}' AS last_source, "
            "DATE '2001-12-31' AS first_load, DATE '2001-12-31' AS last_load, "
            f"COUNT(*) AS stamped FROM clean_{feed}"
            for feed in FEEDS
        ),
    }


def _loaded(layer: str, name: str, table: str, where: str = "") -> str:
    return (
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS rows, CAST(1 AS BIGINT) AS ok FROM {table}{where}"
    )


# Sales as the analyses see them, from the cleansed feeds.
SILVER_SALES = f"""
fs AS (
  SELECT t.*, {cents(half_up("CAST(revenue * 100 AS BIGINT)", "cases"))} AS rpc,
         round(revenue * 0.30, 2) AS margin, round(gross * disc * 0.01, 2) AS discount
  FROM (
    SELECT txn_id, CASE WHEN account_id IN (SELECT account_id FROM clean_accounts) THEN account_id END AS account_id,
           CASE WHEN rep_id IN (SELECT rep_id FROM clean_sales_reps) THEN rep_id END AS rep_id, t.sku_id,
           t.supplier_id, channel, txn_date AS order_date, cases_sold AS cases,
           CAST(discount_pct AS DECIMAL(5,2)) AS disc, CAST(revenue_usd AS DECIMAL(12,2)) AS revenue,
           CAST(cases_sold * COALESCE(CAST(price_per_case_usd AS DECIMAL(10,2)), 0) AS DECIMAL(14,2)) AS gross
    FROM clean_sales_transactions t LEFT JOIN clean_products p ON t.sku_id = p.sku_id
    WHERE is_valid = 1) t)"""
# Products of the cleansed feed with the tiers of the registered query.
SILVER_PRODUCTS = """
products AS (
  SELECT sku_id, category, sub_category,
         CASE WHEN price_per_case_usd < 20000 THEN 'Value' WHEN price_per_case_usd < 40000 THEN 'Mid-Range'
              WHEN price_per_case_usd < 60000 THEN 'Premium' ELSE 'Ultra-Premium' END AS price_tier
  FROM clean_products)"""


def _shown(column: str, digits: int) -> str:
    # Six decimals: with more, scaling a double of this size loses its last digits.
    exact = f"round(CAST({column} AS DECIMAL(28,6)), {digits})"
    return f"format('{{:,.{digits}f}}', CAST({exact} AS DOUBLE))"


def usd(column: str, digits: int = 0) -> str:
    return f"'$' || {_shown(column, digits)}"


def percent(column: str, digits: int) -> str:
    return f"{_shown(column, digits)} || '%'"


def words(column: str, **texts: str) -> str:
    cases = " ".join(f"WHEN '{k.replace('_', ' ')}' THEN '{v}'" for k, v in texts.items())
    return f"CASE {column} {cases} END"


# Per report, the columns shown differently from the analysis.
REPORTS: dict[str, dict[str, str]] = {
    "customer_ltv": {
        "lifetime_revenue": usd("lifetime_revenue"),
        "lifetime_margin": usd("lifetime_margin"),
        "avg_order_value": usd("avg_order_value", 2),
        "monthly_ltv": usd("monthly_ltv"),
        "ltv_tier": words(
            "ltv_tier", Platinum="💎 Platinum", Gold="🥇 Gold", Silver="🥈 Silver", Bronze="🥉 Bronze"
        ),
    },
    "account_retention": {
        "revenue_1999": usd("revenue_1999"),
        "revenue_2000": usd("revenue_2000"),
        "yoy_change": usd("yoy_change"),
        "yoy_growth_pct": percent("yoy_growth_pct", 1),
        "retention_status": words(
            "retention_status",
            Churned="🔴 CHURNED — Needs Win-Back",
            New="🟢 NEW in 2000",
            Growing="📈 Growing (+10%)",
            Declining="📉 Declining (-10%)",
            Stable="➡️  Stable",
        ),
        "at_risk_revenue": usd("at_risk_revenue"),
    },
    "revenue_pareto": {
        "account_revenue": usd("account_revenue"),
        "pct_of_total": percent("pct_of_total", 2),
        "cumulative_pct": percent("cumulative_pct", 1),
        "pareto_group": words(
            "pareto_group", Top_Revenue="⭐ Top 80% Revenue", Tail_Revenue="   Tail Revenue"
        ),
    },
    "order_gaps": {
        "total_revenue": usd("total_revenue"),
        "engagement_health": words(
            "engagement_health",
            Weekly_Buyer="🟢 Weekly Buyer",
            Monthly_Buyer="🟡 Monthly Buyer",
            Occasional="🟠 Occasional",
            Infrequent="🔴 Infrequent — Churn Risk",
        ),
    },
    "discount_leakage": {
        "net_revenue": usd("net_revenue"),
        "total_discounts": usd("total_discounts"),
        "rep_disc_rate": percent("rep_disc_rate", 2),
        "company_avg": percent("company_avg", 2),
        "above_avg_by": percent("above_avg_by", 2),
        "recoverable_revenue": usd("recoverable_revenue"),
        "action": words(
            "action",
            Investigate_Now="🚨 Investigate Now",
            Monitor_Closely="⚠️  Monitor Closely",
            Within_Policy="✅ Within Policy",
        ),
    },
    "kpi_card": {
        **{
            c: usd(c)
            for c in (
                "total_net_revenue",
                "total_gross_revenue",
                "total_discounts",
                "total_est_margin",
            )
        },
        "overall_margin_pct": percent("overall_margin_pct", 1),
        "overall_discount_rate": percent("overall_discount_rate", 1),
        "avg_rev_per_case": usd("avg_rev_per_case", 2),
    },
    "rfm_segments": {
        "lifetime_revenue": usd("lifetime_revenue"),
        "lifetime_margin": usd("lifetime_margin"),
        "avg_order_value": usd("avg_order_value", 2),
        "revenue_at_risk_if_churned": usd("revenue_at_risk_if_churned"),
    },
    "rfm_summary": {
        "total_revenue": usd("total_revenue"),
        "avg_revenue_per_account": usd("avg_revenue_per_account"),
        "total_margin": usd("total_margin"),
        "avg_recency": f"{_shown('avg_recency', 0)} || ' days'",
        "avg_frequency": f"{_shown('avg_frequency', 1)} || ' orders'",
        "priority": words(
            "priority",
            P1="🔴 P1 — Immediate Action",
            P2="🟢 P2 — Nurture & Grow",
            P3="🟡 P3 — Develop",
            P4="⚪ P4 — Low-cost Re-engage",
        ),
    },
    "ab_channel": {
        "total_revenue": usd("total_revenue"),
        "avg_order_value": usd("avg_order_value", 2),
        "stdev_order_value": _shown("stdev_order_value", 2),
        "avg_rev_per_case": usd("avg_rev_per_case", 2),
        "total_margin": usd("total_margin"),
        "avg_margin_pct": percent("avg_margin_pct", 1),
        "discount_rate": percent("discount_rate", 1),
        "revenue_per_account": usd("revenue_per_account"),
        "margin_winner": words(
            "margin_winner", Winner="🏆 Higher Margin Winner", Comparison="   Comparison"
        ),
    },
    "ab_discount_lift": {
        "avg_discount_applied": percent("avg_discount_applied", 1),
        **{
            c: usd(c, 2)
            for c in (
                "avg_cases_per_order",
                "avg_net_revenue_per_order",
                "avg_gross_per_order",
                "avg_discount_given",
                "avg_rev_per_case",
                "avg_margin_per_order",
                "revenue_per_dollar_discounted",
            )
        },
        "total_discounts_given": usd("total_discounts_given"),
        "case_uplift_vs_no_discount": percent("case_uplift_vs_no_discount", 1),
    },
    "ab_discount_roi": {
        "full_price_revenue": usd("full_price_revenue"),
        "discounted_revenue": usd("discounted_revenue"),
        "total_discounts_given": usd("total_discounts_given"),
        "revenue_left_on_table": usd("revenue_left_on_table"),
        "overall_discount_rate": percent("overall_discount_rate", 2),
        "breakeven_uplift_needed": percent("breakeven_uplift_needed", 2),
    },
    "ab_premium_mix": {
        "ab_group": words(
            "ab_group",
            Treatment="Treatment: High Premium Mix (≥50%)",
            Control="Control: Low Premium Mix (<50%)",
        ),
        "avg_premium_mix": percent("avg_premium_mix", 1),
        "avg_rep_revenue": usd("avg_rep_revenue"),
        "avg_rev_per_case": usd("avg_rev_per_case", 2),
        "avg_rep_margin": usd("avg_rep_margin"),
        "rev_per_case_lift": usd("rev_per_case_lift", 2),
        "potential_incremental_revenue": usd("potential_incremental_revenue"),
    },
}


def report_sql() -> dict[str, str]:
    analyses = analysis_sql()
    return {
        f"report_{name}": "SELECT * REPLACE ("
        + ", ".join(f"{shown} AS {column}" for column, shown in columns.items())
        + f") FROM ({analyses[name]})"
        for name, columns in REPORTS.items()
    }


def oracle_sql() -> dict[str, str]:
    analyses = analysis_sql()
    return {
        **analyses,
        # The same analyses, read from the published gold tables.
        **{f"gold_{key}": sql for key, sql in analyses.items() if key != "global_running_sum"},
        "gold_trend_of_days": analyses["monthly_trend"].replace(
            "WHERE revenue > 0 AND cases > 0",
            "WHERE revenue > 0 AND cases > 0 AND order_date BETWEEN DATE '1996-03-10' AND DATE '1996-05-20'",
        ),
        # The same analyses, of the cleansed feeds.
        **{
            f"silver_{key}": analyses[key].replace(with_(*was), with_(*[clean_cte(feed) for feed in feeds], *now))
            for key, was, feeds, now in (
                ("kpi_card", [SALES], ("sales_transactions", "products", "accounts", "sales_reps"), [SILVER_SALES]),
                ("monthly_trend", [SALES], ("sales_transactions", "products", "accounts", "sales_reps"), [SILVER_SALES]),
                (
                    "price_tier_mix",
                    [SALES, PRODUCTS],
                    ("sales_transactions", "products", "accounts", "sales_reps"),
                    [SILVER_SALES, SILVER_PRODUCTS],
                ),
            )
        },
        **star_sql(),
        **cleansing_sql(),
        **quality_sql(),
        **load_sql(),
        **report_sql(),
    }
