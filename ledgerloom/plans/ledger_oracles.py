"""DuckDB statements equal to the ledger queries."""

_BASE = """base AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS event_id, c_mktsegment AS operator_code,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'T' || o_orderkey END AS partner_txn_id, CAST(o_custkey % 40 AS VARCHAR) AS person,
  CASE o_orderstatus WHEN 'F' THEN 'recursion_success' WHEN 'O' THEN 'subscription_success' WHEN 'P' THEN 'refund' END AS txn_type,
  o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(18,4)) AS amount, CAST(o_orderdate AS DATE) AS day, o_orderdate AS ts FROM orders JOIN customer ON o_custkey = c_custkey)"""
_LEDGERS = f"""{_BASE},
p AS (SELECT event_id, operator_code, partner_txn_id, 'A' || person AS account_id, txn_type, priority AS plan_code, amount, day AS business_date, ts,
  CAST(day + CAST(CASE WHEN k % 9 = 0 THEN 3 ELSE k % 2 END AS INTEGER) AS DATE) AS arrival FROM base WHERE k % 17 <> 0),
i AS (SELECT event_id, operator_code, partner_txn_id, 'U' || person AS identity, 'S' || person AS sub_id, txn_type, CASE WHEN txn_type = 'subscription_success' THEN priority END AS plan_code,
  CAST(round(amount * CASE WHEN k % 7 = 0 THEN 1.020 WHEN k % 7 = 1 THEN 1.004 ELSE 1.000 END, 4) AS DECIMAL(18,4)) AS amount,
  CAST(day + CAST(CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END AS INTEGER) AS DATE) AS business_date, ts FROM base WHERE k % 11 <> 0),
x AS (SELECT p.event_id AS pe, i.event_id AS ie, p.operator_code, p.partner_txn_id, p.txn_type, coalesce(p.plan_code, i.plan_code) AS plan_code, p.business_date,
  p.amount AS pa, i.amount AS ia, greatest(p.arrival, i.business_date) AS arrival, i.identity
  FROM p JOIN i ON p.operator_code = i.operator_code AND p.partner_txn_id = i.partner_txn_id AND abs(date_diff('day', p.business_date, i.business_date)) <= 1)"""
_TOL = "abs({a} - {b}) <= greatest(0.01, 0.005 * abs({a}))"
_BRIDGE = """who AS (SELECT DISTINCT c_mktsegment AS operator_code, c_custkey % 40 AS n FROM customer),
bridge AS (SELECT operator_code, 'A' || n AS account_id, 'U' || n AS user_id, DATE '1990-01-01' AS f, DATE '1995-06-17' AS t FROM who
UNION ALL SELECT operator_code, 'A' || n, 'U' || CASE WHEN n % 8 = 0 THEN (n + 1) % 40 ELSE n END, DATE '1995-06-17', DATE '9999-12-31' FROM who)"""
_CHURN = """churn AS (SELECT c_mktsegment AS operator_code, 'U' || (c_custkey % 40) AS user_id,
  CAST(DATE '1994-01-01' + CAST((c_custkey % 40) * 20 + c_custkey % 5 AS INTEGER) AS TIMESTAMP) AS churn_ts FROM customer WHERE (c_custkey % 40) % 3 = 0),
churned AS (SELECT operator_code, user_id, min(churn_ts) AS churn_ts FROM churn GROUP BY ALL)"""
_VERSIONS = """codes AS (SELECT DISTINCT o_orderpriority AS plan_code, TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS digit FROM orders), plans AS (
SELECT plan_code, CAST(coalesce(digit, 9) * step.price AS DECIMAL(18,4)) AS price, CASE WHEN digit IN (2, 3) THEN 'NGN' WHEN digit = 4 THEN 'PKR' ELSE 'USD' END AS currency, step.f, step.t
FROM codes CROSS JOIN (VALUES (20000, DATE '1992-01-01', DATE '1995-07-01'), (30000, DATE '1995-07-01', DATE '9999-12-31')) step(price, f, t)),
rates AS (SELECT currency, CAST(d AS DATE) AS rate_date, CAST(base + day(d) * 0.001 AS DECIMAL(18,8)) AS rate
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)
CROSS JOIN (VALUES ('NGN', 0.5), ('PKR', 2.0)) c(currency, base) WHERE day(d) > 1)"""
_SCORED = f"""{_LEDGERS}, {_BRIDGE},
pu AS MATERIALIZED (SELECT p.*, b.user_id AS identity FROM p LEFT JOIN bridge b ON p.operator_code = b.operator_code AND p.account_id = b.account_id AND p.business_date >= b.f AND p.business_date < b.t),
pk AS (SELECT * FROM pu WHERE partner_txn_id IS NULL AND identity IS NOT NULL AND event_id NOT IN (SELECT pe FROM x)),
ik AS (SELECT * FROM i WHERE event_id NOT IN (SELECT ie FROM x)),
s AS MATERIALIZED (SELECT pk.event_id AS p_event_id, ik.event_id AS i_event_id, CAST(0.60 + CASE WHEN {_TOL.format(a="pk.amount", b="ik.amount")} THEN 0.20 ELSE 0 END
  + CASE WHEN pk.plan_code = ik.plan_code THEN 0.10 ELSE 0 END + CASE WHEN pk.business_date = ik.business_date THEN 0.10 ELSE 0 END AS DECIMAL(6,3)) AS confidence,
  abs(CAST(epoch(pk.ts) AS BIGINT) - CAST(epoch(ik.ts) AS BIGINT)) AS gap
  FROM pk JOIN ik ON pk.operator_code = ik.operator_code AND pk.identity = ik.identity AND pk.txn_type = ik.txn_type AND abs(date_diff('day', pk.business_date, ik.business_date)) <= 1)"""
#: The greedy pass: each step marks the pairs that nothing left beats on either side; the next step forgets what they use.
_GREEDY = f"""{_SCORED},
g AS (SELECT p_event_id, i_event_id, confidence, gap, false AS taken FROM s WHERE confidence >= 0.80
UNION ALL SELECT p_event_id, i_event_id, confidence, gap, row_number() OVER (PARTITION BY p_event_id ORDER BY confidence DESC, gap, p_event_id, i_event_id) = 1
    AND row_number() OVER (PARTITION BY i_event_id ORDER BY confidence DESC, gap, p_event_id, i_event_id) = 1
  FROM (SELECT *, bool_or(taken) OVER (PARTITION BY p_event_id) OR bool_or(taken) OVER (PARTITION BY i_event_id) AS used FROM g) WHERE NOT used),
fb AS MATERIALIZED (SELECT * FROM g WHERE taken)"""


def _alone(side: str) -> str:
    """The rows of a side that neither stage has paired, with the best score they ever had."""
    used = {"p": "SELECT pe FROM x UNION ALL SELECT p_event_id FROM fb", "i": "SELECT ie FROM x UNION ALL SELECT i_event_id FROM fb"}[side]
    rows = {"p": "pu", "i": "i"}[side]
    return f"SELECT l.*, t.best FROM {rows} l LEFT JOIN (SELECT {side}_event_id AS e, max(confidence) AS best FROM s GROUP BY 1) t ON l.event_id = t.e WHERE l.event_id NOT IN ({used})"


_MATCHED = f"""{_GREEDY},
two AS (SELECT pe, ie, 1.0::DOUBLE AS match_confidence, 'partner_txn_id' AS match_method FROM x
UNION ALL SELECT p_event_id, i_event_id, CAST(confidence AS DOUBLE), 'fallback_identity' FROM fb),
r0 AS (SELECT pu.operator_code, CASE WHEN match_method = 'partner_txn_id' THEN pu.partner_txn_id END AS partner_txn_id, pu.event_id AS partner_event_id, i.event_id AS platform_event_id,
  pu.identity AS p_user_id, i.identity AS i_user_id, i.sub_id, pu.account_id, pu.txn_type, coalesce(pu.plan_code, i.plan_code) AS plan_code, pu.business_date, i.business_date AS platform_business_date,
  pu.amount AS partner_amount, i.amount AS internal_amount, CASE WHEN match_method = 'partner_txn_id' THEN greatest(pu.arrival, i.business_date) ELSE pu.arrival END AS file_arrival_date,
  match_confidence, match_method, CASE WHEN {_TOL.format(a="pu.amount", b="i.amount")} THEN 'matched' ELSE 'amount_mismatch' END AS c
  FROM two JOIN pu ON pu.event_id = two.pe JOIN i ON i.event_id = two.ie
UNION ALL SELECT operator_code, partner_txn_id, event_id, NULL, identity, NULL, NULL, account_id, txn_type, plan_code, business_date, NULL, amount, NULL, arrival,
  CASE WHEN best < 0.80 THEN CAST(best AS DOUBLE) ELSE 0 END, CASE WHEN best < 0.80 THEN 'fallback_below_floor' ELSE 'unmatched' END, 'missing_on_platform' FROM ({_alone("p")})
UNION ALL SELECT operator_code, partner_txn_id, NULL, event_id, NULL, identity, sub_id, NULL, txn_type, plan_code, business_date, business_date, NULL, amount, business_date,
  CASE WHEN best < 0.80 THEN CAST(best AS DOUBLE) ELSE 0 END, CASE WHEN best < 0.80 THEN 'fallback_below_floor' ELSE 'unmatched' END, 'missing_at_partner' FROM ({_alone("i")}))"""
_FACT = f"""{_MATCHED}, {_CHURN}, {_VERSIONS},
r1 AS (SELECT r0.*, coalesce(r0.txn_type = 'recursion_success' AND r0.business_date > CAST(h.churn_ts AS DATE), false) AS is_orphan_churn,
  CAST(date_diff('day', r0.business_date, file_arrival_date) AS INTEGER) AS lag_days, strftime(r0.business_date, '%Y-%m') AS period_month
  FROM r0 LEFT JOIN churned h ON r0.operator_code = h.operator_code AND r0.i_user_id = h.user_id),
r2 AS (SELECT *, CASE WHEN is_orphan_churn THEN 'orphan_churn' WHEN c = 'matched' AND lag_days >= 2 THEN 'late_arrival' ELSE c END AS break_category, lag_days >= 2 AS is_late,
  period_month IN ('1994-03', '1996-11') AS is_closed_month FROM r1),
r3 AS (SELECT r2.* EXCLUDE (c), CAST(round(pl.price * coalesce(q.rate, CAST(1 AS DECIMAL(18,8))), 4) AS DECIMAL(18,4)) AS expected_amount
  FROM r2 LEFT JOIN plans pl ON r2.plan_code = pl.plan_code AND r2.business_date >= pl.f AND r2.business_date < pl.t LEFT JOIN rates q ON q.currency = pl.currency AND q.rate_date = r2.business_date),
fact AS MATERIALIZED (SELECT *, CASE WHEN is_closed_month THEN business_date END AS original_business_date, CASE WHEN is_closed_month THEN '1998-09' ELSE period_month END AS adj_period,
  CAST(coalesce(partner_amount, 0) - coalesce(internal_amount, 0) AS DECIMAL(18,4)) AS variance, TIMESTAMP '2026-01-01 00:00:00' AS recon_run_ts,
  sha256(coalesce(partner_event_id, '∅') || '||' || coalesce(platform_event_id, '∅') || '||' || CAST(business_date AS VARCHAR)) AS break_id,
  CASE WHEN expected_amount IS NOT NULL THEN {_TOL.format(a="coalesce(partner_amount, internal_amount)", b="expected_amount")} END AS plan_price_ok FROM r3)"""
_DAILY = """daily AS (SELECT business_date, operator_code, count(DISTINCT partner_event_id) AS partner_txn_count, count(DISTINCT platform_event_id) AS internal_txn_count,
  count(*) FILTER (break_category = 'matched') AS matched_count, count(*) FILTER (break_category = 'amount_mismatch') AS amount_mismatch_count,
  count(*) FILTER (break_category = 'missing_on_platform') AS missing_on_platform_count, count(*) FILTER (break_category = 'missing_at_partner') AS missing_at_partner_count,
  count(*) FILTER (break_category = 'orphan_churn') AS orphan_churn_count, count(*) FILTER (break_category = 'late_arrival') AS late_arrival_count,
  count(*) FILTER (break_category <> 'matched') AS break_count, CAST(sum(coalesce(partner_amount, 0)) AS DECIMAL(28,4)) AS partner_amount_total,
  CAST(sum(coalesce(internal_amount, 0)) AS DECIMAL(28,4)) AS internal_amount_total,
  CAST(sum(coalesce(partner_amount, 0)) - sum(coalesce(internal_amount, 0)) AS DECIMAL(28,4)) AS variance, max(recon_run_ts) AS recon_run_ts FROM fact GROUP BY ALL)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


_QUOTES = "quotes AS (SELECT currency, rate_date, max(rate_to_reporting) AS rate FROM fx_raw WHERE rate_to_reporting IS NOT NULL GROUP BY ALL)"
_FILLED = f"""{_QUOTES}, days AS (SELECT CAST(unnest(generate_series(min(rate_date), max(rate_date), INTERVAL 1 DAY)) AS DATE) AS rate_date FROM quotes),
filled AS (SELECT c.currency, d.rate_date, last_value(q.rate IGNORE NULLS) OVER (PARTITION BY c.currency ORDER BY d.rate_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate
  FROM (SELECT DISTINCT currency FROM quotes) c CROSS JOIN days d LEFT JOIN quotes q ON q.currency = c.currency AND q.rate_date = d.rate_date)"""
_PLAN = "v AS (SELECT operator_code, plan_code, effective_from, arg_max(price_original, (ingest_ts, plan_sk, price_original)) AS price_original FROM dim_plan GROUP BY ALL)"
_SCD = f"""{_PLAN}, s AS (SELECT *, coalesce(lead(effective_from) OVER (PARTITION BY operator_code, plan_code ORDER BY effective_from), DATE '9999-12-31') AS effective_to FROM v)"""
_LINE = "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_discount DESC, l_tax DESC) AS rn"
_NUMBER = "TRY_CAST({0} AS DECIMAL(24,6))"

#: ISO texts as a cast reads them: with an offset, with a zone's name, without either.
_ISO_ZONED = r"""CASE WHEN regexp_matches(x, '^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d+)?)?\s*(Z|[+-]\d\d:?\d\d)$') THEN TRY_CAST(regexp_replace(x, '\s*([+-]\d\d):?(\d\d)$', '\1:\2') AS TIMESTAMPTZ) AT TIME ZONE 'UTC' END AS by_offset"""
_ISO_NAMED = r"""CASE WHEN regexp_matches(x, '^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)? UTC$') THEN TRY_CAST(replace(x, ' UTC', '') AS TIMESTAMP) END AS named"""
_ISO_PLAIN = r"""CASE WHEN regexp_matches(x, '^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d+)?)?$') THEN TRY_CAST(x AS TIMESTAMP) END AS plain"""

ORACLES = {
    "exact_match": _with(_LEDGERS, "SELECT pe AS p_event_id, ie AS i_event_id, arrival FROM x"),
    "tolerance_category": _with(_LEDGERS, f"SELECT operator_code, CASE WHEN {_TOL.format(a='pa', b='ia')} THEN 'matched' ELSE 'amount_mismatch' END AS break_category, count(*) AS n FROM x GROUP BY ALL"),
    "residual_partner": _with(_LEDGERS, "SELECT event_id, operator_code, amount FROM p WHERE event_id NOT IN (SELECT pe FROM x)"),
    "residual_platform": _with(_LEDGERS, "SELECT event_id, operator_code, amount FROM i WHERE event_id NOT IN (SELECT ie FROM x)"),
    "multi_match": _with(_LEDGERS, """SELECT p.event_id, count(*) AS pairs FROM p JOIN i ON p.operator_code = i.operator_code AND CAST(p.event_id AS BIGINT) // 2 = CAST(i.event_id AS BIGINT) // 2 GROUP BY 1 HAVING count(*) > 1"""),
    "asof_identity": _with(f"{_LEDGERS}, {_BRIDGE}", "SELECT p.event_id, p.account_id, b.user_id AS identity FROM p LEFT JOIN bridge b ON p.operator_code = b.operator_code AND p.account_id = b.account_id AND p.business_date >= b.f AND p.business_date < b.t"),
    "fallback_scored": _with(_SCORED, "SELECT p_event_id, i_event_id, CAST(confidence AS DOUBLE) AS confidence, gap FROM s"),
    "below_floor": _with(_SCORED, 'SELECT p_event_id, CAST(max(confidence) AS DOUBLE) AS "top" FROM s GROUP BY 1 HAVING max(confidence) < 0.80'),
    "orphan_overlay": _with(_FACT, "SELECT partner_event_id, platform_event_id, break_category FROM fact WHERE is_orphan_churn"),
    "late_overlay": _with(_FACT, "SELECT break_category, is_late, CAST(lag_days AS INTEGER) AS lag_days, count(*) AS n FROM fact GROUP BY ALL"),
    "closed_routing": _with(_FACT, "SELECT period_month, adj_period, is_closed_month, count(*) AS n, count(original_business_date) AS stamped FROM fact GROUP BY ALL"),
    "plan_price_check": _with(_FACT, "SELECT partner_event_id, platform_event_id, expected_amount, plan_price_ok FROM fact"),
    "closed_offending": _with(_FACT, "SELECT DISTINCT period_month FROM fact WHERE is_closed_month"),
    "churn_min": _with(_CHURN, "SELECT * FROM churned"),
    "break_ids": _with(_FACT, "SELECT break_id, variance FROM fact"),
    "bridge_learning": _with(_LEDGERS, """SELECT p.operator_code, p.account_id, i.identity AS user_id, i.identity AS sub_id, min(p.business_date) AS effective_from
      FROM (SELECT DISTINCT operator_code, partner_txn_id, identity FROM i) i JOIN p ON p.operator_code = i.operator_code AND p.partner_txn_id = i.partner_txn_id GROUP BY ALL"""),
    "fallback_assigned": _with(_GREEDY, "SELECT p_event_id, i_event_id, CAST(confidence AS DOUBLE) AS confidence FROM fb"),
    "match_ledgers": _with(_MATCHED, "SELECT partner_event_id, platform_event_id, c AS break_category, match_method, match_confidence, operator_code, txn_type FROM r0"),
    "match_summary": _with(_MATCHED, "SELECT operator_code, c AS break_category, match_method, count(*) AS n FROM r0 GROUP BY ALL"),
    "reconcile": _with(_FACT, "SELECT * FROM fact"),
    "reconcile_day": _with(_FACT, "SELECT * FROM fact WHERE business_date = DATE '1995-03-15'"),
    "adjustments": _with(_FACT, """SELECT break_id, business_date, adj_period, break_category FROM fact WHERE is_closed_month
      AND (CAST(coalesce(partner_event_id, platform_event_id) AS BIGINT) % 3 = 2 OR CAST(coalesce(partner_event_id, platform_event_id) AS BIGINT) % 6 = 3)"""),
    "daily_mart": _with(f"{_FACT}, {_DAILY}", "SELECT * FROM daily"),
    "health_report": _with(f"{_FACT}, {_DAILY}", """SELECT operator_code, business_date, partner_txn_count, internal_txn_count, matched_count, break_count, amount_mismatch_count,
      missing_on_platform_count, missing_at_partner_count, orphan_churn_count, late_arrival_count, recon_run_ts, round(partner_amount_total, 2) AS partner_total,
      round(internal_amount_total, 2) AS internal_total, round(variance, 2) AS variance, round(matched_count::DOUBLE / nullif(matched_count + break_count, 0), 4) AS match_rate
      FROM daily WHERE business_date = DATE '1995-03-15'"""),
    "drilldown_topk": _with(_FACT, """SELECT operator_code, break_category, txn_type, partner_txn_id, sub_id, account_id, partner_event_id, platform_event_id, round(partner_amount, 2) AS partner_amount,
      round(internal_amount, 2) AS internal_amount, round(variance, 2) AS variance, match_method, match_confidence, is_late, lag_days
      FROM (SELECT *, row_number() OVER (ORDER BY break_category, abs(variance) DESC, partner_event_id, platform_event_id) AS place FROM fact
        WHERE business_date = DATE '1995-03-15' AND break_category IN ('amount_mismatch', 'missing_on_platform', 'missing_at_partner', 'orphan_churn', 'late_arrival')) WHERE place <= 500"""),
    "review_queue": _with(_FACT, """SELECT operator_code, partner_txn_id, sub_id, account_id, partner_event_id, platform_event_id, txn_type, break_category, partner_amount, internal_amount,
      match_method, match_confidence FROM fact WHERE starts_with(match_method, 'fallback') AND match_confidence < 0.9"""),
    "price_exceptions": _with(_FACT, """SELECT operator_code, partner_txn_id, sub_id, partner_event_id, platform_event_id, plan_code, partner_amount, internal_amount, expected_amount, break_category
      FROM fact WHERE expected_amount IS NOT NULL AND NOT (abs(coalesce(partner_amount, internal_amount) - expected_amount) <= greatest(0.01, 0.005 * abs(coalesce(partner_amount, internal_amount))))"""),
    "monthly_close": _with(_FACT, """SELECT operator_code, CAST(sum(CASE txn_type WHEN 'refund' THEN 0 ELSE cash END) AS DECIMAL(28,2)) AS gross_revenue,
      CAST(sum(CASE txn_type WHEN 'refund' THEN cash ELSE 0 END) AS DECIMAL(28,2)) AS refunds, CAST(sum(CASE txn_type WHEN 'refund' THEN -cash ELSE cash END) AS DECIMAL(28,2)) AS net_revenue,
      CAST(coalesce(sum(abs(variance)) FILTER (break_category <> 'matched'), 0) AS DECIMAL(28,2)) AS variance_under_review, count(*) FILTER (break_category = 'missing_on_platform') AS missing_on_platform_cnt,
      count(*) FILTER (break_category = 'missing_at_partner') AS leakage_cnt, count(*) FILTER (break_category = 'orphan_churn') AS orphan_churn_cnt
      FROM (SELECT *, CASE WHEN break_category = 'missing_at_partner' THEN 0 ELSE coalesce(partner_amount, 0) END AS cash FROM fact
        WHERE (period_month = '1998-09' AND NOT is_closed_month) OR period_month IN ('1994-03', '1996-11')) GROUP BY 1"""),
    "audit_trail": _with(_FACT, """SELECT f.break_id, f.business_date, f.break_category, f.txn_type, f.partner_amount, f.internal_amount, f.variance, f.match_method, f.match_confidence, f.is_late, f.lag_days,
      f.original_business_date, f.adj_period, p.partner_txn_id AS partner_txn_id, 'p-' || p.arrival AS partner_source_file, sha256(p.event_id || '||' || p.amount) AS partner_record_hash, p.ts AS partner_ts,
      i.partner_txn_id AS platform_txn_id, i.sub_id AS platform_sub_id, 'i-' || i.business_date AS platform_source_file, sha256(i.event_id || '||' || i.txn_type) AS platform_record_hash, i.ts AS platform_ts
      FROM fact f LEFT JOIN p ON f.partner_event_id = p.event_id LEFT JOIN i ON f.platform_event_id = i.event_id WHERE f.operator_code = 'BUILDING' AND '1996-11' IN (f.period_month, f.adj_period)"""),
    "tie_out": _with(f"{_FACT}, {_DAILY}", "SELECT business_date, operator_code, partner_amount_total AS fact_partner_total FROM daily WHERE operator_code = 'BUILDING'"),
    "category_histogram": _with(_FACT, "SELECT break_category, count(*) AS n FROM fact GROUP BY ALL"),
    "fx_ffill": _with(_FILLED, "SELECT * FROM filled"),
    "fx_convert": _with(_FILLED, """SELECT event_id, CAST(round(CAST(amount_original AS DECIMAL(19,4)) * CASE WHEN upper(trim(currency_original)) = 'USD' THEN CAST(1 AS DECIMAL(18,8)) ELSE f.rate END, 4) AS DECIMAL(18,4)) AS amount_reporting,
      upper(trim(currency_original)) IS DISTINCT FROM 'USD' AND f.rate IS NULL AS fx_missing FROM partner_txn p LEFT JOIN filled f ON upper(trim(p.currency_original)) = f.currency AND p.business_date = f.rate_date"""),
    "scd2_versions": _with(_SCD, "SELECT *, effective_to = DATE '9999-12-31' AS is_current FROM s"),
    "scd2_merge": _with(f"""{_PLAN}, c AS (SELECT *, lag(price_original) OVER (PARTITION BY operator_code, plan_code ORDER BY effective_from) AS b FROM v),
      d AS (SELECT operator_code, plan_code, effective_from, price_original FROM c WHERE price_original IS DISTINCT FROM b),
      e AS (SELECT *, coalesce(lead(effective_from) OVER (PARTITION BY operator_code, plan_code ORDER BY effective_from), DATE '9999-12-31') AS effective_to FROM d)""", "SELECT *, effective_to = DATE '9999-12-31' AS is_current FROM e"),
    "scd2_asof": _with(_SCD, "SELECT p.event_id, s.price_original FROM partner_txn p LEFT JOIN s ON p.operator_code = s.operator_code AND p.plan_code = s.plan_code AND p.business_date >= s.effective_from AND p.business_date < s.effective_to"),
    "merge_latest": _with(f"""a AS (SELECT * FROM (SELECT *, {_LINE} FROM lineitem WHERE l_shipdate < '1995-06-17') WHERE rn = 1),
      b AS (SELECT * FROM (SELECT *, {_LINE} FROM lineitem WHERE l_shipdate >= '1995-06-17') WHERE rn = 1),
      c AS (SELECT b.* FROM b LEFT JOIN a USING (l_orderkey, l_linenumber) WHERE a.l_extendedprice IS DISTINCT FROM b.l_extendedprice),
      u AS (SELECT * FROM c UNION ALL SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.l_orderkey = a.l_orderkey AND c.l_linenumber = a.l_linenumber))""",
      "SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) AS shipped FROM u"),
    "cdc_dedupe": """SELECT l_orderkey, l_linenumber, arg_max(l_extendedprice, v) AS l_extendedprice, arg_max(l_partkey, v) AS l_partkey, arg_max(l_returnflag, v) = 'R' AS is_deleted
      FROM (SELECT *, epoch_us(CAST(l_shipdate AS TIMESTAMP)) + l_partkey * 10000 + l_suppkey AS v FROM lineitem) GROUP BY 1, 2""",
    "union_drift": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier",
    "calendar_cross": _with(_FILLED, "SELECT currency, count(*) AS days, count(rate) AS known FROM filled GROUP BY ALL"),
    "type_map": """SELECT CASE lower(trim(event_type)) WHEN 'renew_ok' THEN 'recursion_success' WHEN 'init_ok' THEN 'subscription_success' WHEN 'refund' THEN 'refund' END AS txn_type,
      count(*) AS n, txn_type IS NULL AS dq_unmapped_type FROM operator_feed GROUP BY txn_type""",
    "amount_parse": f"""SELECT source_file, source_row, operator_code, CAST(CASE WHEN r.decimal_comma THEN {_NUMBER.format("replace(replace(trim(amount), '.', ''), ',', '.')")}
      ELSE {_NUMBER.format("replace(trim(amount), ',', '')")} END AS DECIMAL(18,4)) AS amount FROM operator_feed LEFT JOIN operator_registry r USING (operator_code)""",
    "feed_instants": rf"""WITH t AS (SELECT source_file, source_row, operator_code, event_time AS x, r.timezone AS zone, r.ts_format AS form, regexp_matches(event_time, '\d\d:\d\d(:\d\d(\.\d+)?)?\s*(Z|[+-]\d\d:?\d\d)$') AS zoned,
        {_ISO_ZONED}, {_ISO_NAMED}, {_ISO_PLAIN}
      FROM operator_feed LEFT JOIN operator_registry r USING (operator_code)),
      u AS (SELECT *, CASE WHEN zoned THEN by_offset WHEN form = 'iso8601' THEN coalesce(named, timezone('UTC', timezone(zone, plain)))
        ELSE timezone('UTC', timezone(zone, CASE form WHEN 'yyyy-MM-dd''T''HH:mm:ss' THEN CASE WHEN regexp_matches(x, '^\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\d$') THEN plain END
          WHEN 'yyyy-MM-dd HH:mm:ss' THEN CASE WHEN regexp_matches(x, '^\d{{4}}-\d\d-\d\d \d\d:\d\d:\d\d$') THEN plain END
          WHEN 'dd/MM/yyyy HH:mm:ss' THEN try_strptime(x, '%d/%m/%Y %H:%M:%S') WHEN 'MM/dd/yyyy hh:mm:ss a' THEN try_strptime(x, '%m/%d/%Y %I:%M:%S %p') END)) END AS moment FROM t)
      SELECT source_file, source_row, operator_code, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "at", CAST(moment AS DATE) AS business_date FROM u""",
    "ts_parse": rf"""WITH t AS (SELECT source_file, source_row, {_ISO_ZONED}, {_ISO_PLAIN} FROM (SELECT *, event_time AS x FROM operator_feed WHERE operator_code = 'telco_a')),
      u AS (SELECT *, coalesce(by_offset, timezone('UTC', timezone('Africa/Lagos', plain))) AS moment FROM t)
      SELECT source_file, source_row, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "at", CAST(moment AS DATE) AS business_date FROM u""",
    "epoch_parse": """SELECT source_file, source_row, CASE WHEN abs(t.ts_epoch_ms::HUGEINT) <= 9223372036854775 THEN CASE WHEN year(make_timestamp(t.ts_epoch_ms * 1000)) > 9999 THEN '+' ELSE '' END || strftime(make_timestamp(t.ts_epoch_ms * 1000), '%Y-%m-%d %H:%M:%S') END AS "at",
      CAST(CAST(t.value_minor AS DECIMAL(24,6)) * 0.01 AS DECIMAL(18,4)) AS amount FROM (SELECT source_file, source_row, "transaction" AS t FROM telco_b_feed)""",
    "nested_path": """SELECT source_file, source_row, t.id AS txn_id, s.msisdn AS account, NULL::VARCHAR AS gone FROM (SELECT source_file, source_row, "transaction" AS t, subscriber AS s FROM telco_b_feed)""",
    "json_path": "SELECT event_type, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total, count(json_extract_string(props, '$.k')) AS n FROM events GROUP BY 1",
    "record_hash": "SELECT c_custkey, sha256(c_custkey || '||' || c_name || '||∅||' || c_mktsegment) AS record_hash FROM customer",
    "refund_flip": """WITH a AS (SELECT operator_code, product_code, CASE lower(trim(event_type)) WHEN 'billing_success' THEN 'recursion_success' WHEN 'first_billing' THEN 'subscription_success' WHEN 'billing_failure' THEN 'recursion_failure'
        WHEN 'refund' THEN 'refund' WHEN 'cancel' THEN 'cancel' END AS kind, CAST(TRY_CAST(replace(trim(amount), ',', '') AS DECIMAL(24,6)) AS DECIMAL(18,4)) AS v FROM operator_feed),
      b AS (SELECT operator_code, product_code, CASE WHEN kind = 'recursion_success' AND v < 0 THEN 'refund' ELSE kind END AS txn_type, CASE WHEN kind = 'recursion_success' AND v < 0 THEN abs(v) ELSE v END AS v FROM a)
      SELECT operator_code, txn_type, txn_type IS NULL AS dq_unmapped_type, count(*) AS n, CAST(sum(v) AS DECIMAL(28,4)) AS total, count(product_code) AS plans FROM b GROUP BY 1, 2""",
    "minor_units": """SELECT t.kind AS kind, CAST(sum(CAST(t.value_minor * 0.01 AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS total, max(CAST(t.value_minor * 0.01 AS DECIMAL(18,4))) AS most
      FROM (SELECT "transaction" AS t FROM telco_b_feed) GROUP BY 1""",
}
