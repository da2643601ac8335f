"""DuckDB statements equal to the pN_ queries that SQL can express."""

from ledgerloom.functions.keys import ABSENT

_ABSENT = ", ".join(f"'{a}'" for a in ABSENT)
_BARE = "regexp_replace(upper(partner_txn_id), '[^A-Z0-9]', '', 'g')"
_ID = f"CASE WHEN {_BARE} NOT IN ({_ABSENT}) THEN {_BARE} END"
_NAMED = r"replace(regexp_extract(source_file, '(\d{4}-?\d{2}-?\d{2})', 1), '-', '')"
_ARRIVAL = f"coalesce(file_arrival_date, CAST(try_strptime({_NAMED}, '%Y%m%d') AS DATE))"
_BOOKED = "coalesce(business_date, CAST(txn_ts_utc AT TIME ZONE 'UTC' AS DATE))"
_DIGITS = "nullif(regexp_replace(account_id, '[^0-9]', '', 'g'), '')"

_RANKED = f"""SELECT event_id, operator_code, {_ID} AS id, {_ARRIVAL} AS arrival, {_BOOKED} AS booked, amount_reporting, txn_type,
  row_number() OVER (PARTITION BY operator_code, {_ID} ORDER BY {_ARRIVAL} NULLS LAST, event_id) AS rn FROM partner_txn"""
_KEPT = f"SELECT *, date_diff('day', booked, arrival) AS lag FROM ({_RANKED}) WHERE rn = 1 OR id IS NULL OR operator_code IS NULL"

_P1 = f"""
WITH a AS (SELECT * FROM ({_RANKED}) WHERE rn = 1 AND id IS NOT NULL),
b AS (SELECT * FROM (SELECT operator_code, {_ID} AS id, business_date AS booked, amount_reporting, txn_type,
  row_number() OVER (PARTITION BY operator_code, {_ID} ORDER BY {_ARRIVAL} NULLS LAST, event_id) AS rn FROM platform_txn) WHERE rn = 1 AND id IS NOT NULL),
j AS (SELECT coalesce(a.operator_code, b.operator_code) AS operator_code, coalesce(a.id, b.id) AS partner_txn_id,
  a.id IS NULL AS no_a, b.id IS NULL AS no_b, a.id IS NOT NULL AND b.id IS NOT NULL AS two,
  a.amount_reporting IS DISTINCT FROM b.amount_reporting AS x, a.txn_type IS DISTINCT FROM b.txn_type AS y, a.booked IS DISTINCT FROM b.booked AS z
  FROM a FULL JOIN b ON a.operator_code = b.operator_code AND a.id = b.id)
SELECT operator_code, partner_txn_id, 'missing_at_partner' AS difference FROM j WHERE no_a
UNION ALL SELECT operator_code, partner_txn_id, 'missing_on_platform' FROM j WHERE no_b
UNION ALL SELECT operator_code, partner_txn_id, 'amount_reporting' FROM j WHERE two AND x
UNION ALL SELECT operator_code, partner_txn_id, 'txn_type' FROM j WHERE two AND y
UNION ALL SELECT operator_code, partner_txn_id, 'business_date' FROM j WHERE two AND z"""

_P3_FOUND = f"SELECT event_id, CASE WHEN lag > 7 THEN 'too_late' ELSE 'late' END AS lateness FROM ({_KEPT}) WHERE lag >= 2"

_P3_CORRECTED = f"""
SELECT operator_code, booked AS business_date, CAST(count(*) AS BIGINT) AS rows_count, CAST(sum(amount_reporting) AS DECIMAL(38,4)) AS total
FROM ({_KEPT}) WHERE lag <= 7 GROUP BY ALL"""

_P3_CHANGELOG = f"""
WITH v AS (SELECT operator_code, booked AS business_date, arrival AS version,
    CASE WHEN lag > 7 THEN 'too_late' WHEN lag >= 2 THEN 'late' ELSE 'on_time' END AS lateness, count(*) AS n, sum(amount_reporting) AS t
  FROM ({_KEPT}) WHERE lag IS NOT NULL GROUP BY ALL),
s AS (SELECT *, sum(n) OVER w AS new_n, sum(t) OVER w AS new_t FROM v WHERE lateness != 'too_late'
  WINDOW w AS (PARTITION BY operator_code, business_date ORDER BY version)),
l AS (SELECT *, lag(new_n) OVER w AS old_n, lag(new_t) OVER w AS old_t FROM s WINDOW w AS (PARTITION BY operator_code, business_date ORDER BY version)),
u AS (SELECT operator_code, business_date, version, lateness, CASE WHEN old_n IS NULL THEN 'first' ELSE 'correction' END AS kind, 1 AS sign, new_n AS rows_count, new_t AS total FROM l
UNION ALL SELECT operator_code, business_date, version, lateness, 'correction', -1, old_n, old_t FROM l WHERE old_n IS NOT NULL
UNION ALL SELECT operator_code, business_date, version, lateness, 'rejected', 0, n, t FROM v WHERE lateness = 'too_late')
SELECT operator_code, business_date, version, lateness, kind, CAST(sign AS INTEGER) AS sign, CAST(rows_count AS BIGINT) AS rows_count, CAST(total AS DECIMAL(38,4)) AS total FROM u"""

_P7 = f"""
WITH e AS (SELECT f.break_id, f.plan_sk, f.p_user_id, p.operator_code, p.plan_code, {_DIGITS.replace("account_id", "p.account_id")} AS account,
  coalesce(p.business_date, CAST(p.txn_ts_utc AT TIME ZONE 'UTC' AS DATE)) AS day FROM fact_reconciliation_break f JOIN partner_txn p ON f.partner_event_id = p.event_id),
v AS (SELECT e.break_id, arg_max(d.plan_sk, (d.effective_from, d.ingest_ts)) AS sk FROM e JOIN dim_plan d ON d.operator_code = e.operator_code AND d.plan_code = e.plan_code
  AND d.effective_from <= e.day AND CAST(d.ingest_ts AT TIME ZONE 'UTC' AS DATE) <= e.day GROUP BY 1),
b AS (SELECT operator_code, {_DIGITS} AS account, user_id, effective_from, effective_to FROM account_user_bridge_seed),
u AS (SELECT e.break_id, arg_max(b.user_id, b.effective_from) AS uid FROM e JOIN b ON b.operator_code = e.operator_code AND b.account = e.account
  AND b.effective_from <= e.day AND (b.effective_to IS NULL OR b.effective_to > e.day) GROUP BY 1)
SELECT e.break_id, 'plan_sk' AS field FROM e LEFT JOIN v USING (break_id) WHERE e.plan_sk IS DISTINCT FROM v.sk
UNION ALL SELECT e.break_id, 'p_user_id' FROM e LEFT JOIN u USING (break_id) WHERE e.p_user_id IS DISTINCT FROM u.uid"""


#: Written out by themselves, not taken from the graph that they check: digits of the minor unit, and names with their scale.
_UNITS = """money(code, digits) AS (VALUES ('ngn', 2), ('pkr', 2), ('try', 2), ('bdt', 2), ('eur', 2), ('lkr', 2), ('usd', 2), ('cad', 2), ('kwd', 3), ('jpy', 0), ('inr', 2)),
named(unit, code, scale) AS (VALUES ('naira', 'ngn', 1.0::DOUBLE), ('₦', 'ngn', 1), ('kobo', 'ngn', 0.01), ('rupees', 'pkr', 1), ('rupee', 'pkr', 1), ('whole rupees', 'pkr', 1), ('rupees (pk)', 'pkr', 1),
  ('rs', 'pkr', 1), ('rs pkr', 'pkr', 1), ('rs (whole)', 'pkr', 1), ('paisa', 'pkr', 0.01), ('paise', 'pkr', 0.01), ('lira', 'try', 1), ('₺', 'try', 1), ('kurus', 'try', 0.01), ('kuruş', 'try', 0.01),
  ('taka', 'bdt', 1), ('৳', 'bdt', 1), ('poisha', 'bdt', 0.01), ('euro', 'eur', 1), ('€', 'eur', 1), ('eurocent', 'eur', 0.01), ('euro cents', 'eur', 0.01), ('rupees (lk)', 'lkr', 1), ('rs lkr', 'lkr', 1),
  ('lkr cents', 'lkr', 0.01), ('us$', 'usd', 1), ('$', 'usd', 1), ('us dollar', 'usd', 1), ('us dollars', 'usd', 1), ('us cents', 'usd', 0.01), ('c$', 'cad', 1), ('ca$', 'cad', 1), ('dollars ca', 'cad', 1),
  ('cad cents', 'cad', 0.01), ('kd', 'kwd', 1), ('dinar kw', 'kwd', 1), ('fils', 'kwd', 0.001), ('yen', 'jpy', 1), ('¥', 'jpy', 1), ('rupees (in)', 'inr', 1), ('rs inr', 'inr', 1), ('₹', 'inr', 1), ('inr paise', 'inr', 0.01)),
spelt AS (SELECT unit, code, scale FROM named UNION ALL SELECT code || tail, code, CASE kind WHEN 'main' THEN 1.0 WHEN 'minor' THEN pow(10, -digits) ELSE 1000.0 END
  FROM money, (VALUES ('', 'main'), (' major', 'main'), (' minor', 'minor'), (' minor unit', 'minor'), (' minor units', 'minor'), (' thousand', 'k'), (' x1000', 'k')) f(tail, kind)
  UNION ALL SELECT 'k' || code, code, 1000.0 FROM money UNION ALL SELECT code || '/' || CAST(pow(10, digits) AS BIGINT), code, pow(10, -digits) FROM money WHERE digits > 0),
units AS (SELECT unit, upper(code) AS currency, scale, unit = code AS plain FROM spelt), minors AS (SELECT upper(code) AS currency, pow(10, -digits) AS scale FROM money)"""


def _text(column: str) -> str:
    return rf"trim(regexp_replace(lower({column}), '\s+', ' ', 'g'))"


def _main(source: str, unit: str, remark: str, own: str, number: str, default: str, keep: str) -> str:
    """Amounts of ``source`` in main units, by unit text and remark."""
    named = rf"coalesce(nullif(regexp_extract({_text(remark)}, '^(?:amount |value )?(?:is )?(?:in |unit: ?)(.+)$', 1), ''), nullif({_text(remark)}, ''))"
    return f"""(WITH a AS (SELECT s.*, u.currency AS uc, u.scale AS us, u.plain AS up, coalesce(u.currency, {own}) AS cur, {named} AS named FROM {source} s LEFT JOIN units u ON {_text(unit)} = u.unit),
      b AS (SELECT a.*, r.currency AS rc, r.scale AS rs, r.plain AS rp FROM a LEFT JOIN units r ON r.unit = CASE WHEN regexp_matches(named, '^minor( units?)?$') THEN lower(cur) || ' minor' ELSE named END)
      SELECT {keep}, {number} * coalesce(CASE WHEN NOT rp THEN rs END, CASE WHEN NOT up THEN us END, {default}) AS main, coalesce(rc, cur) AS main_currency FROM b LEFT JOIN minors m ON m.currency = b.cur)"""


_QUOTES = r"""q0 AS (SELECT upper(trim(currency)) AS currency, rate_date, CAST(rate_to_reporting AS DOUBLE) AS quote, lower(trim(quote_basis)) AS t FROM fx_raw WHERE rate_to_reporting > 0),
readings AS (SELECT * FROM (VALUES ('direct/1', 1.0::DOUBLE, 1.0::DOUBLE, 0), ('direct/100', 1, 100, 1), ('direct/1000', 1, 1000, 1), ('inverse/1', -1, 1, 1), ('inverse/100', -1, 100, 1), ('inverse/1000', -1, 1000, 1)) r(basis, sign, scale, rank)),
q1 AS (SELECT *, CASE WHEN t <> '' THEN CASE WHEN currency = 'USD' THEN 'direct' WHEN contains(t, '=') THEN CASE WHEN regexp_matches(t, '^1 usd') THEN 'inverse' ELSE 'direct' END
    WHEN t = lower(currency) || ' per usd' THEN 'inverse' ELSE 'direct' END || CASE WHEN regexp_matches(t, 'mille|1000') THEN '/1000' WHEN regexp_matches(t, 'hundred|\b100\b') THEN '/100' ELSE '/1' END END AS stated FROM q0),
typical AS (SELECT q1.currency, quantile_cont(coalesce(pow(quote, r.sign) / r.scale, quote), 0.5) AS typical FROM q1 LEFT JOIN readings r ON r.basis = q1.stated GROUP BY 1),
guesses AS (SELECT q.currency, q.quote, first(r.basis ORDER BY abs(ln(pow(q.quote, r.sign) / r.scale / t.typical)), r.rank, r.basis) AS guess FROM (SELECT DISTINCT currency, quote FROM q1) q JOIN typical t USING (currency) CROSS JOIN readings r GROUP BY ALL),
q2 AS (SELECT q1.currency, rate_date, q1.quote, coalesce(stated, CASE WHEN q1.currency = 'USD' THEN 'direct/1' ELSE guess END) AS basis FROM q1 JOIN guesses g ON g.currency = q1.currency AND g.quote = q1.quote),
quotes AS (SELECT q2.currency, rate_date, quote, q2.basis, pow(quote, r.sign) / r.scale AS rate FROM q2 JOIN readings r USING (basis)),
daily AS (SELECT currency, rate_date, quantile_cont(rate, 0.5) AS rate FROM quotes GROUP BY ALL)"""

_RAW = r"regexp_replace(regexp_extract(amount, '(-?\s*\d[\d.,''\s]*)', 1), '[\s'']|[.,]+$', '', 'g')"
_FED = rf"""fed AS (SELECT f.*, g.currency AS own, {_RAW} AS n, coalesce(g.decimal_comma, false) AS dc, regexp_matches(lower(amount), '\d[\d.,''\s]*k($|[^a-z])') AS k FROM operator_feed f LEFT JOIN operator_registry g USING (operator_code)),
fed2 AS (SELECT *, TRY_CAST(CASE WHEN regexp_matches(n, '\..*,[^.]*$') OR (regexp_matches(n, '^[^.,]*,[^.,]*$') AND (dc OR NOT regexp_matches(n, ',\d{{3}}$'))) THEN replace(replace(n, '.', ''), ',', '.')
    WHEN regexp_matches(n, ',.*\.[^,]*$') OR (regexp_matches(n, '^[^.,]*\.[^.,]*$') AND (NOT dc OR NOT regexp_matches(n, '\.\d{{3}}$'))) THEN replace(n, ',', '') ELSE replace(replace(n, '.', ''), ',', '') END AS DOUBLE) * CASE WHEN k THEN 1000 ELSE 1 END AS number FROM fed),
tb AS (SELECT source_file, source_row, "transaction".value_minor AS number, "transaction".currency AS ccy, remark, (SELECT any_value(currency) FROM operator_registry WHERE operator_code = 'telco_b') AS own FROM telco_b_feed),
own AS (SELECT p.*, g.currency AS own, CAST(NULL AS VARCHAR) AS none FROM partner_txn p LEFT JOIN operator_registry g USING (operator_code) WHERE amount_original IS NOT NULL)"""
_P4 = f"""
WITH {_UNITS}, {_QUOTES}, {_FED},
ours AS {_main("own", "currency_original", "none", "own", "CAST(amount_original AS DOUBLE)", "1.0", "event_id, source_file, source_row, CAST(amount_reporting AS DOUBLE) AS reporting, least(coalesce(business_date, CAST(txn_ts_utc AT TIME ZONE 'UTC' AS DATE)), (SELECT max(rate_date) FROM daily)) AS day")},
raw AS (SELECT * FROM {_main("fed2", "ccy", "remark", "own", "number", "1.0", "source_file, source_row")} UNION ALL
  SELECT * FROM {_main("tb", "ccy", "remark", "own", "number", "coalesce(m.scale, 0.01)", "source_file, source_row")})
SELECT DISTINCT 'rate' AS record_kind, currency || ':' || strftime(rate_date, '%Y%m%d') AS record_key FROM quotes WHERE basis <> 'direct/1'
UNION ALL SELECT 'reporting', o.event_id FROM ours o ASOF JOIN daily d ON d.currency = o.main_currency AND o.day >= d.rate_date WHERE abs(o.reporting - o.main * d.rate) > abs(o.main * d.rate) * 0.1 + 1e-9
UNION ALL SELECT DISTINCT 'original', o.event_id FROM ours o JOIN raw r ON o.source_file = r.source_file AND o.source_row = r.source_row WHERE abs(abs(o.main) - abs(r.main)) > abs(r.main) * 0.1 + 1e-9"""

_ISO = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*(.*)$"
_OFFSET = r"^([+-])(\d{2}):?(\d{2})?$"
_P5_TEXTS = rf"""
WITH texts AS (SELECT source_file, source_row, operator_code, event_time AS raw, trim(event_time) AS t FROM operator_feed
  UNION ALL SELECT source_file, source_row, 'telco_b', CAST("transaction".ts_epoch_ms AS VARCHAR), CAST("transaction".ts_epoch_ms AS VARCHAR) FROM telco_b_feed),
z AS (SELECT x.*, coalesce(g.timezone, 'UTC') AS zone, coalesce(g.ts_format LIKE 'M%', false) AS month_first, regexp_extract(t, '{_ISO}', 3) AS rest,
  regexp_matches(t, '{_ISO}') AS iso FROM texts x LEFT JOIN operator_registry g USING (operator_code)),
l AS (SELECT *, CASE WHEN iso THEN TRY_CAST(regexp_extract(t, '{_ISO}', 1) || ' ' || regexp_extract(t, '{_ISO}', 2) || CASE WHEN length(regexp_extract(t, '{_ISO}', 2)) = 5 THEN ':00' ELSE '' END AS TIMESTAMP)
    WHEN regexp_matches(t, '^\d{{14}}$') THEN try_strptime(t, '%Y%m%d%H%M%S')
    ELSE coalesce(try_strptime(t, '%d %b %Y %H:%M:%S'), try_strptime(t, '%b %d, %Y %I:%M %p'), try_strptime(regexp_extract(t, '^[A-Z][a-z]+, (.*) GMT$', 1), '%d %b %Y %H:%M:%S'),
      CASE WHEN month_first THEN coalesce(try_strptime(t, '%m/%d/%Y %I:%M:%S %p'), try_strptime(t, '%m/%d/%Y %H:%M:%S')) ELSE try_strptime(t, '%d/%m/%Y %H:%M:%S') END) END AS local,
  CASE WHEN iso AND rest IN ('Z', 'UTC', 'GMT') OR t LIKE '% GMT' THEN 0 WHEN iso AND regexp_matches(rest, '{_OFFSET}') THEN
      (CASE WHEN rest LIKE '-%' THEN -1 ELSE 1 END) * (CAST(regexp_extract(rest, '{_OFFSET}', 2) AS INTEGER) * 60 + coalesce(TRY_CAST(regexp_extract(rest, '{_OFFSET}', 3) AS INTEGER), 0))
    WHEN iso THEN CASE rest WHEN 'WAT' THEN 60 WHEN 'CET' THEN 60 WHEN 'CEST' THEN 120 WHEN 'TRT' THEN 180 WHEN 'PKT' THEN 300 WHEN 'EST' THEN -300 WHEN 'EDT' THEN -240 END END AS shift,
  coalesce(nullif(regexp_extract(rest, '^\[([A-Za-z_/]+)\]$', 1), ''), zone) AS at_zone FROM z),
i AS (SELECT source_file, source_row, raw, CASE WHEN regexp_matches(t, '^\d{{10}}$') THEN make_timestamp(CAST(t AS BIGINT) * 1000000) WHEN regexp_matches(t, '^\d{{13}}$') THEN make_timestamp(CAST(t AS BIGINT) * 1000)
    WHEN regexp_matches(t, '^\d{{16}}$') THEN make_timestamp(CAST(t AS BIGINT)) WHEN shift IS NOT NULL THEN local - to_minutes(shift)
    WHEN iso AND rest <> '' AND rest NOT LIKE '[%' THEN NULL
    WHEN timezone(at_zone, timezone(at_zone, local) - INTERVAL 1 HOUR) = local THEN timezone('UTC', timezone(at_zone, local) - INTERVAL 1 HOUR) ELSE timezone('UTC', timezone(at_zone, local)) END AS instant FROM l)"""
_P5_FOUND = rf"""{_P5_TEXTS}
SELECT DISTINCT p.event_id FROM partner_txn p JOIN i USING (source_file, source_row)
WHERE abs(epoch_us(timezone('UTC', p.txn_ts_utc)) - epoch_us(i.instant)) > 60000000"""

ORACLES = {
    "p5_found": _P5_FOUND,
    "p5_instants": f"{_P5_TEXTS} SELECT source_file, source_row, raw, instant FROM i",
    "p4_found": _P4,
    "p4_quotes": f"WITH {_QUOTES} SELECT currency, rate_date, quote, basis, round(rate, 8) AS rate FROM quotes",
    "p1_found": _P1,
    "p2_found": f"SELECT event_id FROM ({_RANKED}) WHERE rn > 1 AND id IS NOT NULL AND operator_code IS NOT NULL",
    "p3_found": _P3_FOUND,
    "p3_changelog": _P3_CHANGELOG,
    "p3_corrected": _P3_CORRECTED,
    "p7_found": _P7,
}
