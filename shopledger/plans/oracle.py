"""The reports in plain SQL over the same tables, written independently of the operators.

Sub-queries shared by several reports are named once in ``PARTS``; ``_sql``
puts those a report needs in front of it.
"""

from __future__ import annotations

import re

from shopledger.plans.fixtures import ITEM_TYPES
from shopledger.plans.queries import (
    ADDONS,
    AFTER,
    BEFORE,
    BUNDLES,
    CALENDAR_ITEMS,
    END,
    EVENTS_END,
    EVENTS_START,
    EXCLUDED_ITEMS,
    KIT_ITEMS,
    LISTED_ITEMS,
    ORDER_MEASURES,
    PERIODS,
    SEGMENTS,
    SOURCES,
    START,
    TRACKED_PERIOD,
    UPSIZE_MEASURES,
    VALUE_LABELS,
    VARIABLE_LABELS,
    VARIANT_ITEMS,
)


def _in(values) -> str:
    return "(" + ",".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def _r(expression: str, places: int = 6) -> str:
    return f"ROUND(CAST({expression} AS DOUBLE),{places})"


def _ratio(n: str, d: str) -> str:
    return f"CASE WHEN COALESCE({d},0)=0 OR {n} IS NULL THEN 0.0 ELSE CAST({n} AS DOUBLE)/CAST({d} AS DOUBLE) END"


def _pct(n: str, d: str) -> str:
    return f"({_ratio(n, d)})*100.0"


def _day(column: str) -> str:
    return f"strftime({column},'%Y-%m-%d')"


def _stamp(column: str) -> str:
    return f"strftime({column},'%Y-%m-%d %H:%M:%S')"


def _local(column: str) -> str:
    return f"strftime(timezone('America/Los_Angeles', timezone('UTC', {column})),'%Y-%m-%d')"


MONTHS = "['ene','feb','mar','abr','may','jun','jul','ago','sept','oct','nov','dic']"

PARTS: dict[str, str] = {
    # --- tables ---------------------------------------------------------------
    "fo": """
        SELECT o.*, CASE WHEN order_plan='SUBSCRIPTION' AND is_first_order=0 THEN 1 ELSE 0 END AS recurrent
        FROM (SELECT o_orderkey AS id, 'ON' || o_orderkey AS order_number, o_custkey AS customer_id,
                o_custkey AS subscription_id, o_orderdate AS created_at,
                CASE WHEN o_orderstatus='P' THEN 'CANCELLED' ELSE 'PAID' END AS status,
                CASE WHEN left(o_orderpriority,1) IN ('1','2') THEN 'SUBSCRIPTION'
                     WHEN left(o_orderpriority,1)='3' THEN 'MIXED' ELSE 'OTO' END AS order_plan,
                CAST(o_totalprice AS DECIMAL(18,2)) AS total,
                CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)=1
                     THEN 1 ELSE 0 END AS is_first_order
              FROM orders) o""",
    "fou": """
        SELECT fo.*, u.units FROM fo LEFT JOIN
          (SELECT l_orderkey, CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS units FROM lineitem GROUP BY 1) u
          ON u.l_orderkey=fo.id""",
    "catalogue": f"""
        SELECT p_partkey, CAST(split_part(p_brand,'#',2) AS BIGINT)*10 + list_position({list(ITEM_TYPES)}, p_type) - 1 AS item,
               p_type AS category, p_brand AS brand FROM part""",
    "items": """
        SELECT l_orderkey AS oid, item, CAST(l_quantity AS INT) AS quantity, category, brand, l_linenumber AS line
        FROM lineitem JOIN catalogue ON p_partkey=l_partkey""",
    "people": """
        SELECT c_custkey AS cust, c_nationkey AS nation,
               ['CANCELLED','ACTIVE','PROCESSING','ON_HOLD'][CAST(c_custkey%4+1 AS INT)] AS status,
               CASE c_nationkey%3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS program,
               CASE WHEN c_acctbal<0 THEN 1 ELSE 0 END AS negative,
               c_mktsegment AS plan_id, 1+c_custkey%8 AS weeks,
               c_custkey%97<>0 AS answered,
               CASE WHEN c_custkey%97<>0 AND c_custkey%2=0 THEN 13+c_custkey%3 END AS list_code,
               CASE WHEN c_custkey%97<>0 THEN 13+c_custkey%3 END AS any_code,
               CASE WHEN c_custkey%97<>0 THEN CASE c_nationkey%3 WHEN 0 THEN 'current' WHEN 1 THEN 'before' ELSE 'never' END
                 END AS experience,
               CASE WHEN c_nationkey<13 THEN 'user' || c_custkey || '@example.com' END AS email
        FROM customer""",
    "subs": """
        SELECT p.*, d.created, d.updated FROM people p LEFT JOIN
          (SELECT o_custkey, min(o_orderdate) AS created, max(o_orderdate) AS updated FROM orders GROUP BY 1) d
          ON d.o_custkey=p.cust""",
    "sub_items": """
        SELECT fo.customer_id AS cust, l.item, l.category, CASE WHEN l.quantity>25 THEN -1 ELSE 1 END AS remaining
        FROM items l JOIN fo ON fo.id=l.oid WHERE fo.order_plan='SUBSCRIPTION'""",
    "cancels": """
        SELECT o_orderkey AS cancel_id, o_custkey AS cust, o_orderpriority || ' -> P' AS reason,
               o_orderpriority AS root, o_orderdate AS happened
        FROM orders WHERE o_orderstatus='P'""",
    "enrolled": """
        SELECT customer_id AS cust, min(created_at) AS first_date,
               CASE WHEN customer_id%3<>0 THEN max(created_at) END AS last_date
        FROM fo WHERE order_plan='SUBSCRIPTION' GROUP BY 1""",
    "renews": """
        SELECT id, customer_id AS cust, created_at AS happened,
               CASE WHEN status='CANCELLED' THEN 'FAILED' WHEN customer_id%7=0 THEN 'PENDING' ELSE 'SUCCESS' END AS status
        FROM fo""",
    "ev": """
        SELECT *, CAST(regexp_extract(props,'[0-9]+') AS INT) AS k,
               user_id || '-' || strftime(ts,'%Y%m%d') AS entity
        FROM events""",
    "pay": """
        SELECT event_id AS id, entity, user_id, ts,
               CASE WHEN event_type='error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN k%10=8 THEN 'invalid_metadata' WHEN k%10=9 THEN 'unknown_error' ELSE 'code_' || (k%10) END AS code,
               k%10 NOT IN (8,9) AND k%2=0 AS backup, k%3 AS card
        FROM ev WHERE event_type IN ('error','purchase')""",
    # --- payments -------------------------------------------------------------
    "outcome": """
        SELECT entity, arg_min(status, ts) AS first_status, min(ts) AS first_ts, arg_min(code, ts) AS code,
               bool_or(status='FAILED') AS failed, min(ts) FILTER (status='SUCCESS') AS success_ts
        FROM pay GROUP BY 1""",
    "recovered": f"""
        SELECT entity, arg_min(user_id, ts) AS customer_id, count(*) AS attempts, bool_or(status='FAILED') AS had_error,
               arg_max(status, ts) AS last_status, arg_max(backup, ts) AS last_backup, arg_max(id, ts) AS last_id,
               min(ts) AS first_ts, max(ts) AS last_ts
        FROM pay WHERE ts >= '{EVENTS_START}' AND ts < '{EVENTS_END}' GROUP BY 1""",
    "bycard": """
        SELECT 'user' || user_id || '@example.com' AS email, strftime(ts,'%Y%m%d') AS description, count(*) AS attempts,
               bool_or(status='FAILED') AS had_error, arg_max(status, ts)='SUCCESS' AS last_paid,
               list_sort(list_distinct(list('card' || card) FILTER (status='FAILED'))) AS failed,
               arg_max('card' || card, ts) FILTER (status='SUCCESS') AS paid, min(ts) AS first_ts, max(ts) AS last_ts
        FROM pay GROUP BY 1,2""",
    "cardflags": """
        SELECT *, had_error AND last_paid AS resolved,
               COALESCE(had_error AND last_paid AND len(failed)=1 AND paid<>failed[1], false) AS by_backup FROM bycard""",
    # --- program --------------------------------------------------------------
    "prog": f"""
        SELECT e.cust, e.first_date, e.last_date, r.id AS rid, r.happened,
               row_number() OVER (PARTITION BY e.cust ORDER BY r.happened NULLS FIRST, 'RE' || r.id) AS rn,
               p.program, p.status
        FROM enrolled e JOIN people p ON p.cust=e.cust
        LEFT JOIN renews r ON r.cust=e.cust AND r.status='SUCCESS' AND CAST(r.happened AS DATE)>=CAST(e.first_date AS DATE)
          AND (e.last_date IS NULL OR CAST(r.happened AS DATE)<=CAST(e.last_date AS DATE))
        WHERE e.first_date > '{BEFORE}'""",
    "progflags": f"""
        SELECT q.*, max(same_day) OVER (PARTITION BY cust)=1 AS reactivated FROM (
          SELECT cust, rid, rn, CASE WHEN happened IS NULL THEN 0 ELSE rn END AS num, program, status,
                 {_local('first_date')} AS start_date, {_local('happened')} AS renewal_date, {_local('last_date')} AS end_date,
                 CASE WHEN rn=1 THEN 1 ELSE 0 END AS uniq,
                 CASE WHEN happened IS NOT NULL AND rn=1 AND {_local('first_date')}={_local('happened')} THEN 1 ELSE 0 END AS same_day
          FROM prog) q""",
    # --- renewals -------------------------------------------------------------
    "ranked": """
        SELECT subscription_id AS cust, created_at, id,
               row_number() OVER (PARTITION BY subscription_id ORDER BY created_at DESC, id DESC) AS rn
        FROM fo WHERE status<>'CANCELLED'""",
    "lasttwo": """
        SELECT a.cust, a.created_at AS last_ts, b.created_at AS second_ts
        FROM ranked a JOIN ranked b ON a.cust=b.cust AND a.rn=1 AND b.rn=2""",
    "gaps": f"""
        SELECT unnest(CASE p.program WHEN 'true' THEN ['program','all'] ELSE ['no_program','all'] END) AS cohort,
               l.cust, date_diff('day', second_ts, last_ts) AS days, p.weeks AS freq,
               CASE WHEN l.cust%2=0 THEN 'CAT_A' ELSE 'CAT_B' END AS category
        FROM lasttwo l JOIN subs p ON p.cust=l.cust
        WHERE p.status<>'CANCELLED' AND p.created > '{BEFORE}' AND p.created < '{END}'""",
    "series": """
        SELECT cohort, 'configured' AS series, freq*7 AS days FROM gaps
        UNION ALL SELECT cohort, 'actual', days FROM gaps
        UNION ALL SELECT cohort, category, days FROM gaps""",
    "errs": """
        SELECT cust, CAST(SUM(n) AS BIGINT) AS errors FROM (
          SELECT l.cust, r.id, count(*)-1 AS n
          FROM lineitem li JOIN renews r ON r.id=li.l_orderkey JOIN lasttwo l ON l.cust=r.cust
          WHERE r.happened + INTERVAL (li.l_linenumber-1) HOUR BETWEEN l.second_ts AND l.last_ts
          GROUP BY 1,2) GROUP BY 1""",
    "freqs": """
        SELECT * FROM (
          SELECT cust, happened, id, freq, lag(freq) OVER (PARTITION BY cust ORDER BY happened, 'RE' || id, freq) AS prev,
                 min(freq) OVER (PARTITION BY cust)<>max(freq) OVER (PARTITION BY cust) AS several
          FROM (SELECT o_custkey AS cust, o_orderdate AS happened, o_orderkey AS id,
                  CASE WHEN left(o_orderpriority,1)='5' THEN 'Every 2 months'
                       ELSE 'Every ' || left(o_orderpriority,1) || ' weeks' END AS freq FROM orders))
        WHERE several AND (prev IS NULL OR freq<>prev)""",
    "freqlast": """
        SELECT cust, freq, CAST(substr(freq,7,1) AS INT) AS weeks, max(happened) AS happened
        FROM freqs WHERE freq LIKE '%weeks' GROUP BY 1,2,3""",
    "freqdiff": """
        SELECT cust, max(weeks) FILTER (n=1)-max(weeks) FILTER (n=2) AS diff FROM (
          SELECT *, row_number() OVER (PARTITION BY cust ORDER BY happened DESC, freq) AS n FROM freqlast) GROUP BY 1""",
    "enriched": """
        SELECT l.cohort, l.cust, date_diff('day', l.second_ts, l.last_ts) AS days, p.weeks AS freq,
               CASE WHEN l.cust%2=0 THEN 'CAT_A' ELSE 'CAT_B' END AS category, p.negative AS snooze,
               COALESCE(e.errors,0) AS errors, c.cust IS NOT NULL AS changed, CASE WHEN c.cust IS NOT NULL THEN d.diff END AS diff
        FROM (SELECT lt.*, unnest(CASE p.program WHEN 'true' THEN ['program','all'] ELSE ['no_program','all'] END) AS cohort
              FROM lasttwo lt JOIN people p ON p.cust=lt.cust) l
        JOIN people p ON p.cust=l.cust
        LEFT JOIN errs e ON e.cust=l.cust
        LEFT JOIN (SELECT DISTINCT f.cust FROM freqlast f JOIN lasttwo t ON t.cust=f.cust
                   WHERE f.happened BETWEEN t.second_ts AND t.last_ts) c ON c.cust=l.cust
        LEFT JOIN freqdiff d ON d.cust=l.cust""",
    # --- funnels --------------------------------------------------------------
    "steps": """
        SELECT CASE WHEN k<50 THEN 'low' ELSE 'high' END AS funnel, event_type AS step, day(ts) AS d, count(*) AS users
        FROM ev WHERE event_type<>'error' GROUP BY 1,2,3""",
    "stepped": """
        SELECT funnel, step, list_position(['view','click','signup','purchase'], step) AS step_no, 'day' AS row_type,
               CAST(d AS VARCHAR) AS label, users FROM steps
        UNION ALL
        SELECT funnel, step, list_position(['view','click','signup','purchase'], step), 'total', 'Total',
               CAST(SUM(users) AS BIGINT) FROM steps GROUP BY 1,2""",
    "funneled": """
        SELECT *, first_value(users) OVER w AS first_users, lag(users) OVER w AS previous_users, row_number() OVER w AS n
        FROM stepped WINDOW w AS (PARTITION BY funnel, row_type, label ORDER BY step_no)""",
    # --- repurchase -----------------------------------------------------------
    "bought": f"""
        SELECT DISTINCT f.customer_id, f.id, i.brand FROM fo f JOIN items i ON i.oid=f.id
        WHERE f.status<>'CANCELLED' AND f.order_plan='OTO' AND f.recurrent=0
          AND f.id IN (SELECT oid FROM items WHERE category='PROMO')
          AND f.customer_id IN (SELECT g.customer_id FROM fo g JOIN items j ON j.oid=g.id
            WHERE g.status<>'CANCELLED' AND g.order_plan='OTO' AND g.recurrent=0 AND g.is_first_order=1
              AND g.created_at BETWEEN '{START}' AND '{END}')""",
    # The kit line with the lowest item id decides; it has answers only as the first line.
    "kit": f"""
        SELECT oid, arg_min(line, (item, CASE WHEN line=1 THEN 1 ELSE 0 END))=1 AS has_answers
        FROM items WHERE item IN {_in(KIT_ITEMS)} GROUP BY 1""",
    "cohortkit": f"""
        SELECT f.id, f.customer_id, f.created_at, c.n AS customs, COALESCE(k.has_answers,false) AS has_answers,
               COALESCE((SELECT list_sort(list_distinct(list(CAST(i.item AS VARCHAR)))) FROM items i
                         WHERE i.oid=f.id AND i.item IN {_in(EXCLUDED_ITEMS)}), []) AS tracked
        FROM fo f LEFT JOIN kit k ON k.oid=f.id JOIN (SELECT customer_id, count(DISTINCT id) AS n FROM fo
              WHERE status<>'CANCELLED' AND created_at BETWEEN '{START}' AND '{END}'
                AND id IN (SELECT oid FROM items WHERE category IN ('PROMO','ECONOMY')) GROUP BY 1) c
          ON c.customer_id=f.customer_id
        WHERE f.is_first_order=1 AND f.status<>'CANCELLED' AND f.created_at BETWEEN '{START}' AND '{END}'
          AND f.id IN (SELECT oid FROM items WHERE category='PROMO')""",
    "given": """
        SELECT c.id, c.created_at, c.customs, c.tracked, unnest([
            {'variable':'KIND','value':['A','B','C'][CAST(p.cust%3+1 AS INT)]},
            {'variable':'EXPERIENCE','value':upper(p.experience)},
            {'variable':'REACTION','value':CASE WHEN p.negative=1 THEN 'YES' ELSE 'NO' END}]) AS a
        FROM cohortkit c JOIN people p ON p.cust=c.customer_id WHERE c.has_answers AND p.answered""",
    # --- cancellations --------------------------------------------------------
    "lastorder": """
        SELECT * FROM (SELECT c.*, f.id AS oid, f.order_number,
            row_number() OVER (PARTITION BY c.cancel_id ORDER BY f.created_at DESC, f.id DESC) AS n
          FROM cancels c JOIN fo f ON f.subscription_id=c.cust AND f.status<>'CANCELLED' AND f.created_at<c.happened) WHERE n=1""",
    "xbase": f"""
        SELECT l.cancel_id, l.cust, l.reason, l.root, l.happened, l.oid, l.order_number, i.listed, p.list_code, 
               COALESCE(p.experience,'Unknown') AS experience
        FROM lastorder l JOIN people p ON p.cust=l.cust
        JOIN (SELECT oid, list_sort(list_distinct(list(item))) AS listed FROM items WHERE item IN {_in(LISTED_ITEMS)} GROUP BY 1) i
          ON i.oid=l.oid""",
    "xlast": """
        SELECT c.cust, c.root, c.happened, f.id AS oid, f.order_number, f.created_at AS ordered_at, p.any_code, i.item
        FROM (SELECT c.cust, c.root, c.happened, max(f.created_at) AS last_at
              FROM cancels c JOIN fo f ON f.subscription_id=c.cust AND f.created_at<c.happened GROUP BY 1,2,3) c
        JOIN fo f ON f.subscription_id=c.cust AND f.created_at=c.last_at
        JOIN people p ON p.cust=c.cust
        JOIN (SELECT DISTINCT oid, item FROM items) i ON i.oid=f.id
        WHERE f.id IN (SELECT oid FROM items WHERE category='PROMO')""",
    "xlevel": """
        SELECT cust, happened, min(root) AS root, min(any_code) AS code FROM xlast GROUP BY 1,2""",
    "calrows": """
        SELECT CAST(c.happened AS DATE) AS d, s.category AS product, count(*) AS n
        FROM cancels c JOIN people p ON p.cust=c.cust AND p.status='CANCELLED'
        JOIN sub_items s ON s.cust=c.cust GROUP BY 1,2""",
    "calmonth": """
        SELECT m.y, m.mo, t.product, COALESCE(SUM(r.n),0) AS n
        FROM (SELECT DISTINCT year(d) AS y, month(d) AS mo FROM calrows) m
        CROSS JOIN (SELECT DISTINCT product FROM calrows) t
        LEFT JOIN calrows r ON year(r.d)=m.y AND month(r.d)=m.mo AND r.product=t.product GROUP BY 1,2,3""",
    "callevels": """
        SELECT y, 'month' AS row_type, mo, product, n FROM calmonth
        UNION ALL SELECT y, 'total', NULL, product, SUM(n) FROM calmonth GROUP BY 1,4""",
    "reasonrows": f"""
        SELECT year(c.happened) AS y, month(c.happened) AS mo, trim(split_part(c.reason,'-',1)) AS reason, count(*) AS n
        FROM cancels c JOIN sub_items s ON s.cust=c.cust
        WHERE s.item NOT IN {_in(EXCLUDED_ITEMS)} AND c.happened > '{BEFORE}' AND c.happened < '{END}' GROUP BY 1,2,3""",
    "reasonmonth": """
        SELECT m.y, m.mo, t.reason, COALESCE(r.n,0) AS n,
               CAST(COALESCE(r.n,0) AS DOUBLE)/SUM(COALESCE(r.n,0)) OVER (PARTITION BY m.y, m.mo) AS share
        FROM (SELECT DISTINCT y, mo FROM reasonrows) m JOIN (SELECT DISTINCT y, reason FROM reasonrows) t ON t.y=m.y
        LEFT JOIN reasonrows r ON r.y=m.y AND r.mo=m.mo AND r.reason=t.reason""",
    # --- promotions -----------------------------------------------------------
    "oto": "SELECT * FROM fo WHERE status<>'CANCELLED' AND order_plan<>'SUBSCRIPTION'",
    "promo": f"""
        SELECT COALESCE(a.d,b.d) AS d, a.n AS orders, b.n AS discounted
        FROM (SELECT CAST(created_at AS DATE) AS d, count(*) AS n FROM oto
              WHERE recurrent=0 AND created_at > '{BEFORE}' AND created_at < '{AFTER}' GROUP BY 1) a
        FULL JOIN (SELECT CAST(o.created_at AS DATE) AS d, count(*) AS n FROM oto o
              JOIN (SELECT l_orderkey, min(l_shipdate) AS happened FROM lineitem WHERE l_discount>=0.08 GROUP BY 1) u ON u.l_orderkey=o.id
              WHERE u.happened > '{BEFORE}' AND u.happened < '{AFTER}' GROUP BY 1) b ON a.d=b.d""",
    "promoday": f"""
        SELECT d, orders, COALESCE(discounted,0) AS discounted, {_pct('COALESCE(discounted,0)', 'orders')} AS pct
        FROM promo WHERE orders IS NOT NULL""",
    "promomonth": """
        SELECT strftime(d,'%Y-%m') AS month, CAST(SUM(orders) AS BIGINT) AS orders,
               CAST(SUM(discounted) AS BIGINT) AS discounted, count(*) AS days FROM promoday GROUP BY 1""",
    # --- baskets --------------------------------------------------------------
    "basket": """
        SELECT CASE WHEN l_returnflag<>'R' THEN 'ON' || l_orderkey END AS order_number, l_shipdate AS happened,
               l_linestatus='O' AS subscribed,
               (CASE WHEN (floor(l_extendedprice/20)/100)>0 THEN (floor(l_extendedprice/20)/100)*(1+CAST(l_quantity AS INT)%3) ELSE 0 END
                + CASE WHEN ROUND(l_tax*100,2)>0 THEN ROUND(l_tax*100,2) ELSE 0 END) - ROUND(l_discount*100,2) AS amount,
               CASE WHEN (floor(l_extendedprice/20)/100)>0 THEN 1+CAST(l_quantity AS INT)%3 ELSE 0 END
                + CASE WHEN ROUND(l_tax*100,2)>0 THEN 1 ELSE 0 END AS units
        FROM lineitem WHERE (floor(l_extendedprice/20)/100)>0 OR ROUND(l_tax*100,2)>0""",
    "kinds": """
        SELECT *, CASE WHEN order_number IS NULL THEN 'attempts' ELSE 'orders' END AS kind FROM basket
        WHERE (NOT subscribed AND amount>=35) OR (subscribed AND amount>=15)""",
    "kindtotals": """
        SELECT subscribed, kind, count(*) AS n, avg(amount) AS avg_amount, avg(units) AS avg_units,
               date_diff('day', min(happened), max(happened))+1 AS days FROM kinds GROUP BY 1,2""",
    # --- reviews --------------------------------------------------------------
    "rev": """
        SELECT d.doc_id, d.lang, d.source, d.text, l.quality,
               CASE WHEN l.toxic=0 OR (l.toxic IS NULL AND d.doc_id%2=0) THEN 0 ELSE 1 END AS toxic,
               COALESCE(3+l.quality+d.doc_id%2, CASE WHEN d.doc_id%4<>0 THEN 1+d.doc_id%5 END) AS rating,
               CASE d.doc_id%5 WHEN 0 THEN '77-' || d.doc_id WHEN 1 THEN 'KIT1' WHEN 2 THEN CAST(5000+d.doc_id AS VARCHAR)
                    ELSE 'x' || d.doc_id END AS sku,
               '2024-01-' || lpad(CAST(1+d.doc_id%28 AS VARCHAR),2,'0') AS d1
        FROM documents d LEFT JOIN labels l ON l.doc_id=d.doc_id""",
    "verified": "SELECT * FROM rev WHERE toxic=0 AND rating IN (4,5)",
}


def _sql(body: str) -> str:
    """``body`` behind the parts it names, directly or through other parts."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in PARTS:
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    need(body)
    head = ",\n".join(f"{n} AS ({PARTS[n]})" for n in ordered)
    return (f"WITH {head}\n" if head else "") + body


def _metrics(select: dict[str, str], source: str, keep: str = "") -> str:
    """One row per metric out of one-row (or one row per ``keep``) source."""
    rows = [
        f"SELECT {keep + ', ' if keep else ''}'{name}' AS metric, {_r(expression)} AS value FROM {source}"
        for name, expression in select.items()
    ]
    return "\nUNION ALL ".join(rows)


ORACLE_SQL: dict[str, str] = {}


_BODIES: dict[str, str] = {}


def _add(name: str, body: str) -> None:
    _BODIES[name] = body
    ORACLE_SQL[name] = _sql(body)


# --- orders and sales ---------------------------------------------------------

_segment = """
    SELECT CASE WHEN recurrent=1 THEN ['recurrent']
                WHEN is_first_order=1 THEN ['new_' || CASE order_plan WHEN 'OTO' THEN 'oto' ELSE lower(order_plan) END, 'new_all']
                ELSE ['existing_' || CASE order_plan WHEN 'OTO' THEN 'oto' ELSE lower(order_plan) END, 'existing_all'] END"""
_kpi = f"""
 v AS (SELECT f.*, CASE WHEN x.q IS NULL THEN f.units ELSE f.units-x.q END AS vi FROM fou f LEFT JOIN
    (SELECT oid, CAST(SUM(quantity) AS BIGINT) AS q FROM items WHERE item IN {_in(EXCLUDED_ITEMS)} GROUP BY 1) x ON x.oid=f.id),
 s AS (SELECT unnest(({_segment})) AS segment, CAST(created_at AS DATE) AS d, total, vi FROM v
    WHERE status NOT IN ('CANCELLED','PAYMENT_ERROR') AND created_at>='{START}' AND created_at<'{END}'),
 spine AS (SELECT segment, CAST(d AS DATE) AS d FROM
    (SELECT unnest(['new_subscription','new_oto','new_mixed','new_all','existing_subscription','existing_oto',
                    'existing_mixed','existing_all','recurrent']) AS segment) a,
    (SELECT unnest(generate_series(DATE '{START}', DATE '{END}' - 1, INTERVAL 1 DAY)) AS d) b),
 t AS (SELECT segment, 'day' AS row_type, {_day('p.d')} AS label, COALESCE(SUM(s.total),0) AS revenue, count(s.total) AS orders,
         CAST(COALESCE(SUM(s.vi),0) AS BIGINT) AS valid_items FROM spine p LEFT JOIN s USING (segment, d) GROUP BY 1,2,3
       UNION ALL
       SELECT segment, 'total', 'Total', COALESCE(SUM(s.total),0), count(s.total), CAST(COALESCE(SUM(s.vi),0) AS BIGINT)
       FROM spine p LEFT JOIN s USING (segment, d) GROUP BY 1)
"""
_head = _sql("SELECT * FROM fou JOIN items")
ORACLE_SQL["daily_orders_kpi"] = (
    _head[: _head.rindex("\nSELECT * FROM fou")]
    + ",\n"
    + _kpi
    + f"""SELECT segment, row_type, label, {_r('revenue')} AS revenue, orders, valid_items,
       {_r(_ratio('valid_items', 'orders'))} AS avg_items, {_r(_ratio('CAST(revenue AS DOUBLE)', 'orders'))} AS avg_value FROM t"""
)
_add(
    "valid_items",
    f"""SELECT f.id, f.units, CASE WHEN x.q IS NULL THEN f.units ELSE f.units-x.q END AS valid_items FROM fou f LEFT JOIN
    (SELECT oid, CAST(SUM(quantity) AS BIGINT) AS q FROM items WHERE item IN {_in(EXCLUDED_ITEMS)} GROUP BY 1) x ON x.oid=f.id""",
)
_split = f"""(SELECT {_day('created_at')} AS d, count(*) FILTER (recurrent=0) AS a, count(*) FILTER (recurrent=1) AS b
    FROM fo WHERE status NOT IN ('CANCELLED','PAYMENT_ERROR') AND is_first_order<>1
      AND created_at>='{START}' AND created_at<'{END}' GROUP BY 1)"""
_add(
    "daily_sales_split",
    f"""SELECT 'day' AS row_type, d AS label, {_r('a')} AS daily_no_recurrent, {_r('b')} AS daily_recurrent FROM {_split}
    UNION ALL SELECT 'total', 'Total', {_r('SUM(a)')}, {_r('SUM(b)')} FROM {_split}
    UNION ALL SELECT 'mean', 'Mean', {_r('AVG(a)')}, {_r('AVG(b)')} FROM {_split}""",
)
_due = f"""(SELECT d, CAST(SUM(e) AS BIGINT) AS e, CAST(SUM(o) AS BIGINT) AS o FROM (
    SELECT {_day('updated + INTERVAL (weeks*7) DAY')} AS d, 1 AS e, 0 AS o FROM subs
      WHERE status='ACTIVE' AND updated >= TIMESTAMP '{START}' - INTERVAL 56 DAY AND updated < '{END}'
        AND updated + INTERVAL (weeks*7) DAY BETWEEN '{START}' AND '{END}'
    UNION ALL SELECT {_day('created_at')}, 0, 1 FROM fou WHERE created_at>='{START}' AND created_at<'{END}'
        AND order_plan='SUBSCRIPTION' AND recurrent=1 AND units=1) GROUP BY 1)"""
_add(
    "expected_vs_obtained_renewals",
    f"""SELECT 'day' AS row_type, d AS label, e AS expected, o AS obtained, {_r(_ratio('o', 'e'))} AS ratio FROM {_due}
    UNION ALL SELECT 'total', 'Total', CAST(SUM(e) AS BIGINT), CAST(SUM(o) AS BIGINT), {_r(_ratio('SUM(o)', 'SUM(e)'))} FROM {_due}""",
)

# --- payments -----------------------------------------------------------------

_errors = f"""(SELECT d, CAST(SUM(e) AS BIGINT) AS e, CAST(SUM(r) AS BIGINT) AS r FROM (
    SELECT {_day('first_ts')} AS d, 1 AS e, 0 AS r FROM outcome WHERE first_status='FAILED'
    UNION ALL SELECT {_day('success_ts')}, 0, 1 FROM outcome WHERE failed AND success_ts IS NOT NULL) GROUP BY 1)"""
_add(
    "payment_error_daily",
    f"""SELECT 'day' AS row_type, d AS label, {_r('e')} AS daily_errors, {_r('r')} AS daily_resolved FROM {_errors}
    UNION ALL SELECT 'total', 'Total', {_r('SUM(e)')}, {_r('SUM(r)')} FROM {_errors}
    UNION ALL SELECT 'mean', 'Mean', {_r('AVG(e)')}, {_r('AVG(r)')} FROM {_errors}""",
)
_add(
    "payment_error_reasons",
    "SELECT code AS decline_code, count(*) AS error_count FROM outcome WHERE first_status='FAILED' GROUP BY 1",
)
_resolved = "(had_error AND last_status='SUCCESS')"
_add(
    "payment_recovery",
    f"""SELECT customer_id, entity AS entity_id, attempts, had_error, {_resolved} AS resolved,
    {_resolved} AND last_backup AS resolved_by_backup, {_stamp('first_ts')} AS first_attempt, {_stamp('last_ts')} AS last_attempt,
    last_status, last_backup AS last_by_backup, last_id FROM recovered""",
)


def _recovery_summary(counts: str, all_share: bool) -> str:
    return _metrics(
        {
            "total_payments": "n",
            "total_errors": "e",
            "total_resolved": "s",
            "total_resolved_by_backup": "b",
            "error_share": _ratio("e", "n") if all_share else _ratio("s", "e"),
            "resolved_share": _ratio("s", "e"),
            "backup_share": _ratio("b", "s"),
        },
        counts,
    )


_add(
    "payment_recovery_summary",
    _recovery_summary(
        f"""(SELECT count(*) AS n, count(*) FILTER (had_error) AS e, count(*) FILTER ({_resolved}) AS s,
        count(*) FILTER ({_resolved} AND last_backup) AS b FROM recovered)""",
        False,
    ),
)
_add(
    "payment_recovery_by_card",
    f"""SELECT email AS customer_email, description, attempts, had_error, resolved, by_backup AS resolved_by_backup,
    '{{' || COALESCE(array_to_string(failed, ', '),'') || '}}' AS failed_card_ids, COALESCE(paid,'(none)') AS paid_card_id,
    {_stamp('first_ts')} AS first_attempt, {_stamp('last_ts')} AS last_attempt FROM cardflags""",
)
_add(
    "payment_recovery_by_card_summary",
    _recovery_summary(
        """(SELECT count(*) AS n, count(*) FILTER (had_error) AS e, count(*) FILTER (resolved) AS s,
        count(*) FILTER (by_backup) AS b FROM cardflags)""",
        True,
    ),
)

_blocked = f"""
 b AS (SELECT event_id, user_id, entity, ts, CAST(ts AS DATE) AS d, CAST(value AS DECIMAL(18,2)) AS amount,
    CASE WHEN k%4=0 THEN 'user' || user_id || '@example.com' WHEN k%4=2 THEN 'dev' || user_id END AS own
    FROM ev WHERE event_type='error'),
 f AS (SELECT user_id, arg_min(COALESCE(own,'user_' || entity), event_id) AS device FROM b GROUP BY 1),
 paid AS (SELECT entity, arg_min(CAST(value AS DECIMAL(18,2)), event_id) AS paid FROM ev WHERE event_type='purchase' GROUP BY 1),
 r AS (SELECT b.*, COALESCE(b.own, f.device) AS device, paid.paid, paid.paid IS NOT NULL AS resolved
    FROM b JOIN f ON f.user_id=b.user_id LEFT JOIN paid ON paid.entity=b.entity),
 i AS (SELECT d, count(*) AS n, SUM(amount) AS amount, count(*) FILTER (resolved) AS nr, COALESCE(SUM(paid),0) AS paid FROM
    (SELECT d, entity, arg_min(amount, event_id) AS amount, bool_or(resolved) AS resolved, max(paid) AS paid FROM r GROUP BY 1,2) GROUP BY 1),
 u AS (SELECT d, count(DISTINCT device) AS n, count(DISTINCT device) FILTER (resolved) AS nr FROM r GROUP BY 1),
 fb AS (SELECT device, arg_min(d, event_id) AS d, arg_min(ts, event_id) AS ts FROM r GROUP BY 1),
 so AS (SELECT user_id, min(ts) AS ts FROM ev WHERE event_type='signup' GROUP BY 1),
 nu AS (SELECT fb.d, count(*) AS n FROM fb LEFT JOIN people p ON p.email=fb.device LEFT JOIN so ON so.user_id=p.cust
    WHERE fb.device NOT LIKE '%@%' OR p.cust IS NULL OR so.ts IS NULL OR NOT so.ts < fb.ts - INTERVAL 1 DAY GROUP BY 1),
 no AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM ev WHERE event_type='signup' GROUP BY 1),
 daily AS (SELECT i.d, i.n AS blocked_payments, i.amount AS amount_blocked, u.n AS blocked_users, i.nr AS payments_resolved,
    i.paid AS amount_resolved, u.nr AS users_resolved, COALESCE(nu.n,0) AS new_users_blocked, COALESCE(no.n,0) AS total_new_users,
    LEAST(COALESCE(nu.n,0), u.nr) AS new_users_resolved
    FROM i JOIN u ON u.d=i.d LEFT JOIN nu ON nu.d=i.d LEFT JOIN no ON no.d=i.d),
 lv AS (SELECT 'day' AS row_type, {_day('d')} AS label, * EXCLUDE (d) FROM daily
    UNION ALL SELECT 'total', 'Total', SUM(blocked_payments), SUM(amount_blocked), SUM(blocked_users), SUM(payments_resolved),
      SUM(amount_resolved), SUM(users_resolved), SUM(new_users_blocked), SUM(total_new_users), SUM(new_users_resolved) FROM daily)
"""
_head = _sql("SELECT * FROM ev JOIN people")
_base = "(total_new_users+new_users_blocked-new_users_resolved)"
ORACLE_SQL["blocked_payments_daily"] = (
    _head[: _head.rindex("\nSELECT * FROM ev")]
    + ",\n"
    + _blocked
    + f"""SELECT row_type, label, CAST(blocked_payments AS BIGINT) AS blocked_payments, {_r('amount_blocked')} AS amount_blocked,
    CAST(blocked_users AS BIGINT) AS blocked_users, CAST(payments_resolved AS BIGINT) AS payments_resolved,
    {_r('amount_resolved')} AS amount_resolved, CAST(users_resolved AS BIGINT) AS users_resolved,
    CAST(new_users_blocked AS BIGINT) AS new_users_blocked, CAST(total_new_users AS BIGINT) AS total_new_users,
    CAST(new_users_resolved AS BIGINT) AS new_users_resolved,
    CASE WHEN row_type='day' THEN ROUND({_pct('new_users_blocked', _base)},2) ELSE {_r(_pct('new_users_blocked', _base))} END
      AS new_users_blocked_pct FROM lv"""
)

# --- subscriptions ------------------------------------------------------------

_mix = f"""(SELECT
    count(*) FILTER (k='m') AS m, count(*) FILTER (k='r') AS r, COALESCE(SUM(n) FILTER (k='m'),0) AS nm,
    count(*) FILTER (k='r' AND n>0) AS nr,
    (SELECT COALESCE(SUM(i.quantity),0) FROM items i JOIN fo ON fo.id=i.oid WHERE i.item IN {_in(EXCLUDED_ITEMS)}
       AND fo.status<>'CANCELLED' AND fo.order_plan<>'SUBSCRIPTION' AND fo.created_at>='{START}' AND fo.created_at<'{END}') AS o
    FROM (SELECT CASE WHEN plan_id IN ('AUTOMOBILE','BUILDING') THEN 'm' WHEN plan_id IN ('FURNITURE','HOUSEHOLD') THEN 'r' END AS k,
            (SELECT count(*) FROM fo WHERE fo.subscription_id=s.cust AND fo.is_first_order=1) AS n
          FROM subs s WHERE status<>'CANCELLED' AND created>='{START}' AND created<'{END}'))"""
_add(
    "subscription_mix",
    _metrics(
        {
            "mini_subscriptions": "m",
            "subscriptions": "r",
            "mini_pct": f"ROUND({_pct('m', '(m+r)')},2)",
            "oto_pct": f"ROUND({_pct('o', '(m+r+o)')},2)",
            "oto_units": "o",
            "new_mini_subscriptions": "nm",
            "new_subscriptions": "nr",
            "existing_mini_subscriptions": "m-nm",
            "existing_subscriptions": "r-nr",
        },
        _mix,
    ),
)
_add(
    "addon_subscriptions",
    f"""SELECT CASE WHEN item//10%5 IN (0,1) THEN 'group_01' WHEN item//10%5=2 THEN 'group_2' ELSE 'group_3' END AS addon,
    count(*) AS subscriptions FROM sub_items si JOIN subs s ON s.cust=si.cust
    WHERE si.remaining=-1 AND item//10%5<>4 AND s.created>'{BEFORE}' AND s.created<'{END}' GROUP BY 1""",
)
_refill = f"""(SELECT count(*) AS a, SUM(is_first_order) AS b, SUM(quantity) AS q FROM (
    SELECT f.id, f.is_first_order, arg_min(i.quantity, (i.item, i.quantity)) AS quantity FROM fo f JOIN items i ON i.oid=f.id
    WHERE i.category IN ('SMALL','LARGE','MEDIUM') AND f.created_at>'{BEFORE}' AND f.created_at<'{END}'
      AND f.status<>'CANCELLED' AND f.recurrent=0 GROUP BY 1,2))"""
_refill_oto = f"""(SELECT count(*) AS a, SUM(is_first_order) AS b FROM fo WHERE status<>'CANCELLED' AND order_plan='OTO'
    AND created_at>'{BEFORE}' AND created_at<'{END}' AND id IN (SELECT oid FROM items WHERE category='PROMO'))"""
_add(
    "category_refill",
    _metrics({"refill_orders": "a", "refill_new_customers": "b", "refill_units": "q"}, _refill)
    + "\nUNION ALL "
    + _metrics({"oto_orders": "a", "oto_new_customers": "b"}, _refill_oto),
)
_ships = f"status<>'CANCELLED' AND created_at>'{BEFORE}' AND created_at<'{END}'"
_addon = "\nUNION ALL ".join(
    f"""SELECT '{n}' AS addon,
    (SELECT count(*) FROM fo WHERE {_ships} AND order_plan='OTO' AND id IN (SELECT oid FROM items WHERE category IN {_in(a['base'])})) AS b,
    count(*) AS u, SUM(q) AS p FROM (SELECT f.id, arg_min(i.quantity, (i.item, i.quantity)) AS q FROM fo f JOIN items i ON i.oid=f.id
      WHERE {_ships} AND i.item IN {_in(a['items'])} GROUP BY 1)"""
    for n, a in ADDONS.items()
)
_add(
    "upsize_attach",
    f"""SELECT addon, b AS base_orders, u AS upsized_orders, CAST(p AS BIGINT) AS pieces FROM ({_addon})
    UNION ALL SELECT 'total', (SELECT count(*) FROM fo WHERE {_ships} AND order_plan='OTO'
      AND id IN (SELECT oid FROM items WHERE category IN ('PROMO','ECONOMY'))), CAST(SUM(u) AS BIGINT), CAST(SUM(p) AS BIGINT) FROM ({_addon})""",
)
_signed = f"(SELECT *, 'SOURCE_' || (k%9) AS source FROM ev WHERE event_type='signup' AND ts>'{START}' AND ts<'{AFTER}')"
_add(
    "acquisition_survey",
    f"""SELECT 'new_customer_orders' AS metric, count(*) AS value FROM fo WHERE status<>'CANCELLED' AND is_first_order=1
      AND created_at BETWEEN '{START}' AND '{AFTER}'
    UNION ALL SELECT 'respondents', count(DISTINCT user_id) FROM {_signed}
    """
    + "".join(f"UNION ALL SELECT 'source:{s}', count(*) FILTER (source='{s}') FROM {_signed}\n" for s in SOURCES),
)

# --- program ------------------------------------------------------------------

_snap = f"""(SELECT (SELECT count(*) FROM people WHERE program='true' AND status<>'CANCELLED') AS m,
    (SELECT count(*) FROM enrolled e WHERE first_date>'{BEFORE}' AND first_date<'{END}'
       AND cust IN (SELECT cust FROM renews)) AS n,
    (SELECT count(DISTINCT e.cust) FROM enrolled e JOIN renews r ON r.cust=e.cust AND r.status='SUCCESS'
       AND r.happened > e.first_date + INTERVAL 1 DAY AND r.happened > '{BEFORE}' AND (e.last_date IS NULL OR r.happened < e.last_date)) AS r)"""
_add(
    "program_snapshot",
    _metrics(
        {"new_members_pct": f"ROUND({_pct('n', 'm')},2)", "members": "m", "new_members": "n", "renewed_members": "r"}, _snap
    ),
)
_add(
    "program_enrollment_base",
    """SELECT cust AS subscription_id, start_date, renewal_date, end_date, 'RE' || rid AS renewal_id,
    rn AS row_in_subscription, num AS renewal_number, program AS program_active, status AS subscription_status,
    reactivated AS renewed_at_once FROM progflags""",
)
_add(
    "program_flags",
    """SELECT cust AS subscription_id, 'RE' || rid AS renewal_id, num AS renewal_number, uniq AS unique_subscription,
    same_day AS same_day_reactivation, CASE WHEN reactivated THEN cust END AS reactivated_subscription_id FROM progflags""",
)


def _monthly(date: str, where: str, values: str, source: str) -> str:
    return f"""SELECT year(d) AS year, month(d) AS month_number, {MONTHS}[month(d)] AS month, {values}
    FROM (SELECT *, CAST({date} AS DATE) AS d FROM {source}) WHERE d IS NOT NULL AND {where} GROUP BY 1,2,3"""


_add(
    "monthly_count_table",
    _monthly("created_at", "status<>'CANCELLED' AND is_first_order=0 AND total>=1000", "count(*) AS orders", "fo"),
)
_add(
    "monthly_status_table",
    _monthly(
        "created_at",
        "status='PAID' AND order_plan IN ('SUBSCRIPTION','MIXED')",
        """count(*) FILTER (order_plan='SUBSCRIPTION') AS SUBSCRIPTION, count(*) FILTER (order_plan='MIXED') AS MIXED,
        count(*) AS total""",
        "fo",
    ),
)
_FIGURES = {
    "customers_joined": ("start_date", "uniq=1"),
    "reactivation_renewals": ("renewal_date", "same_day=1"),
    "same_day_and_again": ("start_date", "num=2 AND reactivated"),
    "first_renewal_not_reactivation": ("start_date", "num=1 AND same_day=0"),
    "no_renewals_yet": ("start_date", "num=0"),
    "all_renewals": ("renewal_date", "num<>0"),
    "second_renewal": ("renewal_date", "num=2"),
    "second_or_more": ("renewal_date", "num>1"),
}
_STATUSES = {
    "active_processing": ["ACTIVE", "PROCESSING"],
    "active_processing_onhold": ["ACTIVE", "PROCESSING", "ON_HOLD"],
}
for _name, (_date, _where) in _FIGURES.items():
    _add(_name, _monthly(_date, _where, "count(*) AS count", "progflags"))
for _name, _list in _STATUSES.items():
    _counts = ", ".join(f"count(*) FILTER (status='{s}') AS {s}" for s in _list)
    _add(_name, _monthly("start_date", f"uniq=1 AND status IN {_in(_list)}", f"{_counts}, count(*) AS total", "progflags"))
_all = dict(_FIGURES) | {n: ("start_date", f"uniq=1 AND status IN {_in(v)}") for n, v in _STATUSES.items()}
_add(
    "program_tracker",
    "\nUNION ALL ".join(
        f"""SELECT {_day('m')} AS month, '{n}' AS metric, {_r('count(p.cust)')} AS value
    FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS m) s
    LEFT JOIN progflags p ON date_trunc('month', CAST(p.{d} AS DATE))=s.m AND {w} GROUP BY 1"""
        for n, (d, w) in _all.items()
    ),
)

# --- renewals -----------------------------------------------------------------

_add(
    "renewal_gap_simple",
    f"""SELECT cohort, cust AS subscription_id, days AS days_between_orders, {_r('days/7.0')} AS weeks_between_orders,
    {_r('freq')} AS frequency_weeks, category FROM gaps""",
)
_add(
    "renewal_gap_comparison",
    f"""SELECT c.cohort, s.series, {_r('COALESCE(AVG(x.days),0)/7.0')} AS avg_weeks, {_r('COALESCE(AVG(x.days),0)')} AS avg_days,
    COALESCE(max(m.w),'0.00') AS mode_weeks, COALESCE(max(m.d),'0.00') AS mode_days
    FROM (SELECT DISTINCT cohort FROM gaps) c CROSS JOIN (SELECT unnest(['configured','actual','CAT_A','CAT_B']) AS series) s
    LEFT JOIN series x ON x.cohort=c.cohort AND x.series=s.series
    LEFT JOIN (SELECT cohort, series, string_agg(printf('%.2f', days/7.0), ', ' ORDER BY days) AS w,
                 string_agg(printf('%.2f', CAST(days AS DOUBLE)), ', ' ORDER BY days) AS d
               FROM (SELECT cohort, series, days, rank() OVER (PARTITION BY cohort, series ORDER BY count(*) DESC) AS rk,
                       row_number() OVER (PARTITION BY cohort, series ORDER BY count(*) DESC, days) AS n
                     FROM series GROUP BY 1,2,3)
               WHERE rk=1 AND n<=3 GROUP BY 1,2) m ON m.cohort=c.cohort AND m.series=s.series
    GROUP BY 1,2""",
)
_add("renewal_payment_errors", "SELECT cust AS subscription_id, errors AS payment_errors FROM errs")
_add(
    "frequency_changes",
    f"""SELECT cust AS subscription_id, {_stamp('happened')} AS changed_at, 'RE' || id AS renewal_id, freq AS frequency,
    prev AS previous_frequency FROM freqs""",
)
_add(
    "renewal_gap_enriched",
    f"""SELECT cohort, cust AS subscription_id, category, days AS days_between_orders, {_r('days/7.0')} AS weeks_between_orders,
    {_r('freq')} AS frequency_weeks, snooze, errors AS payment_errors, changed AS frequency_change_in_period,
    diff AS frequency_change_weeks FROM enriched""",
)
_add(
    "renewal_health_summary",
    _metrics(
        {
            "subscriptions": "n",
            "with_snooze": "s",
            "with_payment_errors": "e",
            "with_frequency_change": "c",
            "snooze_pct": _pct("s", "n"),
            "payment_errors_pct": _pct("e", "n"),
            "frequency_change_pct": _pct("c", "n"),
            "avg_frequency_change_weeks": "a",
        },
        """(SELECT cohort, count(*) AS n, SUM(snooze) AS s, count(*) FILTER (errors>0) AS e, count(*) FILTER (changed) AS c,
        COALESCE(AVG(diff),0) AS a FROM enriched GROUP BY 1)""",
        "cohort",
    ),
)
_add(
    "payment_error_ladder",
    """SELECT c.cohort, t.threshold, count(e.cust) AS subscriptions FROM (SELECT DISTINCT cohort FROM enriched) c
    CROSS JOIN (SELECT unnest([2,3,4,5,6,7,8,9,10]) AS threshold) t
    LEFT JOIN enriched e ON e.cohort=c.cohort AND e.errors>=t.threshold GROUP BY 1,2""",
)

# --- funnels ------------------------------------------------------------------

_add(
    "funnel_daily",
    f"""SELECT funnel, step_no, step, row_type, label, users,
    CASE WHEN n>1 THEN {_r('100.0*users/NULLIF(first_users,0)')} END AS pct_of_first,
    CASE WHEN n>1 THEN {_r('100.0*users/NULLIF(previous_users,0)')} END AS pct_of_previous FROM funneled""",
)
_add(
    "funnel_summary",
    f"""SELECT funnel, step_no, step, users, {_r('100.0*users/first_users')} AS pct_of_first FROM funneled WHERE row_type='total'""",
)

# --- repurchase ---------------------------------------------------------------


def _repurchase(rows: str, what: str) -> str:
    return f"""SELECT {what}, count(*) FILTER (n>1) AS repurchasers, count(*) AS users, CAST(SUM(n) AS BIGINT) AS orders,
    ROUND({_pct('count(*) FILTER (n>1)', 'count(*)')},2) AS repurchase_pct
    FROM (SELECT {what}, customer_id, count(*) AS n FROM ({rows}) GROUP BY 1,2) GROUP BY 1"""


_add("product_repurchase", _repurchase("SELECT brand AS product_name, customer_id, id FROM bought", "product_name"))
_add(
    "bundle_repurchase",
    _repurchase(
        "\nUNION ALL ".join(
            f"""SELECT '{" + ".join(sorted(b))}' AS combination, customer_id, id FROM bought WHERE brand IN {_in(b)}
        GROUP BY 1,2,3 HAVING count(*)={len(b)}"""
            for b in BUNDLES
        ),
        "combination",
    ),
)
_add(
    "first_order_cohort",
    f"""SELECT id AS order_id, customer_id, has_answers AS has_diagnostic, customs AS total_custom_orders,
    array_to_string(tracked, ',') AS tracked_items, {_stamp('created_at')} AS first_order_date FROM cohortkit""",
)
_outcome = f"""count(*) FILTER (customs>1) AS repurchased, count(*) FILTER (customs<=1) AS not_repurchased, count(*) AS total,
    {_r(_pct('count(*) FILTER (customs>1)', 'count(*)'))} AS repurchase_pct"""
_add("repurchase_by_answer", f"SELECT a.variable AS variable, a.value AS value, {_outcome} FROM given GROUP BY 1,2")
_add(
    "repurchase_by_answer_variants",
    f"""SELECT item, a.variable AS variable, a.value AS value, {_outcome}
    FROM (SELECT *, unnest(list_concat(['all'], [i FOR i IN {[str(i) for i in VARIANT_ITEMS]} IF list_contains(tracked, i)])) AS item
          FROM given) v GROUP BY 1,2,3""",
)
_add("repurchase_sample_size", "SELECT 'customers' AS metric, count(DISTINCT customer_id) AS value FROM bought")
_add(
    "repurchase_by_combination",
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS combination, {_outcome} FROM (SELECT id, customs FROM given WHERE {where} GROUP BY 1,2 HAVING count(*)=2)
    HAVING count(*)>0"""
        for name, where in {
            "current without reaction": "a.value IN ('CURRENT','NO')",
            "current with reaction": "a.value IN ('CURRENT','YES')",
            "never, kind A": "a.value IN ('NEVER','A')",
        }.items()
    ),
)
# The horizon is the same for both periods, but custom orders count from each period's start.
_period_rows = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS period, g.a.variable AS variable, g.a.value AS value, count(*) FILTER (k.n>1) AS r,
      count(*) FILTER (k.n<=1) AS nr, count(*) AS t
    FROM (SELECT * FROM given WHERE created_at BETWEEN '{s}' AND '{e}') g JOIN fo ON fo.id=g.id
    JOIN (SELECT customer_id, count(*) AS n FROM fo WHERE status<>'CANCELLED' AND created_at BETWEEN '{s}' AND '{END}'
          AND id IN (SELECT oid FROM items WHERE category IN ('PROMO','ECONOMY')) GROUP BY 1) k ON k.customer_id=fo.customer_id
    GROUP BY 1,2,3"""
    for name, (s, e) in PERIODS.items()
)
_add(
    "repurchase_period_table",
    f"""SELECT p.period, v.variable, v.value, COALESCE(t.r,0) AS repurchased, COALESCE(t.nr,0) AS not_repurchased,
    COALESCE(t.t,0) AS total,
    {_r(_pct('t.t', '(SELECT max(x.t) FROM (' + _period_rows + ') x WHERE x.period=p.period)'))} AS pct_of_max,
    {_r(_pct('t.t', '(SELECT SUM(x.t) FROM (' + _period_rows + ') x WHERE x.period=p.period AND x.variable=v.variable)'))} AS pct_of_variable,
    {_r(_pct('t.r', 't.t'))} AS repurchase_pct
    FROM (SELECT unnest({list(PERIODS)}) AS period) p CROSS JOIN (SELECT DISTINCT variable, value FROM ({_period_rows})) v
    LEFT JOIN ({_period_rows}) t ON t.period=p.period AND t.variable=v.variable AND t.value=v.value""",
)

_inv = f"""
 valid AS (SELECT * FROM fo WHERE status<>'CANCELLED'),
 sub1 AS (SELECT customer_id, min(created_at) AS happened FROM valid WHERE order_plan IN ('SUBSCRIPTION','MIXED') GROUP BY 1),
 facts AS (SELECT s.customer_id, CAST(s.happened AS DATE) AS cohort, a.n, a.revenue,
     a.revenue-(SELECT max(v.total) FROM valid v WHERE v.customer_id=s.customer_id AND v.created_at=s.happened
                AND v.order_plan IN ('SUBSCRIPTION','MIXED')) AS again,
     CAST(a.oto AS DATE) AS oto, p.status<>'CANCELLED' AS active_sub, CAST(c.happened AS DATE) AS gone, p.experience,
     GREATEST(a.n-1,0) AS re
   FROM sub1 s JOIN (SELECT customer_id, count(*) AS n, SUM(total) AS revenue, max(created_at) FILTER (order_plan='OTO') AS oto
                     FROM valid GROUP BY 1) a ON a.customer_id=s.customer_id
   JOIN people p ON p.cust=s.customer_id
   LEFT JOIN (SELECT cust, max(happened) AS happened FROM cancels GROUP BY 1) c ON c.cust=s.customer_id
   WHERE CAST(s.happened AS DATE) BETWEEN '{START}' AND '{END}'),
 act AS (SELECT *, active_sub OR COALESCE(oto>cohort AND oto >= (SELECT CAST(max(created_at) AS DATE) FROM valid WHERE order_plan='OTO') - 365, false)
     OR COALESCE(gone >= (SELECT CAST(max(created_at) AS DATE) FROM valid WHERE order_plan='OTO') - 90, false) AS active FROM facts),
 spl AS (SELECT unnest(CASE WHEN experience IS NULL THEN ['all'] ELSE ['all', experience] END) AS split, * FROM act)
SELECT s.split, {_day('m.m')} AS cohort_month, count(x.customer_id) AS new_users, CAST(COALESCE(SUM(x.n),0) AS BIGINT) AS orders,
   {_r('COALESCE(SUM(x.revenue),0)')} AS revenue, count(*) FILTER (x.n>=2) AS repurchasing_users,
   CAST(COALESCE(SUM(x.re),0) AS BIGINT) AS repurchase_orders, {_r('COALESCE(SUM(x.again),0)')} AS repurchase_revenue,
   count(*) FILTER (x.active) AS active_users, CAST(COALESCE(SUM(x.re) FILTER (x.active),0) AS BIGINT) AS active_repurchase_orders
FROM (SELECT unnest(['all','current','before','never']) AS split) s
CROSS JOIN (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS m) m
LEFT JOIN spl x ON x.split=s.split AND date_trunc('month', x.cohort)=m.m GROUP BY 1,2"""
_head = _sql("SELECT * FROM fo JOIN people JOIN cancels")
ORACLE_SQL["investor_cohorts"] = _head[: _head.rindex("\nSELECT * FROM fo")] + ",\n" + _inv

# --- cancellations ------------------------------------------------------------

_add(
    "cancellation_base",
    f"""SELECT cancel_id, cust AS subscription_id, reason, {_stamp('happened')} AS cancelled_at, oid AS order_id, order_number,
    array_to_string(listed, ',') AS listed_items, list_code AS segment_code, experience FROM xbase""",
)


def _by_reason(source: str, columns: dict[str, str], subscription: str = "cust") -> str:
    counts = "".join(f", count(*) FILTER ({w}) AS {n}" for n, w in columns.items())
    shares = ", ".join(
        f"ROUND({_pct(n, f'SUM({n}) OVER ()')},2) AS {n}_pct" for n in ["cancellations", *columns]
    )
    return f"""SELECT *, {shares} FROM (SELECT root AS reason, count(*) AS cancellations,
    count(DISTINCT {subscription}) AS subscriptions{counts} FROM {source} GROUP BY 1)"""


_add("cancel_by_reason_segment", _by_reason("xbase", {n: f"list_code={c}" for n, c in SEGMENTS.items()}))
_add(
    "cancel_by_reason_experience",
    _by_reason(
        "xbase",
        {
            "current": "experience='current'",
            "before": "experience='before'",
            "never": "experience='never'",
            "unknown": "experience='Unknown'",
        },
    ),
)
_add("cancel_by_last_order_segment", _by_reason("xlevel", {n: f"code={c}" for n, c in SEGMENTS.items()}))


def _reason_item(rows: str) -> str:
    return f"""SELECT segment, root AS reason, item_id, n AS cancellations,
    ROUND({_pct('n', 'SUM(n) OVER (PARTITION BY segment, item_id)')},2) AS share_pct FROM (
      SELECT r.segment, r.root, i.item_id, count(x.item) AS n FROM (SELECT DISTINCT segment, root FROM ({rows})) r
      CROSS JOIN (SELECT unnest({LISTED_ITEMS}) AS item_id) i
      LEFT JOIN ({rows}) x ON x.segment=r.segment AND x.root=r.root AND x.item=i.item_id GROUP BY 1,2,3)"""


_add(
    "cancel_by_reason_item",
    _reason_item(
        """SELECT unnest(CASE WHEN list_code IS NULL THEN ['all'] ELSE ['all','segment_' || list_code] END) AS segment, root, item
        FROM (SELECT *, unnest(listed) AS item FROM xbase)"""
    ),
)
_add(
    "cancel_by_last_order_item",
    _reason_item(
        f"""SELECT unnest(CASE WHEN any_code IS NULL THEN ['all'] ELSE ['all','segment_' || any_code] END) AS segment, root, item
        FROM (SELECT DISTINCT cust, happened, any_code, item, (SELECT min(y.root) FROM xlast y WHERE y.cust=z.cust AND y.happened=z.happened
                AND y.item IN {_in(LISTED_ITEMS)}) AS root FROM xlast z WHERE item IN {_in(LISTED_ITEMS)})"""
    ),
)
_active = f"""(SELECT s.item, p.list_code, COALESCE(p.experience,'Unknown') AS experience FROM people p
    JOIN (SELECT cust, min(item) AS item FROM sub_items WHERE item IN {_in(CALENDAR_ITEMS)} GROUP BY 1) s ON s.cust=p.cust
    WHERE p.cust IN (SELECT subscription_id FROM fo WHERE status<>'CANCELLED' AND created_at BETWEEN '{START}' AND '{END}'))"""
_add(
    "active_distribution",
    f"""SELECT dimension, label, n AS subscriptions, ROUND({_pct('n', 'SUM(n) OVER (PARTITION BY dimension)')},2) AS share_pct FROM (
    SELECT 'segment' AS dimension, l.label, count(a.item) AS n FROM (SELECT unnest(['segment_13','segment_14','segment_15','none']) AS label) l
      LEFT JOIN {_active} a ON COALESCE('segment_' || a.list_code,'none')=l.label GROUP BY 1,2
    UNION ALL SELECT 'item', CAST(l.i AS VARCHAR), count(a.item) FROM (SELECT unnest({CALENDAR_ITEMS}) AS i) l
      LEFT JOIN {_active} a ON a.item=l.i GROUP BY 1,2
    UNION ALL SELECT 'experience', l.label, count(a.item) FROM (SELECT unnest(['current','before','never','Unknown']) AS label) l
      LEFT JOIN {_active} a ON a.experience=l.label GROUP BY 1,2)""",
)
_add(
    "cancel_by_last_order",
    f"""SELECT cust AS subscription_id, root AS reason, {_stamp('happened')} AS cancelled_at, oid AS order_id, order_number,
    {_stamp('ordered_at')} AS ordered_at, any_code AS segment_code, item AS item_id FROM xlast""",
)
_add(
    "cancel_item_daily",
    f"""SELECT 'day' AS row_type, {_day('x.d')} AS label, t.product, CAST(COALESCE(SUM(r.n),0) AS BIGINT) AS cancellations,
      CAST(NULL AS DOUBLE) AS historic_share
    FROM (SELECT DISTINCT d FROM calrows) x CROSS JOIN (SELECT DISTINCT product FROM calrows) t
    LEFT JOIN calrows r ON r.d=x.d AND r.product=t.product GROUP BY 1,2,3
    UNION ALL SELECT 'total', 'Total', product, CAST(SUM(n) AS BIGINT), {_r('SUM(n)/(SELECT SUM(n) FROM calrows)')}
    FROM calrows GROUP BY product""",
)
_flag = "CASE WHEN (share-h)/h>0.4 THEN 'high' WHEN (share-h)/h<-0.4 THEN 'low' END"
_add(
    "cancel_item_calendar",
    f"""SELECT y AS year, row_type, mo AS month, product, CAST(n AS BIGINT) AS cancellations, {_r('share')} AS share,
    {_r('h')} AS historic_share, {_flag} AS flag FROM (
      SELECT l.*, CAST(n AS DOUBLE)/SUM(n) OVER (PARTITION BY y, row_type, mo) AS share,
        (SELECT CAST(SUM(c.n) AS DOUBLE) FROM calrows c WHERE c.product=l.product)/(SELECT SUM(n) FROM calrows) AS h FROM callevels l)""",
)
_add(
    "cancel_reason_calendar",
    f"""SELECT y AS year, row_type, mo AS month, reason, CAST(n AS BIGINT) AS cancellations, {_r('share')} AS share,
    {_r('h')} AS historic_share, CASE WHEN row_type='month' THEN {_flag} END AS flag FROM (
      SELECT l.*, (SELECT CAST(SUM(c.n) AS DOUBLE) FROM reasonrows c WHERE c.reason=l.reason)/(SELECT SUM(n) FROM reasonrows) AS h
      FROM (SELECT y, 'month' AS row_type, mo, reason, n, share FROM reasonmonth
            UNION ALL SELECT y, 'total', NULL, reason, SUM(n), NULL FROM reasonmonth GROUP BY 1,4
            UNION ALL SELECT y, 'mean', NULL, reason, NULL, AVG(share) FROM reasonmonth GROUP BY 1,4) l)""",
)

# --- promotions ---------------------------------------------------------------

_add(
    "promo_daily",
    f"SELECT {_day('d')} AS day, orders, discounted, {_r('pct')} AS discounted_pct FROM promoday",
)
_promo_months = """(SELECT date_trunc('month', d) AS m, SUM(orders) AS orders, SUM(discounted) AS discounted FROM promo GROUP BY 1)"""
_add(
    "promo_means",
    "\nUNION ALL ".join(
        f"SELECT '{c}_per_{u}' AS metric, {_r(f'AVG({c})')} AS value FROM {s}"
        for u, s in (("day", "promo"), ("month", _promo_months))
        for c in ("orders", "discounted")
    ),
)
_add(
    "promo_recent",
    f"""SELECT {_day('d')} AS day, discounted AS n, 'discounted' AS series FROM promo WHERE discounted IS NOT NULL AND d>='2001-06-01'
    UNION ALL SELECT {_day('d')}, orders, 'orders' FROM promo WHERE orders IS NOT NULL""",
)
_month_line = f"""orders, discounted, days, {_r(_ratio('orders', 'days'))} AS orders_per_day,
    {_r(_ratio('discounted', 'days'))} AS discounted_per_day, {_r(_pct('discounted', 'orders'))} AS discounted_pct"""
_add(
    "promo_monthly",
    f"""SELECT month, {_month_line} FROM promomonth UNION ALL SELECT 'TOTAL', {_month_line} FROM
    (SELECT CAST(SUM(orders) AS BIGINT) AS orders, CAST(SUM(discounted) AS BIGINT) AS discounted, CAST(SUM(days) AS BIGINT) AS days
     FROM promomonth)""",
)
_trend = f"""(SELECT month, {_pct('discounted', 'orders')} AS y, row_number() OVER (ORDER BY month)-1 AS x FROM promomonth)"""
_add(
    "trend_line",
    f"""SELECT month, {_r('y')} AS discounted_pct,
    {_r('x*(SELECT regr_slope(y,x) FROM ' + _trend + ')+(SELECT regr_intercept(y,x) FROM ' + _trend + ')')} AS trend FROM {_trend}""",
)

# --- baskets ------------------------------------------------------------------

_add(
    "basket_value",
    f"""SELECT subscribed, order_number, {_stamp('happened')} AS created_at, {_r('amount')} AS total_amount, {_r('units')} AS units
    FROM basket WHERE happened>'{BEFORE}' AND happened<'{AFTER}'""",
)
_period = f"(date_diff('day', DATE '{BEFORE}', DATE '{AFTER}')+1)"
_kinds = f"""(SELECT t.*, n/days AS per_day, o.c/{_period} AS all_per_day, SUM(n) OVER (PARTITION BY t.subscribed) AS every
    FROM kindtotals t JOIN (SELECT l_linestatus='O' AS subscribed, count(*) AS c FROM lineitem WHERE l_returnflag<>'R' GROUP BY 1) o
    ON o.subscribed=t.subscribed)"""
_common = {"avg_amount": "avg_amount", "avg_units": "avg_units", "per_day": "per_day"}
_add(
    "basket_summary",
    _metrics(
        {**_common, "all_orders_per_day": "all_per_day", "share_of_all_orders": "per_day/all_per_day"},
        f"(SELECT * FROM {_kinds} WHERE kind='orders')",
        "subscribed, kind",
    )
    + "\nUNION ALL "
    + _metrics(
        {**_common, "conversion": "(every-n)/every"}, f"(SELECT * FROM {_kinds} WHERE kind='attempts')", "subscribed, kind"
    ),
)


def _histogram(edges: list[int], subscribed: bool) -> str:
    labels = [f"{a} - {b}" for a, b in zip(edges, edges[1:])] + [f"> {edges[-1]}"]
    ladder = "CASE " + " ".join(f"WHEN amount<={e} THEN {i}" for i, e in enumerate(edges[1:])) + f" ELSE {len(edges)-1} END"
    flag = str(subscribed).lower()
    return f"""SELECT {flag} AS subscribed, t.kind, b.bin, {labels}[b.bin+1] AS label, count(k.amount) AS baskets,
    {_r('AVG(k.amount)')} AS avg_amount, {_r('count(k.amount)/any_value(t.days)')} AS per_day,
    {_r('count(k.amount)/any_value(t.n)')} AS share
    FROM (SELECT * FROM kindtotals WHERE subscribed={flag}) t CROSS JOIN (SELECT unnest(range({len(labels)})) AS bin) b
    LEFT JOIN (SELECT kind, amount, {ladder} AS bin FROM kinds WHERE subscribed={flag}) k ON k.kind=t.kind AND k.bin=b.bin
    GROUP BY t.kind, b.bin"""


_add(
    "basket_histogram",
    _histogram([0, 20, 35, 50, 65, 80, 95], False) + "\nUNION ALL " + _histogram([0, 15, 30, 45, 60, 75, 90], True),
)
_add(
    "basket_units",
    f"""SELECT k.subscribed, k.kind, {_r('k.units')} AS units, count(*) AS baskets, {_r('AVG(k.amount)')} AS avg_amount,
    {_r('count(*)/any_value(t.days)')} AS per_day, {_r('count(*)/any_value(t.n)')} AS share
    FROM kinds k JOIN kindtotals t ON t.kind=k.kind AND t.subscribed=k.subscribed GROUP BY 1,2,3""",
)

# --- reviews ------------------------------------------------------------------

_zone = "CASE doc_id%3 WHEN 0 THEN 'Z' WHEN 1 THEN '-05:00' ELSE '' END"
_add(
    "verified_reviews",
    f"""SELECT CASE WHEN lang='en' THEN 'Item ' || source ELSE 'Product ' || lang END AS product, sku,
    CAST(doc_id AS VARCHAR) AS order_id, lang AS headline, text AS comment, 'User ' || doc_id AS nickname,
    'user' || doc_id || '@example.com' AS email, CASE WHEN rating=5 THEN 10 ELSE 8 END AS recommendation,
    CAST(rating AS INT) AS overallrating, d1 || 'T23:30:00' || {_zone} AS date FROM verified""",
)
_add(
    "verified_reviews_summary",
    f"SELECT 'reviews' AS metric, {_r('count(*)')} AS value FROM rev UNION ALL SELECT 'verified_reviews', {_r('count(*)')} FROM verified",
)
_posted = _stamp("(CAST(d1 || ' 23:30:00' AS TIMESTAMP) + CASE WHEN doc_id%3=1 THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END)")
_type = """CASE WHEN doc_id%5=0 THEN '07' WHEN doc_id%5=1 THEN '12' WHEN doc_id%5=2 AND 5000+doc_id<=5400 THEN '02' ELSE '01' END"""
_add(
    "review_load_set",
    f"""SELECT 'REV' || upper(substr(sha256(concat_ws(chr(1), upper(sku), 'user' || doc_id || '@example.com',
      d1 || 'T23:30:00' || CASE doc_id%3 WHEN 0 THEN 'Z' WHEN 1 THEN '-05:00' ELSE '' END, COALESCE(lang, chr(2)),
      COALESCE(text, chr(2)))), 1, 29)) AS id, 'store' AS created_by, 'PRT' || repeat('0',27) || {_type} AS product_review_type_id, lang AS headline,
    trim(text, ' ') AS comment, 'User' AS nickname, 'user' || doc_id || '@example.com' AS email,
    CASE upper(sku) WHEN 'KIT1' THEN '{{"mainImage": "https://img.example.com/kit.jpg"}}'
                    WHEN 'X3' THEN '{{"mainImage": "https://img.example.com/x3.jpg"}}' END AS additional_fields,
    '["good"]' AS pros, 'a:0:{{}}' AS cons, CASE WHEN rating=5 THEN 10 ELSE 8 END AS recommendation, 0 AS visible,
    CAST(rating AS INT) AS overall_rating, {_posted} AS review_date, {_posted} AS created_at FROM verified""",
)

# --- trackers -----------------------------------------------------------------

_reasons = "(SELECT DISTINCT ' ' || upper(o_orderpriority) AS second FROM orders)"
_segments = ",".join(f"{{'first':'{n}','value':{n}_pct}}" for n in SEGMENTS)
_pairs = [(v, a) for v in dict.fromkeys((*VARIABLE_LABELS.values(), "OTHER")) for a in dict.fromkeys((*VALUE_LABELS.values(), "NONE "))]
_add(
    "tracker_merge",
    f"""SELECT 'answers' AS sheet, m.first, m.second, t.repurchase_pct AS value
    FROM (VALUES {", ".join(f"('{v}','{a}')" for v, a in _pairs)}) m(first, second)
    LEFT JOIN (SELECT variable, value, ROUND(repurchase_pct,2) AS repurchase_pct FROM ({_BODIES["repurchase_by_answer"]})) t
      ON t.variable=m.first AND t.value=trim(m.second)
    UNION ALL
    SELECT 'segments', m.first, m.second, t.cell.value
    FROM (SELECT second, unnest({[*SEGMENTS, "segment_99"]}) AS first FROM {_reasons}) m
    LEFT JOIN (SELECT reason, unnest([{_segments}]) AS cell FROM ({_BODIES["cancel_by_reason_segment"]})) t
      ON t.cell.first=m.first AND t.reason=trim(m.second)
    UNION ALL
    SELECT 'items', m.name, m.second, t.share_pct
    FROM (SELECT second, unnest({[f"ITEM {i}" for i in LISTED_ITEMS] + ["Item10", "ITEM 9999"]}) AS name FROM {_reasons}) m
    LEFT JOIN (SELECT * FROM ({_BODIES["cancel_by_reason_item"]}) WHERE segment='all') t
      ON CAST(t.item_id AS VARCHAR)=regexp_extract(m.name,'[0-9]+') AND t.reason=trim(m.second)""",
)


def _metrics(name: str, keys: list[str], measures: list[str], where: str = "true") -> str:
    cells = ",".join(f"{{'m':'{m}','v':CAST({m} AS DOUBLE)}}" for m in measures)
    metric = " || '.' || ".join([*[f"CAST({k} AS VARCHAR)" for k in keys], "u.m"])
    return f"""SELECT {metric} AS metric, u.v AS value FROM (SELECT *, unnest([{cells}]) AS u
      FROM ({_BODIES.get(name, ORACLE_SQL[name])}) WHERE {where}) WHERE u.v IS NOT NULL"""


_total = "row_type='total'"
_SECTIONS = {
    "orders": _metrics("daily_orders_kpi", ["segment"], ORDER_MEASURES, _total),
    "sales": _metrics("daily_sales_split", [], ["daily_no_recurrent", "daily_recurrent"], _total),
    "payments": _metrics("payment_error_daily", [], ["daily_errors", "daily_resolved"], _total),
    "program": _BODIES["program_snapshot"],
    "subscriptions": _BODIES["subscription_mix"],
    "refills": _BODIES["category_refill"],
    "survey": _BODIES["acquisition_survey"],
    "addons": _metrics("addon_subscriptions", ["addon"], ["subscriptions"]),
    "upsize": _metrics("upsize_attach", ["addon"], UPSIZE_MEASURES),
    "funnels": _metrics("funnel_summary", ["funnel", "step"], ["users"]),
}


def _tracked(period: str, section: str, factor: int = 1) -> str:
    return f"""SELECT '{period}' AS period, '{section}' AS section, metric, value*{factor} AS value FROM ({_SECTIONS[section]})"""


_add("kpi_tracker", "\nUNION ALL ".join(_tracked(TRACKED_PERIOD, name) for name in _SECTIONS))
_add(
    "kpi_tracker_update",
    "\nUNION ALL ".join(
        [_tracked(TRACKED_PERIOD, "survey"), _tracked(TRACKED_PERIOD, "addons", 2), _tracked("2002", "addons", 2)]
    ),
)

# The same tables, read from files or kept in a folder.
for _name, _same in {
    "kpi_tracker_store": "kpi_tracker_update",
    "review_load_twice": "review_load_set",
    "blocked_payment_files": "blocked_payments_daily",
    "payment_attempt_file": "payment_recovery_by_card",
    "funnel_files": "funnel_daily",
    "review_documents": "verified_reviews",
    "enriched_review_file": "review_load_set",
}.items():
    ORACLE_SQL[_name] = ORACLE_SQL[_same]
