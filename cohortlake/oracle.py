"""DuckDB-dialect SQL twins of the registered queries (the correctness oracle).

Each oracle statement is ``WITH <needed views> <query>``; the views below are
the fixture relations of FIXTURES.md section 4 plus the typed / clean /
feature relations, written independently of the Spark code.  Types are cast
to Spark's (``SUM`` -> BIGINT, day differences -> INTEGER).
"""

from __future__ import annotations

import re

FEB, MAR = "2001-01-31", "2001-02-28"

VIEWS: dict[str, str] = {}


def view(name: str, body: str) -> None:
    VIEWS[name] = body.strip()


# ----------------------------------------------------------------- fixtures
view("n_sub", "SELECT CAST(COUNT(*) / 5 AS BIGINT) AS n FROM customer")
view("subs", "SELECT DISTINCT c_custkey % n AS sub FROM customer CROSS JOIN n_sub")


def _labels_sql(start: str, end: str) -> str:
    return f"""
WITH b AS (SELECT DISTINCT o_custkey % n AS sub FROM orders CROSS JOIN n_sub
           WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'),
     l AS (SELECT s.sub, CASE WHEN b.sub IS NULL THEN 1 ELSE 0 END AS is_churn
           FROM subs s LEFT JOIN b ON s.sub = b.sub)
SELECT CAST(sub AS VARCHAR) AS msno, CAST(is_churn AS INTEGER) AS is_churn FROM l
UNION ALL SELECT CAST(sub AS VARCHAR), 1 FROM l WHERE sub % 50 = 0
UNION ALL SELECT CAST(sub AS VARCHAR), 2 FROM l WHERE sub % 60 = 0
UNION ALL SELECT '  ', 0 FROM l WHERE sub = 0"""


view("raw_train", _labels_sql("2001-02-01", "2001-05-01"))
view("raw_train_v2", _labels_sql("2001-03-01", "2001-05-29"))
view("raw_members", """
WITH f AS (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_order FROM orders GROUP BY o_custkey)
SELECT CASE WHEN c_custkey % 53 = 0 OR c_mktsegment = 'BUILDING' OR (c_custkey % n) % 8 = 0 THEN '  ' ELSE CAST(c_custkey % n AS VARCHAR) END AS msno,
       CAST(c_nationkey AS INTEGER) AS city,
       CAST(c_custkey % 80 AS INTEGER) AS bd,
       CASE WHEN c_custkey % 3 = 0 THEN 'male' WHEN c_custkey % 3 = 1 THEN 'female' END AS gender,
       CAST(c_custkey % 5 + 3 AS INTEGER) AS registered_via,
       CASE WHEN c_custkey % 41 = 0 THEN '20010231'
            ELSE REPLACE(CAST(first_order AS VARCHAR), '-', '') END AS registration_init_time
FROM customer CROSS JOIN n_sub LEFT JOIN f ON c_custkey = o_custkey""")
view("raw_transactions", """
WITH t AS (
  SELECT l_orderkey, CASE WHEN l_orderkey % 107 = 0 THEN NULL ELSE CAST(o_custkey % n AS VARCHAR) END AS msno,
         CAST(l_partkey % 41 AS INTEGER) AS payment_method_id, CAST(30 AS INTEGER) AS payment_plan_days,
         CAST(l_quantity AS INTEGER) AS plan_list_price, CAST(l_quantity AS INTEGER) AS actual_amount_paid,
         CAST(CASE WHEN l_orderkey % 211 = 0 THEN 2 WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INTEGER) AS is_auto_renew,
         CASE WHEN l_orderkey % 89 = 0 THEN '20010231'
              ELSE REPLACE(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') END AS transaction_date,
         CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE REPLACE(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '-', '') END
           AS membership_expire_date,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS is_cancel
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey CROSS JOIN n_sub),
d AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE l_orderkey % 101 = 0)
SELECT msno, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid, is_auto_renew,
       transaction_date, membership_expire_date, is_cancel FROM d""")
view("raw_user_logs", """
WITH t AS (
  SELECT event_id, CASE WHEN event_id % 79 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS msno,
         CASE WHEN event_id % 83 = 0 THEN '20010231'
              ELSE REPLACE(CAST(CAST(ts AS DATE) - 8377 - CASE WHEN event_id % 10 <= user_id % 10 THEN 0 ELSE 400 END AS VARCHAR), '-', '') END AS date,
         CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_type = 'error' THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS num_25,
         CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS BIGINT) AS num_50,
         CAST(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS BIGINT) AS num_75,
         CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS num_985,
         CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS num_100,
         CAST(1 AS BIGINT) AS num_unq,
         CASE WHEN event_id % 97 = 0 THEN -value WHEN event_id % 103 = 0 THEN NULL ELSE value END AS total_secs
  FROM events),
d AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE event_id % 73 = 0)
SELECT msno, date, num_25, num_50, num_75, num_985, num_100, num_unq, total_secs FROM d""")

# ----------------------------------------------------------------- typed
PARSE = "CAST(try_strptime({x}, '%Y%m%d') AS DATE)"
view("typed_members", f"SELECT *, {PARSE.format(x='registration_init_time')} AS registration_date FROM raw_members")
view("typed_transactions", f"""
SELECT msno, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid, is_auto_renew,
       transaction_date AS transaction_date_raw, membership_expire_date AS membership_expire_date_raw, is_cancel,
       {PARSE.format(x='transaction_date')} AS transaction_date,
       {PARSE.format(x='membership_expire_date')} AS membership_expire_date
FROM raw_transactions""")
view("typed_user_logs", f"""
SELECT msno, date AS event_date_raw, num_25, num_50, num_75, num_985, num_100, num_unq, total_secs,
       {PARSE.format(x='date')} AS event_date
FROM raw_user_logs""")

# ----------------------------------------------------------------- clean
# Rules on single rows come after equal rows are one group; the latest member is a maximum.
VALID_KEY = "msno IS NOT NULL AND TRIM(msno) <> ''"
for _name, _raw in (("labels_february", "raw_train"), ("labels_march", "raw_train_v2")):
    view(_name, f"""
SELECT msno, CAST(MAX(is_churn) AS INTEGER) AS is_churn FROM {_raw}
WHERE {VALID_KEY} AND is_churn IN (0, 1) GROUP BY msno""")
view("members", f"SELECT msno, MAX(registration_date) AS registration_date FROM typed_members GROUP BY msno HAVING {VALID_KEY}")
view("transactions", f"""
SELECT * EXCLUDE (transaction_date_raw, membership_expire_date_raw) FROM typed_transactions GROUP BY ALL
HAVING {VALID_KEY} AND is_auto_renew IN (0, 1) AND is_cancel IN (0, 1)
   AND transaction_date IS NOT NULL AND membership_expire_date IS NOT NULL""")
view("user_logs", f"""
SELECT * EXCLUDE (event_date_raw) FROM typed_user_logs GROUP BY ALL
HAVING {VALID_KEY} AND event_date IS NOT NULL AND total_secs >= 0
   AND list_min([num_25, num_50, num_75, num_985, num_100, num_unq]) >= 0
   AND list_count([num_25, num_50, num_75, num_985, num_100, num_unq]) = 6""")


# ----------------------------------------------------------------- features
def _subscribers(labels: str, cutoff: str) -> str:
    """One row per label: everything known of a subscriber is stacked, then summed in one grouping, without joins.

    A column is filled by one of the stacked relations only, so its aggregates see that relation's rows.
    """
    age = f"DATE '{cutoff}' - {{}} BETWEEN 0 AND {{}}".format
    return f"""
SELECT msno, MAX(is_churn) AS is_churn, CAST(DATE '{cutoff}' - MAX(registration_date) AS INTEGER) AS membership_tenure_days,
       COUNT(transaction_date) AS transaction_count_90, AVG(is_auto_renew) AS auto_renew_rate_90,
       COUNT(*) FILTER (is_cancel = 1) AS cancellation_count_90,
       CAST(DATE '{cutoff}' - MAX(transaction_date) AS INTEGER) AS days_since_last_transaction,
       CAST(MAX(membership_expire_date) - DATE '{cutoff}' AS INTEGER) AS days_until_expiration,
       COUNT(DISTINCT event_date) AS active_days_30, SUM(total_secs) AS total_secs_30,
       CAST(DATE '{cutoff}' - MAX(event_date) AS INTEGER) AS days_since_last_listen
FROM (FROM {labels}
      UNION ALL BY NAME FROM members
      UNION ALL BY NAME FROM transactions WHERE {age("transaction_date", 89)}
      UNION ALL BY NAME FROM user_logs WHERE {age("event_date", 29)}) stacked
GROUP BY msno HAVING COUNT(is_churn) > 0"""


for _cohort, _labels, _cut in (("february", "labels_february", FEB), ("march", "labels_march", MAR)):
    _all = f"{_cohort}_subscribers"
    view(_all, _subscribers(_labels, _cut))
    view(f"{_cohort}_membership", f"SELECT msno, membership_tenure_days FROM {_all}")
    view(f"{_cohort}_transactions", f"""
SELECT msno, COLUMNS('_90$|_transaction$|_expiration$') FROM {_all} WHERE transaction_count_90 > 0""")
    view(f"{_cohort}_listening", f"SELECT msno, COLUMNS('_30$|_listen$') FROM {_all} WHERE active_days_30 > 0")
    view(f"{_cohort}_features", f"""
SELECT * REPLACE (IFNULL(auto_renew_rate_90, 0) AS auto_renew_rate_90, IFNULL(total_secs_30, 0) AS total_secs_30),
       CAST(transaction_count_90 = 0 AS INTEGER) AS no_recent_transaction, CAST(active_days_30 = 0 AS INTEGER) AS no_recent_listening
FROM {_all}""")

ENGAGEMENT = """CASE WHEN no_recent_listening = 1 THEN 'No recent listening'
     WHEN active_days_30 >= 20 THEN 'Highly active'
     WHEN active_days_30 >= 5 THEN 'Moderately active'
     ELSE 'Low activity' END"""
RENEWAL = """CASE WHEN no_recent_transaction = 1 THEN 'No recent transaction'
     WHEN auto_renew_rate_90 >= 0.5 THEN 'Mostly auto-renew'
     ELSE 'Mostly manual renewal' END"""

# Hash bucket, same formula as Spark's: first 15 hex digits of SHA-256.
BUCKET = "(('0x' || substr(sha256({k}), 1, 15))::BIGINT % {m})"


def bucket(k: str = "msno", m: int = 100) -> str:
    return BUCKET.format(k=k, m=m)


# ----------------------------------------------------------------- assembly
_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(body: str) -> set:
    words = set(_IDENT.findall(body))
    return {w for w in words if w in VIEWS}


def with_views(query: str) -> str:
    """Prefix ``query`` with every view it (transitively) references, in order."""
    order: list = []
    seen: set = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in sorted(_deps(VIEWS[name]) - {name}):
            visit(d)
        order.append(name)

    if query.lstrip().upper().startswith("WITH"):
        query = f"SELECT * FROM (\n{query}\n) q_"
    for name in sorted(_deps(query)):
        visit(name)
    if not order:
        return query.strip()
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in order)
    return f"WITH {ctes}\n{query.strip()}"
