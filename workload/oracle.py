"""The same queries as SQL for an independent engine, over views named like the tables."""

from __future__ import annotations

from workload.inputs import AS_OF, CHANGED_AT, RUN_TS, SECOND_RUN_TS

PRICE = "CAST(o_totalprice AS DECIMAL(10,2))"

RAW = f"""
versions AS (
  SELECT *, 0 AS version FROM orders
  UNION ALL
  SELECT *, 1 AS version FROM orders WHERE o_orderkey % 11 = 0
),
raw AS (
  SELECT
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS order_id,
    CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS customer_id,
    CAST(CASE WHEN o_orderkey % 53 = 0 THEN NULL
              WHEN o_orderkey % 29 = 0 THEN -{PRICE}
              ELSE {PRICE} END + version AS DECIMAL(10,2)) AS amount,
    CASE WHEN version = 1 THEN 'shipped'
         WHEN o_orderkey % 5 <> 0 THEN lower(o_orderstatus) END AS status,
    CASE WHEN o_orderkey % 61 <> 0 THEN o_orderdate END AS created_at,
    o_orderdate + version * INTERVAL '1' DAY AS updated_at
  FROM versions
)"""

LATER = """
later AS (
  SELECT order_id, customer_id,
    CASE WHEN order_id % 7 = 0 THEN CAST(-amount AS DECIMAL(10,2)) ELSE amount END AS amount,
    CASE WHEN order_id % 2 = 0 THEN 'returned' ELSE status END AS status,
    created_at, updated_at
  FROM raw
  WHERE order_id IS NULL OR order_id % 3 <> 0
)"""

CHANGED = f"""
later AS (
  SELECT order_id, customer_id,
    CASE WHEN order_id % 18 = 0 THEN CAST(-amount AS DECIMAL(10,2)) ELSE amount END AS amount,
    CASE WHEN order_id % 9 = 0 THEN 'returned' ELSE status END AS status,
    created_at,
    CASE WHEN order_id % 9 = 0 THEN TIMESTAMP '{CHANGED_AT}' ELSE updated_at END AS updated_at
  FROM raw
  UNION ALL
  SELECT -order_id, customer_id, amount, status, created_at, TIMESTAMP '{CHANGED_AT}'
  FROM raw WHERE order_id % 50 = 0
)"""

RAW_COLUMNS = "order_id, customer_id, amount, status, created_at, updated_at"
SILVER = """order_id, customer_id, order_timestamp, total_amount, order_status,
  silver_processed_at"""


def audited(source: str, run_ts: str) -> str:
    return f"""
    SELECT {RAW_COLUMNS}, TIMESTAMP '{run_ts}' AS ingested_at,
           'postgres_ecom' AS source_system
    FROM {source}"""


def latest(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id
      ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST,
               amount DESC NULLS LAST, customer_id DESC NULLS LAST,
               status DESC NULLS LAST) AS rn
    FROM {source}) ranked
  WHERE rn = 1
)"""


def conformed(run_ts: str) -> str:
    return f"""
    created_at AS order_timestamp,
    CAST(amount AS DECIMAL(10,2)) AS total_amount,
    CASE WHEN status IS NULL THEN 'UNKNOWN' ELSE upper(status) END AS order_status,
    TIMESTAMP '{run_ts}' AS silver_processed_at"""


def classified(source: str, name: str, run_ts: str) -> str:
    return f"""
{name} AS (
  SELECT *,
    CASE WHEN order_id IS NULL THEN 'Missing order_id'
         WHEN customer_id IS NULL THEN 'Missing customer_id'
         WHEN total_amount IS NULL OR total_amount < 0 THEN 'Negative or null total_amount'
         WHEN order_timestamp IS NULL OR order_timestamp > TIMESTAMP '{AS_OF}'
           THEN 'Invalid or future order_date'
    END AS quarantine_reason
  FROM (SELECT {RAW_COLUMNS}, ingested_at, source_system, {conformed(run_ts)}
        FROM {source}) typed
)"""


def bronze(source: str, name: str, run_ts: str) -> str:
    return f"\n{name} AS ({audited(source, run_ts)}\n)"


CLEANED = ",".join(
    [RAW, bronze("raw", "bronze", RUN_TS), latest("bronze", "newest"),
     classified("newest", "outcome", RUN_TS)]
)
TWO_RUNS = ",".join(
    [CLEANED, LATER, bronze("later", "bronze2", SECOND_RUN_TS),
     latest("bronze2", "newest2"), classified("newest2", "outcome2", SECOND_RUN_TS)]
)
SECOND_CHANGED = ",".join(
    [CLEANED, CHANGED, bronze("later", "bronze2", SECOND_RUN_TS),
     latest("bronze2", "newest2"), classified("newest2", "outcome2", SECOND_RUN_TS)]
)
REJECTED_COLUMNS = f"""{RAW_COLUMNS}, {{audit}}order_timestamp, total_amount, order_status,
  silver_processed_at, quarantine_reason"""


def rejected(audit: bool, source: str = "outcome", run_ts: str = RUN_TS) -> str:
    columns = REJECTED_COLUMNS.format(audit="ingested_at, source_system, " if audit else "")
    return f"""
SELECT {columns}, TIMESTAMP '{run_ts}' AS quarantined_at
FROM {source} WHERE quarantine_reason IS NOT NULL"""


def silver(source: str = "outcome") -> str:
    return f"SELECT {SILVER} FROM {source} WHERE quarantine_reason IS NULL"


def changed_gold(runs: str) -> str:
    """Gold after a second run that leaves rows alone of which it says nothing new."""
    return f"""
WITH {runs}, first_gold AS ({silver()}), second_silver AS ({silver("outcome2")})
SELECT s.order_id, s.customer_id, s.order_timestamp, s.total_amount, s.order_status,
  CASE WHEN f.order_id IS NOT NULL AND f.customer_id IS NOT DISTINCT FROM s.customer_id
            AND f.order_timestamp IS NOT DISTINCT FROM s.order_timestamp
            AND f.total_amount IS NOT DISTINCT FROM s.total_amount
            AND f.order_status IS NOT DISTINCT FROM s.order_status
       THEN f.silver_processed_at ELSE s.silver_processed_at END AS silver_processed_at
FROM second_silver s LEFT JOIN first_gold f ON f.order_id = s.order_id
UNION ALL
SELECT * FROM first_gold f
WHERE NOT EXISTS (SELECT 1 FROM second_silver s WHERE s.order_id = f.order_id)"""


UPSERT = f"""
target AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, {PRICE} AS total_amount,
         o_orderstatus AS order_status
  FROM orders WHERE o_orderkey % 10 < 8
),
updates AS (
  SELECT o_orderkey AS order_id, o_custkey + 1 AS customer_id,
         CAST({PRICE} + 10 AS DECIMAL(10,2)) AS total_amount,
         lower(o_orderstatus) AS order_status
  FROM orders WHERE o_orderkey % 10 >= 6
)"""

MERGED = f"""
WITH {UPSERT}
SELECT * FROM updates
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.order_id = t.order_id)"""

DATED = f"""
{UPSERT},
dated_target AS (
  SELECT t.*, o_orderdate AS updated_at FROM target t JOIN orders ON o_orderkey = t.order_id
),
dated_updates AS (
  SELECT u.*, o_orderdate + (o_orderkey % 3 - 1) * INTERVAL '1' DAY AS updated_at
  FROM updates u JOIN orders ON o_orderkey = u.order_id
),
later AS (
  SELECT u.* FROM dated_updates u LEFT JOIN dated_target t ON t.order_id = u.order_id
  WHERE t.order_id IS NULL OR u.updated_at > t.updated_at
)"""

EVENTS = """
WITH outcome AS (
  SELECT *,
    CASE WHEN event_id IS NULL THEN 'Missing event_id'
         WHEN user_id IS NULL OR user_id % 50 = 0 THEN 'Internal user'
         WHEN value IS NULL OR value < 1 THEN 'Value below 1'
         WHEN ts IS NULL OR ts > TIMESTAMP '2024-01-25 00:00:00' THEN 'After cut-off'
    END AS quarantine_reason
  FROM events
)"""

REPORT = """
SELECT coalesce(quarantine_reason, 'clean') AS outcome, count(*) AS n_rows
FROM outcome GROUP BY 1"""

BRONZE = f"WITH {RAW} {audited('raw', RUN_TS)}"
GOLD_FIRST = f"WITH {CLEANED} {silver()}"

ORACLE = {
    "bronze_orders": BRONZE,
    "bronze_snapshot": BRONZE,
    "managed_table_snapshot": BRONZE,
    "bronze_preview": f"""
SELECT source_system, count(*) AS n_rows, count(*) AS n_in_bronze
FROM ({BRONZE} LIMIT 5) some_rows GROUP BY source_system""",
    "dedupe_latest_orders": f"""
WITH {RAW}, {latest("raw", "newest")}
SELECT {RAW_COLUMNS} FROM newest""",
    "dedupe_latest_window": f"""
WITH {RAW}, {latest("raw", "newest")}
SELECT {RAW_COLUMNS} FROM newest""",
    "dedupe_keep_null_keys": f"""
WITH {RAW}, {latest("raw", "newest")}
SELECT {RAW_COLUMNS} FROM newest WHERE order_id IS NOT NULL
UNION ALL
SELECT {RAW_COLUMNS} FROM raw WHERE order_id IS NULL""",
    "dedupe_composite_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_partkey, l_suppkey
    ORDER BY l_shipdate DESC NULLS LAST, l_orderkey DESC NULLS LAST,
             l_linenumber DESC NULLS LAST, l_quantity DESC NULLS LAST,
             l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
             l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST,
             l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) ranked
WHERE rn = 1""",
    "conform_orders": f"WITH {RAW} SELECT {RAW_COLUMNS}, {conformed(RUN_TS)} FROM raw",
    "conform_text_orders": f"""
WITH written AS (
  SELECT o_orderkey AS order_id,
    CASE WHEN o_orderkey % 53 = 0 THEN 'abc'
         WHEN o_orderkey % 31 = 0 THEN '123456789.00'
         WHEN o_orderkey % 29 = 0 THEN '-' || CAST({PRICE} AS VARCHAR)
         ELSE CAST({PRICE} AS VARCHAR) END AS amount,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
         WHEN o_orderkey % 7 = 0 THEN ''
         WHEN o_orderkey % 3 = 0 THEN ' f '
         ELSE lower(o_orderstatus) END AS status,
    CASE WHEN o_orderkey % 61 = 0 THEN 'garbage'
         WHEN o_orderkey % 59 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123'
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created_at
  FROM orders
)
SELECT *, try_strptime(created_at, '%Y-%m-%d %H:%M:%S') AS order_timestamp,
  TRY_CAST(amount AS DECIMAL(10,2)) AS total_amount,
  coalesce(upper(status), 'UNKNOWN') AS order_status
FROM written""",
    "silver_orders": f"""
WITH {RAW}, {latest("raw", "newest")}, outcome AS (
  SELECT {conformed(RUN_TS)}, order_id, customer_id FROM newest
)
SELECT {SILVER} FROM outcome
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
  AND total_amount IS NOT NULL AND total_amount >= 0
  AND order_timestamp IS NOT NULL AND order_timestamp <= TIMESTAMP '{AS_OF}'""",
    "quarantine_orders": f"WITH {CLEANED} {rejected(audit=False)}",
    "quarantine_preview": f"""
WITH {CLEANED}
SELECT order_id, customer_id, total_amount, quarantine_reason
FROM outcome WHERE quarantine_reason IS NOT NULL
ORDER BY order_id NULLS FIRST LIMIT 5""",
    "quality_report": f"WITH {CLEANED} {REPORT}",
    "quality_totals_orders": f"""
WITH {CLEANED}
SELECT count(*) FILTER (WHERE quarantine_reason IS NULL) AS n_clean,
       count(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS n_rejected
FROM outcome""",
    "quarantine_append_rerun": f"""
WITH {CLEANED}, once AS ({rejected(audit=False)})
SELECT *, false AS empty_append_wrote FROM (SELECT * FROM once UNION ALL SELECT * FROM once) twice""",
    "quarantine_append_same_run": f"""
WITH {CLEANED}, once AS ({rejected(audit=False)})
SELECT once.*, run_id
FROM once, (VALUES ('01'), ('1'), ('a'), ('a/b'), ('2024-01-01'), ('12:30:00')) runs(run_id)""",
    "events_quality_split": f"""
{EVENTS}
SELECT event_id, ts, user_id, event_type, value, quarantine_reason,
  CASE WHEN quarantine_reason IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' END
    AS quarantined_at
FROM outcome""",
    "events_quality_report": EVENTS + REPORT,
    "events_latest_per_user": """
SELECT event_id, ts, user_id, event_type, value, props
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) ranked
WHERE rn = 1""",
    "documents_quality_split": """
SELECT doc_id, upper(lang) AS language, CAST(n_chars AS DECIMAL(12,0)) AS size,
  CAST(length(text) AS INTEGER) AS n_text,
  CASE WHEN text IS NULL THEN 'Missing text'
       WHEN n_chars IS NULL OR n_chars < 200 THEN 'Too short'
       WHEN coalesce(upper(lang), 'UNKNOWN') <> 'EN' THEN 'Not in English'
  END AS quarantine_reason
FROM documents""",
    "customer_conform": f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  coalesce(upper(c_mktsegment), 'UNKNOWN') AS segment,
  CAST(c_acctbal AS DECIMAL(12,1)) AS balance, TIMESTAMP '{RUN_TS}' AS processed_at
FROM customer""",
    "gold_bootstrap": GOLD_FIRST,
    "gold_merge_upsert": MERGED,
    "gold_merge_unique_target": MERGED,
    "gold_merge_some_columns": f"""
WITH {UPSERT}
SELECT t.order_id, t.customer_id, coalesce(u.total_amount, t.total_amount) AS total_amount,
       t.order_status
FROM target t LEFT JOIN updates u ON u.order_id = t.order_id
UNION ALL
SELECT * FROM updates u WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.order_id = u.order_id)""",
    "gold_merge_null_keys": f"""
WITH {UPSERT},
t AS (
  SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN order_id END AS order_id) FROM target
),
u AS (
  SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN order_id END AS order_id) FROM updates
)
SELECT * FROM u
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.order_id = t.order_id)""",
    "gold_merge_many_per_key": """
WITH updates AS (
  SELECT o_orderkey AS l_orderkey, lower(o_orderstatus) AS l_linestatus,
         o_orderdate AS l_shipdate
  FROM orders WHERE o_orderkey % 3 = 0
)
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity,
  CASE WHEN u.l_orderkey IS NULL THEN l.l_linestatus ELSE u.l_linestatus END AS l_linestatus,
  CASE WHEN u.l_orderkey IS NULL THEN l.l_shipdate ELSE u.l_shipdate END AS l_shipdate
FROM lineitem l LEFT JOIN updates u ON u.l_orderkey = l.l_orderkey
UNION ALL
SELECT u.l_orderkey, NULL, NULL, u.l_linestatus, u.l_shipdate
FROM updates u
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = u.l_orderkey)""",
    "gold_merge_idempotent": MERGED,
    "gold_table_upsert": MERGED,
    "gold_bucketed_table_upsert": MERGED,
    "gold_rebucket": MERGED,
    "gold_merge_newer_only": f"""
WITH {DATED}
SELECT * FROM later
UNION ALL
SELECT * FROM dated_target t WHERE NOT EXISTS (SELECT 1 FROM later u WHERE u.order_id = t.order_id)""",
    "gold_merge_delete_missing": f"""
WITH {UPSERT}
SELECT * FROM updates
UNION ALL
SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN order_id END AS order_id) FROM target t
WHERE order_status = 'P' AND (order_id % 7 = 0 OR NOT EXISTS (
  SELECT 1 FROM updates u WHERE u.order_id = t.order_id))""",
    "gold_table_mark_missing": f"""
WITH {DATED}
SELECT *, true AS is_current FROM later
UNION ALL
SELECT t.*, EXISTS (SELECT 1 FROM updates u WHERE u.order_id = t.order_id) AS is_current
FROM dated_target t WHERE NOT EXISTS (SELECT 1 FROM later u WHERE u.order_id = t.order_id)""",
    "gold_bucketed_delete_missing": f"""
WITH {DATED}
SELECT * FROM later
UNION ALL
SELECT * FROM dated_target t
WHERE NOT EXISTS (SELECT 1 FROM later u WHERE u.order_id = t.order_id)
  AND EXISTS (SELECT 1 FROM updates u WHERE u.order_id = t.order_id)""",
    "gold_preview_topk": f"{GOLD_FIRST} ORDER BY order_timestamp, order_id LIMIT 10",
    "layers_end_to_end": GOLD_FIRST,
    "layers_second_run": f"""
WITH {TWO_RUNS}, first_gold AS ({silver()}), second_silver AS ({silver("outcome2")})
SELECT * FROM second_silver
UNION ALL
SELECT * FROM first_gold f
WHERE NOT EXISTS (SELECT 1 FROM second_silver s WHERE s.order_id = f.order_id)""",
    "layers_second_run_bucketed": f"""
WITH {TWO_RUNS}, first_gold AS ({silver()}), second_silver AS ({silver("outcome2")})
SELECT * FROM second_silver
UNION ALL
SELECT * FROM first_gold f
WHERE NOT EXISTS (SELECT 1 FROM second_silver s WHERE s.order_id = f.order_id)""",
    "gold_three_schemas": """
WITH third AS (SELECT * FROM orders WHERE o_orderkey % 10 >= 8)
SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 10 >= 8 THEN o_custkey + 5000000000
       WHEN o_orderkey % 10 = 6 THEN o_custkey
       ELSE o_custkey % 30000 END AS customer_id,
  CASE WHEN o_orderkey % 10 >= 8 THEN CAST(o_totalprice AS DECIMAL(14,4))
       ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DECIMAL(14,4)) END AS total_amount,
  CASE WHEN o_orderkey % 10 = 6 THEN o_orderstatus END AS status
FROM orders WHERE o_orderkey % 10 <> 7""",
    "dedupe_window_counted": f"""
WITH {RAW}, {latest("raw", "newest")},
counted AS (SELECT order_id, count(*) AS n_versions FROM raw GROUP BY order_id)
SELECT n.order_id, n.amount, c.n_versions
FROM newest n JOIN counted c ON c.order_id IS NOT DISTINCT FROM n.order_id""",
    "layers_profile": f"""
WITH {TWO_RUNS}, silver AS ({silver()} UNION ALL {silver("outcome2")})
SELECT 'order_id' AS column_name, count(*) AS n_rows, count(*) - count(order_id) AS n_null,
       count(DISTINCT order_id) AS n_exact, true AS distinct_is_near,
       CAST(NULL AS BOOLEAN) AS median_is_near, CAST(min(order_id) AS VARCHAR) AS least
FROM silver
UNION ALL
SELECT 'customer_id', count(*), count(*) - count(customer_id), count(DISTINCT customer_id),
       true, NULL, CAST(min(customer_id) AS VARCHAR)
FROM silver
UNION ALL
SELECT 'total_amount', count(*), count(*) - count(total_amount), count(DISTINCT total_amount),
       true, true, CAST(min(total_amount) AS VARCHAR)
FROM silver
UNION ALL
SELECT 'order_status', count(*), count(*) - count(order_status), count(DISTINCT order_status),
       true, NULL, NULL
FROM silver""",
    "layers_arrivals": GOLD_FIRST,
    "layers_changed_only": changed_gold(TWO_RUNS),
    "layers_changed_only_bucketed": changed_gold(TWO_RUNS),
    "layers_incremental_run": changed_gold(SECOND_CHANGED),
    "orders_relational_rules": f"""
WITH {CLEANED}, judged AS (
  SELECT *,
    count(*) OVER (PARTITION BY customer_id, order_timestamp) AS n_same,
    count(*) FILTER (order_status = 'F') OVER (PARTITION BY customer_id) AS n_finished,
    count(*) OVER (PARTITION BY customer_id) AS n_rows,
    customer_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3) AS is_known
  FROM outcome
)
SELECT order_id, customer_id,
  CASE WHEN order_id IS NULL THEN 'Missing order_id'
       WHEN customer_id IS NOT NULL AND NOT is_known THEN 'Unknown customer'
       WHEN total_amount IS NULL OR total_amount < 0 THEN 'Negative or null total_amount'
       WHEN customer_id IS NOT NULL AND order_timestamp IS NOT NULL AND n_same > 1
         THEN 'Same customer and time'
       WHEN n_finished * 100 > n_rows * 60 THEN 'Too many finished'
  END AS quarantine_reason
FROM judged""",
    "quarantine_replay": f"""
WITH {CLEANED}
{silver()}
UNION ALL
SELECT order_id, customer_id, order_timestamp, total_amount, order_status,
       TIMESTAMP '{SECOND_RUN_TS}' AS silver_processed_at
FROM outcome
WHERE quarantine_reason = 'Negative or null total_amount'
  AND order_timestamp <= TIMESTAMP '{AS_OF}'""",
    "layers_row_balance": f"""
WITH {CLEANED}, totals AS (
  SELECT (SELECT count(*) FROM bronze) AS n_read,
         (SELECT count(*) FROM bronze WHERE order_id IS NULL) AS n_no_key,
         count(*) AS n_kept,
         count(*) FILTER (order_id IS NULL) AS n_kept_no_key,
         count(*) FILTER (quarantine_reason IS NULL) AS n_clean
  FROM outcome
)
SELECT n_read, n_clean, n_kept - n_clean AS n_rejected,
       (n_read - n_no_key) - (n_kept - n_kept_no_key) AS n_superseded,
       n_no_key - n_kept_no_key AS n_collapsed
FROM totals""",
    "layers_second_run_quarantine": f"""
WITH {TWO_RUNS}
{rejected(audit=True)}
UNION ALL
{rejected(audit=True, source="outcome2", run_ts=SECOND_RUN_TS)}""",
    "gold_flagship_topk": f"""
WITH {CLEANED}, clean_orders AS ({silver()}), older AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_timestamp,
         {PRICE} AS total_amount, upper(o_orderstatus) AS order_status,
         TIMESTAMP '2000-12-31 00:00:00' AS silver_processed_at
  FROM orders WHERE o_orderkey % 3 = 0
)
SELECT * FROM (
  SELECT * FROM clean_orders
  UNION ALL
  SELECT * FROM older o
  WHERE NOT EXISTS (SELECT 1 FROM clean_orders c WHERE c.order_id = o.order_id)) gold
ORDER BY order_timestamp, order_id LIMIT 10""",
}
