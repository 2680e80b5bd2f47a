"""Views over the given tables, as SQL text that reads the same in Spark and DuckDB.

Each view covers its whole base table. The arithmetic on keys only decides which rows get which
defect (null e-mail, malformed number, missing legacy row, …), so the operators meet every case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS = {
    "notif": """
SELECT concat('m', event_id) AS message_id,
       CASE WHEN event_id % 9 = 0 THEN 'orders' WHEN event_id % 10 = 9 THEN NULL ELSE 'member' END AS table_name,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type,
       ts AS event_ts,
       CASE event_id % 8
         WHEN 0 THEN concat('["', user_id, '","', user_id + 1, '"]')
         WHEN 1 THEN concat('[', user_id, ',', user_id, ']')
         WHEN 2 THEN concat('{{"record_ids":["', user_id, '","x', user_id, '"],"record_id":"0"}}')
         WHEN 3 THEN concat('{{"record_id":"', user_id, '"}}')
         WHEN 4 THEN concat('{{"record_id":', user_id, '}}')
         WHEN 5 THEN '[]'
         WHEN 6 THEN 'not json'
         ELSE '{{"other":1}}' END AS payload
FROM {events}""",
    "notif_dup": """
SELECT * FROM {notif} UNION ALL SELECT * FROM {notif} WHERE payload = '[]' OR message_id LIKE '%7'""",
    "src_member": """
SELECT concat(c_custkey, '') AS record_id,
       c_name AS name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            WHEN c_custkey % 7 = 1 THEN concat(lower(c_mktsegment), c_custkey)
            ELSE concat(lower(c_mktsegment), c_custkey, '@example.com') END AS email,
       CASE WHEN c_custkey % 29 = 0 THEN 'n/a' WHEN c_custkey % 31 = 0 THEN 'NaN'
            ELSE concat(CAST(c_acctbal AS DECIMAL(18,2)), '') END AS balance,
       concat(c_nationkey, CASE WHEN c_custkey % 37 = 0 THEN 'x' ELSE '' END) AS nation_key,
       CASE c_custkey % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN NULL ELSE 'UPSERT' END AS op_type,
       CASE WHEN c_custkey % 11 = 0 THEN 'TRUE' WHEN c_custkey % 13 = 0 THEN '1' ELSE 'false' END AS is_deleted
FROM {customer}""",
    "aws_member": """
SELECT concat(c_custkey, '') AS user_id,
       CASE WHEN c_custkey % 13 = 0 THEN upper(c_name) ELSE c_name END AS user_name,
       CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN NULL
            WHEN c_custkey % 7 = 1 THEN concat(lower(c_mktsegment), c_custkey)
            ELSE concat(lower(c_mktsegment), c_custkey, '@example.com') END AS user_email
FROM {customer} WHERE c_custkey % 17 <> 0
UNION ALL SELECT concat(c_custkey, ''), c_name, NULL FROM {customer} WHERE c_custkey % 23 = 0
UNION ALL SELECT concat('legacy-', c_custkey), c_name, NULL FROM {customer} WHERE c_custkey % 41 = 0""",
    "cdc_log": """
SELECT concat(user_id, '') AS record_id, event_id AS seq, ts AS change_ts,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
       value AS amount
FROM {events}""",
    "run_log": """
SELECT DISTINCT CASE WHEN event_type = 'signup' THEN 'users' ELSE 'orders' END AS table_name,
       CAST(ts AS DATE) AS run_date, 'SUCCESS' AS status FROM {events}
WHERE event_type = 'signup' OR (event_type = 'error' AND day(ts) % 3 <> 0)""",
    # Text form of all order lines, as a legacy file export holds them.
    "src_line": """
SELECT concat(l_orderkey, '-', l_linenumber) AS record_id,
       concat(l_orderkey, '') AS order_id,
       concat(l_partkey, CASE WHEN l_partkey % 97 = 0 THEN '.5' ELSE '' END) AS part_id,
       CASE WHEN l_suppkey % 89 = 0 THEN 'n/a'
            ELSE concat(CAST(l_quantity AS DECIMAL(18,2)), '') END AS quantity,
       concat(CAST(l_extendedprice AS DECIMAL(18,2)), '') AS price,
       concat(CAST(l_discount AS DECIMAL(18,2)), '') AS discount,
       CASE l_returnflag WHEN 'R' THEN 'TRUE' WHEN 'A' THEN '1' ELSE 'false' END AS is_returned,
       l_returnflag AS return_flag,
       l_linestatus AS line_status
FROM {lineitem}""",
    # Source and legacy copy of all orders with lost rows and changed values.
    "src_order": """
SELECT concat(o_orderkey, '') AS record_id, concat(o_custkey, '') AS customer_id,
       o_orderstatus AS status, concat(CAST(o_totalprice AS DECIMAL(18,2)), '') AS total,
       o_orderpriority AS priority
FROM {orders}""",
    "aws_order": """
SELECT concat(o_orderkey, '') AS id, concat(o_custkey, '') AS cust,
       CASE WHEN o_orderkey % 43 = 0 THEN 'X' ELSE o_orderstatus END AS state,
       concat(CAST(o_totalprice AS DECIMAL(18,2)), CASE WHEN o_custkey % 53 = 0 THEN '0' ELSE '' END) AS amount,
       CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE o_orderpriority END AS prio
FROM {orders} WHERE o_orderkey % 101 <> 0
UNION ALL SELECT concat(o_orderkey, ''), concat(o_custkey, ''), o_orderstatus, '0', NULL
FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'""",
}

MEMBER_MAPPING = {"users": {"user_id": "record_id", "user_name": "name", "user_email": "email"}}
ORDER_MAPPING = {
    "orders": {"id": "record_id", "cust": "customer_id", "state": "status", "amount": "total", "prio": "priority"}
}
DEPENDENCIES = {
    "users": ["snapshot_previous_day"],
    "orders": [],
    "refined_orders": [{"condition": "snapshot_previous_day", "requires": "orders"}],
}


def _needs(name: str) -> list[str]:
    return [v for v in VIEWS if f"{{{v}}}" in VIEWS[name]]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a view over it."""
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    inputs = [n for n in (*BASE_TABLES, *VIEWS) if f"{{{n}}}" in text]
    return spark.sql(text, **{n: load(spark, sf_dir, n) for n in inputs})


def with_views(body: str, *names: str) -> str:
    """DuckDB text: ``body`` with the named views in front as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _needs(name):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    plain = {n: n for n in (*BASE_TABLES, *VIEWS)}
    parts = [f"{n} AS ({VIEWS[n].format(**plain)})" for n in ordered]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def messages(spark: SparkSession, sf_dir: str, view: str = "notif") -> DataFrame:
    """The notifications in message form: attributes without nulls, and the payload.

    The event time is epoch milliseconds for odd events and ISO text with a zone for even ones.
    """
    rows = load(spark, sf_dir, view)
    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    number = F.substring(F.col("message_id"), 2, 20).cast("bigint")
    stamp = F.when(number % 2 == 0, F.concat(F.col("event_ts").cast("string"), F.lit("Z"))).otherwise(
        F.expr(f"CAST(timestampdiff(MILLISECOND, {epoch}, event_ts) AS STRING)")
    )
    entries = F.array(
        F.struct(F.lit("message_id").alias("key"), F.col("message_id").alias("value")),
        F.struct(F.lit("table_name").alias("key"), F.col("table_name").alias("value")),
        F.struct(F.lit("event_type").alias("key"), F.col("event_type").alias("value")),
        F.struct(F.lit("event_timestamp").alias("key"), stamp.alias("value")),
    )
    kept = F.filter(entries, lambda e: e["value"].isNotNull())
    return rows.select(F.map_from_entries(kept).alias("attributes"), "payload")


# Event time of a message in microseconds, as ``messages`` states it.
MESSAGE_MICROS = """CASE WHEN CAST(substr(message_id, 2) AS BIGINT) % 2 = 0 THEN epoch_us(event_ts)
            ELSE (epoch_us(event_ts) // 1000) * 1000 END"""
