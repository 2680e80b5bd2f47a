"""DuckDB SQL with the result each query must have, over the given tables."""

from __future__ import annotations

from fixtures import MESSAGE_MICROS, with_views

# Notifications of the member table with their ids (null when malformed), read with JSON functions.
IDS = f"""note AS (
  SELECT message_id, coalesce(event_type, 'update') AS event_type, payload, event_ts,
         {MESSAGE_MICROS} AS event_us,
         CASE WHEN NOT json_valid(payload) THEN NULL
              WHEN json_type(payload) = 'ARRAY' THEN json_extract_string(payload, '$[*]')
              WHEN json_type(payload) <> 'OBJECT' THEN NULL
              WHEN json_exists(payload, '$.record_ids') THEN json_extract_string(payload, '$.record_ids[*]')
              WHEN json_exists(payload, '$.record_id') THEN [json_extract_string(payload, '$.record_id')]
         END AS ids
  FROM notif WHERE table_name = 'member'),
pair AS (SELECT message_id, event_type, event_us, unnest(list_distinct(ids)) AS id FROM note WHERE ids IS NOT NULL)"""
OP = "CASE WHEN lower(is_deleted) = 'true' THEN 'delete' ELSE coalesce(op_type, 'upsert') END"
RECORDS = f"""{IDS},
rec AS (SELECT p.message_id, p.event_type, p.event_us, s.*, {OP} AS event_op
        FROM pair p JOIN src_member s ON s.record_id = p.id)"""
LEGACY = "leg AS (SELECT user_id AS record_id, user_name AS name, user_email AS email FROM aws_member)"
LEGACY_COUNT = "legn AS (SELECT record_id, count(*) AS n FROM leg GROUP BY 1)"
DIFF_COLUMNS = """concat_ws(',', CASE WHEN g.email IS DISTINCT FROM a.email THEN 'email' END,
                        CASE WHEN g.name IS DISTINCT FROM a.name THEN 'name' END)"""
ORDER_LEGACY = "oleg AS (SELECT id AS record_id, cust AS customer_id, state AS status, amount AS total, prio AS priority FROM aws_order)"
ORDER_DIFF = f"""{ORDER_LEGACY},
odiff AS (
  SELECT record_id, columns, count(*) AS pairs FROM (
    SELECT g.record_id, concat_ws(',', CASE WHEN g.customer_id IS DISTINCT FROM a.customer_id THEN 'customer_id' END,
           CASE WHEN g.priority IS DISTINCT FROM a.priority THEN 'priority' END,
           CASE WHEN g.status IS DISTINCT FROM a.status THEN 'status' END,
           CASE WHEN g.total IS DISTINCT FROM a.total THEN 'total' END) AS columns
    FROM src_order g JOIN oleg a USING (record_id)) WHERE columns <> '' GROUP BY 1, 2)"""


def _encode(*columns: str) -> str:
    """The field encoding of fingerprints: length and value, or a mark for null."""
    return "concat(" + ", ".join(f"CASE WHEN {c} IS NULL THEN '~' ELSE concat(length({c}), ':', {c}) END" for c in columns) + ")"


def _long(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '[+-]?[0-9]+') THEN CAST({column} AS BIGINT) END"


def _double(column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE)"


LINE_COLUMNS = (
    "record_id",
    "order_id",
    "part_id",
    "quantity",
    "price",
    "discount",
    "is_returned",
    "return_flag",
    "line_status",
)
LINE_CHECKS = {
    "not_null(record_id,return_flag)": "record_id IS NOT NULL AND return_flag IS NOT NULL",
    "regex(part_id)": "regexp_full_match(coalesce(part_id, ''), '[0-9]+')",
    "range(quantity)": "coalesce(TRY_CAST(quantity AS DOUBLE) BETWEEN 5 AND 45, false)",
    "unique(record_id)": "count(*) OVER (PARTITION BY record_id) = 1",
    "cheap": "coalesce(price IS NOT NULL AND discount <> '0.10', false)",
}
LINE_FLAGS = "flag AS (SELECT *, " + ", ".join(f'{c} AS ok{i}' for i, c in enumerate(LINE_CHECKS.values())) + " FROM src_line)"
LINE_OK = " AND ".join(f"ok{i}" for i in range(len(LINE_CHECKS)))

REFINED = f"""spend AS (SELECT concat(o_custkey, '') AS record_id, count(*) AS n_orders,
          sum(CAST(o_totalprice AS DECIMAL(18,2))) AS order_total FROM orders GROUP BY 1),
place AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"""
REFINED_COLUMNS = f"""m.record_id, p.n_name AS nation_name, p.r_name AS region_name,
       CASE WHEN contains(m.email, '@') THEN split_part(m.email, '@', -1) END AS email_domain,
       CASE WHEN isnan(TRY_CAST(m.balance AS DOUBLE)) THEN NULL
            ELSE CAST(TRY_CAST(m.balance AS DOUBLE) AS DECIMAL(18,2)) END AS balance_value,
       m.event_op <> 'delete' AS is_active, coalesce(s.n_orders, 0) AS n_orders,
       coalesce(s.order_total, 0) AS order_total"""
REFINED_JOINS = f"""LEFT JOIN place p ON p.n_nationkey = {_long('m.nation_key')}
     LEFT JOIN spend s ON s.record_id = m.record_id"""
KPIS = """SELECT coalesce(region_name, 'UNKNOWN') AS region_name, count(*) AS members,
       count(*) FILTER (is_active) AS active_members,
       count(*) FILTER (email_domain IS NOT NULL) AS reachable_members,
       CAST(sum(balance_value) AS DOUBLE) AS total_balance, CAST(sum(n_orders) AS BIGINT) AS n_orders,
       CAST(sum(order_total) AS DOUBLE) AS order_total FROM ref GROUP BY 1"""

WANTED = """wanted AS (SELECT table_name, run_date FROM (SELECT DISTINCT CAST(ts AS DATE) AS run_date FROM events),
             (VALUES ('users'), ('orders'), ('refined_orders')) t(table_name)),
need AS (SELECT table_name, run_date, 'snapshot_previous_day' AS condition,
                CASE table_name WHEN 'users' THEN 'users' ELSE 'orders' END AS requires,
                CAST(run_date - INTERVAL 1 DAY AS DATE) AS required_date
         FROM wanted WHERE table_name <> 'orders')"""
NEED_DONE = """SELECT 1 FROM run_log r WHERE r.table_name = n.requires AND r.run_date = n.required_date AND r.status = 'SUCCESS'"""
NEED_COLUMNS = "table_name, CAST(run_date AS VARCHAR) AS run_date, condition, requires, CAST(required_date AS VARCHAR) AS required_date"
GATE_TABLE = "CASE event_type WHEN 'view' THEN 'users' WHEN 'click' THEN 'refined_orders' ELSE 'orders' END"

CUTOFF = "TIMESTAMP '2024-01-16 00:00:00'"
INCREMENTAL = f"""SELECT record_id, seq, op, amount FROM cdc_log
WHERE (change_ts, seq) > (SELECT (change_ts, seq) FROM cdc_log WHERE change_ts < {CUTOFF} ORDER BY change_ts DESC, seq DESC LIMIT 1)"""

HOURS = """SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS VARCHAR) AS window_start, event_type, count(*) AS n
FROM events {where} GROUP BY 1, 2"""
CLOSED = """HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE"""
HOURS_CLOSED = """SELECT CAST(w AS VARCHAR) AS window_start, event_type, count(*) AS n
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type FROM events {where}) GROUP BY w, event_type
HAVING w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE"""
LATE = "ts < TIMESTAMP '2024-01-11 00:00:00' AND event_type = 'error'"

# Part d of the stream, windows w of a day, open for three more. A window has passed in part d if an earlier part has a row at
# or behind its end; part 4 is the end of the stream.
PANES = f"""WITH e AS (
  SELECT CASE WHEN {LATE} OR (ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-21' AND event_type = 'view' AND hour(ts) >= 12) THEN 2
              WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 3 END AS d,
         date_trunc('day', ts)::TIMESTAMP AS w, event_type, ts FROM events),
seen AS (SELECT t.d, (SELECT max(ts) FROM e WHERE e.d < t.d) AS mark FROM range(5) t(d)),
s AS (SELECT e.d, w, event_type, coalesce(mark >= w + INTERVAL 1 DAY, false) AS passed, count(*) AS n
      FROM e JOIN seen ON e.d = seen.d WHERE mark IS NULL OR mark < w + INTERVAL 4 DAY GROUP BY e.d, w, event_type, mark),
p AS (SELECT w, event_type, d, CASE WHEN passed THEN 'LATE' ELSE 'EARLY' END AS pane, n FROM s WHERE passed OR {{early}}
      UNION ALL
      SELECT w, event_type, max(d) + 0.5, 'ON_TIME', sum(CASE WHEN {{early}} THEN 0 ELSE n END)::BIGINT
      FROM s WHERE NOT passed AND w + INTERVAL 1 DAY <= (SELECT max(ts) FROM e) GROUP BY w, event_type)
SELECT CAST(w AS VARCHAR) AS window_start, event_type, pane,
       row_number() OVER (PARTITION BY w, event_type ORDER BY d) - 1 AS number, n FROM p"""

ZONE_ROWS = f"""SELECT message_id, record_id, email, {_double('balance')} AS balance, {_long('nation_key')} AS nation_key,
       event_op, 'analytics' AS zone FROM rec WHERE record_id IS NOT NULL AND email IS NOT NULL"""
AUDIT_ID = f"md5({_encode("'member'", "'raw'", 'message_id', 'record_id')})"
AUDIT_ROW = f"""SELECT {AUDIT_ID} AS log_id, 'member_raw' AS pipeline_name, 'member' AS domain, 'raw' AS zone,
       'member' AS table_name, 'SUCCESS' AS status FROM rec"""
BATCH = f"""{RECORDS},
m AS (SELECT r.* FROM rec r WHERE EXISTS (SELECT 1 FROM run_log l WHERE l.table_name = 'users'
        AND l.run_date = CAST(make_timestamp(r.event_us) AS DATE) - 1)),
{REFINED}, ref AS (SELECT {REFINED_COLUMNS} FROM m {REFINED_JOINS})"""


def _log_tables() -> str:
    zones = "(VALUES ('raw'), ('structure'), ('refined'), ('analytics')) z(zone)"
    return with_views(
        f""", {RECORDS}, {LEGACY}, {LEGACY_COUNT},
good AS (SELECT * FROM rec WHERE record_id IS NOT NULL AND email IS NOT NULL),
inzone AS (SELECT 'raw' AS zone, rec.* FROM rec
           UNION ALL SELECT z.zone, good.* FROM good, {zones} WHERE z.zone <> 'raw'),
stage AS (SELECT zone, count(*) AS n, count(*) FILTER (email IS NOT NULL) AS ok FROM inzone GROUP BY 1),
cnt AS (SELECT zone, count(*) AS gcp, CAST(sum(coalesce(n, 0)) AS BIGINT) AS aws, bool_and(coalesce(n, 0) = 1) AS ok
        FROM inzone LEFT JOIN legn USING (record_id) GROUP BY 1),
diff AS (SELECT DISTINCT g.zone, g.record_id, {DIFF_COLUMNS} AS columns FROM inzone g JOIN leg a USING (record_id)),
smp AS (SELECT zone, least(5, count(*)) AS k FROM diff WHERE columns <> '' GROUP BY 1)
SELECT 'pipeline_log' AS log, zone, 'member' AS table_name, concat('SUCCESS {{"records":', n, '}}') AS content FROM stage
UNION ALL SELECT 'pipeline_log', concat(zone, '_dq'), 'member', concat('SUCCESS {{"records":', ok, '}}') FROM stage
UNION ALL SELECT 'data_quality_log', zone, 'member',
       concat('not_null(record_id,email) ', n = ok, ' {{"n_passed":', ok, ',"n_failed":', n - ok, '}}') FROM stage
UNION ALL SELECT 'reconcile_log', zone, 'member', concat(gcp, '/', aws, '/', ok, '/', coalesce(k, 0)) FROM cnt LEFT JOIN smp USING (zone)
""".replace("{{", "{").replace("}}", "}").replace("\n,", ","),
        "notif",
        "src_member",
        "aws_member",
    )


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}

    def put(key: str, body: str, *views: str, ctes: str = "") -> None:
        if views:
            q[key] = with_views((f", {ctes} " if ctes else "") + body, *views)
        else:
            q[key] = (f"WITH {ctes} " if ctes else "") + body.strip()

    # sources and sinks
    put("notification_source", "SELECT message_id, table_name, payload FROM notif_dup", "notif_dup")
    put("dedup_notifications", "SELECT DISTINCT message_id, payload FROM notif_dup", "notif_dup")
    put("event_time", f"SELECT message_id, {MESSAGE_MICROS} AS event_us FROM notif", "notif")
    put("table_read", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
    put("zone_write_readback", "SELECT record_id, customer_id, status, total FROM src_order", "src_order")
    put(
        "raw_append",
        """SELECT CAST(b AS BIGINT) AS batch_id, message_id, record_id, email, event_op, 'member' AS table_name, 'raw' AS zone
           FROM rec, (VALUES (0), (1)) t(b)""",
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    put("snapshot_binary_scan", "SELECT count(*) AS n_lines FROM aws_order", "aws_order")
    put("snapshot_jsonl_scan", "SELECT user_id, user_name, user_email FROM aws_member", "aws_member")
    put("snapshot_typed_scan", "SELECT user_id, user_name, user_email FROM aws_member", "aws_member")
    put("snapshot_listing", "SELECT DISTINCT 'state=' || state AS folder FROM aws_order ORDER BY 1 LIMIT 2", "aws_order")
    put("snapshot_changes", "SELECT 'state=P' AS folder, unnest(['added', 'gone']) AS change")
    put("snapshot_changed_rows", "SELECT id, amount FROM aws_order WHERE state = 'P'", "aws_order")
    put("json_sink_readback", "SELECT record_id, part_id, quantity, price, is_returned FROM src_line", "src_line")
    put("audit_records", AUDIT_ROW, "notif", "src_member", ctes=RECORDS)
    put(
        "audit_json",
        f"""SELECT concat('{{"log_id":"', log_id, '","pipeline_name":"', pipeline_name, '","domain":"', domain, '","zone":"', zone,
                  '","table_name":"', table_name, '","status":"', status, '"}}') AS value FROM ({AUDIT_ROW})""",
        "notif",
        "src_member",
        ctes=RECORDS,
    )

    # projections
    put("notification_filter", "SELECT message_id, payload FROM notif WHERE table_name = 'member'", "notif")
    put(
        "parsed_notifications",
        """SELECT message_id, event_type, 'member' AS table_name, array_to_string(ids, ',') AS ids, event_us, payload AS content
           FROM note WHERE ids IS NOT NULL""",
        "notif",
        ctes=IDS,
    )
    put(
        "notification_dead_letter",
        "SELECT message_id, event_type, payload AS content FROM note WHERE ids IS NULL",
        "notif",
        ctes=IDS,
    )
    names = ("record_id", "name", "email", "balance", "nation_key", "op_type", "is_deleted")
    put(
        "row_to_string_map",
        " UNION ALL ".join(f"SELECT record_id, '{n}' AS column_name, {n} AS column_value FROM src_member" for n in names),
        "src_member",
    )
    put(
        "classified_changes",
        "SELECT message_id, record_id, event_op, 'unknown' AS table_name, 'raw' AS zone FROM rec",
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    put(
        "typed_lines",
        f"""SELECT record_id, {_long('order_id')} AS order_id, {_long('part_id')} AS part_id, {_double('quantity')} AS quantity,
                  {_double('price')} AS price, lower(is_returned) = 'true' AS is_returned, line_status,
                  concat_ws(',', CASE WHEN {_long('part_id')} IS NULL THEN 'part_id' END,
                            CASE WHEN {_double('quantity')} IS NULL THEN 'quantity' END) AS cast_failed FROM src_line""",
        "src_line",
    )
    put("schema_map", f"SELECT * FROM oleg", "aws_order", ctes=ORDER_LEGACY)
    put(
        "schema_registry_apply",
        """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
           FROM orders""",
    )
    put("row_fingerprint", f"SELECT record_id, md5({_encode(*LINE_COLUMNS)}) AS fingerprint FROM src_line", "src_line")
    member_ref = f"m AS (SELECT *, {OP} AS event_op FROM src_member), {REFINED}, ref AS (SELECT {REFINED_COLUMNS} FROM m {REFINED_JOINS})"
    put(
        "refined_member",
        """SELECT record_id, nation_name, region_name, email_domain, CAST(balance_value AS DOUBLE) AS balance_value, is_active,
                  n_orders, CAST(order_total AS DOUBLE) AS order_total FROM ref""",
        "src_member",
        ctes=member_ref,
    )
    put("analytics_member", KPIS, "src_member", ctes=member_ref)

    # joins
    put(
        "fetched_rows",
        "SELECT message_id, event_type, record_id, name, email, balance FROM rec",
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    put(
        "lookup_semi",
        "SELECT record_id, name, email FROM src_member WHERE record_id IN (SELECT id FROM pair)",
        "notif",
        "src_member",
        ctes=IDS,
    )
    put(
        "native_key_fetch",
        """SELECT message_id, concat(o_custkey, '') AS record_id, o_orderkey, o_totalprice
           FROM pair JOIN orders ON concat(o_custkey, '') = id""",
        "notif",
        ctes=IDS,
    )

    # reconciliation
    put(
        "reconcile_counts",
        """SELECT message_id, record_id, CAST(1 AS BIGINT) AS gcp_count, coalesce(n, 0) AS aws_count, coalesce(n, 0) = 1 AS count_match
           FROM rec LEFT JOIN legn USING (record_id)""",
        "notif",
        "src_member",
        "aws_member",
        ctes=f"{RECORDS}, {LEGACY}, {LEGACY_COUNT}",
    )
    put(
        "reconcile_diff",
        f"""SELECT record_id, columns, count(*) AS pairs FROM (
              SELECT g.record_id, {DIFF_COLUMNS} AS columns FROM src_member g JOIN leg a USING (record_id))
            WHERE columns <> '' GROUP BY 1, 2""",
        "src_member",
        "aws_member",
        ctes=LEGACY,
    )
    put("reconcile_diff_orders", "SELECT record_id, columns, pairs FROM odiff", "src_order", "aws_order", ctes=ORDER_DIFF)
    put(
        "reconcile_variant_diff",
        """SELECT record_id, columns, count(*) AS pairs FROM (
             SELECT g.record_id, concat_ws(',', CASE WHEN balance IS NOT NULL THEN 'balance' END,
               CASE WHEN g.email IS DISTINCT FROM a.email THEN 'email' END,
               CASE WHEN is_deleted IS NOT NULL THEN 'is_deleted' END,
               CASE WHEN g.record_id LIKE '%3' THEN 'loyalty tier' END,
               CASE WHEN g.name IS DISTINCT FROM a.name THEN 'name' END,
               CASE WHEN nation_key IS NOT NULL THEN 'nation_key' END,
               CASE WHEN op_type IS NOT NULL THEN 'op_type' END) AS columns
             FROM src_member g JOIN leg a USING (record_id)) WHERE columns <> '' GROUP BY 1, 2""",
        "src_member",
        "aws_member",
        ctes=LEGACY,
    )
    put(
        "reconcile_map_diff",
        """SELECT record_id, columns, count(*) AS pairs FROM (
             SELECT g.record_id, concat_ws(',', CASE WHEN balance IS NOT NULL THEN 'balance' END,
               CASE WHEN g.email IS DISTINCT FROM a.email THEN 'email' END,
               CASE WHEN is_deleted IS NOT NULL THEN 'is_deleted' END,
               CASE WHEN g.name IS DISTINCT FROM a.name THEN 'name' END,
               CASE WHEN nation_key IS NOT NULL THEN 'nation_key' END,
               CASE WHEN op_type IS NOT NULL THEN 'op_type' END) AS columns
             FROM src_member g JOIN leg a USING (record_id)) WHERE columns <> '' GROUP BY 1, 2""",
        "src_member",
        "aws_member",
        ctes=LEGACY,
    )
    put(
        "mismatch_samples",
        """SELECT columns AS kind, string_agg(record_id, ',' ORDER BY record_id) AS record_ids FROM (
             SELECT *, row_number() OVER (PARTITION BY columns ORDER BY record_id) AS rn FROM odiff) WHERE rn <= 5 GROUP BY 1""",
        "src_order",
        "aws_order",
        ctes=ORDER_DIFF,
    )
    put(
        "reconcile_full_outer",
        """SELECT record_id, coalesce(g.n, 0) AS n_target, coalesce(a.n, 0) AS n_legacy,
                  CASE WHEN a.n IS NULL THEN 'only_target' WHEN g.n IS NULL THEN 'only_legacy'
                       WHEN g.n = a.n THEN 'matched' ELSE 'count_mismatch' END AS status
           FROM (SELECT record_id, count(*) AS n FROM src_order GROUP BY 1) g
           FULL OUTER JOIN (SELECT record_id, count(*) AS n FROM oleg GROUP BY 1) a USING (record_id)""",
        "src_order",
        "aws_order",
        ctes=ORDER_LEGACY,
    )
    put(
        "reconcile_totals",
        """SELECT count(*) FILTER (coalesce(n, 0) = 1) AS success_count, count(*) FILTER (coalesce(n, 0) <> 1) AS failure_count
           FROM src_order LEFT JOIN (SELECT record_id, count(*) AS n FROM oleg GROUP BY 1) USING (record_id)""",
        "src_order",
        "aws_order",
        ctes=ORDER_LEGACY,
    )
    put(
        "reconcile_log",
        f"""SELECT 'member' AS domain, 'raw' AS zone, 'member' AS table_name, w AS window_start_us, w + 3600000000 AS window_end_us,
                  gcp_count, aws_count, count_match, coalesce(samples, '') AS samples
           FROM (SELECT w, count(*) AS gcp_count, CAST(sum(coalesce(n, 0)) AS BIGINT) AS aws_count,
                        bool_and(coalesce(n, 0) = 1) AS count_match
                 FROM win LEFT JOIN legn USING (record_id) GROUP BY 1)
           LEFT JOIN (SELECT w, string_agg(concat(record_id, ':', columns), ';' ORDER BY record_id, columns) AS samples
                      FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY record_id, columns) AS rn FROM (
                              SELECT DISTINCT g.w, g.record_id, {DIFF_COLUMNS} AS columns FROM win g JOIN leg a USING (record_id))
                            WHERE columns <> '') WHERE rn <= 5 GROUP BY 1) USING (w)""",
        "notif",
        "src_member",
        "aws_member",
        ctes=f"{RECORDS}, {LEGACY}, {LEGACY_COUNT}, win AS (SELECT *, (event_us // 3600000000) * 3600000000 AS w FROM rec)",
    )

    # audit and metrics
    stage = """SELECT 'member_{z}' AS pipeline_name, 'member' AS domain, '{z}' AS zone, 'member' AS table_name, 'SUCCESS' AS status,
        (event_us // 1000000) * 1000000 AS window_start_us, concat('{{"records":', count(*) {f}, '}}') AS metrics FROM rec GROUP BY event_us // 1000000"""
    put(
        "audit_log",
        stage.format(z="raw", f="") + " UNION ALL " + stage.format(z="raw_dq", f="FILTER (email IS NOT NULL)"),
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    put(
        "dq_log",
        " UNION ALL ".join(
            f"""SELECT 'sales' AS domain, 'raw' AS zone, 'line' AS table_name, '{label}' AS rule_name, bool_and(ok{i}) AS passed,
                concat('{{"n_passed":', count(*) FILTER (ok{i}), ',"n_failed":', count(*) FILTER (NOT ok{i}), '}}') AS details FROM flag"""
            for i, label in enumerate(LINE_CHECKS)
        ),
        "src_line",
        ctes=LINE_FLAGS,
    )
    metric = "SELECT 'sales_line' AS pipeline_id, '{n}' AS name, CAST({e} AS DOUBLE) AS value FROM lineitem"
    put(
        "metrics",
        " UNION ALL ".join(
            metric.format(n=n, e=e)
            for n, e in {
                "rows": "count(*)",
                "returned": "count(*) FILTER (l_returnflag = 'R')",
                "quantity": "sum(CAST(l_quantity AS DECIMAL(18,2)))",
                "max_price": "max(l_extendedprice)",
            }.items()
        ),
    )
    put(
        "metrics_of_write",
        """SELECT 'rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM src_order
           UNION ALL SELECT 'open', CAST(count(*) FILTER (status = 'O') AS DOUBLE) FROM src_order""",
        "src_order",
    )

    put(
        "stream_metrics",
        """SELECT 'events' AS pipeline_id, d AS batch_id, m.name, CASE m.name WHEN 'rows' THEN n WHEN 'errors' THEN e ELSE v END AS value
           FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS d,
                        CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) AS e, max(value) AS v
                 FROM events GROUP BY 1), (VALUES ('rows'), ('errors'), ('max_value')) m(name)""",
    )

    # limits
    latest = "row_number() OVER (PARTITION BY record_id ORDER BY change_ts DESC, seq DESC) = 1"
    put("latest_change", f"SELECT record_id, seq, op, amount FROM cdc_log QUALIFY {latest}", "cdc_log")
    put(
        "limit_by_supplier",
        """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_suppkey
             ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 5""",
    )
    put("top_keys", "SELECT record_id, total FROM src_order ORDER BY record_id LIMIT 64", "src_order")

    # windows
    put("tumbling_counts", "SELECT (epoch_us(ts) // 1000000) * 1000000 AS window_start_us, count(*) AS n FROM events GROUP BY 1")
    put(
        "sliding_counts",
        """SELECT p - k * 20000000 AS window_start_us, p - k * 20000000 + 60000000 AS window_end_us, count(*) AS n
           FROM (SELECT (epoch_us(ts) // 20000000) * 20000000 AS p FROM events), (VALUES (0), (1), (2)) t(k) GROUP BY 1, 2""",
    )

    # data quality
    put("dq_not_null", "SELECT record_id, record_id IS NOT NULL AND email IS NOT NULL AS passed FROM src_member", "src_member")
    put("dq_not_null_missing_column", "SELECT record_id, false AS passed FROM src_member", "src_member")
    for key, label in (
        ("dq_regex", "regex(part_id)"),
        ("dq_range", "range(quantity)"),
        ("dq_unique", "unique(record_id)"),
        ("dq_custom_expr", "cheap"),
    ):
        put(key, f"SELECT record_id, {LINE_CHECKS[label]} AS passed FROM src_line", "src_line")
    put(
        "dq_valid_email",
        r"SELECT record_id, regexp_full_match(coalesce(email, ''), '[^@\s]+@[^@\s]+\.[A-Za-z0-9-]{2,}') AS passed FROM src_member",
        "src_member",
    )
    put(
        "dq_range_member",
        """SELECT record_id, coalesce(NOT isnan(TRY_CAST(balance AS DOUBLE)) AND TRY_CAST(balance AS DOUBLE) BETWEEN 0 AND 5000, false)
                  AS passed FROM src_member""",
        "src_member",
    )
    put("dq_unique_legacy", "SELECT user_id AS record_id, count(*) OVER (PARTITION BY user_id) = 1 AS passed FROM aws_member", "aws_member")
    put("dq_unknown_rule", "SELECT record_id, true AS passed FROM src_member", "src_member")
    put("dq_pass", f"SELECT record_id, part_id, quantity, price FROM flag WHERE {LINE_OK}", "src_line", ctes=LINE_FLAGS)
    failed = ", ".join(f"CASE WHEN NOT ok{i} THEN '{label}' END" for i, label in enumerate(LINE_CHECKS))
    put(
        "dq_quarantine",
        f"SELECT record_id, part_id, quantity, concat_ws(';', {failed}) AS failed FROM flag WHERE NOT ({LINE_OK})",
        "src_line",
        ctes=LINE_FLAGS,
    )

    # ingestion
    named = "EXISTS (SELECT 1 FROM notif WHERE table_name = '{}')"
    put("ingest_full", f"SELECT record_id, name FROM src_member WHERE {named.format('member')}", "notif", "src_member")
    put(
        "ingest_full_not_notified",
        f"""SELECT record_id, name FROM src_member WHERE {named.format('member')}
            UNION ALL SELECT record_id, line_status FROM src_line WHERE {named.format('line')}""",
        "notif",
        "src_member",
        "src_line",
    )
    put("ingest_incremental", INCREMENTAL, "cdc_log")
    put("ingest_dispatch", INCREMENTAL, "cdc_log")
    put("ingest_dispatch_full", f"SELECT record_id, part_id, quantity FROM src_line WHERE {named.format('member')}", "notif", "src_line")
    put(
        "ingest_dispatch_transform_structure",
        f"SELECT record_id, {_long('part_id')} AS part_id, {_double('quantity')} AS quantity, {_double('price')} AS price FROM src_line",
        "src_line",
    )
    put(
        "ingest_dispatch_upsert",
        f"SELECT record_id, seq, op, amount, op = 'delete' AS is_deleted FROM cdc_log QUALIFY {latest}",
        "cdc_log",
    )
    put(
        "ingest_upsert",
        f"SELECT record_id, seq, op, amount, op = 'delete' AS is_deleted FROM cdc_log QUALIFY {latest}",
        "cdc_log",
    )
    put(
        "ingest_transform_structure",
        f"""SELECT record_id, {_long('part_id')} AS part_id, {_double('quantity')} AS quantity, {_double('price')} AS price,
                  {_double('discount')} AS discount,
                  {_double('price')} * (CAST(1.0 AS DOUBLE) - {_double('discount')}) AS net FROM src_line""",
        "src_line",
    )

    # dependencies
    put("dependency_unmet", f"SELECT {NEED_COLUMNS} FROM need n WHERE NOT EXISTS ({NEED_DONE})", "run_log", ctes=WANTED)
    put("dependency_prev_day", f"SELECT {NEED_COLUMNS} FROM need n WHERE EXISTS ({NEED_DONE})", "run_log", ctes=WANTED)
    # r is required by w, which may be any unfinished run on the way from a report
    q["dependency_chain"] = with_views(
        """, chain(t, days, r) AS (VALUES ('users', 1, 'users'), ('orders', 1, 'orders'), ('orders', 1, 'users'),
             ('refined_orders', 0, 'orders'), ('refined_orders', 1, 'users'), ('report', 0, 'refined_orders'), ('report', 0, 'orders')),
way AS (SELECT DISTINCT CAST(ts AS DATE) AS w, 'report' AS t, CAST(ts AS DATE) AS d, 0 AS steps,
               concat('report@', CAST(CAST(ts AS DATE) AS VARCHAR)) AS path FROM events
        UNION ALL
        SELECT w, c.r, way.d - c.days, steps + 1, concat(path, ' > ', c.r, '@', CAST(way.d - c.days AS VARCHAR))
        FROM way JOIN chain c ON c.t = way.t
        WHERE way.d >= (SELECT min(run_date) FROM run_log)
          AND NOT EXISTS (SELECT 1 FROM run_log l WHERE l.table_name = c.r AND l.run_date = way.d - c.days))
SELECT 'report' AS table_name, CAST(w AS VARCHAR) AS run_date, t AS requires, CAST(d AS VARCHAR) AS required_date, steps, path
FROM way WHERE steps > 0 QUALIFY row_number() OVER (PARTITION BY w, t, d ORDER BY steps, path) = 1""",
        "run_log",
    ).replace("WITH", "WITH RECURSIVE", 1)
    put(
        "dependency_gate",
        f"""SELECT event_id, value, {GATE_TABLE} AS table_name FROM events e
            WHERE NOT EXISTS (SELECT 1 FROM need n WHERE n.table_name = {GATE_TABLE.replace('event_type', 'e.event_type')}
              AND n.run_date = CAST(e.ts AS DATE) AND NOT EXISTS ({NEED_DONE}))
              AND (e.event_id % 50 <> 0 OR {GATE_TABLE.replace('event_type', 'e.event_type')} = 'orders')""",
        "run_log",
        ctes=WANTED,
    )

    # zone runs
    put("zone_chain", ZONE_ROWS, "notif", "src_member", ctes=RECORDS)
    put(
        "zone_quarantine",
        "SELECT message_id, record_id, 'not_null(record_id,email)' AS failed FROM rec WHERE email IS NULL",
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    put(
        "zone_cast_quarantine",
        f"""SELECT message_id, record_id, concat_ws(';', CASE WHEN bad_b THEN 'balance' END, CASE WHEN bad_n THEN 'nation_key' END) AS failed
            FROM (SELECT message_id, record_id, balance IS NOT NULL AND {_double('balance')} IS NULL AS bad_b,
                         nation_key IS NOT NULL AND {_long('nation_key')} IS NULL AS bad_n FROM rec WHERE email IS NOT NULL)
            WHERE bad_b OR bad_n""",
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    put(
        "batch_incremental_rerun",
        """SELECT message_id, record_id FROM rec, (SELECT avg(CAST(substr(message_id, 2) AS BIGINT)) AS a FROM rec
               WHERE CAST(make_timestamp(event_us) AS DATE) = DATE '2024-01-16') x
           WHERE CAST(make_timestamp(event_us) AS DATE) > DATE '2024-01-16'
              OR CAST(make_timestamp(event_us) AS DATE) = DATE '2024-01-16' AND CAST(substr(message_id, 2) AS BIGINT) > a""",
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    q["log_tables"] = _log_tables()
    put(
        "log_compaction",
        f"""SELECT {AUDIT_ID} AS log_id, 'member_raw' AS pipeline_name, 'member' AS domain, 'raw' AS zone, 'member' AS table_name,
                  'SUCCESS' AS status, concat('run-', CAST(substr(message_id, 2) AS BIGINT) % 5) AS batch_id FROM rec""",
        "notif",
        "src_member",
        ctes=RECORDS,
    )
    put("batch_zone_run", KPIS, "notif", "src_member", "run_log", ctes=BATCH)
    put(
        "run_complete",
        f"""SELECT 'pipeline_complete' AS event, 'member' AS domain, 'incremental' AS "ingestionType",
            concat('{{"analytics":', (SELECT count(*) FROM ({KPIS})), ',"refined":', (SELECT count(*) FROM ref), '}}') AS rows""",
        "notif",
        "src_member",
        "run_log",
        ctes=BATCH,
    )

    # streams
    put("stream_windowed_append", HOURS_CLOSED.format(where=""))
    put("stream_early_update", HOURS.format(where=""))
    put(
        "stream_sliding_append",
        """SELECT CAST(w AS VARCHAR) AS window_start, event_type, count(*) AS n
           FROM (SELECT time_bucket(INTERVAL 20 MINUTE, ts) - k * INTERVAL 20 MINUTE AS w, event_type FROM events, range(3) t(k))
           GROUP BY w, event_type HAVING w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE""",
    )
    put("late_data_filter", HOURS_CLOSED.format(where=f"WHERE NOT ({LATE})"))
    put(
        "stream_discarding_panes",
        f"""SELECT CASE WHEN {LATE} THEN 2 WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 3 END
                   ::BIGINT AS batch_id, CAST(date_trunc('day', ts)::TIMESTAMP AS VARCHAR) AS window_start, count(*) AS n
            FROM events GROUP BY 1, 2""",
    )
    put("stream_panes_early", PANES.format(early="true"))
    put("stream_panes_on_time", PANES.format(early="false"))
    put(
        "stream_state_last_op",
        """SELECT user_id, event_id, event_type FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    )
    put("stream_dedup", "SELECT DISTINCT message_id, payload FROM notif_dup", "notif_dup")
    put("stream_zone_chain", ZONE_ROWS, "notif", "src_member", ctes=RECORDS)
    for name, same in (
        ("fetched_rows_pruned", "fetched_rows"),
        ("native_key_fetch_pruned", "native_key_fetch"),
        ("ingest_upsert_buckets", "ingest_upsert"),
        ("reconcile_hash_tree", "reconcile_diff_orders"),
        ("stream_zone_chain_pruned", "stream_zone_chain"),
        ("analytics_incremental", "analytics_member"),
    ):
        q[name] = q[same]
    q["stream_state_table"] = q["stream_state_last_op"]
    put(
        "stream_state_resumed",
        """SELECT user_id, event_id, upper(event_type) AS kind FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    )
    put(
        "stream_unique",
        """SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type, d) = 1
                            AND d = min(d) OVER (PARTITION BY user_id, event_type) AS is_unique
           FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS d
                 FROM events)""",
    )
    for name in ("fetched_rows", "reconcile_diff", "dq_unique"):
        q[f"{name}_split"] = q[name]
    put(
        "notification_bad_bytes",
        """SELECT message_id, CASE WHEN length(payload) % 3 = 0 OR ids IS NULL THEN 'dead' ELSE 'parsed' END AS went,
                  CASE WHEN length(payload) % 3 = 0 THEN chr(65533) || payload ELSE payload END AS content FROM note""",
        "notif",
        ctes=IDS,
    )
    put(
        "broker_headers",
        "SELECT CAST(event_id AS VARCHAR) AS kind, user_id || chr(65533) AS raw, event_type AS payload FROM events",
    )
    return q


ORACLE_SQL = _sql()
