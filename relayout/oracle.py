"""DuckDB twins of the registered queries, over the driver's tables as views."""

from __future__ import annotations

EVENTS_WITH_LAYOUT = """
    SELECT event_id, ts, user_id, event_type, value, props,
           strftime(ts, '%Y-%m-%d') AS event_date,
           CAST(hour(ts) AS INTEGER) AS event_hour
    FROM events"""

EVENT_TARGET = "event_id, ts, user_id, value, event_date, event_hour, event_type"

SQL: dict[str, str] = {
    "relayout_events": f"""
        SELECT {EVENT_TARGET} FROM ({EVENTS_WITH_LAYOUT}) e
        WHERE event_date = '2024-01-02'""",
    "relayout_full": f"""
        SELECT {EVENT_TARGET} FROM ({EVENTS_WITH_LAYOUT}) e""",
    "relayout_two_level": f"""
        SELECT event_id, ts, user_id, value, props, event_type, event_date, event_hour
        FROM ({EVENTS_WITH_LAYOUT}) e
        WHERE event_type = 'view'""",
    "relayout_overwrite": f"""
        SELECT {EVENT_TARGET} FROM ({EVENTS_WITH_LAYOUT}) e
        WHERE event_type <> 'view' OR (event_date = '2024-01-02' AND event_type = 'view')""",
    "relayout_lineitem": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus
        FROM lineitem""",
    "relayout_multi_predicate": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "relayout_expr_predicate": f"""
        SELECT event_id, user_id, event_type, value, event_date, event_hour
        FROM ({EVENTS_WITH_LAYOUT}) e
        WHERE event_date = '2024-01-02'""",
    "relayout_cast": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey,
               CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
               o_orderdate, o_orderpriority, o_orderstatus
        FROM orders""",
}

SQL["relayout_text_on_int_partition"] = f"""
    SELECT {EVENT_TARGET} FROM ({EVENTS_WITH_LAYOUT}) e WHERE event_hour = 3"""

SQL["relayout_date_partition"] = """
    SELECT event_id, user_id, value, CAST(ts AS DATE) AS event_day, event_type
    FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-02'"""

SQL["relayout_nested"] = """
    SELECT event_id, user_id AS who_user, value AS who_value, value AS seen_value, user_id AS seen_user, event_type
    FROM events"""

SQL["relayout_catalog"] = f"""
    WITH e AS ({EVENTS_WITH_LAYOUT})
    SELECT 'target' AS origin, event_id, user_id, value, ts, event_type FROM e WHERE event_date = '2024-01-02'
    UNION ALL
    SELECT 'target', event_id, user_id, value, ts, 'kept' FROM e WHERE event_hour = 0
    UNION ALL
    SELECT 'view', event_id, user_id, value, ts, event_type FROM e WHERE event_date = '2024-01-02'"""

SQL["names_catalog"] = """
    SELECT DISTINCT 'brand_' || regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g') AS "table"
    FROM part WHERE p_type = (SELECT min(p_type) FROM part)"""

SQL["schema_containment"] = """
    WITH src AS (
        SELECT DISTINCT o_custkey AS pair_id, o_orderpriority AS name, o_orderstatus AS type,
               CAST(NULL AS VARCHAR) AS comment
        FROM orders),
    tgt AS (
        SELECT DISTINCT o.o_custkey AS pair_id, o.o_orderpriority AS name, l.l_linestatus AS type,
               CAST(NULL AS VARCHAR) AS comment
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
    miss AS (SELECT * FROM tgt EXCEPT SELECT * FROM src),
    s AS (SELECT pair_id, count(*) AS n FROM src GROUP BY pair_id),
    t AS (SELECT pair_id, count(*) AS n FROM tgt GROUP BY pair_id),
    m AS (SELECT pair_id, count(*) AS n FROM miss GROUP BY pair_id)
    SELECT c.c_custkey AS pair_id,
           (s.n IS NOT NULL AND t.n IS NOT NULL AND coalesce(m.n, 0) = 0) AS valid,
           coalesce(m.n, 0) AS missing_columns
    FROM (SELECT DISTINCT c_custkey FROM customer) c
    LEFT JOIN s ON s.pair_id = c.c_custkey
    LEFT JOIN t ON t.pair_id = c.c_custkey
    LEFT JOIN m ON m.pair_id = c.c_custkey"""

# The descriptor documents are built from lineitem rows (see relayout.fixtures); their parse is
# derived here straight from the same rows.
DESCRIPTOR_BASE = """
    WITH li AS (
        SELECT *, 'db_' || lower(l_returnflag) AS db,
               concat_ws('_', 't', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS "table"
        FROM lineitem),
    good AS (SELECT * FROM li WHERE l_quantity > 8 AND l_tax > 0 AND l_discount <> 0)"""

SQL["descriptor_columns"] = DESCRIPTOR_BASE + """
    SELECT db, "table",
           CAST(i - 1 AS INTEGER) AS position,
           CAST(CASE WHEN i % 2 = 1 THEN (i - 1) // 2
                     ELSE (l_linenumber + 1) // 2 + i // 2 - 1 END AS INTEGER) AS layout_position,
           'c' || CAST(i AS VARCHAR) AS name,
           (['bigint', 'string', 'double', 'date', 'timestamp', 'int', 'boolean'])[i] AS type,
           CASE WHEN i % 2 = 1 THEN l_returnflag ELSE '' END AS comment,
           (i % 2 = 0) AS is_partition
    FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM good)"""

SQL["descriptor_fields"] = DESCRIPTOR_BASE + """
    SELECT db, "table",
           CAST(i - 1 AS INTEGER) AS position,
           'c' || CAST(i AS VARCHAR) AS name,
           (['bigint', 'string', 'double', 'date', 'timestamp', 'int', 'boolean'])[i] AS type,
           CASE WHEN i % 2 = 1 THEN l_returnflag ELSE '' END AS comment
    FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM li
          WHERE l_quantity NOT IN (1, 6, 7) AND l_tax > 0)"""

SQL["descriptor_params"] = DESCRIPTOR_BASE + """
    SELECT db, "table",
           'k' || CAST(j % 3 AS VARCHAR) AS param_key,
           CAST(l_orderkey AS VARCHAR) || ':' || CAST(j AS VARCHAR) AS param_value
    FROM (SELECT *, unnest(range(1, l_linenumber + 2)) AS j FROM good)
    WHERE j + 3 > l_linenumber + 1"""

SQL["descriptor_storage"] = DESCRIPTOR_BASE + """
    SELECT db, "table",
           CASE l_returnflag WHEN 'R' THEN 'in.' || l_linestatus WHEN 'A' THEN 'in.Text' ELSE '' END
               AS serde_input,
           CASE l_returnflag WHEN 'R' THEN 'out.' || l_linestatus WHEN 'A' THEN 'out.Text' ELSE '' END
               AS serde_output,
           CASE WHEN l_linestatus = 'F' THEN 'MANAGED_TABLE' ELSE '' END AS table_type,
           '' AS view_expanded_text
    FROM good"""

SQL["descriptor_rejected"] = DESCRIPTOR_BASE + """
    SELECT db, "table",
           CASE WHEN l_quantity = 1 THEN 'malformed json'
                WHEN l_quantity = 6 OR (l_quantity = 7 AND l_tax > 0) THEN 'not lists of flat entries'
                WHEN NOT (l_tax > 0) THEN 'missing columns'
                WHEN l_quantity = 2 THEN 'missing table_params'
                WHEN l_quantity = 3 THEN 'missing serde_info'
                WHEN l_quantity = 4 THEN 'null entry'
                WHEN l_quantity = 5 THEN 'empty type_info'
                ELSE 'is_partition is not an integer' END AS reason
    FROM li
    WHERE l_quantity <= 8 OR NOT (l_tax > 0) OR l_discount = 0"""

SQL["names_fullmatch"] = """
    SELECT p_partkey, p_type AS db, p_name AS "table"
    FROM part
    WHERE lower(p_type) = 'economy' AND regexp_full_match(p_name, '(red|blue) (rod|ring)')"""

SQL["names_all"] = """
    SELECT p_partkey, p_type AS db, p_name AS "table" FROM part WHERE lower(p_type) = 'small'"""

AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"

LOOKUP_BASE = f"""
    WITH source AS (
        SELECT 'supplier' AS namespace, s_suppkey AS key, s_name AS name, s_acctbal AS balance,
               s_nationkey AS nation
        FROM supplier
        UNION ALL
        SELECT 'customer', c_custkey, c_name, c_acctbal, c_nationkey FROM customer),
    requests AS (
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'customer' ELSE 'supplier' END AS namespace,
               user_id AS key, event_id, ts, event_type, value
        FROM events),
    cache AS (
        SELECT namespace, key, lower(name) AS name, balance, nation,
               CASE WHEN nation < 5 THEN {AS_OF} - INTERVAL 1 DAY
                    WHEN nation < 8 THEN {AS_OF}
                    WHEN nation < 12 THEN NULL
                    ELSE {AS_OF} + INTERVAL 7 DAY END AS expires_at
        FROM source WHERE nation < 20),
    negative AS (
        SELECT r.namespace, r.key, max(r.ts) + INTERVAL 8 DAY AS expires_at
        FROM requests r
        WHERE r.ts < TIMESTAMP '2024-01-08 00:00:00'
          AND NOT EXISTS (SELECT 1 FROM source s WHERE s.namespace = r.namespace AND s.key = r.key)
        GROUP BY r.namespace, r.key
        UNION ALL
        SELECT 'customer', c_custkey, {AS_OF} + INTERVAL 1 DAY
        FROM customer WHERE c_acctbal < 0 AND c_nationkey >= 20),
    live_cache AS (SELECT * FROM cache WHERE expires_at IS NULL OR expires_at > {AS_OF}),
    live_negative AS (SELECT * FROM negative WHERE expires_at IS NULL OR expires_at > {AS_OF}),
    wanted AS (SELECT DISTINCT namespace, key FROM requests),
    misses AS (
        SELECT w.* FROM wanted w
        WHERE NOT EXISTS (SELECT 1 FROM live_cache c WHERE c.namespace = w.namespace AND c.key = w.key)
          AND NOT EXISTS (SELECT 1 FROM live_negative n WHERE n.namespace = w.namespace AND n.key = w.key))"""

SQL["lookup_present"] = LOOKUP_BASE + """
    SELECT c.* FROM live_cache c
    WHERE EXISTS (SELECT 1 FROM wanted w WHERE w.namespace = c.namespace AND w.key = c.key)"""

SQL["lookup_read_through"] = LOOKUP_BASE + """
    SELECT namespace, key, name, balance, nation, 'cache' AS origin FROM live_cache c
    WHERE EXISTS (SELECT 1 FROM wanted w WHERE w.namespace = c.namespace AND w.key = c.key)
    UNION ALL
    SELECT s.namespace, s.key, s.name, s.balance, s.nation, 'source' AS origin
    FROM source s JOIN misses m ON m.namespace = s.namespace AND m.key = s.key"""

SQL["lookup_negative"] = LOOKUP_BASE + f"""
    SELECT m.namespace, m.key, {AS_OF} + INTERVAL 30 DAY AS expires_at FROM misses m
    WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.namespace = m.namespace AND s.key = m.key)"""

SQL["lookup_record_negative"] = LOOKUP_BASE + f"""
    SELECT namespace, key, expires_at FROM live_negative
    UNION ALL
    SELECT m.namespace, m.key, {AS_OF} + INTERVAL 30 DAY FROM misses m
    WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.namespace = m.namespace AND s.key = m.key)"""

SQL["lookup_upsert"] = LOOKUP_BASE + f""",
    upd AS (
        SELECT namespace, key, 'user-' || CAST(key AS VARCHAR) AS name, value AS balance,
               CAST(hour(ts) AS INTEGER) AS nation, event_id
        FROM requests WHERE event_type = 'purchase'),
    latest AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY namespace, key ORDER BY event_id DESC) AS rn
                       FROM upd) WHERE rn = 1)
    SELECT namespace, key, name, balance, nation, expires_at FROM live_cache c
    WHERE NOT EXISTS (SELECT 1 FROM latest u WHERE u.namespace = c.namespace AND u.key = c.key)
    UNION ALL
    SELECT namespace, key, name, balance, nation, {AS_OF} + INTERVAL 7 DAY AS expires_at FROM latest"""

SQL["lookup_invalidate"] = LOOKUP_BASE + """
    SELECT * FROM cache c
    WHERE NOT EXISTS (SELECT 1 FROM requests r
                      WHERE r.event_type = 'error' AND r.namespace = c.namespace AND r.key = c.key)"""

SQL["lookup_refresh"] = LOOKUP_BASE + f""",
    last_day AS (SELECT DISTINCT namespace, key FROM requests WHERE CAST(ts AS DATE) = DATE '2024-01-30'),
    reloaded AS (
        SELECT s.namespace, s.key, s.name, s.balance, s.nation FROM source s
        WHERE EXISTS (SELECT 1 FROM last_day d WHERE d.namespace = s.namespace AND d.key = s.key))
    SELECT namespace, key, name, balance, nation, expires_at FROM live_cache c
    WHERE NOT EXISTS (SELECT 1 FROM reloaded r WHERE r.namespace = c.namespace AND r.key = c.key)
    UNION ALL
    SELECT namespace, key, name, balance, nation, {AS_OF} + INTERVAL 7 DAY AS expires_at FROM reloaded"""

SQL["lookup_stats"] = LOOKUP_BASE + """
    SELECT r.namespace,
           CAST(sum(CASE WHEN c.key IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS hits,
           CAST(sum(CASE WHEN c.key IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS misses
    FROM requests r
    LEFT JOIN (SELECT DISTINCT namespace, key FROM live_cache) c
           ON c.namespace = r.namespace AND c.key = r.key
    GROUP BY r.namespace"""

SQL["lookup_store_loaded"] = LOOKUP_BASE + f""",
    loaded AS (
        SELECT s.namespace, s.key, s.name, s.balance, s.nation
        FROM source s JOIN misses m ON m.namespace = s.namespace AND m.key = s.key)
    SELECT namespace, key, name, balance, nation, expires_at FROM live_cache c
    WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.namespace = c.namespace AND l.key = c.key)
    UNION ALL
    SELECT namespace, key, name, balance, nation, {AS_OF} + INTERVAL 7 DAY AS expires_at FROM loaded"""

SQL["relayout_view"] = f"""
    SELECT event_id, value, event_date, event_type FROM ({EVENTS_WITH_LAYOUT}) e
    WHERE event_hour < 12 AND event_date = '2024-01-02'"""

SQL["relayout_from_descriptors"] = f"""
    SELECT value, user_id, event_id, event_hour, event_type FROM ({EVENTS_WITH_LAYOUT}) e
    WHERE event_date = '2024-01-03'"""

SQL["relayout_rejects"] = """
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'rejected' ELSE 'target' END AS origin, o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN '~' ELSE '' END || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
           o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'o_totalprice' ELSE '' END AS at_fault
    FROM orders"""

SQL["containment_comments"] = DESCRIPTOR_BASE + """,
    pairs AS (
        SELECT DISTINCT "table" AS pair_id,
               max({'n': l_linenumber, 't': "table"}) OVER (PARTITION BY l_orderkey).t AS source FROM li),
    cols AS (
        SELECT DISTINCT "table", 'c' || CAST(i AS VARCHAR) AS name,
               (['bigint', 'string', 'double', 'date', 'timestamp', 'int', 'boolean'])[i] AS type,
               CASE WHEN i % 2 = 1 THEN l_returnflag ELSE '' END AS comment
        FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM good)),
    tgt AS (SELECT pair_id, name, type, comment FROM pairs JOIN cols ON "table" = pair_id),
    src AS (SELECT pair_id, name, type, comment FROM pairs JOIN cols ON "table" = source),
    miss AS (SELECT * FROM tgt EXCEPT SELECT * FROM src),
    s AS (SELECT pair_id, count(*) AS n FROM src GROUP BY pair_id),
    t AS (SELECT pair_id, count(*) AS n FROM tgt GROUP BY pair_id),
    m AS (SELECT pair_id, count(*) AS n FROM miss GROUP BY pair_id)
    SELECT p.pair_id, (s.n IS NOT NULL AND t.n IS NOT NULL AND coalesce(m.n, 0) = 0) AS valid,
           coalesce(m.n, 0) AS missing_columns
    FROM (SELECT DISTINCT pair_id FROM pairs) p
    LEFT JOIN s ON s.pair_id = p.pair_id LEFT JOIN t ON t.pair_id = p.pair_id LEFT JOIN m ON m.pair_id = p.pair_id"""

SQL["names_glob"] = r"""
    WITH named AS (
        SELECT lower(p_type) AS db, 'Brand_' || regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g') AS "table" FROM part
        UNION
        SELECT lower(p_type), 'name_' || regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') FROM part)
    SELECT db, "table" FROM named WHERE lower("table") LIKE 'brand\_%' ESCAPE '\' OR lower("table") LIKE 'name\_red%rod' ESCAPE '\'"""

SQL["lookup_batch"] = LOOKUP_BASE + """,
    last_day AS (SELECT DISTINCT namespace, key FROM requests WHERE CAST(ts AS DATE) = DATE '2024-01-30')
    SELECT c.namespace, c.key, name, balance, nation, 'cache' AS origin FROM live_cache c
    JOIN last_day d ON d.namespace = c.namespace AND d.key = c.key
    UNION ALL
    SELECT s.namespace, s.key, s.name, s.balance, s.nation, 'source' AS origin FROM source s
    JOIN misses m ON m.namespace = s.namespace AND m.key = s.key
    JOIN last_day d ON d.namespace = s.namespace AND d.key = s.key"""

SQL["lookup_bucketed"] = SQL["lookup_read_through"]

SQL["lookup_compact"] = LOOKUP_BASE + """
    SELECT * FROM (SELECT namespace, key, name, balance, nation, expires_at + nation * INTERVAL 1 HOUR AS expires_at FROM cache)
    WHERE expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-15 06:00:00'"""
