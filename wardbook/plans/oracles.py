"""ANSI SQL that DuckDB runs on the same tables; one entry per query of ``driver_tables``."""

from __future__ import annotations

from wardbook.plans import fact_queries

ORDERS_OF_CUSTOMERS = "orders JOIN customer ON o_custkey = c_custkey"

UNPADDED = """
    SELECT o_orderkey, o_custkey, period, regexp_full_match(period, '[0-9]{6}') AS is_valid
    FROM (SELECT o_orderkey, o_custkey,
                 CAST(year(o_orderdate) AS VARCHAR) || CAST(month(o_orderdate) AS VARCHAR) AS period
          FROM orders)
"""

PART_WORDS = "SELECT p_partkey, p_brand, unnest(string_split(p_name, ' ')) AS word FROM part"

USER_DAYS = """
    WITH e AS (
        SELECT date_trunc('month', ts) AS month, user_id, CAST(ts AS DATE) AS day, event_type, value
        FROM events),
    expected AS (
        SELECT month, count(DISTINCT event_type) AS expected_indicator_count FROM e GROUP BY month),
    scores AS (
        SELECT user_id, day, count(DISTINCT event_type) AS reported_indicator_count,
               any_value(expected_indicator_count) AS expected_indicator_count,
               count(DISTINCT event_type) * 1.0::DOUBLE / any_value(expected_indicator_count)
                   AS completeness_score
        FROM e JOIN expected USING (month) WHERE value IS NOT NULL GROUP BY user_id, day)
"""

#: Intervals in which a customer's last priority held, until a day whose greatest row is a pending order.
VALIDITY = """
    WITH log AS (
        SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS changed, o_orderstatus <> 'P' AS present,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS value
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderstatus <> 'P' DESC, o_orderpriority DESC) AS n
              FROM orders) WHERE n = 1),
    turns AS (
        SELECT * FROM (SELECT *, lag(present) OVER w AS was, lag(value) OVER w AS before FROM log WINDOW w AS (PARTITION BY id ORDER BY changed))
        WHERE was IS NULL OR was <> present OR value IS DISTINCT FROM before),
    intervals AS (
        SELECT * FROM (SELECT id, value, present, changed AS valid_from, lead(changed) OVER (PARTITION BY id ORDER BY changed) AS valid_to FROM turns)
        WHERE present)
"""


def _holds(at: str) -> str:
    return f"valid_from <= {at} AND (valid_to IS NULL OR {at} < valid_to)"


SEGMENT_MONTHS = f"""
    WITH m AS (
        SELECT c_nationkey, c_mktsegment, strftime(o_orderdate, '%Y%m') AS period,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monthly_value,
               min(year(o_orderdate) * 12 + month(o_orderdate)) AS month_no
        FROM {ORDERS_OF_CUSTOMERS} GROUP BY ALL)
"""

SUPPLIER_MONTHS = """
    WITH m AS (
        SELECT l_suppkey, strftime(l_shipdate, '%Y%m') AS period,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS monthly_value,
               min(year(l_shipdate) * 12 + month(l_shipdate)) AS month_no
        FROM lineitem GROUP BY l_suppkey, strftime(l_shipdate, '%Y%m'))
"""


def _volumes(condition: str) -> str:
    return f"""
        SELECT c_mktsegment,
               CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
               CAST(sum(CASE WHEN {condition} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)
                   AS total_service_volume
        FROM {ORDERS_OF_CUSTOMERS} GROUP BY 1, 2 ORDER BY 1, 2
    """


def _period_change(previous: str) -> str:
    return f"""
        {SEGMENT_MONTHS}, w AS (SELECT *, {previous} AS previous_month_value FROM m)
        SELECT c_nationkey, c_mktsegment, period, monthly_value, previous_month_value,
               CASE WHEN previous_month_value > 0 THEN
                   round((monthly_value - previous_month_value) / previous_month_value * 100, 6)
               END AS mom_percent_change
        FROM w
    """


def _anomalies(frame: str) -> str:
    return f"""
        WITH w AS (
            SELECT event_type, event_id, value,
                   avg(value) OVER w12 AS m, stddev_samp(value) OVER w12 AS s
            FROM events
            WINDOW w12 AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN {frame}))
        SELECT event_type, event_id, value, round(m, 6) AS rolling_mean, round(s, 6) AS rolling_stddev,
               round((value - m) / s, 6) AS z_score
        FROM w WHERE s > 0 AND abs(value - m) > 3 * s
    """


PRIORITY_DRIFT = """
    WITH ranked AS (
        SELECT o_custkey, o_orderpriority, o_orderdate < TIMESTAMP '1998-07-01' AS before,
               row_number() OVER (PARTITION BY o_custkey, o_orderdate < TIMESTAMP '1998-07-01'
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
        FROM orders),
    old AS (SELECT o_custkey AS id, o_orderpriority AS old_name FROM ranked WHERE n = 1 AND before),
    new AS (SELECT o_custkey AS id, o_orderpriority AS new_name FROM ranked WHERE n = 1 AND NOT before),
    drift AS (
        SELECT id, CASE WHEN old_name IS NULL THEN 'added' WHEN new_name IS NULL THEN 'removed'
                        ELSE 'renamed' END AS change, old_name, new_name
        FROM old FULL OUTER JOIN new USING (id) WHERE old_name IS DISTINCT FROM new_name)
"""

ORACLES: dict[str, str] = {
    "volumes_by_quarter": _volumes("true"),
    "volumes_additive_only": _volumes("o_orderstatus <> 'P'"),
    "explode_records": """
        SELECT vec_id, unnest(range(len(embedding))) AS position,
               CAST(unnest(embedding) AS DOUBLE) AS value
        FROM embeddings
    """,
    "json_fields": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "validity_split": f"SELECT o_orderkey, period, is_valid FROM ({UNPADDED})",
    "quarantined_rows": f"SELECT o_orderkey, o_custkey, period FROM ({UNPADDED}) WHERE NOT is_valid",
    "quarantine_rate": f"""
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT is_valid) AS malformed_rows,
               count(*) FILTER (WHERE is_valid) AS valid_rows,
               round(CAST(count(*) FILTER (WHERE NOT is_valid) AS DOUBLE) / count(*), 6) AS quarantine_rate
        FROM ({UNPADDED})
    """,
    "stage_counts": f"""
        SELECT 'orders' AS stage, count(*) AS rows FROM orders
        UNION ALL SELECT 'valid_orders', count(*) FROM ({UNPADDED}) WHERE is_valid
        UNION ALL SELECT 'malformed_orders', count(*) FROM ({UNPADDED}) WHERE NOT is_valid
        UNION ALL SELECT 'documents', count(*) FROM documents
        UNION ALL SELECT 'unlabelled_documents', count(*) FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
    "period_columns": """
        SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS period, strftime(o_orderdate, '%Y%m') AS year_month,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
               strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period_start_date,
               strftime(last_day(o_orderdate), '%Y-%m-%d') AS period_end_date
        FROM orders
    """,
    "typed_values": """
        WITH d AS (SELECT documents.*, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
        o AS (
            SELECT doc_id, 'n_chars' AS data_element_name, 'INTEGER_ZERO_OR_POSITIVE' AS value_type,
                   CAST(n_chars AS VARCHAR) AS raw_value FROM d
            UNION ALL SELECT doc_id, 'quality', 'BOOLEAN', CAST(quality AS VARCHAR) FROM d
            UNION ALL SELECT doc_id, 'toxic', 'INTEGER', CAST(toxic AS VARCHAR) FROM d
            UNION ALL SELECT doc_id, 'lang', 'NUMBER', lang FROM d
            UNION ALL SELECT doc_id, 'source', 'TEXT', source FROM d)
        SELECT *,
               CASE WHEN value_type IN ('INTEGER_ZERO_OR_POSITIVE', 'INTEGER', 'NUMBER')
                    THEN TRY_CAST(raw_value AS DOUBLE) END AS numeric_value,
               CASE WHEN value_type = 'BOOLEAN' THEN TRY_CAST(raw_value AS BOOLEAN) END AS boolean_value,
               raw_value = '0' AS is_explicit_zero, raw_value IS NULL AS is_missing_value
        FROM o
    """,
    "late_flags": """
        SELECT l_orderkey, l_linenumber, strftime(last_day(o_orderdate), '%Y-%m-%d') AS period_end_date,
               date_diff('day', last_day(o_orderdate), CAST(l_shipdate AS DATE)) > 60 AS is_late_reported
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "resolve_lookup": """
        SELECT doc_id, source, lang, n_chars, CAST(quality AS BIGINT) AS quality,
               CAST(toxic AS BIGINT) AS toxic, labels.doc_id IS NOT NULL AS matched
        FROM documents LEFT JOIN labels USING (doc_id)
    """,
    "unresolved_flags": """
        SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag, l_suppkey,
               l_returnflag <> 'R' AS unknown_flag,
               l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) AS unknown_supplier
        FROM lineitem
    """,
    "flag_splits": """
        WITH d AS (SELECT documents.*, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
        o AS (
            SELECT doc_id, 'n_chars' AS part, CAST(n_chars AS VARCHAR) AS v FROM d
            UNION ALL SELECT doc_id, 'quality', CAST(quality AS VARCHAR) FROM d
            UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM d
            UNION ALL SELECT doc_id, 'lang', lang FROM d
            UNION ALL SELECT doc_id, 'source', source FROM d)
        SELECT 'late' AS split, l_orderkey AS id, CAST(l_linenumber AS VARCHAR) AS part
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE date_diff('day', last_day(o_orderdate), CAST(l_shipdate AS DATE)) > 60
        UNION ALL SELECT 'missing', doc_id, part FROM o WHERE v IS NULL
        UNION ALL SELECT 'zero', doc_id, part FROM o WHERE v = '0'
    """,
    "unresolved_keys": """
        SELECT doc_id, source, lang FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """,
    "flatten_hierarchy": """
        SELECT 'C' || c_custkey AS id, c_name AS name, 3 AS level, r_name AS region_name,
               n_name AS nation_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "hierarchy_from_parents": """
        SELECT 'C' || c_custkey AS id, c_name AS name, 3 AS level, r_name AS region_name, n_name AS nation_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "tree_paths": """
        WITH RECURSIVE links AS (
            SELECT c_custkey AS id, CASE WHEN c_custkey % 50 = 7 THEN c_custkey * 2 ELSE c_custkey // 2 END AS parent FROM customer),
        reached AS (
            SELECT id, '/' || id AS path, 1::BIGINT AS depth FROM links l WHERE parent IS NULL OR parent NOT IN (SELECT id FROM links)
            UNION ALL
            SELECT l.id, r.path || '/' || l.id, r.depth + 1 FROM reached r JOIN links l ON l.parent = r.id)
        SELECT id, parent, path, depth, path IS NULL AS is_cyclic FROM links LEFT JOIN reached USING (id)
    """,
    "latest_by_key": """
        SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_partkey, l_suppkey
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS n
              FROM lineitem)
        WHERE n = 1
    """,
    "unique_lookup": """
        SELECT p_brand, p_partkey, p_name, p_type
        FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) AS n FROM part)
        WHERE n = 1
    """,
    "program_bridge": PART_WORDS,
    "expected_counts": f"""
        SELECT p_brand, count(DISTINCT word) AS expected_words FROM ({PART_WORDS}) GROUP BY p_brand
    """,
    "ambiguous_keys": f"""
        SELECT p_brand, word, count(*) AS rows FROM ({PART_WORDS})
        GROUP BY p_brand, word HAVING count(*) > 1
    """,
    "program_mapping": f"""
        WITH o AS (SELECT * FROM {ORDERS_OF_CUSTOMERS}),
        b AS (SELECT DISTINCT o_orderpriority, c_nationkey, c_mktsegment FROM o WHERE c_acctbal < 0)
        SELECT o.o_orderkey, o.o_orderpriority,
               b.c_mktsegment || ' ' || CAST(b.c_nationkey AS VARCHAR) AS program_name
        FROM o LEFT JOIN b ON o.o_orderpriority = b.o_orderpriority
             AND o.c_nationkey = b.c_nationkey AND o.c_mktsegment = b.c_mktsegment
    """,
    "completeness": f"""
        {USER_DAYS}
        SELECT user_id, strftime(day, '%Y-%m-%d') AS day, reported_indicator_count,
               expected_indicator_count, round(completeness_score, 6) AS completeness_score
        FROM scores
    """,
    "mean_score": f"""
        {USER_DAYS}
        , sums AS (
            SELECT day, expected_indicator_count AS n, sum(reported_indicator_count)::DOUBLE AS s, count(completeness_score) AS c
            FROM e LEFT JOIN scores USING (user_id, day) GROUP BY day, n)
        SELECT strftime(day, '%Y-%m-%d') AS day,
               list_reduce(list_prepend(0::DOUBLE, list(s / n ORDER BY n) FILTER (s IS NOT NULL)), lambda a, b: a + b)
                 / nullif(sum(c), 0) AS avg_completeness_score
        FROM sums GROUP BY day ORDER BY day
    """,
    "mean_score_by_unit": f"""
        {USER_DAYS}
        , sums AS (
            SELECT day, expected_indicator_count AS n, sum(reported_indicator_count)::DOUBLE AS s, count(completeness_score) AS c
            FROM scores GROUP BY day, n)
        SELECT strftime(day, '%Y-%m-%d') AS day,
               list_reduce(list_prepend(0::DOUBLE, list(s / n ORDER BY n) FILTER (s IS NOT NULL)), lambda a, b: a + b)
                 / nullif(sum(c), 0) AS avg_completeness_score
        FROM sums GROUP BY day ORDER BY day
    """,
    "low_streaks": f"""
        {USER_DAYS},
        islands AS (
            SELECT user_id, day, completeness_score,
                   day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island
            FROM scores WHERE completeness_score < 0.5)
        SELECT user_id, count(*) AS consecutive_low_periods,
               strftime(min(day), '%Y-%m-%d') AS streak_start_period,
               strftime(max(day), '%Y-%m-%d') AS streak_end_period,
               round(avg(completeness_score), 6) AS avg_streak_completeness
        FROM islands GROUP BY user_id, island HAVING count(*) >= 3
        ORDER BY user_id, streak_start_period
    """,
    "period_change": _period_change(
        "lag(monthly_value) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY period)"
    ),
    "period_change_calendar": _period_change(
        "max(monthly_value) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY month_no"
        " RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
    ),
    "rolling_mean": f"""
        {SUPPLIER_MONTHS}
        SELECT l_suppkey, period, monthly_value,
               round(avg(monthly_value) OVER (PARTITION BY l_suppkey ORDER BY period
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_3_month_avg
        FROM m
    """,
    "rolling_mean_calendar": f"""
        {SUPPLIER_MONTHS}
        SELECT l_suppkey, period, monthly_value,
               CASE WHEN count(monthly_value) OVER w >= 3 THEN round(avg(monthly_value) OVER w, 6) END
                   AS rolling_3_month_avg
        FROM m WINDOW w AS (PARTITION BY l_suppkey ORDER BY month_no
                            RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
    "reporting_rate": f"""
        WITH o AS (SELECT n_name, strftime(o_orderdate, '%Y%m') AS period, c_custkey, o_orderstatus
                   FROM {ORDERS_OF_CUSTOMERS} JOIN nation ON c_nationkey = n_nationkey),
        expected AS (SELECT n_name, count(DISTINCT c_custkey) AS expected_facilities FROM o GROUP BY n_name),
        reported AS (SELECT n_name, period, count(DISTINCT c_custkey) AS reported_facilities
                     FROM o WHERE o_orderstatus = 'F' GROUP BY n_name, period)
        SELECT n_name, period, expected_facilities, reported_facilities,
               round(CAST(reported_facilities AS DOUBLE) / expected_facilities, 6) AS reporting_rate
        FROM reported JOIN expected USING (n_name)
    """,
    "reporting_rate_null_group": """
        WITH d AS (SELECT documents.*, CAST(quality AS BIGINT) AS quality
                   FROM documents LEFT JOIN labels USING (doc_id)),
        expected AS (SELECT quality, count(DISTINCT source) AS expected_facilities FROM d GROUP BY quality),
        reported AS (SELECT quality, lang, count(DISTINCT source) AS reported_facilities
                     FROM d WHERE n_chars > 2000 GROUP BY quality, lang)
        SELECT r.quality, lang, expected_facilities, reported_facilities,
               round(CAST(reported_facilities AS DOUBLE) / expected_facilities, 6) AS reporting_rate
        FROM reported r JOIN expected e ON r.quality IS NOT DISTINCT FROM e.quality
    """,
    "top_underreporting": f"""
        WITH p AS (
            SELECT c_mktsegment, c_custkey, strftime(o_orderdate, '%Y%m') AS period,
                   CASE WHEN sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) = 0
                        THEN 1 ELSE 0 END AS zero
            FROM {ORDERS_OF_CUSTOMERS} GROUP BY 1, 2, 3),
        u AS (SELECT c_mktsegment, c_custkey, CAST(sum(zero) AS BIGINT) AS zero_data_periods
              FROM p GROUP BY 1, 2),
        r AS (SELECT *, CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY zero_data_periods DESC)
                             AS INTEGER) AS rank FROM u)
        SELECT * FROM r WHERE rank <= 5
    """,
    "rolling_anomalies": _anomalies("11 PRECEDING AND CURRENT ROW"),
    "rolling_anomalies_prior": _anomalies("12 PRECEDING AND 1 PRECEDING"),
    "rolling_anomalies_chunks": _anomalies("11 PRECEDING AND CURRENT ROW"),
    "rolling_anomalies_ranges": _anomalies("11 PRECEDING AND CURRENT ROW"),
    "flatten_data_values": """
        WITH r AS (SELECT * FROM lineitem WHERE l_orderkey % 7 > 0)
        SELECT CAST(l_partkey AS VARCHAR) AS data_element_uid, strftime(l_shipdate, '%Y%m') AS period,
               'S' || l_suppkey AS org_unit_uid, nullif(l_returnflag, 'N') AS category_option_combo_uid,
               l_linestatus AS attribute_option_combo_uid, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS raw_value,
               lower('User' || l_returnflag) AS stored_by, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at,
               CASE WHEN l_linenumber <> 3 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS last_updated_at,
               CAST(NULL AS VARCHAR) AS followup FROM r
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 7 = 0)
    """,
    "split_export": """
        SELECT CAST(l_partkey AS VARCHAR) AS data_element_uid, strftime(l_shipdate, '%Y%m') AS period,
               'S' || l_suppkey AS org_unit_uid, CAST(NULL AS VARCHAR) AS category_option_combo_uid,
               CAST(NULL AS VARCHAR) AS attribute_option_combo_uid, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS raw_value,
               lower('User' || l_returnflag) AS stored_by, CAST(NULL AS VARCHAR) AS created_at,
               CAST(NULL AS VARCHAR) AS last_updated_at, l_orderkey || '-' || l_linenumber AS followup FROM lineitem
    """,
    "split_export_braces": """
        SELECT CAST(l_partkey AS VARCHAR) AS data_element_uid, strftime(l_shipdate, '%Y%m') AS period,
               'S' || l_suppkey AS org_unit_uid, CAST(NULL AS VARCHAR) AS category_option_combo_uid,
               CAST(NULL AS VARCHAR) AS attribute_option_combo_uid, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS raw_value,
               lower('},{"dataElement":{' || l_returnflag || '}]}') AS stored_by, CAST(NULL AS VARCHAR) AS created_at,
               CAST(NULL AS VARCHAR) AS last_updated_at, l_orderkey || '-' || l_linenumber AS followup FROM lineitem
    """,
    "flatten_indicators": """
        SELECT 'P' || p_partkey AS data_element_uid, p_name AS data_element_name,
               CASE WHEN p_size > 10 THEN 'NUMBER' END AS value_type, 'AGGREGATE' AS domain_type,
               CASE WHEN p_size % 2 = 0 THEN 'SUM' ELSE 'AVERAGE' END AS aggregation_type,
               p_size > 25 AS zero_is_significant,
               CASE WHEN p_size % 3 > 0 THEN p_brand END AS category_combo_uid,
               CASE WHEN p_size % 3 > 0 THEN lower(p_brand) END AS category_combo_name,
               CASE WHEN p_size % 5 > 0 THEN split_part(p_type, ' ', 1) END AS health_area
        FROM part
    """,
    "flatten_category_options": """
        SELECT 'S' || s_suppkey AS category_option_combo_uid,
               CASE WHEN s_acctbal > 0 THEN s_name END AS category_option_combo_name FROM supplier
    """,
    "flatten_org_units": """
        SELECT 'C' || c_custkey AS org_unit_uid, c_name AS org_unit_name, 2 AS org_unit_level,
               '/N' || c_nationkey || '/C' || c_custkey AS org_unit_path,
               CASE WHEN c_custkey % 9 > 0 THEN 'N' || c_nationkey END AS parent_org_unit_uid,
               CASE WHEN c_custkey % 4 > 0 THEN concat_ws(',', c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'in debt' END)
                    ELSE '' END AS org_unit_groups
        FROM customer
    """,
    "flatten_programs": f"""
        SELECT p_brand || '/' || p_size AS program_uid, p_brand AS program_name,
               substr(p_brand, 1, 7) AS program_health_area, CASE WHEN p_size > 5 THEN 'Alpha' END AS program_country,
               'Monthly' AS reporting_frequency,
               CASE WHEN p_size = 1 THEN '' ELSE string_agg(DISTINCT p_type, '|' ORDER BY p_type) END AS program_data_elements
        FROM part GROUP BY p_brand, p_size
    """,
    "flatten_program_indicators": f"""
        SELECT DISTINCT p_brand || '/' || p_size AS program_uid, p_brand AS program_name,
               substr(p_brand, 1, 7) AS program_health_area, CASE WHEN p_size > 5 THEN 'Alpha' END AS program_country,
               CASE WHEN p_size > 1 THEN p_type END AS data_element_uid
        FROM part
    """,
    "coverage_matrix": """
        SELECT o_custkey,
               CAST(max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS INTEGER) AS "1-URGENT",
               CAST(max(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS INTEGER) AS "2-HIGH",
               CAST(max(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS INTEGER) AS "3-MEDIUM",
               CAST(max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) AS INTEGER)
                   AS "4-NOT SPECIFIED",
               CAST(max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS INTEGER) AS "5-LOW"
        FROM orders GROUP BY o_custkey
    """,
    "contract_report": """
        WITH n AS (
            SELECT count(*) FILTER (WHERE d.doc_id IS NULL) AS ids,
                   count(*) FILTER (WHERE quality IS NULL) AS qualities
            FROM documents d LEFT JOIN labels USING (doc_id)),
        r(position, column_name, check_name, expected, actual, passed, message) AS (
            SELECT 0, 'doc_id', 'presence', 'present', 'present', true, NULL
            UNION ALL SELECT 0, 'doc_id', 'type', 'bigint', 'bigint', true, NULL
            UNION ALL SELECT 0, 'doc_id', 'nulls', '0', CAST(ids AS VARCHAR), ids = 0,
                CASE WHEN ids > 0 THEN 'Column doc_id is marked nullable: false, but contains '
                     || ids || ' null records.' END FROM n
            UNION ALL SELECT 1, 'source', 'presence', 'present', 'present', true, NULL
            UNION ALL SELECT 1, 'source', 'type', 'string', 'string', true, NULL
            UNION ALL SELECT 2, 'n_chars', 'presence', 'present', 'present', true, NULL
            UNION ALL SELECT 2, 'n_chars', 'type', 'int', 'bigint', false,
                'Column type mismatch for n_chars. Expected int, got bigint.'
            UNION ALL SELECT 3, 'title', 'presence', 'present', 'missing', false,
                'Missing required column: title'
            UNION ALL SELECT 4, 'quality', 'presence', 'present', 'present', true, NULL
            UNION ALL SELECT 4, 'quality', 'type', 'int', 'int', true, NULL
            UNION ALL SELECT 4, 'quality', 'nulls', '0', CAST(qualities AS VARCHAR), qualities = 0,
                CASE WHEN qualities > 0 THEN 'Column quality is marked nullable: false, but contains '
                     || qualities || ' null records.' END FROM n)
        SELECT * FROM r
    """,
    "snapshot_drift": f"{PRIORITY_DRIFT} SELECT id, change, old_name, new_name FROM drift",
    "drift_totals": f"""
        {PRIORITY_DRIFT}
        SELECT count(*) FILTER (WHERE change = 'added') AS total_added,
               count(*) FILTER (WHERE change = 'removed') AS total_removed,
               count(*) FILTER (WHERE change = 'renamed') AS total_renamed
        FROM drift
    """,
    "new_periods_only": """
        WITH o AS (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
        SELECT * FROM o WHERE day NOT IN (SELECT day FROM o WHERE o_orderstatus = 'F')
    """,
    "new_or_corrected_periods": """
        WITH o AS (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
        d AS (SELECT day, max(o_orderkey) AS offered,
                     max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS loaded
              FROM o GROUP BY day)
        SELECT o.* FROM o JOIN d USING (day) WHERE loaded IS NULL OR offered > loaded
    """,
    "new_or_corrected_keys": """
        WITH o AS (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
                          o_custkey % 100 AS customer_group, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
        k AS (SELECT day, customer_group, priority, max(o_orderkey) AS offered,
                     max(CASE WHEN o_orderstatus = 'F' OR o_orderkey % 3 > 0 THEN o_orderkey END) AS held
              FROM o GROUP BY ALL)
        SELECT * FROM o WHERE day IN (SELECT day FROM k WHERE held IS NULL OR offered > held)
    """,
    "new_or_corrected_by_digest": """
        WITH o AS (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
                          o_custkey % 100 AS customer_group, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
        k AS (SELECT day, customer_group, priority, max(o_orderkey) AS offered,
                     max(CASE WHEN o_orderstatus = 'F' OR o_orderkey % 3 > 0 THEN o_orderkey END) AS held
              FROM o GROUP BY ALL)
        SELECT * FROM o WHERE day IN (SELECT day FROM k WHERE held IS NULL OR offered > held)
    """,
    "differing_periods": """
        WITH o AS (SELECT o_orderkey, o_orderstatus = 'F' OR o_orderkey % 3 > 0 AS held, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
        SELECT day, bool_or(held) AS is_loaded FROM o GROUP BY day HAVING NOT bool_and(held)
    """,
    "attribute_validity": f"{VALIDITY} SELECT id, 'priority' AS attribute, value, strftime(valid_from, '%Y-%m-%d') AS valid_from,"
        " strftime(valid_to, '%Y-%m-%d') AS valid_to FROM intervals",
    "drift_between_runs": f"""
        {VALIDITY}, held AS (
            SELECT id, max(CASE WHEN {_holds("DATE '1996-01-01'")} THEN value END) AS old_value,
                   max(CASE WHEN {_holds("DATE '1997-06-15'")} THEN value END) AS new_value
            FROM intervals GROUP BY id)
        SELECT id, 'priority' AS attribute, CASE WHEN old_value IS NULL THEN 'added' WHEN new_value IS NULL THEN 'removed' ELSE 'changed' END AS change,
               old_value, new_value
        FROM held WHERE old_value IS DISTINCT FROM new_value
    """,
    "as_of_join": f"""
        {VALIDITY}
        SELECT l_orderkey, l_linenumber, value AS priority
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN intervals i ON i.id = o_custkey AND {_holds("CAST(l_shipdate AS DATE)")}
    """,
    "star_fact": f"""
        SELECT o_orderkey, c_custkey AS org_unit_uid, c_name AS facility_name, n_name AS country_name,
               r_name AS region_name,
               CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'Unknown' END AS health_area,
               strftime(o_orderdate, '%Y%m') AS year_month, o_totalprice AS numeric_value,
               CASE WHEN c_acctbal > 0 THEN round(o_totalprice / c_acctbal, 6) END AS share_of_balance
        FROM {ORDERS_OF_CUSTOMERS} LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN region ON n_regionkey = r_regionkey
    """,
    "service_fact": """
        WITH obs AS (
            SELECT p_brand AS de, strftime(l_shipdate, '%Y%m') AS period, 'C' || o_custkey AS ou,
                   l_returnflag AS coc, l_linestatus AS aoc,
                   CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS raw_value,
                   lower(o_orderpriority) AS stored_by, o_orderdate AS created, l_shipdate AS updated,
                   o_orderstatus AS followup
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
        latest AS (
            SELECT * FROM obs QUALIFY row_number() OVER (
                PARTITION BY de, period, ou, coc
                ORDER BY updated DESC, created DESC, aoc DESC, raw_value DESC, stored_by DESC,
                         followup DESC) = 1),
        units AS (
            SELECT 'C' || c_custkey AS ou, c_name, n_name, r_name
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        bridge AS (
            SELECT DISTINCT r_name, substr(p_brand, 1, 7) AS area, p_brand AS de
            FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
                 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        expected AS (SELECT r_name, area, count(*) AS expected FROM bridge GROUP BY r_name, area),
        reported AS (
            SELECT ou, period, substr(de, 1, 7) AS area, count(DISTINCT de) AS reported
            FROM obs GROUP BY ou, period, substr(de, 1, 7))
        SELECT l.de AS data_element_uid, lower(l.de) AS data_element_name,
               l.coc AS category_option_combo_uid,
               CASE WHEN l.coc <> 'N' THEN lower(l.coc) END AS category_option_combo_name,
               b.r_name || '/' || b.area AS program_uid, b.r_name AS program_name,
               substr(l.de, 1, 7) AS health_area, l.ou AS org_unit_uid, u.c_name AS facility_name,
               u.n_name AS district_name, CAST(NULL AS VARCHAR) AS region_name, u.r_name AS country_name,
               l.period, l.period AS year_month, CAST(year(l.updated) AS INTEGER) AS year,
               CAST(month(l.updated) AS INTEGER) AS month,
               CAST(year(l.updated) AS VARCHAR) || 'Q' || CAST(quarter(l.updated) AS VARCHAR) AS quarter,
               l.raw_value, CAST(l.raw_value AS DOUBLE) AS numeric_value,
               CAST(NULL AS BOOLEAN) AS boolean_value, l.stored_by,
               strftime(l.created, '%Y-%m-%d') AS created_at, strftime(l.updated, '%Y-%m-%d') AS last_updated_at,
               l.raw_value = '0' AS is_explicit_zero, l.raw_value IS NULL AS is_missing_value,
               date_diff('day', last_day(l.updated), CAST(l.updated AS DATE)) > 60 AS is_late_reported,
               r.reported AS reported_indicator_count, e.expected AS expected_indicator_count,
               CAST(r.reported AS DOUBLE) / e.expected AS completeness_score
        FROM latest l JOIN units u ON u.ou = l.ou
             LEFT JOIN bridge b ON b.de = l.de AND b.r_name = u.r_name
             LEFT JOIN expected e ON e.r_name = u.r_name AND e.area = substr(l.de, 1, 7)
             LEFT JOIN reported r ON r.ou = l.ou AND r.period = l.period AND r.area = substr(l.de, 1, 7)
    """,
    **fact_queries.ORACLES,
}
