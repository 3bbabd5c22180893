"""The same answers in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

FIRST, LAST = "1995-03-15", "1997-10-20"
MONEY = "DECIMAL(38,2)"

# Common tables, in order of dependence. Each query names the last one it needs.
_TABLES = {
    "lines": """
        SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk,
               l_returnflag = 'R' AS returned,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
               CAST(l_quantity AS BIGINT) AS q,
               o_orderdate, o_custkey, n_name, p_name
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        JOIN part ON p_partkey = l_partkey
    """,
    "planted": """
        SELECT (((ok * 8 + ln) * 32768 + pk) * 1024 + sk) * 100000 + cents % 100000 AS id,
               CASE WHEN returned AND ln <= 2 THEN CASE WHEN ok % 2 = 0 THEN 'C' ELSE 'c' END
                    ELSE '' END || CAST(500000 + ok AS VARCHAR) AS invoice_no,
               CASE pk % 97 WHEN 0 THEN 'POST' WHEN 1 THEN 'M' WHEN 2 THEN 'm' WHEN 3 THEN 'DOT'
                    WHEN 4 THEN 'BANK CHARGES' ELSE CAST(10000 + pk AS VARCHAR) END AS stock_code,
               CASE WHEN pk % 50 = 7 THEN NULL ELSE p_name END AS description,
               CAST(CASE WHEN returned AND ln <= 3 AND NOT (ln = 1 AND ok % 50 = 0)
                    THEN -q ELSE q END AS INTEGER) AS quantity,
               CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(ok % 24 AS BIGINT)) AS invoice_date,
               CASE WHEN (ok + ln) % 150 = 0 THEN CAST(0 AS DECIMAL(10,2))
                    ELSE CAST(CAST((cents - cents % q) // q AS DECIMAL(16,0))
                              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS unit_price,
               CAST(CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS INTEGER)
                   AS customer_id,
               CASE WHEN o_custkey % 211 = 1 THEN NULL ELSE n_name END AS country
        FROM lines
    """,
    "tx": """
        SELECT * FROM planted
        UNION ALL
        SELECT -id, * EXCLUDE (id) FROM planted WHERE id % 503 = 3
    """,
    "txf": """
        SELECT *,
               invoice_no ILIKE 'c%' AS is_cancellation,
               customer_id IS NULL AS is_missing_customer,
               quantity < 0 AS is_return,
               unit_price <= 0 AS is_invalid_price,
               upper(stock_code) IN ('POST', 'M', 'DOT', 'C2', 'BANK CHARGES', 'AMAZONFEE')
                   AS is_non_product,
               quantity < 0 AND invoice_no NOT ILIKE 'c%' AS is_stock_adjustment,
               CAST(quantity * unit_price AS DECIMAL(38,2)) AS total_value
        FROM tx
    """,
    "revenue": """
        SELECT * FROM txf
        WHERE NOT is_non_product AND NOT is_invalid_price AND NOT is_stock_adjustment
    """,
    "sales": """
        SELECT * FROM txf
        WHERE customer_id IS NOT NULL AND NOT is_cancellation AND NOT is_stock_adjustment
          AND quantity > 0 AND unit_price > 0
    """,
    "rfm": """
        SELECT customer_id,
               CAST(date_diff('day', CAST(max(invoice_date) AS DATE),
                    CAST((SELECT max(invoice_date) FROM tx) AS DATE)) AS INTEGER) AS recency_days,
               count(DISTINCT upper(invoice_no)) AS frequency,
               sum(total_value) AS monetary
        FROM sales GROUP BY customer_id
    """,
    "clustered": """
        SELECT customer_id, recency_days, frequency,
               CAST(monetary AS DECIMAL(12,2)) AS monetary,
               CASE WHEN recency_days <= 180 AND frequency >= 11 THEN 0
                    WHEN recency_days > 300 THEN 1 ELSE 2 END AS cluster
        FROM rfm
    """,
    "medians": """
        SELECT median(CAST(recency_days AS DOUBLE)) AS r, median(CAST(frequency AS DOUBLE)) AS f,
               median(CAST(monetary AS DOUBLE)) AS m
        FROM clustered
    """,
    "means": """
        SELECT cluster, avg(recency_days) AS r, avg(frequency) AS f,
               avg(CAST(monetary AS DOUBLE)) AS m
        FROM clustered GROUP BY cluster
    """,
    "names": """
        SELECT cluster,
               CASE WHEN recent AND frequent AND high THEN 'Champions'
                    WHEN NOT recent AND NOT frequent AND NOT high THEN 'Lost / Lapsed'
                    WHEN recent AND NOT frequent AND NOT high THEN 'New / Low-Engagement'
                    WHEN NOT recent THEN 'Occasional / Low-value'
                    ELSE 'Regular' END AS segment_name
        FROM (SELECT cluster, means.r <= medians.r AS recent, means.f >= medians.f AS frequent,
                     means.m >= medians.m AS high
              FROM means, medians)
    """,
    "segments": """
        SELECT customer_id, recency_days, frequency, monetary, cluster, segment_name
        FROM clustered JOIN names USING (cluster)
    """,
    "logged": """
        SELECT *, ln(1 + CAST(frequency AS DOUBLE)) AS log_frequency,
               ln(1 + greatest(CAST(monetary AS DOUBLE), 0)) AS log_monetary
        FROM segments
    """,
    "scaled": """
        SELECT *,
               (recency_days - (SELECT avg(recency_days) FROM logged))
                   / (SELECT stddev_pop(recency_days) FROM logged) AS x,
               (log_frequency - (SELECT avg(log_frequency) FROM logged))
                   / (SELECT stddev_pop(log_frequency) FROM logged) AS y,
               (log_monetary - (SELECT avg(log_monetary) FROM logged))
                   / (SELECT stddev_pop(log_monetary) FROM logged) AS z
        FROM logged
    """,
    "stats": """
        SELECT segment_name, count(*) AS customer_count,
               CAST(round(round(sum(recency_days) / count(*), 4), 1) AS DECIMAL(18,1))
                   AS avg_recency_days,
               CAST(round(round(sum(frequency) / count(*), 4), 1) AS DECIMAL(18,1))
                   AS avg_frequency,
               CAST(round(round(CAST(sum(monetary) AS DOUBLE) / count(*), 6), 2)
                   AS DECIMAL(18,2)) AS avg_monetary
        FROM segments GROUP BY segment_name
    """,
    "scores": """
        SELECT id AS transaction_id,
               CAST((total_value - 103000) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(10,6))
                   AS anomaly_score,
               total_value > 103000 AS is_anomaly
        FROM (SELECT id, CAST(total_value AS DECIMAL(18,2)) AS total_value FROM sales)
    """,
    "detail": """
        SELECT transaction_id, invoice_no, customer_id, country, quantity, unit_price, total_value,
               invoice_date, anomaly_score, is_anomaly
        FROM scores JOIN txf ON id = transaction_id
    """,
    "overview": """
        SELECT CAST(count_if(is_anomaly) AS BIGINT) AS total_anomalies, count(*) AS total_scored,
               round(100.0 * CAST(count_if(is_anomaly) AS DOUBLE) / count(*), 2) AS pct_anomalous
        FROM scores
    """,
    "flagged_customers": """
        SELECT customer_id, count(*) AS anomaly_count,
               CAST(round(round(sum(quantity) / count(*), 4), 1) AS DECIMAL(18,1)) AS avg_quantity,
               CAST(round(round(CAST(sum(total_value) AS DOUBLE) / count(*), 6), 2)
                   AS DECIMAL(18,2)) AS avg_order_value,
               max(country) AS country
        FROM detail WHERE is_anomaly AND customer_id IS NOT NULL
        GROUP BY customer_id
        ORDER BY anomaly_count DESC, customer_id
    """,
    "raw": """
        SELECT CASE WHEN abs(id) % 1009 = 5 THEN NULL ELSE invoice_no END AS invoice_no,
               stock_code,
               CASE WHEN abs(id) % 401 = 7 THEN 'nan' ELSE description END AS description,
               CASE WHEN abs(id) % 211 = 3 THEN 'n/a'
                    WHEN abs(id) % 223 = 5 THEN quantity || '.0'
                    ELSE CAST(quantity AS VARCHAR) END AS quantity,
               CASE WHEN abs(id) % 307 = 2 THEN 'not a date'
                    WHEN abs(id) % 311 = 4 THEN strftime(invoice_date, '%-m/%-d/%Y %-H:%M')
                    ELSE strftime(invoice_date, '%Y-%m-%d %H:%M:%S') END AS invoice_date,
               CASE WHEN abs(id) % 419 = 6 THEN 'free'
                    ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
               customer_id || '.0' AS customer_id,
               CASE WHEN abs(id) % 17 = 1 THEN 'CÔTE D''IVOIRE' ELSE country END AS country
        FROM tx
    """,
    "typed": """
        SELECT invoice_no, stock_code, nullif(description, 'nan') AS description,
               CAST(round(TRY_CAST(quantity AS DOUBLE)) AS INTEGER) AS quantity,
               coalesce(TRY_CAST(invoice_date AS TIMESTAMP),
                        try_strptime(invoice_date, '%m/%d/%Y %H:%M')) AS invoice_date,
               TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
               TRY_CAST(TRY_CAST(customer_id AS DOUBLE) AS INTEGER) AS customer_id,
               country
        FROM raw
    """,
    "usable": """
        SELECT * FROM typed
        WHERE invoice_no IS NOT NULL AND stock_code IS NOT NULL AND invoice_date IS NOT NULL
          AND quantity IS NOT NULL AND unit_price IS NOT NULL
    """,
    "history": """
        SELECT conv_id * 1000 + turn AS id, role AS narrative_type,
               CASE WHEN conv_id % 7 = 0 THEN NULL ELSE 'k' || CAST(conv_id % 50 AS VARCHAR) END
                   AS reference_key,
               '{"conv_id":' || conv_id || ',"turn":' || turn || '}' AS input_stats,
               text AS narrative_text,
               TIMESTAMP '2024-01-01' + to_minutes(CAST(turn // 2 AS BIGINT)) AS generated_at
        FROM conversations
    """,
    "newest": """
        SELECT n1.* FROM history n1
        WHERE NOT EXISTS (
            SELECT 1 FROM history n2
            WHERE n1.narrative_type = n2.narrative_type
              AND n1.reference_key IS NOT DISTINCT FROM n2.reference_key AND n1.id < n2.id)
    """,
    "incoming": """
        SELECT conv_id * 100 + turn AS seq, role AS narrative_type,
               CASE WHEN conv_id % 11 = 0 THEN NULL ELSE 'k' || CAST(conv_id % 60 AS VARCHAR) END
                   AS reference_key,
               '{"conv_id":' || conv_id || ',"turn":' || turn || '}' AS input_stats,
               'new: ' || text AS narrative_text
        FROM conversations
    """,
    "segment_texts": """
        SELECT row_number() OVER (ORDER BY avg_monetary DESC, segment_name) AS seq,
               'segment' AS narrative_type, segment_name AS reference_key,
               segment_name || ': ' || customer_count || ' customers, ' || avg_recency_days
                   || ' days since the last purchase on average, ' || avg_frequency
                   || ' orders and $' || avg_monetary || ' spent per customer.' AS narrative_text,
               CAST(to_json({'segment_name': segment_name, 'customer_count': customer_count,
                        'avg_recency_days': avg_recency_days, 'avg_frequency': avg_frequency,
                        'avg_monetary': avg_monetary}) AS VARCHAR) AS facts
        FROM stats
    """,
    "anomaly_text": """
        SELECT CAST(6 AS BIGINT) AS seq, 'anomaly' AS narrative_type,
               'anomaly_overview' AS reference_key,
               'Of ' || total_scored || ' transactions scored, ' || total_anomalies
                   || ' are unusual (' || pct_anomalous
                   || '%). Unusual does not mean wrong or fraudulent.' || chr(10)
                   || (SELECT string_agg('- Customer ' || customer_id || ' ('
                              || coalesce(country, 'unknown') || '): ' || anomaly_count
                              || ' unusual transactions, ' || avg_quantity || ' units and $'
                              || avg_order_value || ' on average.', chr(10)
                              ORDER BY anomaly_count DESC, customer_id)
                       FROM (FROM flagged_customers ORDER BY anomaly_count DESC, customer_id
                             LIMIT 3)) AS narrative_text,
               '{"overview":{"total_anomalies":"total_scored":"pct_anomalous":"top_customers":'
                   || '"customer_id":"anomaly_count":"avg_quantity":"avg_order_value":"country":'
                   || (SELECT string_agg(coalesce(country, 'null'), '|')
                       FROM (FROM flagged_customers ORDER BY anomaly_count DESC, customer_id
                             LIMIT 3)) AS facts
        FROM overview
    """,
    "executive_text": """
        SELECT CAST(7 AS BIGINT) AS seq, 'executive' AS narrative_type,
               CAST(NULL AS VARCHAR) AS reference_key,
               (SELECT string_agg(narrative_text, chr(10) || chr(10) ORDER BY seq)
                FROM segment_texts) || chr(10) || chr(10) || 'Anomalies: '
                   || (SELECT narrative_text FROM anomaly_text) AS narrative_text,
               CAST(to_json({'segment_narratives':
                        (SELECT string_agg(reference_key || '":"' || narrative_text, '|')
                         FROM segment_texts),
                        'anomaly_narrative': (SELECT narrative_text FROM anomaly_text)})
                    AS VARCHAR) AS facts
    """,
}

_NEEDS = {
    "planted": ["lines"],
    "tx": ["planted"],
    "txf": ["tx"],
    "revenue": ["txf"],
    "sales": ["txf"],
    "rfm": ["sales"],
    "clustered": ["rfm"],
    "medians": ["clustered"],
    "means": ["clustered"],
    "names": ["medians", "means"],
    "segments": ["names"],
    "logged": ["segments"],
    "scaled": ["logged"],
    "stats": ["segments"],
    "scores": ["sales"],
    "detail": ["scores"],
    "overview": ["scores"],
    "flagged_customers": ["detail"],
    "raw": ["tx"],
    "typed": ["raw"],
    "usable": ["typed"],
    "newest": ["history"],
    "segment_texts": ["stats"],
    "anomaly_text": ["overview", "flagged_customers"],
    "executive_text": ["segment_texts", "anomaly_text"],
}

SQL: dict[str, str] = {}


def _required(names: list[str]) -> list[str]:
    wanted: set[str] = set()
    waiting = list(names)
    while waiting:
        name = waiting.pop()
        if name not in wanted:
            wanted.add(name)
            waiting += _NEEDS.get(name, [])
    return [name for name in _TABLES if name in wanted]


def _add(query: str, needs: str, body: str) -> None:
    names = _required(needs.split()) if needs else []
    # Read more than once by the big statements, so compute each table once.
    tables = [f"{name} AS MATERIALIZED ({_TABLES[name].strip()})" for name in names]
    SQL[query] = ("WITH " + ",\n".join(tables) + "\n" if tables else "") + body.strip()


TX = (
    "id, invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, "
    "country"
)
FLAGS = (
    "is_cancellation, is_missing_customer, is_return, is_invalid_price, is_non_product, "
    "is_stock_adjustment"
)
RAW = TX.removeprefix("id, ")

_add("s1_read_raw_csv", "raw", f"SELECT {RAW} FROM raw")
_add("s2_select_source_columns", "raw", f"SELECT {RAW} FROM raw")
_add("s3_coerce_types", "typed", f"SELECT {RAW} FROM typed")
_add("s4_drop_unusable", "usable", f"SELECT {RAW} FROM usable")
_add(
    "s4_load_report",
    "typed usable",
    """SELECT (SELECT count(*) FROM typed) AS rows_read, (SELECT count(*) FROM usable) AS rows_kept,
       (SELECT count(*) FROM typed) - (SELECT count(*) FROM usable) AS rows_dropped""",
)
_DATE = "coalesce(TRY_CAST(invoice_date AS TIMESTAMP), try_strptime(invoice_date, '%m/%d/%Y %H:%M'))"
_NUMBER = "TRY_CAST({} AS DOUBLE)"
_PLANTED_GAPS = "{0} IS NULL OR {0} IN ('n/a', 'nan')"
_REASONS = ", ".join(
    f"count(*) FILTER ({condition}) AS {name}"
    for name, condition in {
        "malformed": "false",
        **{f"{name}_missing": _PLANTED_GAPS.format(name) for name in
           ("invoice_no", "stock_code", "invoice_date", "quantity", "unit_price")},
        "invoice_no_unreadable": "false",
        "stock_code_unreadable": "false",
        "invoice_date_unreadable": f"invoice_date IS NOT NULL AND {_DATE} IS NULL",
        "quantity_unreadable": f"NOT ({_PLANTED_GAPS.format('quantity')}) AND {_NUMBER.format('quantity')} IS NULL",
        "quantity_out_of_range": f"abs({_NUMBER.format('quantity')}) >= 2147483647.5",
        "unit_price_unreadable": f"unit_price IS NOT NULL AND {_NUMBER.format('unit_price')} IS NULL",
        "unit_price_out_of_range": f"abs({_NUMBER.format('unit_price')}) >= 99999999.995",
    }.items()
)
_add(
    "s4_load_reasons",
    "raw usable",
    f"""SELECT count(*) AS rows_read, (SELECT count(*) FROM usable) AS rows_kept,
       count(*) - (SELECT count(*) FROM usable) AS rows_dropped, CAST(0 AS BIGINT) AS rows_known,
       {_REASONS} FROM raw""",
)
_add(
    "s5_row_ids",
    "usable",
    f"""SELECT 1000 + row_number() OVER (ORDER BY invoice_date, invoice_no, stock_code, quantity, unit_price,
           customer_id NULLS FIRST, description NULLS FIRST, country NULLS FIRST) AS id,
       {RAW} FROM usable""",
)
_add(
    "s6_append_once",
    "usable",
    f"""SELECT row_number() OVER (ORDER BY invoice_date, invoice_no, stock_code, quantity, unit_price,
           customer_id NULLS FIRST, description NULLS FIRST, country NULLS FIRST) AS id,
       {RAW} FROM usable""",
)
_add(
    "s6_append_twice",
    "usable",
    """SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month,
       2 * count(*) AS row_count, CAST(2 * sum(quantity) AS BIGINT) AS units
       FROM usable GROUP BY 1""",
)
_add("s7_replace_twice", "segments", "SELECT * FROM segments")
_add("s8_projected_scan", "sales", "SELECT id, customer_id, quantity, unit_price FROM sales")
_DAILY = """SELECT CAST(invoice_date AS DATE) AS invoice_date,
    count(DISTINCT upper(invoice_no)) AS order_count, sum(total_value) AS revenue
    FROM {} GROUP BY 1"""
_add(
    "s9_export_csv",
    "revenue",
    f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({_DAILY.format('revenue')})",
)

# JSON as a writer escaping everything beyond ASCII gives it.
_ESCAPED = """array_to_string(list_transform(regexp_extract_all({0}, '(?s).'), lambda c:
    CASE WHEN unicode(c) > 65535 THEN
        '\\u' || printf('%04X', 55296 + (unicode(c) - 65536) // 1024)
        || '\\u' || printf('%04X', 56320 + (unicode(c) - 65536) % 1024)
    WHEN unicode(c) > 127 THEN '\\u' || printf('%04X', unicode(c)) ELSE c END), '')"""
_STATS = """CAST(to_json({'narrative_type': narrative_type, 'reference_key': reference_key,
    'source': {'id': id, 'text': narrative_text}}) AS VARCHAR)"""
_add(
    "s10_stats_json",
    "history",
    f"SELECT id, {_ESCAPED.format(_STATS)} AS input_stats FROM history",
)

for _position, _name in enumerate(FLAGS.split(", "), 1):
    _add(f"f{_position}_{_name}", "txf", f"SELECT id, {_name} FROM txf")
_add(
    "f7_reference_key_norm",
    "history",
    "SELECT id, coalesce(reference_key, '__none__') AS reference_key_norm FROM history",
)
_add("f8_line_value", "txf", "SELECT id, total_value FROM txf")
_add(
    "f9_genuine_sales",
    "txf",
    """SELECT id, customer_id IS NOT NULL AND NOT is_cancellation AND NOT is_stock_adjustment
        AND quantity > 0 AND unit_price > 0 AS is_genuine FROM txf""",
)

_add("v1_revenue_transactions", "revenue", f"SELECT {TX}, {FLAGS} FROM revenue")
_add(
    "v2_customer_transactions",
    "revenue",
    f"SELECT {TX}, {FLAGS} FROM revenue WHERE customer_id IS NOT NULL",
)
_add(
    "v3_net_sales",
    "revenue",
    """SELECT min(stock_code) AS stock_code, min(description) AS description,
       CAST(sum(quantity) AS BIGINT) AS net_quantity, sum(total_value) AS net_revenue
       FROM revenue GROUP BY upper(stock_code), upper(description)""",
)
_add("v4_anomaly_detail", "detail", "SELECT * FROM detail")

_PCT = "CASE WHEN n = 0 THEN NULL ELSE round_even(CAST(c AS DOUBLE) / n * 100, 2) END"
_add(
    "q1_cleaning_summary",
    "txf",
    f"""SELECT metric, CAST(c AS BIGINT) AS count,
        CASE WHEN metric = 'total_rows' THEN 100.0::DOUBLE ELSE {_PCT} END AS pct_of_total
        FROM (SELECT count(*) AS n FROM txf), (
            SELECT 'total_rows' AS metric, count(*) AS c FROM txf
            UNION ALL SELECT 'missing_customer_id', count_if(is_missing_customer) FROM txf
            UNION ALL SELECT 'negative_quantity', count_if(is_return) FROM txf
            UNION ALL SELECT 'zero_or_negative_price', count_if(is_invalid_price) FROM txf
            UNION ALL SELECT 'non_product_stock_codes', count_if(is_non_product) FROM txf
            UNION ALL SELECT 'cancellation_invoices', count_if(is_cancellation) FROM txf
            UNION ALL SELECT 'stock_adjustments', count_if(is_stock_adjustment) FROM txf)""",
)
_add(
    "q2_exact_duplicates",
    "tx",
    """SELECT min(invoice_no) AS invoice_no, min(stock_code) AS stock_code,
       min(description) AS description, quantity, invoice_date, unit_price, customer_id,
       min(country) AS country, count(*) AS occurrences
       FROM tx
       GROUP BY upper(invoice_no), upper(stock_code), upper(description), quantity, invoice_date,
                unit_price, customer_id, upper(country)
       HAVING count(*) > 1""",
)
_add(
    "q3_date_range",
    "tx",
    """SELECT min(invoice_date) AS earliest, max(invoice_date) AS latest, count(*) AS total_rows
       FROM tx""",
)
_add(
    "q4_outside_window",
    "txf",
    f"""SELECT {TX}, {FLAGS} FROM txf
        WHERE invoice_date < TIMESTAMP '{FIRST}' OR invoice_date > TIMESTAMP '{LAST}'
        ORDER BY id LIMIT 50""",
)
_add(
    "q5_cancellation_by_sign",
    "txf",
    """SELECT is_cancellation, quantity < 0 AS is_negative_qty, count(*) AS row_count
       FROM txf GROUP BY ALL""",
)
_add(
    "q6_stock_adjustment_rows",
    "txf",
    """SELECT stock_code, description, quantity, unit_price, invoice_no, customer_id, country
       FROM txf WHERE NOT is_cancellation AND quantity < 0 ORDER BY quantity, id LIMIT 30""",
)
_add(
    "q7_stock_adjustment_tally",
    "txf",
    """SELECT min(stock_code) AS stock_code, min(description) AS description,
       count(*) AS occurrences, CAST(sum(quantity) AS BIGINT) AS total_qty
       FROM txf WHERE NOT is_cancellation AND quantity < 0
       GROUP BY upper(stock_code), upper(description)
       ORDER BY occurrences DESC, upper(stock_code) NULLS FIRST, upper(description) NULLS FIRST
       LIMIT 20""",
)
_add(
    "q8_cancelled_not_negative",
    "txf",
    f"SELECT {TX}, {FLAGS} FROM txf WHERE is_cancellation AND quantity >= 0",
)
_NOT_NULL = " UNION ALL ".join(
    f"SELECT '{name} not null' AS rule, count(*) - count({name}) AS violations FROM tx"
    for name in ("invoice_no", "stock_code", "invoice_date", "quantity", "unit_price")
)
_add(
    "q9_constraint_audit",
    "tx segments scores history",
    f"""{_NOT_NULL}
        UNION ALL SELECT 'transactions id unique', count(*)
            FROM (SELECT id FROM tx GROUP BY id HAVING count(*) > 1)
        UNION ALL SELECT 'transaction_anomalies transaction_id unique', count(*)
            FROM (SELECT 1 FROM scores GROUP BY transaction_id HAVING count(*) > 1)
        UNION ALL SELECT 'transaction_anomalies transaction_id references transactions', count(*)
            FROM scores ANTI JOIN tx ON id = transaction_id
        UNION ALL SELECT 'customer_segments customer_id unique', count(*)
            FROM (SELECT 1 FROM segments GROUP BY customer_id HAVING count(*) > 1)
        UNION ALL SELECT 'narratives (type, key) unique', count(*)
            FROM (SELECT 1 FROM history GROUP BY upper(narrative_type), upper(reference_key)
                  HAVING count(*) > 1)""",
)

_add("r1_rfm", "rfm", "SELECT * FROM rfm")
_add(
    "r2_log_features",
    "logged",
    """SELECT customer_id, round(log_frequency, 6) AS log_frequency,
       round(log_monetary, 6) AS log_monetary FROM logged""",
)
_add(
    "r3_scaled_features",
    "scaled",
    """SELECT customer_id, round(x, 6) + 0.0::DOUBLE AS scaled_recency_days,
       round(y, 6) + 0.0::DOUBLE AS scaled_log_frequency,
       round(z, 6) + 0.0::DOUBLE AS scaled_log_monetary FROM scaled""",
)
# Mean distance of each customer to each cluster over all pairs; itself counts nothing.
_SILHOUETTE = """
    WITH pairs AS (
        SELECT a.customer_id, a.cluster, b.cluster AS other, sum({distance}) AS total,
               count(*) - CASE WHEN a.cluster = b.cluster THEN 1 ELSE 0 END AS points
        FROM scaled a, scaled b GROUP BY 1, 2, 3),
    sides AS (
        SELECT customer_id, cluster,
               max(CASE WHEN cluster = other AND points > 0 THEN total / points END) AS inner_mean,
               min(CASE WHEN cluster <> other THEN total / points END) AS outer_mean
        FROM pairs GROUP BY 1, 2)
    SELECT customer_id, cluster,
           coalesce((outer_mean - inner_mean) / greatest(inner_mean, outer_mean), 0) AS silhouette
    FROM sides"""
_SQUARE = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)"
_add(
    "r5_euclidean_silhouette",
    "scaled",
    f"""SELECT customer_id, cluster, round(silhouette, 6) + 0.0::DOUBLE AS silhouette
        FROM ({_SILHOUETTE.format(distance=f"sqrt({_SQUARE})")})""",
)
_add(
    "r5_squared_silhouette",
    "scaled",
    f"""SELECT count(*) AS customers, round(avg(silhouette), 6) AS silhouette_squared
        FROM ({_SILHOUETTE.format(distance=_SQUARE)})""",
)
_add(
    "r4_lloyd_step",
    "scaled",
    """SELECT k, cluster, count(*) AS customers, round(avg(x), 6) + 0.0 AS scaled_recency_days,
           round(avg(y), 6) + 0.0 AS scaled_log_frequency, round(avg(z), 6) + 0.0 AS scaled_log_monetary
       FROM (
           SELECT customer_id, k, any_value(s.x) AS x, any_value(s.y) AS y, any_value(s.z) AS z,
                  CAST(arg_min(c, struct_pack(d := (s.x - m.x) ** 2 + (s.y - m.y) ** 2 + (s.z - m.z) ** 2, c := c)) AS INTEGER) AS cluster
           FROM scaled s,
               (SELECT row_number() OVER (ORDER BY customer_id) - 1 AS c, x, y, z FROM scaled) m,
               (VALUES (2), (3), (5)) AS ks(k)
           WHERE c < k
           GROUP BY customer_id, k)
       GROUP BY k, cluster""",
)
_add(
    "r6b_assign_to_centroids",
    "scaled",
    """SELECT customer_id, arg_min(c, struct_pack(d := d, c := c)) AS cluster FROM (
           SELECT customer_id, m.cluster AS c,
                  (s.x - m.x) ** 2 + (s.y - m.y) ** 2 + (s.z - m.z) ** 2 AS d
           FROM scaled s, (SELECT cluster, avg(x) AS x, avg(y) AS y, avg(z) AS z
                           FROM scaled GROUP BY cluster) m)
       GROUP BY customer_id""",
)
_add(
    "r7_overall_medians",
    "medians",
    """SELECT round(r, 4) AS recency_days, round(f, 4) AS frequency, round(m, 4) AS monetary
       FROM medians""",
)
_add(
    "r8_cluster_means",
    "means",
    """SELECT cluster, round(r, 4) AS recency_days, round(f, 4) AS frequency,
       round(m, 4) AS monetary FROM means""",
)
_add("r9_label_segments", "segments", "SELECT customer_id, cluster, segment_name FROM segments")
_add(
    "r10_segment_profile",
    "segments",
    """SELECT cluster, segment_name,
       round(avg(recency_days), 4) AS recency_days_mean, count(*) AS recency_days_count,
       round(avg(frequency), 4) AS frequency_mean, count(*) AS frequency_count,
       round(avg(CAST(monetary AS DOUBLE)), 4) AS monetary_mean, count(*) AS monetary_count
       FROM segments GROUP BY 1, 2""",
)
_add("r11_segment_stats", "stats", "SELECT * FROM stats")
_add(
    "r12_segment_shares",
    "segments",
    """SELECT segment_name, count(*) AS customer_count,
       round(100.0 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM segments), 2)
           AS pct_of_customers
       FROM segments GROUP BY 1""",
)
_add("r13_segment_table", "segments", "SELECT * FROM segments")

_add(
    "a1_sale_features",
    "sales",
    """SELECT id, customer_id, quantity, unit_price, total_value,
       CAST(hour(invoice_date) AS INTEGER) AS invoice_hour,
       CAST(dayofweek(invoice_date) + 1 AS INTEGER) AS invoice_dow FROM sales""",
)
_add(
    "a2_log_features",
    "sales",
    """SELECT id, round(ln(1 + CAST(quantity AS DOUBLE)), 6) AS log_quantity,
       round(ln(1 + CAST(unit_price AS DOUBLE)), 6) AS log_unit_price,
       round(ln(1 + CAST(total_value AS DOUBLE)), 6) AS log_total_value FROM sales""",
)
_CUT = """
    WITH scored AS (SELECT id, CAST(total_value AS DOUBLE) / 1000000 AS s FROM sales),
    shifted AS (
        SELECT id, s - (SELECT quantile_cont(s, 0.99) FROM scored) AS anomaly_score FROM scored)
"""
_add(
    "a5_flag_top_share",
    "sales",
    f"""SELECT * FROM ({_CUT} SELECT id, round(anomaly_score, 6) + 0.0::DOUBLE AS anomaly_score,
        anomaly_score > 0 AS is_anomaly FROM shifted)""",
)
_add(
    "a6_top_anomalies",
    "detail",
    """SELECT transaction_id AS id, customer_id, quantity, unit_price, total_value, anomaly_score
       FROM detail ORDER BY anomaly_score DESC, id LIMIT 50""",
)
_add(
    "a7_score_table",
    "sales",
    f"""SELECT * FROM ({_CUT} SELECT id AS transaction_id,
        CAST(anomaly_score AS DECIMAL(10,6)) AS anomaly_score,
        anomaly_score > 0 AS is_anomaly FROM shifted)""",
)
_add("a8_flagged_detail", "detail", "SELECT * FROM detail WHERE is_anomaly")
_add("a9_anomaly_overview", "overview", "SELECT * FROM overview")
_add("a10_top_flagged_customers", "flagged_customers", "FROM flagged_customers LIMIT 10")
_add(
    "a11_customer_concentration",
    "flagged_customers overview",
    """SELECT n AS top_anomalies, total_anomalies,
       round(100.0 * CAST(n AS DOUBLE) / total_anomalies, 2) AS pct_of_anomalies
       FROM overview, (SELECT CAST(sum(anomaly_count) AS BIGINT) AS n
                       FROM (FROM flagged_customers LIMIT 3))""",
)

_TOP = """SELECT min(stock_code) AS stock_code, min(description) AS description,
    CAST(sum(quantity) AS BIGINT) AS units_sold, sum(total_value) AS revenue
    FROM {} GROUP BY upper(stock_code), upper(description)
    ORDER BY revenue DESC, upper(min(stock_code)) NULLS FIRST,
             upper(min(description)) NULLS FIRST LIMIT {}"""
_MONTHLY = """SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month,
    count(DISTINCT upper(invoice_no)) AS order_count, sum(total_value) AS revenue
    FROM {} GROUP BY 1"""
_FIGURES = """SELECT sum(total_value) AS total_revenue,
    count(DISTINCT upper(invoice_no)) AS total_orders,
    count(DISTINCT customer_id) AS distinct_customers,
    count(DISTINCT upper(stock_code)) AS distinct_products,
    least(20, count(DISTINCT (upper(stock_code), upper(description)))) AS products_tracked,
    (SELECT CAST(count_if(is_anomaly) AS BIGINT) FROM scores) AS anomalies_flagged FROM {}"""
_SLICED = f"""(SELECT * FROM revenue WHERE CAST(invoice_date AS DATE)
    BETWEEN DATE '{FIRST}' AND DATE '{LAST}')"""
_add("d1_daily_revenue", "revenue", _DAILY.format("revenue"))
_add("d2_top_products", "revenue", _TOP.format("revenue", 20))
_add("d3_monthly_revenue", "revenue", _MONTHLY.format("revenue"))
_add("d4_headline_figures", "revenue scores", _FIGURES.format("revenue"))
_add("d5_sliced_daily_revenue", "revenue", _DAILY.format(_SLICED))
_add("d5_sliced_top_products", "revenue", _TOP.format(_SLICED, 10))
_add("d5_sliced_monthly_revenue", "revenue", _MONTHLY.format(_SLICED))
_add("d5_sliced_headline_figures", "revenue scores", _FIGURES.format(_SLICED))
_add(
    "d6_latest_narratives",
    "history",
    """SELECT n.narrative_type, n.reference_key, n.narrative_text, n.generated_at
       FROM history n JOIN (SELECT narrative_type AS t, reference_key AS k, max(generated_at) AS g
                            FROM history GROUP BY 1, 2) m
       ON n.narrative_type = m.t AND n.reference_key IS NOT DISTINCT FROM m.k
          AND n.generated_at = m.g""",
)

_FIELDS = "seq, narrative_type, reference_key, narrative_text"
_add("n1_segment_narratives", "segment_texts", f"SELECT {_FIELDS} FROM segment_texts")
_add("n2_anomaly_narrative", "anomaly_text", f"SELECT {_FIELDS} FROM anomaly_text")
_add("n3_executive_narrative", "executive_text", f"SELECT {_FIELDS} FROM executive_text")

_STARTERS = (
    "'our', 'this', 'these', 'those', 'given', 'by', 'we', 'it', 'the', 'a', 'an', 'that', 'with', "
    "'as', 'since', 'while', 'in', 'for', 'to', 'and', 'but', 'so', 'average', 'customers', "
    "'segment'"
)


def _fact_check(keys: str, source: str) -> str:
    """``source`` has the columns ``keys``, ``body`` and ``facts``. A capitalised word is a whole
    run of word characters made of a capital and more Latin letters."""
    return f"""
        WITH source AS MATERIALIZED (SELECT {keys}, body, lower({_ESCAPED.format("facts")}) AS facts
                        FROM ({source})),
        checked AS (
            SELECT {keys}, list_filter(
                regexp_extract_all(body, '[\\p{{L}}\\p{{N}}_]+'),
                lambda w: regexp_full_match(w, '[A-Z][a-zA-Z]+')
                    AND lower(w) NOT IN ({_STARTERS}) AND NOT contains(facts, lower(w))) AS terms
            FROM source)
        SELECT {keys}, CAST(len(terms) AS BIGINT) AS flagged_count,
               array_to_string(terms, ' ') AS flagged_terms
        FROM checked"""


_add(
    "n4_fact_check_documents",
    "",
    _fact_check(
        "doc_id",
        """SELECT doc_id, text AS body, CAST(to_json({'lang': lang, 'source': source,
           'n_chars': n_chars}) AS VARCHAR) AS facts FROM documents""",
    ),
)
_add(
    "n4_fact_check_replies",
    "",
    _fact_check(
        "conv_id, turn",
        """SELECT t.conv_id, t.turn, t.text AS body,
           CAST(to_json({'role': t.role, 'prompt': p.text}) AS VARCHAR) AS facts
           FROM conversations t
           LEFT JOIN conversations p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1""",
    ),
)
_add(
    "n5_stored_findings",
    "executive_text",
    f"""SELECT * FROM ({_fact_check(
        "seq, narrative_type",
        '''SELECT seq, narrative_type, narrative_text AS body, CAST(facts AS VARCHAR) AS facts
           FROM (FROM segment_texts UNION ALL BY NAME FROM anomaly_text
                 UNION ALL BY NAME FROM executive_text)''',
    )})""",
)
_add("n6_newest_by_id", "newest", "SELECT * FROM newest")
_SAVED = """
    SELECT narrative_type, reference_key, min(seq) AS seq, arg_max(input_stats, seq) AS input_stats,
           arg_max(narrative_text, seq) AS narrative_text
    FROM incoming {} GROUP BY narrative_type, reference_key"""
_UPSERT = """
    SELECT coalesce(o.id, (SELECT max(id) FROM newest) + n.seq) AS id,
           coalesce(o.narrative_type, n.narrative_type) AS narrative_type,
           CASE WHEN o.id IS NULL THEN n.reference_key ELSE o.reference_key END AS reference_key,
           coalesce(n.input_stats, o.input_stats) AS input_stats,
           coalesce(n.narrative_text, o.narrative_text) AS narrative_text,
           CASE WHEN n.seq IS NULL THEN o.generated_at
                ELSE TIMESTAMP '2024-06-01 12:00:00' END AS generated_at
    FROM newest o FULL JOIN ({}) n
    ON o.narrative_type = n.narrative_type
       AND coalesce(o.reference_key, '-') = coalesce(n.reference_key, '-')"""
_add("n7_upsert", "newest incoming", _UPSERT.format(_SAVED.format("")))
_add(
    "n8_regenerate_one_type",
    "newest incoming",
    _UPSERT.format(_SAVED.format("WHERE narrative_type = 'assistant'")),
)
