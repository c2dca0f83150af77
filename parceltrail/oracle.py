"""DuckDB SQL with the same result as the registered query of the same name."""

from __future__ import annotations

# --- shared parts: the layers as common table expressions -------------------------------------

# The region of each state, written out so that the check does not rest on the code it checks.
_REGION_ROWS = """
    ('SP', 'Sudeste'), ('RJ', 'Sudeste'), ('MG', 'Sudeste'), ('ES', 'Sudeste'),
    ('PR', 'Sul'), ('SC', 'Sul'), ('RS', 'Sul'),
    ('AC', 'Norte'), ('AP', 'Norte'), ('AM', 'Norte'), ('PA', 'Norte'), ('RO', 'Norte'),
    ('RR', 'Norte'), ('TO', 'Norte'),
    ('AL', 'Nordeste'), ('BA', 'Nordeste'), ('CE', 'Nordeste'), ('MA', 'Nordeste'), ('PB', 'Nordeste'),
    ('PE', 'Nordeste'), ('PI', 'Nordeste'), ('RN', 'Nordeste'), ('SE', 'Nordeste'),
    ('DF', 'Centro-Oeste'), ('GO', 'Centro-Oeste'), ('MT', 'Centro-Oeste'), ('MS', 'Centro-Oeste')"""

_CAPITALISE = """array_to_string(list_transform(
           regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'),
           lambda w: (CASE WHEN w[1] = 'ß' THEN 'ß' ELSE upper(w[1]) END) || w[2:]), '')"""

_CITY = _CAPITALISE.format(
    text="""['mogi-guacu d''oeste', 'SAO PAULO', 'Embu-GUACU', 'são JOSÉ'][CAST(s_suppkey % 4 AS INTEGER) + 1]
                       || ' ' || replace(s_name, '#', '-')"""
)

_CTES = {
    "order_rows": """
        SELECT o.*, 0 AS version FROM orders o
        UNION ALL
        SELECT o.*, 1 AS version FROM orders o WHERE o_orderkey % 10 = 0""",
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE WHEN version = 1 THEN 'created' WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
               CASE WHEN version = 1 OR o_orderkey % 97 <> 0
                    THEN o_orderdate + to_seconds((o_orderkey * 37) % 86400) - to_hours(version)
               END AS purchase_timestamp,
               o_orderdate + to_days(2) AS delivered_carrier_date,
               CASE WHEN o_orderkey % 50 <> 0
                    THEN o_orderdate + to_days(CAST((o_orderkey * 7 + o_custkey) % 60 AS INTEGER))
                                     + to_hours(o_orderkey % 24)
               END AS delivered_customer_date,
               o_orderdate + to_days(30) AS estimated_delivery_date
        FROM order_rows""",
    "silver_orders": """
        SELECT order_id, customer_id, order_status, purchase_timestamp,
               purchase_timestamp + to_hours(1) AS approved_at, delivered_carrier_date,
               delivered_customer_date, estimated_delivery_date,
               if(order_status = 'delivered',
                  CAST(extract('day' FROM delivered_customer_date - estimated_delivery_date)
                       AS INTEGER), NULL) AS delay_days,
               coalesce(order_status = 'delivered'
                        AND delivered_customer_date > estimated_delivery_date, FALSE) AS is_late
        FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id
                                   ORDER BY purchase_timestamp DESC NULLS FIRST) = 1""",
    "silver_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               CAST(l_quantity AS DECIMAL(10,2)) AS freight_value,
               CAST(CAST(l_extendedprice AS DECIMAL(10,2)) + CAST(l_quantity AS DECIMAL(10,2))
                    AS DECIMAL(11,2)) AS total_item_value
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS FIRST, product_id DESC NULLS FIRST,
                     seller_id DESC NULLS FIRST, price DESC NULLS FIRST,
                     freight_value DESC NULLS FIRST) = 1""",
    "silver_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               coalesce(array_to_string(list_transform(
                   regexp_extract_all(lower(replace(nullif(p_type, 'PROMO') || '_' || p_name, '_', ' ')),
                                      '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+'),
                   lambda w: upper(w[1]) || w[2:]), ''), 'Sem Categoria') AS product_category,
               CAST(length(p_name) + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS INTEGER)
                   AS name_length,
               CAST(length(p_type) AS INTEGER) AS description_length,
               p_size % 7 AS photos_qty,
               CAST(p_retailprice AS DECIMAL(10,2)) AS weight_g,
               CAST(p_size AS DECIMAL(10,2)) AS length_cm,
               CAST(p_size + 1 AS DECIMAL(10,2)) AS height_cm,
               CAST(p_size + 2 AS DECIMAL(10,2)) AS width_cm
        FROM part""",
    "silver_sellers": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               CAST(s_suppkey + CASE WHEN s_suppkey % 10 = 0 THEN 1 ELSE 0 END AS INTEGER)
                   AS zip_code_prefix,
               {_CITY} AS city,
               upper(['sp','rj','mg','es','pr','sc','rs','ac','ap','am','pa','ro','rr','to','al',
                      'ba','ce','ma','pb','pe','pi','rn','se','df','go','mt','ms','xx']
                     [CAST(s_suppkey % 28 AS INTEGER) + 1]) AS state
        FROM supplier""",
    "fact": """
        SELECT i.order_id, i.product_id, i.seller_id, o.purchase_timestamp, i.price,
               i.freight_value, i.total_item_value AS total_amount, o.delay_days, o.is_late
        FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id
        WHERE o.order_status = 'delivered'""",
    "dim_products": """
        SELECT product_id, product_category, weight_g,
               CAST(length_cm * height_cm * width_cm AS DECIMAL(32,6)) AS product_volume_cm3
        FROM silver_products""",
    "dim_sellers": """
        SELECT seller_id, city, state, region FROM silver_sellers LEFT JOIN regions USING (state)""",
    "regions": f"""
        SELECT * FROM (VALUES {_REGION_ROWS}) AS r(state, region)""",
}

_LAYER = {
    "silver_orders": ["order_rows", "raw_orders", "silver_orders"],
    "silver_items": ["silver_items"],
    "dim_products": ["silver_products", "dim_products"],
    "dim_sellers": ["silver_sellers", "regions", "dim_sellers"],
}
_LAYER["fact"] = [*_LAYER["silver_orders"], *_LAYER["silver_items"], "fact"]


def _sql(body: str, *layers: str, **ctes: str) -> str:
    names = dict.fromkeys(name for layer in layers for name in _LAYER.get(layer, [layer]))
    parts = {**{name: _CTES[name] for name in names}, **ctes}
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + body


def _calendar(source: str, ts: str, step_from: str = "lo", step_to: str = "hi") -> str:
    return f"""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
               CAST(extract('year' FROM d) AS INTEGER) AS year,
               CAST(extract('month' FROM d) AS INTEGER) AS month,
               rpad(monthname(d), 9, ' ') AS month_name,
               CAST(extract('quarter' FROM d) AS INTEGER) AS quarter,
               CAST(extract('week' FROM d) AS INTEGER) AS week_of_year,
               CAST(extract('dow' FROM d) AS INTEGER) AS day_of_week,
               rpad(dayname(d), 9, ' ') AS day_name,
               extract('dow' FROM d) IN (0, 6) AS is_weekend
        FROM (SELECT unnest(generate_series({step_from}, {step_to}, INTERVAL 1 DAY)) AS d
              FROM (SELECT min({ts}) AS lo, max({ts}) AS hi FROM {source}))"""


# --- reports ----------------------------------------------------------------------------------

_PER_ORDER_OUTCOME = "bool_or(is_late) AS is_late, max(delay_days) AS delay_days"
_SHARE = """count(*) AS n_orders, count(*) FILTER (WHERE is_late) AS n_late,
       100.0::DOUBLE * count(*) FILTER (WHERE is_late) / count(*) AS pct_late"""
_LINES = f"""
        SELECT f.*, p.product_category, p.weight_g, p.product_volume_cm3, s.region
        FROM fact f LEFT JOIN dim_products p USING (product_id)
                    LEFT JOIN dim_sellers s USING (seller_id)"""


def _per_order(key: str) -> str:
    return f"SELECT {key}, order_id, {_PER_ORDER_OUTCOME} FROM lines GROUP BY {key}, order_id"


def _on_lines(body: str, **ctes: str) -> str:
    return _sql(body, "fact", "dim_products", "dim_sellers", lines=_LINES, **ctes)


def _late_by(key: str) -> str:
    return _on_lines(f"SELECT {key}, {_SHARE} FROM o GROUP BY {key}", o=_per_order(key))


def _average_delay(key: str) -> str:
    return _on_lines(
        f"""SELECT {key}, count(delay_days) AS n_dated,
       CAST(sum(delay_days) AS BIGINT) AS sum_delay_days,
       count(delay_days) FILTER (WHERE is_late) AS n_late,
       CAST(sum(delay_days) FILTER (WHERE is_late) AS BIGINT) AS sum_late_days,
       CAST(sum(delay_days) AS DOUBLE) / nullif(count(delay_days), 0) AS avg_delay_days,
       CAST(sum(delay_days) FILTER (WHERE is_late) AS DOUBLE)
           / nullif(count(delay_days) FILTER (WHERE is_late), 0) AS avg_late_days
FROM o GROUP BY {key}""",
        o=_per_order(key),
    )


def _top(measure: str, key: str, k: int) -> str:
    return f"""SELECT *, rank() OVER (ORDER BY {measure} DESC NULLS LAST) AS rank FROM r
ORDER BY {measure} DESC NULLS LAST, {key} ASC NULLS FIRST LIMIT {k}"""


def _top_by_delay(key: str, k: int) -> str:
    return f"WITH r AS ({_average_delay(key)}) {_top('avg_late_days', key, k)}"


def _ranked(key: str, k: int | None = None) -> str:
    return _on_lines(
        "SELECT *, rank() OVER (ORDER BY n_late DESC) AS rank FROM r" if k is None else _top("n_late", key, k),
        o=_per_order(key),
        r=f"SELECT {key}, {_SHARE} FROM o GROUP BY {key}",
    )


def _by_calendar(*attributes: str) -> str:
    columns = ", ".join(attributes)
    return _sql(
        f"SELECT {columns}, {_SHARE} FROM o LEFT JOIN dim_date USING (date_id) GROUP BY {columns}",
        "fact",
        dim_date=_calendar("fact", "purchase_timestamp"),
        o="""
        SELECT order_id, bool_or(is_late) AS is_late,
               CAST(strftime(max(purchase_timestamp), '%Y%m%d') AS INTEGER) AS date_id
        FROM fact GROUP BY order_id""",
    )


def _by_size(measure: str, low: int, high: int) -> str:
    return _on_lines(
        f"""SELECT band, {_SHARE}, CAST(sum(n) AS BIGINT) AS n_items,
       CAST(sum(freight) AS DECIMAL(38,2)) AS freight FROM o GROUP BY band""",
        o=f"""
        SELECT CASE WHEN {measure} < {low} THEN 0 WHEN {measure} < {high} THEN 1
                    WHEN {measure} IS NOT NULL THEN 2 END AS band,
               order_id, bool_or(is_late) AS is_late, count(*) AS n, sum(freight_value) AS freight
        FROM lines GROUP BY 1, 2""",
    )


def _by_quartile(measure: str, source: str) -> str:
    return _on_lines(
        f"""SELECT band, min(least) AS least, max(greatest) AS greatest, {_SHARE}, CAST(sum(n) AS BIGINT) AS n_items,
       CAST(sum(freight) AS DECIMAL(38,2)) AS freight FROM o GROUP BY band""",
        limits=f"""
        SELECT value, CAST((sum(n) OVER (ORDER BY value) - n) * 4 // sum(n) OVER () AS INTEGER) AS band
        FROM (SELECT {measure} AS value, count(*) AS n FROM {source} WHERE {measure} IS NOT NULL GROUP BY 1)""",
        o=f"""
        SELECT band, order_id, min({measure}) AS least, max({measure}) AS greatest,
               bool_or(is_late) AS is_late, count(*) AS n, sum(freight_value) AS freight
        FROM lines LEFT JOIN limits ON {measure} = value GROUP BY 1, 2""",
    )


_TREND = _on_lines(
    """SELECT measure, CAST(n AS BIGINT) AS n_items,
       round((n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0), 9) AS days_per_unit,
       round((n * sxy - sx * sy) / nullif(sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy), 0), 9) AS corr_delay,
       round((n * sxl - sx * sl) / nullif(sqrt(n * sxx - sx * sx) * sqrt(n * sl - sl * sl), 0), 9) AS corr_late
FROM sums""",
    points="""
        SELECT measure, CAST(x AS DECIMAL(14,2)) AS x, CAST(delay_days AS DECIMAL(7,0)) AS y,
               CAST(is_late AS DECIMAL(1,0)) AS late
        FROM (SELECT delay_days, CAST(is_late AS INTEGER) AS is_late,
                     unnest(['product_volume_cm3', 'weight_g', 'freight_value']) AS measure,
                     unnest([CAST(product_volume_cm3 AS DECIMAL(14,2)), CAST(weight_g AS DECIMAL(14,2)),
                             CAST(freight_value AS DECIMAL(14,2))]) AS x
              FROM lines WHERE delay_days IS NOT NULL)
        WHERE x IS NOT NULL""",
    sums="""
        SELECT measure, CAST(count(*) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS sx, CAST(sum(y) AS DOUBLE) AS sy,
               CAST(sum(late) AS DOUBLE) AS sl, CAST(sum(x * x) AS DOUBLE) AS sxx, CAST(sum(x * y) AS DOUBLE) AS sxy,
               CAST(sum(x * late) AS DOUBLE) AS sxl, CAST(sum(y * y) AS DOUBLE) AS syy
        FROM points GROUP BY measure""",
)


# --- nested records ---------------------------------------------------------------------------

_PEOPLE = """
        SELECT event_id, CAST(event_id % 3 + 1 AS INTEGER) AS number, event_type AS craft,
               user_id || '-' || unnest(generate_series(1, event_id % 3 + 1)) AS name
        FROM events"""

_NA = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND',
       '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""

_RUN_TS = "TIMESTAMP '2024-01-15 12:30:00'"

ORACLE = {
    "dedup_latest_item": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS order_item_id,
               max(l_shipdate) AS shipping_limit_date
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "dedup_latest_event": """
        SELECT user_id, event_type, ts, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1""",
    "dedup_any_product": "SELECT p_partkey, p_name, p_type FROM part",
    "dedup_any_seller": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "silver_orders": _sql(f"SELECT *, {_RUN_TS} AS updated_at FROM silver_orders", "silver_orders"),
    "silver_items": _sql(f"SELECT *, {_RUN_TS} AS updated_at FROM silver_items", "silver_items"),
    "silver_products": _sql(f"SELECT *, {_RUN_TS} AS updated_at FROM silver_products", "silver_products"),
    "silver_sellers": _sql(f"SELECT *, {_RUN_TS} AS updated_at FROM silver_sellers", "silver_sellers"),
    "delay_fractional": """
        SELECT event_id,
               CAST(extract('day' FROM ts - TIMESTAMP '2024-01-15 12:00:00') AS INTEGER)
                   AS delay_days,
               ts > TIMESTAMP '2024-01-15 12:00:00' AS is_late
        FROM events""",
    "initcap_words": "SELECT p_partkey, "
    + _CAPITALISE.format(text="concat_ws('-', upper(p_name), p_brand, 'd''oeste')")
    + " AS words FROM part",
    "initcap_documents": "SELECT doc_id, "
    + _CAPITALISE.format(text="text")
    + " AS words FROM documents",
    "casts_from_text": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderdate,
               CAST(CAST(o_totalprice AS DECIMAL(12,3)) AS DECIMAL(10,2)) AS o_totalprice
        FROM orders""",
    "csv_roundtrip": """
        SELECT o_orderkey, o_orderdate,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority,
               TIMESTAMP '2024-01-15 12:30:00' AS ingestion_date, TRUE AS has_file
        FROM orders""",
    "csv_quoted_text": f"""
        SELECT doc_id, CASE WHEN text NOT IN {_NA} THEN text END AS text FROM documents""",
    "csv_mixed_files": f"""
        SELECT doc_id, CASE WHEN text NOT IN {_NA} THEN text END AS text FROM documents""",
    "replace_load": "SELECT c_custkey, c_mktsegment FROM customer",
    "gold_fact": _sql("SELECT * FROM fact", "fact"),
    "gold_dim_sellers": _sql("SELECT * FROM dim_sellers", "dim_sellers"),
    "gold_dim_products": _sql("SELECT * FROM dim_products", "dim_products"),
    "gold_dim_date": _sql(_calendar("fact", "purchase_timestamp"), "fact"),
    "star_join": _sql(
        """SELECT * FROM (SELECT *, CAST(strftime(purchase_timestamp, '%Y%m%d') AS INTEGER) AS date_id
               FROM fact)
     LEFT JOIN dim_products USING (product_id) LEFT JOIN dim_sellers USING (seller_id)
     LEFT JOIN dim_date USING (date_id)""",
        "fact",
        "dim_products",
        "dim_sellers",
        dim_date=_calendar("fact", "purchase_timestamp"),
    ),
    "dim_date_of_events": _calendar("events", "ts"),
    "calendar_at_midnight": _calendar(
        "events", "ts", "CAST(CAST(lo AS DATE) AS TIMESTAMP)", "CAST(CAST(hi AS DATE) AS TIMESTAMP)"
    ),
    "kpi_sla": _on_lines(
        """SELECT count(*) AS n_orders, count(*) FILTER (WHERE is_late) AS n_late,
       count(*) FILTER (WHERE delay_days IS NULL) AS n_unknown,
       count(*) FILTER (WHERE NOT is_late) AS n_on_time,
       100.0::DOUBLE * count(*) FILTER (WHERE NOT is_late) / count(*) AS pct_on_time,
       100.0::DOUBLE * count(*) FILTER (WHERE is_late) / count(*) AS pct_late
FROM o""",
        o=f"SELECT order_id, {_PER_ORDER_OUTCOME} FROM lines GROUP BY order_id",
    ),
    "kpi_late_of_all_orders": _sql(f"SELECT {_SHARE} FROM silver_orders", "silver_orders"),
    "kpi_late_by_region": _late_by("region"),
    "kpi_late_by_category": _late_by("product_category"),
    "kpi_late_by_seller": _late_by("seller_id"),
    "kpi_late_grouping_sets": _on_lines(
        """SELECT CASE WHEN grouping(product_category) = 0 THEN 'category'
            WHEN grouping(region) = 0 THEN 'region' ELSE 'seller' END AS breakdown,
       product_category, region, seller_id,
       count(DISTINCT order_id) AS n_orders,
       count(DISTINCT order_id) FILTER (WHERE is_late) AS n_late,
       100.0::DOUBLE * count(DISTINCT order_id) FILTER (WHERE is_late)
           / count(DISTINCT order_id) AS pct_late
FROM lines GROUP BY GROUPING SETS ((product_category), (region), (seller_id))"""
    ),
    "kpi_avg_delay_seller": _average_delay("seller_id"),
    "kpi_avg_delay_category": _average_delay("product_category"),
    "kpi_avg_delay_region": _average_delay("region"),
    "kpi_seller_ranking": _ranked("seller_id"),
    "kpi_top_offenders": _ranked("seller_id", 10),
    "kpi_top_categories": _ranked("product_category", 10),
    "kpi_top_regions": _ranked("region", 10),
    "kpi_top_by_avg_delay_seller": _top_by_delay("seller_id", 10),
    "kpi_top_by_avg_delay_category": _top_by_delay("product_category", 10),
    "kpi_late_by_month": _by_calendar("year", "month"),
    "kpi_late_by_weekend": _by_calendar("is_weekend"),
    "kpi_late_by_weekday": _by_calendar("day_of_week", "day_name"),
    "kpi_delay_by_volume": _by_size("product_volume_cm3", 1_000, 27_000),
    "kpi_delay_by_weight": _by_size("weight_g", 930, 965),
    "kpi_late_by_volume_quartile": _by_quartile("product_volume_cm3", "dim_products"),
    "kpi_late_by_weight_quartile": _by_quartile("weight_g", "dim_products"),
    "kpi_late_by_freight_quartile": _by_quartile("freight_value", "fact"),
    "kpi_delay_trend": _TREND,
    "json_field": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "json_records_inline": f"""
        SELECT event_id, number, TRUE AS count_ok, craft, name FROM ({_PEOPLE})""",
    "row_message": f"""
        SELECT event_id,
               name || ' is currently in space flying on the ' || craft || '! Hello! :)' AS message
        FROM ({_PEOPLE})""",
    "people_documents": f"SELECT craft, number, count(*) AS n FROM ({_PEOPLE}) GROUP BY 1, 2",
    "layers_end_to_end": _late_by("seller_id"),
}
