"""DuckDB SQL stating the expected result of every registered query.

The feed rule of ``sources.feeds`` is restated here as CTEs over the same
parquet tables; each query then states its own expected output. Column names
and types match the Spark side (sums cast to BIGINT, ranks to INTEGER).
"""

from __future__ import annotations

_RANGE = (
    "CAST(p_size % 6 + 6 AS VARCHAR) || ':' || CAST((p_partkey % 4) * 15 AS VARCHAR) || '-' || "
    "CAST((p_size % 6 + 6 + 8 + p_size % 12) % 24 AS VARCHAR) || ':' || CAST((p_size % 2) * 30 AS VARCHAR)"
)

ENTITY = f"""
geo AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
),
ent AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, n_name, r_name, 0 AS copy
  FROM part JOIN geo ON p_partkey % 25 = n_nationkey
  UNION ALL
  SELECT p_partkey, p_name, p_brand, p_type, p_size, n_name, r_name, 1 AS copy
  FROM part JOIN geo ON p_partkey % 25 = n_nationkey
  WHERE p_size % 10 = 0
),
ent2 AS (
  SELECT *, CAST(p_partkey AS VARCHAR) AS business_id, {_RANGE} AS rng FROM ent
),
landing AS (
  SELECT
    business_id,
    CASE WHEN copy = 1 THEN upper(p_name) ELSE p_name END AS name,
    p_brand || ' Ave' AS address,
    n_name AS city,
    r_name AS state,
    lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
    CAST(p_partkey % 180 AS DOUBLE) - 89.5 AS latitude,
    CAST(p_partkey % 360 AS DOUBLE) - 179.75 AS longitude,
    CAST(1 + (p_size % 9) * 0.5 AS DOUBLE) AS stars,
    CAST(p_partkey % 500 AS INTEGER) AS review_count,
    CAST(p_partkey % 2 AS INTEGER) AS is_open,
    CASE WHEN p_size % 13 = 0 THEN NULL ELSE
      '{{' || concat_ws(',',
        CASE WHEN p_size % 3 = 0 THEN NULL
             WHEN p_size % 2 = 0 THEN '"BusinessAcceptsCreditCards":"True"'
             ELSE '"BusinessAcceptsCreditCards":"False"' END,
        CASE p_partkey % 4 WHEN 0 THEN '"Brand"' WHEN 1 THEN '"''Brand''"'
             WHEN 2 THEN '"u''Brand''"' ELSE '"\\"Brand\\""' END || ':"' || p_brand || '"',
        '"RestaurantsPriceRange2":"' || CAST(p_size % 4 + 1 AS VARCHAR) || '"'
      ) || '}}' END AS attributes,
    CASE WHEN p_size % 11 = 0 THEN NULL
         WHEN p_size % 6 = 0 THEN replace(p_name, ' ', ', ') || ', ' || p_type || ', , ' || split_part(p_name, ' ', 1)
         ELSE replace(p_name, ' ', ', ') || ', ' || p_type END AS categories,
    CASE WHEN p_size % 7 = 0 THEN NULL ELSE
      '{{' || concat_ws(',',
        '"Monday":"' || rng || '"', '"Tuesday":"' || rng || '"', '"Wednesday":"' || rng || '"',
        '"Thursday":"' || rng || '"', '"Friday":"' || rng || '"',
        '"Saturday":"' || CASE WHEN p_size % 2 = 0 THEN '0:0-0:0' ELSE rng END || '"',
        CASE WHEN p_size % 5 = 0 THEN '"Sunday":"closed"' END
      ) || '}}' END AS hours,
    p_size, p_partkey, p_brand
  FROM ent2
),
core AS (
  SELECT business_id, name, address, city, state, postal_code, latitude, longitude, stars, review_count, is_open
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY business_id
      ORDER BY name ASC NULLS FIRST, address ASC NULLS FIRST, city ASC NULLS FIRST, state ASC NULLS FIRST,
               postal_code ASC NULLS FIRST, latitude ASC NULLS FIRST, longitude ASC NULLS FIRST,
               stars ASC NULLS FIRST, review_count ASC NULLS FIRST, is_open ASC NULLS FIRST) AS rk
    FROM landing
  ) d WHERE rk = 1
),
category AS (
  SELECT business_id, trim(c) AS category
  FROM (SELECT business_id, unnest(string_split_regex(categories, ',\\s*')) AS c
        FROM landing WHERE categories IS NOT NULL) s
  WHERE length(trim(c)) > 0
),
attrs AS (
  SELECT business_id,
         regexp_replace(e.key, '^u?[''"]|[''"]$', '', 'g') AS attribute_key,
         e.value AS attribute_value,
         e.key AS raw_key
  FROM (SELECT business_id,
               unnest(map_entries(CAST(CAST(attributes AS JSON) AS MAP(VARCHAR, VARCHAR)))) AS e
        FROM landing WHERE attributes IS NOT NULL) s
)"""

#: every seventh business changes, half of these into another city and category
CHANGED_ENTITY = ENTITY.replace("landing AS (", "first_landing AS (", 1).replace(
    "core AS (", """landing AS (
  SELECT * REPLACE (
    CASE WHEN changed THEN 6 - stars ELSE stars END AS stars, CASE WHEN moved THEN 'NEWTOWN' ELSE city END AS city,
    CASE WHEN moved THEN coalesce(categories, 'plain') || ', moved' ELSE categories END AS categories)
  FROM (SELECT *, p_partkey % 7 = 0 AS changed, p_partkey % 14 = 0 AS moved FROM first_landing)
),
core AS (""", 1)

REVIEW = """
rv AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, l_shipdate,
         o_custkey, o_orderpriority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
review_landing AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
              CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS review_id,
    CAST(o_custkey AS VARCHAR) AS user_id,
    CASE WHEN l_partkey % 53 = 0 THEN 'x' ELSE '' END || CAST(l_partkey AS VARCHAR) AS business_id,
    CAST(1 + l_quantity % 5 AS INTEGER) AS stars,
    CASE WHEN l_suppkey % 89 <> 0 THEN CAST(l_linenumber - 1 AS INTEGER) END AS useful,
    CAST(l_suppkey % 3 AS INTEGER) AS funny,
    CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey % 4 AS INTEGER) END AS cool,
    concat_ws(' ', 'order', o_orderpriority, 'flag', l_returnflag, l_linestatus) AS text,
    CASE WHEN l_suppkey % 97 = 0 THEN NULL
         WHEN l_linenumber = 3 THEN CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 270 MINUTE
         ELSE CAST(date_trunc('second', l_shipdate) AS TIMESTAMP) END AS review_date
  FROM rv
),
fact AS (
  SELECT review_id, user_id, business_id, stars, useful, funny, cool, review_date,
         strftime(review_date, '%Y-%m') AS ym
  FROM review_landing
)"""

FACT_COLS = "review_id, user_id, business_id, stars, useful, funny, cool, review_date, ym"
LANDING_COLS = (
    "business_id, name, address, city, state, postal_code, latitude, longitude, stars, review_count, is_open, "
    "attributes, categories, hours"
)

MART_CITY_CATEGORY = """
SELECT city, category, CAST(count(DISTINCT business_id) AS BIGINT) AS business_count, avg(stars) AS avg_rating
FROM core JOIN category USING (business_id)
GROUP BY city, category"""

MART_BEST_CITY = """
SELECT city, CAST(count(DISTINCT business_id) AS BIGINT) AS business_cnt,
       CAST(sum(review_count) AS BIGINT) AS total_reviews, avg(stars) AS avg_business_rating
FROM core GROUP BY city"""

MART_QUALITY = """
SELECT business_id, ym, avg_rating, review_cnt,
       avg_rating - lag(avg_rating) OVER (PARTITION BY business_id ORDER BY ym ASC NULLS FIRST) AS rating_delta
FROM (SELECT business_id, ym, avg(CAST(stars AS DOUBLE)) AS avg_rating, CAST(count(*) AS BIGINT) AS review_cnt
      FROM fact GROUP BY business_id, ym) m"""

MART_ENRICHED_COLS = """
  f.review_id, f.ym, f.review_date, f.business_id, c.name AS business_name, c.city, c.state,
  c.latitude, c.longitude, c.is_open, c.stars AS business_stars, c.review_count AS business_review_count,
  f.user_id, f.stars AS review_stars, f.useful, f.funny, f.cool"""

RANKED = """
ranked AS (
  SELECT business_id, name, category, city, stars, review_count,
         CAST(row_number() OVER (PARTITION BY category
              ORDER BY stars DESC NULLS LAST, review_count DESC NULLS LAST, business_id ASC NULLS FIRST) AS INTEGER) AS rn
  FROM (SELECT DISTINCT c.business_id, c.name, k.category, c.city, c.stars, c.review_count
        FROM core c JOIN category k ON c.business_id = k.business_id) d
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE: dict[str, str] = {
    "json_scan_conform": _with(ENTITY) + f"\nSELECT {LANDING_COLS} FROM landing",
    "conform_entity": _with(ENTITY) + f"\nSELECT {LANDING_COLS} FROM landing",
    "review_landing": _with(REVIEW) + "\nSELECT review_id, user_id, business_id, stars, useful, funny, cool, text, "
    "review_date FROM review_landing",
    "business_core": _with(ENTITY) + "\nSELECT * FROM core",
    "business_category": _with(ENTITY) + "\nSELECT business_id, category FROM category",
    "business_attributes": _with(ENTITY) + "\nSELECT business_id, attribute_key, attribute_value FROM attrs",
    "clean_attribute_key": _with(ENTITY)
    + "\nSELECT raw_key, attribute_key, CAST(count(*) AS BIGINT) AS n FROM attrs GROUP BY raw_key, attribute_key",
    "event_props_kv": """
SELECT event_id, k AS prop_key, json_extract_string(props, '$.' || k) AS prop_value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) e""",
    "business_hours": _with(ENTITY)
    + r""",
days AS (
  SELECT business_id, day, json_extract_string(hours, '$.' || day) AS rng
  FROM (SELECT business_id, hours, unnest(json_keys(hours)) AS day FROM landing WHERE hours IS NOT NULL) h
),
parts AS (
  SELECT business_id, day AS day_of_week,
    try_cast(regexp_extract(split_part(rng, '-', 1), '^(\d{1,2})', 1) AS INTEGER) AS open_hour,
    try_cast(regexp_extract(split_part(rng, '-', 1), '^\d{1,2}:(\d{1,2})', 1) AS INTEGER) AS open_minute,
    try_cast(regexp_extract(split_part(rng, '-', 2), '^(\d{1,2})', 1) AS INTEGER) AS close_hour,
    try_cast(regexp_extract(split_part(rng, '-', 2), '^\d{1,2}:(\d{1,2})', 1) AS INTEGER) AS close_minute
  FROM days WHERE rng IS NOT NULL
)
SELECT business_id, day_of_week, open_hour, open_minute, close_hour, close_minute,
       open_hour * 60 + open_minute AS open_minutes, close_hour * 60 + close_minute AS close_minutes
FROM parts""",
    "review_fact": _with(REVIEW) + f"\nSELECT {FACT_COLS} FROM fact",
    "fact_month_slice": _with(REVIEW) + f"\nSELECT {FACT_COLS} FROM fact WHERE ym BETWEEN '1997-01' AND '1997-12'",
    "dynamic_partition_overwrite": _with(REVIEW)
    + f"""
SELECT {FACT_COLS} FROM fact WHERE ym IS NULL OR NOT (ym BETWEEN '1998-01' AND '1998-12')
UNION ALL
SELECT review_id, user_id, business_id, stars, useful + 1000 AS useful, funny, cool, review_date, ym
FROM fact WHERE ym BETWEEN '1998-01' AND '1998-12' AND stars >= 3""",
    "mart_city_category_rating": _with(ENTITY) + MART_CITY_CATEGORY,
    "mart_best_city_avg_rate": _with(ENTITY) + MART_BEST_CITY,
    "mart_business_quality_monthly": _with(REVIEW) + MART_QUALITY,
    "mart_review_fact_enriched": _with(ENTITY, REVIEW)
    + f"\nSELECT {MART_ENRICHED_COLS}\nFROM fact f LEFT JOIN core c ON f.business_id = c.business_id",
    "mart_top_businesses_per_category": _with(ENTITY, RANKED) + "\nSELECT * FROM ranked",
    "top_k_per_category": _with(ENTITY, RANKED) + "\nSELECT * FROM ranked WHERE rn <= 3",
    "mart_category_creditcard_share": _with(ENTITY)
    + """,
flags AS (
  SELECT business_id, max(CASE WHEN lower(trim(attribute_value)) = 'true' THEN 1 ELSE 0 END) AS accepts
  FROM attrs
  WHERE attribute_key = 'BusinessAcceptsCreditCards' AND lower(trim(attribute_value)) IN ('true', 'false')
  GROUP BY business_id
),
per_business AS (
  SELECT k.category, k.business_id, max(f.accepts) AS accepts
  FROM category k JOIN flags f ON k.business_id = f.business_id
  GROUP BY k.category, k.business_id
)
SELECT category, CAST(count(*) AS BIGINT) AS businesses_with_info,
       CAST(sum(accepts) AS BIGINT) AS accepting_credit_cards,
       CAST(100 AS DOUBLE) * CAST(sum(accepts) AS BIGINT) / CAST(count(*) AS BIGINT) AS acceptance_level_pct
FROM per_business GROUP BY category""",
    "sanitize_nan_inf": """
SELECT event_id, event_type, value,
       CASE WHEN event_type IN ('error', 'click', 'signup') THEN CAST(NULL AS DOUBLE) ELSE value END AS score
FROM events""",
    "publish_rows_ndjson": _with(ENTITY) + MART_CITY_CATEGORY,
    "publish_partitioned_ndjson": _with(REVIEW) + MART_QUALITY,
    "publish_enriched_ndjson": _with(ENTITY, REVIEW)
    + """
SELECT """ + MART_ENRICHED_COLS + """
FROM fact f LEFT JOIN core c ON f.business_id = c.business_id""",
    "publish_fill_defaults": _with(ENTITY, REVIEW)
    + """
SELECT f.review_id, coalesce(f.ym, '') AS ym, coalesce(f.review_date, TIMESTAMP '1970-01-01 00:00:00') AS review_date,
  f.business_id, coalesce(c.name, '') AS business_name, coalesce(c.city, '') AS city, coalesce(c.state, '') AS state,
  coalesce(c.latitude, 0) AS latitude, coalesce(c.longitude, 0) AS longitude, coalesce(c.is_open, 0) AS is_open,
  coalesce(c.stars, 0) AS business_stars, coalesce(c.review_count, 0) AS business_review_count, f.user_id,
  f.stars AS review_stars, coalesce(f.useful, 0) AS useful, f.funny, coalesce(f.cool, 0) AS cool
FROM fact f LEFT JOIN core c ON f.business_id = c.business_id""",
    "publish_append": _with(ENTITY)
    + """,
mart AS (""" + MART_BEST_CITY + """)
SELECT 'mart_best_city_avg_rate' AS table_name, CAST(count(*) AS BIGINT) AS rows_written,
       CAST(count(*) AS BIGINT) AS rows_read_back, CAST(2 * count(*) AS BIGINT) AS rows_published FROM mart""",
    "json_scan_quarantine": """
SELECT '{"business_id":"' || CAST(p_partkey AS VARCHAR) || '","name":"' || p_name AS raw_line FROM part WHERE p_size % 9 = 0""",
    "conform_missing_columns": _with(ENTITY)
    + """
SELECT business_id, name, CAST(NULL AS VARCHAR) AS address, city, state, CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS DOUBLE) AS latitude,
  longitude, stars, CAST(NULL AS INTEGER) AS review_count, is_open, attributes, categories, CAST(NULL AS VARCHAR) AS hours
FROM landing""",
    "catalog_table_overwrite": _with(REVIEW) + f"\nSELECT {FACT_COLS} FROM fact WHERE stars >= 3 OR stars IS NULL",
    "external_landing_table": _with(REVIEW) + "\nSELECT review_id, user_id, business_id, stars, useful, funny, cool, text, "
    "review_date FROM review_landing",
    "create_drop_layers": _with(REVIEW)
    + """
SELECT ym, CAST(count(*) AS BIGINT) AS n, false AS left_after_drop FROM fact GROUP BY ym""",
    "mart_month_refresh": _with(REVIEW.replace("FROM review_landing\n)", "FROM revised_landing\n)").replace(
        "fact AS (", """revised_landing AS (
  SELECT * REPLACE (CASE WHEN strftime(review_date, '%Y-%m') BETWEEN '1997-06' AND '1997-08' THEN CAST(6 - stars AS INTEGER) ELSE stars END AS stars)
  FROM review_landing
),
fact AS (""")) + MART_QUALITY,
    "publish_audit": _with(ENTITY)
    + """,
mart AS (""" + MART_BEST_CITY + """)
SELECT 'mart_best_city_avg_rate' AS table_name, CAST(count(*) AS BIGINT) AS rows_written,
       CAST(count(*) AS BIGINT) AS rows_read_back FROM mart""",
    "incremental_fact_merge": _with(REVIEW)
    + f""",
inc AS (
  SELECT l.review_id, user_id, business_id, stars, useful, 2 AS funny, cool,
         CASE WHEN moved THEN review_date + INTERVAL 40 DAY ELSE review_date END AS review_date
  FROM (SELECT *, l_linenumber = 2 AS moved FROM review_landing r JOIN
          (SELECT l_linenumber, concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                  CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS rid, l_shipdate FROM rv) k ON r.review_id = k.rid
        WHERE l_shipdate >= TIMESTAMP '1999-07-01 00:00:00') l
)
SELECT {FACT_COLS} FROM fact WHERE review_id NOT IN (SELECT review_id FROM inc)
UNION ALL
SELECT review_id, user_id, business_id, stars, useful, funny, cool, review_date, strftime(review_date, '%Y-%m') AS ym FROM inc""",
    "publish_audit_by_partition": _with(REVIEW)
    + """
SELECT ym AS partition_value, CAST(count(*) AS BIGINT) AS rows_expected, CAST(count(*) AS BIGINT) AS rows_published
FROM fact GROUP BY ym""",
    "publish_ranges": _with(REVIEW)
    + """
SELECT ym, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS overlapping_files,
       min(business_id) AS first_business, max(business_id) AS last_business
FROM fact GROUP BY ym""",
    "mart_city_refresh": _with(CHANGED_ENTITY) + MART_CITY_CATEGORY,
    "mart_best_city_refresh": _with(CHANGED_ENTITY) + MART_BEST_CITY,
    "mart_enriched_null_keys": _with(ENTITY, REVIEW)
    + """,
keyed AS (
  SELECT * REPLACE (CASE WHEN CAST(split_part(review_id, '-', 2) AS INTEGER) % 2 <> 0 THEN business_id END AS business_id) FROM fact
)
SELECT """ + MART_ENRICHED_COLS + """
FROM keyed f LEFT JOIN core c ON f.business_id = c.business_id""",
    "landing_rebalance": _with(REVIEW) + "\nSELECT review_id, user_id, business_id, stars, useful, funny, cool, text, "
    "review_date FROM review_landing",
    "catalog_save_table": _with(ENTITY) + "\nSELECT * FROM core",
    "publish_dry_run": _with(ENTITY)
    + """
SELECT 'mart_best_city_avg_rate' AS table_name, CAST(count(DISTINCT coalesce(city, '?')) AS BIGINT) AS rows_counted, false AS written
FROM core
UNION ALL
SELECT 'mart_city_category_rating', CAST(count(*) AS BIGINT), false
FROM (SELECT DISTINCT city, category FROM core JOIN category USING (business_id))""",
}
