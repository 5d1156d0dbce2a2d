"""Check SQL (DuckDB dialect) for every registered query.

Where it can, a check computes the expected answer by another route than the
Spark query: from the numeric column a price text was formatted from, from the
construction branch a product name was built in, from the table columns a
page's markup was written from.  Regular expressions appear only where the
pattern itself is the operator under test.
"""

from __future__ import annotations

from .tracking import ORACLE as TRACKING

# Shared pieces ---------------------------------------------------------------

DEC = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)"
DEC_NUM = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE)"
COMMA = f"replace({DEC}, '.', ',')"

PRICE_PARSE = f"""
WITH b AS (
  SELECT p_partkey, p_retailprice, {DEC} AS d,
         split_part(CAST(CAST(p_retailprice * 10 AS DECIMAL(12,2)) AS VARCHAR), '.', 1) AS ip,
         split_part(CAST(CAST(p_retailprice * 10 AS DECIMAL(12,2)) AS VARCHAR), '.', 2) AS fp
  FROM part)
SELECT p_partkey,
  CASE p_partkey % 6
    WHEN 0 THEN replace(d, '.', ',') || '€ / UN'
    WHEN 1 THEN (CASE WHEN length(ip) > 3
                      THEN substr(ip, 1, length(ip) - 3) || '.' || substr(ip, length(ip) - 2)
                      ELSE ip END) || ',' || fp || '€/kg'
    WHEN 2 THEN d
    WHEN 3 THEN '1.' || d
    WHEN 4 THEN ''
    ELSE NULL END AS price_text,
  CASE p_partkey % 6
    WHEN 0 THEN {DEC_NUM}
    WHEN 1 THEN CAST(CAST(p_retailprice * 10 AS DECIMAL(12,2)) AS DOUBLE)
    WHEN 2 THEN {DEC_NUM}
    ELSE NULL END AS price
FROM b"""

HARMONISED = f"""
SELECT p_name AS product_name, {DEC_NUM} AS price, 'R1' AS source, 0 AS source_rank
FROM part
UNION ALL
SELECT p_name, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE {DEC_NUM} END, 'R2', 1
FROM part
UNION ALL
SELECT p_name, p_retailprice, 'R3', 2 FROM part"""


def _stats(col: str, src: str, by: str = "") -> str:
    sel_by = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""
SELECT {sel_by}count({col}) AS count, round(avg({col}), 6) AS mean,
  round(stddev_samp({col}), 6) AS std, round(min({col}), 6) AS min,
  round(quantile_cont({col}, 0.25), 6) AS q25, round(quantile_cont({col}, 0.5), 6) AS q50,
  round(quantile_cont({col}, 0.75), 6) AS q75, round(max({col}), 6) AS max
FROM {src}{grp}"""


NAMES = """
(SELECT p_partkey, p_size, p_retailprice, p_partkey % 16 AS k,
  p_name || ' ' || CASE p_partkey % 16
    WHEN 0 THEN p_size || '.75l' WHEN 1 THEN p_size || ',75l'
    WHEN 2 THEN '4x' || p_size || ' g' WHEN 3 THEN '2×' || p_size || ' g'
    WHEN 4 THEN '6x' || p_size || 'cl' WHEN 5 THEN p_size || ' un'
    WHEN 6 THEN p_size || 'nun' WHEN 7 THEN p_size || ' units'
    WHEN 8 THEN p_size || ' dozen' WHEN 9 THEN p_size || ' meia dúzia'
    WHEN 10 THEN p_size || ' L' WHEN 11 THEN p_size || 'm'
    WHEN 12 THEN p_size || ' ml' WHEN 13 THEN '2 massas ' || p_size || 'g'
    WHEN 14 THEN p_size || ' garrafas' ELSE p_size || ' para' END AS product_name
 FROM part) n"""

# Expected pack-size triple per construction branch (worked out from the
# matcher order, not by running the patterns).
EXP_VALUE = """CAST(CASE k WHEN 0 THEN p_size + 0.75 WHEN 1 THEN 75.0 WHEN 2 THEN p_size
  WHEN 3 THEN p_size WHEN 4 THEN p_size WHEN 8 THEN 12 * p_size WHEN 9 THEN 12 * p_size
  WHEN 12 THEN p_size WHEN 14 THEN p_size END AS DOUBLE)"""
EXP_UNIT = """CASE k WHEN 0 THEN 'l' WHEN 1 THEN 'l' WHEN 2 THEN 'g' WHEN 3 THEN 'g'
  WHEN 4 THEN 'cl' WHEN 5 THEN 'un' WHEN 7 THEN 'un' WHEN 8 THEN 'dozen'
  WHEN 9 THEN 'meia dúzia' WHEN 11 THEN 'm' WHEN 12 THEN 'ml' WHEN 13 THEN 'm'
  WHEN 14 THEN 'g' WHEN 15 THEN 'par' END"""
EXP_QTY = """CAST(CASE k WHEN 2 THEN 4 WHEN 4 THEN 6 WHEN 5 THEN p_size WHEN 7 THEN p_size
  WHEN 8 THEN p_size WHEN 9 THEN p_size WHEN 11 THEN p_size WHEN 13 THEN 2
  WHEN 15 THEN p_size END AS BIGINT)"""
STD_VALUE = """CAST(CASE k WHEN 0 THEN (p_size + 0.75) * 1000.0 WHEN 1 THEN 75000.0
  WHEN 2 THEN p_size WHEN 3 THEN p_size WHEN 12 THEN p_size WHEN 14 THEN p_size END AS DOUBLE)"""
STD_UNIT = """CASE WHEN k IN (0, 1, 12) THEN 'ml' WHEN k IN (2, 3, 14) THEN 'g' END"""
STD_QTY = """CAST(CASE WHEN k IN (5, 7, 8, 9, 15) THEN p_size END AS BIGINT)"""

# Expected hits of single matchers per construction branch, likewise worked out
# by reading the names: the number and unit that the branch writes.
W_VALUE = """CAST(CASE k WHEN 0 THEN p_size + 0.75 WHEN 1 THEN 75 WHEN 2 THEN p_size
  WHEN 3 THEN p_size WHEN 12 THEN p_size WHEN 13 THEN p_size WHEN 14 THEN p_size END AS DOUBLE)"""
W_UNIT = """CASE k WHEN 0 THEN 'l' WHEN 1 THEN 'l' WHEN 2 THEN 'g' WHEN 3 THEN 'g' WHEN 12 THEN 'ml'
  WHEN 13 THEN 'g' WHEN 14 THEN 'g' END"""
L_UNIT = "CASE WHEN k IN (9, 11, 13) THEN 'm' END"
L_QTY = "CAST(CASE k WHEN 9 THEN p_size WHEN 11 THEN p_size WHEN 13 THEN 2 END AS BIGINT)"
U_UNIT = """CASE k WHEN 5 THEN 'un' WHEN 7 THEN 'un' WHEN 8 THEN 'dozen' WHEN 9 THEN 'meia dúzia'
  WHEN 15 THEN 'par' END"""
U_QTY = "CAST(CASE WHEN k IN (5, 7, 8, 9, 15) THEN p_size END AS BIGINT)"

VALUE_UNITS = """
(SELECT p_partkey,
  CASE WHEN p_partkey % 11 = 0 THEN 0.0 ELSE CAST(p_size AS DOUBLE) END AS weight_value,
  list_extract(['kg', 'g', 'l', 'ml', 'cl', 'un', 'dozen', 'm', 'meia dúzia'],
               CAST(p_partkey % 9 AS INTEGER) + 1) AS weight_unit,
  CAST(CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 5 END AS BIGINT) AS quantity
 FROM part) v"""

NOJSON = "(p_partkey % 17 = 0 OR p_partkey % 13 = 0)"
TILE_POS = "CAST(row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS BIGINT)"

GROUPS = """
(SELECT 'customer-' || o_custkey AS category, o_custkey,
   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) // 100000 AS n
 FROM orders GROUP BY o_custkey) g"""
PAGES_N = "CAST(ceil(n / 212.0) AS BIGINT)"
LAST_PAGE = f"""CASE o_custkey % 50 WHEN 7 THEN 0 WHEN 8 THEN -3 WHEN 9 THEN 99999999999
  ELSE CASE WHEN {PAGES_N} > 1 THEN {PAGES_N} END END"""

NULL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]

LOG_OK = "event_id % 10 <> 0"


def _log(expr: str) -> str:
    return f"CASE WHEN {LOG_OK} THEN {expr} END"


# All of part listed by category, 50 tiles a page (see driver_inputs._listing).
LISTING = """
(SELECT category, page, count(*) AS n_rows, any_value(pages) AS pages FROM (
   SELECT lower(p_type) AS category,
     (row_number() OVER (PARTITION BY lower(p_type) ORDER BY p_partkey) - 1) // 50 AS page,
     CAST(ceil(count(*) OVER (PARTITION BY lower(p_type)) / 50.0) AS BIGINT) AS pages FROM part)
 GROUP BY category, page) listing"""


# The audit's pages (see driver_inputs.audit_pages): rows that landed on each, and the counters.
_AUDIT = """SELECT CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) ELSE 'tudo' END AS category, p_partkey FROM part"""
AUDIT_PAGES = f"""
(SELECT category, rn // 216 AS page,
   CASE WHEN (rn // 216) % 3 = 1 AND category <> 'promo' THEN 0 ELSE count(*) END AS rows
 FROM (SELECT category, row_number() OVER (PARTITION BY category ORDER BY p_partkey) - 1 AS rn FROM ({_AUDIT}))
 GROUP BY 1, 2)"""
AUDIT_TOTAL = f"""
(SELECT category, count(*) - CASE WHEN category = 'promo' THEN 5 ELSE 0 END AS total FROM ({_AUDIT}) GROUP BY category)"""


def _completeness(gone: str, last_page: str) -> str:
    return f"""
SELECT category, CAST(NULL AS BIGINT) AS expected_total, {last_page} AS last_page, count(*) AS n_pages,
  CAST(sum(n_rows) AS BIGINT) AS fetched_rows, CAST(sum(n_rows) AS BIGINT) AS progress,
  count(*) FILTER (WHERE n_rows < 50) AS short_pages, CAST(NULL AS BIGINT) AS missing_rows,
  CASE WHEN {last_page} IS NOT NULL THEN count(*) = {last_page}
       ELSE max_by(n_rows, page) < 50 END AS complete
FROM {LISTING} WHERE NOT ({gone}) GROUP BY category"""


ORACLE: dict[str, str] = {
    "price_parse": PRICE_PARSE,
    "drop_missing": f"SELECT p_partkey, price FROM ({PRICE_PARSE}) WHERE price IS NOT NULL",
    "min_price_filter": f"SELECT p_partkey, price FROM ({PRICE_PARSE}) WHERE price >= 950.0",
    "harmonise": f"SELECT product_name, price, source FROM ({HARMONISED})",
    "row_counts": """
SELECT source, category, count(*) AS n_rows FROM (
  SELECT 'R1' AS source, lower(p_type) AS category FROM part
  UNION ALL SELECT 'R2', lower(p_type) FROM part
  UNION ALL SELECT 'R3', lower(p_type) FROM part) GROUP BY source, category""",
    "row_index": f"""
SELECT product_name, price, source,
  CAST(row_number() OVER (ORDER BY source_rank, product_name NULLS LAST, price NULLS LAST) - 1
       AS BIGINT) AS row_index
FROM ({HARMONISED})""",
    "lineage_columns": """
SELECT p_partkey, lower(p_type) AS cgid, DATE '2024-11-13' AS tracking_date, 'R1' AS source
FROM part""",
    "price_describe": _stats("l_extendedprice", "lineitem"),
    "price_describe_by_source": _stats("price", f"({HARMONISED})", "source"),
    "parse_quantity": f"""
SELECT p_partkey, product_name, {EXP_VALUE} AS weight_value, {EXP_UNIT} AS weight_unit,
       {EXP_QTY} AS quantity FROM {NAMES}""",
    "qty_weight": f"""
SELECT p_partkey, product_name, {W_VALUE} AS weight_value, {W_UNIT} AS weight_unit,
  CAST(NULL AS BIGINT) AS quantity FROM {NAMES}""",
    "qty_multipack": f"""
SELECT p_partkey, product_name, CAST(CASE WHEN k = 2 THEN p_size END AS DOUBLE) AS weight_value,
  CASE WHEN k = 2 THEN 'g' END AS weight_unit, CAST(CASE WHEN k = 2 THEN 4 END AS BIGINT) AS quantity
FROM {NAMES}""",
    "qty_volume_pack": f"""
SELECT p_partkey, product_name, CAST(CASE WHEN k = 4 THEN p_size END AS DOUBLE) AS weight_value,
  CASE WHEN k = 4 THEN 'cl' END AS weight_unit, CAST(CASE WHEN k = 4 THEN 6 END AS BIGINT) AS quantity
FROM {NAMES}""",
    "qty_length": f"""
SELECT p_partkey, product_name, CAST(NULL AS DOUBLE) AS weight_value, {L_UNIT} AS weight_unit,
  {L_QTY} AS quantity FROM {NAMES}""",
    "qty_units": f"""
SELECT p_partkey, product_name, {U_UNIT} AS unit, {U_QTY} AS unit_quantity,
  CAST(NULL AS BIGINT) AS dose_quantity,
  CAST(CASE WHEN k = 15 THEN p_size END AS BIGINT) AS pair_quantity
FROM {NAMES}""",
    "qty_dozen": f"""
SELECT p_partkey, {U_UNIT} AS unit, {U_QTY} AS quantity,
  CAST(CASE WHEN k IN (8, 9) THEN 12 * p_size END AS DOUBLE) AS items
FROM {NAMES}""",
    "to_base_unit": f"""
SELECT p_partkey, weight_value, weight_unit,
  CASE WHEN weight_unit IN ('kg', 'l') THEN weight_value * 1000.0
       WHEN weight_unit IN ('g', 'ml') THEN weight_value END AS base_value
FROM {VALUE_UNITS}""",
    "to_ml": f"""
SELECT p_partkey, weight_value, weight_unit,
  CASE WHEN weight_unit = 'l' THEN weight_value * 1000.0
       WHEN weight_unit = 'ml' THEN weight_value END AS ml_value
FROM {VALUE_UNITS}""",
    "standardise_quantity": f"""
SELECT p_partkey,
  CASE WHEN weight_unit IN ('kg', 'l') THEN weight_value * 1000.0
       WHEN weight_unit IN ('g', 'ml') THEN weight_value END AS std_value,
  CASE WHEN weight_unit IN ('kg', 'g') THEN 'g' WHEN weight_unit IN ('l', 'ml') THEN 'ml' END
    AS std_unit,
  CASE WHEN weight_unit IN ('unit', 'un', 'par', 'pieces', 'dozen', 'meia dúzia', 'rolos', 'doses')
       THEN quantity END AS std_quantity
FROM {VALUE_UNITS}""",
    "price_per_unit": f"""
SELECT {STD_VALUE} AS Weight_Value, {STD_UNIT} AS Weight_Unit, {STD_QTY} AS Quantity,
  product_name, p_retailprice AS product_price, p_retailprice / {STD_VALUE} AS price_per_unit
FROM {NAMES}""",
    "tile_explode": f"""
SELECT CAST(p_partkey // 50 AS BIGINT) AS page_id, {TILE_POS} AS tile_pos,
  '/p/' || p_partkey AS product_url FROM part""",
    "extract_json_tiles": f"""
SELECT CAST(p_partkey // 50 AS BIGINT) AS page_id, {TILE_POS} AS tile_pos,
  CASE WHEN {NOJSON} THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
  CASE WHEN {NOJSON} THEN NULL WHEN p_partkey % 7 = 0 THEN p_name || '''s'
       WHEN p_partkey % 11 = 0 THEN p_name || ' & co' ELSE p_name END AS product_name,
  CASE WHEN {NOJSON} THEN NULL ELSE p_retailprice END AS price,
  CASE WHEN {NOJSON} THEN NULL ELSE p_brand END AS brand,
  CASE WHEN {NOJSON} THEN NULL ELSE p_type END AS category_name,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'https://img.example/' || p_partkey || '.jpg' END
    AS image_url,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE {COMMA} || '€/kg' END AS unit_price_raw,
  p_size || ' un' AS min_quantity,
  '/p/' || p_partkey AS product_url
FROM part""",
    "node_text": f"""
SELECT CAST(p_partkey // 50 AS BIGINT) AS page_id, {TILE_POS} AS tile_pos,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE {COMMA} || '€/kg' END AS text_tight,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE {COMMA} || '€ / kg' END AS text_ends
FROM part""",
    "extract_attr_tiles": f"""
SELECT CAST(p_partkey // 50 AS BIGINT) AS page_id, {TILE_POS} AS tile_pos,
  CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_retailprice END AS price,
  p_type AS category_l1, p_brand AS category_l2,
  CASE WHEN p_partkey % 2 = 1 THEN p_name END AS category_l3,
  'https://img.example/a/' || p_partkey || '.png' AS image_url,
  CAST(p_partkey AS VARCHAR) AS rating,
  CASE WHEN p_partkey % 4 = 0 THEN '-' || p_size || '%' END AS promotion,
  CAST(p_partkey % 3 AS BIGINT) AS n_labels,
  CASE WHEN p_partkey % 29 = 0 THEN 'missing: price_raw' END AS parse_error
FROM part""",
    "label_explode": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(NULL AS BIGINT) AS label_pos,
  CAST(NULL AS VARCHAR) AS alt, CAST(NULL AS VARCHAR) AS title FROM part WHERE p_partkey % 3 = 0
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), CAST(0 AS BIGINT), p_brand, 'L0' FROM part
WHERE p_partkey % 3 IN (1, 2)
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), CAST(1 AS BIGINT), p_brand, 'L1' FROM part
WHERE p_partkey % 3 = 2""",
    "labels_to_json": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE p_partkey % 3 WHEN 0 THEN '[]'
    WHEN 1 THEN '[{"alt":"' || p_brand || '","title":"L0"}]'
    ELSE '[{"alt":"' || p_brand || '","title":"L0"},{"alt":"' || p_brand || '","title":"L1"}]'
  END AS labels_json
FROM part""",
    "extract_cards": f"""
SELECT CAST(p_partkey // 50 AS BIGINT) AS page_id, {TILE_POS} AS tile_pos,
  replace(p_name, ' ', '-') || '-' || p_partkey AS product_id,
  p_name || ' ' || p_size || ' g' AS product_name, {DEC_NUM} AS price,
  'https://img.example/c/' || p_partkey || '.jpg' AS image_url,
  CASE WHEN p_partkey % 6 = 0 THEN CAST(p_size AS VARCHAR) END AS rating
FROM part""",
    "category_levels": """
SELECT s_suppkey, r_name AS category_l1, n_name AS category_l2,
  CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS category_l3
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "nutrition_record": """
SELECT p_partkey,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size || '%' END AS reference_intake,
  (p_size * 10) || ' g' AS serving_size,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'g' END AS uom,
  CAST(2 AS BIGINT) AS n_nutrients, CAST(2 AS BIGINT) AS n_description
FROM part""",
    "nutrient_rows": f"""
SELECT p_partkey, CAST(0 AS BIGINT) AS pos, 'Energia' AS nutrient,
  CAST(p_size * 4 AS VARCHAR) AS quantity, 'kcal' AS unit FROM part
UNION ALL
SELECT p_partkey, CAST(1 AS BIGINT), 'Lípidos', {DEC}, 'g' FROM part""",
    "description_entries": """
SELECT p_partkey, 'Tipo' AS key,
  CASE WHEN p_partkey % 2 = 0 THEN p_type || ' v2' ELSE p_type END AS value FROM part
UNION ALL
SELECT p_partkey, 'Marca', p_brand FROM part""",
    "expected_count": f"""
SELECT category,
  CASE WHEN o_custkey % 2 = 0 AND n >= 1000
       THEN greatest(least(n, 216), n // 1000, n % 1000)
       ELSE greatest(least(n, 216), n) END AS expected_total
FROM {GROUPS}""",
    "last_page": f"""
SELECT category, {LAST_PAGE} AS last_page_raw, coalesce({LAST_PAGE}, 1) AS last_page FROM {GROUPS}""",
    "expected_pages": f"""
SELECT category, CAST(unnest(generate_series(1, coalesce({LAST_PAGE}, 1))) AS BIGINT) AS page_no,
  CAST(NULL AS VARCHAR) AS page_error
FROM {GROUPS} WHERE o_custkey % 50 NOT IN (7, 8, 9)
UNION ALL SELECT category, NULL, 'pager: last page 99999999999' FROM {GROUPS} WHERE o_custkey % 50 = 9""",
    "page_links": """
SELECT page_id, nullif(regexp_extract(html, '<a href="([^"]*)"', 1), '') AS first_href,
  CAST(len(regexp_extract_all(html, '<a href="')) AS BIGINT) AS n_links
FROM pages""",
    "landed_pages": r"""
SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS source,
  regexp_extract(url, '^https?://[^/?#]+/([^/?#]+)', 1) AS category,
  coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS INTEGER), 1)
    AS page_no,
  CAST(length(html) AS BIGINT) AS n_chars
FROM pages""",
    "url_key": "SELECT page_id, string_split(url, '/')[-2] AS url_key FROM pages",
    "slug": """
SELECT p_partkey, replace(replace(p_name || ': ' || p_type, ' ', '_'), ':', '') AS slug
FROM part""",
    "attr_filter": "SELECT p_partkey, p_brand FROM part WHERE p_brand = 'Brand#12'",
    "category_filter": """
SELECT p_partkey, lower(p_type) AS category FROM part WHERE lower(p_type) IN ('small', 'promo')""",
    "cheapest_first": """
SELECT lower(p_type) AS category, p_partkey, p_retailprice AS price,
  CAST(row_number() OVER (PARTITION BY lower(p_type) ORDER BY p_retailprice, p_partkey) - 1
       AS BIGINT) AS price_rank
FROM part""",
    "page_slice": """
SELECT category, p_partkey, price, CAST(rn // 212 AS BIGINT) AS page_no,
  CAST(rn % 212 AS BIGINT) AS pos_in_page
FROM (SELECT lower(p_type) AS category, p_partkey, p_retailprice AS price,
        row_number() OVER (PARTITION BY lower(p_type) ORDER BY p_retailprice, p_partkey) - 1 AS rn
      FROM part)""",
    "page_offset": """
SELECT lower(p_type) AS category, p_partkey, p_retailprice AS price FROM part
ORDER BY p_retailprice, p_partkey LIMIT 212 OFFSET 212""",
    "conform_schema": """
SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS promo FROM events""",
    "null_profile": "WITH j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, "
                    "l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)\n"
                    + "\nUNION ALL\n".join(
                        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
                        f"CAST(count(*) AS BIGINT) AS n_rows FROM j" for c in NULL_COLS),
    "snapshot_date_parse": """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d_dir, CAST(l_shipdate AS DATE) AS d_col,
  strftime(date_trunc('second', l_shipdate), '%Y-%m-%d %H:%M:%S') AS observed_at
FROM lineitem""",
    "snapshot_roundtrip": """
SELECT CASE p_partkey % 3 WHEN 0 THEN 'r1' WHEN 1 THEN 'r2' ELSE 'r3' END AS source,
  CAST(DATE '2024-11-13' + CAST(p_partkey % 2 AS INTEGER) AS DATE) AS snapshot_date,
  CASE WHEN p_partkey % 3 = 2 THEN lower(p_type) || '/bem-estar/' ELSE lower(p_type) END AS category,
  CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_retailprice AS price
FROM part""",
    "scan_union_csv": f"""
SELECT 'item-' || p_partkey AS product_id, p_name AS product_name,
  {COMMA} || '€ / UN' AS product_price, 'r2' AS source,
  CASE WHEN p_partkey % 2 = 0 THEN '20241113_173405' ELSE '20241114_165838' END AS timestamp,
  CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-11-13' ELSE DATE '2024-11-14' END AS snapshot_date,
  lower(p_type) AS category
FROM part""",
    "log_fields": f"""
SELECT event_id,
  {_log("strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || "
        "lpad(CAST((epoch_us(ts) % 1000000) // 1000 AS VARCHAR), 3, '0')")} AS logged_at,
  {_log("'shelfscan'")} AS logger,
  {_log("CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END")}
    AS level,
  {_log("event_type || '.py'")} AS file,
  {_log("CAST(user_id AS BIGINT)")} AS line,
  {_log("'handle_' || event_type")} AS func,
  {_log("'event ' || event_id || ' - k=' || json_extract_string(props, '$.k')")} AS message
FROM events""",
    "run_report": """
SELECT lower(p_type) AS category, CAST(count(DISTINCT p_partkey // 50) AS BIGINT) AS n_pages,
  CAST(CASE WHEN lower(p_type) = 'promo' THEN 0 ELSE count(*) END AS BIGINT) AS n_rows,
  CAST(CASE WHEN lower(p_type) = 'promo' THEN 0
            ELSE count(*) FILTER (WHERE p_partkey % 29 = 0) END AS BIGINT) AS n_errors,
  CASE WHEN lower(p_type) = 'promo' THEN 'empty'
       WHEN count(*) FILTER (WHERE p_partkey % 29 = 0) > 0 THEN 'error' ELSE 'saved' END AS status
FROM part GROUP BY lower(p_type)""",
    "ingest_snapshot": f"""
SELECT 'r1' AS source, 'catalogue' AS category, DATE '2024-11-13' AS snapshot_date,
  CAST(p_partkey // 50 AS BIGINT) AS page,
  CASE WHEN {NOJSON} THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
  CASE WHEN {NOJSON} THEN NULL WHEN p_partkey % 7 = 0 THEN p_name || chr(39) || 's'
       WHEN p_partkey % 11 = 0 THEN p_name || ' & co' ELSE p_name END AS product_name,
  CASE WHEN {NOJSON} THEN NULL ELSE p_retailprice END AS price,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE {COMMA} || '€/kg' END AS unit_price_raw,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'https://img.example/' || p_partkey || '.jpg' END
    AS image_url,
  '/p/' || p_partkey AS product_url, CAST(NULL AS VARCHAR) AS rating,
  CAST(NULL AS VARCHAR) AS promotion, CAST(NULL AS VARCHAR) AS parse_error,
  CASE WHEN {NOJSON} THEN NULL ELSE p_type END AS category_l1,
  CAST(CASE WHEN {NOJSON} THEN 0 ELSE 1 END AS BIGINT) AS n_categories,
  '2024-11-13 17:34:05' AS observed_at
FROM part
UNION ALL
SELECT 'r2', 'catalogue', DATE '2024-11-13', CAST(p_partkey // 50 AS BIGINT),
  replace(p_name, ' ', '-') || '-' || p_partkey, p_name || ' ' || p_size || ' g', {DEC_NUM},
  CAST(NULL AS VARCHAR), 'https://img.example/c/' || p_partkey || '.jpg',
  'https://shop.example/produtos/' || replace(p_name, ' ', '-') || '-' || p_partkey || '/',
  CASE WHEN p_partkey % 6 = 0 THEN CAST(p_size AS VARCHAR) END,
  CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT),
  '2024-11-13 17:34:05'
FROM part
UNION ALL
SELECT 'r3', 'catalogue', DATE '2024-11-13', CAST(p_partkey // 50 AS BIGINT),
  CAST(p_partkey AS VARCHAR), p_name,
  CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_retailprice END,
  CAST(NULL AS VARCHAR), 'https://img.example/a/' || p_partkey || '.png',
  '{{"productUrl":"/p/' || p_partkey || '"}}', CAST(p_partkey AS VARCHAR),
  CASE WHEN p_partkey % 4 = 0 THEN '-' || p_size || '%' END,
  CASE WHEN p_partkey % 29 = 0 THEN 'missing: price_raw' END,
  p_type, CAST(CASE WHEN p_partkey % 2 = 1 THEN 3 ELSE 2 END AS BIGINT),
  '2024-11-13 17:34:05'
FROM part""",
    "harmonise_snapshot": f"""
SELECT CASE WHEN {NOJSON} THEN NULL WHEN p_partkey % 7 = 0 THEN p_name || chr(39) || 's'
            WHEN p_partkey % 11 = 0 THEN p_name || ' & co' ELSE p_name END AS product_name,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE {DEC_NUM} END AS price, 'R1' AS source
FROM part
UNION ALL
SELECT p_name || ' ' || p_size || ' g', {DEC_NUM}, 'R2' FROM part
UNION ALL
SELECT p_name, CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_retailprice END, 'R3' FROM part""",
    "completeness_audit": f"""
SELECT k.category, CAST(t.total AS BIGINT) AS expected_total, CAST(NULL AS BIGINT) AS last_page,
  CAST(count(*) AS BIGINT) AS n_pages, CAST(sum(rows) AS BIGINT) AS fetched_rows,
  CAST(least(sum(rows), t.total) AS BIGINT) AS progress,
  CAST(count(*) FILTER (WHERE rows < 216) AS BIGINT) AS short_pages,
  CAST(t.total - sum(rows) AS BIGINT) AS missing_rows, sum(rows) = t.total AS complete
FROM {AUDIT_PAGES} k JOIN {AUDIT_TOTAL} t USING (category) GROUP BY k.category, t.total""",
    # the gaps between landed pages, page 0 and the page after the last one
    "missing_pages": f"""
WITH landed AS (
  SELECT 'counter' AS style, category, page + 1 AS p FROM {AUDIT_PAGES} k WHERE rows > 0
  UNION ALL SELECT 'pager', category, page + 1 FROM {LISTING} WHERE NOT (category = 'promo' AND page % 3 = 2)
  UNION ALL SELECT 'short', category, page + 1 FROM {LISTING} WHERE NOT (category = 'promo' AND page = pages - 1)),
ends AS (
  SELECT 'counter' AS style, category, CAST(ceil(total / 216.0) AS BIGINT) AS z FROM {AUDIT_TOTAL} t
  UNION ALL SELECT 'pager', category, CASE WHEN category = 'economy' THEN 99999999999
                          WHEN any_value(pages) > 1 THEN any_value(pages)
                          WHEN max_by(n_rows, page) < 50 THEN max(page) + 1 END
    FROM {LISTING} WHERE NOT (category = 'promo' AND page % 3 = 2) GROUP BY category
  UNION ALL SELECT 'short', category, CASE WHEN max_by(n_rows, page) < 50 THEN max(page) + 1 END
    FROM {LISTING} WHERE NOT (category = 'promo' AND page = pages - 1) GROUP BY category),
points AS (
  SELECT style, category, p FROM landed JOIN ends USING (style, category) WHERE z IS NULL OR p <= z
  UNION ALL SELECT style, category, 0 FROM ends UNION ALL SELECT style, category, z + 1 FROM ends WHERE z IS NOT NULL),
gaps AS (SELECT *, lead(p) OVER (PARTITION BY style, category ORDER BY p) AS q FROM points)
SELECT style, category, CAST(p + 1 AS BIGINT) AS from_page, CAST(q - 1 AS BIGINT) AS to_page
FROM gaps JOIN ends USING (style, category) WHERE q > p + 1 OR (q IS NULL AND z IS NULL)""",
    "min_price_pushed": "SELECT p_partkey, p_retailprice AS price FROM part WHERE p_retailprice >= 950.0",
    "category_pruned": """
SELECT p_partkey, lower(p_type) AS category FROM part WHERE lower(p_type) IN ('small', 'promo')""",
    "scan_union_drift": f"""
SELECT 'item-' || p_partkey AS product_id, p_name AS product_name,
  {COMMA} || '€ / UN' AS product_price, CAST(NULL AS VARCHAR) AS product_rating, 'r2' AS source,
  CASE WHEN p_partkey % 2 = 0 THEN '20241113_173405' ELSE '20241114_165838' END AS timestamp,
  CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-11-13' ELSE DATE '2024-11-14' END AS snapshot_date,
  CASE p_partkey % 3 WHEN 0 THEN 'processed_Água e/ou ' || lower(p_type) || ' 100%+'
       WHEN 1 THEN lower(p_type) ELSE 'padded-' || lower(p_type) END AS category,
  CAST(NULL AS VARCHAR) AS file_error
FROM part WHERE p_partkey % 3 < 2 OR lower(p_type) NOT IN ('promo', 'small')
UNION ALL
SELECT DISTINCT NULL, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-11-13' ELSE DATE '2024-11-14' END, 'foreign-' || lower(p_type),
  'header lacks product_id, product_name: nome;codigo;preco;hora;loja'
FROM part WHERE p_partkey % 3 = 2 AND lower(p_type) IN ('promo', 'small')""",
    "name_column": "SELECT p_name AS product_name FROM part",
    "unit_price_job": f"""
SELECT {STD_VALUE} AS Weight_Value, {STD_UNIT} AS Weight_Unit, {STD_QTY} AS Quantity, product_name,
  {DEC_NUM} AS product_price, {DEC_NUM} / {STD_VALUE} AS price_per_unit
FROM {NAMES}""",
    "pages_roundtrip": """
SELECT 'r1' AS source, 'broken' AS category, DATE '2024-11-13' AS snapshot_date,
  CAST(s_suppkey AS INTEGER) AS page_start, CAST(13 AS BIGINT) AS n_chars FROM supplier
UNION ALL
SELECT 'elsewhere', 'web', DATE '2024-11-13', CAST(page_id AS INTEGER), CAST(length(html) AS BIGINT) FROM pages
UNION ALL
SELECT 'r1', 'catalogue', DATE '2024-11-13', CAST(p_partkey // 50 AS INTEGER), NULL
FROM part GROUP BY p_partkey // 50""",
    "ingest_run_report": """
SELECT 'r1' AS source, 'catalogue' AS category, CAST(count(DISTINCT p_partkey // 50) AS BIGINT) AS n_pages,
  count(*) AS n_rows, CAST(0 AS BIGINT) AS n_errors, 'saved' AS status FROM part
UNION ALL SELECT 'r1', 'broken', count(*), 0, count(*), 'error' FROM supplier
UNION ALL SELECT 'elsewhere', 'web', count(*), 0, count(*), 'error' FROM pages""",
    "completeness_by_pager": _completeness(
        "category = 'promo' AND page % 3 = 2",
        "CASE WHEN category = 'economy' THEN 99999999999 WHEN any_value(pages) > 1 THEN any_value(pages) END"),
    "completeness_by_short_page": _completeness("category = 'promo' AND page = pages - 1",
                                                "CAST(NULL AS BIGINT)"),
    "pipeline_metrics": """
SELECT (SELECT count(*) FROM (SELECT DISTINCT p_partkey % 2, lower(p_type) FROM part)) AS n_files,
  (SELECT count(*) FROM part) AS n_rows, (SELECT count(*) FROM part) AS n_null,
  (SELECT (max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000)) / 1000.0 FROM events WHERE event_id % 10 <> 0) AS elapsed_s""",
    **TRACKING,
}
