"""The same results as plain SQL over the given tables, query by query."""

from __future__ import annotations

from checks.bindings import OWNERS_SQL, PARCELS_SQL, SNAPSHOT
from checks.registry import PLACES

RAW = f"WITH {OWNERS_SQL.strip()}, {PARCELS_SQL.strip()}"
RESIDENTIAL = "('APARTMENT', 'MIXED USE', 'RESIDENT LAND', 'RESIDENTIAL', 'RESIDENTIAL CONDO')"
COMMERCIAL = "('BED & BREAK', 'COMMERCIAL', 'MIXED USE')"
DAY = f"DATE '{SNAPSHOT[:4]}-{SNAPSHOT[4:6]}-{SNAPSHOT[6:]}'"


def _dbl(expression: str, digits: int = PLACES["other"]) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits})"


def _m2(expression: str) -> str:
    return _dbl(expression, PLACES["m2"])


AREAS = "area AS (SELECT file_index, parcel_id, sum(area_m2) AS m2 FROM parcels GROUP BY ALL)"
OWNERSHIP = """held AS (
  SELECT DISTINCT file_index, owner_name, parcel_id, is_real_property, pct_own, account_type FROM owners
)"""
PER_OWNER = f"""{RAW}, {AREAS}, {OWNERSHIP},
per_owner AS (
  SELECT file_index, owner_name,
    count(DISTINCT parcel_id) FILTER (is_real_property) AS real_parcels,
    count(DISTINCT parcel_id) FILTER (NOT is_real_property) AS building_parcels,
    count(DISTINCT parcel_id) FILTER (is_real_property AND account_type IN {RESIDENTIAL})
      AS residential_parcels,
    CAST(sum(m2 * pct_own) FILTER (is_real_property) AS DOUBLE) AS real_m2,
    CAST(coalesce(sum(m2 * pct_own)
      FILTER (is_real_property AND account_type IN {RESIDENTIAL}), 0) AS DOUBLE) AS residential_m2,
    avg(pct_own) FILTER (is_real_property) AS real_mean_stake,
    coalesce(avg(pct_own) FILTER (NOT is_real_property), 0) AS building_mean_stake
  FROM held INNER JOIN area USING (file_index, parcel_id)
  GROUP BY file_index, owner_name
)"""
OWNER_DAYS = f"""{PER_OWNER},
owner_days AS (
  SELECT CAST(strptime(file_index, '%Y%m%d') AS DATE) AS report_date, owner_name,
    real_parcels, building_parcels, residential_parcels, real_m2, residential_m2,
    real_mean_stake, building_mean_stake,
    real_parcels - coalesce(lag(real_parcels) OVER seq, 0) AS gain,
    1 - coalesce(lag(real_m2) OVER seq, 0) / nullif(real_m2, 0) AS change
  FROM per_owner
  WINDOW seq AS (PARTITION BY owner_name ORDER BY file_index)
)"""
TYPE_DAYS = f"""{RAW}, {AREAS},
kinds AS (
  SELECT file_index, parcel_id, account_type, count(DISTINCT owner_name) AS n
  FROM owners WHERE is_real_property GROUP BY ALL
),
per_type AS (
  SELECT file_index, account_type, count(DISTINCT parcel_id) AS n_parcels, sum(n) AS n_owners,
         CAST(sum(m2) AS DOUBLE) AS m2
  FROM kinds INNER JOIN area USING (file_index, parcel_id) GROUP BY ALL
),
type_days AS (
  SELECT CAST(strptime(file_index, '%Y%m%d') AS DATE) AS report_date, account_type,
    n_parcels, n_owners, m2,
    m2 / nullif(sum(m2) OVER (PARTITION BY file_index), 0) AS share,
    n_parcels - coalesce(lag(n_parcels) OVER seq, 0) AS gain,
    1 - coalesce(lag(m2) OVER seq, 0) / nullif(m2, 0) AS change
  FROM per_type
  WINDOW seq AS (PARTITION BY account_type ORDER BY file_index)
)"""
DRAWN = """drawn AS (
  SELECT DISTINCT strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS file_index,
    CAST(o_custkey AS VARCHAR) AS parcel_id FROM orders
)"""

PROPERTY_COUNT = f"""{RAW}
SELECT owner_name, count(DISTINCT parcel_id) AS total_properties
FROM owners
WHERE is_real_property AND file_index = '{SNAPSHOT}'
  AND parcel_id IN (SELECT parcel_id FROM parcels)
GROUP BY owner_name"""

# squares as in the shape binding; areas from the authalic-sphere formula
_E2 = "0.0066943799901413165e0"
_E = "0.08181919084262149e0"
_QP = "1.9955310875028376e0"
_R2 = "40589732499314.77e0"


def _authalic_tangent(latitude: str) -> str:
    s = f"sin(radians({latitude}))"
    q = (f"(1e0 - {_E2}) * ({s} / (1e0 - {_E2} * {s} * {s}) "
         f"- ln((1e0 - {_E} * {s}) / (1e0 + {_E} * {s})) / (2e0 * {_E}))")
    return f"tan(asin({q} / {_QP}) / 2e0)"


def _square(x: str, y: str, side: str) -> str:
    """Area of the square on (x, y): its south and north edges are the only ones with a width."""
    width = f"tan(radians(({x} + {side}) - {x}) / 2e0)"
    south, north = _authalic_tangent(y), _authalic_tangent(f"{y} + {side}")
    edges = [f"2e0 * atan2({width} * 2e0 * {t}, 1e0 + {t} * {t})" for t in (south, north)]
    return f"{_R2} * abs({edges[0]} - {edges[1]})"


SHAPES = """shapes AS (
  SELECT p_partkey, p_size,
    p_type, -105.5e0 + CAST(p_partkey % 100 AS DOUBLE) * 0.01e0 AS x,
    39.9e0 + CAST((p_partkey // 100) % 10000 AS DOUBLE) * 0.002e0 AS y,
    CAST(p_size AS DOUBLE) * 0.0001e0 AS side
  FROM part
)"""

SHAPE_AREA = f"""{_square('x', 'y', 'side')}
    - CASE WHEN p_size % 2 = 0 THEN {_square('(x + side / 4e0)', '(y + side / 4e0)', 'side / 2e0')}
      ELSE 0e0 END
    + CASE WHEN p_size % 5 = 0 THEN {_square('x', '(y + 0.2e0)', 'side / 2e0')} ELSE 0e0 END"""


def _residential_by_owner(owner_filter: str = "") -> str:
    return f"""{RAW}, {AREAS},
stakes AS (
  SELECT DISTINCT owner_name, parcel_id, coalesce(pct_own, 1) AS stake FROM owners
  WHERE is_real_property AND account_type IN {RESIDENTIAL} {owner_filter}
)
SELECT owner_name, {_dbl('CAST(sum(m2 * stake) AS DOUBLE) * 0.00024711e0')} AS total_owned_residential
FROM stakes INNER JOIN area ON area.parcel_id = stakes.parcel_id AND area.file_index = '{SNAPSHOT}'
GROUP BY owner_name"""


ORACLE: dict[str, str] = {
    "owner_daily_summary": f"""{OWNER_DAYS}
SELECT report_date, owner_name,
  CAST(real_parcels AS INTEGER) AS total_real_property_owned,
  CAST(building_parcels AS INTEGER) AS total_building_property_owned,
  {_m2('real_m2')} AS total_real_property_land_area_owned_m2,
  {_dbl('real_m2 * 0.00024711e0')} AS total_real_property_land_area_owned_acres,
  CAST(residential_parcels AS INTEGER) AS total_residential_parcels_owned,
  {_m2('residential_m2')} AS total_residential_land_area_owned_m2,
  {_dbl('residential_m2 * 0.00024711e0')} AS total_residential_land_area_owned_acres,
  {_dbl('real_mean_stake')} AS avg_real_property_investment_stake,
  {_dbl('building_mean_stake')} AS avg_building_property_investment_stake,
  CAST(gain AS INTEGER) AS real_property_gain_loss,
  {_dbl('change')} AS pct_land_area_gain_loss
FROM owner_days""",
    "land_type_daily_summary": f"""{TYPE_DAYS}
SELECT report_date, account_type,
  coalesce(account_type IN {RESIDENTIAL}, false) AS is_residential,
  coalesce(account_type IN {COMMERCIAL}, false) AS is_commercial,
  CAST(n_parcels AS INTEGER) AS total_parcels, CAST(n_owners AS INTEGER) AS total_owners,
  {_m2('m2')} AS land_area_m2, {_dbl('m2 * 0.00024711e0')} AS land_area_acres,
  {_dbl('share')} AS pct_total_land_area, CAST(gain AS INTEGER) AS total_parcel_gain_loss,
  {_dbl('change')} AS pct_land_area_gain_loss
FROM type_days""",
    "parcel_area": f"{RAW}, {AREAS} SELECT parcel_id, file_index, {_m2('m2')} AS area_m2 FROM area",
    "ownership_distinct": f"""{RAW}, {OWNERSHIP}
SELECT owner_name, parcel_id, is_real_property, {_dbl('pct_own')} AS pct_own, account_type, file_index
FROM held""",
    "parcel_account_type": f"""{RAW}
SELECT file_index, parcel_id, account_type, count(DISTINCT owner_name) AS owners
FROM owners WHERE is_real_property GROUP BY ALL""",
    "owner_conditional_counts": f"""{PER_OWNER}
SELECT file_index, owner_name, real_parcels, building_parcels, residential_parcels FROM per_owner""",
    "owner_weighted_area": f"""{PER_OWNER}
SELECT file_index, owner_name, {_m2('real_m2')} AS real_m2,
  {_dbl('real_m2 * 0.00024711e0')} AS real_acres, {_m2('residential_m2')} AS residential_m2,
  {_dbl('residential_m2 * 0.00024711e0')} AS residential_acres
FROM per_owner""",
    "owner_avg_stake": f"""{PER_OWNER}
SELECT file_index, owner_name, {_dbl('real_mean_stake')} AS real_mean_stake,
  {_dbl('building_mean_stake')} AS building_mean_stake
FROM per_owner""",
    "owner_lag_delta": f"""{OWNER_DAYS}
SELECT report_date, owner_name, CAST(real_parcels AS INTEGER) AS total_real_property_owned,
  CAST(gain AS INTEGER) AS real_property_gain_loss
FROM owner_days""",
    "owner_area_change": f"""{OWNER_DAYS}
SELECT report_date, owner_name, {_m2('real_m2')} AS total_real_property_land_area_owned_m2,
  {_dbl('change')} AS pct_land_area_gain_loss
FROM owner_days""",
    "type_share_of_day": f"""{TYPE_DAYS}
SELECT report_date, account_type, {_m2('m2')} AS land_area_m2, {_dbl('share')} AS pct_total_land_area
FROM type_days""",
    "type_lag_delta": f"""{TYPE_DAYS}
SELECT report_date, account_type, CAST(n_parcels AS INTEGER) AS total_parcels,
  CAST(gain AS INTEGER) AS total_parcel_gain_loss
FROM type_days""",
    "type_area_change": f"""{TYPE_DAYS}
SELECT report_date, account_type, {_m2('m2')} AS land_area_m2,
  {_dbl('change')} AS pct_land_area_gain_loss
FROM type_days""",
    "residential_acres_raw": f"""{RAW}, {AREAS},
kinds AS (
  SELECT DISTINCT parcel_id, account_type FROM owners
  WHERE is_real_property AND file_index = '{SNAPSHOT}' AND account_type IN {RESIDENTIAL}
)
SELECT {_dbl('CAST(sum(m2) AS DOUBLE) * 0.00024711e0')} AS total_residential_land_acres
FROM kinds INNER JOIN area ON area.parcel_id = kinds.parcel_id AND area.file_index = '{SNAPSHOT}'""",
    "residential_acres_mart": f"""{TYPE_DAYS}
SELECT {_dbl('sum(m2 * 0.00024711e0)')} AS total_land_area
FROM type_days WHERE report_date = {DAY} AND account_type IN {RESIDENTIAL}""",
    "owners_by_residential_raw": _residential_by_owner(),
    "owners_by_residential_one_snapshot": _residential_by_owner(f"AND file_index = '{SNAPSHOT}'"),
    "owners_by_residential_mart": f"""{OWNER_DAYS}
SELECT owner_name, {_dbl('residential_m2 * 0.00024711e0')} AS total_residential_land_area_owned_acres
FROM owner_days WHERE report_date = {DAY}""",
    "owners_by_property_count_raw": PROPERTY_COUNT,
    "owners_by_property_count_mart": f"""{OWNER_DAYS}
SELECT owner_name, CAST(real_parcels AS INTEGER) AS total_real_property_owned
FROM owner_days WHERE report_date = {DAY}""",
    "top_owner": f"{PROPERTY_COUNT} ORDER BY total_properties DESC, owner_name LIMIT 1",
    "address_assembly": """
SELECT p_partkey,
  CAST(p_size AS VARCHAR) || ' ' || CASE WHEN p_type = 'PROMO' THEN p_brand || ' ' ELSE '' END
    || p_name || ' ' || CASE WHEN p_type <> 'SMALL' THEN p_type ELSE '' END AS address
FROM part""",
    "account_prefix_flag": """
SELECT l_returnflag || CAST(l_orderkey AS VARCHAR) AS account_id,
  l_returnflag = 'R' AS is_real_property
FROM lineitem""",
    "stake_cast": """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(l_linenumber || '.' || l_partkey AS DECIMAL(10,3)) AS DOUBLE) AS pct_own
FROM lineitem""",
    "type_flags": """
SELECT p_partkey,
  CASE WHEN p_size > 1 THEN CASE p_type WHEN 'ECONOMY' THEN 'RESIDENTIAL' WHEN 'SMALL' THEN 'APARTMENT'
    WHEN 'MEDIUM' THEN 'MIXED USE' WHEN 'PROMO' THEN 'COMMERCIAL' WHEN 'LARGE' THEN 'NATURAL RESRC'
    WHEN 'STANDARD' THEN 'EXEMPT' END END AS account_type,
  p_size > 1 AND p_type IN ('ECONOMY', 'SMALL', 'MEDIUM') AS is_residential,
  p_size > 1 AND p_type IN ('MEDIUM', 'PROMO') AS is_commercial
FROM part""",
    "snapshot_date_parse": f"""{RAW}
SELECT DISTINCT file_index, CAST(strptime(file_index, '%Y%m%d') AS DATE) AS report_date FROM parcels""",
    "snapshot_select": f"{RAW} SELECT max(file_index) AS file_index FROM parcels",
    "snapshot_by_date": f"{RAW} SELECT DISTINCT file_index FROM parcels WHERE file_index = '{SNAPSHOT}'",
    "snapshot_pending": f"""{RAW}
SELECT DISTINCT file_index FROM parcels
EXCEPT
SELECT strftime(date_trunc('month', o_orderdate), '%Y%m%d') FROM orders""",
    "blank_key_filter": """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS parcel_id
FROM lineitem WHERE l_returnflag = 'N'""",
    "raw_owner_rows": """
SELECT DISTINCT l_returnflag || '-' || l_linenumber AS account_id, CAST(l_partkey AS VARCHAR) AS parcel_id,
  CAST(NULL AS VARCHAR) AS lot, l_returnflag = 'R' AS is_real_property, l_linestatus AS status_cd,
  p_size || ' ' || CASE WHEN p_type = 'PROMO' THEN p_brand || ' ' ELSE '' END || p_name || ' '
    || CASE WHEN p_type <> 'SMALL' THEN p_type ELSE '' END AS address,
  CAST(NULL AS VARCHAR) AS address_unit, '' AS city, s_name AS owner_name,
  CAST(CAST(l_discount AS DECIMAL(10,3)) AS DOUBLE) AS pct_own,
  CASE p_type WHEN 'ECONOMY' THEN 'RESIDENTIAL' WHEN 'SMALL' THEN 'APARTMENT' WHEN 'MEDIUM' THEN 'MIXED USE'
    WHEN 'PROMO' THEN 'COMMERCIAL' WHEN 'LARGE' THEN 'NATURAL RESRC' WHEN 'STANDARD' THEN 'EXEMPT' END
    AS account_type,
  strftime(date_trunc('month', l_shipdate), '%Y%m%d') AS file_index
FROM lineitem INNER JOIN supplier ON s_suppkey = l_suppkey INNER JOIN part ON p_partkey = l_partkey""",
    "csv_records": """
WITH part AS (
  SELECT doc_id, unnest(string_split(translate(text, 'q', '"'), chr(10))) AS x,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
counted AS (SELECT *, sum(length(x) - length(replace(x, '"', ''))) OVER (PARTITION BY doc_id ORDER BY i) AS quotes FROM part),
numbered AS (
  SELECT *, coalesce(sum((quotes % 2 = 0)::INTEGER) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r FROM counted),
record AS (SELECT doc_id, rtrim(string_agg(x, chr(10) ORDER BY i), chr(13) || chr(10)) AS value FROM numbered GROUP BY doc_id, r)
SELECT doc_id, count(*) AS records, max(length(value)) AS longest FROM record WHERE value <> '' GROUP BY doc_id""",
    "raw_parcel_rows": f"""WITH {SHAPES}
SELECT CAST(p_partkey AS VARCHAR) AS object_id, CAST(p_partkey AS VARCHAR) AS parcel_id,
  CAST(p_size AS VARCHAR) AS shape_area, '{SNAPSHOT}' AS file_index, round({SHAPE_AREA}, 2) AS area_m2
FROM shapes WHERE p_type IN ('ECONOMY', 'STANDARD')""",
    "shape_vertices": """
SELECT CAST(p_partkey AS VARCHAR) AS parcel_id,
  CAST(1 + (p_size % 5 = 0)::INTEGER AS INTEGER) AS polygons,
  CAST(1 + (p_size % 2 = 0)::INTEGER + (p_size % 5 = 0)::INTEGER AS INTEGER) AS rings,
  CAST(5 * (1 + (p_size % 2 = 0)::INTEGER + (p_size % 5 = 0)::INTEGER) AS INTEGER) AS vertices
FROM part""",
    "geodesic_area": f"""WITH {SHAPES}
SELECT CAST(p_partkey AS VARCHAR) AS parcel_id,
  round({SHAPE_AREA}, 2) AS area_m2
FROM shapes""",
    "dq_multi_feature": f"""{RAW}
SELECT file_index, parcel_id, count(*) AS features FROM parcels GROUP BY ALL HAVING count(*) > 1""",
    "dq_no_geometry": f"""
SELECT '{SNAPSHOT}' AS file_index, count(*) AS features FROM part
WHERE p_type IN ('LARGE', 'PROMO') HAVING count(*) > 0""",
    "dq_unknown_parcel": f"""{RAW}, {DRAWN}
SELECT file_index, parcel_id, count(*) AS owner_rows FROM owners
WHERE (file_index, parcel_id) NOT IN (SELECT (file_index, parcel_id) FROM drawn) GROUP BY ALL""",
    "dq_unowned_parcel": f"""{RAW}, {DRAWN}
SELECT file_index, parcel_id FROM drawn
EXCEPT SELECT file_index, parcel_id FROM owners""",
    "wkb_vertices": """
WITH shapes AS (
  SELECT CAST(p_partkey AS VARCHAR) AS parcel_id, p_partkey % 100 AS x, p_size AS y, p_size % 2 = 0 AS hole, p_size % 5 = 0 AS island
  FROM part)
SELECT parcel_id, CAST(1 + CAST(island AS INT) AS INT) AS polygons,
  CAST(1 + CAST(hole AS INT) + CAST(island AS INT) AS INT) AS rings,
  CAST(5 * (1 + CAST(hole AS INT) + CAST(island AS INT)) AS INT) AS vertices,
  CAST(5 * x + 8 + CASE WHEN hole THEN 5 * (x + 1) + 4 ELSE 0 END + CASE WHEN island THEN 5 * x + 4 ELSE 0 END AS DOUBLE) AS sum_x,
  CAST(5 * y + 8 + CASE WHEN hole THEN 5 * (y + 1) + 4 ELSE 0 END + CASE WHEN island THEN 5 * (y + 50) + 4 ELSE 0 END AS DOUBLE) AS sum_y
FROM shapes""",
    "dq_profile": f"""{RAW},
profile AS (
  SELECT coalesce(f.file_index, o.file_index) AS file_index, coalesce(n, 0) AS n, coalesce(lost, 0) AS lost,
    coalesce(owner_rows, 0) AS owner_rows, coalesce(types, 0) AS types, total
  FROM (SELECT file_index, parcel_id, count(*) AS n, count(*) FILTER (area_m2 % 7 = 0) AS lost FROM parcels GROUP BY ALL) f
  FULL JOIN (
    SELECT file_index, parcel_id, count(*) AS owner_rows, count(DISTINCT account_type) FILTER (is_real_property) AS types
    FROM owners GROUP BY ALL) o USING (file_index, parcel_id)
  LEFT JOIN (
    SELECT file_index, parcel_id, 10 * sum(pct_own) AS total
    FROM (SELECT DISTINCT file_index, parcel_id, owner_name, pct_own FROM owners WHERE is_real_property) GROUP BY ALL
  ) s USING (file_index, parcel_id))
SELECT file_index, report, count(*) AS parcels FROM (
  SELECT file_index, unnest([CASE WHEN n > 1 THEN 'multi_feature' END, CASE WHEN lost > 0 THEN 'no_geometry' END,
    CASE WHEN owner_rows > 0 AND n = 0 THEN 'unknown' END, CASE WHEN owner_rows = 0 THEN 'unowned' END,
    CASE WHEN total > 1 THEN 'overallocated' END, CASE WHEN types > 1 THEN 'multi_type' END]) AS report FROM profile)
WHERE report IS NOT NULL GROUP BY ALL""",
    "landed_owner_rows": """
SELECT DISTINCT l_returnflag || '-' || l_linenumber AS account_id, CAST(l_partkey AS VARCHAR) AS parcel_id,
  CAST(NULL AS VARCHAR) AS lot, l_returnflag = 'R' AS is_real_property, l_linestatus AS status_cd,
  p_size || ' ' || CASE WHEN p_type = 'PROMO' THEN p_brand || ' ' ELSE '' END || p_name || ' '
    || CASE WHEN p_type <> 'SMALL' THEN p_type ELSE '' END AS address,
  CAST(NULL AS VARCHAR) AS address_unit, '' AS city, s_name || chr(10) || '"' || l_linestatus || '", heir' AS owner_name,
  CAST(CAST(l_discount AS DECIMAL(10,3)) AS DOUBLE) AS pct_own,
  CASE p_type WHEN 'ECONOMY' THEN 'RESIDENTIAL' WHEN 'SMALL' THEN 'APARTMENT' WHEN 'MEDIUM' THEN 'MIXED USE'
    WHEN 'PROMO' THEN 'COMMERCIAL' WHEN 'LARGE' THEN 'NATURAL RESRC' WHEN 'STANDARD' THEN 'EXEMPT' END
    AS account_type,
  strftime(date_trunc('year', l_shipdate), '%Y%m%d') AS file_index
FROM lineitem INNER JOIN supplier ON s_suppkey = l_suppkey INNER JOIN part ON p_partkey = l_partkey""",
    "dq_overallocated": f"""{RAW}
SELECT file_index, parcel_id, {_dbl('10 * sum(pct_own)')} AS total_stake
FROM (SELECT DISTINCT file_index, parcel_id, owner_name, pct_own FROM owners WHERE is_real_property)
GROUP BY file_index, parcel_id HAVING sum(pct_own) * 10 > 1""",
    "dq_multi_type": f"""{RAW}
SELECT file_index, p_brand AS parcel_id, count(DISTINCT account_type) AS account_types
FROM owners INNER JOIN part ON CAST(p_partkey AS VARCHAR) = parcel_id
WHERE is_real_property GROUP BY ALL HAVING count(DISTINCT account_type) > 1""",
}


# a mart rebuilt step by step is the mart of all snapshots
ORACLE["owner_mart_after_replacement"] = ORACLE["owner_daily_summary"]
ORACLE["type_mart_after_replacement"] = ORACLE["land_type_daily_summary"]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
