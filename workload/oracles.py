"""DuckDB SQL with the same results as ``queries``, on the same tables."""

from __future__ import annotations

# Labels and scale spelled out again, so that a wrong value in the library does not pass.
_STATUS = """CASE stat WHEN 'HU' THEN 'hurricane' WHEN 'TS' THEN 'tropical storm' WHEN 'EX' THEN 'extratropical cyclone'
      WHEN 'TD' THEN 'tropical depression' WHEN 'LO' THEN 'low pressure system' WHEN 'WV' THEN 'tropical wave' END"""
_RECORD = "CASE rec WHEN '' THEN '' WHEN 'L' THEN 'landfall' WHEN 'I' THEN 'pressure and wind intensity peak' END"


def _category(wind: str, status: str) -> str:
    return f"""CASE WHEN {wind}>=137 THEN '5-MAJOR' WHEN {wind}>=113 THEN '4-MAJOR' WHEN {wind}>=96 THEN '3-MAJOR'
      WHEN {wind}>=83 THEN '2' WHEN {wind}>=64 THEN '1' WHEN {wind}<64 THEN {status} ELSE 'uncategorized' END"""


_SCALE = """scale(storm_category, min_kt, max_kt, damage) AS (VALUES
    ('1', 64, 82, 'Power outages that could last a few to several days.'),
    ('2', 83, 95, 'Near-total power loss is expected with outages that could last from several days to weeks.'),
    ('3-MAJOR', 96, 112, 'Electricity and water will be unavailable for several days to weeks after the storm passes.'),
    ('4-MAJOR', 113, 136, 'Catastrophic damage will occur; most of the area will be uninhabitable for weeks or months.'),
    ('5-MAJOR', 137, 1000000, 'Catastrophic damage will occur; most of the area will be uninhabitable for weeks or months.'))"""

# The feed: typed columns next to the line text that decides the order of lines.
_LINES = f"""
item AS (SELECT l_partkey AS block, 1 AS kind, l_shipdate, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS qty,
    CASE WHEN l_returnflag='R' AND l_linestatus='F' AND l_tax>=0.07 THEN 'L' WHEN l_returnflag='N' THEN 'I'
      WHEN l_returnflag='A' AND l_linestatus='F' THEN 'Z' ELSE '' END AS rec,
    ['HU','TS','EX','TD','LO','WV','XX'][l_linenumber] AS stat,
    (l_suppkey*37+l_partkey*11+CAST(l_quantity AS BIGINT)*53)%900 AS la,
    (l_partkey*29+l_suppkey*7+CAST(l_quantity AS BIGINT)*101)%1900 AS lo,
    CASE WHEN l_discount>=0.08 THEN 'S' ELSE 'N' END AS ns, CASE WHEN l_discount<=0.01 THEN 'W' ELSE 'E' END AS ew,
    l_discount=0 AS no_pressure FROM lineitem),
size AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1),
head AS (SELECT p_partkey AS block, 0 AS kind, 'AL'||lpad(CAST(p_partkey%100 AS VARCHAR),2,'0')||(1900+p_size) AS storm_id,
    CASE WHEN p_type='STANDARD' THEN 'UNNAMED' ELSE p_name END AS name,
    coalesce(n,0)+CASE WHEN p_type='SMALL' THEN 2 ELSE 0 END AS entries FROM part LEFT JOIN size ON l_partkey=p_partkey),
lines AS (
  SELECT block, kind, ' '||storm_id||' ,  '||name||', '||entries||',' AS value, storm_id, name, entries,
    NULL::DATE AS storm_date, NULL::VARCHAR AS storm_time, NULL::VARCHAR AS rec, NULL::VARCHAR AS stat,
    NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude, NULL::INTEGER AS wind, NULL::INTEGER AS pressure FROM head
  UNION ALL
  SELECT block, kind, strftime(l_shipdate,'%Y%m%d')||', '||lpad(CAST(line*300 AS VARCHAR),4,'0')||', '||rec||', '||stat
    ||', '||la//10||'.'||la%10||ns||', '||lo//10||'.'||lo%10||ew
    ||', '||CASE WHEN line=7 THEN 'n/a' WHEN line=4 THEN CAST(qty+line*20 AS VARCHAR)||'.0' ELSE CAST(qty+line*20 AS VARCHAR) END
    ||', '||CASE WHEN no_pressure THEN '-999' ELSE CAST(qty+880 AS VARCHAR) END
    ||CASE WHEN line=5 THEN ', 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25' ELSE '' END,
    NULL, NULL, NULL, CAST(l_shipdate AS DATE), lpad(CAST(line*300 AS VARCHAR),4,'0'),
    {_RECORD}, {_STATUS},
    CASE ns WHEN 'N' THEN 1 ELSE -1 END * (la/10.0::DOUBLE) + 0.0::DOUBLE,
    CASE ew WHEN 'E' THEN 1 ELSE -1 END * (lo/10.0::DOUBLE) + 0.0::DOUBLE,
    CASE WHEN line<>7 THEN CAST(qty+line*20 AS INTEGER) END,
    CASE WHEN no_pressure THEN -999 ELSE CAST(qty+880 AS INTEGER) END FROM item),
feed AS (SELECT *, CAST(row_number() OVER (ORDER BY block, kind, value)-1 AS BIGINT) AS line_id FROM lines),
headers AS (SELECT line_id AS header_id, storm_id, upper(name) AS storm_name, CAST(entries AS BIGINT) AS entries,
    substring(storm_id,1,2) AS basin, CAST(substring(storm_id,3,2) AS INTEGER) AS atcf_cyclone_num,
    CAST(substring(storm_id,5,4) AS INTEGER) AS storm_year FROM feed WHERE kind=0),
stats AS (SELECT line_id AS stat_id, storm_date, CAST(year(storm_date) AS INTEGER) AS storm_year,
    CAST(month(storm_date) AS INTEGER) AS storm_month, CAST(day(storm_date) AS INTEGER) AS storm_day, storm_time,
    rec AS record_identifier, stat AS storm_status, {_category('wind', 'stat')} AS storm_category, latitude, longitude,
    wind AS max_sustained_wind_kt, pressure AS min_pressure_mbar FROM feed WHERE kind=1),
pairs AS (SELECT h.header_id, h.storm_id, h.storm_name, h.basin, h.atcf_cyclone_num, h.entries, s.*
    FROM headers h JOIN stats s ON s.stat_id BETWEEN h.header_id AND h.header_id+h.entries)"""

# Inside: the box without its corner. NULL state where no known state holds the point.
_LANDFALLS = """
known AS (SELECT n_name AS state, CAST(n_nationkey AS VARCHAR) AS state_code FROM nation
    JOIN region ON n_regionkey=r_regionkey WHERE r_name<>'AFRICA'),
box AS (SELECT n_name AS state, (n_nationkey//5)*18 AS la, (n_nationkey%5)*36 AS lo FROM nation),
landed AS (SELECT * FROM pairs WHERE NOT contains(storm_name,'UNNAMED') AND record_identifier='landfall'),
located AS (SELECT landed.*, known.state, known.state_code FROM landed
    LEFT JOIN box ON latitude>=la AND latitude<la+18 AND longitude>=lo AND longitude<lo+36
      AND 2*(latitude-la)+(longitude-lo)<60.05
    LEFT JOIN known ON known.state=box.state),
swl AS (SELECT DISTINCT storm_id, storm_name, storm_year, storm_status, storm_category, latitude, longitude, state, state_code
    FROM located WHERE state IS NOT NULL),
landfalls AS (SELECT CAST(row_number() OVER (ORDER BY storm_id, storm_name, storm_year, storm_status NULLS FIRST,
    storm_category NULLS FIRST, latitude, longitude, state) AS BIGINT) AS swl_id, storm_id, storm_name, storm_year,
    storm_status, storm_category, state_code FROM swl)"""

_NAMES = """
names AS (SELECT CAST(row_number() OVER (ORDER BY CAST(1900+p_size AS VARCHAR), p_brand, p_name, p_type, CAST(p_partkey AS VARCHAR))
    AS BIGINT) AS name_id, upper(p_name) AS birth_name, CAST(1900+p_size AS VARCHAR) AS birth_year, p_brand AS state_code,
    p_type AS sex, CAST(p_partkey AS VARCHAR) AS name_count, CAST((1900+p_size)//10*10 AS INTEGER) AS decade FROM part)"""

_FACT = f"""
{_SCALE},
fact AS (SELECT swl_id, storm_id, name_id, storm_name, birth_name AS baby_name, storm_year, birth_year AS baby_birth_year,
    l.state_code, storm_status, l.storm_category, damage AS storm_damage_description, sex AS baby_sex, name_count
    FROM landfalls l JOIN names ON storm_name=birth_name LEFT JOIN scale ON scale.storm_category=l.storm_category)"""

_FULL_FACT = ", ".join([_LINES, _LANDFALLS, _NAMES, _FACT])

_MAX_ALL = """SELECT storm_name, storm_year, storm_status, storm_category, baby_name, baby_birth_year, state_code,
  max(CAST(name_count AS INTEGER)) AS max_name_count FROM fact GROUP BY ALL"""

_MAX = """SELECT storm_name, storm_year, storm_status, storm_category, baby_name, baby_birth_year, state_code,
  max(CAST(name_count AS INTEGER)) AS max_name_count FROM fact WHERE {} GROUP BY ALL"""

_FACT_WITH_ID = f"""WITH {_FULL_FACT} SELECT CAST(row_number() OVER (ORDER BY name_count, swl_id, name_id, state_code) AS BIGINT)
  AS bsn_id, * FROM fact"""

_CUSTOMER_STATES = """c AS (SELECT c_name AS state, CAST(c_custkey AS VARCHAR) AS state_code, c_mktsegment AS region,
  CAST(c_nationkey AS VARCHAR) AS division FROM customer)"""

_ALL_NAMES = "a AS (SELECT p_brand AS state_code, upper(p_name) AS birth_name, 1900+p_size AS y, p_partkey FROM part)"

SQL = {
    "q_wind_scale": f"""WITH {_LINES}, {_SCALE}, c AS (SELECT storm_category, count(*) AS n FROM stats GROUP BY 1)
      SELECT c.storm_category, CAST(n AS BIGINT) AS n, CAST(min_kt AS BIGINT) AS min_sustained_wind_kt,
      CAST(max_kt AS BIGINT) AS max_sustained_wind_kt, damage AS brief_damage_description
      FROM c LEFT JOIN scale ON scale.storm_category=c.storm_category""",
    "q_name_lines": f"WITH {_NAMES} SELECT state_code, sex, birth_year, birth_name, name_count, decade FROM names",
    "q_name_ids": f"WITH {_NAMES} SELECT * FROM names",
    "q_states": f"""WITH {_CUSTOMER_STATES} SELECT CAST(row_number() OVER (ORDER BY state, state_code) AS BIGINT) AS state_id,
      * FROM c""",
    "q_headers": f"WITH {_LINES} SELECT * FROM headers ORDER BY header_id",
    "q_details": f"WITH {_LINES} SELECT * FROM stats",
    "q_code_map": """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'min central pressure' WHEN 'F' THEN 'final' END
      AS label FROM orders""",
    "q_coords": """WITH t AS (SELECT *, (c_custkey%900)//10||'.'||c_custkey%10 AS la, (c_custkey%1800)//10||'.'||c_custkey%10 AS lo
      FROM customer) SELECT c_custkey, CASE WHEN c_acctbal<0 THEN -1 ELSE 1 END * CAST(la AS DOUBLE) + 0.0 AS latitude,
      CASE WHEN c_mktsegment='MACHINERY' THEN 1 ELSE -1 END * CAST(lo AS DOUBLE) + 0.0 AS longitude FROM t""",
    "q_category": f"""WITH d AS (SELECT CASE WHEN l_linenumber<>7 THEN CAST(l_quantity AS INTEGER)+20*l_linenumber END AS wind,
      CASE l_returnflag WHEN 'R' THEN 'tropical storm' WHEN 'A' THEN 'disturbance' END AS status FROM lineitem)
      SELECT wind, status, {_category('wind', 'status')} AS category, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY ALL""",
    "q_block_join": f"""WITH {_LINES} SELECT header_id, storm_name, entries, stat_id, max_sustained_wind_kt FROM pairs""",
    "q_track_ids": f"""WITH {_LINES} SELECT CAST(row_number() OVER (ORDER BY storm_id, header_id, stat_id) AS BIGINT) AS atl_id,
      storm_id, basin, atcf_cyclone_num, storm_name, storm_date, storm_year, storm_time, record_identifier, storm_status,
      storm_category, latitude, longitude, max_sustained_wind_kt, min_pressure_mbar FROM pairs""",
    "q_track_ingest": f"""WITH {_LINES} SELECT line_id, {', '.join(
        f"nullif(split_part(value, ',', {i + 1}), '') AS field_{i}" for i in range(25))} FROM feed""",
    "q_landfall": f"""WITH {_LINES}, {_LANDFALLS} SELECT storm_id, storm_name, storm_date, storm_time, latitude, longitude, state
      FROM located""",
    "q_landfall_ids": f"WITH {_LINES}, {_LANDFALLS} SELECT * FROM landfalls",
    "q_fact_join": _FACT_WITH_ID,
    "q_fact_ids": """SELECT CAST(row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR), p_name) AS BIGINT) AS bsn_id,
      CAST(p_partkey AS VARCHAR) AS name_count, CAST(p_partkey AS INTEGER) AS name_count_int FROM part""",
    "q_fact_max": f"WITH {_FULL_FACT} "
    + _MAX.format(
        "storm_name='HOT RING' AND storm_year=2001 AND state_code='7' AND (baby_birth_year='1903' OR baby_birth_year='1904'"
        " OR baby_birth_year='1906' OR baby_birth_year='1910')"
    )
    + " ORDER BY baby_birth_year",
    "q_fact_max_storm": f"WITH {_FULL_FACT} "
    + _MAX.format("storm_name='HOT BOLT' AND storm_year=1999 AND baby_birth_year IN ('1906','1911','1933')")
    + " ORDER BY baby_birth_year",
    "q_fact_max_all_states": f"WITH {_FULL_FACT} {_MAX_ALL} ORDER BY baby_birth_year",
    "q_fact_max_from_dims": f"WITH {_FULL_FACT} {_MAX_ALL}",
    "q_missing": f"""WITH {_LINES}, m(feed, column_name, lost) AS (
      {' UNION ALL '.join(
        f"SELECT 'tracks', '{i}', count(*) FILTER (split_part(value, ',', {i + 1}) = '') FROM lines" for i in range(25))}
      UNION ALL SELECT 'tracks', '_c0', 0
      {' '.join(f"UNION ALL SELECT 'names', '{n}', count(*) FILTER ({c} IS NULL) FROM part" for n, c in [
        ('state_code', 'p_brand'), ('sex', 'p_type'), ('birth_year', 'p_size'), ('birth_name', 'p_name'), ('count', 'p_partkey')])}
      {' '.join(f"UNION ALL SELECT 'states', '{n}', count(*) FILTER ({c} IS NULL) FROM customer" for n, c in [
        ('State', 'c_name'), ('State Code', 'c_custkey'), ('Region', 'c_mktsegment'), ('Division', 'c_nationkey')])}
      UNION ALL SELECT 'events', 'event_type', count(*) FILTER (nullif(event_type,'error') IS NULL) FROM events
      UNION ALL SELECT 'events', 'value', count(*) FILTER (value>200 OR value IS NULL) FROM events
      {' '.join(f"UNION ALL SELECT 'events', '{c}', count(*) FILTER ({c} IS NULL) FROM events"
        for c in ['event_id', 'ts', 'user_id', 'props'])})
      SELECT feed, column_name, CAST(lost AS BIGINT) AS n_missing FROM m""",
    "q_duplicates": """WITH twice AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber=2)
      SELECT CAST(count(*) AS BIGINT) AS n_duplicate_groups FROM (SELECT count(*) AS n FROM twice GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) WHERE n>1""",
    "q_ragged": f"""WITH {_LINES} SELECT CAST(count(*) FILTER (nullif(split_part(value,',',4),'') IS NULL) AS BIGINT) AS short_rows,
      CAST(count(*) AS BIGINT) AS all_rows FROM lines""",
    "q_check_blocks": f"""WITH {_LINES}, e AS (SELECT (SELECT count(*) FROM feed) AS expected,
      (SELECT count(*) FROM headers)+(SELECT count(*) FROM pairs) AS actual)
      SELECT 'storms' AS check_name, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
      expected=actual AS passed FROM e""",
    "q_check_names": f"""WITH {_NAMES}, e AS (SELECT (SELECT count(*) FROM part) AS expected, (SELECT count(*) FROM names) AS actual,
      (SELECT count(*) FROM names WHERE birth_name IS NULL OR birth_year IS NULL) AS lost)
      SELECT 'names' AS check_name, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
      CAST(lost AS BIGINT) AS null_keys, expected=actual AND lost=0 AS passed FROM e""",
    "q_check_states": """SELECT 'states' AS check_name, CAST(count(*) AS BIGINT) AS expected,
      CAST(count(*) FILTER (c_acctbal>=0)+count(*) FILTER (c_acctbal<0) AS BIGINT) AS actual,
      CAST(count(*) FILTER (c_acctbal<0) AS BIGINT) AS null_keys, count(*) FILTER (c_acctbal<0)=0 AS passed FROM customer""",
    "q_check_coords": f"""WITH {_LINES}, e AS (SELECT CAST(count(*) FILTER (latitude IS NULL OR abs(latitude)>90) AS BIGINT) AS bad_latitude,
      CAST(count(*) FILTER (longitude IS NULL OR abs(longitude)>180) AS BIGINT) AS bad_longitude FROM stats)
      SELECT *, bad_latitude=0 AND bad_longitude=0 AS passed FROM e""",
    "q_check_landfall": f"""WITH {_LINES}, {_LANDFALLS}, e AS (SELECT (SELECT count(*) FROM landed) AS total,
      (SELECT count(*) FROM located WHERE state IS NOT NULL) AS in_region, (SELECT count(*) FROM landed WHERE NOT EXISTS
        (SELECT 1 FROM box JOIN known USING (state) WHERE latitude>=la AND latitude<la+18 AND longitude>=lo AND longitude<lo+36
          AND 2*(latitude-la)+(longitude-lo)<60.05)) AS no_region)
      SELECT CAST(total AS BIGINT) AS total, CAST(in_region AS BIGINT) AS in_region, CAST(no_region AS BIGINT) AS no_region,
      in_region+no_region=total AS passed FROM e""",
    "q_top_names": f"""WITH {_ALL_NAMES}, t AS (SELECT state_code, birth_name, CAST(sum(p_partkey) AS BIGINT) AS total FROM a
      WHERE y BETWEEN 1910 AND 1940 GROUP BY ALL)
      SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY state_code ORDER BY total DESC, birth_name)<=3""",
    "q_parquet_roundtrip": """SELECT o_orderkey, o_orderpriority, o_orderstatus AS state_code,
      CAST(year(o_orderdate) AS INTEGER) AS birth_year FROM orders""",
    "q_text_roundtrip": """SELECT c_name AS state, CAST(c_custkey AS VARCHAR) AS state_code, c_mktsegment AS region,
      CAST(c_nationkey AS VARCHAR) AS division FROM customer WHERE c_acctbal>=0""",
    "q_decades": """SELECT CAST(year(o_orderdate)//10*10 AS INTEGER) AS decade, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1""",
    "q_build_all": _FACT_WITH_ID,
    "q_stored_states": f"""WITH {_LINES}, {_LANDFALLS} SELECT CAST(row_number() OVER (ORDER BY state, k.state_code) AS BIGINT) AS state_id,
      k.state_code, state, r_name AS region, k.state_code AS division FROM known k JOIN nation ON n_name=state
      JOIN region ON n_regionkey=r_regionkey""",
    "q_stored_headers": f"WITH {_LINES} SELECT * FROM headers",
    "q_stored_stats": f"""WITH {_LINES} SELECT CAST(stat_id AS VARCHAR) AS "index", storm_date, storm_year, storm_month, storm_day,
      storm_time, record_identifier, storm_status, storm_category AS category, latitude, longitude, max_sustained_wind_kt,
      min_pressure_mbar FROM stats""",
    "q_stored_names": f"WITH {_NAMES} SELECT * FROM names",
    "q_stored_landfalls": f"WITH {_LINES}, {_LANDFALLS} SELECT * FROM landfalls",
    "q_fact_glob": _FACT_WITH_ID,
    "q_fact_first": f"{_FACT_WITH_ID} ORDER BY bsn_id LIMIT 25",
}
SQL["q_track_csv"] = SQL["q_track_ingest"]
# Three years anew, without one sex; their ids go on after the last of the first build.
_REFRESHED = f"""
n0 AS (SELECT count(*) AS n FROM names), f0 AS (SELECT count(*) AS n FROM fact),
new_names AS (SELECT CAST(n + row_number() OVER (ORDER BY name_id) AS BIGINT) AS name_id, names.* EXCLUDE name_id FROM names, n0
    WHERE birth_year IN ('1903','1911','1950') AND sex<>'SMALL'),
new_fact AS (SELECT swl_id, storm_id, name_id, storm_name, birth_name AS baby_name, storm_year, birth_year AS baby_birth_year,
    l.state_code, storm_status, l.storm_category, damage AS storm_damage_description, sex AS baby_sex, name_count
    FROM landfalls l JOIN new_names ON storm_name=birth_name LEFT JOIN scale ON scale.storm_category=l.storm_category)"""
SQL["q_refresh_names"] = f"""WITH {_FULL_FACT}, {_REFRESHED}
    SELECT * FROM names WHERE birth_year NOT IN ('1903','1911','1950') UNION ALL SELECT * FROM new_names"""
SQL["q_refresh_fact"] = f"""WITH {_FULL_FACT}, {_REFRESHED}, old AS ({_FACT_WITH_ID})
    SELECT * FROM old WHERE baby_birth_year NOT IN ('1903','1911','1950') UNION ALL
    SELECT CAST(n + row_number() OVER (ORDER BY name_count, swl_id, name_id, state_code) AS BIGINT) AS bsn_id, new_fact.* FROM new_fact, f0"""
SQL["q_stored_scale"] = f"""WITH {_LINES}, {_SCALE}, c AS (SELECT storm_category, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY 1)
    SELECT scale.storm_category AS category, CAST(min_kt AS BIGINT) AS min_sustained_wind_kt,
    CAST(max_kt AS BIGINT) AS max_sustained_wind_kt, damage AS brief_damage_description, n
    FROM scale LEFT JOIN c ON c.storm_category=scale.storm_category"""
SQL["q_build_checks"] = f"""WITH {_LINES}, {_LANDFALLS}, e(check_name, expected, actual, bad) AS (
    SELECT 'storms', (SELECT count(*) FROM feed), (SELECT count(*) FROM headers)+(SELECT count(*) FROM pairs), 0
    UNION ALL SELECT 'names', count(*), count(*), count(*) FILTER (p_name IS NULL OR p_size IS NULL) FROM part
    UNION ALL SELECT 'states', count(*), count(*), count(*) FILTER (state IS NULL OR state_code IS NULL) FROM known
    UNION ALL SELECT 'coordinates', count(*), count(*), count(*) FILTER (latitude IS NULL OR abs(latitude)>90)
      + count(*) FILTER (longitude IS NULL OR abs(longitude)>180) FROM stats
    UNION ALL SELECT 'landfalls', (SELECT count(*) FROM landed), (SELECT count(*) FROM located), 0)
    SELECT check_name, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, CAST(bad AS BIGINT) AS bad,
    expected=actual AND bad=0 AS passed FROM e"""
SQL["q_stored_tracks"] = SQL["q_track_ids"]
