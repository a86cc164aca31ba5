"""Independent DuckDB SQL for every catalog query.

The domain extracts, labels, bounds and constants are restated here as
literals in DuckDB's dialect straight from the rules in FIXTURES.md; this
module imports nothing from the rest of the package, so a wrong bound,
label or constant there turns a row red. ``sql(name)`` returns one
self-contained statement over the driver's pre-registered tables.
"""

from __future__ import annotations

TS_FORMAT = "%m/%d/%Y %I:%M:%S %p"


def _milli(v: str) -> str:
    return f"(CAST(({v}) // 1000 AS VARCHAR) || '.' || lpad(CAST(({v}) % 1000 AS VARCHAR), 3, '0'))"


def _lat(i: str) -> str:
    return _milli(f"33000 + {i} * 37 % 2000")


def _lon(i: str) -> str:
    return "('-' || " + _milli(f"117000 + {i} // 2000 * 7 % 60000") + ")"


RAW_COLS = "dr_no, date_occ, time_occ, area, premis_desc, vict_descent, weapon_cd, lat, lon"

CTES: dict[str, str] = {}

CTES["orders_text"] = f"""
SELECT o_orderdate AS _day,
  CAST(o_orderkey AS VARCHAR) AS dr_no,
  CASE WHEN o_orderkey % 101 = 0 THEN 'bad' ELSE strftime(o_orderdate, '{TS_FORMAT}') END AS date_occ,
  lpad(CAST(o_orderkey * 7 % 2500 AS VARCHAR), 4, '0') AS time_occ,
  CAST(o_custkey % 27 + 1 AS VARCHAR) AS area,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'STREET' ELSE o_orderpriority END AS premis_desc,
  CASE WHEN o_custkey % 20 = 19 THEN NULL
       ELSE substr('ABCDFGHIJKLOPSUVWXZ', CAST(o_custkey % 20 AS INTEGER) + 1, 1) END AS vict_descent,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 300 AS VARCHAR) END AS weapon_cd,
  CASE WHEN o_orderkey % 97 = 0 THEN '0' ELSE {_lat('o_custkey')} END AS lat,
  CASE WHEN o_orderkey % 97 = 0 THEN '0' ELSE {_lon('o_custkey')} END AS lon
FROM orders"""
CTES["incidents_raw"] = f"SELECT {RAW_COLS} FROM orders_text"
CTES["incidents_a_raw"] = (f"SELECT {RAW_COLS} FROM orders_text "
                           f"WHERE _day < TIMESTAMP '1999-01-01'")
CTES["incidents_b_raw"] = (f"SELECT {RAW_COLS} FROM orders_text "
                           f"WHERE _day >= TIMESTAMP '1998-07-01'")
CTES["merged_raw"] = "SELECT * FROM incidents_a_raw UNION SELECT * FROM incidents_b_raw"


def _typed_incidents(src: str) -> str:
    return f"""
SELECT TRY_CAST(dr_no AS BIGINT) AS dr_no,
  try_strptime(date_occ, '{TS_FORMAT}') AS date_occ,
  time_occ,
  TRY_CAST(area AS INTEGER) AS area,
  premis_desc, vict_descent,
  TRY_CAST(weapon_cd AS INTEGER) AS weapon_cd,
  TRY_CAST(lat AS DOUBLE) AS lat,
  TRY_CAST(lon AS DOUBLE) AS lon
FROM {src}"""


CTES["incidents"] = _typed_incidents("incidents_raw")
CTES["incidents_a"] = _typed_incidents("incidents_a_raw")
CTES["incidents_b"] = _typed_incidents("incidents_b_raw")
CTES["merged"] = _typed_incidents("merged_raw")
CTES["stations_raw"] = f"""
SELECT CAST(n_nationkey + 1 AS VARCHAR) AS prec, n_name AS division,
  '-' || {_milli('118700 - n_nationkey * 31 % 600')} AS x, {_milli('33700 + n_nationkey * 29 % 600')} AS y
FROM nation"""
CTES["stations"] = """
SELECT CAST(prec AS INTEGER) AS prec, division, TRY_CAST(x AS DOUBLE) AS x, TRY_CAST(y AS DOUBLE) AS y FROM stations_raw"""
CTES["income_raw"] = """
SELECT CAST(90000 + n_nationkey AS VARCHAR) AS zip,
  CASE WHEN n_nationkey % 3 <> 0 THEN 'Los Angeles (' || n_name || ')' ELSE n_name END AS community,
  '$' || format('{:,}', 30000 + n_nationkey * 3721) AS median_income
FROM nation"""
CTES["income"] = """
SELECT CAST(zip AS INTEGER) AS zip, community,
  TRY_CAST(regexp_replace(median_income, '[$,]', '', 'g') AS DOUBLE) AS median_income FROM income_raw"""
CTES["revgeo_raw"] = f"""
SELECT {_lat('c_custkey')} AS lat, {_lon('c_custkey')} AS lon, CAST(90000 + c_custkey % 25 AS VARCHAR) AS zip
FROM customer WHERE c_custkey % 13 <> 0"""
CTES["revgeo"] = """
SELECT TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon, CAST(zip AS INTEGER) AS zip FROM revgeo_raw"""
CTES["households_raw"] = """
SELECT CAST(c_custkey AS VARCHAR) AS household_id, CAST(90000 + c_nationkey AS VARCHAR) AS zip,
  CASE WHEN c_custkey % 3 <> 0 THEN 'Los Angeles (' || c_mktsegment || ')' ELSE c_mktsegment END AS community,
  CASE WHEN c_custkey % 89 = 0 THEN 'n/a'
       ELSE '$' || format('{:,}', CAST(floor(c_acctbal) AS BIGINT)) END AS median_income
FROM customer"""
CTES["households"] = """
SELECT CAST(household_id AS BIGINT) AS household_id, CAST(zip AS INTEGER) AS zip, community,
  TRY_CAST(regexp_replace(median_income, '[$,]', '', 'g') AS DOUBLE) AS median_income FROM households_raw"""

DEPENDS = {
    "incidents_raw": ["orders_text"],
    "incidents_a_raw": ["orders_text"],
    "incidents_b_raw": ["orders_text"],
    "merged_raw": ["incidents_a_raw", "incidents_b_raw"],
    "incidents": ["incidents_raw"],
    "incidents_a": ["incidents_a_raw"],
    "incidents_b": ["incidents_b_raw"],
    "merged": ["merged_raw"],
    "stations": ["stations_raw"],
    "income": ["income_raw"],
    "revgeo": ["revgeo_raw"],
    "households": ["households_raw"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{n} AS ({CTES[n]}\n)" for n in _closure(views)]
    # A long chain of steps: materialised, or the optimizer multiplies their expressions out.
    parts += [f"{n} AS MATERIALIZED ({q}\n)" for n, q in extra or []]
    return "WITH " + ",\n".join(parts) + "\n" + body


def descent_case(col: str) -> str:
    return f"""CASE WHEN {col} = 'A' THEN 'Other Asian' WHEN {col} = 'B' THEN 'Black' WHEN {col} = 'C' THEN 'Chinese'
  WHEN {col} = 'D' THEN 'Cambodian' WHEN {col} = 'F' THEN 'Filipino' WHEN {col} = 'G' THEN 'Guamanian'
  WHEN {col} IN ('H', 'I') THEN 'Hispanic/Latin/Mexican' WHEN {col} = 'J' THEN 'Japanese' WHEN {col} = 'K' THEN 'Korean'
  WHEN {col} = 'L' THEN 'Laotian' WHEN {col} = 'O' THEN 'Other' WHEN {col} = 'P' THEN 'Pacific Islander'
  WHEN {col} = 'S' THEN 'Samoan' WHEN {col} = 'U' THEN 'Hawaiian' WHEN {col} = 'V' THEN 'Vietnamese'
  WHEN {col} = 'W' THEN 'White' WHEN {col} = 'X' THEN 'Unknown' WHEN {col} = 'Z' THEN 'Asian Indian'
  ELSE 'OTHERWISE' END"""


def daypart_text_case(col: str) -> str:
    return f"""CASE WHEN {col} BETWEEN '0500' AND '1159' THEN 'MORNING' WHEN {col} BETWEEN '1200' AND '1659' THEN 'AFTERNOON'
  WHEN {col} BETWEEN '1700' AND '2059' THEN 'EVENING' WHEN {col} >= '2100' OR {col} <= '0459' THEN 'NIGHT'
  ELSE 'OTHERWISE' END"""


def daypart_number_case(col: str) -> str:
    t = f"TRY_CAST({col} AS INTEGER)"
    return f"""CASE WHEN {t} BETWEEN 500 AND 1159 THEN 'MORNING' WHEN {t} BETWEEN 1200 AND 1659 THEN 'AFTERNOON'
  WHEN {t} BETWEEN 1700 AND 2059 THEN 'EVENING' WHEN {t} BETWEEN 2100 AND 2359 OR {t} BETWEEN 0 AND 459 THEN 'NIGHT'
  ELSE 'UNKNOWN' END"""


def geodesic_ctes(src: str) -> list[tuple[str, str]]:
    """CTE chain adding ``distance`` to ``src`` (columns lat1, lon1, lat2, lon2).

    The inverse problem by fixed-point iteration on the auxiliary sphere in
    Cartesian form (unit vectors of the reduced latitudes; great-circle
    angle and equatorial azimuth from cross and dot products), with Helmert's
    series in the third-flattening-like parameter k1 for the length.
    """
    f = "(1 / 298.257223563)"
    out = [("w0", f"SELECT *, atan((1 - {f}) * tan(radians(lat1))) AS b1, atan((1 - {f}) * tan(radians(lat2))) AS b2,"
                  f" radians(lon2) - radians(lon1) AS dl, radians(lon2) - radians(lon1) AS w FROM {src}")]
    turns = 12
    for k in range(turns):
        # Unit vectors p = (cos b1, 0, sin b1) and q = (cos b2 cos w, cos b2 sin w, sin b2); n = p x q.
        out.append((f"turn{k}", "SELECT *, CASE WHEN ca2 < 1e-15 THEN 0 ELSE dot - 2 * sin(b1) * sin(b2) / ca2 END AS cm FROM ("
                    "SELECT *, 1 - sa * sa AS ca2 FROM ("
                    "SELECT *, atan2(sqrt(nx * nx + ny * ny + nz * nz), dot) AS arc,"
                    " CASE WHEN nx * nx + ny * ny + nz * nz = 0 THEN 0 ELSE nz / sqrt(nx * nx + ny * ny + nz * nz) END AS sa FROM ("
                    "SELECT lat1, lon1, lat2, lon2, division, b1, b2, dl, w, -sin(b1) * cos(b2) * sin(w) AS nx,"
                    " sin(b1) * cos(b2) * cos(w) - cos(b1) * sin(b2) AS ny, cos(b1) * cos(b2) * sin(w) AS nz,"
                    f" cos(b1) * cos(b2) * cos(w) + sin(b1) * sin(b2) AS dot FROM w{k})))"))
        c = f"({f} / 16 * ca2 * (4 + {f} * (4 - 3 * ca2)))"
        out.append((f"w{k + 1}", f"SELECT lat1, lon1, lat2, lon2, division, b1, b2, dl,"
                    f" dl + (1 - {c}) * {f} * sa * (arc + {c} * sin(arc) * (cm + {c} * dot * (2 * cm * cm - 1))) AS w FROM turn{k}"))
    b = f"(6378.137 * (1 - {f}))"
    out.append(("series", f"SELECT *, (sqrt(1 + ca2 * (pow(6378.137, 2) / pow({b}, 2) - 1)) - 1)"
                       f" / (sqrt(1 + ca2 * (pow(6378.137, 2) / pow({b}, 2) - 1)) + 1) AS k1 FROM turn{turns - 1}"))
    out.append(("scaled", "SELECT *, (1 + k1 * k1 / 4) / (1 - k1) AS big_a, k1 * (1 - 3 * k1 * k1 / 8) AS big_b FROM series"))
    out.append(("g3", f"SELECT *, {b} * big_a * (arc - big_b * sin(arc) * (cm + big_b / 4 * (dot * (2 * cm * cm - 1)"
                      " - big_b / 6 * cm * (4 * pow(sin(arc), 2) - 3) * (4 * cm * cm - 3)))) AS distance FROM scaled"))
    return out


def _checksums() -> str:
    columns = {"incidents": RAW_COLS, "stations": "prec, division, x, y", "income": "zip, community, median_income",
               "revgeo": "lat, lon, zip", "households": "household_id, zip, community, median_income"}
    parts = []
    for name, cols in columns.items():
        text = " || '|' || ".join(f"coalesce({c}, '<null>')" for c in cols.split(", "))
        parts.append(f"SELECT '{name}' AS table_name, count(*) AS row_count,"
                     f" CAST(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) AS BIGINT) AS checksum FROM {name}_raw")
    return " UNION ALL ".join(parts)


CITY = "'%Los Angeles (%'"


def _q1(src: str, count_name: str) -> str:
    return with_views([src], f"""
, ym AS (SELECT CAST(year(date_occ) AS INTEGER) AS year, CAST(month(date_occ) AS INTEGER) AS month
         FROM {src}),
ranked AS (SELECT year, month, count(*) AS {count_name},
                  CAST(rank() OVER (PARTITION BY year ORDER BY count(*) DESC) AS INTEGER) AS "rank"
           FROM ym GROUP BY year, month)
SELECT year, month, {count_name}, "rank" FROM ranked WHERE "rank" <= 3""")


def _q2(case: str) -> str:
    return with_views(["merged"], f"""
SELECT {case} AS time_of_day, count(*) AS "count"
FROM merged WHERE premis_desc = 'STREET' GROUP BY 1""")


def _q3_zips(order: str) -> str:
    return (f"SELECT zip FROM income WHERE community LIKE {CITY} AND median_income IS NOT NULL "
            f"ORDER BY median_income {order}, zip LIMIT 3")


def _q3(order: str) -> str:
    return with_views(["incidents_a", "revgeo", "income"], f"""
, zips AS ({_q3_zips(order)}),
per_zip AS (SELECT g.zip, v.vict_descent, count(*) AS "count"
            FROM incidents_a v JOIN revgeo g ON v.lat = g.lat AND v.lon = g.lon
            WHERE v.vict_descent IS NOT NULL GROUP BY g.zip, v.vict_descent)
SELECT zip, p.vict_descent AS descent_code, {descent_case('p.vict_descent')} AS descent, p."count"
FROM zips JOIN per_zip p USING (zip)""")


def _q3_both() -> str:
    return with_views(["incidents_a", "revgeo", "income"], f"""
, zips AS (SELECT 'richest' AS side, zip FROM ({_q3_zips('DESC')})
           UNION ALL SELECT 'poorest' AS side, zip FROM ({_q3_zips('ASC')})),
per_zip AS (SELECT g.zip, v.vict_descent, count(*) AS "count"
            FROM incidents_a v JOIN revgeo g ON v.lat = g.lat AND v.lon = g.lon
            WHERE v.vict_descent IS NOT NULL GROUP BY g.zip, v.vict_descent)
SELECT side, zip, p.vict_descent AS descent_code, {descent_case('p.vict_descent')} AS descent,
       p."count"
FROM zips JOIN per_zip p USING (zip)""")


def _q4_joined(filtered: bool) -> str:
    cond = ("WHERE i.weapon_cd >= 100 AND i.weapon_cd < 200 AND i.lat <> 0 AND i.lon <> 0"
            if filtered else "")
    return (f"SELECT i.lat AS lat1, i.lon AS lon1, s.y AS lat2, s.x AS lon2, s.division "
            f"FROM merged i JOIN stations s ON i.area = s.prec {cond}")


def _q4(filtered: bool) -> str:
    return with_views(["merged", "stations"], """
SELECT division, round(avg(distance), 6) AS average_distance, count(*) AS number_of_incidents
FROM g3 GROUP BY division""", [("j", _q4_joined(filtered))] + geodesic_ctes("j"))


def _q4_rows() -> str:
    return with_views(["merged", "stations"], """
SELECT lat1 AS crime_lat, lon1 AS crime_lon, lat2 AS station_lat, lon2 AS station_lon, division,
       round(distance, 6) AS distance
FROM g3""", [("j", _q4_joined(True))] + geodesic_ctes("j"))


CTES["duties"] = """
SELECT l_orderkey * 10 + l_linenumber AS period_id, CAST(l_suppkey % 27 + 1 AS INTEGER) AS area, l_shipdate - to_hours(l_partkey % 36) AS on_at,
  l_shipdate - to_hours(l_partkey % 36) + to_hours(CAST(l_quantity AS INTEGER)) AS off_at FROM lineitem"""
CTES["readings"] = """
SELECT CAST(l_suppkey % 27 + 1 AS INTEGER) AS area, l_shipdate AS read_at, l_orderkey * 10 + l_linenumber AS reading_id, l_quantity AS level FROM lineitem"""
CTES["visits"] = """
SELECT o_orderkey AS visit_id, CAST(o_custkey % 27 + 1 AS INTEGER) AS area, o_orderdate AS came_at, o_orderdate + to_hours(o_orderkey % 5 + 1) AS left_at FROM orders"""
CTES["revised_raw"] = f"""
SELECT {RAW_COLS.replace('premis_desc', "CASE WHEN CAST(dr_no AS BIGINT) % 10 = 0 THEN 'STREET' ELSE premis_desc END AS premis_desc")}
FROM incidents_b_raw, range(2) AS twice(i) WHERE i = 0 OR CAST(dr_no AS BIGINT) % 31 = 0"""
CTES["arrivals"] = """
SELECT event_type, epoch(date_trunc('second', ts))::BIGINT AS s,
  CAST(floor((epoch(date_trunc('second', ts))::BIGINT + event_id * 7 % 11 * 3600 + CASE WHEN event_id % 50 = 0 THEN 518400 ELSE 0 END - 1704067200) / 518400.0) AS INTEGER) AS delta
FROM events"""
DEPENDS.update({"revised_raw": ["incidents_b_raw"]})


def _nearest(sites: str, k: int, columns: str) -> str:
    # Great-circle distance by the haversine.
    return with_views(["incidents", sites], f"""
, spots AS (SELECT DISTINCT lat, lon FROM incidents WHERE lat <> 0 AND lon <> 0),
sites AS (SELECT DISTINCT * FROM ({columns})),
pairs AS (SELECT p.lat, p.lon, s.key,
    round(2 * 6371.0088 * asin(sqrt(pow(sin(radians(s.y - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(s.y)) * pow(sin(radians(s.x - p.lon) / 2), 2))), 6) AS km
  FROM spots p, sites s),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY km, key) AS nth FROM pairs QUALIFY nth <= {k})""")


def _extended(q: dict[str, str]) -> None:
    q["nearest_stations"] = _nearest("stations", 3, "SELECT prec AS key, y, x FROM stations") + """
SELECT dr_no, CAST(nth AS INTEGER) AS near_rank, key AS prec, km AS near_km FROM incidents JOIN ranked USING (lat, lon)"""
    q["nearest_geocode"] = _nearest("revgeo", 1, "SELECT zip AS key, lat AS y, lon AS x FROM revgeo") + """
SELECT dr_no, key AS zip, km AS near_km FROM incidents JOIN ranked USING (lat, lon)"""
    q["join_interval"] = with_views(["incidents", "duties"], """
SELECT i.dr_no, i.area, d.period_id FROM incidents i JOIN duties d ON i.area = d.area AND d.on_at <= i.date_occ AND i.date_occ < d.off_at""")
    q["join_overlap"] = with_views(["visits", "duties"], """
SELECT v.visit_id, v.area, d.period_id FROM visits v JOIN duties d
ON v.area = d.area AND v.came_at < d.off_at AND d.on_at < v.left_at WHERE d.on_at < d.off_at""")
    q["join_asof"] = with_views(["incidents", "readings"], """
, one AS (SELECT area, read_at, max(reading_id) AS reading_id, arg_max(level, reading_id) AS level FROM readings GROUP BY area, read_at)
SELECT i.dr_no, i.area, i.date_occ, o.read_at, o.reading_id, o.level
FROM incidents i ASOF LEFT JOIN one o ON i.area = o.area AND i.date_occ >= o.read_at""")
    q["gaps_and_islands"] = with_views(["incidents"], """
, steps AS (SELECT area, date_occ, coalesce(date_occ - lag(date_occ) OVER w > to_days(3), true) AS begins
            FROM incidents WHERE date_occ IS NOT NULL AND area IS NOT NULL WINDOW w AS (PARTITION BY area ORDER BY date_occ)),
runs AS (SELECT area, date_occ, CAST(sum(CAST(begins AS INTEGER)) OVER (PARTITION BY area ORDER BY date_occ ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM steps)
SELECT area, island, min(date_occ) AS "start", max(date_occ) AS "end", count(*) AS n FROM runs GROUP BY area, island""")
    q["rollup_months"] = with_views(["incidents"], """
, m AS (SELECT CAST(year(date_occ) AS INTEGER) AS year, CAST(month(date_occ) AS INTEGER) AS month, area, weapon_cd FROM incidents)
SELECT year, month, area, CAST(grouping_id(year, month, area) AS BIGINT) AS grouping_id, count(*) AS "count", CAST(sum(weapon_cd) AS BIGINT) AS total_weapon_cd
FROM m GROUP BY ROLLUP (year, month, area)""")
    q["cube_premises"] = with_views(["incidents"], """
SELECT premis_desc, vict_descent, CAST(grouping_id(premis_desc, vict_descent) AS BIGINT) AS grouping_id, count(*) AS "count"
FROM incidents GROUP BY CUBE (premis_desc, vict_descent)""")
    q["percentile_distance"] = with_views(["merged", "stations"], """
, rounded AS (SELECT division, round(distance, 6) AS distance FROM g3 WHERE distance IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY division ORDER BY distance) AS nth, count(*) OVER (PARTITION BY division) AS n FROM rounded),
shares(share) AS (VALUES (0.5::DOUBLE), (0.95::DOUBLE))
SELECT division, n, share, distance AS percentile FROM numbered, shares WHERE nth = greatest(1, ceil(share * n))""", [("j", _q4_joined(True))] + geodesic_ctes("j"))
    q["sketches_merged"] = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, count(DISTINCT l_partkey) AS n_distinct, true AS distinct_within, true AS median_within
FROM lineitem GROUP BY 1"""
    q["layout_bucketed_join"] = with_views(["incidents"], """
SELECT i.dr_no, i.area, count(*) AS n_items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM incidents i JOIN lineitem ON l_orderkey = i.dr_no GROUP BY i.dr_no, i.area""")
    q["layout_partition_pruned"] = with_views(["incidents", "stations"], """
SELECT s.division, CAST(i.date_occ AS DATE) AS "day", count(*) AS n
FROM incidents i JOIN stations s ON i.area = s.prec WHERE s.division LIKE '%3' GROUP BY 1, 2""")
    q["difference_bag"] = with_views(["incidents_b_raw", "revised_raw"], f"""
SELECT {RAW_COLS}, CAST(sum(d) AS BIGINT) AS "change"
FROM (SELECT {RAW_COLS}, -1 AS d FROM incidents_b_raw UNION ALL SELECT {RAW_COLS}, 1 AS d FROM revised_raw)
GROUP BY ALL HAVING sum(d) <> 0""")
    q["difference_keyed"] = with_views(["incidents_a_raw", "revised_raw"], f"""
, went AS (SELECT {RAW_COLS} FROM incidents_a_raw EXCEPT ALL SELECT {RAW_COLS} FROM revised_raw),
came AS (SELECT {RAW_COLS} FROM revised_raw EXCEPT ALL SELECT {RAW_COLS} FROM incidents_a_raw),
ones AS (SELECT dr_no FROM (SELECT dr_no, 1 AS w, 0 AS c FROM went UNION ALL SELECT dr_no, 0, 1 FROM came) GROUP BY dr_no HAVING sum(w) = 1 AND sum(c) = 1)
SELECT 'delete' AS action, dr_no, premis_desc, date_occ FROM went WHERE dr_no NOT IN (SELECT dr_no FROM ones)
UNION ALL SELECT CASE WHEN dr_no IN (SELECT dr_no FROM ones) THEN 'update' ELSE 'insert' END, dr_no, premis_desc, date_occ FROM came""")
    q["stream_windows"] = with_views(["arrivals"], """
, seen AS (SELECT delta, max(s) AS latest FROM arrivals GROUP BY delta),
marks AS (SELECT d.delta, max(e.latest) - 86400 AS mark FROM seen d LEFT JOIN seen e ON e.delta < d.delta GROUP BY d.delta),
named AS (SELECT event_type, s // 86400 * 86400 AS window_start, coalesce(s // 86400 * 86400 + 86400 <= mark, false) AS late FROM arrivals JOIN marks USING (delta))
SELECT event_type, CAST(window_start AS BIGINT) AS window_start,
  CASE WHEN late THEN 'late' WHEN window_start + 86400 <= (SELECT max(latest) - 86400 FROM seen) THEN 'closed' ELSE 'open' END AS state, count(*) AS n
FROM named GROUP BY ALL""")
    q["stream_dedup"] = q["union_distinct"].replace("SELECT * FROM merged_raw", f"SELECT {RAW_COLS} FROM merged_raw")
    q["incremental_q1"] = q["q1_top_months_df_parquet"]
    q["incremental_q2"] = q["q2_time_of_day_string"]
    q["incremental_q4"] = q["q4_station_distance"]


def _all() -> dict[str, str]:
    q: dict[str, str] = {}
    q["csv_scan_typed"] = with_views(["incidents"], "SELECT * FROM incidents")
    q["csv_scan_reordered"] = with_views(["incidents_a", "incidents_b"], "SELECT * FROM incidents_a UNION ALL SELECT * FROM incidents_b")
    q["csv_to_parquet"] = with_views(["incidents_raw", "stations_raw", "income_raw", "revgeo_raw", "households_raw"], _checksums())
    q["csv_to_parquet_stream"] = with_views(
        ["incidents_a_raw", "incidents_b_raw"],
        "SELECT * FROM incidents_a_raw UNION ALL SELECT * FROM incidents_b_raw")
    q["timestamp_parse"] = with_views(["incidents"], "SELECT dr_no, date_occ FROM incidents")
    q["money_parse"] = with_views(["households"], "SELECT household_id, median_income FROM households")
    q["filter_equals"] = with_views(
        ["incidents"], "SELECT dr_no, time_occ FROM incidents WHERE premis_desc = 'STREET'")
    q["filter_not_null"] = with_views(
        ["incidents"], "SELECT dr_no, vict_descent FROM incidents WHERE vict_descent IS NOT NULL")
    q["filter_like"] = with_views(
        ["households"], f"SELECT household_id, community FROM households WHERE community LIKE {CITY}")
    q["filter_range_nonzero"] = with_views(["incidents"], """
SELECT dr_no, weapon_cd, lat, lon FROM incidents
WHERE weapon_cd >= 100 AND weapon_cd < 200 AND lat <> 0 AND lon <> 0""")
    q["union_all"] = with_views(["incidents_a_raw", "incidents_b_raw"],
                                "SELECT * FROM incidents_a_raw UNION ALL SELECT * FROM incidents_b_raw")
    q["union_distinct"] = with_views(["merged_raw"], "SELECT * FROM merged_raw")
    q["group_count"] = with_views(
        ["incidents"], 'SELECT area, count(*) AS "count" FROM incidents GROUP BY area')
    q["reduce_by_key_sum"] = with_views(
        ["incidents"], "SELECT area, CAST(sum(weapon_cd) AS BIGINT) AS total FROM incidents GROUP BY area")
    q["rank_per_group"] = """
WITH c AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
                  count(*) AS "count"
           FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, CAST(rank() OVER (PARTITION BY year ORDER BY "count" DESC) AS INTEGER) AS "rank" FROM c)
SELECT year, month, "count", "rank" FROM r WHERE "rank" <= 3"""
    q["top_k"] = with_views(["households"], """
SELECT household_id, zip, median_income FROM households WHERE median_income IS NOT NULL
ORDER BY median_income DESC, household_id LIMIT 3""")
    q["bottom_k"] = with_views(["households"], """
SELECT household_id, zip, median_income FROM households WHERE median_income IS NOT NULL
ORDER BY median_income ASC, household_id LIMIT 3""")
    q["decode_codes"] = with_views(["incidents"], f"""
SELECT {descent_case('vict_descent')} AS descent, count(*) AS "count" FROM incidents GROUP BY 1""")
    q["join_composite_key"] = with_views(["incidents", "revgeo"], """
SELECT i.dr_no, g.zip FROM incidents i JOIN revgeo g ON i.lat = g.lat AND i.lon = g.lon""")
    q["join_using"] = with_views(["incidents", "revgeo", "income"], """
, per_zip AS (SELECT g.zip, count(*) AS "count"
              FROM incidents i JOIN revgeo g ON i.lat = g.lat AND i.lon = g.lon GROUP BY g.zip)
SELECT zip, community, "count" FROM per_zip JOIN income USING (zip)""")
    q["join_null_safe"] = with_views(["incidents_a", "incidents_b"], """
, one AS (SELECT dr_no, weapon_cd, max({'t': time_occ, 'a': area}) AS r FROM incidents_b GROUP BY dr_no, weapon_cd)
SELECT a.dr_no, a.weapon_cd, a.premis_desc, b.r.t AS time_occ, b.r.a AS area FROM incidents_a a JOIN one b
ON a.dr_no IS NOT DISTINCT FROM b.dr_no AND a.weapon_cd IS NOT DISTINCT FROM b.weapon_cd""")
    q["join_null_safe_semi"] = with_views(["incidents_a", "incidents_b"], """
SELECT a.dr_no, a.weapon_cd FROM incidents_a a
WHERE EXISTS (SELECT 1 FROM incidents_b b
              WHERE a.dr_no = b.dr_no AND a.weapon_cd IS NOT DISTINCT FROM b.weapon_cd)""")
    for fmt in ("parquet", "csv", "converted"):
        q[f"q1_top_months_df_{fmt}"] = _q1("merged", '"count"')
        if fmt != "converted":
            q[f"q1_top_months_sql_{fmt}"] = _q1("merged", "total_crimes")
    q["q2_time_of_day_string"] = _q2(daypart_text_case("time_occ"))
    q["q2_time_of_day_int"] = _q2(daypart_number_case("time_occ"))
    q["q3_income_top"] = _q3("DESC")
    q["q3_income_bottom"] = _q3("ASC")
    for s in ("broadcast", "merge", "shuffle_hash"):
        q[f"q3_income_top_{s}"] = _q3("DESC")
        q[f"q3_income_bottom_{s}"] = _q3("ASC")
    q["q3_income_extremes"] = _q3_both()
    q["q4_distance_rows"] = _q4_rows()
    q["q4_station_distance"] = _q4(True)
    q["q4_station_distance_unfiltered"] = _q4(False)
    for s in ("broadcast", "repartition", "udf"):
        q[f"q4_station_distance_{s}"] = _q4(True)
    _extended(q)
    return q


ORACLE = _all()


def sql(name: str) -> str:
    return ORACLE[name]
