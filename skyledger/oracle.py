"""DuckDB SQL for every query key, written independently of the Spark jobs."""

from __future__ import annotations

from skyledger.catalog import (
    COUNTRY,
    HEAVY_SHARE,
    MISSING_COUNTRY,
    NAME_PATTERN,
    TAIL,
    YEAR,
)


def _padded(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


def _clock(minutes: str) -> str:
    return (
        f"concat({_padded(f'{minutes} // 60', 2)}, ':', "
        f"{_padded(f'{minutes} % 60', 2)}, ':00')"
    )


def _seconds(time: str) -> str:
    """Seconds of day of well-formed text."""
    return (
        f"((CAST(substr({time}, 1, 2) AS BIGINT) * 3600"
        f" + CAST(substr({time}, 4, 2) AS BIGINT) * 60"
        f" + CAST(substr({time}, 7, 2) AS BIGINT)) % 86400)"
    )


TABLES = f"""
WITH airlines AS (
  SELECT concat('C', {_padded('s_suppkey', 6)}) AS carrier_code,
         s_name AS name, n_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
), aircrafts AS (
  SELECT concat('N', {_padded('p_partkey', 6)}) AS tailnum,
         CASE WHEN p_partkey % 29 = 0 THEN NULL
              WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'CESSNA'
              ELSE upper(p_type) END AS manufacturer,
         CASE WHEN p_partkey % 31 = 0 THEN NULL
              WHEN p_partkey % 37 = 0 THEN 'SKYLANE'
              ELSE concat(CAST(100 + p_size AS VARCHAR),
                          upper(substr(p_name, 1, 1))) END AS model
  FROM part
), planned AS (
  SELECT *,
         (l_orderkey * 7 + l_partkey * 13 + l_linenumber * 101) % 1441 AS sm,
         (l_orderkey + l_partkey * 3 + l_suppkey * 5) % 200 - 60 AS shift
  FROM lineitem
), departed AS (
  SELECT *, CASE WHEN l_partkey % 97 = 0 THEN (sm + 720) % 1440
                 ELSE (sm + shift + 1440) % 1440 END AS am
  FROM planned
), flights AS (
  SELECT l_orderkey * 10 + l_linenumber AS flight_id,
         concat('C', {_padded('l_suppkey', 6)}) AS carrier_code,
         CAST(l_shipdate AS DATE) AS flight_date,
         CASE WHEN l_partkey % 53 = 0 THEN NULL
              ELSE concat('N', {_padded('l_partkey', 6)}) END AS tail_number,
         CASE WHEN sm = 1440 THEN '24:00:00'
              ELSE {_clock('sm')} END AS scheduled_departure_time,
         CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN NULL
              WHEN am = 0 AND l_linenumber % 2 = 1 THEN '24:00:00'
              ELSE {_clock('am')} END AS actual_departure_time
  FROM departed
), flown AS (
  SELECT * FROM flights WHERE actual_departure_time IS NOT NULL
), gaps AS (
  SELECT flight_id, carrier_code, flight_date,
         {_seconds('actual_departure_time')}
         - {_seconds('scheduled_departure_time')} AS gap
  FROM flown
), rollup_rows AS (
  SELECT a.name, a.carrier_code, f.tail_number, a.country,
         CAST(count(*) AS BIGINT) AS legs
  FROM airlines a JOIN flown f ON a.carrier_code = f.carrier_code
  GROUP BY a.name, a.carrier_code, f.tail_number, a.country
), country_legs AS (
  SELECT a.name, a.carrier_code, f.tail_number, CAST(count(*) AS BIGINT) AS legs
  FROM airlines a JOIN flights f ON a.carrier_code = f.carrier_code
  WHERE a.country = '{COUNTRY}'
  GROUP BY a.name, a.carrier_code, f.tail_number
), fleet AS (
  SELECT r.name, p.manufacturer, p.model, CAST(sum(r.legs) AS BIGINT) AS numFlights
  FROM rollup_rows r JOIN aircrafts p ON r.tail_number = p.tailnum
  WHERE r.country = '{COUNTRY}'
    AND p.manufacturer IS NOT NULL AND p.model IS NOT NULL
  GROUP BY r.name, p.manufacturer, p.model
), exact_fleet AS (
  SELECT name, manufacturer, model, numFlights,
         CAST(row_number() OVER (PARTITION BY name
              ORDER BY numFlights DESC, manufacturer, model) AS INTEGER) AS rank
  FROM fleet
)
"""

FIRST_DAY = f"DATE '{YEAR}-01-01'"
LAST_DAY = f"DATE '{YEAR}-12-31'"
IN_YEAR = f"flight_date BETWEEN {FIRST_DAY} AND {LAST_DAY}"


def _model_counts(source: str) -> str:
    return f"""
    SELECT regexp_extract(p.model, '[0-9]{{3}}') AS modelName,
           CAST(sum(c.n) AS BIGINT) AS numFlights
    FROM aircrafts p
    LEFT JOIN (SELECT tail_number, count(*) AS n FROM {source} GROUP BY tail_number) c
           ON p.tailnum = c.tail_number
    WHERE p.manufacturer = 'CESSNA'
    GROUP BY 1
    """


def _top_models(source: str) -> str:
    return f"""
    SELECT modelName, numFlights FROM ({_model_counts(source)})
    WHERE modelName <> ''
    ORDER BY numFlights DESC NULLS LAST, modelName LIMIT 3
    """


def _delay_stats(
    early: str = "gap - 86400",
    airline_filter: str = "TRUE",
    flight_filter: str = "TRUE",
) -> str:
    return f"""
    SELECT a.name, d.numOfDelays, d.avgDelays, d.minDelay, d.maxDelay
    FROM (
      SELECT carrier_code,
             CAST(count(*) AS BIGINT) AS numOfDelays,
             round(CAST(sum(delay) AS DOUBLE) / (count(*) * 60), 2) AS avgDelays,
             CAST(min(delay) AS DOUBLE) / 60 AS minDelay,
             CAST(max(delay) AS DOUBLE) / 60 AS maxDelay
      FROM (
        SELECT carrier_code,
               CASE WHEN gap > 43200 THEN {early}
                    WHEN gap < -43200 THEN gap + 86400
                    ELSE gap END AS delay
        FROM gaps WHERE {IN_YEAR} AND {flight_filter}
      ) WHERE delay > 0
      GROUP BY carrier_code
    ) d JOIN airlines a ON a.carrier_code = d.carrier_code
    WHERE {airline_filter}
    """


def _ranked_fleet(direction: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT name, manufacturer, model, numFlights,
             CAST(rank() OVER (PARTITION BY name ORDER BY numFlights {direction})
                  AS INTEGER) AS rank
      FROM fleet
    ) WHERE rank <= 5
    """


def _nulls(*columns: str) -> str:
    return ", ".join(
        f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in columns
    )


def _duplicates(table: str, key: str) -> str:
    return f"""
    SELECT '{table}' AS "table", CAST(count(*) AS BIGINT) AS duplicates
    FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)
    """


TOP_FLEET = _ranked_fleet("DESC")

BODIES: dict[str, str] = {
    "t1_top_models": _top_models("flights"),
    "t1_top_models_flown": f"""
    SELECT modelName, numFlights FROM ({_model_counts('flown')})
    WHERE modelName <> '' AND numFlights IS NOT NULL
    ORDER BY numFlights DESC, modelName LIMIT 3
    """,
    "t1_model_counts": _model_counts("flights"),
    "t2_delay_stats": _delay_stats(),
    "t2_delay_stats_absolute": _delay_stats(early="86400 - gap"),
    "t2_delay_stats_country": _delay_stats(airline_filter=f"a.country = '{COUNTRY}'"),
    "t2_delay_stats_from_layout": _delay_stats(),
    "t2_delay_stats_from_csv_layout": _delay_stats(),
    "t2_delay_stats_from_csv": _delay_stats(flight_filter="flight_id % 41 <> 0"),
    "t3_top_fleet": TOP_FLEET,
    "t3_top_fleet_exact": "SELECT * FROM exact_fleet WHERE rank <= 5",
    "t3_top_fleet_from_rollup": TOP_FLEET,
    "t3_top_fleet_from_csv_rollup": TOP_FLEET,
    "t3_top_fleet_colocated": TOP_FLEET,
    "t3_least_flown": _ranked_fleet("ASC"),
    "t3_missing_country": f"""
    SELECT CAST(count(*) AS BIGINT) AS n FROM rollup_rows
    WHERE country = '{MISSING_COUNTRY}'
    """,
    "layout_year_carrier": f"""
    SELECT carrier_code, CAST(count(*) AS BIGINT) AS n FROM flights
    WHERE {IN_YEAR} GROUP BY carrier_code
    """,
    "layout_country_rollup": """
    SELECT country, CAST(count(*) AS BIGINT) AS n,
           CAST(sum(legs) AS BIGINT) AS numFlights
    FROM rollup_rows GROUP BY country
    """,
    "layout_country_flights": """
    SELECT a.country, CAST(count(*) AS BIGINT) AS n,
           CAST(count(DISTINCT tail_number) AS BIGINT) AS tails,
           CAST(count(DISTINCT name) AS BIGINT) AS names
    FROM flown f JOIN airlines a ON f.carrier_code = a.carrier_code
    GROUP BY a.country
    """,
    "layout_country_tail": f"""
    SELECT name, tail_number, CAST(count(*) AS BIGINT) AS n
    FROM flown f JOIN airlines a ON f.carrier_code = a.carrier_code
    WHERE country = '{COUNTRY}' GROUP BY name, tail_number
    """,
    "flights_of_tail_from_layout": f"""
    SELECT country, f.carrier_code, CAST(count(*) AS BIGINT) AS n
    FROM flown f JOIN airlines a ON f.carrier_code = a.carrier_code
    WHERE tail_number = '{TAIL}' GROUP BY country, f.carrier_code
    """,
    "layout_incremental": """
    SELECT CAST(year(flight_date) AS INTEGER) AS year, carrier_code,
           CAST(count(*) AS BIGINT) AS n, CAST(sum(flight_id) AS BIGINT) AS ids
    FROM flights GROUP BY 1, 2
    """,
    "layout_rollup_incremental": """
    SELECT country, carrier_code, CAST(count(*) AS BIGINT) AS n,
           CAST(sum(legs) AS BIGINT) AS numFlights
    FROM (
      SELECT a.country, a.carrier_code, f.tail_number, count(*) AS legs
      FROM airlines a JOIN flown f ON a.carrier_code = f.carrier_code
      WHERE NOT (f.flight_id % 10 < 6 AND f.flight_id % 7 = 0)
      GROUP BY a.country, a.carrier_code, f.tail_number
    ) GROUP BY country, carrier_code
    """,
    "layout_file_cap": """
    SELECT TRUE AS within_cap, CAST(count(*) AS BIGINT) AS total FROM rollup_rows
    """,
    "flights_by_year_carrier": """
    SELECT CAST(year(flight_date) AS INTEGER) AS year, carrier_code,
           CAST(count(*) AS BIGINT) AS n
    FROM flights GROUP BY 1, 2
    """,
    "rollup_by_country_carrier": """
    SELECT country, carrier_code, CAST(count(*) AS BIGINT) AS n
    FROM rollup_rows GROUP BY country, carrier_code
    """,
    "flights_in_year_total": f"""
    SELECT CAST(count(*) AS BIGINT) AS total FROM flights WHERE {IN_YEAR}
    """,
    "flights_of_tail": f"""
    SELECT tail_number, CAST(count(*) AS BIGINT) AS n FROM flights
    WHERE tail_number = '{TAIL}' GROUP BY tail_number
    """,
    "flight_id_counts": """
    SELECT flight_id, CAST(count(*) AS BIGINT) AS n FROM flights
    WHERE scheduled_departure_time IS NOT NULL GROUP BY flight_id
    """,
    "aircraft_by_model": """
    SELECT manufacturer, model, CAST(count(*) AS BIGINT) AS n
    FROM aircrafts GROUP BY manufacturer, model
    """,
    "models_per_airline": """
    SELECT name, CAST(count(*) AS BIGINT) AS n FROM fleet GROUP BY name
    """,
    "country_model_counts": """
    SELECT p.model, CAST(sum(l.legs) AS BIGINT) AS numFlights
    FROM country_legs l JOIN aircrafts p ON l.tail_number = p.tailnum
    GROUP BY p.model
    """,
    "country_tail_counts": """
    SELECT name, carrier_code, tail_number, legs AS n FROM country_legs
    """,
    "fleet_right_outer": """
    SELECT p.tailnum, p.manufacturer, p.model, l.name, l.legs AS n
    FROM country_legs l RIGHT JOIN aircrafts p ON l.tail_number = p.tailnum
    """,
    "fleet_usage": """
    SELECT f.tail_number, CAST(count(*) AS BIGINT) AS n
    FROM aircrafts p LEFT JOIN flights f ON p.tailnum = f.tail_number
    GROUP BY f.tail_number
    """,
    "fleet_with_unknown": """
    SELECT p.manufacturer, p.model, l.name, CAST(sum(l.legs) AS BIGINT) AS numFlights
    FROM country_legs l LEFT JOIN aircrafts p ON l.tail_number = p.tailnum
    GROUP BY p.manufacturer, p.model, l.name
    """,
    "airline_name_search": f"""
    SELECT carrier_code, name FROM airlines
    WHERE country = '{COUNTRY}' AND name LIKE '{NAME_PATTERN}'
    """,
    "distinct_countries": """
    SELECT CAST((SELECT count(*) FROM (SELECT DISTINCT country FROM airlines))
                AS BIGINT) AS countries,
           CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM airlines))
                AS BIGINT) AS airlines
    """,
    "schema_drift": f"""
    SELECT CAST(count(*) AS BIGINT) AS missing FROM (
      SELECT flight_id FROM flights
      WHERE flight_id % 41 = 0 AND concat(strftime(flight_date, '%Y-%m-%d'), '?')
            BETWEEN '{YEAR}-01-01' AND '{YEAR}-12-31'
      EXCEPT
      SELECT flight_id FROM flights WHERE flight_id % 41 <> 0 AND {IN_YEAR}
    )
    """,
    "compare_reads": """
    SELECT kind, "column", CAST(sum(n) AS BIGINT) AS n FROM (
      WITH sides AS (
        SELECT flight_id,
               CASE WHEN flight_id % 41 = 0
                    THEN concat(strftime(flight_date, '%Y-%m-%d'), '?')
                    ELSE strftime(flight_date, '%Y-%m-%d') END AS d,
               tail_number AS t, actual_departure_time AS a, 1 AS l, 0 AS r
        FROM flights WHERE flight_id % 61 <> 0
        UNION ALL
        SELECT flight_id,
               CASE WHEN flight_id % 41 <> 0 THEN strftime(flight_date, '%Y-%m-%d') END,
               tail_number, actual_departure_time, 0, 1
        FROM flights WHERE flight_id % 59 <> 0
      ), rest AS (
        SELECT flight_id, d, t, a, greatest(sum(l) - sum(r), 0) AS l,
               greatest(sum(r) - sum(l), 0) AS r
        FROM sides GROUP BY flight_id, d, t, a HAVING sum(l) <> sum(r)
      ), per_key AS (
        SELECT flight_id, sum(l) AS l, sum(r) AS r FROM rest GROUP BY flight_id
      ), cells AS (
        SELECT flight_id, 'flight_date' AS "column", d AS v, l, r FROM rest
        UNION ALL SELECT flight_id, 'tail_number', t, l, r FROM rest
        UNION ALL SELECT flight_id, 'actual_departure_time', a, l, r FROM rest
      ), per_value AS (
        SELECT flight_id, "column", v, sum(l) AS l, sum(r) AS r
        FROM cells GROUP BY flight_id, "column", v
      )
      SELECT 'only left' AS kind, NULL AS "column", l - r AS n FROM per_key WHERE l > r
      UNION ALL SELECT 'only right', NULL, r - l FROM per_key WHERE r > l
      UNION ALL
      SELECT 'differs', "column", least(sum(l), sum(r)) - sum(least(l, r))
      FROM per_value GROUP BY flight_id, "column"
    ) WHERE n > 0 GROUP BY kind, "column"
    """,
    "profile_heavy_tails": f"""
    SELECT tail_number, CAST(count(*) AS BIGINT) AS n FROM flights
    GROUP BY tail_number
    HAVING count(*) > {HEAVY_SHARE} * (SELECT count(*) FROM flights)
    """,
    "profile_lost_to_typing": """
    SELECT CAST(0 AS BIGINT) AS flight_id,
           CAST(count(*) FILTER (flight_id % 41 = 0) AS BIGINT) AS flight_date,
           CAST(0 AS BIGINT) AS distance
    FROM flights
    """,
    "profile_null_counts": f"""
    SELECT {_nulls('flight_id', 'carrier_code', 'flight_date', 'tail_number',
                   'scheduled_departure_time', 'actual_departure_time')}
    FROM flights
    """,
    "profile_cancelled": """
    SELECT CAST(count(*) - count(actual_departure_time) AS BIGINT) AS cancelled,
           CAST(count(*) AS BIGINT) AS total
    FROM flights
    """,
    "profile_duplicate_keys": " UNION ALL ".join(
        (
            _duplicates("airlines", "carrier_code"),
            _duplicates("aircrafts", "tailnum"),
            _duplicates("flights", "flight_id"),
        )
    ),
    "profile_early_departures": """
    SELECT carrier_code, CAST(count(*) AS BIGINT) AS n FROM gaps
    WHERE gap < 0 GROUP BY carrier_code
    """,
    "profile_extreme_delays": """
    SELECT flight_id, CAST(gap AS DOUBLE) / 60 AS minutes FROM gaps
    WHERE gap < -600 * 60
    """,
    "profile_join_coverage": """
    SELECT CAST(count(*) AS BIGINT) AS n
    FROM flights f JOIN aircrafts p ON f.tail_number = p.tailnum
    WHERE p.manufacturer IS NOT NULL AND p.model IS NOT NULL
    """,
    "profile_midnight_24": """
    SELECT flight_id, scheduled_departure_time AS scheduled,
           actual_departure_time AS actual
    FROM flights
    WHERE scheduled_departure_time = '24:00:00' OR actual_departure_time = '24:00:00'
    """,
    "src_csv_roundtrip": """
    SELECT tailnum, CAST(NULL AS VARCHAR) AS type, manufacturer,
           CAST(NULL AS VARCHAR) AS issue_date, model,
           CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS aircraft_type,
           CAST(NULL AS VARCHAR) AS engine_type, CAST(NULL AS VARCHAR) AS year
    FROM aircrafts
    """,
    "src_csv_headerless": "SELECT carrier_code, name, country FROM airlines",
    "src_uri_path": "SELECT tailnum, manufacturer, model FROM aircrafts",
    "src_csv_ragged": "SELECT tailnum, manufacturer, model FROM aircrafts",
    "src_csv_quarantine": """
    SELECT CASE WHEN flight_id % 43 = 0 THEN 'fields missing'
                WHEN flight_id % 47 = 0 THEN 'fields surplus'
                WHEN flight_id % 53 = 0 THEN 'open quote'
                WHEN flight_id % 41 = 0 THEN 'value of flight_date'
                ELSE 'accepted' END AS reason,
           CAST(count(*) AS BIGINT) AS n, CAST(sum(flight_id) AS BIGINT) AS ids
    FROM flights GROUP BY 1
    """,
    "src_csv_mixed_headers": """
    SELECT flight_id, carrier_code,
           CASE WHEN flight_id % 4 <> 3 THEN CAST(flight_id % 1000 AS VARCHAR) END
             AS flight_number,
           CASE WHEN flight_id % 41 <> 0 THEN strftime(flight_date, '%Y-%m-%d') END
             AS flight_date,
           tail_number, scheduled_departure_time, actual_departure_time
    FROM flights
    """,
    "report_model_lines": f"""
    SELECT concat('Cessna ', modelName, ' \t ', CAST(numFlights AS VARCHAR)) AS line
    FROM ({_top_models('flights')})
    """,
    "report_delay_lines": f"""
    SELECT concat_ws(' \t ', name, CAST(numOfDelays AS VARCHAR),
                     CAST(avgDelays AS VARCHAR), CAST(minDelay AS VARCHAR),
                     CAST(maxDelay AS VARCHAR)) AS line
    FROM ({_delay_stats()})
    """,
    "report_fleet_lines": """
    SELECT concat(name, ' \t [',
                  string_agg(concat(manufacturer, ' ', model), ', ' ORDER BY rank),
                  ']') AS line
    FROM exact_fleet WHERE rank <= 5 GROUP BY name
    """,
    "report_fleet_lines_ties": f"""
    SELECT concat_ws(' \t ', name, CAST(rank AS VARCHAR),
                     concat(manufacturer, ' ', model)) AS line
    FROM ({TOP_FLEET})
    """,
}

ORACLE_SQL: dict[str, str] = {key: TABLES + body for key, body in BODIES.items()}
