"""The same results in plain SQL over the given tables, written without the library's help."""

from __future__ import annotations

EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE user_id % 3 WHEN 0 THEN 'Hanoi' WHEN 1 THEN 'Ap Ba' ELSE 'Ho Chi Minh City' END AS city
  FROM events
)"""

TRAFFIC = """
traffic AS (
  SELECT CAST(event_id AS VARCHAR) AS _id, city, k % 12 AS "iconCategory", k % 5 AS "magnitudeOfDelay",
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "startTime",
         strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS "endTime",
         value AS length, k * 10 AS delay,
         CASE WHEN event_id % 3 > 0 THEN CAST(100 + event_id % 7 AS INTEGER) END AS event_code,
         CASE WHEN event_id % 3 > 0 THEN 'event ' || CAST(100 + event_id % 7 AS VARCHAR) END AS event_desc,
         CAST(event_id % 3 AS INTEGER) AS n_events, ts
  FROM ev WHERE event_type = 'click'
)"""

WEATHER = """
weather AS (
  SELECT city, CAST(105 + user_id % 3 AS DOUBLE) AS longitude, CAST(10 + user_id % 3 AS DOUBLE) AS latitude,
         CASE k % 3 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' ELSE 'Rain' END AS weather_main,
         CASE k % 5 WHEN 0 THEN 'clear sky' WHEN 1 THEN 'few clouds' WHEN 2 THEN 'mist'
                    WHEN 3 THEN 'light rain' ELSE 'heavy rain' END AS weather_desc,
         CAST(280 + k % 30 AS DOUBLE) AS temperature, CAST(279 + k % 30 AS DOUBLE) AS feels_like,
         1000 + k % 20 AS pressure, k AS humidity, value / 10 AS wind_speed, k * 3 % 360 AS wind_deg,
         100 - k AS cloudiness, 10000 - k * 10 AS visibility, ts, k
  FROM ev WHERE event_type = 'error'
)"""

AIR = """
air AS (
  SELECT city, CAST(k % 12 AS DOUBLE) AS uv, value * 10 AS co, CAST(k AS DOUBLE) AS o3, value / 5 AS so2,
         CAST(nullif(k % 7, 0) AS DOUBLE) AS pm2_5, value AS pm10, k % 6 + 1 AS "us-epa-index",
         k % 10 + 1 AS "gb-defra-index", ts
  FROM ev WHERE event_type = 'purchase'
)"""

DATE, TIME = "strftime(ts, '%Y-%m-%d') AS date", "strftime(ts, '%H:%M:%S') AS time"
SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

TRAFFIC_COLUMNS = '_id, city, "iconCategory", "magnitudeOfDelay", length, delay, event_code, event_desc'
WEATHER_COLUMNS = (
    "city, longitude, latitude, weather_main, weather_desc, temperature, feels_like, pressure, humidity, "
    "wind_speed, wind_deg, cloudiness, visibility"
)
AIR_COLUMNS = 'city, uv, co, o3, so2, pm2_5, pm10, "us-epa-index", "gb-defra-index"'

CLEAN = f"""
traffic_clean AS (SELECT DISTINCT {TRAFFIC_COLUMNS}, {DATE}, {TIME} FROM traffic WHERE event_code IS NOT NULL),
weather_clean AS (SELECT DISTINCT {WEATHER_COLUMNS}, {DATE}, {TIME} FROM weather),
air_clean AS (SELECT DISTINCT {AIR_COLUMNS}, {DATE}, {TIME} FROM air WHERE pm2_5 IS NOT NULL)"""


def _keyed(topic: str, minutes: int) -> str:
    return f"""
{topic}_keyed AS (
  SELECT * EXCLUDE (time, of_day)
         REPLACE (CASE city WHEN 'Ap Ba' THEN 'da nang' WHEN 'Hanoi' THEN 'ha noi' ELSE lower(city) END AS city),
         CAST((of_day - of_day % {minutes}) // 60 AS INTEGER) AS hour,
         CAST((of_day - of_day % {minutes}) % 60 AS INTEGER) AS minute
  FROM (SELECT *, CAST(substr(time, 1, 2) AS INTEGER) * 60 + CAST(substr(time, 4, 2) AS INTEGER) AS of_day
        FROM {topic}_clean)
)"""


BOXES = """
boxes(city, min_lon, min_lat, max_lon, max_lat) AS (VALUES
  ('Ho Chi Minh City', 106.532129::DOUBLE, 10.66594::DOUBLE, 106.831575::DOUBLE, 10.883411::DOUBLE),
  ('Hanoi', 105.2849::DOUBLE, 20.5645::DOUBLE, 106.0201::DOUBLE, 21.3853::DOUBLE),
  ('Da Nang', 107.818782::DOUBLE, 15.917955::DOUBLE, 108.574858::DOUBLE, 16.344307::DOUBLE))"""

FEEDS = f"WITH {EV},{TRAFFIC},{WEATHER},{AIR}"


def aligned(minutes: int) -> str:
    return f"""{FEEDS},{CLEAN},{_keyed('traffic', minutes)},{_keyed('weather', minutes)},{_keyed('air', minutes)}
SELECT * FROM traffic_keyed JOIN weather_keyed USING (date, city, hour, minute)
                            JOIN air_keyed USING (date, city, hour, minute)"""


LATEST = """
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY _id ORDER BY report_time DESC, event_id DESC) AS place
  FROM (SELECT user_id AS _id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS report_time, event_id, event_type, value FROM events)
) WHERE place = 1"""

GAPPY = "(SELECT * REPLACE (nullif(l_discount, 0) AS l_discount) FROM lineitem)"

LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINEITEM_TYPES = {
    **dict.fromkeys(("l_orderkey", "l_partkey", "l_suppkey"), "bigint"), "l_linenumber": "int",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
LINEITEM_TEXT = {"l_returnflag", "l_linestatus", "l_shipdate"}


def _per_column(columns, row) -> str:
    return "\nUNION ALL ".join(row(c) for c in columns)


def _zeros(c: str) -> str:
    if c in LINEITEM_TEXT:
        return f"SELECT '{c}' AS \"column\", CAST(0 AS BIGINT) AS zero_count, CAST(0 AS DOUBLE) AS zero_percentage FROM (SELECT count(*) FROM lineitem)"
    return (
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} = 0) AS zero_count, "
        f"round_even(count(*) FILTER (WHERE {c} = 0)::DOUBLE / count({c}) * 100 * 100, 0) / 100 AS zero_percentage FROM {GAPPY}"
    )


WEIGHTED = "(SELECT *, l_extendedprice * l_quantity AS weight, l_extendedprice * l_quantity AS unit_price_sq FROM lineitem)"


def _outliers(c: str) -> str:
    return f"""SELECT '{c}' AS "column",
       count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS num_outliers,
       round_even(count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1))::DOUBLE / count(*) * 100 * 100, 0)
         / 100 AS percentage
FROM (SELECT {c} AS x FROM {WEIGHTED}),
     (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {WEIGHTED})"""


def _box(c: str) -> str:
    low, high = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
    return f"""SELECT '{c}' AS "column", round(any_value(q1), 2) AS q1, round(any_value(q2), 2) AS median,
       round(any_value(q3), 2) AS q3,
       round(min(x) FILTER (WHERE x >= {low} AND x <= {high}), 2) AS whisker_low,
       round(max(x) FILTER (WHERE x >= {low} AND x <= {high}), 2) AS whisker_high,
       count(*) FILTER (WHERE x < {low} OR x > {high}) AS fliers
FROM (SELECT {c} AS x FROM {WEIGHTED}),
     (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {WEIGHTED})"""


def _histogram(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS "column", CAST(b AS INTEGER) AS bin, round(lo + b * w, 4) AS bin_low,
       round(lo + (b + 1) * w, 4) AS bin_high, count(x) AS count
FROM range(20) t(b), (SELECT min({name}) AS lo, (max({name}) - min({name})) / 20 AS w FROM {source}) s
LEFT JOIN (SELECT {name} AS x FROM {source}) v ON CAST(least(floor((x - lo) / w), 19) AS INTEGER) = b
GROUP BY b, lo, w"""


def _kde(name: str, weighted: str, source: str) -> str:
    """``weighted`` gives rows (x, n) from ``source`` and the statistics ``s``."""
    return f"""
WITH s AS (SELECT count(*) AS total, min({name}) AS lo, max({name}) AS hi,
                  stddev_samp({name}) * power(count(*), -0.2) AS h FROM {source}),
grid AS (SELECT CAST(i AS INTEGER) AS point, lo + i * ((hi - lo) / 199) AS g FROM s, range(200) t(i)),
v AS ({weighted})
SELECT '{name}' AS "column", point, round(g, 4) AS x,
       round(sum(n * exp(-0.5 * ((g - v.x) / h) * ((g - v.x) / h))) / any_value(total * h * sqrt(2 * pi())), 10) AS density,
       round(sum(n * exp(-0.5 * ((g - v.x) / h) * ((g - v.x) / h))) / any_value(total * h * sqrt(2 * pi()))
             * any_value(total * (hi - lo) / 20), 4) AS height
FROM grid, v, s GROUP BY point, g"""


LABELLED = """
labelled AS (
  SELECT *, strftime(o_orderdate, '%a') AS weekday,
         CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS target
  FROM orders
),
grouped AS (
  SELECT 'o_orderstatus' AS feature, o_orderstatus AS level, count(*) AS n, avg(target) AS mean,
         coalesce(var_samp(target), 0) AS variance FROM labelled GROUP BY o_orderstatus
  UNION ALL
  SELECT 'weekday', weekday, count(*), avg(target), coalesce(var_samp(target), 0) FROM labelled GROUP BY weekday
)"""

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CENTRES = [[-1.0, -0.8, 0.3, 0.1], [0.1, 0.0, -0.6, 0.7], [1.1, 1.2, 0.2, -0.4]]


def _distance(centre) -> str:
    return " + ".join(f"(z{i} - {c}::DOUBLE) * (z{i} - {c}::DOUBLE)" for i, c in enumerate(centre))


SCORES = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z{i}" for i, c in enumerate(MEASURES))

GAPPY_PART = """(SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS p_size,
                        CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice END AS p_retailprice FROM part)"""


def _robust(c: str, source: str) -> str:
    return (
        f"({c} - (SELECT quantile_cont({c}, 0.5) FROM {source})) / "
        f"(SELECT coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) FROM {source})"
    )


STATS = [
    ("humidity", 50.5, 28.7), ("pressure", 1009.4, 5.8), ("temperature", 294.6, 8.7), ("wind_speed", 5.1, 2.9),
    ("magnitudeOfDelay", 2.1, 1.4), ("pm10", 50.3, 28.9), ("pm2_5", 3.4, 1.7), ("co", 503.0, 289.0), ("so2", 10.1, 5.8), ("o3", 49.7, 28.8),
]
LEVEL_CENTRES = {
    "High": [0.11, -0.23, 0.31, 0.07, 0.43, 0.83, 0.37, 0.79, 0.81, 0.29],
    "Moderate": [-0.17, 0.41, -0.13, 0.57, -0.61, -0.47, 0.53, -0.43, -0.51, 0.67],
    "Low": [0.19, -0.37, -0.29, -0.71, 0.23, -0.59, -0.83, -0.61, -0.53, -0.89],
}


def _away(centre) -> str:
    return " + ".join(f"power((\"{c}\" - {m}::DOUBLE) / {d}::DOUBLE - {x}::DOUBLE, 2)" for (c, m, d), x in zip(STATS, centre))


COMBINED = f"""aligned AS ({{aligned}}),
far AS (SELECT DISTINCT *, {", ".join(f"{_away(c)} AS d{i}" for i, c in enumerate(LEVEL_CENTRES.values()))} FROM aligned),
combined AS (SELECT * EXCLUDE (d0, d1, d2),
  CASE WHEN d0 <= d1 AND d0 <= d2 THEN 'High' WHEN d1 <= d2 THEN 'Moderate' ELSE 'Low' END AS pollution_level FROM far)""".format(aligned=aligned(60))
ROW_KEY = "_id, date, city, hour, minute"
TRAINING = f"""WITH {COMBINED}
SELECT CASE WHEN CAST('0x' || substr(md5(_id), 1, 4) AS INTEGER) % 10 < 8 THEN 'train' ELSE 'test' END AS dataset,
       pollution_level, count(*) AS rows, true AS sound FROM combined GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "scan_topic": f"""{FEEDS} SELECT _id, city, delay, strftime(ts, '%Y') AS partition_0, strftime(ts, '%m') AS partition_1,
        strftime(ts, '%d') AS partition_2, printf('%02d', hour(ts) // 6 * 6) AS partition_3 FROM traffic""",
    "collection_scan": f"WITH {EV} SELECT CAST(event_id AS VARCHAR) AS _id, city, value FROM ev",
    "concat_json": f"""WITH {EV}
SELECT event_id, k, value, mode, CASE event_id % 7 WHEN 0 THEN 'plain' WHEN 1 THEN 'a }} {{ b' WHEN 2 THEN '}}' WHEN 3 THEN '{{'
  WHEN 4 THEN 'say "}}{{" \\' WHEN 5 THEN '{{}}}}{{{{' ELSE 'tail \\\\' END AS note
FROM ev, (VALUES ('files'), ('cut')) m(mode)
UNION ALL SELECT 0, NULL, NULL, mode, 'rejects' FROM (VALUES ('files'), ('cut')) m(mode)""",
    "topic_rejects": f"""{FEEDS} SELECT mode, _id,
  CASE WHEN CAST(_id AS BIGINT) % 10 = 0 OR CAST(_id AS BIGINT) % 15 = 1 THEN 'bad' ELSE 'good' END AS state
FROM traffic, (VALUES ('batch'), ('stream')) m(mode)""",
    "explode_incidents": f"{FEEDS} SELECT _id, city, delay, CAST(floor(CAST(_id AS BIGINT) / 50) AS BIGINT) AS poll FROM traffic",
    "flatten_air": f"{FEEDS} SELECT {AIR_COLUMNS}, {SECOND} AS report_time FROM air",
    "flatten_traffic": f"""{FEEDS} SELECT * EXCLUDE (ts, n_events) REPLACE (CAST(event_code AS DOUBLE) AS event_code) FROM traffic""",
    "first_event": f"{FEEDS} SELECT _id, n_events, CAST(event_code AS DOUBLE) AS event_code, event_desc FROM traffic",
    "flatten_weather": f"""{FEEDS} SELECT {WEATHER_COLUMNS}, 'VN' AS country,
        strftime(to_timestamp(1704067200 + k * 60) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS sunrise,
        strftime(to_timestamp(1704110400 + k * 60) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS sunset,
        {SECOND} AS report_time FROM weather""",
    "drop_columns": f"{FEEDS} SELECT {WEATHER_COLUMNS}, {SECOND} AS report_time FROM weather",
    "stamp_records": f"{FEEDS} SELECT _id, 'Da Nang' AS city, '2024-02-01 08:30:00' AS report_time FROM traffic",
    "columns_by_type": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer",
    "head_n": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
    "dropna_any": f"""SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_returnflag FROM {GAPPY} WHERE l_discount IS NOT NULL""",
    "dedupe_rows": "SELECT DISTINCT text, lang FROM documents",
    "category_filter": f"""{FEEDS} SELECT _id, city, "iconCategory" FROM traffic WHERE "iconCategory" IN (1, 2, 4, 6, 8, 9, 10, 11)""",
    "bbox_assign": f"""{FEEDS},{BOXES},
points AS (
  SELECT _id, CASE WHEN CAST(_id AS BIGINT) % 7 = 0 THEN -10::DOUBLE WHEN city = 'Hanoi' THEN 105.65::DOUBLE
                   WHEN city = 'Ap Ba' THEN 108.2::DOUBLE ELSE 106.68::DOUBLE END AS lon,
         CASE city WHEN 'Hanoi' THEN 20.97::DOUBLE WHEN 'Ap Ba' THEN 16.13::DOUBLE ELSE 10.77::DOUBLE END AS lat
  FROM traffic)
SELECT _id, lon, lat, city FROM points JOIN boxes ON lon BETWEEN min_lon AND max_lon AND lat BETWEEN min_lat AND max_lat""",
    # Every segment against every box: the parts on which it is between the box's sides, axis by axis.
    "lines_in_boxes": f"""WITH {EV},{BOXES},
centres AS (
  SELECT event_id, event_id % 6 AS kind, CASE city WHEN 'Hanoi' THEN 105.65::DOUBLE WHEN 'Ap Ba' THEN 108.2::DOUBLE ELSE 106.68::DOUBLE END AS x,
         CASE city WHEN 'Hanoi' THEN 20.97::DOUBLE WHEN 'Ap Ba' THEN 16.13::DOUBLE ELSE 10.77::DOUBLE END AS y,
         (k % 9 - 4) / 8.0::DOUBLE AS k9, (k % 17 - 8) / 8.0::DOUBLE AS k17,
         (event_id % 5 - 2) / 8.0::DOUBLE AS n5, (event_id % 17 - 8) / 8.0::DOUBLE AS n17
  FROM ev WHERE event_type = 'click'),
parts AS (
  SELECT event_id, x + k9 AS x0, y + n5 AS y0, x + k9 AS x1, y + n5 AS y1 FROM centres WHERE kind IN (0, 3)
  UNION ALL SELECT event_id, x - 2, y + k17, x + 2, y + n17 FROM centres WHERE kind = 1
  UNION ALL SELECT event_id, x + 2, y + n17, x + 2, y + 3 FROM centres WHERE kind = 1
  UNION ALL SELECT event_id, x - 2, y - 2, x + 2, y + 2 FROM centres WHERE kind = 2
  UNION ALL SELECT event_id, x + k9, y - 3, x + k9, y + 3 FROM centres WHERE kind = 2),
shares AS (
  SELECT event_id, city, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS length,
         CASE WHEN x1 <> x0 THEN least((min_lon - x0) / (x1 - x0), (max_lon - x0) / (x1 - x0))
              WHEN x0 BETWEEN min_lon AND max_lon THEN 0 ELSE 9 END AS in_x,
         CASE WHEN x1 <> x0 THEN greatest((min_lon - x0) / (x1 - x0), (max_lon - x0) / (x1 - x0)) ELSE 1 END AS out_x,
         CASE WHEN y1 <> y0 THEN least((min_lat - y0) / (y1 - y0), (max_lat - y0) / (y1 - y0))
              WHEN y0 BETWEEN min_lat AND max_lat THEN 0 ELSE 9 END AS in_y,
         CASE WHEN y1 <> y0 THEN greatest((min_lat - y0) / (y1 - y0), (max_lat - y0) / (y1 - y0)) ELSE 1 END AS out_y
  FROM parts, boxes)
SELECT event_id, city, count(*) AS segments, round(sum((least(1, out_x, out_y) - greatest(0, in_x, in_y)) * length), 6) AS inside
FROM shares WHERE greatest(0, in_x, in_y) <= least(1, out_x, out_y) GROUP BY event_id, city""",
    "valid_records": """
SELECT event_id, CASE WHEN json_valid(t) THEN CAST(json_extract_string(t, '$.k') AS DOUBLE) END AS k,
       CASE WHEN json_valid(t) THEN 'good' ELSE 'bad' END AS state
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS t FROM events)""",
    "latest_per_key": LATEST.format(columns="_id, report_time, event_id, event_type, value"),
    "normalise_city": f"""WITH {EV} SELECT event_id,
        CASE city WHEN 'Ap Ba' THEN 'da nang' WHEN 'Hanoi' THEN 'ha noi' ELSE lower(city) END AS city FROM ev""",
    "split_report_time": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
        CASE WHEN event_id % 3 = 0 AND strftime(ts, '%f') <> '000000' THEN strftime(ts, '%H:%M:%S.%f')
             ELSE strftime(ts, '%H:%M:%S') END AS time FROM events""",
    "hour_minute": "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute FROM events",
    "iso_to_naive": """SELECT event_id, strftime(CASE WHEN event_id % 2 = 0 THEN ts ELSE ts - INTERVAL 7 HOUR END,
        '%Y-%m-%d %H:%M:%S') AS report_time FROM events""",
    "epoch_to_ts": """SELECT o_orderkey, strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS at
        FROM orders""",
    "resolve_choice": f"""WITH {EV} SELECT event_id, CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN CAST(k AS DOUBLE)
        WHEN 2 THEN value END AS length FROM ev""",
    "variant_choice": f"""WITH {EV} SELECT event_id,
  CASE WHEN event_id % 10 = 9 THEN 'missing' ELSE ['double', 'int', 'string', 'string', 'null', 'missing'][event_id % 6 + 1] END AS kind,
  CASE WHEN event_id % 10 = 9 THEN NULL WHEN event_id % 6 IN (0, 2) THEN value WHEN event_id % 6 = 1 THEN CAST(k AS DOUBLE) END AS length
FROM ev""",
    "variant_fields": """WITH sent AS (SELECT event_id % 6 AS kind FROM events WHERE event_id % 10 <> 9),
kinds AS (
  SELECT f.path, 'int' AS kind, count(*) AS rows FROM sent, (VALUES ('id'), ('properties.k')) f(path) GROUP BY f.path
  UNION ALL SELECT 'properties.length', ['double', 'int', 'string', 'string', 'null'][kind + 1] AS name, count(*) FROM sent WHERE kind < 5 GROUP BY name)
SELECT *, CASE path WHEN 'properties.length' THEN (
  SELECT string_agg(kind, ',' ORDER BY kind) FROM kinds WHERE path = 'properties.length' AND kind <> 'null' HAVING count(*) > 1) END AS choice
FROM kinds""",
    "map_labels": """SELECT vec_id, CASE label % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'Low' END AS level
        FROM embeddings""",
    "to_json_record": f"WITH {EV} SELECT event_id, city, value FROM ev",
    "json_roundtrip": f"{FEEDS},{CLEAN} SELECT * FROM air_clean",
    "clean_air": f"{FEEDS},{CLEAN} SELECT * FROM air_clean",
    "clean_traffic": f"{FEEDS},{CLEAN} SELECT * FROM traffic_clean",
    "clean_weather": f"{FEEDS},{CLEAN} SELECT * FROM weather_clean",
    "align_topics": aligned(60),
    "unmatched_cities": f"""{FEEDS},
named AS (SELECT DISTINCT CASE city WHEN 'Ap Ba' THEN 'da nang' WHEN 'Hanoi' THEN 'ha noi' ELSE lower(city) END AS city, topic
  FROM (SELECT city, 0 AS topic FROM traffic UNION ALL SELECT city, 1 FROM weather
        UNION ALL SELECT CASE city WHEN 'Ap Ba' THEN 'Ap Bac' ELSE city END, 2 FROM air))
SELECT city, count(*) AS topics FROM named GROUP BY city HAVING count(*) < 3""",
    "profile_shape": f"SELECT count(*) AS n_rows, CAST({len(LINEITEM)} AS BIGINT) AS n_columns FROM lineitem",
    "profile_duplicates": """SELECT CAST((SELECT count(*) FROM documents)
        - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS BIGINT) AS duplicates""",
    "profile_nulls": _per_column(
        LINEITEM, lambda c: f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {GAPPY}"
    ),
    "profile_info": _per_column(
        LINEITEM, lambda c: f"SELECT '{c}' AS \"column\", count({c}) AS non_null, '{LINEITEM_TYPES.get(c, 'double')}' AS dtype FROM {GAPPY}"
    ),
    "profile_zeros": _per_column(LINEITEM, _zeros),
    "profile_outliers": _per_column(["l_quantity", "l_extendedprice", "l_discount", "l_tax", "unit_price_sq"], _outliers),
    "kept_profiles": f"""WITH {EV},
cells AS (
  SELECT event_type AS topic, 'value' AS "column", CASE WHEN event_id % 11 > 0 THEN value END AS x FROM ev
  UNION ALL SELECT event_type, 'k', CAST(k AS DOUBLE) FROM ev)
SELECT topic, "column", count(*) AS rows, count(*) - count(x) AS missing, count(*) FILTER (x = 0) AS zeros, min(x) AS low, max(x) AS high,
       true AS q1_close, true AS median_close, true AS q3_close
FROM cells GROUP BY topic, "column" """,
    "iqr_outliers": f"""SELECT l_orderkey, l_linenumber, l_partkey, round(weight, 2) AS weight FROM {WEIGHTED},
        (SELECT quantile_cont(weight, 0.25) AS q1, quantile_cont(weight, 0.75) AS q3 FROM {WEIGHTED})
        WHERE weight < q1 - 1.5 * (q3 - q1) OR weight > q3 + 1.5 * (q3 - q1)""",
    "histogram20": _per_column(["l_quantity", "l_extendedprice"], lambda c: _histogram(c, "lineitem")),
    "histogram_scaled": f"""WITH scaled AS (SELECT {_robust('c_acctbal', 'customer')} AS c_acctbal FROM customer)
        {_histogram('c_acctbal', 'scaled')}""",
    "kde_curve": _kde("c_acctbal", "SELECT c_acctbal AS x, 1 AS n FROM customer", "customer"),
    "kde_binned": _kde(
        "l_extendedprice",
        """SELECT (lo + bin * w + (lo + (bin + 1) * w)) / 2 AS x, count(*) AS n FROM (
             SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 2000)), 1999) AS INTEGER) AS bin, lo,
                    (hi - lo) / 2000 AS w FROM lineitem, s) GROUP BY bin, lo, w""",
        "lineitem",
    ),
    "boxplot_stats": _per_column(["l_quantity", "l_extendedprice", "weight"], _box),
    "dq_rules": f"""
SELECT 'ColumnCount > 0' AS rule, 'Passed' AS outcome, CAST({len(LINEITEM)} AS DOUBLE) AS actual FROM (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'RowCount > 0', CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END, CAST(count(*) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'Completeness `l_discount` >= 0.95',
  CASE WHEN count(l_discount)::DOUBLE / count(*) >= 0.95 THEN 'Passed' ELSE 'Failed' END,
  round(count(l_discount)::DOUBLE / count(*), 4) FROM {GAPPY}""",
    "group_moments": f"""WITH {LABELLED} SELECT feature, level, n, round(mean, 4) AS mean, round(variance, 4) AS variance FROM grouped""",
    # Both features have an odd number of levels, so the tail of F has a closed form.
    "anova_f": f"""WITH {LABELLED},
overall AS (SELECT feature, count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * mean) / sum(n) AS grand FROM grouped GROUP BY feature),
tested AS (
  SELECT feature, k, o.n AS n,
         (sum(g.n * (mean - grand) * (mean - grand)) / (k - 1)) / (sum((g.n - 1) * variance) / (o.n - k)) AS f
  FROM grouped g JOIN overall o USING (feature) GROUP BY feature, k, o.n, grand),
tail AS (
  SELECT *, (n - k) / 2.0::DOUBLE AS b, (n - k) / ((n - k) + (k - 1) * f) AS x FROM tested),
valued AS (
  SELECT *, power(x, b) * CASE k WHEN 3 THEN 1 WHEN 7 THEN 1 + b * (1 - x) + b * (b + 1) / 2 * (1 - x) * (1 - x) END AS p FROM tail)
SELECT feature, k, n, round(f, 4) AS f_stat, round(p, 4) AS p_value, p < 0.05 AS significant FROM valued""",
    "label_encode": """SELECT o_orderkey, o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM orders""",
    "string_index": """SELECT p_partkey, p_brand, code FROM part JOIN (
        SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS code FROM part GROUP BY p_brand) USING (p_brand)""",
    "impute_mean": f"""SELECT p_partkey,
        round(coalesce(CAST(p_size AS DOUBLE), (SELECT avg(p_size) FROM {GAPPY_PART})), 4) AS p_size,
        round(coalesce(p_retailprice, (SELECT avg(p_retailprice) FROM {GAPPY_PART})), 4) AS p_retailprice FROM {GAPPY_PART}""",
    "zscore": """SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 4) AS p_size,
        round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 4) AS p_retailprice FROM part""",
    "robust_scale": f"""SELECT p_partkey, round({_robust('p_size', 'part')}, 4) AS p_size,
        round({_robust('p_retailprice', 'part')}, 4) AS p_retailprice FROM part""",
    "hash_split": """SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) AS INTEGER) % 10 < 8
        THEN 'train' ELSE 'test' END AS part FROM orders""",
    "assemble_features": """SELECT p_partkey, CAST(0 AS INTEGER) AS pos, CAST(p_size AS DOUBLE) AS value FROM part
        UNION ALL SELECT p_partkey, 1, p_retailprice FROM part""",
    "kmeans_assign": f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INTEGER) AS cluster,
        round(least(d0, d1, d2), 4) AS distance
        FROM (SELECT *, {', '.join(f'{_distance(c)} AS d{i}' for i, c in enumerate(CENTRES))}
              FROM (SELECT *, {SCORES} FROM lineitem))""",
    "centroid_profile": "\nUNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS cluster, '{c}' AS feature, "
        f"round({z}::DOUBLE * stddev_pop({c}) + avg({c}), 4) AS value FROM lineitem"
        for i, centre in enumerate(CENTRES)
        for c, z in zip(MEASURES, centre)
    ),
    "kmeans_fit": "SELECT CAST(3 AS BIGINT) AS clusters, count(*) AS rows, true AS centred FROM lineitem",
    "classify_pollution": f"WITH {COMBINED} SELECT * FROM combined",
    "pollution_fit": f"""WITH {COMBINED} SELECT CAST(3 AS BIGINT) AS clusters, count(*) AS rows, true AS centred,
        'High,Low,Moderate' AS levels FROM aligned""",
    **dict.fromkeys(("train_lr", "train_dt", "train_rf", "train_rf_tuned"), TRAINING),
    "train_pipeline": f"""WITH {COMBINED},
ranked AS (SELECT city, CAST(row_number() OVER (ORDER BY count(*) DESC, city) - 1 AS DOUBLE) AS city_index FROM combined GROUP BY city)
SELECT _id AS row_id, city, hour, city_index, CAST(23 AS INTEGER) AS inputs, CAST(23 AS INTEGER) AS scaled FROM combined JOIN ranked USING (city)""",
    "score_batch": f"WITH {COMBINED} SELECT {ROW_KEY}, true AS known, true AS whole FROM combined",
    "model_roundtrip": f"WITH {COMBINED} SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM combined",
    "stream_score": f"WITH {COMBINED} SELECT {ROW_KEY}, count(*) AS rows, true AS same FROM combined GROUP BY ALL",
    "robust_scale_ml": "SELECT p_partkey, true AS within_0, true AS within_1 FROM part",
    "document_sink": f"{FEEDS},{CLEAN} SELECT * FROM traffic_clean",
    "upload_batches": f"{FEEDS},{CLEAN} SELECT _id, count(*) AS records, true AS bounded FROM traffic_clean GROUP BY _id",
    "timed_batches": "SELECT event_id, event_type, value FROM events",
    "class_metrics": """
WITH c AS (SELECT quality AS l, toxic AS p, count(*) AS n FROM labels GROUP BY ALL),
classes AS (SELECT DISTINCT l FROM c),
per AS (SELECT l, (SELECT sum(n) FROM c WHERE c.l = k.l) AS support,
               (SELECT coalesce(sum(n), 0) FROM c WHERE c.p = k.l) AS guessed,
               (SELECT coalesce(sum(n), 0) FROM c WHERE c.p = k.l AND c.l = k.l) AS hits FROM classes k),
m AS (SELECT sum(hits) / sum(support) AS acc, sum(support * (2.0 * hits / (support + guessed))) / sum(support) AS f1,
             sum(support * (hits::DOUBLE / support)) / sum(support) AS rec FROM per)
SELECT 'all' AS dataset, 'accuracy' AS metric, round(acc::DOUBLE, 4) AS value FROM m
UNION ALL SELECT 'all', 'f1', round(f1::DOUBLE, 4) FROM m
UNION ALL SELECT 'all', 'recall', round(rec::DOUBLE, 4) FROM m""",
    "stream_ingest": f"{FEEDS} SELECT * EXCLUDE (ts, n_events) REPLACE (CAST(event_code AS DOUBLE) AS event_code) FROM traffic",
    "stream_dedupe": f"""{FEEDS},{CLEAN} SELECT _id, city, delay, event_code, date || ' ' || time AS event_ts FROM traffic_clean""",
    "stream_upsert": LATEST.format(columns="_id, report_time, event_id, value"),
    "stream_align": aligned(60),
    "stream_upsert_compacted": LATEST.format(columns="_id, report_time, event_id, value"),
}
ORACLE["fan_out_sinks"] = ORACLE["dq_rules"] + "".join(
    f"\nUNION ALL SELECT '{sink}', 'Written', CAST(count(*) AS DOUBLE) FROM lineitem" for sink in ("documents", "files")
)

_CITY = "CASE user_id % 3 WHEN 0 THEN 'Hanoi' WHEN 1 THEN 'Ap Ba' ELSE 'Ho Chi Minh City' END"
ORACLE |= {
    "profile_duplicates_clocks": """
SELECT CAST((SELECT count(*) FROM events) - (SELECT count(*) FROM (SELECT DISTINCT event_type, date_trunc('day', ts), event_id % 3, user_id % 5 FROM events)) AS BIGINT) AS duplicates""",
    "polled_events": f"""
SELECT {_CITY} AS location, CAST(hour(ts) + 1 AS BIGINT) AS tick, event_id, value, CAST(NULL AS VARCHAR) AS error FROM events
UNION ALL SELECT 'Nowhere', t, NULL, NULL, 'no such place' FROM (SELECT unnest(generate_series(1, 24)) AS t)""",
    "stream_fan_out": """
SELECT name, count(*) AS rows, count(DISTINCT event_id) AS different, round(sum(value), 2) AS total
FROM events, (SELECT unnest(['files', 'documents']) AS name) GROUP BY name
UNION ALL SELECT unnest(['RowCount > 0', 'Completeness `value` >= 0.5']), 3, 1, NULL""",
    "stream_dedupe_moving": f"SELECT event_id, {_CITY} AS city, value, {SECOND} AS event_ts FROM events",
    "partial_delivery": """
SELECT event_id, CASE WHEN event_id % 91 = 0 THEN 'parked' ELSE 'delivered' END AS status,
  CASE WHEN event_id % 91 = 0 THEN 3 WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS tries,
  CASE WHEN event_id % 91 = 0 THEN 'throttled' END AS error, CASE WHEN event_id % 91 = 0 THEN 0 ELSE 1 END AS received
FROM events""",
    "combine_increments": aligned(60),
}

ORACLE |= {
    "stream_latest_live": """
WITH rows AS (SELECT user_id AS _id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS report_time, event_id, value FROM events),
upto AS (
  SELECT k::BIGINT AS batch, r.*, row_number() OVER (PARTITION BY k, _id ORDER BY report_time DESC, event_id DESC) AS place
  FROM rows r, (SELECT unnest(generate_series(0, 3)) AS k) WHERE event_id % 4 <= k)
SELECT _id, report_time, event_id, value, batch FROM upto WHERE place = 1 AND event_id % 4 = batch
UNION ALL SELECT _id, report_time, event_id, value, -1 FROM upto WHERE place = 1 AND batch = 3""",
    "stream_rules": """
WITH m AS (SELECT event_id % 4 AS batch, count(*) AS n, count(value) FILTER (WHERE event_id % 12 > 2) AS present FROM events GROUP BY ALL)
SELECT batch::BIGINT AS batch, 'ColumnCount > 3' AS rule, 'Failed' AS outcome, 3.0::DOUBLE AS actual FROM m
UNION ALL SELECT batch, 'RowCount > 0', 'Passed', n::DOUBLE FROM m
UNION ALL SELECT batch, 'Completeness `value` >= 0.7', CASE WHEN present / n >= 0.7 THEN 'Passed' ELSE 'Failed' END, round(present / n, 4)::DOUBLE FROM m""",
}
