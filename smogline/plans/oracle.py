"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

OBS = """obs AS (
  SELECT '{"sensor":' || user_id || '}' AS key, CAST(user_id AS VARCHAR) AS sensorId,
         CAST(user_id * 61 % 100 + 1 AS INTEGER) AS lon,
         CAST(user_id * 37 % 100 + 1 AS INTEGER) AS lat,
         CAST(event_id % 45 AS DOUBLE) - CAST(10 AS DOUBLE) AS temperature,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS humidity,
         value AS pm2, 'pollution' AS measurement, ts, event_id AS seq
  FROM events)"""

READING = OBS + """, reading AS (
  SELECT sensorId AS id, pm2,
         '(' || ((lat - 1) // 25) || ',' || ((lon - 1) // 25) || ')' AS area,
         CAST(lat AS VARCHAR) AS lat, CAST(lon AS VARCHAR) AS lon,
         temperature AS tempC, CAST(humidity AS DOUBLE) AS humidity, ts, seq
  FROM obs)"""

SENSOR = READING + """, placed AS (
  SELECT *, unnest([time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01'),
                    time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01') - INTERVAL 5 DAY]) AS window_start
  FROM reading),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY id, window_start ORDER BY ts, seq) AS rk,
         count(*) OVER (PARTITION BY id, window_start) AS n
  FROM placed),
sw_raw AS (
  SELECT id, window_start, window_start + INTERVAL 10 DAY AS window_end, max(n) AS n,
         sum(pm2) AS sumPM2, max(tempC) AS tempC, max(humidity) AS humidity,
         min_by(area, rk) AS area, min_by(lat, rk) AS lat, min_by(lon, rk) AS lon,
         avg(pm2) FILTER (rk <= 1 + n // 10) AS first_mean,
         avg(pm2) FILTER (rk > n - 1 - n // 10) AS last_mean
  FROM numbered GROUP BY id, window_start),
sw AS (
  SELECT id, window_start, window_end, n > 1 AND last_mean - first_mean > 10 AS pm2tooHigh, area,
         sumPM2 / n AS avgPM2, CAST(n AS INTEGER) AS elementsInWindow, sumPM2, tempC,
         tempC * CAST(1.8 AS DOUBLE) + 32 AS tempF, humidity, lat, lon
  FROM sw_raw)"""

SENSOR_ROUNDED = """round(avgPM2, 7) AS avgPM2, elementsInWindow, round(sumPM2, 7) AS sumPM2,
  tempC, round(tempF, 7) AS tempF, humidity"""

_AREA_BUCKET = """time_bucket(INTERVAL 60 HOUR, window_end - INTERVAL 1 MICROSECOND,
                     TIMESTAMP '1970-01-01')"""


def _area_cte(source: str) -> str:
    return f""", areas AS (
  SELECT area, {_AREA_BUCKET} AS window_start, {_AREA_BUCKET} + INTERVAL 60 HOUR AS window_end,
         CAST(sum(CAST(pm2tooHigh AS INTEGER)) AS BIGINT) AS sensorsReportingTrend
  FROM {source} GROUP BY ALL)"""


AREA = SENSOR + _area_cte("sw")

TREND = "WITH RECURSIVE " + OBS + """, tw AS (
  SELECT *, time_bucket(INTERVAL 2 DAY, ts, TIMESTAMP '1970-01-01') AS window_start FROM obs),
tn AS MATERIALIZED (
  SELECT key, window_start, pm2,
         row_number() OVER (PARTITION BY key, window_start ORDER BY ts, seq) AS rk
  FROM tw),
run AS (
  SELECT key, window_start, CAST(0 AS BIGINT) AS rk, CAST(-1 AS DOUBLE) AS f, CAST(0 AS DOUBLE) AS s,
         CAST(-1000 AS DOUBLE) AS t, false AS high, 0 AS cnt
  FROM tn WHERE rk = 1
  UNION ALL
  SELECT r.key, r.window_start, x.rk,
    CASE WHEN r.f <= x.pm2 THEN CASE WHEN r.f = -1 THEN 0 ELSE (x.pm2 - r.s) + r.f END ELSE r.f END,
    CASE WHEN r.f <= x.pm2 OR r.t >= x.pm2 THEN x.pm2 ELSE r.s END,
    CASE WHEN r.f <= x.pm2 THEN r.t
         WHEN r.t >= x.pm2 THEN CASE WHEN r.t = -1000 THEN 0 ELSE (x.pm2 - r.s) + r.t END
         ELSE r.t END,
    CASE WHEN r.f <= x.pm2 THEN r.high OR (r.f <> -1 AND (x.pm2 - r.s) + r.f >= 1)
         WHEN r.t >= x.pm2 AND r.t <> -1000 AND (x.pm2 - r.s) + r.t >= 1 THEN false
         ELSE r.high END,
    r.cnt + CASE WHEN r.f <= x.pm2 AND r.f <> -1 AND (x.pm2 - r.s) + r.f >= 1 THEN 1 ELSE 0 END
  FROM run r JOIN tn x ON x.key = r.key AND x.window_start = r.window_start AND x.rk = r.rk + 1),
fold AS (
  SELECT key, window_start, max_by(high, rk) AS tooHigh, max_by(cnt, rk) AS tooHighCount,
         max_by(f, rk) AS pair_first, max_by(s, rk) AS pair_second, max_by(t, rk) AS pair_third
  FROM run GROUP BY key, window_start),
stats AS (
  SELECT key, window_start, window_start + INTERVAL 2 DAY AS window_end,
         max_by(sensorId, seq) AS sensorId, max_by(measurement, seq) AS measurement,
         max_by('Area [' || (lon // 25) || ', ' || (lat // 25) || ']', seq) AS area,
         sum(pm2) / count(*) AS avgPm2, CAST(count(*) AS INTEGER) AS countUsecase, sum(pm2) AS sumPm2,
         greatest(CAST(-1 AS DOUBLE), max(pm2)) AS maxPm2,
         greatest(CAST(-1 AS DOUBLE), max(temperature)) AS temperatureCMax,
         greatest(CAST(-1 AS DOUBLE), max(temperature * CAST(1.8 AS DOUBLE) + 32)) AS temperatureFMax,
         greatest(-1, max(humidity)) AS humidityMax
  FROM tw GROUP BY key, window_start),
trend AS (SELECT * FROM stats JOIN fold USING (key, window_start))"""

STATS = """sensorId, measurement, area, round(avgPm2, 7) AS avgPm2, countUsecase,
  round(sumPm2, 7) AS sumPm2, maxPm2, temperatureCMax, round(temperatureFMax, 7) AS temperatureFMax,
  humidityMax"""
PAIR = """round(pair_first, 7) AS pair_first, round(pair_second, 7) AS pair_second,
  round(pair_third, 7) AS pair_third"""

WIRE_A = """'{"measurement":"pollution", "id": ' || sensorId || ', "long": ' || lon || ', "lat": ' || lat
  || ', "humidity": ' || humidity || ', "temperature": ' || temperature || ', "pm2": ' || pm2 || '}'"""
POSITIONAL = "seq, id, pm2, area, lat, lon, tempC, humidity"

JSON_TEXT = """text AS (
  SELECT seq, seq % 7 = 0 OR seq % 9 = 0 AS bad,
         CASE WHEN seq % 7 = 0 THEN left(record, 20) ELSE regexp_replace(record, '"lon":([0-9]+)', '"lon":\\1.5') END AS value
  FROM (SELECT seq, CAST(to_json({sensorId: sensorId, lon: lon, lat: lat, temperature: temperature,
          humidity: humidity, pm2: pm2, measurement: measurement}) AS VARCHAR) AS record FROM obs))"""


def _decimal(column: str) -> str:
    return f"CAST(round({column}, 6) AS DECIMAL(18, 6))"


# 0.1 km of latitude and longitude at the map origin, in degrees
_STEP_LAT = "(100.0::DOUBLE * (180 / (6371000::DOUBLE * sin(radians(47.063::DOUBLE)) * pi())))"
_STEP_LNG = f"({_STEP_LAT} / cos(radians(47.063::DOUBLE)))"

# a window has closed when its end is not after the watermark (latest event minus one day)
_CLOSED = "(SELECT max(ts) - INTERVAL 1 DAY FROM events)"

ORACLE: dict[str, str] = {
    "decode_positional": f"WITH {READING} SELECT {POSITIONAL} FROM reading",
    "decode_json": f"""WITH {OBS} SELECT key, seq, sensorId, lon, lat,
        CASE WHEN seq % 5 = 0 THEN 0 ELSE temperature END AS temperature, humidity, pm2, measurement
        FROM obs""",
    "decode_store_reading": f"""WITH {OBS} SELECT seq, sensorId AS id, CAST(pm2 AS VARCHAR) AS pm2,
        CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts FROM obs""",
    "bad_records": f"""WITH {OBS}, text AS (SELECT seq, {WIRE_A} AS value FROM obs)
        SELECT seq, CASE seq % 10
            WHEN 3 THEN regexp_replace(value, '"lat": ([0-9]+)', '"lat": \\1.0')
            WHEN 5 THEN regexp_replace(value, '"pm2": .*', '"pm2": abc}}')
            WHEN 7 THEN array_to_string(string_split(value, ',')[1:4], ',')
            ELSE '' END AS value
        FROM text WHERE seq % 10 IN (3, 5, 7, 9)""",
    "good_records": f"""WITH {READING} SELECT {POSITIONAL} FROM reading
        WHERE seq % 10 NOT IN (3, 5, 7, 9)""",
    "bad_json_records": f"""WITH {OBS}, {JSON_TEXT} SELECT seq, value FROM text WHERE bad""",
    "bad_store_records": f"""WITH {OBS} SELECT seq, '{{"id":' || sensorId || ',"measurement":pollution,"ts":'
        || (epoch_us(ts) // 1000) || ',"lon":' || lon AS value FROM obs WHERE seq % 10 = 7""",
    "area_grid": f"""WITH {OBS} SELECT seq, lat, lon,
        '(' || ((lat - 1) // 25) || ',' || ((lon - 1) // 25) || ')' AS area FROM obs""",
    "area_block": f"""WITH {OBS} SELECT seq, lat, lon,
        'Area [' || (lon // 25) || ', ' || (lat // 25) || ']' AS area FROM obs""",
    "temp_fahrenheit": f"""WITH {OBS} SELECT seq, temperature AS tempC,
        round(temperature * CAST(1.8 AS DOUBLE) + 32, 7) AS tempF FROM obs""",
    "sensor_window_sliding": f"""WITH {SENSOR}
        SELECT id, window_start, window_end, area, {SENSOR_ROUNDED} FROM sw""",
    "sensor_rise": f"""WITH {SENSOR}
        SELECT id, window_start, window_end, pm2tooHigh, area, {SENSOR_ROUNDED} FROM sw""",
    "sensor_flag": f"""WITH {SENSOR}
        SELECT id, window_end, CAST(pm2tooHigh AS INTEGER) AS flag, area FROM sw""",
    "area_trend": f"WITH {AREA} SELECT * FROM areas",
    "area_alarms": f"""WITH {AREA} SELECT *, 640 // 16 // 10 AS threshold FROM areas
        WHERE sensorsReportingTrend > 640 // 16 // 10""",
    "alert_messages": f"""WITH {AREA} SELECT area, window_end, sensorsReportingTrend AS count,
        4 AS threshold, CASE WHEN sensorsReportingTrend > 4 THEN 'above' ELSE 'below' END AS severity,
        CASE WHEN sensorsReportingTrend > 4
          THEN 'Area: ' || area || ' registered a high increase of PM2,5. ' || sensorsReportingTrend
               || ' of 40 registered sensors reported.'
          ELSE 'Area: ' || area || ' registered a too high increase of PM2,5 concentration: '
               || sensorsReportingTrend || ' of 40 registered sensors reported.' END AS message
        FROM areas""",
    "alert_messages_above": f"""WITH {AREA} SELECT area, window_end, sensorsReportingTrend AS count,
        4 AS threshold, 'above' AS severity,
        'ALARM !!! Area: ' || area || ' registered a high increase of PM2,5. ' || sensorsReportingTrend
          || ' of 40 registered sensors reported.' AS message
        FROM areas WHERE sensorsReportingTrend > 4""",
    "trend_window": f"{TREND} SELECT key, window_start, window_end, {STATS} FROM stats",
    "trend_fold": f"""{TREND} SELECT key, window_start, window_start + INTERVAL 2 DAY AS window_end,
        tooHigh, tooHighCount, {PAIR} FROM fold""",
    "trend_too_high": f"""{TREND} SELECT key, window_start, window_end, area, tooHighCount,
        round(avgPm2, 7) AS avgPm2 FROM trend WHERE tooHigh""",
    "area_running_count": f"""{TREND} SELECT area, count(*) AS count FROM trend WHERE tooHigh
        GROUP BY area""",
    "alert_messages_updates": f"""{TREND}, counted AS (
        SELECT area, window_end, row_number() OVER (PARTITION BY area ORDER BY window_end) AS count
        FROM trend WHERE tooHigh)
        SELECT area, window_end, count,
          'In ' || area || 'was registred a too high Pm2.5 concentration' || count AS message
        FROM counted""",
    "encode_trend_json": f"""{TREND} SELECT key, window_start, window_end, tooHigh, tooHighCount,
        {STATS}, {PAIR} FROM trend""",
    "encode_trend_text": f"""{TREND} SELECT
        '{{"key":' || to_json(key) || ',"window_start":' || (epoch_us(window_start) // 1000)
          || ',"window_end":' || (epoch_us(window_end) // 1000) || '}}' AS key,
        '{{"sensorId":"' || sensorId || '","measurement":"' || measurement || '","tooHigh":' || tooHigh
          || ',"tooHighCount":' || tooHighCount || ',"area":"' || area || '","avgPm2":' || {_decimal("avgPm2")}
          || ',"countUsecase":' || countUsecase || ',"pair":{{"first":' || {_decimal("pair_first")} || ',"second":'
          || {_decimal("pair_second")} || ',"third":' || {_decimal("pair_third")} || '}},"sumPm2":' || {_decimal("sumPm2")}
          || ',"maxPm2":' || {_decimal("maxPm2")} || ',"temperatureCMax":' || {_decimal("temperatureCMax")}
          || ',"temperatureFMax":' || {_decimal("temperatureFMax")} || ',"humidityMax":' || humidityMax || '}}' AS value
        FROM trend""",
    "encode_counts_text": f"""{TREND} SELECT area AS key,
        CAST(row_number() OVER (PARTITION BY area ORDER BY window_end) AS VARCHAR) AS value FROM trend WHERE tooHigh""",
    "points_pollution": f"""WITH {READING} SELECT 'Pollution' AS measurement, ts, id, area,
        lat AS latitude, lon AS longitude, pm2, humidity, tempC FROM reading""",
    "points_pollution_plain": f"""WITH {READING} SELECT 'Pollution' AS measurement, ts, id, area,
        pm2, humidity, tempC FROM reading""",
    "points_sensor_data": f"""WITH {SENSOR} SELECT 'SensorData' AS measurement, window_end AS ts, id,
        area, pm2tooHigh, {SENSOR_ROUNDED} FROM sw""",
    "points_area_trend": f"""WITH {AREA} SELECT 'AreaTrend' AS measurement, window_end AS ts, area,
        sensorsReportingTrend FROM areas""",
    "points_map_sensors": f"""WITH {SENSOR} SELECT 'sensors' AS measurement, window_end AS ts,
        id AS sensorino, round(avgPM2, 7) AS avgPM2, id, lat, lon FROM sw""",
    "points_map_areas": f"""WITH {AREA} SELECT 'areas' AS measurement, window_end AS ts, area,
        sensorsReportingTrend AS tooHigh FROM areas""",
    "raw_points": f"""WITH {OBS} SELECT 'pollutionRaw' AS point, ts, sensorId, lon, lat, temperature,
        humidity, pm2, measurement FROM obs""",
    "trend_points": f"""{TREND} SELECT 'pollution' AS point, window_end AS ts, tooHigh, tooHighCount,
        {STATS} FROM trend""",
    "store_payload": f"""WITH {OBS} SELECT '{{"id":"' || sensorId || '","pm2":"' || pm2 || '","ts":"'
        || (epoch_us(ts) // 1000) || '"}}' AS payload FROM obs""",
    "points_time_range": f"""WITH {READING} SELECT 'Pollution' AS measurement, ts, id, area,
        lat AS latitude, lon AS longitude, pm2, humidity, tempC FROM reading
        WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""",
    "map_sensor_layer": f"""WITH {SENSOR} SELECT id, round(avgPM2, 7) AS avgPM2,
        CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS long,
        round(47.063::DOUBLE + CAST(lat AS DOUBLE) * {_STEP_LAT}, 7) AS lat_deg,
        round(15.44::DOUBLE + CAST(lon AS DOUBLE) * {_STEP_LNG}, 7) AS lng_deg,
        CASE WHEN avgPM2 < 15 THEN 'green' ELSE 'red' END AS color FROM sw""",
    "map_layer_from_text": f"""WITH {SENSOR} SELECT id, round(avgPM2, 7) AS avgPM2,
        CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS long,
        round(47.063::DOUBLE + CAST(lat AS DOUBLE) * {_STEP_LAT}, 7) AS lat_deg,
        round(15.44::DOUBLE + CAST(lon AS DOUBLE) * {_STEP_LNG}, 7) AS lng_deg,
        CASE WHEN avgPM2 < 15 THEN 'green' ELSE 'red' END AS color FROM sw""",
    "map_area_layer": f"""WITH {AREA}, k AS (
        SELECT (sqrt(count(DISTINCT id)) + 1) / 2 - 1 AS edge FROM sw),
        parts AS (
          SELECT area, sensorsReportingTrend AS tooHigh, edge * {_STEP_LAT} AS h, edge * {_STEP_LNG} AS w,
                 CAST(regexp_extract(area, '\\((-?\\d+),(-?\\d+)\\)', 1) AS INTEGER) AS r,
                 CAST(regexp_extract(area, '\\((-?\\d+),(-?\\d+)\\)', 2) AS INTEGER) AS c
          FROM areas, k)
        SELECT area, tooHigh, round(47.063::DOUBLE + h * r, 7) AS start_lat,
          round(15.44::DOUBLE + w * c, 7) AS start_lng,
          round(47.063::DOUBLE + h * r + h, 7) AS end_lat, round(15.44::DOUBLE + w * c + w, 7) AS end_lng,
          CASE WHEN tooHigh < 2 THEN 'green' ELSE 'red' END AS color FROM parts""",
    "sensor_rise_stream": f"""WITH {SENSOR}
        SELECT id, window_start, window_end, pm2tooHigh, area, {SENSOR_ROUNDED} FROM sw
        WHERE window_end <= {_CLOSED}""",
    "area_trend_stream": f"""WITH {SENSOR}, closed AS (
          SELECT * FROM sw WHERE window_end <= {_CLOSED}) {_area_cte("closed")}
        SELECT * FROM areas WHERE window_end <= {_CLOSED}""",
    "trend_stream": f"""{TREND} SELECT key, window_start, window_end, tooHigh, tooHighCount,
        {STATS}, {PAIR} FROM trend WHERE window_end <= {_CLOSED}""",
    "area_running_count_stream": f"""{TREND} SELECT area, count(*) AS count FROM trend
        WHERE tooHigh AND window_end <= {_CLOSED} GROUP BY area""",
    "sensor_flag_stream": f"""WITH {SENSOR}
        SELECT id, window_end, CAST(pm2tooHigh AS INTEGER) AS flag, area FROM sw WHERE window_end <= {_CLOSED}""",
    "trend_store": f"""{TREND} SELECT key, window_start, window_end, tooHigh, tooHighCount,
        {STATS}, {PAIR}, window_end > {_CLOSED} AS open FROM trend""",
    "alert_messages_updates_stream": f"""{TREND}, counted AS (
        SELECT area, window_end, row_number() OVER (PARTITION BY area ORDER BY window_end) AS count
        FROM trend WHERE tooHigh AND window_end <= {_CLOSED})
        SELECT area, window_end, count,
          'In ' || area || 'was registred a too high Pm2.5 concentration' || count AS message
        FROM counted""",
    # a file moves the watermark for the files after it; a window takes rows in while its end lies behind that
    "late_rows_stream": f"""WITH {OBS}, landed AS (
          SELECT seq, ts, least(floor(seq * 6 / (SELECT max(seq) + 1 FROM obs)) + CASE WHEN seq % 11 = 0 THEN 1 ELSE 0 END, 5) AS file
          FROM obs),
        moved AS (SELECT file, (max(epoch_us(max(ts)) // 1000) OVER (ORDER BY file) - 86400000) * 1000 AS mark
                  FROM landed GROUP BY file)
        SELECT seq, epoch_us(time_bucket(INTERVAL 2 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 2 DAY)
                    > coalesce(mark, 0) AS counted
        FROM landed LEFT JOIN moved ON moved.file = landed.file - 1 WHERE seq % 11 = 0""",
    "bad_json_records_stream": f"""WITH {OBS}, {JSON_TEXT}
        SELECT seq, CASE WHEN bad THEN value END AS value FROM text""",
    "rise_from_text_file": f"""WITH {READING}, lines AS (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rk, count(*) OVER (PARTITION BY id) AS n FROM reading)
        SELECT id, CAST(max(n) AS INTEGER) AS elementsInWindow,
          max(n) > 1 AND avg(pm2) FILTER (rk > n - 1 - n // 10) - avg(pm2) FILTER (rk <= 1 + n // 10) > 10 AS pm2tooHigh,
          round(sum(pm2), 7) AS sumPM2, min_by(area, rk) AS area, min_by(lat, rk) AS lat, min_by(lon, rk) AS lon
        FROM lines GROUP BY id""",
}

# A running job splits the same messages: bad ones with their text, good ones without.
for _bad in ("bad_records", "bad_store_records"):
    ORACLE[f"{_bad}_stream"] = f"""SELECT event_id AS seq, bad.value AS value FROM events
        LEFT JOIN ({ORACLE[_bad]}) bad ON bad.seq = event_id"""

# The map over the areas that have closed.
ORACLE["map_area_layer_stream"] = ORACLE["map_area_layer"].replace(
    f"WITH {AREA}", f"""WITH {SENSOR}, ended AS (SELECT * FROM sw WHERE window_end <= {_CLOSED})
        {_area_cte("ended").replace("GROUP BY ALL)", f"GROUP BY ALL HAVING {_AREA_BUCKET} + INTERVAL 60 HOUR <= {_CLOSED})")}"""
)

# Landed rows and the batch operators give the same closed windows.
for _batch in ("sensor_rise", "area_trend", "trend"):
    ORACLE[f"{_batch}_closing"] = ORACLE[f"{_batch}_stream"]
