"""Table schemas; nothing is inferred on read."""



READINGS = "id BIGINT, link_id BIGINT, speed_band INT, min_speed INT, max_speed INT, snapshot_ts BIGINT"
RAW_READINGS = "id STRING, link_id STRING, speed_band STRING, min_speed STRING, max_speed STRING, snapshot_time STRING"
ROADS = (
    "link_id BIGINT, road_name STRING, road_category INT, "
    "start_lat DOUBLE, start_lon DOUBLE, end_lat DOUBLE, end_lon DOUBLE"
)
INCIDENT_SNAPSHOTS = "row_id BIGINT, type STRING, lat DOUBLE, lon DOUBLE, message STRING, snapshot_ts BIGINT"
INCIDENTS = (
    "incident_id BIGINT, nearest_link_id BIGINT, type STRING, start_ts BIGINT, end_ts BIGINT, "
    "duration_min DOUBLE, lat DOUBLE, lon DOUBLE, message STRING"
)
STATIONS = "station_id STRING, lat DOUBLE, lon DOUBLE"
RAIN = "station_id STRING, ts BIGINT, rain_mm DOUBLE"
FEED_INCIDENT = "Type STRING, Latitude DOUBLE, Longitude DOUBLE, Message STRING"
FEED_SPEED = "LinkID STRING, SpeedBand STRING"
SPEED_PAGE = f"fetched_at BIGINT, value ARRAY<STRUCT<{FEED_SPEED}>>"
STATION_FEED = "data STRUCT<stations: ARRAY<STRUCT<id: STRING, location: STRUCT<latitude: STRING, longitude: STRING>>>>"
GEOCODE = (
    "results ARRAY<STRUCT<SEARCHVAL: STRING, ADDRESS: STRING, POSTAL: STRING, "
    "LATITUDE: STRING, LONGITUDE: STRING>>"
)
