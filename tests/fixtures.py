"""Feed rows used as goldens: nine incidents, thirteen postcodes and three weather snapshots,
some of them ingested more than once."""

from datetime import datetime

RUNS = [datetime(2025, 10, 26, 1, 30), datetime(2025, 10, 26, 10, 44), datetime(2025, 10, 28, 16, 0)]

# crime_id, lat, lon, category, outcome
INCIDENTS = [
    (130549789, "53.350547", "-2.114897", "burglary", "Investigation complete; no suspect identified"),
    (130544811, "53.352734", "-2.189627", "other-crime", "Unable to prosecute suspect"),
    (130533517, "53.353403", "-2.141496", "public-order", "Unable to prosecute suspect"),
    (130551342, "53.353481", "-2.088779", "public-order", None),
    (130539447, "53.348301", "-2.146781", "violent-crime", None),
    (130539535, "53.352716", "-2.129159", "violent-crime", None),
    (130540161, "53.348301", "-2.146781", "violent-crime", None),
    (130588276, "53.365257", "-2.151243", "violent-crime", None),
    (130825955, "53.418127", "-2.158532", "violent-crime", None),
]

# postcode, lat, lon, eastings, northings: full postcodes with both coordinate systems published
FULL_POSTCODES = [
    ("SK1 1EB", 53.409982, -2.158064, 389590, 390362),
    ("SK2 5DH", 53.40185, -2.126389, 391694, 389453),
    ("SK3 0SA", 53.395495, -2.182087, 387989, 388754),
    ("SK4 1AA", 53.408836, -2.161806, 389341, 390235),
    ("SK8 3AU", 53.372898, -2.21402, 385858, 386246),
]

# datetime, weather_id, weather_main, temp, humidity, wind, runs it was ingested in
WEATHER = [
    (datetime(2025, 10, 26, 1, 30, 53), 800, "Clear", 4.31, 81.0, 3.09, 1),
    (datetime(2025, 10, 26, 10, 40, 30), 500, "Rain", 8.14, 87.0, 5.14, 3),
    (datetime(2025, 10, 28, 15, 56, 32), 802, "Clouds", 12.25, 67.0, 6.17, 1),
]


def incidents(spark):
    rows = [
        (cid, lat, lon, cat, outcome, "2025-08", "2025-08" if outcome else None, "On or near A Street", run)
        for run in RUNS for cid, lat, lon, cat, outcome in INCIDENTS
    ]
    return spark.createDataFrame(
        rows, "crime_id long, lat string, lon string, category string, outcome_category string, month string, "
              "outcome_date string, street_name string, ingestion_timestamp timestamp",
    )


def postcodes(spark):
    rows = [
        (pc, "full_postcode", lat, lon, e, n, "District", "Ward", run)
        for run in RUNS for pc, lat, lon, e, n in FULL_POSTCODES
    ]
    rows += [("SK1", "outward_code", 53.4, -2.15, 390131, 389259, "District", None, run) for run in RUNS]
    return spark.createDataFrame(
        rows, "postcode string, postcode_type string, lat double, lon double, eastings long, northings long, "
              "admin_district string, admin_ward string, ingestion_timestamp timestamp",
    )


def weather(spark):
    rows = [
        ("Town", 53.4, -2.15, at, wid, main, temp, hum, wind, RUNS[i])
        for at, wid, main, temp, hum, wind, n in WEATHER for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "location_name string, lat double, lon double, datetime timestamp, weather_id int, weather_main string, "
              "temp_celsius double, humidity_percent double, wind_speed_ms double, ingestion_timestamp timestamp",
    )


def elements(spark):
    """Elements with every kind of missing or broken geometry."""
    line = '[{"lat":53.40,"lon":-2.15},{"lat":53.41,"lon":-2.15},{"lat":53.41,"lon":-2.16}]'
    t1, t2 = RUNS[0], RUNS[1]
    rows = [
        (1, "node", 53.40, -2.15, None, None, None, "op", "nm", "water", "steel", t1),
        (1, "node", 53.40, -2.15, None, None, None, None, None, None, None, t2),
        (2, "way", None, None, line, 53.40, -2.15, "op", "nm", "water", None, t1),
        (3, "way", None, None, '[{"lat":53.42,"lon":-2.10}]', 53.42, -2.10, "op", "nm", None, None, t1),
        (4, "way", None, None, "[]", None, None, "op", None, None, None, t1),
        (5, "way", None, None, '[{"lat":53.4', 53.36, -2.12, None, None, None, None, t1),
        (6, "way", None, None, None, None, None, None, None, None, None, t1),
        (7, "way", None, None, '[{"lat":53.40,"lon":-2.15},{"lat":53.41}]', 53.40, -2.15, None, None, None, None, t1),
        (8, "node", 53.35, -2.20, None, None, None, None, None, None, None, t1),
        (9, "node", 53.3499, -2.20, None, None, None, None, None, None, None, t1),
    ]
    return spark.createDataFrame(
        rows, "id long, type string, lat double, lon double, geometry_json string, first_lat double, first_lon double, "
              "operator string, name string, substance string, material string, ingestion_timestamp timestamp",
    )
