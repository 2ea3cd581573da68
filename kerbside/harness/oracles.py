"""The registered queries as plain SQL, written as the joins and groupings they stand for.

Deliberately naive: models and views are real row joins here, while the library multiplies
pre-aggregated counts. Each query is a chain of the CTEs it needs. Averages are moved off rounding
ties by 1e-9, as in registry.py: engines add doubles in different orders.
"""

from __future__ import annotations

# --------------------------------------------------------------------------------------------
# The feeds (see adapters.py) and the enriched tables made of them.
# --------------------------------------------------------------------------------------------

# Model column and the table column it shows.
MODEL_VEHICLE_COLUMNS = (
    ("high_impact_crash", "high_impact_crash"),
    ("vehicle_year", "vehicle_year"),
    ("vehicle_type", "vehicle_type"),
    ("state_registration", "state_registration"),
    ("pre_crash", "pre_crash"),
    ("vehicle_damage", "vehicle_damage"),
    ("vehicle_contributing_factor", "contributing_factor"),
)
MODEL_PERSON_COLUMNS = (
    ("person_type", "person_type"),
    ("person_injury", "person_injury"),
    ("person_age", "person_age"),
    ("ejection", "ejection"),
    ("emotional_status", "emotional_status"),
    ("bodily_injury", "bodily_injury"),
    ("position_in_vehicle", "position_in_vehicle"),
    ("safety_equipment", "safety_equipment"),
    ("person_contributing_factor_1", "contributing_factor_1"),
    ("person_contributing_factor_2", "contributing_factor_2"),
    ("person_sex", "person_sex"),
)

# The codes of the taxi feed and what they stand for.
TAXI_VENDORS = ((1, "Creative Mobile Technologies, LLC"), (2, "VeriFone Inc."))
TAXI_RATES = (
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
)
TAXI_PAYMENTS = (
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
)


def _listed(table: str, columns) -> str:
    return ", ".join(f"{table}.{own} AS {name}" for name, own in columns)


def _codes(table) -> str:
    return "(VALUES " + ", ".join(f"({code}, '{label}')" for code, label in table) + ")"


_CTES = {
    "regions": """
        SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "crashes_raw": """
        SELECT o_orderdate + INTERVAL 22 YEARS AS crash_date,
          concat(o_custkey % 24, ':', lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')) AS crash_time,
          CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderstatus = 'F' THEN CASE r_name WHEN 'AFRICA' THEN 'Kings'
              WHEN 'AMERICA' THEN 'New York' WHEN 'ASIA' THEN 'queens' WHEN 'EUROPE' THEN 'bx'
              ELSE 'Richmond County' END
            ELSE CASE r_name WHEN 'AFRICA' THEN 'Brooklyn' WHEN 'AMERICA' THEN 'Manhattan'
              WHEN 'ASIA' THEN 'Queens' WHEN 'EUROPE' THEN 'Bronx' ELSE 'Staten Island' END
          END AS borough,
          CAST(o_custkey % 300 + 10000 AS INTEGER) AS zip_code,
          CAST(o_custkey % 1000 AS DOUBLE) / 1000 + 40.5::DOUBLE AS latitude,
          CAST(o_custkey % 1000 AS DOUBLE) / 1000 - 74.5::DOUBLE AS longitude,
          CAST(o_orderkey % 5 AS INTEGER) AS number_of_persons_injured,
          CASE WHEN o_orderkey % 10 = 3 THEN NULL WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END
            AS number_of_persons_killed,
          CAST(o_orderkey % 2 AS INTEGER) AS number_of_pedestrians_injured,
          0 AS number_of_pedestrians_killed,
          CAST(o_orderkey % 3 AS INTEGER) AS number_of_cyclist_injured,
          0 AS number_of_cyclist_killed,
          CAST(o_orderkey % 4 AS INTEGER) AS number_of_motorist_injured,
          0 AS number_of_motorist_killed,
          CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS contributing_factor_vehicle_1,
          CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Sedan' END AS vehicle_type_code1,
          CASE WHEN o_orderstatus = 'O' THEN 'Taxi' END AS vehicle_type_code2,
          o_orderkey AS collision_id
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN regions ON c_nationkey = n_nationkey""",
    "crashes": """
        SELECT CAST(crash_date AS DATE) AS crash_date, coalesce(borough, 'Unknown') AS borough,
          zip_code, latitude, longitude, number_of_persons_injured, number_of_persons_killed,
          number_of_pedestrians_injured, number_of_cyclist_injured, number_of_motorist_injured,
          coalesce(contributing_factor_vehicle_1, 'Unknown') AS contributing_factor_vehicle_1,
          coalesce(vehicle_type_code1, 'Unknown') AS vehicle_type_code1,
          coalesce(vehicle_type_code2, 'Unknown') AS vehicle_type_code2,
          collision_id,
          CAST(year(crash_date) AS INTEGER) AS year, CAST(month(crash_date) AS INTEGER) AS month,
          CAST(day(crash_date) AS INTEGER) AS day,
          coalesce(number_of_persons_killed > 0, FALSE) AS was_fatal,
          CASE WHEN vehicle_type_code1 IS NULL THEN 0 ELSE 1 END AS vehicle_type_code1_involved,
          CASE WHEN vehicle_type_code2 IS NULL THEN 0 ELSE 1 END AS vehicle_type_code2_involved,
          CASE WHEN vehicle_type_code1 IS NULL THEN 0 ELSE 1 END
            + CASE WHEN vehicle_type_code2 IS NULL THEN 0 ELSE 1 END AS total_vehicles_involved
        FROM crashes_raw""",
    "aliases": """
        SELECT unnest(names) AS alias, canonical FROM (VALUES
          (['manhattan', 'new york', 'new york city', 'ny'], 'Manhattan'),
          (['brooklyn', 'kings', 'kings county'], 'Brooklyn'),
          (['queens', 'queens county'], 'Queens'),
          (['bronx', 'bronx county', 'bx'], 'Bronx'),
          (['staten island', 'richmond', 'richmond county'], 'Staten Island')) t(names, canonical)""",
    "standardized": """
        SELECT crashes.*, coalesce(canonical, borough) AS standardized_borough
        FROM crashes LEFT JOIN aliases ON alias = lower(borough)""",
    "vehicles_raw": """
        SELECT l_orderkey AS collision_id,
          CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN NULL
            ELSE CAST(CAST(o_orderdate + INTERVAL 22 YEARS AS DATE) AS VARCHAR)
              || CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'T00:00:00'
                 ELSE 'T00:00:00.000' END END AS crash_date,
          CASE WHEN l_linenumber <> 6 THEN
            concat(l_partkey % 24, ':', lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0')) END
            AS crash_time,
          CASE WHEN l_linenumber <> 5 THEN n_name END AS state_registration,
          CASE WHEN l_linenumber <> 4 THEN p_size + 1985 END AS vehicle_year,
          p_type AS vehicle_type,
          CASE l_returnflag WHEN 'R' THEN 'Making Left Turn' WHEN 'A' THEN 'Going Straight Ahead'
            WHEN 'N' THEN 'Making U Turn' END AS pre_crash,
          CASE p_brand WHEN 'Brand#1' THEN 'Lost Consciousness'
            WHEN 'Brand#2' THEN 'Driver Inattention/Distraction' WHEN 'Brand#3' THEN NULL
            ELSE p_brand END AS contributing_factor_1,
          CASE WHEN l_linenumber = 1 THEN 'No Damage' WHEN l_linenumber = 2 THEN 'Other'
            WHEN l_linenumber = 3 THEN NULL WHEN l_linestatus = 'O' THEN 'Center Front End'
            ELSE 'Left Rear Quarter Panel' END AS vehicle_damage
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
          JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "vehicles": """
        SELECT collision_id, CAST(substr(crash_date, 1, 10) AS DATE) AS crash_date,
          coalesce(crash_time, 'Unknown') AS crash_time,
          coalesce(state_registration, 'Unknown') AS state_registration, vehicle_year, vehicle_type,
          pre_crash, coalesce(contributing_factor_1, 'Unknown') AS contributing_factor,
          coalesce(vehicle_damage, 'Unknown') AS vehicle_damage,
          CAST(year(CAST(substr(crash_date, 1, 10) AS DATE)) AS INTEGER) AS year,
          CAST(month(CAST(substr(crash_date, 1, 10) AS DATE)) AS INTEGER) AS month,
          CAST(day(CAST(substr(crash_date, 1, 10) AS DATE)) AS INTEGER) AS day,
          CASE WHEN CAST(split_part(crash_time, ':', 1) AS INTEGER) < 6 THEN 'Night'
            WHEN CAST(split_part(crash_time, ':', 1) AS INTEGER) < 12 THEN 'Morning'
            WHEN CAST(split_part(crash_time, ':', 1) AS INTEGER) < 18 THEN 'Afternoon'
            ELSE 'Evening' END AS part_of_day,
          CASE WHEN dayofweek(CAST(substr(crash_date, 1, 10) AS DATE)) IN (0, 6) THEN 'Yes'
            ELSE 'No' END AS weekend,
          CASE WHEN vehicle_year IS NULL THEN 'Unknown' WHEN 2024 - vehicle_year < 5 THEN '0-4 years'
            WHEN 2024 - vehicle_year < 10 THEN '5-9 years' ELSE '10+ years' END
            AS vehicle_age_category,
          CASE WHEN contributing_factor_1 IN
              ('Lost Consciousness', 'Driver Inattention/Distraction') THEN 'Yes' ELSE 'No' END
            AS high_impact_crash,
          CAST(date_trunc('month', CAST(substr(crash_date, 1, 10) AS DATE)) AS DATE) AS year_month_ts
        FROM vehicles_raw WHERE crash_date IS NOT NULL""",
    "persons_raw": """
        SELECT l_orderkey AS collision_id,
          CAST(CAST(o_orderdate + INTERVAL 22 YEARS AS DATE) AS VARCHAR)
            || ' 00:00:00.000000 UTC' AS crash_date,
          concat(l_orderkey % 24, ':', lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0')) AS crash_time,
          CASE l_returnflag WHEN 'R' THEN 'Occupant' WHEN 'A' THEN 'Pedestrian'
            WHEN 'N' THEN 'Bicyclist' END AS person_type,
          CASE l_linenumber WHEN 1 THEN 'Killed' WHEN 2 THEN 'Injured' WHEN 3 THEN 'Unspecified'
            WHEN 4 THEN NULL WHEN 5 THEN 'Not Injured' ELSE 'Injured' END AS person_injury,
          l_partkey AS vehicle_id,
          CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_quantity) AS INTEGER) + 10 END AS person_age,
          CASE l_linestatus WHEN 'O' THEN 'Not Ejected' ELSE 'Ejected' END AS ejection,
          CASE l_linenumber % 4 WHEN 0 THEN 'Conscious' WHEN 1 THEN 'Shock' WHEN 2 THEN 'Unconscious'
            END AS emotional_status,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Does Not Apply' WHEN '2-HIGH' THEN NULL
            ELSE o_orderpriority END AS bodily_injury,
          CASE WHEN l_linenumber = 1 THEN 'Driver' ELSE 'Passenger' END AS position_in_vehicle,
          CASE WHEN l_linenumber <> 2 THEN 'Lap Belt' END AS safety_equipment,
          CASE l_suppkey % 5 WHEN 0 THEN 'Unspecified' WHEN 2 THEN 'Driver Inexperience'
            WHEN 3 THEN 'Unsafe Speed'
            WHEN 4 THEN 'Pedestrian/Bicyclist/Other Pedestrian Error/Confusion' END
            AS contributing_factor_1,
          concat('Factor ', l_suppkey % 3) AS contributing_factor_2,
          CASE l_linestatus WHEN 'O' THEN 'M' ELSE 'F' END AS person_sex
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "persons": """
        SELECT collision_id, CAST(substr(crash_date, 1, 10) AS DATE) AS crash_date, crash_time,
          person_type, coalesce(person_injury, 'Unknown') AS person_injury, vehicle_id, person_age,
          ejection, coalesce(emotional_status, 'Unknown') AS emotional_status,
          coalesce(bodily_injury, 'Unknown') AS bodily_injury, position_in_vehicle,
          coalesce(safety_equipment, 'Unknown') AS safety_equipment,
          coalesce(contributing_factor_1, 'Unknown') AS contributing_factor_1,
          contributing_factor_2, person_sex,
          CAST(year(CAST(substr(crash_date, 1, 10) AS DATE)) AS INTEGER) AS year,
          CAST(month(CAST(substr(crash_date, 1, 10) AS DATE)) AS INTEGER) AS month,
          CASE WHEN CAST(split_part(crash_time, ':', 1) AS INTEGER) < 6 THEN 'Night'
            WHEN CAST(split_part(crash_time, ':', 1) AS INTEGER) < 12 THEN 'Morning'
            WHEN CAST(split_part(crash_time, ':', 1) AS INTEGER) < 18 THEN 'Afternoon'
            ELSE 'Evening' END AS part_of_day,
          CASE WHEN dayofweek(CAST(substr(crash_date, 1, 10) AS DATE)) IN (0, 6) THEN 'Weekend'
            ELSE 'Weekday' END AS weekday_weekend,
          CASE WHEN person_age IS NULL THEN 'Unknown' WHEN person_age < 18 THEN '<18'
            WHEN person_age < 25 THEN '18-24' WHEN person_age < 35 THEN '25-34'
            WHEN person_age < 45 THEN '35-44' WHEN person_age < 55 THEN '45-54'
            WHEN person_age < 65 THEN '55-64' ELSE '65+' END AS age_category,
          CASE WHEN person_injury = 'Killed' THEN 5 WHEN person_injury LIKE '%Injured%' THEN 3
            WHEN person_injury = 'Unspecified' THEN 1 ELSE 0 END AS injury_severity,
          CAST(date_trunc('month', CAST(substr(crash_date, 1, 10) AS DATE)) AS DATE) AS year_month_ts
        FROM persons_raw""",
    "weather_raw": """
        SELECT CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN NULL
            ELSE l_shipdate + INTERVAL 22 YEARS + to_hours(l_partkey % 24) END AS stamp,
          CASE WHEN l_linenumber = 6 THEN 'n/a'
            ELSE concat(CAST(floor(l_quantity) AS INTEGER), '.0 m asl') END AS elevation,
          CASE r_name WHEN 'AFRICA' THEN 'Brooklyn' WHEN 'AMERICA' THEN 'Manhattan'
            WHEN 'ASIA' THEN 'Queens' WHEN 'EUROPE' THEN 'Bronx' ELSE 'Staten Island' END AS burrough,
          l_suppkey * 0.0002::DOUBLE + 40.71003::DOUBLE AS lattitude,
          l_suppkey * 0.0002::DOUBLE - 74.00003::DOUBLE AS longitude,
          CASE WHEN l_linenumber <> 5 THEN l_quantity - 20.123::DOUBLE END AS temperature_2m,
          CASE WHEN l_linenumber <> 4 THEN l_quantity * 2 END AS relative_humidity_2m,
          l_quantity - 25 AS dew_point_2m, l_quantity - 22 AS apparent_temperature,
          l_discount + l_tax AS precipitation, l_discount + 0.0::DOUBLE AS rain,
          l_tax + 0.0::DOUBLE AS snowfall, l_tax * 10 + 0.0::DOUBLE AS snow_depth,
          CAST(l_linenumber AS DOUBLE) AS weather_code,
          CASE WHEN l_linenumber <> 3 THEN l_quantity + 988 END AS pressure_msl,
          l_quantity + 980 AS surface_pressure, l_quantity * 2 AS cloud_cover,
          l_quantity / 2 AS wind_speed_10m, l_extendedprice AS wind_gusts_10m,
          CAST(l_partkey % 2 AS DOUBLE) AS is_day, l_quantity * 60 AS sunshine_duration
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
          JOIN regions ON s_nationkey = n_nationkey""",
    "weather_stats": """
        SELECT avg(rain) AS m_rain, stddev_samp(rain) AS s_rain, avg(snowfall) AS m_snow,
          stddev_samp(snowfall) AS s_snow, avg(wind_gusts_10m) AS m_gust,
          stddev_samp(wind_gusts_10m) AS s_gust
        FROM weather_raw WHERE stamp IS NOT NULL""",
    "weather": """
        SELECT stamp AS weather_timestamp, CAST(stamp AS DATE) AS date, elevation, burrough,
          round(lattitude, 4) AS lattitude, round(longitude, 4) AS longitude,
          round(temperature_2m, 2) AS temperature_2m, relative_humidity_2m, dew_point_2m,
          apparent_temperature, rain, snowfall, snow_depth, pressure_msl, wind_speed_10m,
          sunshine_duration, cloud_cover, wind_gusts_10m,
          CAST(year(stamp) AS INTEGER) AS year, CAST(month(stamp) AS INTEGER) AS month,
          CAST(day(stamp) AS INTEGER) AS day, CAST(hour(stamp) AS INTEGER) AS hour_of_day,
          CASE WHEN rain < m_rain - s_rain THEN 'Low Rainfall'
            WHEN rain > m_rain + s_rain THEN 'High Rainfall' ELSE 'Moderate Rainfall' END
            AS rainfall_category,
          CASE WHEN snowfall < m_snow - s_snow THEN 'Low Snowfall'
            WHEN snowfall > m_snow + s_snow THEN 'High Snowfall' ELSE 'Moderate Snowfall' END
            AS snowfall_category,
          CASE WHEN wind_gusts_10m < m_gust - s_gust THEN 'Low Gusts'
            WHEN wind_gusts_10m > m_gust + s_gust THEN 'High Gusts' ELSE 'Moderate Gusts' END
            AS wind_gusts_category,
          TRY_CAST(regexp_extract(elevation, '\\d+\\.?\\d*') AS DOUBLE) AS elevation_m,
          CASE WHEN round(temperature_2m, 2) < 0 THEN 'Below Freezing' ELSE 'Above Freezing' END
            AS temperature_category,
          CASE WHEN relative_humidity_2m < 50 THEN 'Low Humidity' ELSE 'High Humidity' END
            AS humidity_range,
          CASE WHEN pressure_msl > 1013.25 THEN 'High Pressure' ELSE 'Low Pressure' END
            AS pressure_condition,
          CASE WHEN wind_speed_10m > 20 THEN 'High Wind' ELSE 'Low Wind' END AS wind_intensity,
          CAST(date_trunc('month', stamp) AS DATE) AS year_month_ts
        FROM weather_raw, weather_stats WHERE stamp IS NOT NULL""",
    "traffic_raw": """
        SELECT CAST(event_id AS INTEGER) AS id, value AS speed,
          CAST(floor(value * 10) AS INTEGER) AS travel_time,
          CAST(user_id % 2 AS INTEGER) AS status,
          CASE WHEN event_type = 'signup' AND user_id % 7 = 0 THEN NULL
            ELSE ts - to_days(CAST(event_id % 2400 + 183 AS INTEGER)) END AS data_as_of,
          CAST(user_id AS VARCHAR) AS link_id,
          CASE WHEN event_type <> 'view' THEN 'City' END AS owner,
          CASE user_id % 5 WHEN 0 THEN 'Brooklyn' WHEN 1 THEN 'Manhattan' WHEN 2 THEN 'Queens'
            WHEN 3 THEN 'Bronx' ELSE 'Staten Island' END AS borough,
          event_type AS link_name
        FROM events""",
    "traffic_stats": """
        SELECT avg(speed) AS m_speed, stddev_samp(speed) AS s_speed, avg(travel_time) AS m_time,
          stddev_samp(travel_time) AS s_time
        FROM traffic_raw WHERE data_as_of IS NOT NULL""",
    "traffic": """
        SELECT id, speed, travel_time, status, data_as_of, link_id, 'Unknown' AS link_points,
          'Unknown' AS encoded_poly_line, 'Unknown' AS encoded_poly_line_lvls,
          coalesce(owner, 'Unknown') AS owner, 'Unknown' AS transcom_id, borough, link_name,
          CAST(data_as_of AS DATE) AS crash_timestamp,
          CAST(year(data_as_of) AS INTEGER) AS year, CAST(month(data_as_of) AS INTEGER) AS month,
          CAST(dayofweek(data_as_of) + 1 AS INTEGER) AS day_of_week,
          CAST(hour(data_as_of) AS INTEGER) AS hour,
          CASE WHEN speed < m_speed - s_speed THEN 'Low' WHEN speed < m_speed + s_speed
            THEN 'Average' ELSE 'High' END AS speed_band,
          CASE WHEN travel_time < m_time - s_time THEN 'Quick' WHEN travel_time > m_time + s_time
            THEN 'Slow' ELSE 'Normal' END AS travel_time_category,
          CASE WHEN hour(data_as_of) BETWEEN 0 AND 5 THEN 'Late Night'
            WHEN hour(data_as_of) BETWEEN 6 AND 11 THEN 'Morning'
            WHEN hour(data_as_of) BETWEEN 12 AND 17 THEN 'Afternoon' ELSE 'Evening' END AS time_slot,
          CASE WHEN dayofweek(data_as_of) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS week_part,
          CAST(date_trunc('month', data_as_of) AS DATE) AS year_month_ts
        FROM traffic_raw, traffic_stats WHERE data_as_of IS NOT NULL""",
    "taxi_raw": """
        SELECT l_linenumber % 3 + 1 AS VendorID,
          o_orderdate + to_seconds(l_suppkey * 37 % 86400) AS tpep_pickup_datetime,
          l_shipdate + to_seconds(l_partkey * 53 % 86400) AS tpep_dropoff_datetime,
          l_linenumber AS passenger_count, l_quantity AS trip_distance,
          CASE WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN NULL ELSE l_linenumber END
            AS RatecodeID,
          CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END
            AS store_and_fwd_flag,
          CAST(l_suppkey % 265 AS INTEGER) AS PULocationID,
          CAST(l_partkey % 265 AS INTEGER) AS DOLocationID,
          l_linenumber % 7 AS payment_type, l_extendedprice AS fare_amount,
          l_discount + 0.0::DOUBLE AS extra, l_tax + 0.0::DOUBLE AS mta_tax,
          l_quantity / 4 AS tip_amount, l_quantity / 8 AS tolls_amount,
          0.5::DOUBLE AS improvement_surcharge, o_totalprice AS total_amount,
          2.5::DOUBLE AS congestion_surcharge, 1.25::DOUBLE AS airport_fee
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "model": f"""
        SELECT standardized.*, {_listed("vehicles", MODEL_VEHICLE_COLUMNS)},
          {_listed("persons", MODEL_PERSON_COLUMNS)}
        FROM vehicles JOIN persons USING (collision_id) JOIN standardized USING (collision_id)""",
    "crash_weather": """
        SELECT m.*, w.temperature_2m, w.relative_humidity_2m, w.pressure_msl, w.wind_speed_10m,
          w.sunshine_duration, w.rainfall_category, w.snowfall_category
        FROM model m JOIN weather w
          ON m.standardized_borough = w.burrough AND m.crash_date = w.date""",
    "crash_traffic": """
        SELECT m.*, t.speed, t.status, t.travel_time
        FROM model m JOIN traffic t
          ON m.standardized_borough = t.borough AND m.crash_date = t.crash_timestamp""",
    "traffic_weather": """
        SELECT t.*, w.temperature_2m, w.relative_humidity_2m, w.pressure_msl, w.wind_speed_10m,
          w.sunshine_duration, w.rainfall_category, w.snowfall_category
        FROM traffic t JOIN weather w
          ON t.borough = w.burrough AND CAST(t.data_as_of AS DATE) = w.date""",
    "runs": """
        SELECT event_type AS process_name,
          CASE WHEN user_id % 3 <> 0 THEN 'Success' ELSE 'Failure' END AS process_status,
          ts AS insert_ts, CASE WHEN user_id % 11 <> 0 THEN ts END AS last_timestamp_loaded
        FROM events""",
}

# Which CTEs each CTE reads, in an order that defines before use.
_NEEDS = {
    "crashes_raw": ["regions"],
    "crashes": ["crashes_raw"],
    "standardized": ["crashes", "aliases"],
    "vehicles": ["vehicles_raw"],
    "persons": ["persons_raw"],
    "weather_raw": ["regions"],
    "weather_stats": ["weather_raw"],
    "weather": ["weather_raw", "weather_stats"],
    "traffic_stats": ["traffic_raw"],
    "traffic": ["traffic_raw", "traffic_stats"],
    "model": ["standardized", "vehicles", "persons"],
    "crash_weather": ["model", "weather"],
    "crash_traffic": ["model", "traffic"],
    "traffic_weather": ["traffic", "weather"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _sql(query: str, *ctes: str) -> str:
    """The query with the CTEs it reads in front; a leading comma adds CTEs of its own."""
    parts = ",\n".join(f"{name} AS ({_CTES[name]})" for name in _closure(list(ctes)))
    query = query.strip()
    if query.startswith(","):
        return f"WITH {parts}{query}"
    return f"WITH {parts}\n{query}" if parts else query


_MONTH = "CAST(date_trunc('month', {0}) AS DATE)"
_YEAR = "CAST(date_trunc('year', {0}) AS DATE)"


_TRAFFIC_DAY = """id, speed, travel_time, status,
  CASE WHEN data_as_of IS NULL THEN 'n/a' ELSE strftime(data_as_of, '%Y-%m-%dT%H:%M:%S') END AS data_as_of,
  link_id, NULL::VARCHAR AS link_points, NULL::VARCHAR AS encoded_poly_line,
  NULL::VARCHAR AS encoded_poly_line_lvls, owner, NULL::VARCHAR AS transcom_id, borough, link_name"""


def oracle_sql() -> dict[str, str]:
    month, year = _MONTH.format("crash_date"), _YEAR.format("crash_date")
    found = {
        # ---- enrichment, row by row
        "crash_enrich": _sql("SELECT * FROM crashes", "crashes"),
        "person_enrich": _sql("SELECT * FROM persons", "persons"),
        "vehicle_enrich": _sql("SELECT * FROM vehicles", "vehicles"),
        "traffic_enrich": _sql("SELECT * FROM traffic", "traffic"),
        "weather_enrich": _sql("SELECT * FROM weather", "weather"),
        "taxi_decode": _sql(
            f"""
            SELECT coalesce(vendor, 'Other') AS vendor_name,
              tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
              date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime)
                AS trip_duration_minutes,
              passenger_count, trip_distance, coalesce(rate, 'Unknown rate code') AS rate_description,
              store_and_fwd_flag = 'Y' AS is_store_and_forward,
              coalesce(payment, 'Other') AS payment_method,
              fare_amount, extra, mta_tax, tip_amount, tolls_amount,
              improvement_surcharge AS imp_surcharge, airport_fee, total_amount,
              PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
              CAST(year(tpep_pickup_datetime) AS INTEGER) AS data_file_year,
              CAST(month(tpep_pickup_datetime) AS INTEGER) AS data_file_month
            FROM taxi_raw
              LEFT JOIN {_codes(TAXI_VENDORS)} vendors(vendor_code, vendor) ON VendorID = vendor_code
              LEFT JOIN {_codes(TAXI_RATES)} rates(rate_code, rate) ON RatecodeID = rate_code
              LEFT JOIN {_codes(TAXI_PAYMENTS)} payments(payment_code, payment)
                ON payment_type = payment_code""",
            "taxi_raw",
        ),
        # ---- banding
        "traffic_bands": _sql(
            """
            SELECT speed_band, travel_time_category, time_slot, week_part, count(*) AS readings
            FROM traffic GROUP BY 1, 2, 3, 4""",
            "traffic",
        ),
        "weather_bands": _sql(
            """
            SELECT rainfall_category, snowfall_category, wind_gusts_category, temperature_category,
              humidity_range, pressure_condition, wind_intensity, count(*) AS readings
            FROM weather GROUP BY ALL""",
            "weather",
        ),
        "band_stats": _sql(
            """
            SELECT round(avg(speed) + 1e-9, 6) AS mean_speed, round(stddev_samp(speed) + 1e-9, 6) AS stddev_speed,
              round(avg(travel_time) + 1e-9, 6) AS mean_travel_time,
              round(stddev_samp(travel_time) + 1e-9, 6) AS stddev_travel_time
            FROM traffic_raw""",
            "traffic_raw",
        ),
        # ---- cleaning
        "null_fill": """
            SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'P' THEN 'Unknown' ELSE o_orderstatus END AS status,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'Unknown' ELSE o_orderpriority END AS priority,
              CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price
            FROM orders""",
        "lenient_cast": """
            SELECT l_orderkey, l_linenumber,
              CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN l_linenumber END AS line,
              CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS price,
              CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS shipped
            FROM lineitem""",
        "bad_values": """
            SELECT count(*) AS landed, count(*) FILTER (l_returnflag = 'A') AS bad_line,
              count(*) FILTER (l_linestatus = 'F') AS bad_price,
              count(*) FILTER (l_returnflag = 'R') AS bad_shipped
            FROM lineitem""",
        "text_number": """
            SELECT l_orderkey, l_linenumber,
              CASE WHEN l_linestatus = 'F' THEN NULL
                WHEN l_returnflag = 'R' THEN CAST(floor(l_quantity) AS DOUBLE)
                ELSE l_extendedprice END AS number
            FROM lineitem""",
        "date_patterns": """
            SELECT o_orderkey,
              CASE WHEN o_orderkey % 7 <> 6 THEN o_orderdate END AS parsed,
              CASE WHEN o_orderkey % 7 <> 6 THEN CAST(o_orderdate AS DATE) END AS parsed_date,
              CASE WHEN o_custkey % 3 <> 2 THEN CAST(o_custkey % 24 AS INTEGER) END AS hour
            FROM orders""",
        "canonical_names": _sql(
            """
            SELECT borough, standardized_borough, count(*) AS crashes
            FROM standardized GROUP BY 1, 2""",
            "standardized",
        ),
        "calendar_periods": """
            SELECT event_id, CAST(date_trunc('year', ts) AS DATE) AS year_start,
              CAST(date_trunc('month', ts) AS DATE) AS month_start,
              CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) AS week_start,
              strftime(ts, '%Y-%m') AS month_key
            FROM events""",
        # ---- slices, series, resume
        "time_slice": """
            SELECT w AS window_number, o_orderkey, o_orderdate
            FROM orders, range(7) AS t(w)
            WHERE o_orderdate >= TIMESTAMP '1995-01-01' + to_days(CAST(365 * w AS INTEGER))
              AND o_orderdate <= TIMESTAMP '1995-01-01' + to_days(CAST(365 * (w + 1) AS INTEGER))""",
        "time_slice_left": """
            SELECT CAST(floor(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) / 365) AS INTEGER)
              AS window_number, o_orderkey, o_orderdate
            FROM orders""",
        "month_slice": """
            SELECT o_orderkey, o_orderdate, 1997 AS data_file_year, 3 AS data_file_month
            FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'""",
        "resume_point": _sql(
            """
            SELECT process_name,
              coalesce(max_by(last_timestamp_loaded, insert_ts)
                FILTER (process_status = 'Success' AND last_timestamp_loaded IS NOT NULL
                  AND insert_ts = newest), TIMESTAMP '2009-01-01') AS resume_from
            FROM runs JOIN (SELECT process_name AS p, max(insert_ts) AS newest FROM runs
              WHERE process_status = 'Success' GROUP BY 1) ON p = process_name
            GROUP BY process_name""",
            "runs",
        ),
        "latest_run": _sql(
            """
            SELECT process_name, process_status, insert_ts, last_timestamp_loaded
            FROM runs ORDER BY insert_ts DESC, process_name DESC LIMIT 1""",
            "runs",
        ),
        "hourly_series": """
            SELECT o_orderkey, CAST(o_custkey % 5 AS INTEGER) AS site,
              o_orderdate + to_hours(i) AS reading_time, o_totalprice + i AS temperature,
              CASE WHEN o_orderkey % 5 <> 2 THEN CAST(i AS BIGINT) END AS sparse_series
            FROM orders, range(6) AS t(i)
            WHERE i * 60 < (o_orderkey % 5) * 60 + 30""",
        "located_windows": """
            SELECT c_custkey, c_name AS burrough, CAST(c_acctbal AS DOUBLE) AS lattitude,
              TIMESTAMP '2009-01-01' AS "start", TIMESTAMP '2009-03-02' AS "end"
            FROM customer""",
        "location_tags": _sql(
            """
            SELECT stamp, burrough,
              CASE burrough WHEN 'Manhattan' THEN 40.71 WHEN 'Brooklyn' THEN 40.67
                WHEN 'Queens' THEN 40.71 WHEN 'Bronx' THEN 40.85 ELSE 40.57 END::DOUBLE AS lattitude,
              CASE burrough WHEN 'Manhattan' THEN -74.00 WHEN 'Brooklyn' THEN -73.97
                WHEN 'Queens' THEN -73.80 WHEN 'Bronx' THEN -73.93 ELSE -74.07 END::DOUBLE
                AS longitude,
              temperature_2m
            FROM weather_raw""",
            "weather_raw",
        ),
        # ---- model and views
        "model_rows": _sql("SELECT * FROM model", "model"),
        "crash_weather_rows": _sql(
            "SELECT * FROM crash_weather WHERE year(crash_date) = 2020 AND month(crash_date) = 3",
            "crash_weather",
        ),
        "crash_weather_all": _sql(
            """
            SELECT collision_id, count(*) AS view_rows, min(crash_date) AS first_day, max(crash_date) AS last_day,
              min(standardized_borough) AS place, sum(number_of_persons_injured) AS injured,
              sum(vehicle_year::BIGINT) AS vehicle_years, sum(person_age::BIGINT) AS ages,
              count(DISTINCT vehicle_type) AS vehicle_types, min(state_registration) AS first_state,
              max(vehicle_contributing_factor) AS last_factor, count(DISTINCT person_type) AS person_types,
              min(safety_equipment) AS first_equipment, count(ejection) AS ejections,
              round(min(temperature_2m), 6) AS coldest, round(max(temperature_2m), 6) AS warmest,
              round(min(pressure_msl), 6) AS lowest_pressure, round(max(wind_speed_10m), 6) AS strongest_wind,
              count(DISTINCT relative_humidity_2m) AS humidities, count(sunshine_duration) AS sunshine,
              min(rainfall_category) AS first_rain, max(snowfall_category) AS last_snow
            FROM crash_weather GROUP BY collision_id""",
            "crash_weather",
        ),
        "crash_traffic_rows": _sql("SELECT * FROM crash_traffic", "crash_traffic"),
        "traffic_weather_rows": _sql("SELECT * FROM traffic_weather", "traffic_weather"),
        # ---- the model as counts
        "unified_model": _sql(
            """
            SELECT collision_id, borough, standardized_borough, crash_date, count(*) AS model_rows
            FROM model GROUP BY 1, 2, 3, 4""",
            "model",
        ),
        "crash_weather": _sql(
            """
            SELECT standardized_borough, crash_date, rainfall_category, snowfall_category,
              count(*) AS view_rows
            FROM crash_weather GROUP BY 1, 2, 3, 4""",
            "crash_weather",
        ),
        "crash_weather_year": _sql(
            """
            SELECT vehicle_type, was_fatal, count(*) AS view_rows
            FROM crash_weather WHERE year(crash_date) = 2020 GROUP BY 1, 2""",
            "crash_weather",
        ),
        "crash_traffic": _sql(
            """
            SELECT standardized_borough, crash_date, status, count(*) AS view_rows
            FROM crash_traffic GROUP BY 1, 2, 3""",
            "crash_traffic",
        ),
        "traffic_weather": _sql(
            """
            SELECT borough, crash_timestamp, count(*) AS view_rows,
              round(avg(temperature_2m) + 1e-9, 6) AS average_temperature,
              round(avg(relative_humidity_2m) + 1e-9, 6) AS average_humidity
            FROM traffic_weather GROUP BY 1, 2""",
            "traffic_weather",
        ),
        # ---- reports
        "q01": _sql(
            f"""
            SELECT burrough, {_YEAR.format('weather_timestamp')} AS weather_year,
              round(sum(rain) + 1e-9, 4) AS total_rainfall, round(sum(snowfall) + 1e-9, 4) AS total_snowfall,
              max(snow_depth) AS max_snow_depth, round(avg(wind_gusts_10m) + 1e-9, 6) AS avg_wind_gusts,
              round(avg(wind_speed_10m) + 1e-9, 6) AS avg_wind_speed,
              round(avg(pressure_msl) + 1e-9, 6) AS avg_pressure_msl,
              round(avg(dew_point_2m) + 1e-9, 6) AS avg_dew_point,
              round(avg(relative_humidity_2m) + 1e-9, 6) AS avg_rel_humidity
            FROM weather GROUP BY 1, 2""",
            "weather",
        ),
        "q02": _sql(
            f"""
            SELECT {month} AS crash_month, borough, was_fatal, count(collision_id) AS collisions
            FROM model
            WHERE high_impact_crash IN ('Yes') AND crash_date >= DATE '2016-01-01'
              AND crash_date < DATE '2024-05-12'
            GROUP BY 1, 2, 3""",
            "model",
        ),
        "q03": _sql(
            """
            SELECT CAST(year(crash_date) AS INTEGER) AS year, vehicle_type, count(*) AS total
            FROM crash_weather GROUP BY 1, 2""",
            "crash_weather",
        ),
        "q04": _sql(
            """
            SELECT snowfall_category, rainfall_category, borough,
              count(collision_id) AS total_collisions
            FROM crash_weather WHERE was_fatal IN (TRUE) GROUP BY 1, 2, 3""",
            "crash_weather",
        ),
        "q05": _sql(
            """
            SELECT bodily_injury, emotional_status, age_category,
              count(DISTINCT collision_id) AS distinct_collisions
            FROM persons
            WHERE emotional_status IN ('Conscious', 'Unconscious', 'Semiconscious',
                'Apparent Death', 'Shock', 'Incoherent')
              AND NOT (bodily_injury IS NULL OR bodily_injury IN ('Does Not Apply', 'Unknown'))
            GROUP BY 1, 2, 3""",
            "persons",
        ),
        "q06": _sql(
            """
            SELECT person_contributing_factor_1, count(collision_id) AS collisions
            FROM crash_weather
            WHERE person_contributing_factor_1 IS NOT NULL AND person_contributing_factor_1 NOT IN
              ('Pedestrian/Bicyclist/Other Pedestrian Error/Confusion', 'Unknown', 'Unspecified')
            GROUP BY 1""",
            "crash_weather",
        ),
        "q07": _sql(
            f"""
            SELECT {year} AS crash_year, borough,
              CAST(sum(number_of_persons_killed) AS BIGINT) AS persons_killed
            FROM model GROUP BY 1, 2""",
            "model",
        ),
        "q08": _sql(
            f"""
            SELECT {month} AS crash_month, count(collision_id) AS collisions FROM model
            WHERE high_impact_crash IN ('Yes') AND crash_date >= DATE '2016-05-01'
              AND crash_date < DATE '2024-05-13'
            GROUP BY 1""",
            "model",
        ),
        "q09": _sql(
            f"""
            SELECT {month} AS crash_month,
              CAST(sum(number_of_persons_injured) AS BIGINT) AS persons_injured
            FROM model
            WHERE crash_date >= DATE '2012-01-01' AND crash_date < DATE '2024-05-01' GROUP BY 1""",
            "model",
        ),
        "q10": _sql(
            """
            SELECT count(DISTINCT collision_id) AS distinct_collisions FROM model
            WHERE high_impact_crash IN ('Yes') AND pre_crash IN ('Making Left Turn',
              'Making Right Turn on Red', 'Making Right Turn', 'Making Left Turn on Red',
              'Making U Turn')""",
            "model",
        ),
        "q11": _sql(
            """
            SELECT person_type, age_category, count(collision_id) AS total_cases FROM persons
            WHERE age_category NOT IN ('Unknown') GROUP BY 1, 2""",
            "persons",
        ),
        "q12": _sql(
            """
            SELECT crash_timestamp - CAST(dayofweek(crash_timestamp) AS INTEGER) AS week_start,
              week_part, speed_band, round(avg(speed) + 1e-9, 6) AS avg_speed
            FROM traffic GROUP BY 1, 2, 3""",
            "traffic",
        ),
        "q13": _sql(
            f"""
            SELECT {year} AS crash_year, borough, count(high_impact_crash) AS flagged
            FROM model GROUP BY 1, 2""",
            "model",
        ),
        "q14": _sql(
            """
            SELECT pre_crash, vehicle_damage, count(collision_id) AS occurrences FROM vehicles
            WHERE crash_date >= DATE '2017-05-13' AND crash_date < DATE '2024-05-13'
              AND vehicle_damage NOT IN ('Unknown', 'Other', 'No Damage')
            GROUP BY 1, 2""",
            "vehicles",
        ),
        "q15": _sql(
            """
            SELECT state_registration, count(collision_id) AS collisions FROM vehicles
            WHERE state_registration NOT IN ('Unknown') AND crash_date >= DATE '2023-01-01'
              AND crash_date < DATE '2024-05-13' AND high_impact_crash IN ('Yes')
            GROUP BY 1""",
            "vehicles",
        ),
        # ---- reports over collisions instead of model rows
        "q02_distinct": _sql(
            f"""
            SELECT {month} AS crash_month, borough, was_fatal, count(DISTINCT collision_id) AS collisions
            FROM model WHERE high_impact_crash = 'Yes' AND crash_date >= DATE '2016-01-01'
              AND crash_date < DATE '2024-05-12' GROUP BY ALL""",
            "model",
        ),
        "q07_distinct": _sql(
            f"""
            SELECT {year} AS crash_year, borough,
              CAST(sum(number_of_persons_killed) AS BIGINT) AS persons_killed
            FROM crashes WHERE collision_id IN (SELECT collision_id FROM model) GROUP BY ALL""",
            "model",
        ),
        "q08_distinct": _sql(
            f"""
            SELECT {month} AS crash_month, count(DISTINCT collision_id) AS collisions FROM model
            WHERE high_impact_crash = 'Yes' AND crash_date >= DATE '2016-05-01'
              AND crash_date < DATE '2024-05-13' GROUP BY ALL""",
            "model",
        ),
        "q09_distinct": _sql(
            f"""
            SELECT {month} AS crash_month,
              CAST(sum(number_of_persons_injured) AS BIGINT) AS persons_injured
            FROM crashes WHERE collision_id IN (SELECT collision_id FROM model)
              AND crash_date >= DATE '2012-01-01' AND crash_date < DATE '2024-05-01' GROUP BY ALL""",
            "model",
        ),
        "q13_distinct": _sql(
            f"""
            SELECT {year} AS crash_year, borough,
              count(DISTINCT collision_id) FILTER (high_impact_crash IS NOT NULL) AS flagged
            FROM model GROUP BY ALL""",
            "model",
        ),
        "p1_distinct": _sql(
            """
            , once AS (SELECT DISTINCT collision_id, borough, standardized_borough, crash_date FROM model)
            SELECT borough, crash_date, count(DISTINCT collision_id) AS total_crashes,
              round(avg(temperature_2m) + 1e-9, 6) AS average_temperature,
              round(avg(wind_speed_10m) + 1e-9, 6) AS average_wind_speed
            FROM once JOIN weather ON standardized_borough = burrough AND crash_date = date
            GROUP BY borough, crash_date""",
            "model",
            "weather",
        ),
        "p2_distinct": _sql(
            """
            , once AS (SELECT DISTINCT collision_id, standardized_borough, crash_date FROM model)
            SELECT crash_date, count(DISTINCT collision_id) AS total_crashes,
              round(avg(speed) + 1e-9, 6) AS average_speed
            FROM once JOIN traffic t ON standardized_borough = t.borough AND crash_date = crash_timestamp
            GROUP BY crash_date""",
            "model",
            "traffic",
        ),
        "p3_distinct": _sql(
            """
            , per_factor AS (
              SELECT borough, vehicle_contributing_factor AS factor,
                count(DISTINCT collision_id) AS crashes FROM model GROUP BY ALL),
            per_borough AS (SELECT borough, sum(crashes) AS crashes FROM per_factor GROUP BY ALL)
            SELECT f.borough, f.factor AS vehicle_contributing_factor, f.crashes AS total_crashes,
              round(f.crashes::DOUBLE / b.crashes * 100, 2) AS percentage_of_total,
              CAST(1 + count(o.factor) AS INTEGER) AS rank
            FROM per_factor f JOIN per_borough b ON b.borough = f.borough
              LEFT JOIN per_factor o ON o.borough = f.borough
                AND (o.crashes > f.crashes OR o.crashes = f.crashes AND o.factor < f.factor)
            GROUP BY f.borough, f.factor, f.crashes, b.crashes HAVING count(o.factor) < 5""",
            "model",
        ),
        "p1": _sql(
            """
            SELECT borough, crash_date, count(collision_id) AS total_crashes,
              round(avg(temperature_2m) + 1e-9, 6) AS average_temperature,
              round(avg(wind_speed_10m) + 1e-9, 6) AS average_wind_speed
            FROM crash_weather GROUP BY 1, 2""",
            "crash_weather",
        ),
        "p2": _sql(
            """
            SELECT crash_date, count(collision_id) AS total_crashes,
              round(avg(speed) + 1e-9, 6) AS average_speed
            FROM crash_traffic GROUP BY 1""",
            "crash_traffic",
        ),
        # Per borough and factor the crashes, against the borough's total; a factor's rank is one more
        # than the number of factors of its borough that come before it.
        "p3": _sql(
            """
            , per_factor AS (
              SELECT borough, vehicle_contributing_factor AS factor, count(*) AS crashes
              FROM model GROUP BY ALL),
            per_borough AS (SELECT borough, count(*) AS crashes FROM model GROUP BY ALL)
            SELECT f.borough, f.factor AS vehicle_contributing_factor, f.crashes AS total_crashes,
              round(f.crashes::DOUBLE / b.crashes * 100, 2) AS percentage_of_total,
              CAST(1 + count(o.factor) AS INTEGER) AS rank
            FROM per_factor f
              JOIN per_borough b ON b.borough = f.borough
              LEFT JOIN per_factor o ON o.borough = f.borough
                AND (o.crashes > f.crashes OR o.crashes = f.crashes AND o.factor < f.factor)
            GROUP BY f.borough, f.factor, f.crashes, b.crashes HAVING count(o.factor) < 5""",
            "model",
        ),
        # Ages at the crash over the rows of the weather view, once more per vehicle of the collision.
        "p4": _sql(
            """
            SELECT view.borough, own.vehicle_type,
              round(avg(age) + 1e-9, 6) AS average_vehicle_age,
              round(avg(age) FILTER (view.number_of_persons_injured >= 3) + 1e-9, 6)
                AS average_vehicle_age_high_impact,
              round(avg(age) + 1e-9, 6) AS average_vehicle_age_by_type,
              round(avg(age) FILTER (view.number_of_persons_killed > 0) + 1e-9, 6)
                AS average_vehicle_age_with_fatalities,
              round(avg(view.temperature_2m) + 1e-9, 6) AS average_temperature,
              round(avg(view.wind_speed_10m) + 1e-9, 6) AS average_wind_speed
            FROM (SELECT collision_id, crash_date, vehicle_type,
                year(crash_date) - vehicle_year AS age FROM vehicles) own
              JOIN crash_weather AS view USING (collision_id, crash_date)
            GROUP BY ALL""",
            "crash_weather",
            "vehicles",
        ),
        "factor_share": _sql(
            """
            SELECT borough, vehicle_contributing_factor, total_crashes,
              round(total_crashes / sum(total_crashes) OVER (PARTITION BY borough) + 1e-9, 6) AS share
            FROM (SELECT borough, vehicle_contributing_factor, count(*) AS total_crashes
              FROM model GROUP BY 1, 2)""",
            "model",
        ),
        # ---- loads
        "file_stream_load": _sql(f"SELECT {_TRAFFIC_DAY} FROM traffic_raw", "traffic_raw"),
        "run_metrics": """
            SELECT 'load-orders' AS process_name, 'Success' AS process_status,
              count(*) AS processed_rows, max(o_orderdate) AS last_timestamp_loaded FROM orders
            UNION ALL
            SELECT 'load-lineitem', 'Success', count(*), max(l_shipdate) FROM lineitem
            UNION ALL
            SELECT 'load-events', 'Success', count(*), max(ts) FROM events""",
        "incremental_load": "SELECT * FROM events",
        "incremental_runs": """
            SELECT CAST(i + 1 AS INTEGER) AS run, TIMESTAMP '2024-01-16' AS last_timestamp_loaded,
              count(*) AS processed_rows
            FROM events, range(2) AS t(i)
            WHERE ts >= TIMESTAMP '2024-01-01' + to_days(CAST(15 * i AS INTEGER))
              AND ts < TIMESTAMP '2024-01-01' + to_days(CAST(15 * (i + 1) AS INTEGER))
            GROUP BY i""",
        "incremental_late_rows": "SELECT * FROM events",
        "late_merge": "SELECT * FROM events",
        "band_stats_kept": """
            SELECT round(avg(value) + 1e-9, 6) AS mean_value, round(stddev_samp(value) + 1e-9, 6) AS stddev_value
            FROM events""",
        "monthly_load": """
            SELECT o_orderkey, o_orderdate, o_orderpriority,
              CAST(year(o_orderdate) AS INTEGER) AS data_file_year,
              CAST(month(o_orderdate) AS INTEGER) AS data_file_month
            FROM orders WHERE o_orderdate < TIMESTAMP '1995-03-01'""",
        "corrupt_records": """
            SELECT load, count(*) AS landed, count(*) FILTER (event_id % 7 = 0) AS corrupt,
              count(*) FILTER (event_id % 7 <> 0) AS readable
            FROM events, (VALUES ('batch'), ('stream')) t(load) GROUP BY load""",
        "batch_load_crashes": _sql("SELECT * FROM crashes_raw", "crashes_raw"),
        "batch_load_persons": _sql("SELECT * FROM persons_raw", "persons_raw"),
        "batch_load_vehicles": _sql("SELECT * FROM vehicles_raw", "vehicles_raw"),
        "batch_load_taxi": _sql("SELECT * FROM taxi_raw", "taxi_raw"),
        "batch_load_weather": _sql("SELECT * FROM weather_raw", "weather_raw"),
        "batch_load_traffic": _sql(f"SELECT {_TRAFFIC_DAY} FROM traffic_raw", "traffic_raw"),
        "batch_load_again": _sql(f"SELECT {_TRAFFIC_DAY} FROM traffic_raw", "traffic_raw"),
        "header_drift": _sql(
            f"""
            SELECT load, {_TRAFFIC_DAY} FROM (
              SELECT * REPLACE (
                CASE WHEN id % 3 <> 1 THEN owner END AS owner, CASE WHEN id % 3 <> 1 THEN link_name END AS link_name)
              FROM traffic_raw), (VALUES ('batch'), ('stream')) t(load)""",
            "traffic_raw",
        ),
        "json_array_load": """
            SELECT CAST(event_id AS INTEGER) AS id, value AS speed, '}"],[{' || event_type ||
              CASE WHEN event_id % 5 = 0 THEN '\\' ELSE chr(10) || '\\"' END AS link_name
            FROM events""",
        "csv_roundtrip": "SELECT * FROM customer",
        "json_roundtrip": "SELECT event_id, ts, user_id, event_type, value FROM events",
        "parquet_partitioned": """
            SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month
            FROM orders""",
        "prod_tables": _sql(
            """
            SELECT year, month, high_impact_crash, part_of_day, count(*) AS vehicles
            FROM vehicles GROUP BY 1, 2, 3, 4""",
            "vehicles",
        ),
    }
    # Distinct collisions by month, year and over all.
    periods = f"""(SELECT *, 'month' AS unit, {month} AS period FROM {{0}} UNION ALL
        SELECT *, 'year', {year} FROM {{0}} UNION ALL SELECT *, 'all', CAST(NULL AS DATE) FROM {{0}})"""
    count = "CAST(count(DISTINCT collision_id) AS BIGINT) AS distinct_collisions"
    found["q05_rollup"] = _sql(
        f"""
        SELECT bodily_injury, emotional_status, age_category, unit, period, {count}
        FROM {periods.format("persons")}
        WHERE emotional_status IN ('Conscious', 'Unconscious', 'Semiconscious',
            'Apparent Death', 'Shock', 'Incoherent')
          AND NOT (bodily_injury IS NULL OR bodily_injury IN ('Does Not Apply', 'Unknown'))
        GROUP BY 1, 2, 3, 4, 5""",
        "persons",
    )
    found["q10_rollup"] = _sql(
        f"""
        SELECT unit, period, {count} FROM {periods.format("model")}
        WHERE high_impact_crash IN ('Yes') AND pre_crash IN ('Making Left Turn',
          'Making Right Turn on Red', 'Making Right Turn', 'Making Left Turn on Red', 'Making U Turn')
        GROUP BY 1, 2""",
        "model",
    )
    # Stored models answer as the model does.
    found |= {f"{q}_stored": found[q] for q in (
        "model_rows", "q02", "q03", "q06", "q08", "q09", "q10", "q13", "p3", "p4")}
    found["model_refresh"] = found["model_rows"]
    found["compacted_runs"] = found["incremental_runs"]
    return found
