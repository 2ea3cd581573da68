"""Test tables in the shape of the feeds.

The star schema has no nulls, no text to parse and no aliases, so the adapters put some in, by rules
over the row's own values. Order dates move forward 22 years into the range the reports ask for, and
event times move back by 183 to 2,582 days so that readings fall on crash days.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LOCATION_SCHEMA, LOCATIONS

# The test tables' columns. Given, they save a footer scan per table and query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

CANONICAL = """CASE r_name WHEN 'AFRICA' THEN 'Brooklyn' WHEN 'AMERICA' THEN 'Manhattan'
    WHEN 'ASIA' THEN 'Queens' WHEN 'EUROPE' THEN 'Bronx' ELSE 'Staten Island' END"""
ALIAS = """CASE r_name WHEN 'AFRICA' THEN 'Kings' WHEN 'AMERICA' THEN 'New York'
    WHEN 'ASIA' THEN 'queens' WHEN 'EUROPE' THEN 'bx' ELSE 'Richmond County' END"""
CRASH_DAY = "string(date(o_orderdate + interval 22 years))"


def _clock(hours: str, minutes: str) -> str:
    return f"concat({hours} % 24, ':', lpad({minutes} % 60, 2, '0'))"


@dataclass(frozen=True)
class Feeds:
    """The raw feeds of one scale-factor folder."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def locations(self) -> DataFrame:
        return self.spark.createDataFrame(list(LOCATIONS), LOCATION_SCHEMA)

    def _join(self, left: DataFrame, right: str, left_key: str, right_key: str) -> DataFrame:
        other = self.table(right)
        return left.join(other, left[left_key] == other[right_key])

    def _regions_of(self, df: DataFrame, nation_key: str) -> DataFrame:
        nations = self._join(df, "nation", nation_key, "n_nationkey")
        return self._join(nations, "region", "n_regionkey", "r_regionkey")

    def crashes(self) -> DataFrame:
        orders = self._join(self.table("orders"), "customer", "o_custkey", "c_custkey")
        return self._regions_of(orders, "c_nationkey").selectExpr(
            "o_orderdate + interval 22 years AS crash_date",
            f"{_clock('o_custkey', 'o_orderkey')} AS crash_time",
            f"""CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                WHEN o_orderstatus = 'F' THEN {ALIAS} ELSE {CANONICAL} END AS borough""",
            "int(o_custkey % 300 + 10000) AS zip_code",
            "double(o_custkey % 1000) / 1000 + 40.5D AS latitude",
            "double(o_custkey % 1000) / 1000 - 74.5D AS longitude",
            "int(o_orderkey % 5) AS number_of_persons_injured",
            """CASE WHEN o_orderkey % 10 = 3 THEN NULL WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END
                AS number_of_persons_killed""",
            "int(o_orderkey % 2) AS number_of_pedestrians_injured",
            "0 AS number_of_pedestrians_killed",
            "int(o_orderkey % 3) AS number_of_cyclist_injured",
            "0 AS number_of_cyclist_killed",
            "int(o_orderkey % 4) AS number_of_motorist_injured",
            "0 AS number_of_motorist_killed",
            "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS contributing_factor_vehicle_1",
            "CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Sedan' END AS vehicle_type_code1",
            "CASE WHEN o_orderstatus = 'O' THEN 'Taxi' END AS vehicle_type_code2",
            "o_orderkey AS collision_id",
        )

    def _lines(self) -> DataFrame:
        return self._join(self.table("lineitem"), "orders", "l_orderkey", "o_orderkey")

    def vehicles(self) -> DataFrame:
        parts = self._join(self._lines(), "part", "l_partkey", "p_partkey")
        suppliers = self._join(parts, "supplier", "l_suppkey", "s_suppkey")
        return self._join(suppliers, "nation", "s_nationkey", "n_nationkey").selectExpr(
            "l_orderkey AS collision_id",
            f"""CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN NULL
                WHEN l_linenumber % 3 = 0 THEN {CRASH_DAY}
                WHEN l_linenumber % 3 = 1 THEN concat({CRASH_DAY}, 'T00:00:00')
                ELSE concat({CRASH_DAY}, 'T00:00:00.000') END AS crash_date""",
            f"CASE WHEN l_linenumber <> 6 THEN {_clock('l_partkey', 'l_suppkey')} END AS crash_time",
            "CASE WHEN l_linenumber <> 5 THEN n_name END AS state_registration",
            "CASE WHEN l_linenumber <> 4 THEN p_size + 1985 END AS vehicle_year",
            "p_type AS vehicle_type",
            """CASE l_returnflag WHEN 'R' THEN 'Making Left Turn'
                WHEN 'A' THEN 'Going Straight Ahead' WHEN 'N' THEN 'Making U Turn' END
                AS pre_crash""",
            """CASE p_brand WHEN 'Brand#1' THEN 'Lost Consciousness'
                WHEN 'Brand#2' THEN 'Driver Inattention/Distraction' WHEN 'Brand#3' THEN NULL
                ELSE p_brand END AS contributing_factor_1""",
            """CASE WHEN l_linenumber = 1 THEN 'No Damage' WHEN l_linenumber = 2 THEN 'Other'
                WHEN l_linenumber = 3 THEN NULL WHEN l_linestatus = 'O' THEN 'Center Front End'
                ELSE 'Left Rear Quarter Panel' END AS vehicle_damage""",
        )

    def persons(self) -> DataFrame:
        return self._lines().selectExpr(
            "l_orderkey AS collision_id",
            f"concat({CRASH_DAY}, ' 00:00:00.000000 UTC') AS crash_date",
            f"{_clock('l_orderkey', 'l_suppkey')} AS crash_time",
            """CASE l_returnflag WHEN 'R' THEN 'Occupant' WHEN 'A' THEN 'Pedestrian'
                WHEN 'N' THEN 'Bicyclist' END AS person_type""",
            """CASE l_linenumber WHEN 1 THEN 'Killed' WHEN 2 THEN 'Injured' WHEN 3 THEN 'Unspecified'
                WHEN 4 THEN NULL WHEN 5 THEN 'Not Injured' ELSE 'Injured' END AS person_injury""",
            "l_partkey AS vehicle_id",
            "CASE WHEN l_linenumber <> 7 THEN int(l_quantity) + 10 END AS person_age",
            "CASE l_linestatus WHEN 'O' THEN 'Not Ejected' ELSE 'Ejected' END AS ejection",
            """CASE l_linenumber % 4 WHEN 0 THEN 'Conscious' WHEN 1 THEN 'Shock'
                WHEN 2 THEN 'Unconscious' END AS emotional_status""",
            """CASE o_orderpriority WHEN '1-URGENT' THEN 'Does Not Apply' WHEN '2-HIGH' THEN NULL
                ELSE o_orderpriority END AS bodily_injury""",
            "CASE WHEN l_linenumber = 1 THEN 'Driver' ELSE 'Passenger' END AS position_in_vehicle",
            "CASE WHEN l_linenumber <> 2 THEN 'Lap Belt' END AS safety_equipment",
            """CASE l_suppkey % 5 WHEN 0 THEN 'Unspecified' WHEN 2 THEN 'Driver Inexperience'
                WHEN 3 THEN 'Unsafe Speed'
                WHEN 4 THEN 'Pedestrian/Bicyclist/Other Pedestrian Error/Confusion' END
                AS contributing_factor_1""",
            "concat('Factor ', l_suppkey % 3) AS contributing_factor_2",
            "CASE l_linestatus WHEN 'O' THEN 'M' ELSE 'F' END AS person_sex",
        )

    def weather(self) -> DataFrame:
        lines = self._join(self.table("lineitem"), "supplier", "l_suppkey", "s_suppkey")
        stamp = "l_shipdate + interval 22 years + (l_partkey % 24) * interval 1 hour"
        return self._regions_of(lines, "s_nationkey").selectExpr(
            f"""CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN NULL
                ELSE concat(string({stamp}), '+00:00') END AS date""",
            """CASE WHEN l_linenumber = 6 THEN 'n/a'
                ELSE concat(int(l_quantity), '.0 m asl') END AS elevation""",
            f"{CANONICAL} AS burrough",
            "l_suppkey * 0.0002D + 40.71003D AS lattitude",
            "l_suppkey * 0.0002D - 74.00003D AS longitude",
            "CASE WHEN l_linenumber <> 5 THEN l_quantity - 20.123D END AS temperature_2m",
            "CASE WHEN l_linenumber <> 4 THEN l_quantity * 2 END AS relative_humidity_2m",
            "l_quantity - 25 AS dew_point_2m",
            "l_quantity - 22 AS apparent_temperature",
            "l_discount + l_tax AS precipitation",
            "l_discount + 0.0D AS rain",
            "l_tax + 0.0D AS snowfall",
            "l_tax * 10 + 0.0D AS snow_depth",
            "double(l_linenumber) AS weather_code",
            "CASE WHEN l_linenumber <> 3 THEN l_quantity + 988 END AS pressure_msl",
            "l_quantity + 980 AS surface_pressure",
            "l_quantity * 2 AS cloud_cover",
            "l_quantity / 2 AS wind_speed_10m",
            "l_extendedprice AS wind_gusts_10m",
            "double(l_partkey % 2) AS is_day",
            "l_quantity * 60 AS sunshine_duration",
        )

    def traffic(self) -> DataFrame:
        stamp = "ts - (event_id % 2400 + 183) * interval 1 day"
        return self.table("events").selectExpr(
            "int(event_id) AS id",
            "value AS speed",
            "int(floor(value * 10)) AS travel_time",
            "int(user_id % 2) AS status",
            f"""CASE WHEN event_type = 'signup' AND user_id % 7 = 0 THEN 'n/a'
                ELSE translate(string({stamp}), ' ', 'T') END AS data_as_of""",
            "string(user_id) AS link_id",
            "string(NULL) AS link_points",
            "string(NULL) AS encoded_poly_line",
            "string(NULL) AS encoded_poly_line_lvls",
            "CASE WHEN event_type <> 'view' THEN 'City' END AS owner",
            "string(NULL) AS transcom_id",
            """CASE user_id % 5 WHEN 0 THEN 'Brooklyn' WHEN 1 THEN 'Manhattan' WHEN 2 THEN 'Queens'
                WHEN 3 THEN 'Bronx' ELSE 'Staten Island' END AS borough""",
            "event_type AS link_name",
        )

    def taxi(self) -> DataFrame:
        return self._lines().selectExpr(
            "l_linenumber % 3 + 1 AS VendorID",
            "o_orderdate + (l_suppkey * 37 % 86400) * interval 1 second AS tpep_pickup_datetime",
            "l_shipdate + (l_partkey * 53 % 86400) * interval 1 second AS tpep_dropoff_datetime",
            "l_linenumber AS passenger_count",
            "l_quantity AS trip_distance",
            "CASE WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN NULL ELSE l_linenumber END AS RatecodeID",
            """CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END
                AS store_and_fwd_flag""",
            "int(l_suppkey % 265) AS PULocationID",
            "int(l_partkey % 265) AS DOLocationID",
            "l_linenumber % 7 AS payment_type",
            "l_extendedprice AS fare_amount",
            "l_discount + 0.0D AS extra",
            "l_tax + 0.0D AS mta_tax",
            "l_quantity / 4 AS tip_amount",
            "l_quantity / 8 AS tolls_amount",
            "0.5D AS improvement_surcharge",
            "o_totalprice AS total_amount",
            "2.5D AS congestion_surcharge",
            "1.25D AS airport_fee",
        )

    def run_log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_type AS process_name",
            "CASE WHEN user_id % 3 <> 0 THEN 'Success' ELSE 'Failure' END AS process_status",
            "ts AS insert_ts",
            "CASE WHEN user_id % 11 <> 0 THEN ts END AS last_timestamp_loaded",
        )
