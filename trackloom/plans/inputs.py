"""Inputs of the registered queries, derived from the given tables.

Each is one SQL text that reads the same in Spark and in the checking engine. Double
literals carry an exponent, since a plain ``0.001`` is a decimal.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators.routes import find_gaps
from trackloom.operators.slices import with_position
from trackloom.operators.track import consecutive_pairs
from trackloom.session import use_utc

# One fix per event. A third of all fixes belongs to device D0.
POINTS = """
select event_id, user_id % 10 as part,
  case when user_id % 3 = 0 then 'D0' else concat('D', cast(user_id % 40 as varchar(20))) end as device_id,
  concat('V', cast(user_id % 40 as varchar(20))) as vehicle_id,
  ts, value as speed,
  42.6e0 + (user_id % 40)*1e-3 + value*2e-5 as latitude,
  23.3e0 + (user_id % 40)*1e-3 + (event_id % 97)*3e-5 as longitude
from {events}"""

# As POINTS, with some fixes 9, 100 and 1,000 kilometres away from every road and a third in one car park.
SCATTERED = """
select event_id,
  case when event_id % 3 = 0 then 42.61e0 + (event_id % 11)*1e-6
       when event_id % 53 = 1 then 42.6e0 + (user_id % 40)*1e-3 + value*2e-5 + 8e-2
       when event_id % 211 = 2 then 42.6e0 + value*2e-5 - 9e-1
       when event_id % 499 = 2 then 42.6e0 + value*2e-5 - 9e0
       else 42.6e0 + (user_id % 40)*1e-3 + value*2e-5 end as latitude,
  case when event_id % 3 = 0 then 23.31e0 + (event_id % 7)*1e-6
       else 23.3e0 + (user_id % 40)*1e-3 + (event_id % 97)*3e-5 end as longitude
from {events}"""

# One road segment per part, every 500th a kilometre long and every 300th a single point.
ROADS = """
select p_partkey as seg_id,
  23.3e0 + (p_partkey % 41)*1e-3 as x1, 42.6e0 + (p_partkey % 50)*1e-3 as y1,
  case when p_partkey % 300 = 0 then 23.3e0 + (p_partkey % 41)*1e-3
       when p_partkey % 500 = 1 then 23.3e0 + (p_partkey % 41)*1e-3 + 1e-2
       else 23.3e0 + (p_partkey % 41)*1e-3 + (p_partkey % 7)*1e-4 end as x2,
  case when p_partkey % 300 = 0 then 42.6e0 + (p_partkey % 50)*1e-3
       when p_partkey % 500 = 1 then 42.6e0 + (p_partkey % 50)*1e-3 - 9e-3
       else 42.6e0 + (p_partkey % 50)*1e-3 + 7e-4 end as y2
from {part}"""

# Raw text rows with a few malformed cells of every kind.
RAW = """
select event_id, user_id % 10 as part,
  case event_id % 101 when 0 then '' when 1 then 'abc' when 2 then '1.5d' when 3 then ' 42.5'
    when 4 then 'NaN' when 5 then '1_000' when 6 then '1e400' when 7 then '-inf' when 8 then '4.25e1'
    when 9 then '.5' when 10 then '5.' when 11 then '+41.5' when 12 then '0x1p-2'
    else concat('42.', right(concat('00000', cast(event_id*37 % 1000000 as varchar(20))), 6)) end as lat,
  case event_id % 103 when 0 then '' when 1 then '23.5f' when 2 then '23,5' when 3 then 'Infinity'
    else concat('23.', right(concat('00000', cast(event_id*53 % 1000000 as varchar(20))), 6)) end as lon,
  case event_id % 107 when 0 then '' when 1 then '1.5' when 2 then '9223372036854775808'
    when 3 then '9223372036854775807' when 4 then '+1735689600000' when 5 then '-62135596800001'
    when 6 then 'soon' when 7 then '1e12'
    else cast(1735689600000 + event_id*4999 as varchar(20)) end as ts,
  concat('D', cast(user_id % 40 as varchar(20))) as dev_id,
  case event_id % 109 when 0 then '' when 1 then 'fast' else cast(user_id % 90 as varchar(20)) end as speed,
  case event_id % 113 when 0 then '-' else concat('598.', cast(event_id % 10 as varchar(20))) end as alt,
  case event_id % 127 when 0 then '31.0' when 1 then '+31' when 2 then '9223372036854775808'
    else cast(user_id % 32 as varchar(20)) end as signal,
  case event_id % 131 when 0 then '1e2' when 1 then '-3' else cast(event_id % 12 as varchar(20)) end as sats,
  event_type as status,
  case event_id % 2 when 0 then 'False' else 'True' end as in_depot,
  case event_id % 137 when 0 then '' else concat('V', cast(user_id % 40 as varchar(20))) end as veh_id,
  '' as formatted_ts
from {events}"""

# Message texts, well-formed and not.
MESSAGES = """
select event_id,
  case event_id % 17 when 0 then 'not json' when 1 then '[1]' when 2 then 'null' when 3 then ''
    when 4 then '{{"lat":"1"' when 5 then '{{"lat":1.5,"sats":8}}' when 6 then '{{}}'
    when 7 then '"text"' when 8 then '7' when 9 then '{{"lat":"1"}} x' when 10 then '{{"lat":"1"}} {{"lat":"2"}}'
    when 11 then '{{"lat":"1"}}}}' when 12 then '{{"lat":"1"}},{{"lat":"2"}}' when 13 then '{{"lat":"1"}}, "y":{{"lat":"2"}}'
    when 14 then '{{"dev_id":7}}'
    else concat('{{"lat":"', cast(value as varchar(20)), '","current_ts":', cast(event_id as varchar(20)),
      ',"props":', props, ',"veh_id":"V', cast(user_id % 40 as varchar(20)), '","status":null,"signal":"',
      event_type, '"}}') end as value
from {events}"""

# ISO timestamps in several spellings, and text that is none.
ISO_TEXT = """
select event_id, user_id, event_type,
  case event_id % 9 when 0 then 'xyz'
    when 1 then concat(day_text, 'T', clock, 'Z') when 2 then concat(day_text, 'T', clock, '.5Z')
    when 3 then concat(day_text, 'T', clock, '.000Z') when 4 then concat(day_text, 'T', clock, '.123456789Z')
    when 5 then concat(day_text, 'T', clock, '.25+02:00') when 6 then concat('2025-02-30T', clock, 'Z')
    when 7 then '' else concat(day_text, 'T', clock, '.975Z') end as stamp
from (select event_id, user_id, event_type,
  concat('2025-01-', lpad(cast(1 + event_id % 28 as varchar(20)), 2, '0')) as day_text,
  concat(lpad(cast(event_id % 24 as varchar(20)), 2, '0'), ':', lpad(cast(event_id % 60 as varchar(20)), 2, '0'),
    ':', lpad(cast(event_id*7 % 60 as varchar(20)), 2, '0')) as clock
  from {events}) t"""

# Exported lines key:json, some of them broken.
LINES = (
    """
select event_id,
  case event_id % 19 when 0 then 'no colon here' when 1 then '  ' when 2 then 'D1:{{"Latitude":' when 3 then 'D1:[1]'
    when 4 then 'D1:{{}}' when 5 then ':{{"DeviceID":"none"}}' when 6 then 'D1:{{"Latitude":1}} {{"Latitude":2}}'
    when 7 then 'D1:{{"Latitude":1}}}}' when 8 then 'D1:{{"Latitude":1}} x' when 9 then 'D1:{{"Latitude":1}}],[{{"Latitude":2}}'
    else concat(case event_id % 2 when 0 then '' else '  ' end, 'D', cast(user_id % 40 as varchar(20)),
      ':{{"Latitude":42.65', cast(1 + event_id % 9 as varchar(20)), ',"Longitude":23.35', cast(1 + user_id % 9 as varchar(20)),
      ',"Speed":', cast(user_id % 90 as varchar(20)), ',"Signal":31,"Timestamp":"', stamp,
      '","DeviceID":"D', cast(user_id % 40 as varchar(20)), '","Status":"', event_type, '"}}',
      case event_id % 2 when 0 then '  ' else '' end) end as value
from ("""
    + ISO_TEXT
    + ") s"
)

# Offset commits that do not arrive in offset order.
COMMITS = """
select event_id as commit_seq, user_id % 10 as part, event_id*7919 % 100003 as off from {events}"""


@cache
def _template(name: str) -> str:
    return globals()[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the inputs above as a DataFrame."""
    text = _template(name)
    source = "part" if "{part}" in text else "events"
    return spark.sql(text, **{source: table(spark, sf_dir, source)})


def derive_sql(name: str) -> str:
    """One of the inputs above as a sub-query over the registered tables."""
    return f"({_template(name).format(events='events', part='part')})"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fixes of all events."""
    return derive(spark, sf_dir, "POINTS").select(
        F.col("event_id").alias("offset"),
        F.col("part").cast("int").alias("partition"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "device_id",
        "vehicle_id",
        "speed",
        "latitude",
        "longitude",
        F.lit(1.0).alias("altitude"),
        F.lit(2).cast("bigint").alias("signal"),
        F.lit(3).cast("bigint").alias("satellites"),
        F.lit("on task").alias("status"),
        F.lit("False").alias("in_depot"),
        F.lit("x").alias("formatted_ts"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "RAW")


def offset_rows(df: DataFrame) -> DataFrame:
    """Rows with ``part`` and ``event_id`` as messages of a partitioned topic."""
    placed = with_position(df, ["part"], ["event_id"], "_pos")
    return placed.select(
        *[name for name in df.columns if name != "part"],
        F.col("part").cast("int").alias("partition"),
        (F.col("_pos") - 1).alias("offset"),
    )


def straight_routes(pairs: DataFrame, start_id: str) -> DataFrame:
    """A straight route per pair, of 2 to 31 coordinates; some pairs have two, some none."""
    n = (F.lit(2) + F.pmod(F.col(start_id), F.lit(30))).cast("int")

    def between(a: str, b: str, k):
        return F.col(a) + (F.col(b) - F.col(a)) * k / (F.col("_n") - 1)

    def micro(name: str):
        return F.floor(F.col(name) * 1e6 + 0.5).cast("bigint")

    best = pairs.select(
        micro("longitude").alias("o_lon"),
        micro("latitude").alias("o_lat"),
        micro("next.longitude").alias("d_lon"),
        micro("next.latitude").alias("d_lat"),
        "longitude",
        "latitude",
        F.col("next.longitude").alias("to_lon"),
        F.col("next.latitude").alias("to_lat"),
        F.col(start_id).alias("route_no"),
        n.alias("_n"),
    ).filter(F.pmod("route_no", F.lit(41)) != 0)
    routes = best.select(
        "o_lon",
        "o_lat",
        "d_lon",
        "d_lat",
        "route_no",
        F.transform(
            F.sequence(F.lit(0), F.col("_n") - 1),
            lambda k: F.struct(
                between("longitude", "to_lon", k).alias("lon"),
                between("latitude", "to_lat", k).alias("lat"),
            ),
        ).alias("coordinates"),
    )
    detours = routes.filter(F.pmod("route_no", F.lit(5)) == 0).withColumn(
        "route_no", F.col("route_no") + 1_000_000_000
    ).withColumn("coordinates", F.slice("coordinates", 1, 1))
    return routes.unionByName(detours)


def gaps(fixes: DataFrame) -> DataFrame:
    return find_gaps(consecutive_pairs(fixes))
