"""SQL counterparts of the registered queries, for checking results in another engine.

They state the expected result in the plainest way (windows over whole units, all
point-segment pairs) with no regard for cost.
"""

from __future__ import annotations

from trackloom.plans.inputs import derive_sql
from trackloom.schemas import RAW_FIELDS

POINTS = derive_sql("POINTS")
SCATTERED = derive_sql("SCATTERED")
ROADS = derive_sql("ROADS")
RAW = derive_sql("RAW")
MESSAGES = derive_sql("MESSAGES")
ISO_TEXT = derive_sql("ISO_TEXT")
LINES = derive_sql("LINES")
COMMITS = derive_sql("COMMITS")

METRES_PER_DEGREE = "111194.92664455873e0"


def micro(x: str) -> str:
    return f"cast(floor(({x})*1e6 + 5e-1) as bigint)"


def mm(x: str) -> str:
    return f"cast(floor(({x})*1e3 + 5e-1) as bigint)"


def ten_thousandths(x: str) -> str:
    return f"cast(floor(({x})*1e4 + 5e-1) as bigint)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half_lat = f"sin(radians({lat2} - {lat1})/2)"
    half_lon = f"sin(radians({lon2} - {lon1})/2)"
    a = f"({half_lat}*{half_lat} + cos(radians({lat1}))*cos(radians({lat2}))*{half_lon}*{half_lon})"
    return f"(12742000e0 * atan2(sqrt({a}), sqrt(1 - {a})))"


PAIRS = f"""(select *, {haversine("latitude", "longitude", "to_lat", "to_lon")} as metres from (
  select *, lead(event_id) over w as to_id, lead(latitude) over w as to_lat,
    lead(longitude) over w as to_lon, lead(speed) over w as to_speed
  from {POINTS} window w as (partition by device_id order by ts, event_id)))"""

GAPS = f"(select * from {PAIRS} where metres > 100)"


def routes(gaps: str, start_id: str = "event_id") -> str:
    """Route points in rows: one per (route, k)."""
    ends = f"""select {micro("longitude")} as o_lon, {micro("latitude")} as o_lat,
      {micro("to_lon")} as d_lon, {micro("to_lat")} as d_lat,
      longitude, latitude, to_lon, to_lat, {start_id} as route_no, 2 + {start_id} % 30 as n
      from {gaps} where {start_id} % 41 <> 0"""
    return f"""(select o_lon, o_lat, d_lon, d_lat, route_no, n, k,
        longitude + (to_lon - longitude)*k/(n - 1) as lon, latitude + (to_lat - latitude)*k/(n - 1) as lat
      from ({ends}) e, lateral (select unnest(range(n)) as k) u
      union all
      select o_lon, o_lat, d_lon, d_lat, route_no + 1000000000, 1, 0, longitude, latitude
      from ({ends}) e where route_no % 5 = 0)"""


ROUTES = routes(GAPS)


def first_routes(all_routes: str) -> str:
    return f"""(select * from {all_routes}
      qualify rank() over (partition by o_lon, o_lat, d_lon, d_lat order by route_no) = 1)"""


def on_route(gaps: str, all_routes: str) -> str:
    """Gaps joined with the coordinates of their route."""
    return f"""(select g.*, r.n, r.k, r.lon, r.lat from {gaps} g join {first_routes(all_routes)} r
      on {micro("g.longitude")} = r.o_lon and {micro("g.latitude")} = r.o_lat
      and {micro("g.to_lon")} = r.d_lon and {micro("g.to_lat")} = r.d_lat)"""


INNER = "k >= 1 and k <= n - 2"
SAMPLED = f"{INNER} and k - 1 >= greatest(1, (n - 2)//6) and (k - 1) % greatest(1, (n - 2)//6) = 0"
FAR = f"""{haversine("lat", "lon", "latitude", "longitude")} > 20
  and {haversine("lat", "lon", "to_lat", "to_lon")} > 20"""

ON_ROUTE = on_route(GAPS, ROUTES)


def nearest(points: str) -> str:
    """Brute force over all pairs of distinct coordinate and segment."""
    return f"""(with u as (select distinct {micro("longitude")} as mlon, {micro("latitude")} as mlat from {points}),
      p as (select mlon, mlat, mlon/1e6 as lon, mlat/1e6 as lat, cos(radians(mlat/1e6)) as shrink from u),
      a as (select mlon, mlat, lon, lat, shrink, seg_id, x1, y1, x2, y2,
          (x2 - x1)*shrink as dx, y2 - y1 as dy from p, {ROADS} s),
      b as (select *, dx*dx + dy*dy as length2 from a),
      c as (select *, case when length2 > 0
          then least(greatest(((lon - x1)*shrink*dx + (lat - y1)*dy)/length2, 0e0), 1e0) else 0e0 end as t from b),
      d as (select mlon, mlat, lon, lat, shrink, seg_id,
          x1 + t*(x2 - x1) as road_lon, y1 + t*(y2 - y1) as road_lat from c),
      e as (select mlon, mlat, seg_id, road_lon, road_lat,
          sqrt((road_lon - lon)*shrink*((road_lon - lon)*shrink) + (road_lat - lat)*(road_lat - lat))
            * {METRES_PER_DEGREE} as metres from d),
      f as (select mlon, mlat, min(struct_pack(um := cast(floor(metres*1e6 + 5e-1) as bigint), seg_id := seg_id,
          road_lon := road_lon, road_lat := road_lat, metres := metres)) as best from e
          group by mlon, mlat)
      select mlon, mlat, best.seg_id as seg_id, best.road_lon as road_lon, best.road_lat as road_lat,
        best.metres as road_metres from f)"""


FLOAT = r"regexp_full_match({x}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')"


def strict_double(x: str) -> str:
    return f"""(case when {FLOAT.format(x=x)} and not isinf(coalesce(try_cast({x} as double), 'inf'::double))
        then try_cast({x} as double)
      when lower({x}) in ('inf', '+inf', 'infinity', '+infinity') then 'inf'::double
      when lower({x}) in ('-inf', '-infinity') then '-inf'::double
      when lower({x}) = 'nan' then 'nan'::double end)"""


def strict_long(x: str) -> str:
    return f"(case when regexp_full_match({x}, '[+-]?[0-9]+') then try_cast({x} as bigint) end)"


def kind(x: str) -> str:
    return f"""(case when {x} is null then 'none' when isnan({x}) then 'nan'
      when isinf({x}) then 'infinite' else 'finite' end)"""


def finite(x: str) -> str:
    return f"(case when isfinite({x}) then {x} end)"


VALID_FLOAT = """(regexp_full_match(trim({x}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
  or regexp_full_match(lower(trim({x})), '[+-]?(inf|infinity|nan)'))"""
VALID_INT = "regexp_full_match(trim({x}), '[+-]?[0-9]+')"
VALIDATION = f"""(case when lat = '' then 'Missing required field: lat' when lon = '' then 'Missing required field: lon'
  when ts = '' then 'Missing required field: ts' when veh_id = '' then 'Missing required field: veh_id'
  when not ({VALID_FLOAT.format(x="lat")} and {VALID_FLOAT.format(x="lon")} and {VALID_INT.format(x="ts")})
  then 'Invalid numeric values' end)"""
VALID = f"(select * from {RAW} r where {VALIDATION} is null)"

TYPED = f"""(select event_id, part, dev_id, veh_id, status, in_depot,
    case when flat is null then concat('bad latitude: ', lat) when flon is null then concat('bad longitude: ', lon)
      when fspeed is null then concat('bad speed: ', speed) when falt is null then concat('bad altitude: ', alt)
      when fsignal is null then concat('bad signal: ', signal) when fsats is null then concat('bad satellites: ', sats)
      when fts is null then concat('bad timestamp: ', ts) end as error,
    flat, flon, fspeed, falt, fsignal, fsats, fts
  from (select *, {strict_double("lat")} as flat, {strict_double("lon")} as flon, {strict_double("speed")} as fspeed,
    {strict_double("alt")} as falt, {strict_long("signal")} as fsignal, {strict_long("sats")} as fsats,
    case when abs(cast({strict_long("ts")} as hugeint)) <= 9223372036854 then {strict_long("ts")} end as fts
    from {RAW} r))"""

BATCHES = f"""(select *, off // 10 as batch_id from (
  select event_id, part, error, flat, flon, row_number() over (partition by part order by event_id) - 1 as off from {TYPED}))"""

FAILED = f"(select distinct part, batch_id from {BATCHES} where error is not null)"

STORED = f"(select part, max(off) // 2 as last from {BATCHES} where part <> 3 group by part)"

READABLE = """case when {ms} between -62135596800000 and 253402300799999
  then strftime(make_timestamp({ms} * 1000), '%Y-%m-%d %H:%M:%S') end"""


def iso(x: str) -> str:
    """ISO text in canonical form; a clock with a time zone keeps it."""
    shape = r"([0-9]{4}-[0-9]{2}-[0-9]{2})T([0-9]{2}:[0-9]{2}:[0-9]{2})(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?"
    micros = f"rpad(substr(regexp_extract({x}, '{shape}', 3), 2, 6), 6, '0')"
    return f"""(case when regexp_full_match({x}, '{shape}')
        and try_strptime(substr({x}, 1, 19), '%Y-%m-%dT%H:%M:%S') is not null
      then concat(substr({x}, 1, 19), case when {micros} = '000000' then '' else concat('.', {micros}) end,
        replace(regexp_extract({x}, '{shape}', 4), 'Z', '+00:00'))
      else {x} end)"""


TRIMMED = f"(select event_id, trim(value) as value from {LINES})"
SPLIT = f"""(select event_id, substr(value, 1, strpos(value, ':') - 1) as key,
  substr(value, strpos(value, ':') + 1) as value from {TRIMMED} where strpos(value, ':') > 0)"""


def json_text(field: str) -> str:
    return f"coalesce(json_extract_string(value, '$.{field}'), '')"


BATCH_POINTS = f"""(select *, row_number() over (partition by part order by event_id) - 1 as off from {POINTS})"""
BATCH_PAIRS = f"""(select *, {haversine("latitude", "longitude", "to_lat", "to_lon")} as metres from (
  select *, off // 7 as batch_id, lead(latitude) over w as to_lat, lead(longitude) over w as to_lon,
    lead(speed) over w as to_speed, count(*) over (partition by part, off // 7) as size
  from {BATCH_POINTS} window w as (partition by part, off // 7 order by off)))"""
BATCH_GAPS = f"(select * from {BATCH_PAIRS} where metres > 100)"


def smoothed(pairs: str, gaps: str, all_routes: str, alone: str, failed: str, on: str) -> str:
    """``failed`` lists the units that are left out, and ``on`` compares their keys."""
    return f"""with pairs as materialized (select * from {pairs}), gaps as materialized (select * from {gaps}),
      hits as materialized (select * from {nearest(POINTS)}),
      filled as materialized (select * from {on_route("gaps", all_routes)}),
      failed as materialized ({failed})
    select event_id, 0::bigint as j,
      {micro("case when " + alone + " then latitude else coalesce(road_lat, latitude) end")} as mlat,
      {micro("case when " + alone + " then longitude else coalesce(road_lon, longitude) end")} as mlon,
      epoch_us(ts) as us, device_id, 'on task' as status, 1e0 as altitude
    from pairs p left join hits h on h.mlon = {micro("p.longitude")} and h.mlat = {micro("p.latitude")}
    anti join failed x on {on.format(rows="p")}
    union all
    select event_id, k as j, {micro("lat")}, {micro("lon")}, epoch_us(ts) + k*1000000, device_id, '', 0e0
    from filled f anti join failed x on {on.format(rows="f")} where {SAMPLED} and {FAR}"""


FAILED_BATCHES = """select distinct g.part, g.batch_id from gaps g
  anti join (select distinct event_id from filled) r on r.event_id = g.event_id"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "gap_summary": f"""select device_id, count(*) as segments, count(*) filter (where metres > 100) as gaps,
            cast(floor(sum(metres) + 5e-1) as bigint) as path_m
          from {PAIRS} where to_id is not null group by device_id""",
        "consecutive_pairs": f"""select event_id, to_id as next_id, {micro("to_lat")} as next_mlat,
            {micro("to_lon")} as next_mlon from {PAIRS}""",
        "segment_distance": f"select event_id, {mm('metres')} as mm from {PAIRS}",
        "haversine_m": f"""select event_id, {mm(haversine("latitude", "longitude", "42.65e0", "23.35e0"))} as mm
          from {POINTS}""",
        "degrees_to_radians": f"""select event_id, cast(floor(radians(latitude)*1e9 + 5e-1) as bigint) as nano_radians
          from {POINTS}""",
        "mean_speed": f"""select event_id, {ten_thousandths("(speed + to_speed)/2")} as mean_speed from {PAIRS}""",
        "add_seconds": f"select event_id, epoch_us(ts) + (event_id % 100)*1000000 as later_us from {POINTS}",
        "micro_degrees": f"""select event_id, {micro("latitude")} as mlat, {micro("longitude")} as mlon
          from {POINTS}""",
        "unit_bounds": f"""select event_id, cast(lead(event_id) over w is null as int) as is_last,
            cast(count(*) over (partition by vehicle_id, part) = 1 as int) as alone
          from {POINTS} window w as (partition by vehicle_id, part order by ts, event_id)""",
        "every_nth": f"""select * from (select veh_id, event_id,
            row_number() over (partition by veh_id order by event_id) as pos from {RAW}) where pos % 10 = 0""",
        "tracks": f"""select veh_id, event_id, row_number() over (partition by veh_id order by event_id) as pos
          from {VALID}""",
        "row_bounded_pairs": f"""select event_id, lead(event_id) over (partition by device_id order by date_trunc('day', ts), event_id) as next_id
          from {POINTS}""",
        "row_bounded_tracks": f"""select event_id, row_number() over (partition by device_id order by date_trunc('day', ts), event_id) as pos
          from {POINTS}""",
        "track_lists": f"""select veh_id, (pos - 1)//100 as part, count(*) as length,
            min(event_id) as first_id, max(event_id) as last_id
          from (select veh_id, event_id, row_number() over (partition by veh_id order by event_id) as pos from {VALID})
          group by veh_id, (pos - 1)//100""",
        "decode_raw": f"""select event_id, {", ".join(f"{json_text(name)} as {name}" for name in RAW_FIELDS)}, failed
          from (select event_id, cast(not good as int) as failed, case when good then value else '{{}}' end as value
            from (select event_id, value, case when json_valid(value) then json_type(value) = 'OBJECT'
                and {" and ".join(f"coalesce(json_type(value, '$.{name}'), 'NULL') in ('VARCHAR', 'NULL')" for name in RAW_FIELDS)}
              else false end as good from {MESSAGES}))""",
        "validate_raw": f"select event_id, {VALIDATION} as error from {RAW}",
        "to_processed": f"""select event_id, error, {finite("flat")} as latitude, {kind("flat")} as latitude_kind,
            {finite("flon")} as longitude, fspeed as speed, falt as altitude, fsignal as signal, fsats as satellites,
            fts as ts_ms, dev_id as device_id, veh_id as vehicle_id, status, in_depot from {TYPED}""",
        "parse_numbers": f"""select event_id, {finite("x")} as lat, {kind("x")} as lat_kind, signal, loose_float, loose_int
          from (select event_id, {strict_double("lat")} as x, {strict_long("signal")} as signal,
            cast({VALID_FLOAT.format(x="lat")} as int) as loose_float, cast({VALID_INT.format(x="ts")} as int) as loose_int
            from {RAW})""",
        "missing_as_empty": """select event_id, coalesce(case when event_id % 3 <> 0 then event_type end, '') as text
          from events""",
        "split_ok_error": f"""select event_id, case when error is null then 'ok' else 'error' end as side from {TYPED}""",
        "stamp_ingest": """select event_id, epoch_us(ts) // 1000 as current_ts,
            strftime(ts, '%Y-%m-%d %H:%M:%S') as formatted_ts from events""",
        "epoch_ms": f"""select event_id, fts*1000 as us, year(make_timestamp(fts*1000)) as year
          from (select event_id, fts from {TYPED})""",
        "format_timestamp": f"""select event_id, coalesce({READABLE.format(ms="ms")}, ts) as formatted
          from (select event_id, ts, {strict_long("trim(ts)")} as ms from {RAW})""",
        "iso_timestamp": f"select event_id, {iso('stamp')} as iso from {ISO_TEXT}",
        "vehicle_key": """select event_id, cast(cast(concat('0x', right(sha256(concat('A', cast(user_id as varchar))), 8))
            as ubigint) as varchar) as key from events""",
        "encode_output": f"""select event_id, dev_id as key, flat as latitude, flon as longitude, fspeed as speed, falt as altitude,
            fsignal as signal, fsats as satellites, fts as ts_ms, dev_id as device_id, veh_id as vehicle_id, status, in_depot,
            '' as formatted_ts
          from {TYPED} where error is null and isfinite(flat) and isfinite(flon)""",
        "feed_raw_messages": f"""select cast(cast(concat('0x', right(sha256(veh_id), 8)) as ubigint) as varchar) as key,
            concat('{{"event_id":', event_id, ',"lat":"', lat, '","lon":"', lon, '","ts":"', ts, '","dev_id":"', dev_id,
              '","speed":"', speed, '","alt":"', alt, '","signal":"', signal, '","sats":"', sats, '","status":"', status,
              '","in_depot":"', in_depot, '","veh_id":"', veh_id, '","formatted_ts":"',
              strftime(make_timestamp((1735689600000 + event_id)*1000), '%Y-%m-%d %H:%M:%S'),
              '","current_ts":', 1735689600000 + event_id, '}}') as value
          from {VALID}""",
        "split_key_value": f"select * from {SPLIT}",
        "flatten_export": f"""select event_id, {iso(json_text("Timestamp"))} as timestamp,
            {json_text("FormattedTS")} as formatted_timestamp, {json_text("Latitude")} as latitude,
            {json_text("Longitude")} as longitude, {json_text("Speed")} as speed, {json_text("Altitude")} as altitude,
            {json_text("Signal")} as signal, {json_text("Satellites")} as satellites, {json_text("DeviceID")} as device_id,
            {json_text("VehicleID")} as vehicle_id, {json_text("Status")} as status, {json_text("InDepot")} as in_depot
          from (select event_id, case when json_valid(value) then value else '[]' end as value from {SPLIT})
          where json_type(value) = 'OBJECT'""",
        "filter_key": f"select * from {SPLIT} where key = 'D7'",
        "export_keyed_lines": f"select concat(key, ':', value) as value from {SPLIT}",
        "assign_batches": f"""select event_id, part as partition, off as "offset", batch_id from {BATCHES}""",
        "batch_key": f"select event_id, concat(part, ':', off) as key from {BATCHES}",
        "quarantine_batches": f"""select event_id, case when f.part is null then 'kept' else 'rejected' end as side
          from {BATCHES} b left join {FAILED} f on b.part = f.part and b.batch_id = f.batch_id""",
        "start_from": f"""select event_id, off as "offset" from {BATCHES} b left join {STORED} s on b.part = s.part
          where off >= coalesce(s.last, 0)""",
        "skip_processed": f"""select event_id, batch_id from {BATCHES} b left join {STORED} s on b.part = s.part
          where batch_id*10 > coalesce(s.last, -1)""",
        "drop_inflight_duplicates": f"""select part as partition, off as "offset", event_id from {BATCHES}""",
        "last_offsets": f"""select part as partition, arg_max(off, commit_seq) as "offset" from {COMMITS} group by part""",
        "batch_summary": f"""select part as partition, batch_id, count(*) as messages, min(off) as first_offset,
            max(off) as last_offset, count(error) as errors,
            case when count(error) = 0 then count(*) else 0 end as outputs,
            case when count(error) = 0 then count(*) filter (where isfinite(flat) and isfinite(flon)) else 0 end as written,
            concat(part, ':', min(off)) as batch_key from {BATCHES} group by part, batch_id""",
        "all_errors_match": f"""select part as partition, batch_id, cast(bool_and(contains(error, 'latitude')) as int) as all_match
          from {BATCHES} where error is not null group by part, batch_id""",
        "offset_intervals": f"""select part as partition, min(off) as first, max(off) as last
          from (select part, off, off - row_number() over (partition by part order by off) as run
            from {BATCHES} where event_id % 97 <> 0)
          group by part, run""",
        "unseen_messages": f"""select event_id, off as "offset" from {BATCHES} where event_id % 997 <= 2""",
        "retry_verdicts": f"""select event_id, case when all_match then 'skip' when part % 3 >= 1 then 'reject' else 'retry' end as verdict
          from (select event_id, part, bool_and(contains(error, 'latitude')) over batch as all_match, count(error) over batch as errors
            from {BATCHES} window batch as (partition by part, batch_id))
          where errors > 0""",
        "contains_text": "select event_id, cast(contains(props, '7') as int) as found from events",
        "count_per_vehicle": f"select veh_id, count(*) as messages from {VALID} group by veh_id",
        "total_messages": f"select count(*) as total_messages from {VALID}",
        "count_vehicles": f"select count(distinct veh_id) as vehicles from {VALID}",
        "snap_to_road": f"""select event_id, seg_id, {mm("road_metres")} as mm,
            {micro("coalesce(road_lat, latitude)")} as mlat, {micro("coalesce(road_lon, longitude)")} as mlon
          from {SCATTERED} p left join {nearest(SCATTERED)} h
            on h.mlon = {micro("p.longitude")} and h.mlat = {micro("p.latitude")}""",
        "first_in_list": f"""select o_lon, o_lat, d_lon, d_lat, min(route_no) as route_no, count(*) as coordinates
          from {first_routes(ROUTES)} group by o_lon, o_lat, d_lon, d_lat""",
        "route_lookup": f"""select g.event_id, r.coordinates, case when r.coordinates is null then 'no route found' end as error
          from {GAPS} g left join (select o_lon, o_lat, d_lon, d_lat, count(*) as coordinates
            from {first_routes(ROUTES)} group by all) r
          on {micro("g.longitude")} = r.o_lon and {micro("g.latitude")} = r.o_lat
            and {micro("g.to_lon")} = r.d_lon and {micro("g.to_lat")} = r.d_lat""",
        "inner_coordinates": f"""select route_no, count(*) filter (where {INNER}) as length,
            max(case when k = 1 and {INNER} then {micro("lat")} end) as first_mlat,
            max(case when k = n - 2 and {INNER} then {micro("lon")} end) as last_mlon
          from {ROUTES} group by route_no""",
        "explode_route": f"""select route_no, k as i, {micro("lat")} as mlat, {micro("lon")} as mlon
          from {ROUTES} where {INNER}""",
        "sample_step": f"""select route_no, k as i, {micro("lat")} as mlat, {micro("lon")} as mlon
          from {ROUTES} where {SAMPLED}""",
        "step_size": "select event_id, greatest(1, (event_id % 97)//6) as step from events",
        "filter_near_ends": f"select event_id, k as i from {ON_ROUTE} where {INNER} and {FAR}",
        "impute_fields": f"""select event_id, k as j, {micro("lat")} as mlat, {micro("lon")} as mlon,
            {ten_thousandths("(speed + to_speed)/2")} as speed, epoch_us(ts) + k*1000000 as us, device_id, vehicle_id,
            0e0 as altitude, 0::bigint as signal, 0::bigint as satellites, '' as status, '' as in_depot, '' as formatted_ts
          from {ON_ROUTE} where {INNER}""",
        "impute_gaps": f"""select event_id, k as j, {micro("lat")} as mlat, {micro("lon")} as mlon,
            epoch_us(ts) + k*1000000 as us from {ON_ROUTE} where {SAMPLED} and {FAR}""",
        "append_imputed": f"""select event_id, 0::bigint as j, {ten_thousandths("speed")} as speed from {POINTS}
          union all select event_id, k, {ten_thousandths("(speed + to_speed)/2")} from {ON_ROUTE} where {SAMPLED} and {FAR}""",
        "smooth_devices": smoothed(
            PAIRS, GAPS, routes("gaps"), "false", "select device_id from gaps where false", "x.device_id = {rows}.device_id"
        ),
        "smooth_batches": smoothed(
            BATCH_PAIRS,
            BATCH_GAPS,
            routes("gaps"),
            "size = 1",
            FAILED_BATCHES,
            "x.part = {rows}.part and x.batch_id = {rows}.batch_id",
        ),
        "smooth_rejected": f"""with pairs as materialized (select * from {BATCH_PAIRS}), gaps as materialized (select * from {BATCH_GAPS}),
            filled as materialized (select * from {on_route("gaps", routes("gaps"))}),
            failed as materialized ({FAILED_BATCHES})
          select event_id, {micro("latitude")} as mlat, {micro("longitude")} as mlon, 'no route found' as error
          from pairs p semi join failed x on x.part = p.part and x.batch_id = p.batch_id""",
        "output_order": f"""select device_id, us, event_id, j, lead(event_id) over w as next_id, lead(j) over w as next_j
          from (select device_id, epoch_us(ts) as us, event_id, 0::bigint as j from {POINTS}
            union all select device_id, epoch_us(ts), event_id, k from {ON_ROUTE} where {SAMPLED} and {FAR})
          window w as (partition by device_id order by us, event_id, j)""",
    }
    return sql
