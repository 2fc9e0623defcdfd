"""The queries once more as SQL over the same tables, for checking in DuckDB."""

from __future__ import annotations

from wayfare.plans.queries import BATCHES, DAY_MS, JOIN_WINDOW_MS, POINT
from wayfare.streaming.staging import ROWS_PER_FILE

_GEO = """
  cast(-74.06e0 + (event_id*7919 % 37000)/1e5 as float) as start_lon,
  cast(40.49e0 + (event_id*104729 % 52000)/1e5 as float) as start_lat,
  cast(-74.06e0 + (event_id*15485863 % 37000)/1e5 as float) as end_lon,
  cast(40.49e0 + (event_id*32452843 % 52000)/1e5 as float) as end_lat"""

_RIDES = f"""
rides as (
  select event_id as ride_id, is_start,
    date_trunc('second', ts) as start_time,
    date_trunc('second', ts) + to_seconds(120 + event_id*7919 % 3480) as end_time, {_GEO},
    cast(event_id % 6 + 1 as smallint) as passenger_cnt,
    user_id + 2013000000 as taxi_id, user_id + 2014000000 as driver_id
  from (select *, unnest([true, false]) as is_start from events)
),
timed as (
  select *, epoch_us(start_time)//1000 as start_ms, epoch_us(end_time)//1000 as end_ms,
    case when is_start then epoch_us(start_time)//1000 else epoch_us(end_time)//1000 end as event_ms
  from rides
)"""

_FARES = """
fares as (
  select event_id as ride_id, user_id + 2013000000 as taxi_id, user_id + 2014000000 as driver_id,
    date_trunc('second', ts) as start_time,
    epoch_us(date_trunc('second', ts))//1000 as start_ms,
    case when event_id % 2 = 0 then 'CSH' else 'CRD' end as payment_type,
    cast(event_id % 7 as float) as tip, cast(event_id % 3 as float) as tolls,
    cast(value as float) as total_fare
  from events
)"""

_CARS = """
cars as (
  select cast(event_id as varchar) as id, cast(user_id as varchar) as car_id,
    epoch_us(ts)//1000 as ts_ms,
    cast(-74.06e0 + (event_id*7919 % 37000)/1e5 as float) as longitude,
    cast(40.49e0 + (event_id*104729 % 52000)/1e5 as float) as latitude,
    cast(event_id % 13 as float) as consumption,
    cast(case when event_type = 'error' then 0 else value end as float) as speed,
    cast(event_id % 100 as float) as throttle, cast(event_id % 90 as float) as engineload
  from events
)"""

_DISTANCE = """110.25e0 * sqrt(
  power(cast({lat1} - {lat2} as double), 2)
  + power(cast({lon1} - {lon2} as double) * cos(cast({lat2} as double)), 2))"""

_RIDE_DISTANCE = _DISTANCE.format(lon1="start_lon", lat1="start_lat", lon2="end_lon", lat2="end_lat")

_DIRECTION = """cast(trunc(degrees(atan2(
  cast(end_lat - start_lat as double),
  cast(end_lon - start_lon as double) * cos(cast(start_lat as double))))) as integer) + 179"""

_FEATURES = f"""{_RIDES},
features as (
  select ride_id, taxi_id, event_ms, {_DIRECTION} as direction, {_RIDE_DISTANCE} as distance,
    (end_ms - start_ms)/1000.0e0 as travel_time
  from timed where not is_start
),
bucketed as (select *, cast(direction // 45 as integer) as bucket from features)"""

_MODEL = f"""{_FEATURES},
model as (
  select bucket, count(*) as n, sum(distance*distance) as sum_xx, sum(distance*travel_time) as sum_xy
  from bucketed group by bucket
)"""

_CELL_X = "cast(floor((74.05e0 - abs({lon}::double))/0.0014e0) as integer)"
_CELL_Y = "cast(floor((41.0e0 - {lat}::double)/0.00125e0) as integer)"
_CELL = f"({_CELL_X} + 250*{_CELL_Y})"

_TUPLES = """
tuples_1 as (
  select 'Source1' as source_id, event_id % 50 as tuple_id, event_id % 97 as value, ts from events
),
tuples_2 as (
  select 'Source2' as source_id, event_id as tuple_id, user_id - 1 as value, ts from events
)"""

_RIDE_LINE = """
concat(ride_id, ',', case when is_start then 'START' else 'END' end, ',',
  strftime({first}, '%Y-%m-%d %H:%M:%S'), ',', strftime({second}, '%Y-%m-%d %H:%M:%S'), ',',
  start_lon, ',', start_lat, ',', end_lon, ',', end_lat, ',',
  passenger_cnt, ',', taxi_id, ',', driver_id)"""

_RIDE_COLUMNS = """ride_id, is_start, start_lon, start_lat, end_lon, end_lat,
  passenger_cnt, taxi_id, driver_id"""

_MAILS = """
sent as (
  select *, timestamp '2013-01-10' + to_seconds((doc_id*61) % 1728000) as sent_at,
    (case when doc_id % 11 = 0 then 'bad#|#' else '' end) || source || ' ' || lang as subject
  from documents
),
fields as (
  select '<m' || (doc_id % 700) || '@x>' as message_id,
    strftime(sent_at, '%Y-%m-%d-%H:%M:%S') as time,
    'user' || (doc_id % 17) || ' <u@x>' as sender,
    subject,
    chr(10) || 'soft'
      || replace(rtrim(text, chr(10)) || chr(10), '=' || chr(10), '') as body,
    case when doc_id % 3 = 0 then '<m' || (doc_id % 5) || '@x>' else 'null' end as reply_to
  from sent
),
mails as (
  select * from fields
  where not contains(subject, '#|#') and not contains(body, '#|#') and not contains(body, '##//##')
),
firsts as (
  select * exclude (place) from (
    select *, row_number() over (
      partition by message_id order by time, sender, subject, body, reply_to) as place
    from mails)
  where place = 1
)"""

_MAIL_LINE = """message_id || '#|#' || time || '#|#' || sender || '#|#' || subject || '#|#'
  || body || '#|#' || reply_to"""

_STEPS = f"""
{_RIDES},
corners as (
  select ride_id, {_CELL_X.format(lon='start_lon')} as xa,
    {_CELL_Y.format(lat='start_lat')} as ya, {_CELL_X.format(lon='end_lon')} as xb,
    {_CELL_Y.format(lat='end_lat')} as yb
  from rides where not is_start
),
lines as (
  select ride_id, least(xa, xb) as x0, greatest(xa, xb) as x1,
    case when xa <= xb then ya else yb end as y0,
    case when xa <= xb then yb else ya end as y1
  from corners
),
sloped as (select *, (y1 - y0)/((x1 - x0) + 0.00000001e0) as slope from lines),
steps as (
  select *, x0 as x, y0 as y, 0 as step from sloped
  union all
  select ride_id, x0, x1, y0, y1, slope,
    x + case when near and slope <= 0 then 2 when near or east then 1 else 0 end,
    y + case when near or not east then (case when slope > 0 then 1 else -1 end) else 0 end,
    step + 1
  from (
    select *, height > y - 0.05e0 and height < y + 0.05e0 as near,
      case when slope > 0 then height < y else height > y end as east
    from (
      select *, case when slope > 0 then (x - x0 + 0.5e0)*slope + y0 - 0.5e0
                     else (x - x0 + 0.5e0)*slope + y0 + 0.5e0 end as height
      from steps where x < x1 or y <> y1
    )
  )
)"""

_UNRELIABLE = """
records as (
  select * exclude (value), epoch_us(date_trunc('second', ts))//1000 as start_ms,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as start_text
  from events
),
lines as (
  select *, concat(event_id, ',', case when event_type = 'error' then 'STOP' else 'START' end, ',',
    start_text, ',',
    case when event_type = 'signup' then '2024-13-01 00:00:00' else start_text end, ',,',
    case when event_type = 'view' then ' ' else '' end, ',-73.95,40.78,',
    case when event_type = 'purchase' then '99999' else '1' end, ',',
    user_id, ',', user_id, ',,') as value
  from records
)"""

_PREDICTED = """case when n is null or n < 2 or abs(sum_xx) < 4.9e-323 then -1
  else cast(trunc(sum_xy/sum_xx*distance) as integer) end as predicted_time"""


def _inside(lon: str, lat: str) -> str:
    return (
        f"{lon}::double between -74.05e0 and -73.7e0 and {lat}::double between 40.5e0 and 41.0e0"
    )


def _point_distance(lon: str, lat: str) -> str:
    return _DISTANCE.format(
        lon1=f"cast({POINT[0]}e0 as float)", lat1=f"cast({POINT[1]}e0 as float)", lon2=lon, lat2=lat
    )


def _on_time(records: str, delay_ms: int) -> str:
    """Records of windows that are over, without those that came after their window was closed.

    A micro-batch drops what belongs to windows that the watermark had passed when the one before it ran, which
    knows the times of the batches before that.
    """
    return f"""
      arriving as (
        select *, epoch_us(ts)//1000 + (event_id*7919 % 7200)*1000
          + case when event_id % 7 = 0 then 864000000 else 0 end as arrival_ms
        from events
      ),
      sized as (
        select count(*) as n, greatest(1, ceil(count(*) / {BATCHES * ROWS_PER_FILE}))::bigint as files from events
      ),
      batched as (
        select arriving.*, (row_number() over (order by arrival_ms, event_id) - 1) * {BATCHES} * files // n // files as batch
        from arriving, sized
      ),
      {records},
      tops as (select batch, max(event_ms) as top from records group by batch),
      marks as (
        select batch, max(top) over (order by batch rows between unbounded preceding and 2 preceding) - {delay_ms} as mark
        from tops
      ),
      on_time as (
        select *, event_ms//{DAY_MS}*{DAY_MS} as window_start_ms from records join marks using (batch)
        where event_ms//{DAY_MS}*{DAY_MS} + {DAY_MS} > coalesce(mark, 0)
          and event_ms//{DAY_MS}*{DAY_MS} + {DAY_MS} <= (select max(top) - {delay_ms} from tops)
      )"""


_STOP_RECORDS = """records as (
        select batch, cast(user_id as varchar) as car_id, epoch_us(ts)//1000 as event_ms,
          event_type = 'error' or cast(value as float) = 0 as stopped
        from batched
      )"""

_RIDE_RECORDS = """records as (
        select batch, is_start, epoch_us(date_trunc('second', ts))//1000
          + case when is_start then 0 else (120 + event_id*7919 % 3480)*1000 end as event_ms
        from (select *, unnest([true, false]) as is_start from batched)
      )"""

def _uniform(seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:=' || event_id), 1, 13))::bigint / 4503599627370496.0e0)"


_JOIN_WINDOW_US = JOIN_WINDOW_MS * 1000

_WINDOW_JOIN = f"""
with {_TUPLES}
select l.source_id as l_source_id, l.tuple_id as l_tuple_id, l.value + 1 as l_value,
  r.source_id as r_source_id, r.tuple_id as r_tuple_id, r.value + 1 as r_value
from tuples_1 l join tuples_2 r
  on l.tuple_id = r.value + 1
  and epoch_us(l.ts)//{_JOIN_WINDOW_US} = epoch_us(r.ts)//{_JOIN_WINDOW_US}"""

_FIT = f"""
with {_MODEL}
select bucket, n, round(sum_xx, 2) as sum_xx, round(sum_xy, 2) as sum_xy from model"""

_PREQUENTIAL = f"""
    with {_FEATURES},
    seen as (
      select ride_id, bucket, distance, count(*) over earlier as n,
        sum(distance*distance) over earlier as sum_xx,
        sum(distance*travel_time) over earlier as sum_xy
      from bucketed
      window earlier as (partition by bucket order by event_ms, ride_id
        rows between unbounded preceding and 1 preceding)
    )
    select ride_id, bucket, {_PREDICTED} from seen"""

_LINE_REFERENCE = _RIDE_LINE.format(first="start_time", second="end_time")

ORACLES: dict[str, str] = {
    "scan_rides": f"with {_RIDES} select {_RIDE_COLUMNS}, start_ms, end_ms from timed",
    "scan_fares": f"with {_FARES} select * exclude (start_time) from fares",
    "scan_cars": f"with {_CARS} select * replace (ts_ms//1000*1000 as ts_ms) from cars",
    "scan_mails": """
        with raw as (
          select 'From dev-return-' || doc_id || '-x@y '
            || strftime(timestamp '2013-01-10' + to_seconds((doc_id*61) % 1728000),
                        '%a %b %d %H:%M:%S %Y')
            || chr(10) || 'Message-ID: <m' || (doc_id % 700) || '@x>'
            || chr(10) || 'FROM: user' || (doc_id % 17) || ' <u@x>'
            || chr(10) || 'Subject: old' || chr(10) || 'Subject: '
            || case when doc_id % 11 = 0 then 'bad#|#' else '' end || source || ' ' || lang
            || chr(10)
            || case when doc_id % 3 = 0
                    then 'In-Reply-To: <m' || (doc_id % 5) || '@x>' || chr(10) else '' end
            || chr(10) || 'soft=' || chr(10) || text || chr(10) as mail
          from documents
        )
        select md5(mail) as mail_md5, cast(length(mail) as integer) as n_chars from raw""",
    "decode_rides": f"""
        with {_RIDES}
        select {_RIDE_COLUMNS},
          case when is_start then start_ms else end_ms end as start_ms,
          case when is_start then end_ms else start_ms end as end_ms
        from timed""",
    "encode_rides": f"with {_RIDES} select {_LINE_REFERENCE} as value from rides",
    "encode_fares": f"""
        with {_FARES}
        select concat(ride_id, ',', taxi_id, ',', driver_id, ',',
          strftime(start_time, '%Y-%m-%d %H:%M:%S'), ',', payment_type, ',',
          tip, ',', tolls, ',', total_fare) as value
        from fares""",
    "encode_cars": f"""
        with {_CARS}
        select concat(id, ',', ts_ms, ',', longitude, ',', latitude, ',',
          speed, ',', throttle, ',', engineload) as value
        from cars""",
    "bad_rides": f"with {_UNRELIABLE} select value from lines where event_type <> 'click'",
    "good_rides": f"""
        with {_UNRELIABLE}
        select event_id as ride_id, true as is_start,
          cast(0 as float) as start_lon, cast(0 as float) as start_lat,
          cast(-73.95 as float) as end_lon, cast(40.78 as float) as end_lat,
          cast(1 as smallint) as passenger_cnt, user_id as taxi_id, user_id as driver_id,
          start_ms, start_ms as end_ms
        from lines where event_type = 'click'""",
    "ride_event_time": f"with {_RIDES} select ride_id, is_start, event_ms from timed",
    "fare_event_time": f"with {_FARES} select ride_id, start_ms as event_ms from fares",
    "nyc_rides": f"""
        with {_RIDES}
        select ride_id, is_start from rides
        where {_inside('start_lon', 'start_lat')} and {_inside('end_lon', 'end_lat')}""",
    "grid_cell": f"""
        with {_RIDES}
        select ride_id, is_start, {_CELL.format(lon='start_lon', lat='start_lat')} as start_cell,
          {_CELL.format(lon='end_lon', lat='end_lat')} as end_cell
        from rides""",
    "cell_center": f"""
        with {_RIDES},
        cells as (
          select ride_id, {_CELL.format(lon='start_lon', lat='start_lat')} as cell from rides
        )
        select ride_id, cell,
          -cast(74.05e0 - (cell % 250)*0.0014e0 - 0.0007e0 as float) as lon,
          cast(41.0e0 - ((cell - cell % 250)//250)*0.00125e0 - 0.000625e0 as float) as lat
        from cells""",
    "grid_path_cells": f"""
        with recursive {_STEPS}
        select ride_id, is_start, count(*) as n_cells, max(step)::bigint as last_step, sum(cell)::bigint as cell_sum,
          sum(step::bigint * cell)::bigint as ordered_sum, sum(step::bigint * step * cell)::bigint as twice_ordered_sum,
          min(cell) as least_cell, max(cell) as largest_cell
        from (select ride_id, unnest([true, false]) as is_start, step, (x + 250*y)::bigint as cell from steps)
        group by ride_id, is_start""",
    "grid_traffic": f"""
        with recursive {_STEPS}
        select (x + 250*y)::integer as cell, 2 * count(*) as n_passed, 2 * sum(step)::bigint as steps
        from steps group by all""",
    "ride_distance": f"""
        with {_RIDES}
        select ride_id, is_start, round({_RIDE_DISTANCE}, 6) as distance from rides""",
    "ride_direction": f"with {_RIDES} select ride_id, is_start, {_DIRECTION} as direction from rides",
    "distance_to_point": f"""
        with {_RIDES}
        select ride_id, is_start, round(case when is_start
          then {_point_distance('start_lon', 'start_lat')}
          else {_point_distance('end_lon', 'end_lat')} end, 6) as distance
        from rides""",
    "random_points": f"""
        select event_id, cast(-73.7e0 - (-73.7e0 - -74.05e0) * {_uniform(7)} as float) as lon,
          cast(40.5e0 + (41.0e0 - 40.5e0) * {_uniform(8)} as float) as lat
        from events""",
    "ride_features": f"""
        with {_FEATURES}
        select ride_id, taxi_id, direction, round(distance, 6) as distance, travel_time, event_ms
        from features""",
    "direction_bucket": f"with {_FEATURES} select ride_id, direction, bucket from bucketed",
    "fit_travel_time": _FIT,
    "fit_travel_time_stream": _FIT,
    "predict_travel_time": f"""
        with {_MODEL}
        select ride_id, bucket, {_PREDICTED} from bucketed left join model using (bucket)""",
    "prequential_travel_time": _PREQUENTIAL,
    "prequential_travel_time_stream": _PREQUENTIAL,
    "keyed_tuples": f"""
        with {_TUPLES}
        select source_id, tuple_id, value from tuples_1
        union all select source_id, tuple_id, value from tuples_2""",
    "map_increment": f"""
        with {_TUPLES}
        select source_id, tuple_id, value + 1 as value from tuples_1
        union all select source_id, tuple_id, value + 1 as value from tuples_2""",
    "ingestion_stamps": f"""
        with {_TUPLES}
        select source_id, tuple_id, value, epoch_us(ts) as event_us, true as in_run, true as replaced from tuples_1""",
    "window_join": _WINDOW_JOIN,
    "window_join_stream": _WINDOW_JOIN,
    "earliest_stop": f"""
        with {_CARS}
        select car_id, coalesce(min(case when speed = 0 then ts_ms end), 9223372036854775807)
          as earliest_stop_ms
        from cars group by car_id""",
    "earliest_stop_per_window": f"""
        with {_CARS}
        select car_id, ts_ms//86400000*86400000 as window_start_ms,
          coalesce(min(case when speed = 0 then ts_ms end), 9223372036854775807)
          as earliest_stop_ms
        from cars group by all""",
    "earliest_stop_stream": f"""
        with {_on_time(_STOP_RECORDS, 30_000)}
        select car_id, window_start_ms, coalesce(min(case when stopped then event_ms end), 9223372036854775807)
          as earliest_stop_ms
        from on_time group by car_id, window_start_ms""",
    "rides_per_window_stream": f"""
        with {_on_time(_RIDE_RECORDS, DAY_MS)}
        select window_start_ms, count(*) as n_records, count(*) filter (where is_start) as n_starts
        from on_time group by window_start_ms""",
    "lateness_audit": """
        with arrivals as (
          select event_type as source, event_id, epoch_us(ts)//1000 as ts_ms,
            epoch_us(ts)//1000 + (event_id*7919 % 7200)*1000 as arrival_ms
          from events
        ),
        seen as (
          select *, max(ts_ms) over (partition by source order by arrival_ms, event_id
            rows between unbounded preceding and 1 preceding) - 30000 as watermark_ms
          from arrivals
        )
        select source, event_id, ts_ms, watermark_ms, coalesce(ts_ms <= watermark_ms, false) as is_late
        from seen""",
    "rides_stream": f"with {_RIDES} select ride_id, is_start, event_ms from timed",
    "fares_stream": f"""
        with {_FARES}
        select ride_id, payment_type, total_fare, start_ms as event_ms from fares""",
    "cars_stream": f"""
        with {_CARS} select id, car_id, speed, ts_ms//1000*1000 as ts_ms from cars""",
    "fan_out_rides": f"""
        with {_RIDES},
        lines as (select {_LINE_REFERENCE} as value, unnest([1, 2, 3]) as sink from rides)
        select value, cast(sink as integer) as sink from lines""",
    "order_rides": f"""
        with {_RIDES}
        select taxi_id, ride_id, is_start, row_number() over (
          partition by taxi_id order by event_ms, is_start desc, ride_id) as position
        from timed""",
    "order_cars": f"""
        with {_CARS}
        select car_id, id, row_number() over (partition by car_id order by ts_ms, id) as position
        from cars""",
    "unique_rides": f"""
        with {_RIDES}
        select {_RIDE_COLUMNS}, start_ms, end_ms from (
          select *, row_number() over (
            partition by ride_id order by event_ms, is_start desc) as place
          from timed)
        where place = 1""",
    "unique_fares": f"with {_FARES} select * exclude (start_time) from fares",
    "parse_mails": f"with {_MAILS} select * from mails",
    "distinct_mails": f"with {_MAILS} select * from firsts",
    "mail_lines": f"with {_MAILS} select {_MAIL_LINE} as value from firsts",
    "mail_archive_job": f"with {_MAILS} select {_MAIL_LINE} as value from firsts",
}
