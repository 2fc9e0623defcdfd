from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wayfare.functions import codecs
from wayfare.sources.messages import decode_rides
from wayfare.sources.text import read_rides
from wayfare.streaming.sinks import encode_rides

START = "1,START,2013-01-01 00:00:00,2013-01-01 00:10:00,-73.98,40.75,-73.95,40.78,1,7,8"
END = "1,END,2013-01-01 00:10:00,2013-01-01 00:00:00,-73.98,40.75,-73.95,40.78,1,7,8"
T0 = 1356998400000
T10 = T0 + 600_000


def ride_times(df):
    rows = df.select("is_start", F.unix_millis("start_time"), F.unix_millis("end_time")).collect()
    return [tuple(row) for row in rows]


def test_end_lines_carry_the_end_first(texts):
    assert ride_times(codecs.parse_rides(texts(START, END))) == [
        (True, T0, T10),
        (False, T0, T10),
    ]


def test_event_time_is_the_start_or_the_end(texts):
    times = codecs.parse_rides(texts(START, END)).select(F.unix_millis(codecs.ride_event_time()))
    assert [row[0] for row in times.collect()] == [T0, T10]


def test_trailing_commas_vanish_and_empty_floats_are_zero(texts):
    line = "2,START,2013-01-01 00:01:00,2013-01-01 00:05:00,,,-73.95,40.78,2,3,4,,"
    row = codecs.parse_rides(texts(line)).first()
    assert (row.start_lon, row.start_lat, row.passenger_cnt, row.driver_id) == (0.0, 0.0, 2, 4)


MALFORMED = [
    START.replace("START", "STOP"),
    START.replace(",1,7,8", ",99999,7,8"),
    START.replace(",1,7,8", ",1,7,"),
    START.replace(",1,7,8", ",1, 7 ,8"),
    START.replace(",1,7,8", ",1,7.0,8"),
    START.replace("-73.98", " "),
    START.replace("-73.98", "nan"),
    START.replace("-73.98", "x1"),
    START.replace("2013-01-01 00:10:00", "2013-13-01 00:10:00"),
    START.replace("2013-01-01 00:10:00", "2013-01-01"),
    START + ",9",
    "",
]


def test_malformed_rides_are_kept_apart(texts):
    parsed = codecs.parse_rides(texts(START, *MALFORMED, END), mode="quarantine")
    assert [r.value for r in codecs.bad_records(parsed).collect()] == MALFORMED
    assert codecs.good_records(parsed).count() == 2


@pytest.mark.parametrize("line", MALFORMED[:2] + MALFORMED[-1:])
def test_malformed_rides_fail_the_job(texts, line):
    with pytest.raises(PySparkException, match="Malformed record"):
        codecs.parse_rides(texts(START, line)).collect()


def test_failfast_also_fails_when_the_bad_column_is_not_used(texts):
    bad = START.replace(",1,7,8", ",99999,7,8")
    with pytest.raises(PySparkException, match="Malformed record"):
        codecs.parse_rides(texts(bad)).select("ride_id").collect()
    with pytest.raises(PySparkException, match="Malformed record"):
        codecs.parse_rides(texts(bad)).filter("ride_id = 5").count()


def test_parsing_runs_once_under_a_filter(texts):
    plan = codecs.parse_rides(texts(START)).filter("is_start")._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("split(") <= 1


def test_float_spellings(texts):
    spellings = ["NaN", "Infinity", "1e2", " 1.5 ", "1f"]
    lines = (START.replace("-73.98", spelling) for spelling in spellings)
    read = codecs.parse_rides(texts(*lines)).selectExpr("cast(start_lon as string) v")
    assert [r.v for r in read.collect()] == ["NaN", "Infinity", "100.0", "1.5", "1.0"]


def test_short_numbers_in_times(texts):
    line = START.replace("2013-01-01 00:00:00", "2013-1-1 0:0:00").replace(
        "2013-01-01 00:10:00", "813-1-1 0:10:00"
    )
    row = codecs.parse_rides(texts(line)).select(
        F.unix_millis("start_time"), F.year("end_time")
    ).first()
    assert tuple(row) == (T0, 813)


def test_reference_layout_swaps_the_times_of_an_end(texts):
    rides = codecs.parse_rides(texts(START, END))
    assert [r.value for r in encode_rides(rides).collect()] == [START, START.replace("START", "END")]
    assert ride_times(decode_rides(encode_rides(rides))) == [(True, T0, T10), (False, T10, T0)]


def test_roundtrip_layout(texts):
    rides = codecs.parse_rides(texts(START, END))
    binary = encode_rides(rides, "roundtrip").select(F.col("value").cast("binary"))
    assert decode_rides(binary).collect() == rides.collect()


def test_fares(texts):
    line = "1,2,3,2013-01-01 00:00:00,CSH,,1.5,20"
    fares = codecs.parse_fares(texts(line))
    row = fares.first()
    assert (row.payment_type, row.tip, row.tolls, row.total_fare) == ("CSH", 0.0, 1.5, 20.0)
    text = fares.select(codecs.fare_line().alias("v")).first().v
    assert text == "1,2,3,2013-01-01 00:00:00,CSH,0.0,1.5,20.0"
    no_payment_type = "1,2,3,2013-01-01 00:00:00,,,1.5,20"
    assert codecs.parse_fares(texts(no_payment_type)).first().payment_type == ""
    parsed = codecs.parse_fares(texts("1,2,3,2013-01-01 00:00:00,CSH,1,2,"), "quarantine")
    assert codecs.bad_records(parsed).count() == 1


def car_text(time="2013-01-01T00:00:00+0000", separator=",", **fields):
    values = {0: "car", 1: "id", 7: "1.5", 9: "0", 12: "3", 19: "", 20: "-73.9", 21: "40.7", 22: time}
    values.update({int(k[1:]): v for k, v in fields.items()})
    return separator.join(values.get(i, "-") for i in range(23))


@pytest.mark.parametrize("separator", [",", ";", ", ", ";\t "])
def test_cars(texts, separator):
    cars = codecs.parse_cars(texts(car_text(separator=separator)))
    row = cars.first()
    assert (row.car_id, row.id, row.consumption, row.speed) == ("car", "id", 1.5, 0.0)
    assert (row.throttle, row.engineload) == (3.0, 0.0)
    line = cars.select(codecs.car_line().alias("v")).first().v
    assert line == f"id,{T0},-73.9,40.7,0.0,3.0,0.0"


def test_car_offsets_and_bad_cars(texts):
    times = ["2013-01-01T00:00:00Z", "2013-01-01T02:00:00+02:00", "2013-01-01T02:00:00+0200"]
    cars = codecs.parse_cars(texts(*(car_text(t) for t in times)))
    assert {r[0] for r in cars.select(F.unix_millis("ts")).collect()} == {T0}
    bad = [car_text("2013-01-01T00:00:00"), car_text(_9="fast"), car_text() + ",x", car_text("")]
    good = [car_text() + "; ,", car_text(separator=";") + ";;;"]
    parsed = codecs.parse_cars(texts(*bad, *good), "quarantine")
    assert {r.value for r in codecs.bad_records(parsed).collect()} == set(bad)
    assert codecs.good_records(parsed).count() == 2


def test_gzipped_files(spark, texts, tmp_path):
    texts(START, END).coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "rides"))
    rides = read_rides(spark, str(tmp_path / "rides"), partitions=3)
    assert sorted(r.is_start for r in rides.collect()) == [False, True]
    assert rides.first().start_time.replace(tzinfo=timezone.utc) <= datetime.now(timezone.utc)


def test_unknown_arguments(texts):
    with pytest.raises(ValueError):
        codecs.parse_rides(texts(START), mode="ignore")
    with pytest.raises(ValueError):
        codecs.ride_line("other")
