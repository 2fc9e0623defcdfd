from collections import Counter

from wayfare.functions import codecs
from wayfare.operators import ordering
from wayfare.streaming import jobs, sinks

RIDE = "{},{},2013-01-01 00:0{}:00,2013-01-01 00:0{}:00,-73.98,40.75,-73.95,40.78,1,7,8"


def lines(texts):
    return texts(RIDE.format(1, "START", 1, 4), RIDE.format(1, "END", 4, 1), RIDE.format(2, "START", 4, 5))


def test_fan_out_reaches_every_sink_once_and_survives_a_restart(spark, texts, tmp_path):
    source = str(tmp_path / "rides")
    names = [str(tmp_path / f"sink{n}") for n in range(3)]

    def run():
        writers = [sinks.file_batch_writer(name, "text") for name in names]
        jobs.fan_out_rides(
            spark, source, writers, str(tmp_path / "checkpoint"), "roundtrip", available_now=True
        ).awaitTermination()
        return [Counter(r.value for r in spark.read.text(name).collect()) for name in names]

    lines(texts).write.text(source)
    expected = Counter(r.value for r in lines(texts).collect())
    assert run() == [expected] * 3
    assert run() == [expected] * 3
    texts(RIDE.format(3, "START", 6, 7)).write.mode("append").text(source)
    assert run() == [expected + Counter([RIDE.format(3, "START", 6, 7)])] * 3


def test_a_repeated_batch_replaces_itself(spark, texts, tmp_path):
    write = sinks.file_batch_writer(str(tmp_path / "out"), "text")
    for _ in range(2):
        write(lines(texts), 0)
    write(lines(texts), 1)
    assert spark.read.text(str(tmp_path / "out")).count() == 6


def test_writers_that_need_no_service_until_started(spark, texts, tmp_path):
    lines(texts).write.text(str(tmp_path / "rides"))
    stream = spark.readStream.text(str(tmp_path / "rides"))
    assert sinks.message_writer(stream, str(tmp_path / "c")) is not None
    assert callable(sinks.message_batch_writer())


def test_printing(spark, tmp_path):
    spark.range(50).selectExpr("cast(id as string) value").write.text(str(tmp_path / "numbers"))
    stream = spark.readStream.text(str(tmp_path / "numbers"))
    (tmp_path / "seen").mkdir()
    seen = str(tmp_path / "seen")

    def note(record):
        with open(f"{seen}/{record[0]}", "x"):
            pass

    for emit in ({}, {"emit": note}):
        query = sinks.print_stream(stream, **emit).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
    assert {path.name for path in (tmp_path / "seen").iterdir()} == {str(i) for i in range(50)}


def test_order_of_rides(texts):
    rides = codecs.parse_rides(lines(texts))
    ordered = [(r.ride_id, r.is_start) for r in ordering.order_rides(rides).collect()]
    assert ordered == [(1, True), (2, True), (1, False)]
    ranked = ordering.rank_rides(rides).collect()
    assert [(r.ride_id, r.is_start) for r in sorted(ranked, key=lambda r: r.position)] == ordered


def test_start_and_end_are_the_same_ride(texts):
    rides = codecs.parse_rides(lines(texts))
    unique = ordering.unique_rides(rides)
    assert unique.columns == rides.columns
    assert {(r.ride_id, r.is_start) for r in unique.collect()} == {(1, True), (2, True)}


def test_order_and_identity_of_cars(spark):
    cars = spark.sql(
        "select * from values ('b', 'x', timestamp'2013-01-01 00:00:02'), "
        "('a', 'x', timestamp'2013-01-01 00:00:02'), ('a', 'x', timestamp'2013-01-01 00:00:01') "
        "as t(id, car_id, ts)"
    )
    assert [r.id for r in ordering.order_cars(cars).collect()] == ["a", "a", "b"]
    assert {(r.id, r.ts.second) for r in ordering.unique_cars(cars).collect()} == {("a", 1), ("b", 2)}
