import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wayfare.functions import geo
from wayfare.functions import grid_path as grid_path_module
from wayfare.functions.grid_path import grid_path, way_cells


def one(spark, values, schema, expression):
    return spark.createDataFrame([values], schema).select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "lon, lat, expected",
    [
        (-73.9, 40.7, True),
        (-73.7, 40.7, False),  # as a float just east of the edge
        (-74.05, 40.7, False),  # as a float just west of the edge
        (-73.9, 41.0, True),
        (-73.9, 40.5, True),
        (-73.9, 41.1, False),
        (-73.9, 40.4, False),
        (float("nan"), 40.7, True),
        (-73.9, float("nan"), True),
        (float("nan"), 50.0, False),
    ],
)
def test_box(spark, lon, lat, expected):
    inside = geo.in_nyc(F.col("lon"), F.col("lat"))
    assert one(spark, (lon, lat), "lon float, lat float", inside) is expected


@pytest.mark.parametrize(
    "lon, lat, expected",
    [
        (-74.05, 41.0, -1),  # float -74.05 is west of the edge
        (-74.0493, 40.9994, 0),
        (-74.0479, 40.9981, 251),
        (-74.06, 41.01, -8 - 8 * 250),
        (0.0, 0.0, 52892 + 32800 * 250),
        (float("nan"), 40.9994, 0),
        (float("nan"), float("nan"), 0),
        # saturated column plus a row start, with 32 bits
        (1e30, 40.9994, -(2**31)),
        (-74.0493, -1e30, -250),
    ],
)
def test_grid_cell(spark, lon, lat, expected):
    cell = geo.grid_cell(F.col("lon"), F.col("lat"))
    assert one(spark, (lon, lat), "lon float, lat float", cell) == expected


def test_centers_map_back_to_their_cells(spark):
    cells = spark.range(250 * 400).select(F.col("id").cast("int").alias("cell"))
    centers = cells.select(
        "cell",
        geo.cell_center_lon(F.col("cell")).alias("lon"),
        geo.cell_center_lat(F.col("cell")).alias("lat"),
    )
    assert centers.filter(geo.grid_cell(F.col("lon"), F.col("lat")) != F.col("cell")).count() == 0


def test_centers_of_negative_cells_keep_the_sign(spark):
    lon = geo.cell_center_lon(F.col("cell"))
    lat = geo.cell_center_lat(F.col("cell"))
    assert one(spark, (-1,), "cell int", lon) == pytest.approx(-74.0507, abs=1e-5)
    assert one(spark, (-1,), "cell int", lat) == pytest.approx(40.999375, abs=1e-5)


CORNERS = "a float, b float, c float, d float"


def test_distance_takes_degrees_for_radians(spark):
    lon1, lat1, lon2, lat2 = (np.float32(v) for v in (-73.98, 40.75, -73.95, 40.78))
    north = float(lat1 - lat2)
    east = float(lon1 - lon2) * np.cos(float(lat2))
    distance = geo.euclidean_distance(*(F.col(c) for c in "abcd"))
    values = tuple(float(v) for v in (lon1, lat1, lon2, lat2))
    assert one(spark, values, CORNERS, distance) == pytest.approx(
        110.25 * np.sqrt(north**2 + east**2), rel=1e-12
    )


@pytest.mark.parametrize(
    "corners, expected",
    [
        ((-73.9, 40.7, -73.9, 40.8), 90 + 179),  # latitude grows: a quarter turn
        ((-73.9, 40.8, -73.9, 40.7), -90 + 179),
        ((-73.9, 40.7, -73.8, 40.7), 180 + 179),  # cos(40.7) is negative
        ((-73.8, 40.7, -73.9, 40.7), 179),
        ((-73.9, 40.7, -73.9, 40.7), 359),  # zero vector, negative cosine
        ((0.0, 0.0, 0.0, 0.0), 179),  # zero vector, positive cosine
    ],
)
def test_direction(spark, corners, expected):
    direction = geo.direction_angle(*(F.col(c) for c in "abcd"))
    assert one(spark, corners, CORNERS, direction) == expected


def test_distance_to_point_uses_start_or_end(spark):
    rides = spark.createDataFrame(
        [(True, -73.9, 40.7, -73.8, 40.8), (False, -73.9, 40.7, -73.8, 40.8)],
        "is_start boolean, start_lon float, start_lat float, end_lon float, end_lat float",
    )
    at_start = rides.select(geo.distance_to_point(-73.9, 40.7).alias("d")).collect()
    at_end = rides.select(geo.distance_to_point(-73.8, 40.8).alias("d")).collect()
    assert at_start[0].d == 0 and at_start[1].d > 1
    assert at_end[1].d == 0 and at_end[0].d > 1


def test_random_points_are_repeatable_and_inside(spark):
    draws = (geo.random_nyc_lon(1, F.col("id")).alias("lon"), geo.random_nyc_lat(2, F.col("id")).alias("lat"))
    points = spark.range(1000).select("id", *draws)
    assert sorted(points.collect()) == sorted(spark.range(1000).repartition(7, "id").select("id", *draws).collect())
    assert points.select("lon").distinct().count() > 900
    uniform = spark.range(4000).select(geo.keyed_uniform(5, F.col("id"), F.lit(None)).alias("u"))
    spread = uniform.agg(F.min("u"), F.avg("u"), F.max("u"), F.stddev("u")).first()
    assert 0 <= spread[0] < 0.01 and abs(spread[1] - 0.5) < 0.02 and 0.99 < spread[2] < 1 and abs(spread[3] - 0.2887) < 0.01
    apart = (F.lit(None), F.lit(""), F.lit("="))
    assert len(set(spark.range(1).select(*(geo.keyed_uniform(5, key) for key in apart)).first())) == 3
    assert points.filter(geo.in_nyc(F.col("lon"), F.col("lat"))).count() >= 999


def walk(x1, y1, x2, y2):
    """The same way, one step after another."""
    if x1 > x2:
        x1, y1, x2, y2 = x2, y2, x1, y1
    slope = (y2 - y1) / ((x2 - x1) + 1e-8)
    sign = 1 if slope > 0 else -1
    x, y, cells = x1, y1, [x1 + 250 * y1]
    while x < x2 or y != y2:
        height = (x - x1 + 0.5) * slope + y1 - 0.5 * sign
        if y - 0.05 < height < y + 0.05:
            x, y = x + (1 if sign > 0 else 2), y + sign
        elif (height - y) * sign < 0:
            x += 1
        else:
            y += sign
        cells.append(x + 250 * y)
    return cells


@pytest.mark.parametrize(
    "way, expected",
    [
        ((3, 2, 3, 2), [503]),
        ((0, 1, 1, 0), [250, 2]),
        ((0, 0, 3, 0), [0, 1, 2, 3]),
        ((3, 0, 0, 0), [0, 1, 2, 3]),
        ((5, 0, 5, 2), [5, 255, 505]),
        ((5, 2, 5, 0), [505, 255, 5]),
        ((0, 0, 2, 2), [0, 251, 502]),
    ],
)
def test_ways_by_hand(way, expected):
    cells, lengths = way_cells(*(np.array([v]) for v in way))
    assert cells.tolist() == expected and lengths.tolist() == [len(expected)]


def assert_same_ways(ways):
    cells, lengths = way_cells(*np.array(ways, dtype=np.int64).T)
    pieces = np.split(cells, np.cumsum(lengths)[:-1])
    for way, piece in zip(ways, pieces):
        assert piece.tolist() == walk(*way), way


def test_all_small_ways_in_one_batch():
    assert_same_ways([(2, y, 2 + w, y + d) for w in range(31) for d in range(-31, 32) for y in (0, 9)])


corner = st.tuples(st.integers(-60, 320), st.integers(-60, 460))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(corner, corner), min_size=1, max_size=40))
def test_random_ways(pairs):
    assert_same_ways([(*a, *b) for a, b in pairs])


def test_path_column_over_nulls_and_long_ways(spark):
    points = spark.createDataFrame(
        [
            (-74.0493, 40.9994, -74.0465, 40.9994),
            (None, 40.7, -73.9, 40.7),
            (0.0, 0.0, -73.9, 40.7),  # empty fields of a record are zero: over 85,000 cells
            (-74.0465, 40.9994, -74.0493, 40.9994),
        ],
        CORNERS,
    )
    paths = points.select(grid_path(*(F.col(c) for c in "abcd")).alias("p"))
    first, missing, long, back = [row.p for row in paths.coalesce(1).collect()]
    assert first == back == [0, 1, 2]
    assert missing is None
    x, y = 107, 239
    assert long == walk(52892, 32800, x, y)
    corrupt = spark.createDataFrame([(1e30, 0.0, 0.0, 0.0)], CORNERS)
    with pytest.raises(PySparkException, match="corrupt coordinates"):
        corrupt.select(grid_path(*(F.col(c) for c in "abcd"))).collect()


def streamed(ways):
    found = [[] for _ in ways]
    for way, step, cells in grid_path_module.stream_of_cells(*np.array(ways, dtype=np.int64).T):
        assert len(cells) <= grid_path_module.CELLS_PER_BATCH
        for number, place, cell in zip(way.tolist(), step.tolist(), cells.tolist()):
            assert place == len(found[number])
            found[number].append(cell)
    return found


@pytest.mark.parametrize("chunk,batch", [(5, 3), (7, 100), (16, 4), (1000, 11)])
def test_ways_made_in_pieces(monkeypatch, chunk, batch):
    monkeypatch.setattr(grid_path_module, "CELLS_PER_CHUNK", chunk)
    monkeypatch.setattr(grid_path_module, "CELLS_PER_BATCH", batch)
    ways = [(2, 9, 2 + w, 9 + d) for w in range(0, 41, 2) for d in range(-41, 42, 3)]
    ways += [(0, 0, 300, -300), (0, 0, 300, 300), (0, 0, 300, -299), (0, 0, 4, 500), (0, 5, 200, 5), (7, 7, 7, -90)]
    assert streamed(ways) == [walk(*way) for way in ways]


@settings(max_examples=40, deadline=None)
@given(corner, corner, st.integers(5, 60))
def test_random_ways_in_pieces(one, other, chunk):
    before = grid_path_module.CELLS_PER_CHUNK
    grid_path_module.CELLS_PER_CHUNK = chunk
    try:
        assert streamed([(*one, *other)]) == [walk(*one, *other)]
    finally:
        grid_path_module.CELLS_PER_CHUNK = before


def test_a_way_across_the_number_range_is_never_held():
    ends = [np.array([value]) for value in (-(2**31), 2**31 - 1, 2**31 - 1, -(2**31))]
    cells = grid_path_module.stream_of_cells(*ends)
    sizes = [len(next(cells)[2]) for _ in range(30)]
    assert max(sizes) == grid_path_module.CELLS_PER_BATCH


def test_a_row_for_each_cell(spark):
    points = spark.createDataFrame(
        [(-74.0493, 40.9994, -74.0465, 40.9994), (None, 40.7, -73.9, 40.7), (0.0, 0.0, -73.9, 40.7)], CORNERS
    )
    named = points.withColumn("name", F.when(F.col("a") < 0, "short").when(F.col("a") == 0, "long").otherwise("unknown"))
    cells = grid_path_module.path_cells(named, *(F.col(c) for c in "abcd"))
    assert cells.columns == [*"abcd", "name", "step", "cell"]
    rows = sorted((row["name"], row["step"], row["cell"]) for row in cells.collect())
    assert [cell for name, _, cell in rows if name == "short"] == [0, 1, 2]
    assert [cell for name, _, cell in rows if name == "long"] == walk(52892, 32800, 107, 239)
    assert {name for name, *_ in rows} == {"short", "long"}
    assert grid_path_module.path_cells(points.limit(0), *(F.col(c) for c in "abcd")).count() == 0


def test_path_batches_are_cut_by_their_work(spark):
    points = spark.range(400, numPartitions=1).selectExpr(
        "cast(0 as float) a", "cast(0 as float) b",
        "cast(-20 - id / 100 as float) c", "cast(10 as float) d",
    )
    sizes = points.select(
        F.size(grid_path(*(F.col(c) for c in "abcd"))).alias("n"),
        (geo.grid_x(F.col("a")) - geo.grid_x(F.col("c"))).alias("w"),
    )
    assert sizes.filter("n <= w").count() == 0 and sizes.count() == 400
