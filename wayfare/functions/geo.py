"""City-grid geography as Column functions.

Longitudes and latitudes are ``float``. Differences are taken in float and widened afterwards, and
``cos`` gets degrees as they are: both are part of the expected results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.functions.numeric import floor_to_int, wrap_int

# Box edges in degrees, grid steps and counts, kilometres per degree.
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
GRID_COLUMNS = 250
GRID_ROWS = 400
DEGREE_KM = 110.25


def in_nyc(lon: Column, lat: Column) -> Column:
    """Inside the city box, edges included. NaN is not outside of anything, so it passes."""

    def inside(value: Column, low: float, high: float) -> Column:
        return F.isnan(value) | value.cast("double").between(low, high)

    return inside(lon, LON_WEST, LON_EAST) & inside(lat, LAT_SOUTH, LAT_NORTH)


def grid_x(lon: Column) -> Column:
    """Grid column, counted eastwards from the west edge."""
    offset = F.lit(-LON_WEST) - F.abs(lon).cast("double")
    return floor_to_int(offset / F.lit(DELTA_LON))


def grid_y(lat: Column) -> Column:
    """Grid row, counted southwards from the north edge."""
    offset = F.lit(LAT_NORTH) - lat.cast("double")
    return floor_to_int(offset / F.lit(DELTA_LAT))


def grid_cell(lon: Column, lat: Column) -> Column:
    """Cell id; points outside the box get negative or aliased ids."""
    row_start = grid_y(lat).cast("bigint") * F.lit(GRID_COLUMNS)
    return wrap_int(grid_x(lon).cast("bigint") + row_start)


def cell_center_lon(cell: Column) -> Column:
    column = cell % F.lit(GRID_COLUMNS)
    west = F.lit(-LON_WEST) - column * F.lit(DELTA_LON) - F.lit(DELTA_LON / 2)
    return -west.cast("float")


def cell_center_lat(cell: Column) -> Column:
    column = cell % F.lit(GRID_COLUMNS)
    row = ((cell.cast("bigint") - column) / F.lit(GRID_COLUMNS)).cast("int")
    return (F.lit(LAT_NORTH) - row * F.lit(DELTA_LAT) - F.lit(DELTA_LAT / 2)).cast("float")


def euclidean_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Kilometres between two points, on a plane stretched by the second point's latitude."""
    north = (lat1 - lat2).cast("double")
    east = (lon1 - lon2).cast("double") * F.cos(lat2.cast("double"))
    return F.lit(DEGREE_KM) * F.sqrt(north * north + east * east)


def direction_angle(
    start_lon: Column, start_lat: Column, dest_lon: Column, dest_lat: Column
) -> Column:
    """Direction in whole degrees, -1 to 359.

    Between equal longitudes the eastward part is a zero with the sign of the cosine, which makes
    half a turn of difference between equal points. Spark's ``atan2`` drops the sign of a zero, so
    a negative one is replaced by a number too small to matter otherwise.
    """
    north = (dest_lat - start_lat).cast("double")
    lon_step = dest_lon - start_lon
    stretch = F.cos(start_lat.cast("double"))
    east = F.when((lon_step == 0) & (stretch < 0), F.lit(-1e-300)).otherwise(
        lon_step.cast("double") * stretch
    )
    degrees = F.nanvl(F.degrees(F.atan2(north, east)), F.lit(0.0))
    return degrees.cast("int") + F.lit(179)


def distance_to_point(lon: Column | float, lat: Column | float) -> Column:
    """Kilometres from a point to a ride's start (START record) or end (END record)."""
    lon = F.lit(lon) if not isinstance(lon, Column) else lon
    lat = F.lit(lat) if not isinstance(lat, Column) else lat
    point = (lon.cast("float"), lat.cast("float"))
    return F.when(
        F.col("is_start"), euclidean_distance(*point, F.col("start_lon"), F.col("start_lat"))
    ).otherwise(euclidean_distance(*point, F.col("end_lon"), F.col("end_lat")))


def keyed_uniform(seed: int, *key: Column) -> Column:
    """A number in [0, 1), fixed by the seed and the key alone: 52 bits of a hash of both.

    Unlike ``rand``, whose numbers follow the partitions and the rows before, it stays the same however often or wherever
    a row is computed. Null counts as a key of its own.
    """
    parts = [F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("")) for column in key]
    text = F.concat_ws(":", F.lit(str(seed)), *parts)
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return bits / F.lit(2.0**52)


def random_nyc_lon(seed: int, *key: Column) -> Column:
    """A random longitude in the box for each key."""
    return (F.lit(LON_EAST) - F.lit(LON_EAST - LON_WEST) * keyed_uniform(seed, *key)).cast("float")


def random_nyc_lat(seed: int, *key: Column) -> Column:
    """A random latitude in the box for each key."""
    return (F.lit(LAT_SOUTH) + F.lit(LAT_NORTH - LAT_SOUTH) * keyed_uniform(seed, *key)).cast("float")
