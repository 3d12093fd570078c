"""Nearest stops and stops within a distance."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopclock.functions.geo import (
    EARTH_RADIUS_M,
    degrees_for,
    ellipsoidal_m,
    haversine_m,
)

STOP_COLUMNS = ("stop_id", "stop_code", "stop_name", "latitude", "longitude")


def _located(df: DataFrame) -> DataFrame:
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def nearest_stops(
    stops: DataFrame,
    latitude: float,
    longitude: float,
    limit: int = 10,
    ellipsoidal: bool = False,
    clamp: bool = False,
) -> DataFrame:
    """The ``limit`` stops closest to a point, closest first, with metres.

    The order is by the great circle; ``ellipsoidal`` reports the distance on WGS 84.
    ``clamp`` brings ``limit`` into 1..25 instead of refusing it.
    """
    if not (-90 <= latitude <= 90 and -180 <= longitude <= 180):
        raise ValueError("latitude must be -90..90, longitude -180..180")
    if clamp:
        limit = max(1, min(limit, 25))
    elif not 1 <= limit <= 100:
        raise ValueError("limit must be 1..100")
    here = (F.lit(float(latitude)), F.lit(float(longitude)))
    there = (F.col("latitude"), F.col("longitude"))
    shown = ellipsoidal_m if ellipsoidal else haversine_m
    return (
        _located(stops)
        .select(
            *STOP_COLUMNS,
            shown(*here, *there).alias("distance_m"),
            haversine_m(*here, *there).alias("_sphere"),
        )
        .orderBy("_sphere", "stop_id")
        .limit(limit)
        .drop("_sphere")
    )


# --- k nearest for many points -------------------------------------------------------
#
# Stops are counted in nested grids, each cell of a level split 8 x 8 on the next.  A
# point starts with all cells of a coarse level and keeps those that can still hold one
# of its k nearest: a cell lies within its half diagonal of its centre, so once the
# closest cells hold k stops, everything farther than that plus two half diagonals is out.
# The survivors are replaced by their children until cells are small, and only then do
# stops meet points.  Whatever the crowding, a point never sees more than a ring of small
# cells around its k-th stop, so no cell full of points meets a cell full of stops.

FANOUT = 8
TOP_DEGREES = 45.0
LEVELS = 8  # the last one has cells of about two metres
START_CELLS = 64
CELL_STOPS = 16
SLACK_M = 0.01


def _side(level: int) -> float:
    return TOP_DEGREES / FANOUT**level


def _half_diagonal_m(level: int) -> float:
    return EARTH_RADIUS_M * math.radians(_side(level)) / math.sqrt(2)


def _cell(level: int) -> list[Column]:
    side = _side(level)
    rows, cols = round(180 / side), round(360 / side)
    row = F.least(F.floor((F.col("latitude") + 90) / side), F.lit(rows - 1))
    col = F.pmod(F.floor((F.col("longitude") + 180) / side), F.lit(cols))
    return [row.cast("int").alias("row"), col.cast("int").alias("col")]


def _centre_distance(level: int, row: Column, col: Column) -> Column:
    side = _side(level)
    return haversine_m(
        F.col("p_lat"), F.col("p_lon"), (row + 0.5) * side - 90, (col + 0.5) * side - 180
    )


def _cell_counts(places: DataFrame, level: int) -> DataFrame:
    return places.groupBy(*_cell(level)).agg(F.sum("n").alias("n"))


def _choose_levels(places: DataFrame) -> tuple[int, int]:
    """First level to look at, and the level whose cells are small enough."""
    per_level = F.explode(
        F.array(
            *[
                F.struct(F.lit(level).alias("level"), *_cell(level))
                for level in range(LEVELS)
            ]
        )
    )
    sizes = (
        places.select(per_level.alias("c"), "n")
        .groupBy("c")
        .agg(F.sum("n").alias("n"))
        .groupBy("c.level")
        .agg(F.count("*").alias("cells"), F.max("n").alias("fullest"))
    )
    by_level = {r["level"]: r for r in sizes.collect()}  # one row per level
    if not by_level:
        return 0, 0
    start = max(i for i in by_level if i == 0 or by_level[i]["cells"] <= START_CELLS)
    end = next(
        (i for i in range(start, LEVELS) if by_level[i]["fullest"] <= CELL_STOPS), LEVELS - 1
    )
    return start, end


def nearest_stops_join(
    points: DataFrame, stops: DataFrame, k: int, point_id: str = "point_id"
) -> DataFrame:
    """The ``k`` nearest stops of every point, exactly; equal distances go by stop id.

    ``points`` has a unique id, ``latitude`` and ``longitude``.  Runs one small job at
    once: cell counts per grid level, from which the levels to use follow.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    # Of the stops at one and the same place only the first k can be among the nearest.
    same_place = Window.partitionBy("latitude", "longitude").orderBy("stop_id")
    kept = (
        _located(stops)
        .select(*STOP_COLUMNS)
        .withColumn("_n", F.row_number().over(same_place))
        .filter(F.col("_n") <= k)
        .drop("_n")
    )
    places = kept.groupBy("latitude", "longitude").agg(F.count("*").alias("n"))
    start, end = _choose_levels(places)

    asked = _located(points).select(
        F.col(point_id), F.col("latitude").alias("p_lat"), F.col("longitude").alias("p_lon")
    )
    # At most START_CELLS cells, by the choice of the level.
    cells = (
        _cell_counts(places, start).agg(F.collect_list(F.struct("row", "col", "n"))).scalar()
    )
    frontier = _first_frontier(asked.withColumn("cells", cells), start, k, point_id)
    for level in range(start + 1, end + 1):
        frontier = _descend(frontier, places, level, k, point_id)

    stops_in_cells = kept.select(*STOP_COLUMNS, *_cell(end))
    distance = haversine_m(
        F.col("p_lat"), F.col("p_lon"), F.col("latitude"), F.col("longitude")
    )
    rank = Window.partitionBy(point_id).orderBy("distance_m", "stop_id")
    return (
        frontier.join(stops_in_cells, ["row", "col"])
        .select(point_id, *STOP_COLUMNS, distance.alias("distance_m"))
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
    )


def _first_frontier(asked: DataFrame, level: int, k: int, point_id: str) -> DataFrame:
    """The cells of the list that can hold one of the k nearest, without a shuffle.

    The list with its distances and the reach are columns of their own, computed once per
    point before the list is opened.
    """
    measured = F.transform(
        F.col("cells"),
        lambda c: F.struct(
            _centre_distance(level, c["row"], c["col"]).alias("d"),
            c["row"].alias("row"),
            c["col"].alias("col"),
            c["n"].alias("n"),
        ),
    )
    none = F.lit(None).cast("double")
    reach = F.aggregate(
        F.col("measured"),
        F.struct(F.lit(0).cast("long").alias("n"), none.alias("d")),
        lambda acc, c: F.struct(
            (acc["n"] + c["n"]).alias("n"),
            F.coalesce(acc["d"], F.when(acc["n"] + c["n"] >= k, c["d"])).alias("d"),
        ),
        lambda acc: F.coalesce(acc["d"], F.lit(float("inf"))),
    )
    place = [point_id, "p_lat", "p_lon"]
    return (
        asked.select(*place, F.sort_array(measured).alias("measured"))
        .select(*place, "measured", reach.alias("reach"))
        .select(*place, "reach", F.inline("measured"))
        .filter(F.col("d") <= F.col("reach") + (2 * _half_diagonal_m(level) + SLACK_M))
        .select(*place, "row", "col")
    )


def _descend(
    frontier: DataFrame, places: DataFrame, level: int, k: int, point_id: str
) -> DataFrame:
    """Cells of the level above to those children that can hold one of the k nearest."""
    # At most FANOUT * FANOUT children per cell, so the list is short.
    children = (
        _cell_counts(places, level)
        .groupBy(
            F.floor(F.col("row") / FANOUT).cast("int").alias("up_row"),
            F.floor(F.col("col") / FANOUT).cast("int").alias("up_col"),
        )
        .agg(F.collect_list(F.struct("row", "col", "n")).alias("children"))
        .toDF("row", "col", "children")
    )
    opened = (
        frontier.join(children, ["row", "col"])
        .select(point_id, "p_lat", "p_lon", F.inline("children"))
        .withColumn("d", _centre_distance(level, F.col("row"), F.col("col")))
    )
    of_point = Window.partitionBy(point_id)
    closest = of_point.orderBy("d", "row", "col").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reach = F.min(F.when(F.col("seen") >= k, F.col("d"))).over(of_point)
    return (
        opened.withColumn("seen", F.sum("n").over(closest))
        .withColumn("reach", F.coalesce(reach, F.lit(float("inf"))))
        .filter(F.col("d") <= F.col("reach") + (2 * _half_diagonal_m(level) + SLACK_M))
        .select(point_id, "p_lat", "p_lon", "row", "col")
    )


# --- within a distance ---------------------------------------------------------------

#: Pairs to compare that a piece of a cell and a task hold at most, and rows of a task.
PIECE_PAIRS, TASK_PAIRS, TASK_ROWS = 2_000_000, 20_000_000, 1_000_000


def stops_within(
    points: DataFrame, stops: DataFrame, radius_m: float, point_id: str = "point_id"
) -> DataFrame:
    """All (point, stop) pairs at most ``radius_m`` apart.

    Rows of the grid are as tall as the radius, and its columns in each row as wide as the
    radius can reach there, so a partner is in the same or an adjacent row and column.  The
    stops of a crowded cell are dealt over pieces that each meet its points, and the pieces
    over tasks by the pairs to compare, whose number grows with both tables.  Runs one small
    job at once: the counts of the cells.
    """
    if radius_m <= 0:
        raise ValueError("radius_m must be positive")
    height = min(degrees_for(radius_m) * (1 + 1e-9), 180.0)
    half = math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2))

    def columns_in(row: Column) -> Column:
        """Number of columns of a grid row; one near the poles."""
        south, north = row * height - 90, (row + 1) * height - 90
        edge = F.least(F.greatest(F.abs(south), F.abs(north)) + height, F.lit(90.0))
        reach = F.asin(F.least(F.lit(1.0), F.lit(half) / F.greatest(F.cos(F.radians(edge)), F.lit(1e-12))))
        return F.greatest(F.floor(F.lit(math.pi * (1 - 1e-9)) / reach), F.lit(1)).cast("int")

    def row_of(lat: Column) -> Column:
        return F.floor((lat + 90) / height).cast("int")

    def column_of(lon: Column, n: Column) -> Column:
        return F.pmod(F.floor((lon + 180) / 360 * n).cast("int"), n)

    lat, lon = F.col("latitude"), F.col("longitude")
    placed = _located(stops).select(
        *STOP_COLUMNS,
        row_of(lat).alias("row"),
        column_of(lon, columns_in(row_of(lat))).alias("col"),
    )

    def cells_in(row: Column) -> Column:
        n = columns_in(row)
        c = column_of(F.col("p_lon"), n)
        ring = F.array(*[F.pmod(c + step, n) for step in (-1, 0, 1)])
        return F.transform(
            F.array_distinct(ring), lambda x: F.struct(row.alias("row"), x.alias("col"))
        )

    here = row_of(F.col("p_lat"))
    around = F.flatten(F.array(*[cells_in(here + step) for step in (-1, 0, 1)]))
    asked = _located(points).select(
        F.col(point_id), lat.alias("p_lat"), lon.alias("p_lon")
    )
    distance = haversine_m(F.col("p_lat"), F.col("p_lon"), lat, lon)
    opened = asked.select(point_id, "p_lat", "p_lon", F.inline(around))
    cell = ["row", "col"]
    of_points = opened.groupBy(*cell).agg(F.count("*").alias("n_points"))
    of_stops = placed.groupBy(*cell).agg(F.count("*").alias("n_stops"))
    sizes = of_points.join(of_stops, cell).withColumn("pairs", F.col("n_points") * F.col("n_stops"))
    pairs, rows = sizes.agg(
        F.coalesce(F.sum("pairs"), F.lit(0)),
        F.coalesce(F.sum(F.col("n_points") + F.col("n_stops")), F.lit(0)),
    ).first()
    tasks = 1 + pairs // TASK_PAIRS + rows // TASK_ROWS
    if tasks > 1:
        # Both tables are small beside their pairs, so tasks by the size of tables would be few.
        tasks = max(tasks, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        pieces = sizes.select(*cell, F.ceil(F.col("pairs") / PIECE_PAIRS).cast("int").alias("pieces"))
        number = F.pmod(F.xxhash64(*STOP_COLUMNS), F.col("pieces")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
        cell = [*cell, "piece"]
        placed = placed.join(pieces, ["row", "col"]).withColumn("piece", number).repartition(tasks, *cell)
        opened = opened.join(pieces, ["row", "col"]).withColumn("piece", every).repartition(tasks, *cell)
    return (
        opened.join(placed, cell)
        .select(point_id, *STOP_COLUMNS, distance.alias("distance_m"))
        .filter(F.col("distance_m") <= radius_m)
    )
