"""Incident lines and the boxes that they cross."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.columns import field

#: Positions further out than this are no longitude or latitude.
FARTHEST = 360.0
#: What a line's reach inside of a column of cells is widened by, as a share of a cell.
SLACK = 1e-6


def paths(coordinates: Column) -> Column:
    """Coordinates of a point, a line or several lines, as text -> array of paths, each an array of ``[lon, lat]``.

    The number of brackets at the beginning tells which of them it is. A path with a position that
    isn't a pair of numbers in range is left out; a text that doesn't parse has no paths.
    """
    depth = F.length(F.regexp_replace(F.regexp_extract(coordinates, r"^[\s\[]*", 0), r"\s", ""))
    whole = F.when(depth == 1, F.concat(F.lit("[["), coordinates, F.lit("]]")))
    whole = whole.when(depth == 2, F.concat(F.lit("["), coordinates, F.lit("]"))).when(depth == 3, coordinates)
    found = F.from_json(whole, "array<array<array<double>>>", {"mode": "PERMISSIVE"})

    def placed(position: Column) -> Column:
        return F.coalesce((F.abs(F.get(position, F.lit(0))) <= FARTHEST) & (F.abs(F.get(position, F.lit(1))) <= FARTHEST), F.lit(False))

    kept = F.filter(found, lambda path: F.coalesce((F.size(path) > 0) & F.forall(path, placed), F.lit(False)))
    return F.coalesce(kept, F.array().cast("array<array<array<double>>>"))


def segments(lines: Column) -> Column:
    """Paths -> array of ``struct(x0, y0, x1, y1)``; a path of one position is a segment of no length."""

    def of_path(path: Column) -> Column:
        def leave(position: Column, at: Column) -> Column:
            to = F.coalesce(F.get(path, at + 1), F.when(F.size(path) == 1, position))
            ends = {"x0": position[0], "y0": position[1], "x1": F.get(to, F.lit(0)), "y1": F.get(to, F.lit(1))}
            return F.struct(*[end.alias(name) for name, end in ends.items()])

        return F.filter(F.transform(path, leave), lambda s: s["x1"].isNotNull())

    return F.flatten(F.transform(lines, of_path))


def cover(parts: Column, cell: float) -> Column:
    """Segments -> distinct grid cells ``struct(cx, cy)`` that they run through, column of cells by column."""

    def of_segment(s: Column) -> Column:
        left, right = F.least(s["x0"], s["x1"]), F.greatest(s["x0"], s["x1"])
        slope = (s["y1"] - s["y0"]) / F.nullif(s["x1"] - s["x0"], F.lit(0.0))

        def of_column(cx: Column) -> Column:
            ends = (F.greatest(left, cx * cell), F.least(right, (cx + 1) * cell))
            enter, leave = (s["y0"] + (x - s["x0"]) * slope for x in ends)
            low = F.coalesce(F.least(enter, leave), F.least(s["y0"], s["y1"]))  # an upright segment has no slope
            high = F.coalesce(F.greatest(enter, leave), F.greatest(s["y0"], s["y1"]))
            rows = F.sequence(F.floor(low / cell - SLACK), F.floor(high / cell + SLACK))
            return F.transform(rows, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

        return F.flatten(F.transform(F.sequence(F.floor(left / cell), F.floor(right / cell)), of_column))

    return F.array_distinct(F.flatten(F.transform(parts, of_segment)))


def clipped(s: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """``struct(enter, leave)``: the shares of a segment at which it comes into a box and goes out; it meets the box if enter <= leave."""
    min_lon, min_lat, max_lon, max_lat = box

    def axis(start: Column, end: Column, low: Column, high: Column) -> tuple[Column, Column]:
        run = F.nullif(end - start, F.lit(0.0))
        at_low, at_high = (low - start) / run, (high - start) / run
        beside = F.when(start.between(low, high), 0.0).otherwise(2.0)  # a segment along the edges is inside all the way or never
        return F.coalesce(F.least(at_low, at_high), beside), F.coalesce(F.greatest(at_low, at_high), F.lit(1.0))

    (in_x, out_x), (in_y, out_y) = axis(s["x0"], s["x1"], min_lon, max_lon), axis(s["y0"], s["y1"], min_lat, max_lat)
    return F.struct(F.greatest(F.lit(0.0), in_x, in_y).alias("enter"), F.least(F.lit(1.0), out_x, out_y).alias("leave"))


def lines_in_boxes(lines: DataFrame, boxes: DataFrame, coordinates: str = "coordinates", cell: float = 1.0) -> DataFrame:
    """Lines with each city whose box ``(city, min_lon, min_lat, max_lon, max_lat)`` they run through or touch.

    Adds ``city``, ``segments``, how many segments meet the box, and ``inside``, the length inside
    of it in degrees; a line whose positions all lie outside counts if a segment crosses. Edges belong to the box.

    Lines and boxes meet on grid cells by an equality join: the box table is broadcast if Spark finds it small, and a
    crowded cell is split by the adaptive skew join. A pair that shares several cells is kept in the
    first of the line's cells that the box has, so that nothing has to be made distinct after the join.
    A line is copied once per cell that it runs through; ``cell`` should be about as wide as a box.
    Lines without a position in range meet no box. ``coordinates`` goes away, all other columns stay.
    """
    if cell <= 0:
        raise ValueError("cells need a width")
    edges = ("min_lon", "min_lat", "max_lon", "max_lat")
    spans = {f"_{name}": F.floor(F.col(name) / cell) for name in edges}
    columns, rows = (F.explode(F.sequence(F.col(f"_min_{axis}"), F.col(f"_max_{axis}"))) for axis in ("lon", "lat"))
    gridded = (
        boxes.select("city", *edges).where("min_lon <= max_lon and min_lat <= max_lat")
        .withColumns(spans).withColumn("_cx", columns).withColumn("_cy", rows)
    )
    rest = [c for c in lines.columns if c != coordinates]
    parted = lines.select(*map(field, rest), segments(paths(field(coordinates).cast("string"))).alias("_parts"))
    covered = parted.withColumn("_cells", cover(F.col("_parts"), cell)).withColumn("_cell", F.explode("_cells"))
    placed = covered.withColumns({"_cx": F.col("_cell")["cx"], "_cy": F.col("_cell")["cy"]})
    first = F.get(
        F.filter(
            "_cells", lambda c: c["cx"].between(F.col("_min_lon"), F.col("_max_lon")) & c["cy"].between(F.col("_min_lat"), F.col("_max_lat"))
        ),
        F.lit(0),
    )
    box = tuple(F.col(name) for name in edges)

    def within(s: Column) -> Column:
        length = F.sqrt((s["x1"] - s["x0"]) * (s["x1"] - s["x0"]) + (s["y1"] - s["y0"]) * (s["y1"] - s["y0"]))
        at = clipped(s, box)
        return F.when(at["enter"] <= at["leave"], (at["leave"] - at["enter"]) * length)

    met = placed.join(gridded, ["_cx", "_cy"]).where(F.col("_cell") == first)
    lengths = met.select(*map(field, rest), "city", F.filter(F.transform("_parts", within), lambda x: x.isNotNull()).alias("_inside"))
    return lengths.where(F.size("_inside") > 0).select(
        *map(field, rest),
        "city",
        F.size("_inside").cast("bigint").alias("segments"),
        F.aggregate("_inside", F.lit(0.0), lambda total, x: total + x).alias("inside"),
    )
