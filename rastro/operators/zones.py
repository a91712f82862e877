"""Zones and districts of points.

The districts of a city are a small reference table. Their geometry is put into the plan as
constants, so assigning a zone is a projection: no shuffle, and no task depends on how many
points share a place. A grid over the city settles most points without looking at any edge.
"""

from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import Window
from pyspark.sql import functions as F

from rastro import schema as S
from rastro.functions import geometry as G
from rastro.operators.skew import salted_left_join
from rastro.session import scratch_path

EDGES_PER_CONSTANT = 50_000
# The geometry is part of the plan; more than this is no district table.
MAX_EDGES = 1_000_000
# The grid has at most (3 x 128 + 8)^2 cells whatever the data: that is what gets broadcast.
GRID_CELLS = 128  # along the longer side of the districts' envelope
GRID_MARGIN = 1  # envelopes around it
GRID_SPLIT = 8  # cells are first made 8 times as wide; those not settled are measured again

# A zone table of more rows is none; above the smaller number, points look only at centres near their cell.
MAX_ZONES = 10_000
FEW_ZONES = 64
# Cells along each side of the envelope of district boxes, and the bytes of their lists that are broadcast at most.
BOX_CELLS = 256
BROADCAST_BYTES = 64 << 20
SHOWN = 20  # names in an error

_NO_ZONE = "int(NULL)"


def district_shapes(districts):
    """Districts with bounding box and edges, for the geometry helpers."""
    box = G.ring_box("get(rings, 0)")
    return districts.select(
        "zona_id",
        "nombre",
        *[F.expr(box[name]).alias(name) for name in ("minx", "miny", "maxx", "maxy")],
        F.expr(G.ring_edges("rings")).alias("edges"),
    )


def _check_districts(shapes):
    """Raise if a district has no polygon, or all have more edges than a plan should hold; reads a row of counts."""
    missing = F.col("minx").isNull() | F.col("miny").isNull() | F.col("maxx").isNull() | F.col("maxy").isNull()
    edges, n = shapes.agg(F.coalesce(F.sum(F.size("edges")), F.lit(0)), F.count_if(missing)).first()
    if n:
        names = [row[0] for row in shapes.where(missing).select("nombre").orderBy("nombre").limit(SHOWN).collect()]
        raise ValueError("districts without a polygon: " + ", ".join(map(str, names)))
    if edges > MAX_EDGES:
        raise ValueError(f"{edges} district edges; the geometry of a city has at most {MAX_EDGES}")


@dataclass(frozen=True)
class Shapes:
    """District geometry as constants of bounded size, in file order; names and envelope."""

    constants: list[str]
    names: dict[int, str]
    box: tuple[float, float, float, float]

    @classmethod
    def of(cls, districts):
        """Read the reference table: the districts of one file (one job)."""
        shapes = district_shapes(districts)
        _check_districts(shapes)
        plain = F.to_json(F.struct(*[c for c in shapes.columns if c != "nombre"]))
        rows = shapes.select(
            "zona_id", "nombre", "minx", "miny", "maxx", "maxy", F.size("edges"), plain
        )
        names, boxes, texts, size = {}, [], [[]], 0
        for zone, name, *box, edges, text in sorted(rows.collect()):
            if texts[-1] and size + edges > EDGES_PER_CONSTANT:
                texts.append([])
                size = 0
            texts[-1].append(text)
            size += edges
            names[zone] = name
            boxes.append(box)
        constants = [f"from_json('[{','.join(t)}]', '{G.SHAPES}')" for t in texts if t]
        lows, highs = [b[:2] for b in boxes], [b[2:] for b in boxes]
        box = (*map(min, zip(*lows)), *map(max, zip(*highs))) if boxes else ()
        return cls(constants, names, box)

    def extent(self):
        """The longer side of the envelope."""
        return max(self.box[2] - self.box[0], self.box[3] - self.box[1]) if self.box else 0

    def among(self, candidates):
        """The same, restricted to the candidate zone ids where these are not null."""
        chosen = [G.among(c, candidates) for c in self.constants]
        return Shapes(chosen, self.names, self.box)

    def containing(self, x, y):
        found = [G.first_containing(c, x, y) for c in self.constants]
        return f"coalesce({', '.join([_NO_ZONE, *found])})"

    def nearest(self, x, y):
        best = [G.nearest(c, x, y) for c in self.constants]
        if not best:
            return _NO_ZONE
        return (f"least({', '.join(best)})" if len(best) > 1 else best[0]) + ".zona_id"

    def classify(self, x, y):
        """Containing district, else the nearest; null for a point without coordinates."""
        found = f"coalesce({self.containing(x, y)}, {self.nearest(x, y)})"
        return f"IF({x} IS NOT NULL AND {y} IS NOT NULL, {found}, {_NO_ZONE})"

    def measured(self, x, y):
        return f"concat({', '.join(G.measured(c, x, y) for c in self.constants)})"


def _name(column):
    return f"`{column}`"


# --- grid ----------------------------------------------------------------------------------


def _settle(cells, shapes, origin, size):
    """Set ``zone`` of cells in which every point has the same district, else ``candidates``.

    The distance to a boundary changes by no more than the way one goes, so the distances at
    the middle of a cell bound those of all its points.
    """
    reach = G.number(size * sqrt(0.5) + 10 * G.BOUNDARY)
    middle = {
        "x": f"{G.number(origin[0])} + (ix + 0.5D) * {G.number(size)}",
        "y": f"{G.number(origin[1])} + (iy + 0.5D) * {G.number(size)}",
    }
    facts = shapes.among("candidates").measured("x", "y")
    near = f"f_ -> f_.odd OR f_.d <= best + 2D * {reach}"
    return (
        cells.withColumns({name: F.expr(text) for name, text in middle.items()})
        .withColumn("facts", F.expr(f"IF(zone IS NULL, {facts}, NULL)"))
        .withColumns(
            {
                "best": F.expr("array_min(transform(facts, f_ -> f_.d))"),
                # districts that some point of the cell may lie in, or touch
                "first": F.expr(f"get(filter(facts, f_ -> f_.odd OR f_.d <= {reach}), 0)"),
            }
        )
        .withColumn("possible", F.expr(f"transform(filter(facts, {near}), f_ -> f_.zona_id)"))
        .selectExpr(
            "ix",
            "iy",
            f"""coalesce(zone, CASE WHEN first.odd AND first.d > {reach} THEN first.zona_id
                WHEN size(possible) = 1 THEN possible[0] END) AS zone""",
            "possible AS candidates",
        )
    )


def _split(cells):
    rest = [name for name in cells.columns if name not in ("ix", "iy")]
    return cells.selectExpr(
        "*", f"explode(sequence(0, {GRID_SPLIT**2 - 1})) AS part"
    ).selectExpr(
        f"ix * {GRID_SPLIT} + part % {GRID_SPLIT} AS ix", f"iy * {GRID_SPLIT} + part div {GRID_SPLIT} AS iy", *rest
    )


def district_grid(spark, shapes):
    """(grid, origin, size): cells (ix, iy, zone, candidates) over the city and its margin."""
    minx, miny, maxx, maxy = shapes.box
    width, height = maxx - minx, maxy - miny
    size = max(width, height) / GRID_CELLS
    coarse = size * GRID_SPLIT
    origin = (minx - GRID_MARGIN * width, miny - GRID_MARGIN * height)
    across, up = (ceil((1 + 2 * GRID_MARGIN) * side / coarse) for side in (width, height))
    cells = spark.range(across * up).selectExpr(
        f"id % {across} AS ix",
        f"id div {across} AS iy",
        f"{_NO_ZONE} AS zone",
        "cast(NULL AS array<int>) AS candidates",
    )
    wide = _settle(cells, shapes, origin, coarse)
    return _settle(_split(wide), shapes, origin, size), origin, size


# --- operators -----------------------------------------------------------------------------


def _zone_rows(zones=None):
    """(id, lat, lon, radius, name) of a zone table (one job), else of the built-in zones."""
    if zones is None:
        return [(zid, lat, lon, radius, name) for zid, name, lat, lon, radius in S.ZONES]
    columns = ("zona_id", "latitud_centro", "longitud_centro", "radio_km", "nombre")
    rows = zones.select(*columns).limit(MAX_ZONES + 1).collect()
    if len(rows) > MAX_ZONES:
        raise ValueError(f"more than {MAX_ZONES} zones")
    return sorted(map(tuple, rows))


def _zone_array(rows):
    return G.zone_array(row[:4] for row in rows)


def zone_within_radius(df, lat="latitude", lon="longitude", name="zona_id"):
    """Add the nearest built-in zone that reaches the point; 1 if none does or it is null."""
    found = G.center_within_radius(
        _zone_array(_zone_rows()), _name(lat), _name(lon), S.ZONE_RADIUS_TO_DEGREES
    )
    return df.withColumn(name, F.expr(f"coalesce({found}, 1)"))


def _center_grid(spark, rows):
    """(grid, origin, size): cells (ix, iy, candidates) with the centres that can be nearest to a point of the cell.

    The distance to a centre changes by no more than the way one goes, so a centre that is farther from the middle
    than the nearest one by the width of a cell is nearest nowhere in it.
    """
    lats, lons = [float(row[1]) for row in rows], [float(row[2]) for row in rows]
    width, height = max(lons) - min(lons), max(lats) - min(lats)
    size = max(width, height) / GRID_CELLS
    origin = (min(lons) - GRID_MARGIN * width, min(lats) - GRID_MARGIN * height)

    def among(cells, candidates, step):
        x = f"({G.number(origin[0])} + (ix + 0.5D) * {G.number(step)})"
        y = f"({G.number(origin[1])} + (iy + 0.5D) * {G.number(step)})"
        near = G.centers_within(candidates, y, x, G.number(step * sqrt(2) + 10 * G.BOUNDARY))
        return cells.select("ix", "iy", F.expr(near).alias("candidates"))

    # all centres for wide cells, then only theirs for the cells within
    wide = size * GRID_SPLIT
    across, up = (max(1, ceil((1 + 2 * GRID_MARGIN) * side / wide)) for side in (width, height))
    cells = spark.range(across * up).selectExpr(f"id % {across} AS ix", f"id div {across} AS iy")
    return among(_split(among(cells, _zone_array(rows), wide)), "candidates", size), origin, size


def _nearest_center(df, rows, lat, lon, name):
    """Add the nearest centre; among many centres, only those that a grid lists for the point's cell are measured."""
    rows = [row for row in rows if row[1] is not None and row[2] is not None]
    zones, y, x = _zone_array(rows), _name(lat), _name(lon)
    if len(rows) <= FEW_ZONES or len({row[1:3] for row in rows}) == 1:
        return df.withColumn(name, F.expr(G.nearest_center(zones, y, x) if rows else _NO_ZONE))
    cells, origin, size = _center_grid(df.sparkSession, rows)
    cells = cells.selectExpr("ix AS _ix", "iy AS _iy", "candidates AS _centers")
    located = df.withColumns(
        {
            "_ix": F.expr(f"floor(({x} - {G.number(origin[0])}) / {G.number(size)})"),
            "_iy": F.expr(f"floor(({y} - {G.number(origin[1])}) / {G.number(size)})"),
        }
    )
    joined = located.join(F.broadcast(cells), ["_ix", "_iy"], "left")
    return joined.withColumn(name, F.expr(G.nearest_center(f"coalesce(_centers, {zones})", y, x))).drop("_ix", "_iy", "_centers")


def zone_nearest_center(df, lat="latitude", lon="longitude", name="zona_id", zones=None):
    """Add the zone with the nearest centre, the lowest id on ties."""
    return _nearest_center(df, _zone_rows(zones), lat, lon, name)


def point_in_district(df, districts, lat="latitude", lon="longitude", name="zona_id"):
    """Add the first district that strictly contains the point, else null.

    In the grid only the districts that reach into the point's cell are measured.
    """
    x, y = _name(lon), _name(lat)
    return _in_grid(df, Shapes.of(districts), x, y, name, lambda shapes: shapes.containing(x, y))


def nearest_district(df, districts, lat="latitude", lon="longitude", name="zona_id"):
    """Add the district whose boundary is nearest, the first one on ties.

    In the grid only the districts that can be nearest in the point's cell are measured.
    """
    x, y = _name(lon), _name(lat)
    return _in_grid(df, Shapes.of(districts), x, y, name, lambda shapes: shapes.nearest(x, y))


def classify_point(df, districts, lat="latitude", lon="longitude", name="zona_id", grid=True):
    """Add the first district that strictly contains the point, else the nearest one.

    With the grid, most points get their zone from the cell they lie in; edges are only
    measured in cells that are not settled, for their few candidates, and far outside.
    """
    return _classified(df, Shapes.of(districts), lat, lon, name, grid)


def _classified(df, shapes, lat, lon, name, grid=True):
    x, y = _name(lon), _name(lat)
    if not grid:
        return df.withColumn(name, F.expr(shapes.classify(x, y)))
    return _in_grid(df, shapes, x, y, name, lambda s: s.classify(x, y), "_zone")


def _in_grid(df, shapes, x, y, name, measure, settled=_NO_ZONE):
    """Add ``measure`` of the districts that matter in the point's cell; of all outside the grid.

    ``settled`` is the answer for whole cells, where there is one.
    """
    if not shapes.constants or shapes.extent() == 0:
        # no districts, or no area to lay a grid over
        return df.withColumn(name, F.expr(measure(shapes)))
    cells, origin, size = district_grid(df.sparkSession, shapes)
    cells = cells.selectExpr("ix AS _ix", "iy AS _iy", "zone AS _zone", "candidates AS _candidates")

    def cell(axis, start):
        return F.expr(f"floor(({axis} - {G.number(start)}) / {G.number(size)})")

    located = df.withColumns({"_ix": cell(x, origin[0]), "_iy": cell(y, origin[1])})
    return (
        located.join(F.broadcast(cells), ["_ix", "_iy"], "left")
        .withColumn(name, F.expr(f"coalesce({settled}, {measure(shapes.among('_candidates'))})"))
        .drop("_ix", "_iy", "_zone", "_candidates")
    )


def assign_district_zone(
    df, districts=None, zones=None, lat="latitude", lon="longitude", name="zona_id"
):
    """Add the zone of a point: its district's zone by name, else the nearest zone centre.

    Only zones of the zone table are returned; without one, the districts (or, without
    these, the built-in zones) are the table.
    """
    if districts is None:
        return zone_nearest_center(df, lat, lon, name, zones)
    shapes = Shapes.of(districts)
    placed = _classified(df, shapes, lat, lon, name)
    if zones is None:
        return placed
    rows = _zone_rows(zones)
    ids = {row[4]: row[0] for row in rows}
    # district position -> zone id of the same name, for the names the table has
    pairs = [(zone, ids[text]) for zone, text in shapes.names.items() if text in ids]
    mapped = " ".join(f"WHEN {zone} THEN {found}" for zone, found in pairs)
    by_name = f"CASE `{name}` {mapped} END" if pairs else _NO_ZONE
    placed = _nearest_center(placed, rows, lat, lon, "_fallback")
    return placed.withColumn(name, F.expr(f"coalesce({by_name}, _fallback)")).drop("_fallback")


def _box_cells(boxes):
    """(cells, cell): cells (ix, iy, boxes) with the boxes that a point of the cell can lie in, in file order up to the
    first that holds the whole cell; and a function from an axis and a value to the number of its cell.

    None if there are no boxes. Numbers of cells grow with the value, so a point of a box lies in a cell of the box, exactly.
    """
    minx, miny, maxx, maxy = boxes.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first()
    if minx is None:
        return None
    limits = {"x": (minx, (maxx - minx) / BOX_CELLS or 1.0), "y": (miny, (maxy - miny) / BOX_CELLS or 1.0)}

    def cell(axis, value):
        low, step = limits[axis]
        return F.floor((value - F.lit(low)) / F.lit(step))

    ends = {f"{end}_{a}": cell(a, F.col(f"{end}{a}")) for end in ("min", "max") for a in "xy"}
    spread = (
        boxes.withColumns(ends)
        .withColumn("ix", F.explode(F.sequence("min_x", "max_x")))
        .withColumn("iy", F.explode(F.sequence("min_y", "max_y")))
    )
    within = [(F.col(f"i{a}") > F.col(f"min_{a}")) & (F.col(f"i{a}") < F.col(f"max_{a}")) for a in "xy"]
    whole = F.min(F.when(within[0] & within[1], F.col("zona_id"))).over(Window.partitionBy("ix", "iy"))
    needed = spread.withColumn("whole", whole).where(F.col("whole").isNull() | (F.col("zona_id") <= F.col("whole")))
    box = F.struct("zona_id", "minx", "miny", "maxx", "maxy")
    return needed.groupBy("ix", "iy").agg(F.sort_array(F.collect_list(box)).alias("boxes")), cell


def district_bbox_match(df, districts, lat="latitude", lon="longitude", name="zona_id"):
    """Add the first district whose outer ring's bounding box holds the point, else null.

    A point looks at the boxes that reach into its cell of a grid. The grid is a table made by Spark; it is broadcast up to
    a checked size, and joined beyond that with busy cells dealt over many tasks.
    """
    shapes = district_shapes(districts)
    _check_districts(shapes)
    found = _box_cells(shapes.select("zona_id", "minx", "miny", "maxx", "maxy"))
    if found is None:
        return df.withColumn(name, F.expr(_NO_ZONE))
    spark = df.sparkSession
    cells, cell = found
    folder = scratch_path(spark, "box-cells")
    cells.select(F.col("ix").alias("_ix"), F.col("iy").alias("_iy"), F.col("boxes").alias("_boxes")).write.parquet(folder)
    cells = spark.read.parquet(folder)
    size = cells.agg(F.coalesce(F.sum(F.size("_boxes") * 48 + 48), F.lit(0))).first()[0]
    located = df.withColumns({"_ix": cell("x", F.col(lon)), "_iy": cell("y", F.col(lat))})
    if size <= BROADCAST_BYTES:
        joined = located.join(F.broadcast(cells), ["_ix", "_iy"], "left")
    else:
        numbered = located.withColumn("_row", F.monotonically_increasing_id())
        joined = salted_left_join(numbered, cells, ["_ix", "_iy"], ["_row"]).drop("_row")
    return joined.withColumn(name, F.expr(G.first_box("_boxes", _name(lon), _name(lat)))).drop("_ix", "_iy", "_boxes")


def district_by_id(districts, distrito_id):
    return districts.filter(F.col("distrito_id") == str(distrito_id))


def district_by_name(districts, nombre):
    """The first district with the name, whatever its case."""
    same = F.lower("nombre") == F.lower(F.lit(nombre))
    return districts.filter(same).orderBy("zona_id").limit(1)


def all_districts(districts):
    return districts.orderBy("zona_id")


def district_bounds(districts):
    """One row: envelope of all districts, its middle and the map zoom for it."""
    box = district_shapes(districts).agg(
        F.min("minx").alias("min_lon"),
        F.min("miny").alias("min_lat"),
        F.max("maxx").alias("max_lon"),
        F.max("maxy").alias("max_lat"),
    )
    narrow = (F.col("max_lat") - F.col("min_lat") < 0.2) & (
        F.col("max_lon") - F.col("min_lon") < 0.2
    )
    return box.select(
        "*",
        ((F.col("min_lat") + F.col("max_lat")) / 2).alias("center_lat"),
        ((F.col("min_lon") + F.col("max_lon")) / 2).alias("center_lon"),
        F.when(narrow, 12).otherwise(11).alias("zoom"),
    )


def district_centers(districts):
    """Zone rows of the districts: the middle of each bounding box, radius 5 km."""
    return district_shapes(districts).select(
        "zona_id",
        F.substring("nombre", 1, S.ZONE_NAME_LENGTH).alias("nombre"),
        ((F.col("miny") + F.col("maxy")) / 2).alias("latitud_centro"),
        ((F.col("minx") + F.col("maxx")) / 2).alias("longitud_centro"),
        F.lit(S.DISTRICT_RADIUS_KM).alias("radio_km"),
    )
