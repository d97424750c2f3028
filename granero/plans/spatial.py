"""Zone assignment by point-in-polygon and the history of zones."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.functions.dates import as_date
from granero.functions.geo import edge_crosses, edges_for_box, edges_meet_box, inside_edges, ring_edges
from granero.session import cut_lineage


STEP = 4  # cells of one level are so many times as long as those of the level below
POINTS_PER_CELL = 64  # of the grid that totals by polygon use
BLOCK = 32  # rows of that grid whose edges are picked together
MARGIN = 1e-6  # cells; wider than any rounding of a point's cell


def _cells(low: Column, high: Column, size: Column) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def _size(level: Column, cell: float) -> Column:
    return F.lit(float(cell)) * F.pow(F.lit(float(STEP)), level)


def _judged(cells: DataFrame, cell: float) -> DataFrame:
    """Add ``_kind``: a cell is ``border`` where an edge touches it, else ``inner`` or ``outer`` as its middle is.

    Of ``_edges`` a cell keeps those that decide about its own points.
    """
    size = _size(F.col("_level"), cell)
    west, south, margin = F.col("_cx") * size, F.col("_cy") * size, size * 1e-6  # wider than any rounding of a point's cell
    box = west - margin, south - margin, west + size + margin, south + size + margin
    near = cells.withColumn("_edges", edges_for_box(F.col("_edges"), *box))
    inner = inside_edges(F.col("_edges"), west + size / 2, south + size / 2)
    kind = F.when(edges_meet_box(F.col("_edges"), *box), "border").when(inner, "inner").otherwise("outer")
    # Exploding instead of filtering keeps Spark from judging every cell twice.
    return near.withColumn("_kind", F.explode(F.filter(F.array(kind), lambda k: k != "outer")))


def _cut(cells: DataFrame, cell: float, wanted: Column) -> DataFrame:
    """Cells with those at a border that are ``wanted`` cut into ``STEP`` by ``STEP`` of the level below."""
    split = F.when((F.col("_kind") == "border") & wanted, F.sequence(F.lit(0), F.lit(STEP * STEP - 1))).otherwise(F.array(F.lit(-1)))
    parts = cells.withColumn("_part", F.explode(split))
    whole, part = F.col("_part") < 0, F.col("_part")
    finer = parts.withColumns({
        "_cx": F.when(whole, F.col("_cx")).otherwise(F.col("_cx") * STEP + part % STEP),
        "_cy": F.when(whole, F.col("_cy")).otherwise(F.col("_cy") * STEP + F.floor(part / STEP)),
        "_level": F.when(whole, F.col("_level")).otherwise(F.col("_level") - 1),
    }).drop("_part")
    return _judged(finer, cell)


def _whole_cells(polygons: DataFrame, cell: float) -> DataFrame:
    """Each polygon with the cells it starts with, about a quarter to a whole of its extent long."""
    lngs, lats = F.transform("ring", lambda p: p["lng"]), F.transform("ring", lambda p: p["lat"])
    extent = F.greatest(F.array_max(lngs) - F.array_min(lngs), F.array_max(lats) - F.array_min(lats))
    level = F.greatest(F.floor(F.log(extent / cell) / F.log(F.lit(float(STEP)))), F.lit(0)).cast("int")
    placed = polygons.withColumns({"_level": F.coalesce(level, F.lit(0)), "_edges": ring_edges(F.col("ring"))})
    size = _size(F.col("_level"), cell)
    cells = placed.withColumn("_cx", F.explode(_cells(F.array_min(lngs), F.array_max(lngs), size)))
    cells = cells.withColumn("_cy", F.explode(_cells(F.array_min(lats), F.array_max(lats), size)))
    return _judged(cells.drop("ring"), cell)


def cover(polygons: DataFrame, cell: float, refine: int = 2) -> DataFrame:
    """Each polygon with cells (``_level``, ``_cx``, ``_cy``, ``_kind``, ``_edges``) that cover it and nothing twice.

    A polygon starts with cells about a quarter to a whole of its extent long, so large and small ones have few cells
    each; ``refine`` times, cells at its border are cut into smaller ones. Cells outside the ring are left out.
    """
    cells = _whole_cells(polygons, cell)
    for _ in range(refine):
        cells = _cut(cells, cell, F.lit(True))
    return cells


def _placed(points: DataFrame, levels: Column, cell: float) -> DataFrame:
    """Points with their cell at each of the levels."""
    probed = points.withColumn("_level", F.explode(F.coalesce(levels, F.array().cast("array<int>"))))
    size = _size(F.col("_level"), cell)
    return probed.withColumns({"_cx": F.floor(F.col("lng") / size), "_cy": F.floor(F.col("lat") / size)})


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float, refine: int = 2) -> DataFrame:
    """Every (point, polygon) pair where the ring contains the point.

    Polygons are covered by cells that suit their own size and meet points on the cell, at the few levels there are. A
    point in an inner cell is accepted as it is; the exact test runs only in cells at a border. Choose ``cell`` near the
    width of the smallest polygons; larger ones get longer cells.
    """
    covered = cover(polygons, cell, refine)
    placed = _placed(points, covered.agg(F.array_sort(F.collect_set("_level"))).scalar(), cell)
    accepted = (F.col("_kind") == "inner") | inside_edges(F.col("_edges"), F.col("lng"), F.col("lat"))
    # Inner cells travel without edges.
    light = covered.withColumn("_edges", F.when(F.col("_kind") == "border", F.col("_edges")))
    return placed.join(light, ["_level", "_cx", "_cy"]).where(accepted).drop("_level", "_cx", "_cy", "_kind", "_edges")


def _spread(df: DataFrame) -> DataFrame:
    """Few rows that cause much work each, dealt over all tasks; run-time joining of small partitions would undo it otherwise."""
    conf = df.sparkSession.conf
    number = conf.get("spark.sql.shuffle.partitions")
    return df.repartition(int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", number) or number))


@dataclass(frozen=True)
class _Grid:
    """``count`` times ``count`` cells over the extent of all points."""

    west: float
    south: float
    width: float
    height: float
    count: int

    def column(self, lng: Column) -> Column:
        return F.floor((lng - self.west) / self.width)

    def row(self, lat: Column) -> Column:
        return F.floor((lat - self.south) / self.height)

    def inside(self, number: Column) -> Column:
        return F.greatest(F.least(number, F.lit(self.count - 1)), F.lit(0))

    def edges_in_rows(self, edges: Column, first: Column, last: Column) -> Column:
        """The edges that touch rows ``first`` to ``last``."""
        low, high = self.south + (first - MARGIN) * self.height, self.south + (last + 1 + MARGIN) * self.height

        def touches(edge: Column) -> Column:
            a, b = edge["a"]["lat"], edge["b"]["lat"]
            return (F.greatest(a, b) >= low) & (F.least(a, b) <= high)

        return F.filter(edges, touches)

    def spans(self, edges: Column, row: Column) -> Column:
        """For each edge its columns ``lo`` to ``hi`` in a row, -1 and ``count`` for those beyond the points.

        ``through`` says whether it crosses the whole row, ``middle`` whether it crosses the row's middle.
        """
        low, high = self.south + (row - MARGIN) * self.height, self.south + (row + 1 + MARGIN) * self.height
        middle = self.south + (row + 0.5) * self.height

        def part(edge: Column) -> Column:
            a, b = edge["a"], edge["b"]
            slope = (b["lng"] - a["lng"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0))
            # Ends of the part inside the row; a level edge is there as a whole.
            ends = [F.coalesce(a["lng"] + (F.least(F.greatest(end["lat"], low), high) - a["lat"]) * slope, end["lng"]) for end in (a, b)]
            return F.struct(edge.alias("edge"), *[end.alias(name) for end, name in zip(ends, "ab")])

        def number(lng: Column) -> Column:
            near = F.least(F.greatest(lng, F.lit(self.west - 2 * self.width)), F.lit(self.west + (self.count + 2) * self.width))
            return F.greatest(F.least(self.column(near), F.lit(self.count)), F.lit(-1)).cast("int")

        def span(part: Column) -> Column:
            a, b = part["edge"]["a"]["lat"], part["edge"]["b"]["lat"]
            return F.struct(
                part["edge"].alias("edge"), number(F.least(part["a"], part["b"]) - MARGIN * self.width).alias("lo"),
                number(F.greatest(part["a"], part["b"]) + MARGIN * self.width).alias("hi"),
                ((F.least(a, b) <= low) & (F.greatest(a, b) >= high)).alias("through"), ((a > middle) != (b > middle)).alias("middle"),
            )

        return F.transform(F.transform(edges, part), span)


def _parts(polygons: DataFrame, grid: _Grid) -> DataFrame:
    """Each polygon as parts of the grid's rows, by ``_row`` and ``_column``.

    ``sum``: all points of the row up to the column count ``_sign`` times; the untouched cells between two touched ones
    lie wholly inside or outside. ``edge``: points of the cell are inside where they cross ``_edge`` an odd number of times
    together with ``_odd``; ``edges``: the same with several edges.
    """
    lat = [F.transform("_edges", lambda e: f(e["a"]["lat"], e["b"]["lat"])) for f in (F.least, F.greatest)]
    known = F.filter(ring_edges(F.col("ring")), lambda e: (e["a"]["lng"] + e["a"]["lat"] + e["b"]["lng"] + e["b"]["lat"]).isNotNull())
    edged = polygons.withColumn("_edges", known).where(F.size("_edges") > 0)
    first, last = grid.row(F.array_min(lat[0])), grid.row(F.array_max(lat[1]))
    met = edged.withColumns({"_first": first, "_last": last}).where((F.col("_last") >= -1) & (F.col("_first") <= grid.count)).drop("ring")
    # Blocks of rows first, so that a row looks at the edges of its block only.
    block = F.explode(F.sequence(F.floor(grid.inside(F.col("_first")) / BLOCK), F.floor(grid.inside(F.col("_last")) / BLOCK)))
    blocks = met.withColumn("_block", block)
    start, end = F.col("_block") * BLOCK, F.col("_block") * BLOCK + BLOCK - 1
    blocks = blocks.withColumn("_edges", grid.edges_in_rows(F.col("_edges"), start, end))
    inside = F.sequence(F.greatest(start, grid.inside(F.col("_first"))), F.least(end, grid.inside(F.col("_last"))))
    rows = blocks.withColumn("_row", F.explode(inside)).drop("_block", "_first", "_last")
    rows = rows.withColumn("_spans", grid.spans(grid.edges_in_rows(F.col("_edges"), F.col("_row"), F.col("_row")), F.col("_row"))).drop("_edges")
    touched = F.array_sort(F.array_distinct(F.flatten(F.transform("_spans", lambda s: F.sequence(s["lo"], s["hi"])))))
    rows = rows.withColumn("_touched", touched)
    odd = F.lit(1)

    def part(kind: str, column: Column, sign: Column, edges: Column, before: Column) -> Column:
        return F.struct(F.lit(kind).alias("_kind"), column.cast("int").alias("_column"), sign.cast("int").alias("_sign"), edges.alias("_edges"), before.alias("_odd"))

    no_edges = F.lit(None).cast(edged.schema["_edges"].dataType)

    def gap(k: Column) -> Column:
        left, right = F.get("_touched", k - 1), F.get("_touched", k)
        crossed = F.size(F.filter("_spans", lambda s: s["middle"] & (s["lo"] >= right))) % 2
        ends = F.array(
            part("sum", left, F.lit(-1), no_edges, F.lit(False)), part("sum", right - 1, F.lit(1), no_edges, F.lit(False)),
        )
        return F.when((right - left > 1) & (crossed == odd), ends).otherwise(F.slice(ends, 1, 0))

    def cell(column: Column) -> Column:
        near = F.filter("_spans", lambda s: (s["hi"] >= column) & ((s["lo"] <= column) | ~s["through"]))
        crossed = F.size(F.filter("_spans", lambda s: s["through"] & (s["lo"] > column))) % 2
        edges = F.transform(near, lambda s: s["edge"])
        return part("edge", column, F.lit(1), edges, crossed == odd)

    gaps = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.size("_touched") - 1, F.lit(1))), gap))
    gaps = F.when(F.size("_touched") > 1, gaps).otherwise(F.slice(F.transform("_touched", lambda c: part("sum", c, F.lit(1), no_edges, F.lit(False))), 1, 0))
    cells = F.transform(F.filter("_touched", lambda c: c.between(0, grid.count - 1)), cell)
    keys = [c for c in polygons.columns if c != "ring"]
    parts = rows.select(*keys, F.col("_row").cast("int").alias("_row"), F.explode(F.concat(gaps, cells)).alias("_part"))
    flat = parts.select(*keys, "_row", "_part.*")
    single = (F.col("_kind") == "edge") & (F.size("_edges") == 1)
    kind = F.when(single | (F.col("_kind") == "sum"), F.col("_kind")).otherwise("edges")
    return flat.select(
        *keys, "_row", "_column", kind.alias("_kind"), "_sign", "_odd", F.when(single, F.get("_edges", F.lit(0))).alias("_edge"),
        F.when(kind == "edges", F.col("_edges")).alias("_edges"),
    )


def _running_totals(cells: DataFrame, grid: _Grid, names: Sequence[str]) -> DataFrame:
    """For each cell of the grid the totals of its row up to there, also where a cell has no points."""
    number = F.sequence(F.lit(0), F.lit(grid.count - 1))
    full = cells.select("_row").distinct().withColumn("_column", F.explode(number)).withColumn("_column", F.col("_column").cast("int"))
    along = Window.partitionBy("_row").orderBy("_column")
    return full.join(cells, ["_row", "_column"], "left").select("_row", "_column", *[F.sum(F.coalesce(name, F.lit(0))).over(along).alias(name) for name in names])


def polygon_totals(
    points: DataFrame, polygons: DataFrame, cell: float, sums: dict[str, str], count: str = "n", per_cell: int = POINTS_PER_CELL,
) -> DataFrame:
    """For each polygon that contains points, their number and the sums ``{name: column}``, without a row for each pair.

    The result is that of ``points_in_polygons``, grouped; sums of whole numbers or decimals are exact. A grid over the points
    has about ``per_cell`` of them in a cell (``cell`` has no part in it). Between the cells that its edges touch, a
    polygon takes differences of running totals along each row; only points in touched cells are tested, mostly against
    one edge. So the work grows with the borders. The parts of the polygons are written once.
    """
    finite = points.where((F.col("lng") - F.col("lng") == 0) & (F.col("lat") - F.col("lat") == 0))
    lng, lat = F.col("lng"), F.col("lat")
    seen = finite.agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{f.__name__}") for c in ("lng", "lat") for f in (F.min, F.max)]).first()
    side = max(1, math.ceil(math.sqrt(seen["n"] / per_cell)))
    # A little wider, so that the last points lie in the last cells.
    steps = [((seen[f"{c}_max"] or 0.0) - (seen[f"{c}_min"] or 0.0)) / side * (1 + 1e-9) or 1.0 for c in ("lng", "lat")]
    grid = _Grid(seen["lng_min"] or 0.0, seen["lat_min"] or 0.0, *steps, side)
    keys = [c for c in polygons.columns if c != "ring"]
    parts = cut_lineage(_parts(_spread(polygons), grid))
    # Next to each sum the number of values in it, since a sum without any is NULL.
    measures = {count: F.lit(1).cast("long")} | {name: F.col(c) for name, c in sums.items()}
    measures |= {f"_{name}_known": F.col(c).isNotNull().cast("long") for name, c in sums.items()}
    names = list(measures)
    single = finite.select("lng", "lat", grid.row(lat).cast("int").alias("_row"), grid.column(lng).cast("int").alias("_column"), *[c.alias(n) for n, c in measures.items()])
    place = ["_row", "_column"]

    def of(kind: str, *more: str) -> DataFrame:
        return parts.where(F.col("_kind") == kind).select(*keys, *place, *more)

    def totals(rows: DataFrame, by: Sequence[str], sign: Column = F.lit(1)) -> DataFrame:
        return rows.groupBy(*by).agg(*[F.sum(F.col(name) * sign).alias(name) for name in names])

    running = _running_totals(totals(single, place), grid, names)
    between = totals(of("sum", "_sign").join(running, place), keys, F.col("_sign"))
    a, b = F.col("_edge.a"), F.col("_edge.b")
    one = of("edge", "_odd", "_edge").select(*keys, *place, "_odd", *[e[c].alias(f"_{n}_{c}") for n, e in (("a", a), ("b", b)) for c in ("lng", "lat")])
    crosses = edge_crosses(F.col("_a_lng"), F.col("_a_lat"), F.col("_b_lng"), F.col("_b_lat"), lng, lat)
    dealt = _spread(single)  # few files of points may meet broadcast parts
    beside = dealt.join(one, place).where(crosses != F.col("_odd"))
    several = dealt.join(of("edges", "_odd", "_edges"), place).where(inside_edges(F.col("_edges"), lng, lat) != F.col("_odd"))
    found = totals(between.unionByName(totals(beside, keys)).unionByName(totals(several, keys)), keys).where(F.col(count) > 0)
    return found.select(*keys, count, *[F.when(F.col(f"_{name}_known") > 0, F.col(name)).alias(name) for name in sums])


def assign_zones(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """All zones of each order."""
    return points_in_polygons(points, polygons.select("polygon", "ring"), cell)


def assign_district(points: DataFrame, polygons: DataFrame, cell: float, key: str = "order_id") -> DataFrame:
    """One district per order: the first polygon that contains it."""
    hits = points_in_polygons(points.select(key, "lng", "lat"), polygons.select("polygon", "position", "ring"), cell)
    first = hits.groupBy(key).agg(F.min(F.struct("position", "polygon")).alias("_first"))
    return first.select(key, F.col("_first.polygon").alias("polygon"))


def zone_history(history: DataFrame, current: DataFrame, day, tracked: Sequence[str] = ("ring",)) -> DataFrame:
    """Merge the day's zones into their history.

    ``updated`` moves only when a ``tracked`` attribute (ring, carrier, shipping method, delivery channel) or the
    activity changed; the deletion date clears when a zone is active, otherwise sticks, and a zone missing from the
    day becomes inactive as of the day before.
    """
    day = as_date(day)
    today = current.groupBy("polygon").agg(
        *[F.max(c).alias(f"_{c}") for c in tracked], F.bool_or("active").alias("_active"), F.lit(True).alias("_seen")
    )
    joined = history.withColumn("_known", F.lit(True)).join(today, "polygon", "full")
    seen, known = F.col("_seen").isNotNull(), F.col("_known").isNotNull()
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*tracked, "active")])
    live = F.coalesce("active", F.lit(False)) | F.col("deleted").isNull()
    return joined.select(
        "polygon", *[F.when(seen, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in tracked],
        F.when(seen, F.col("_active")).when(live, F.lit(False)).otherwise(F.col("active")).alias("active"),
        F.when(seen, F.least("created", day)).otherwise(F.col("created")).alias("created"),
        F.when(seen & ~known, day).when(seen & changed, F.greatest("updated", day)).otherwise(F.col("updated")).alias("updated"),
        F.when(seen & F.col("_active"), F.lit(None).cast("date")).when(seen, F.coalesce("deleted", day))
        .otherwise(F.coalesce("deleted", F.date_sub(day, 1))).alias("deleted"),
    )
