"""Density clusters of trip points (DBSCAN), exact and distributed.

Points are scaled to metres and laid on square cells whose diagonal is just under
eps, so all points of one cell are neighbours of each other: a cell with
``min_points`` points is core throughout, and the core points of any cell belong
to one cluster. Everything then happens between cells:

1. equal coordinates collapse to one weighted site before anything is shuffled;
2. only sites of thin cells (fewer than ``min_points``) look for neighbours, in full cells by
   boxes with counts, of which only those that the circle cuts are opened;
3. cells are linked when two of their core sites lie within eps. Boxes and extreme
   sites settle most pairs; open pairs are refined box by box, and only boxes that
   stay undecided are compared site by site;
4. clusters are the components of the cell graph, whose size depends on the area
   covered and not on the number of points.

A cell with a large share of all points is split by a salt wherever sites are
joined, and the sites that probe it (at most ``min_points`` - 1 per thin cell) are
repeated per salt. Results equal the sequential algorithm that visits points in id
order: clusters are numbered by their smallest core id, a border point takes the
lowest cluster that reaches it, all others are noise (-1).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.functions.geo import haversine_km, point_label
from tripweave.operators.components import connected_components
from tripweave.operators.spatial import trip_points
from tripweave.params import DEFAULTS, Params
from tripweave.session import cut

_REACH = 2  # cells further away than this are more than eps away
_SPLIT = 4  # boxes per side and refinement step
_MAX_KINDS, _PLANE = 16, 2**26  # cells of two kinds are further apart than any of one kind


def _near(a: str, b: str, eps: float) -> Column:
    dx, dy = F.col(f"{a}.x") - F.col(f"{b}.x"), F.col(f"{a}.y") - F.col(f"{b}.y")
    return F.sqrt(dx * dx + dy * dy) <= F.lit(eps)


def _around(half: bool = False) -> Column:
    """Array of cell offsets within reach; ``half`` lists each unordered pair once."""
    steps = range(-_REACH, _REACH + 1)
    return F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
        for i in steps for j in steps if not half or (i, j) > (0, 0)
    ])


def _small(table: DataFrame, rows: int, p: Params) -> DataFrame:
    return F.broadcast(table) if rows <= p.max_broadcast_rows else table


def sites_of(points: DataFrame, p: Params, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Weighted sites with their cell.

    Kinds of points share the jobs but not the plane: each kind's cells are numbered
    far away from the others', so no two kinds meet.
    """
    points = points.where(F.col("kind").isNotNull())
    if kinds is None:
        kinds = tuple(r.kind for r in points.select("kind").distinct().limit(_MAX_KINDS + 1).collect())
    if len(kinds) > _MAX_KINDS:
        raise ValueError(f"more than {_MAX_KINDS} kinds of points")
    plane = F.array_position(F.array(*[F.lit(k) for k in sorted(kinds)]), F.col("kind")) - 1 if kinds else F.lit(0)
    side = p.eps_m / 1.4143  # diagonal just under eps
    return (
        points.where(F.col("lng").isNotNull() & F.col("lat").isNotNull())
        .groupBy("kind", "lng", "lat").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("first_id"))
        .withColumns({"x": F.col("lng") * F.lit(p.metres_lng), "y": F.col("lat") * F.lit(p.metres_lat)})
        .withColumns({
            "cx": F.floor(F.col("x") / F.lit(side)) + plane * _PLANE, "cy": F.floor(F.col("y") / F.lit(side)),
        })
        .withColumn("cell", (F.col("cx") + 2**30) * 2**31 + F.col("cy") + 2**30)
    )


def with_salts(sites: DataFrame, p: Params) -> tuple[DataFrame, int]:
    """Fixed sites with cell population and salt count; number of cells."""
    cells = cut(
        sites.groupBy("cx", "cy").agg(F.sum("w").alias("pop"), F.count(F.lit(1)).alias("sites"))
        .withColumn("salts", F.ceil(F.col("sites") / F.lit(p.max_rows_per_task)).cast("int"))
        .drop("sites")
    )
    n_cells = cells.count()
    tagged = sites.join(_small(cells, n_cells, p), ["cx", "cy"]).withColumn(
        "salt", F.pmod(F.xxhash64("lng", "lat"), F.col("salts")).cast("int")
    )
    return tagged, n_cells


_POINT = ("kind", "lng", "lat", "x", "y", "cx", "cy")


def _asked(probes: DataFrame, cells: DataFrame, n_cells: int, p: Params) -> DataFrame:
    """Probes p beside every cell of ``cells`` within reach of theirs."""
    spread = probes.select(F.struct(*_POINT).alias("p"), F.explode(_around()).alias("o"))
    return spread.select("p", (F.col("p.cx") + F.col("o.i")).alias("cx"), (F.col("p.cy") + F.col("o.j")).alias("cy")).join(
        _small(cells, n_cells, p), ["cx", "cy"]
    )


def near_sums(probes: DataFrame, sites: DataFrame, n_cells: int, enough: int, p: Params, each_cell: bool = False) -> DataFrame:
    """kind, lng, lat of a probe, cx, cy of a cell and w, the weight of that cell's sites within eps.

    Exact up to ``enough``: once that much is known of a probe (of a probe and cell with
    ``each_cell``), the rest may be left out. Sites of a cell with up to ``max_listed_sites`` are looked
    at one by one. Fuller cells are counted by boxes: a box inside the circle adds its weight, one
    outside adds nothing, and only boxes that the circle cuts are opened into quarters.
    """
    cells = sites.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("listed"), F.first("salts").alias("salts"))
    full = cut(cells.where(F.col("listed") > p.max_listed_sites).select("cx", "cy"))
    light = _asked(probes, cells.where(F.col("listed") <= p.max_listed_sites).drop("listed"), n_cells, p).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    )
    found = sites.select("cx", "cy", "salt", F.struct("x", "y", "w").alias("q"))
    listed = light.join(found, ["cx", "cy", "salt"]).where(_near("p", "q", p.eps_m)).groupBy(
        "p.kind", "p.lng", "p.lat", "cx", "cy"
    ).agg(F.sum("q.w").alias("w"))
    if full.isEmpty():
        return listed
    return listed.unionByName(_sums_by_boxes(_asked(probes, full, n_cells, p), sites.join(_small(full, n_cells, p), ["cx", "cy"], "left_semi"), enough, p, each_cell))


def _sums_by_boxes(asked: DataFrame, sites: DataFrame, enough: int, p: Params, each_cell: bool) -> DataFrame:
    """Weights within eps of (probe, cell) pairs, level by level down the boxes of the cells.

    Distances to a box's nearest and furthest corner are rounded as those to its sites are, so
    both tests agree with looking at every site. A box of one site is never cut.
    """
    who = ["kind", "lng", "lat", *(["cx", "cy"] if each_cell else [])]
    point = lambda c: F.col(f"p.{c}")
    below = lambda c, lo, hi: F.greatest(F.col(lo) - point(c), point(c) - F.col(hi), F.lit(0.0))
    above = lambda c, lo, hi: F.greatest(F.abs(point(c) - F.col(lo)), F.abs(point(c) - F.col(hi)))
    length = lambda f: F.sqrt(f("x", "x0", "x1") * f("x", "x0", "x1") + f("y", "y0", "y1") * f("y", "y0", "y1"))
    rows = sites.select("cx", "cy", "x", "y", "w").withColumn("box", F.lit(""))
    frontier = asked.select("p", "cx", "cy").withColumn("box", F.lit(""))
    sums = None
    while True:
        boxes = cut(rows.groupBy("cx", "cy", "box").agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.sum("w").alias("w")
        ))
        tested = cut(frontier.join(boxes, ["cx", "cy", "box"]).where(length(below) <= p.eps_m).withColumn("inside", length(above) <= p.eps_m))
        told = tested.where("inside").groupBy("p.kind", "p.lng", "p.lat", "cx", "cy").agg(F.sum("w").alias("w"))
        sums = cut(told if sums is None else sums.unionByName(told).groupBy("kind", "lng", "lat", "cx", "cy").agg(F.sum("w").alias("w")))
        settled = sums.groupBy(*who).agg(F.sum("w").alias("w")).where(F.col("w") >= enough).select(*who)
        open_boxes = tested.where(~F.col("inside")).select("p", "cx", "cy", "box", "p.kind", "p.lng", "p.lat", "x0", "x1", "y0", "y1")
        open_boxes = cut(open_boxes.join(settled, who, "left_anti"))
        if open_boxes.isEmpty():
            return sums
        opened = open_boxes.select("cx", "cy", "box", "x0", "x1", "y0", "y1").distinct()
        quarter = F.concat("box", _split_key("x", "x0", "x1"), _split_key("y", "y0", "y1"))
        split = rows.join(opened, ["cx", "cy", "box"]).withColumn("child", quarter)
        children = split.select("cx", "cy", "box", "child").distinct()
        frontier = open_boxes.select("p", "cx", "cy", "box").join(children, ["cx", "cy", "box"]).select("p", "cx", "cy", F.col("child").alias("box"))
        rows = cut(split.select("cx", "cy", "x", "y", "w", F.col("child").alias("box")))


def _flag_core(sites: DataFrame, n_cells: int, p: Params) -> DataFrame:
    thin = sites.where(F.col("pop") < p.min_points)
    seen = near_sums(thin, sites, n_cells, p.min_points, p).groupBy("kind", "lng", "lat").agg((F.sum("w") >= p.min_points).alias("core"))
    judged = thin.join(seen, ["kind", "lng", "lat"], "left").withColumn("core", F.coalesce("core", F.lit(False)))
    sure = sites.where(F.col("pop") >= p.min_points).withColumn("core", F.lit(True))
    return sure.unionByName(judged)


def boxes_of(sites: DataFrame, by: list[str]) -> DataFrame:
    """Bounding box and four extreme sites per group.

    Only plain numbers are aggregated, so this is a hash aggregation with map-side
    combine; which of several equally extreme sites is taken does not matter.
    """
    site = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    extremes = sites.groupBy(*by).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.min_by("y", "x").alias("at_x0"), F.max_by("y", "x").alias("at_x1"),
        F.min_by("x", "y").alias("at_y0"), F.max_by("x", "y").alias("at_y1"),
    )
    reps = F.array(site("x0", "at_x0"), site("x1", "at_x1"), site("at_y0", "y0"), site("at_y1", "y1"))
    return extremes.withColumn("reps", reps).drop("at_x0", "at_x1", "at_y0", "at_y1")


def _apart(a: str, b: str, eps: float) -> Column:
    """The boxes are further apart than eps."""
    gap = lambda lo, hi: F.greatest(
        F.col(f"{a}.{lo}") - F.col(f"{b}.{hi}"), F.col(f"{b}.{lo}") - F.col(f"{a}.{hi}"), F.lit(0.0)
    )
    gx, gy = gap("x0", "x1"), gap("y0", "y1")
    # a hair of slack: rounding must never declare a touching pair apart
    return F.sqrt(gx * gx + gy * gy) > F.lit(eps * (1 + 1e-12))


def _touch(a: str, b: str, eps: float) -> Column:
    """Two extreme sites lie within eps."""
    def close(s: Column, t: Column) -> Column:
        dx, dy = s["x"] - t["x"], s["y"] - t["y"]
        return F.sqrt(dx * dx + dy * dy) <= F.lit(eps)

    return F.exists(F.col(f"{a}.reps"), lambda s: F.exists(F.col(f"{b}.reps"), lambda t: close(s, t)))


def _box_struct(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in ("x0", "x1", "y0", "y1", "reps")])


def _split_key(c: str, low: str, high: str) -> Column:
    """Quarter of the parent box a site falls in, along one axis."""
    width = F.col(high) - F.col(low)
    step = F.floor((F.col(c) - F.col(low)) / F.when(width > 0, width / F.lit(_SPLIT)))
    return F.coalesce(F.least(step, F.lit(_SPLIT - 1)), F.lit(0)).cast("string")


def link_cells(core: DataFrame, cells: DataFrame, n_cells: int, p: Params) -> DataFrame:
    """(node, root) of the graph that joins cells with core sites within eps."""
    eps = p.eps_m
    right = cells.select(F.col("cell").alias("v"), "cx", "cy", _box_struct().alias("b"))
    pairs = (
        cells.select(F.col("cell").alias("u"), _box_struct().alias("a"), "cx", "cy", F.explode(_around(True)).alias("o"))
        .select("u", "a", (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"))
        .join(_small(right, n_cells, p), ["cx", "cy"])
        .where(~_apart("a", "b", eps))
        .withColumn("linked", _touch("a", "b", eps))
    )
    pairs = cut(pairs.select("u", "v", "linked"))
    edges = pairs.where("linked").select("u", "v")
    doubt = pairs.where(~F.col("linked")).select("u", "v")
    roots = connected_components(edges)
    # cells that are connected already need no further proof
    doubt = cut(
        doubt.join(roots.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", "left")
        .join(roots.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", "left")
        .where(F.coalesce("ru", "u") != F.coalesce("rv", "v"))
        .select("u", "v")
    )
    if doubt.isEmpty():
        return roots
    more = _refine(core, cells, n_cells, doubt, p)
    return connected_components(roots.toDF("u", "v").unionByName(more))


def _refine(
    core: DataFrame, cells: DataFrame, n_cells: int, doubt: DataFrame, p: Params
) -> DataFrame:
    """Settle undecided cell pairs by quartering boxes.

    Boxes shrink until two boxes touch, lie apart, or hold one site each; the test of
    extreme sites is exact for the last kind. No two groups of sites are ever joined.
    """
    asked = doubt.select(F.col("u").alias("cell")).union(doubt.select("v")).distinct()
    frames = cells.join(asked, "cell", "left_semi").select("cell", "x0", "x1", "y0", "y1")
    # a box is named by the quarters on the way to it
    sites = core.select("cell", "x", "y").join(_small(frames, n_cells, p), "cell").withColumn("box", F.lit(""))
    pairs = doubt.withColumns({"bu": F.lit(""), "bv": F.lit("")})
    linked = None
    while True:
        quarter = F.concat("box", _split_key("x", "x0", "x1"), _split_key("y", "y0", "y1"))
        split = sites.withColumn("child", quarter)
        boxes = cut(
            boxes_of(split, ["cell", "box", "child"]).select("cell", "box", "child", _box_struct().alias("s"))
        )
        side = lambda c, b, n, s: boxes.select(
            F.col("cell").alias(c), F.col("box").alias(b), F.col("child").alias(n), F.col("s").alias(s)
        )
        tested = cut(
            pairs.join(side("u", "bu", "cu", "a"), ["u", "bu"]).join(side("v", "bv", "cv", "b"), ["v", "bv"])
            .where(~_apart("a", "b", p.eps_m))
            .withColumn("linked", _touch("a", "b", p.eps_m))
            .where("linked or a.x0 < a.x1 or a.y0 < a.y1 or b.x0 < b.x1 or b.y0 < b.y1")
            .select("u", "v", F.col("cu").alias("bu"), F.col("cv").alias("bv"), "linked")
        )
        proven = tested.where("linked").select("u", "v").distinct()
        linked = proven if linked is None else linked.unionByName(proven)
        pairs = tested.drop("linked").join(proven, ["u", "v"], "left_anti")
        if pairs.isEmpty():
            return linked
        live = pairs.select(F.col("u").alias("cell"), F.col("bu").alias("box")).union(pairs.select("v", "bv")).distinct()
        kept = boxes.select("cell", F.col("child").alias("box"), "s.x0", "s.x1", "s.y0", "s.y1").join(
            live, ["cell", "box"], "left_semi"
        )
        sites = cut(split.select("cell", "x", "y", F.col("child").alias("box")).join(kept, ["cell", "box"]))


def label_sites(points: DataFrame, p: Params = DEFAULTS, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """(kind, id, lng, lat) points to weighted sites with ``cluster_id`` (-1 is noise).

    Each kind is clustered and numbered by itself; ``kinds`` saves a look for those
    there are, at most 16. Points of equal kind and coordinates share a site, hence a label.
    """
    sites, n_cells = with_salts(cut(sites_of(points, p, kinds)), p)
    flagged = cut(_flag_core(sites, n_cells, p))
    core = flagged.where("core")
    cells = cut(boxes_of(core, ["kind", "cell", "cx", "cy"]))
    roots = link_cells(core, cells, n_cells, p)
    rooted = core.groupBy("kind", "cell").agg(F.min("first_id").alias("first_id")).join(
        roots.withColumnRenamed("node", "cell"), "cell", "left"
    ).withColumn("root", F.coalesce("root", "cell"))
    first = rooted.groupBy("kind", "root").agg(F.min("first_id").alias("first_id"))
    by_first = Window.partitionBy("kind").orderBy("first_id")  # at most one row per cell
    ranked = first.select("root", (F.row_number().over(by_first) - 1).alias("cluster_id"))
    clusters = cut(
        rooted.join(ranked, "root").join(cells.select("cell", "cx", "cy"), "cell").select("cx", "cy", "cluster_id")
    )
    known = _small(clusters, n_cells, p)
    inner = flagged.where("core").join(known, ["cx", "cy"])
    outer = flagged.where(~F.col("core"))
    border = near_sums(outer, flagged.where("core"), n_cells, 1, p, each_cell=True).join(known, ["cx", "cy"]).groupBy(
        "kind", "lng", "lat"
    ).agg(F.min("cluster_id").alias("cluster_id"))
    outer = outer.join(border, ["kind", "lng", "lat"], "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))
    cols = ["kind", "lng", "lat", "w", "first_id", "core", "cluster_id"]
    return inner.select(*cols).unionByName(outer.select(*cols))


def cluster_points(points: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """(kind, id, lng, lat) points with ``cluster_id``."""
    sites = label_sites(points, p).select("kind", "lng", "lat", "cluster_id")
    return points.join(sites, ["kind", "lng", "lat"], "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))


def cluster_summary(sites: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Centre, size and radius of every cluster.

    ``radius_m`` is the largest planar distance in degrees times the metres per
    degree of longitude; ``radius_true_m`` is the great-circle one.
    """
    members = sites.where(F.col("cluster_id") >= 0)
    weight = F.sum("w")
    by = ["kind", "cluster_id"]
    centers = cut(members.groupBy(*by).agg(
        (F.sum(F.col("lng") * F.col("w")) / weight).alias("center_lng"),
        (F.sum(F.col("lat") * F.col("w")) / weight).alias("center_lat"),
        weight.alias("trip_count"),
    ))
    dx, dy = F.col("lng") - F.col("center_lng"), F.col("lat") - F.col("center_lat")
    return (
        members.join(_small(centers, centers.count(), p), by)
        .groupBy(*by).agg(
            F.first("center_lng").alias("center_lng"), F.first("center_lat").alias("center_lat"),
            F.first("trip_count").alias("trip_count"),
            (F.max(F.sqrt(dx * dx + dy * dy)) * F.lit(p.metres_lng)).alias("radius_m"),
            (F.max(haversine_km(F.col("lng"), F.col("lat"), F.col("center_lng"), F.col("center_lat"))) * 1000.0).alias("radius_true_m"),
        )
        .withColumnRenamed("kind", "point_type")
    )


def all_clusters(trips: DataFrame, point_type: str = "start", p: Params = DEFAULTS) -> DataFrame:
    """Every cluster of start or end points; ``both`` clusters the two kinds in the same jobs, labelled."""
    points = trip_points(trips, point_type, ("trip_id",)).withColumnRenamed("trip_id", "id")
    return cluster_summary(label_sites(points, p, ("start", "end")), p)


def find_hotspots(trips: DataFrame, point_type: str = "start", p: Params = DEFAULTS) -> DataFrame:
    """The largest clusters, at most ``top_hotspots`` of each kind."""
    return largest_clusters(all_clusters(trips, point_type, p), p)


def largest_clusters(summary: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    largest = Window.partitionBy("point_type").orderBy(F.desc("trip_count"), "cluster_id")
    ranked = summary.withColumn("place", F.row_number().over(largest))
    return ranked.where(F.col("place") <= p.top_hotspots).drop("place")


def hotspot_ranking(hotspots: DataFrame, n: int = 15) -> DataFrame:
    """The ranking list: position, label, count, share of the longest bar."""
    by = Window.orderBy(F.desc("trip_count"), "cluster_id")  # at most top_hotspots rows
    top = Window.partitionBy()
    return hotspots.select(
        F.row_number().over(by).alias("rank_no"), "cluster_id",
        F.col("center_lng").alias("lng"), F.col("center_lat").alias("lat"),
        point_label(F.col("center_lng"), F.col("center_lat")).alias("label"),
        F.col("trip_count").alias("count"),
        F.round(F.col("trip_count") * 100.0 / F.max("trip_count").over(top)).alias("bar_pct"),
    ).where(F.col("rank_no") <= n)
