"""Grid density, sparse OD matrix, flows between and net flow of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.functions.geo import (
    cell_lat, cell_lng, center_lat, center_lng, grid_center, grid_id, point_label,
)
from tripweave.functions.stats import safe_ratio
from tripweave.operators.temporal import in_periods, periods_table
from tripweave.params import DEFAULTS, Params


def trip_points(trips: DataFrame, point_type: str = "start", keep: tuple[str, ...] = ()) -> DataFrame:
    """Start, end, or both points of each trip as lng, lat; one scan for both."""
    ends = {
        "start": F.struct(F.lit("start").alias("kind"), F.col("s_lng").alias("lng"), F.col("s_lat").alias("lat")),
        "end": F.struct(F.lit("end").alias("kind"), F.col("e_lng").alias("lng"), F.col("e_lat").alias("lat")),
    }
    if point_type == "both":
        points = F.inline(F.array(*ends.values()))
        return trips.select(*keep, points)
    if point_type not in ends:
        raise ValueError(f"unknown point type {point_type!r}")
    return trips.select(*keep, ends[point_type].alias("p")).select(*keep, "p.*")


def _density(points: DataFrame, by: tuple[str, ...], p: Params) -> DataFrame:
    cells = points.select(
        *by, cell_lng(F.col("lng"), p).alias("i_lng"), cell_lat(F.col("lat"), p).alias("i_lat")
    )
    counts = cells.groupBy(*by, "i_lng", "i_lat").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumns({
        "lng": center_lng(F.col("i_lng"), p), "lat": center_lat(F.col("i_lat"), p),
    })


def density(trips: DataFrame, point_type: str = "start", p: Params = DEFAULTS) -> DataFrame:
    """Points per grid cell, with the cell centre."""
    return _density(trip_points(trips, point_type), (), p)


def density_by_period(trips: DataFrame, point_type: str = "start", p: Params = DEFAULTS) -> DataFrame:
    points = trip_points(in_periods(trips, p), point_type, ("period_no",))
    named = F.broadcast(periods_table(trips, p))
    return _density(points, ("period_no",), p).join(named, "period_no")


def od_matrix(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Sparse matrix: o, d, flow."""
    return (
        trips.select(
            grid_id(F.col("s_lng"), F.col("s_lat"), p).alias("o"),
            grid_id(F.col("e_lng"), F.col("e_lat"), p).alias("d"),
        )
        .groupBy("o", "d").agg(F.count(F.lit(1)).alias("flow"))
    )


def od_summary(od: DataFrame) -> DataFrame:
    """One row: trips, pairs, trips inside one cell and their share."""
    inner = F.coalesce(F.sum(F.when(F.col("o") == F.col("d"), F.col("flow"))), F.lit(0))
    total = F.coalesce(F.sum("flow"), F.lit(0))
    return od.agg(
        total.alias("trips"), F.count(F.lit(1)).alias("pairs"), inner.alias("intra_trips"),
        safe_ratio(inner, total, 100.0).alias("intra_pct"),
    )


def with_centers(pairs: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    o_lng, o_lat = grid_center(F.col("o"), p)
    d_lng, d_lat = grid_center(F.col("d"), p)
    return pairs.withColumns({"o_lng": o_lng, "o_lat": o_lat, "d_lng": d_lng, "d_lat": d_lat})


def top_od_pairs(od: DataFrame, n: int = 20, p: Params = DEFAULTS) -> DataFrame:
    """Largest flows between different cells."""
    top = od.where(F.col("o") != F.col("d")).orderBy(F.desc("flow"), "o", "d").limit(n)
    return with_centers(top, p)


def net_pairs(pairs: DataFrame) -> DataFrame:
    """Opposite flows merged into their difference; balanced pairs vanish."""
    low, high = F.least("o", "d"), F.greatest("o", "d")
    signed = F.when(F.col("o") < F.col("d"), F.col("flow")).otherwise(-F.col("flow"))
    net = pairs.groupBy(low.alias("low"), high.alias("high")).agg(F.sum(signed).alias("net"))
    up = F.col("net") > 0
    return net.where(F.col("net") != 0).select(
        F.when(up, F.col("low")).otherwise(F.col("high")).alias("o"),
        F.when(up, F.col("high")).otherwise(F.col("low")).alias("d"),
        F.abs("net").alias("flow"),
    )


def _node_name(lng: Column, lat: Column) -> Column:
    return F.concat(F.lit("("), F.round(lng, 5).cast("string"), F.lit(","), F.round(lat, 5).cast("string"), F.lit(")"))


def flow_edges(od: DataFrame, n: int = 30, before_topk: bool = False, p: Params = DEFAULTS) -> DataFrame:
    """Edges of the flow map: source, target, value, with both cells.

    The top pairs are taken first and merged then; ``before_topk`` merges the whole
    matrix first.
    """
    between = od.where(F.col("o") != F.col("d"))
    if before_topk:
        net = net_pairs(between).orderBy(F.desc("flow"), "o", "d").limit(n)
    else:
        net = net_pairs(between.orderBy(F.desc("flow"), "o", "d").limit(n))
    c = with_centers(net, p)
    return c.select(
        "o", "d",
        _node_name(F.col("o_lng"), F.col("o_lat")).alias("source"),
        _node_name(F.col("d_lng"), F.col("d_lat")).alias("target"),
        F.col("flow").alias("value"),
    )


def flow_nodes(edges: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Distinct end cells of the edges: name, lng, lat."""
    cells = edges.select(F.explode(F.array("o", "d")).alias("cell")).distinct()
    lng, lat = grid_center(F.col("cell"), p)
    return cells.select(
        _node_name(lng, lat).alias("name"), F.round(lng, 5).alias("lng"), F.round(lat, 5).alias("lat"),
    )


def net_flow(trips: DataFrame, p: Params = DEFAULTS, dense: bool = False) -> DataFrame:
    """Outflow, inflow and net per cell; active cells only unless ``dense``."""
    moves = trips.select(F.inline(F.array(
        F.struct(grid_id(F.col("s_lng"), F.col("s_lat"), p).alias("grid_id"), F.lit(1).alias("out"), F.lit(0).alias("in")),
        F.struct(grid_id(F.col("e_lng"), F.col("e_lat"), p).alias("grid_id"), F.lit(0).alias("out"), F.lit(1).alias("in")),
    )))
    flows = moves.groupBy("grid_id").agg(F.sum("out").alias("outflow"), F.sum("in").alias("inflow"))
    if dense:
        cells = trips.sparkSession.range(p.n_cells).withColumnRenamed("id", "grid_id")
        flows = cells.join(flows, "grid_id", "left").fillna(0, ["outflow", "inflow"])
    lng, lat = grid_center(F.col("grid_id"), p)
    return flows.select(
        "grid_id", lng.alias("lng"), lat.alias("lat"), "outflow", "inflow",
        (F.col("inflow") - F.col("outflow")).alias("net_flow"),
    )


def top_cells(flows: DataFrame, column: str, n: int = 10) -> DataFrame:
    return flows.orderBy(F.desc(column), "grid_id").limit(n)


def net_flow_extremes(flows: DataFrame, n: int = 15) -> DataFrame:
    """The n largest net inflows and the n largest net outflows, for the two-sided list."""
    def side(direction: str, first: Column) -> DataFrame:
        place = F.row_number().over(Window.orderBy(first, "grid_id"))  # n rows
        best = flows.orderBy(first, "grid_id").limit(n)
        return best.select("*", F.lit(direction).alias("direction"), place.alias("order_no"))

    ranked = side("in", F.desc("net_flow")).unionByName(side("out", F.asc("net_flow")))
    return ranked.select(
        "direction", "order_no", "grid_id", point_label(F.col("lng"), F.col("lat")).alias("label"),
        "net_flow", F.abs("net_flow").alias("value"),
    ).orderBy("direction", "order_no")


def heat_points(trips: DataFrame, n: int = 500, cap: int = 50, p: Params = DEFAULTS) -> DataFrame:
    """Busiest start cells with the capped intensity of the heat layer."""
    return busiest_cells(density(trips, "start", p), n, cap)


def busiest_cells(cells: DataFrame, n: int = 500, cap: int = 50) -> DataFrame:
    """The first ``n`` of counted cells."""
    return cells.orderBy(F.desc("n"), "i_lng", "i_lat").limit(n).select(
        "i_lng", "i_lat", "lng", "lat", F.col("n").alias("count"),
        F.least(F.col("n"), F.lit(cap)).alias("intensity"),
    )
