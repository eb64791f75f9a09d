"""Density clusters that grow with the trips: the result of a fresh clustering, from the cells that changed.

Points are only ever added, so a core site stays core and linked cells stay linked. New points can
make sites core within two cells of theirs; these can link cells and reach border sites two cells
further on. So each step loads the stored regions around the new points, flags, links and reaches
there with the batch operators, and joins the links to the components so far. Sites are stored by
region, under the version that changed the region last; cells and border sums are small tables of the area.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tripweave.operators.components import connected_components
from tripweave.operators.hotspots import boxes_of, largest_clusters, link_cells, near_sums, sites_of, with_salts
from tripweave.params import DEFAULTS, Params
from tripweave.session import cut

KIND = "start"
#: Cells on a side of a stored region.
REGION = 16
_SITE = "region long, lng double, lat double, w long, first_id long, x double, y double, cx long, cy long, cell long, core boolean, reach array<long>"
_CELL = "cell long, cx long, cy long, region long, root long, first_id long, w long, wx double, wy double"
_BORDER = "region long, reach array<long>, w long, wx double, wy double"


def _region(cx: Column, cy: Column) -> Column:
    return (F.floor(cx / REGION) * (1 << 31) + F.floor(cy / REGION)).cast("long")


def _ring(cells: DataFrame, width: int) -> DataFrame:
    """The cells at most ``width`` columns and rows away."""
    around = lambda c: F.explode(F.sequence(F.col(c) - width, F.col(c) + width)).alias(c)
    return cells.select(around("cx"), "cy").select("cx", around("cy")).distinct()


def _stored_sites(spark: SparkSession, regions: DataFrame, wanted: list[int]) -> DataFrame:
    """The stored sites of some regions, each from the folder that holds it."""
    by_path: dict[str, list[int]] = {}
    for row in regions.where(F.col("region").isin(wanted)).collect():  # regions around one batch: bounded by the area
        by_path.setdefault(row.path, []).append(row.region)
    parts = [spark.read.parquet(path).where(F.col("region").isin(some)) for path, some in by_path.items()]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], _SITE))


def grown(spark: SparkSession, before: str | None, points: DataFrame, p: Params = DEFAULTS) -> dict[str, DataFrame]:
    """The state with ``points`` (id, lng, lat) added to the state of the version stored at ``before``.

    sites: all sites of the regions that changed, regions: the folder of each other region's sites,
    cells: the core cells with their component, borders: sums of border sites by the core cells they reach.
    """
    read = lambda name, schema: spark.read.parquet(f"{before}/{name}") if before else spark.createDataFrame([], schema)
    regions = read("regions", "region long, path string")
    if before:  # regions that the version before changed itself are in its own folder
        own = spark.read.parquet(f"{before}/sites").select("region").distinct().withColumn("path", F.lit(f"{before}/sites"))
        regions = regions.join(own, "region", "left_anti").unionByName(own)
    regions, cells, borders = cut(regions), read("cells", _CELL), read("borders", _BORDER)
    fresh = cut(sites_of(points.withColumn("kind", F.lit(KIND)), p, (KIND,)))
    touched = cut(fresh.select("cx", "cy").distinct())
    wanted = [r.region for r in _ring(touched, 6).select(_region(F.col("cx"), F.col("cy")).alias("region")).distinct().collect()]
    if not wanted:
        return {"sites": spark.createDataFrame([], _SITE), "regions": regions, "cells": cells, "borders": borders}
    known = _stored_sites(spark, regions, wanted)
    place = ["x", "y", "cx", "cy", "cell"]
    merged = known.unionByName(fresh.drop("kind"), allowMissingColumns=True).groupBy("lng", "lat", *place).agg(
        F.sum("w").alias("w"), F.min("first_id").alias("first_id"), F.coalesce(F.max("core"), F.lit(False)).alias("was_core"),
        F.max("reach").alias("old_reach"),
    ).withColumns({"kind": F.lit(KIND), "region": _region(F.col("cx"), F.col("cy"))})
    tagged, n_cells = with_salts(cut(merged), p)
    dirty, wide = (cut(_ring(touched, n)).withColumn(name, F.lit(True)) for n, name in ((2, "dirty"), (4, "wide")))
    tagged = cut(tagged.join(dirty, ["cx", "cy"], "left").join(wide, ["cx", "cy"], "left"))
    dense = F.col("was_core") | (F.col("pop") >= p.min_points)
    asked = tagged.where(~dense & F.col("dirty"))
    seen = near_sums(asked, tagged, n_cells, p.min_points, p).groupBy("lng", "lat").agg((F.sum("w") >= p.min_points).alias("full"))
    flagged = cut(tagged.join(seen, ["lng", "lat"], "left").withColumn("core", dense | F.coalesce("full", F.lit(False))).drop("full"))
    core = flagged.where("core")
    loose = flagged.where(~F.col("core") & F.col("wide"))
    reach = near_sums(loose, core, n_cells, 1, p, each_cell=True).select(
        "lng", "lat", ((F.col("cx") + 2**30) * 2**31 + F.col("cy") + 2**30).alias("to")
    ).groupBy("lng", "lat").agg(F.array_sort(F.collect_set("to")).alias("new_reach"))
    none = F.array().cast("array<long>")
    sites = cut(flagged.join(reach, ["lng", "lat"], "left").withColumn(
        "reach", F.when(F.col("core"), none).when(F.col("wide"), F.coalesce("new_reach", none)).otherwise(F.coalesce("old_reach", none))
    ).select(*[c.split()[0] for c in _SITE.split(", ")]).repartition("region").sortWithinPartitions("region"))
    near = core.where("wide")
    found = link_cells(near, cut(boxes_of(near, ["kind", "cell", "cx", "cy"])), n_cells, p)
    links = cells.select(F.col("cell").alias("u"), F.col("root").alias("v")).unionByName(found.toDF("u", "v"))
    roots = cut(connected_components(links))
    sums = [F.sum("w").alias("w"), F.sum(F.col("w") * F.col("lng")).alias("wx"), F.sum(F.col("w") * F.col("lat")).alias("wy")]
    new_cells = sites.where("core").groupBy("cell", "cx", "cy", "region").agg(F.min("first_id").alias("first_id"), *sums)
    kept = cells.drop("root").where(~F.col("region").isin(wanted))
    cells = kept.unionByName(new_cells).join(roots.withColumnRenamed("node", "cell"), "cell", "left").withColumn("root", F.coalesce("root", "cell"))
    new_borders = sites.where(F.size("reach") > 0).groupBy("region", "reach").agg(*sums)
    borders = borders.where(~F.col("region").isin(wanted)).unionByName(new_borders)
    return {"sites": sites, "regions": regions.where(~F.col("region").isin(wanted)), "cells": cut(cells), "borders": cut(borders)}


def summary(state: dict[str, DataFrame]) -> DataFrame:
    """point_type, cluster_id, center_lng, center_lat, trip_count of every cluster.

    Clusters are numbered by their smallest core id; a border site counts for the lowest cluster it reaches.
    """
    cells, borders = state["cells"], state["borders"]
    first = cells.groupBy("root").agg(F.min("first_id").alias("first_id"))  # at most a row for each cell of the area
    numbers = first.select("root", (F.row_number().over(Window.orderBy("first_id")) - 1).alias("cluster_id"))
    named = cut(cells.join(numbers, "root"))
    sums = ("w", "wx", "wy")
    lowest = borders.select("*", F.explode("reach").alias("cell")).join(named.select("cell", "cluster_id"), "cell").groupBy("region", "reach", *sums).agg(
        F.min("cluster_id").alias("cluster_id")
    )
    whole = named.select("cluster_id", *sums).unionByName(lowest.select("cluster_id", *sums)).groupBy("cluster_id").agg(*[F.sum(c).alias(c) for c in sums])
    return whole.select(
        F.lit(KIND).alias("point_type"), "cluster_id", (F.col("wx") / F.col("w")).alias("center_lng"), (F.col("wy") / F.col("w")).alias("center_lat"),
        F.col("w").alias("trip_count"),
    )


def hotspots(state: dict[str, DataFrame], p: Params = DEFAULTS) -> DataFrame:
    return largest_clusters(summary(state), p)
