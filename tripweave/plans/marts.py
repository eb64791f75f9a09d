"""Result marts: each a DataFrame built from trips; nothing here runs a job by itself
except where an exact percentile or a clustering needs one."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F

from tripweave.functions.clock import hour_label
from tripweave.functions.geo import point_label
from tripweave.operators import hotspots as H
from tripweave.operators import sample, spatial, temporal
from tripweave.params import DEFAULTS, Params
from tripweave.plans import board
from tripweave.session import cut
from tripweave.sources.sinks import od_columns


def _one_row(*frames: DataFrame) -> DataFrame:
    """Frames of one row each as one row, without a join."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])


@dataclass(frozen=True)
class Marts:
    """Marts over one set of valid trips. Persist the trips when building several."""

    trips: DataFrame
    params: Params = DEFAULTS

    @cached_property
    def hourly_stats(self) -> DataFrame:
        return temporal.hourly_stats(self.trips)

    @cached_property
    def od(self) -> DataFrame:
        return spatial.od_matrix(self.trips, self.params)

    @cached_property
    def clusters(self) -> DataFrame:
        """All clusters of both point types, labelled; fixed, as several marts read them."""
        return cut(H.all_clusters(self.trips, "both", self.params))

    @cached_property
    def hotspots(self) -> DataFrame:
        """The largest clusters of both point types."""
        return H.largest_clusters(self.clusters, self.params)

    @cached_property
    def start_hotspots(self) -> DataFrame:
        if "clusters" in self.__dict__:  # clustered already, with the ends
            return self.hotspots.where(F.col("point_type") == "start")
        return H.find_hotspots(self.trips, "start", self.params)

    def kpis(self) -> DataFrame:
        return temporal.kpis(self.trips).select(
            "total_trips", "total_vehicles", "avg_duration", "peak_hour", "peak_trips"
        )

    def hourly(self) -> DataFrame:
        return temporal.hourly_counts(self.trips).select(
            "hour", hour_label(F.col("hour")).alias("label"), "trip_count"
        )

    def duration_histogram(self) -> DataFrame:
        return temporal.duration_histogram(self.trips)

    def period_shares(self) -> DataFrame:
        return temporal.period_stats(self.trips, self.params).select(
            "period_no", "period_name", F.round("ratio_pct", 1).alias("ratio_pct")
        )

    def hotspot_bars(self) -> DataFrame:
        label = F.concat(
            F.lit("#"), F.col("cluster_id"), F.lit(" "), point_label(F.col("center_lng"), F.col("center_lat"))
        )
        top = self.start_hotspots.orderBy(F.desc("trip_count"), "cluster_id").limit(15)
        return top.select("cluster_id", label.alias("label"), "trip_count")

    def distance_histogram(self) -> DataFrame:
        return temporal.distance_histogram(self.trips)

    def distance_summary(self) -> DataFrame:
        return temporal.distance_stats(self.trips, self.params).select(
            F.round("mean", 2).alias("mean"), F.round("median", 2).alias("median"),
            F.round("short_trip_ratio", 1).alias("short_ratio"), F.round("long_trip_ratio", 1).alias("long_ratio"),
        )

    def speed_histogram(self) -> DataFrame:
        return temporal.speed_histogram(self.trips)

    def speed_summary(self) -> DataFrame:
        return temporal.speed_stats(self.trips).select(
            F.round("mean", 1).alias("mean"), F.round("median", 1).alias("median"), "total", "mean_bin"
        )

    def top_vehicles(self, n: int = 15) -> DataFrame:
        top = temporal.top_vehicles(temporal.vehicle_efficiency(self.trips), n)
        return top.select(
            "vehicle_id", "trip_count",
            F.round("total_duration", 1).alias("total_duration"), F.round("total_distance", 2).alias("total_distance"),
            F.round("avg_duration", 1).alias("avg_duration"), F.round("avg_distance", 2).alias("avg_distance"),
        )

    def flow_edges(self) -> DataFrame:
        return spatial.flow_edges(self.od, p=self.params)

    def flow_nodes(self) -> DataFrame:
        return spatial.flow_nodes(self.flow_edges(), self.params)

    def net_flow_extremes(self) -> DataFrame:
        return spatial.net_flow_extremes(spatial.net_flow(self.trips, self.params))

    def report_fields(self) -> DataFrame:
        """One row: everything the text report states apart from its vehicle list."""
        k = temporal.kpis(self.trips)
        peaks = temporal.peak_hours(temporal.hourly_counts(self.trips), self.params)
        shares = self.trips.agg(
            (F.avg(F.when(F.col("distance_km") < self.params.short_km, 1.0).otherwise(0.0)) * 100).alias("short_trip_ratio"),
            (F.avg(F.when(F.col("distance_km") > self.params.long_km, 1.0).otherwise(0.0)) * 100).alias("long_trip_ratio"),
        )
        kinds = self.clusters.agg(*[
            F.count_if(F.col("point_type") == kind).alias(f"{kind}_hotspots") for kind in ("start", "end")
        ])
        return _one_row(k, peaks, shares, kinds).select(
            "total_trips", "total_vehicles", "avg_duration", "avg_distance",
            "morning_peak", "evening_peak", "peak_hour_max", "peak_max_trips",
            "short_trip_ratio", "long_trip_ratio", "start_hotspots", "end_hotspots",
        )

    def report_figures(self) -> DataFrame:
        """figure_no, figure, text: the figures of the report as they are printed, a dash where there is none."""
        r = self.report_fields()
        number = lambda c, digits: F.coalesce(F.format_number(c, digits), F.lit("-"))
        listed = lambda c: F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]"))
        figures = [
            ("trips", number("total_trips", 0)), ("vehicles", number("total_vehicles", 0)),
            ("mean duration (min)", number("avg_duration", 1)), ("mean distance (km)", number("avg_distance", 2)),
            ("morning peak hours", listed("morning_peak")), ("evening peak hours", listed("evening_peak")),
            ("busiest hour", F.concat(hour_label(F.col("peak_hour_max")), F.lit(" ("), number("peak_max_trips", 0), F.lit(" trips)"))),
            ("short trips (%)", number("short_trip_ratio", 1)), ("long trips (%)", number("long_trip_ratio", 1)),
            ("pick-up hotspots", number("start_hotspots", 0)), ("drop-off hotspots", number("end_hotspots", 0)),
        ]
        rows = [F.struct(F.lit(i).alias("figure_no"), F.lit(name).alias("figure"), text.alias("text")) for i, (name, text) in enumerate(figures)]
        return r.select(F.inline(F.array(*rows)))

    def reference_lines(self) -> DataFrame:
        return temporal.hourly_reference_lines(temporal.hourly_counts(self.trips), self.params)

    def scatter(self) -> DataFrame:
        return sample.scatter(self.trips)

    def correlation(self) -> DataFrame:
        return temporal.duration_distance_correlation(self.trips)

    def time_summary(self) -> DataFrame:
        k = temporal.kpis(self.trips).select("total_trips", "total_vehicles")
        peaks = temporal.peak_hours(temporal.hourly_counts(self.trips), self.params)
        return _one_row(k, peaks.select("morning_peak", "evening_peak", "peak_hour_max"))

    def space_summary(self) -> DataFrame:
        p = self.params
        return self.clusters.where("point_type = 'start'").agg(F.count(F.lit(1)).alias("hotspot_count")).select(
            F.lit(p.n_cells).alias("n_cells"), F.lit(p.grid_lng).alias("grid_lng"),
            F.lit(p.grid_lat).alias("grid_lat"), "hotspot_count",
        )

    def cache_rows(self) -> DataFrame:
        return board.cache_rows(self.trips, self.start_hotspots, self.params)

    def board_set(self) -> dict[str, DataFrame]:
        """Everything the analysis board shows."""
        return {
            "kpis": self.kpis(), "hourly": self.hourly(), "duration": self.duration_histogram(),
            "period": self.period_shares(), "hotspots": self.hotspot_bars(),
            "distance": self.distance_histogram(), "distance_summary": self.distance_summary(),
            "speed": self.speed_histogram(), "speed_summary": self.speed_summary(),
            "vehicles": self.top_vehicles(), "flow_nodes": self.flow_nodes(), "flow_edges": self.flow_edges(),
            "net_flow": self.net_flow_extremes(),
        }

    def result_tables(self) -> dict[str, DataFrame]:
        """The tables of the result store, by name."""
        return {
            "od_trips": od_columns(self.trips),
            "hourly_stats": self.hourly_stats,
            "period_stats": temporal.period_stats(self.trips, self.params),
            "hotspots": self.hotspots,
            "vehicle_efficiency": temporal.vehicle_efficiency(self.trips).withColumnRenamed("vehicle_id", "VehicleNum"),
            "net_flow": spatial.net_flow(self.trips, self.params),
            "realtime_stats": self.cache_rows(),
        }
