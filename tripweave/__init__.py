"""tripweave: trips, demand tables and hotspots from fleet GPS pings, on Spark."""

from tripweave.params import Params

__all__ = ["Params"]
