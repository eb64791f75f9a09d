"""Distances and grid arithmetic as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tripweave.params import DEFAULTS, Params

EARTH_KM = 6371.0  # fixed value


def haversine_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Great-circle distance; null when any coordinate is null."""
    half_lat = (F.radians(lat2) - F.radians(lat1)) / 2.0
    half_lng = (F.radians(lng2) - F.radians(lng1)) / 2.0
    h = F.sin(half_lat) * F.sin(half_lat) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lng) * F.sin(half_lng)
    )
    return F.lit(2.0 * EARTH_KM) * F.atan2(F.sqrt(h), F.sqrt(1.0 - h))


def equirect_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Flat-earth distance at the mean latitude."""
    east = F.radians(lng2 - lng1) * F.cos(F.radians((lat1 + lat2) / 2.0))
    north = F.radians(lat2 - lat1)
    return F.lit(EARTH_KM) * F.sqrt(east * east + north * north)


def in_box(lng: Column, lat: Column, p: Params = DEFAULTS) -> Column:
    """Inclusive box test; null coordinates are outside."""
    return lng.between(p.lng_min, p.lng_max) & lat.between(p.lat_min, p.lat_max)


def _axis_cell(value: Column, low: float, step: float, n: int) -> Column:
    # points outside the box go to the edge cell, and before the cast, so that none is too large for it
    raw = (value - F.lit(low)) / F.lit(step)
    return F.least(F.lit(float(n - 1)), F.greatest(F.lit(0.0), raw)).cast("int")


def cell_lng(lng: Column, p: Params = DEFAULTS) -> Column:
    return F.when(lng.isNotNull(), _axis_cell(lng, p.lng_min, p.grid_lng, p.n_lng))


def cell_lat(lat: Column, p: Params = DEFAULTS) -> Column:
    return F.when(lat.isNotNull(), _axis_cell(lat, p.lat_min, p.grid_lat, p.n_lat))


def grid_id(lng: Column, lat: Column, p: Params = DEFAULTS) -> Column:
    return cell_lng(lng, p).cast("long") * F.lit(p.n_lat) + cell_lat(lat, p)


def center_lng(i_lng: Column, p: Params = DEFAULTS) -> Column:
    return F.lit(p.lng_min) + (i_lng + F.lit(0.5)) * F.lit(p.grid_lng)


def center_lat(i_lat: Column, p: Params = DEFAULTS) -> Column:
    return F.lit(p.lat_min) + (i_lat + F.lit(0.5)) * F.lit(p.grid_lat)


def grid_center(cell: Column, p: Params = DEFAULTS) -> tuple[Column, Column]:
    """Centre of a cell number: number = i_lng * n_lat + i_lat."""
    i_lat = cell % F.lit(p.n_lat)
    i_lng = (cell - i_lat) / F.lit(p.n_lat)
    return center_lng(i_lng, p), center_lat(i_lat, p)


def point_label(lng: Column, lat: Column, digits: int = 3) -> Column:
    return F.format_string(f"(%.{digits}f,%.{digits}f)", lng, lat)
