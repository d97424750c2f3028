"""Planar and spherical geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088  # fixed value: mean Earth radius


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance; within 0.5 % of the ellipsoidal one."""
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    half = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(half))


def closed_ring(points: Column) -> Column:
    """Distinct points in order with the first repeated at the end."""
    unique = F.array_distinct(points)
    return F.concat(unique, F.slice(unique, 1, 1))


def ring_edges(ring: Column) -> Column:
    """Edges of a closed ring of ``struct<lng,lat>``, each with its two ends ``a`` and ``b``."""
    count = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.arrays_zip(F.slice(ring, F.lit(1), count).alias("a"), F.slice(ring, F.lit(2), count).alias("b"))


def edges_for_box(edges: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """The edges that a ray towards the east can cross from a point of the box, among them all that touch the box."""

    def counts(edge: Column) -> Column:
        a, b = edge["a"], edge["b"]
        return (
            (F.greatest(a["lng"], b["lng"]) >= west) & (F.greatest(a["lat"], b["lat"]) >= south) & (F.least(a["lat"], b["lat"]) <= north)
        )

    return F.filter(edges, counts)


def ring_meets_box(ring: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether an edge of a closed ring of ``struct<lng,lat>`` touches the box."""
    return edges_meet_box(ring_edges(ring), west, south, east, north)


def edges_meet_box(edges: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether one of the edges touches the box.

    A segment misses a box if their extents lie apart or all four corners lie on one side of its line.
    """

    def meets(edge: Column) -> Column:
        a, b = edge["a"], edge["b"]
        apart = (
            (F.greatest(a["lng"], b["lng"]) < west) | (F.least(a["lng"], b["lng"]) > east)
            | (F.greatest(a["lat"], b["lat"]) < south) | (F.least(a["lat"], b["lat"]) > north)
        )
        sides = [(b["lng"] - a["lng"]) * (y - a["lat"]) - (b["lat"] - a["lat"]) * (x - a["lng"]) for x in (west, east) for y in (south, north)]
        return ~apart & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return F.exists(edges, meets)


def inside_ring(ring: Column, lng: Column, lat: Column) -> Column:
    """Even-odd ray casting against a closed ring of ``struct<lng,lat>``."""
    return inside_edges(ring_edges(ring), lng, lat)


def edge_crosses(a_lng: Column, a_lat: Column, b_lng: Column, b_lat: Column, lng: Column, lat: Column) -> Column:
    """Whether a ray towards the east crosses the edge from ``a`` to ``b``."""
    at = a_lng + (lat - a_lat) * (b_lng - a_lng) / F.nullif(b_lat - a_lat, F.lit(0.0))
    return ((a_lat > lat) != (b_lat > lat)) & (lng < at)


def inside_edges(edges: Column, lng: Column, lat: Column) -> Column:
    """Even-odd ray casting towards the east against edges."""

    def crosses(edge: Column) -> Column:
        return edge_crosses(edge["a"]["lng"], edge["a"]["lat"], edge["b"]["lng"], edge["b"]["lat"], lng, lat)

    return F.size(F.filter(edges, crosses)) % 2 == 1
