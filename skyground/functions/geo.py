"""Great-circle distance and the two grids that turn "within r metres" into key equality."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import EARTH_RADIUS_M

# Cells are a hair larger, and sure-neighbour cells a hair smaller, than the geometry asks,
# so that rounding in floor() and cos() can never lose a pair or invent one.
_WIDER = 1.000001
_NARROWER = 0.999999


def great_circle_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance in metres on the sphere."""
    sin_half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    sin_half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    parallel = F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b))
    hav = sin_half_lat * sin_half_lat + parallel * sin_half_lon * sin_half_lon
    # rounding can push antipodal points past 1, where asin is NaN
    return F.asin(F.sqrt(F.least(hav, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def _sure_key(value: str) -> str:
    """A join key known not to be NULL (rows without one were filtered before).

    Otherwise Spark guards each join with "key is not null" and pushes that down as a filter on the
    whole cell formula, evaluated once more per row.
    """
    return f"coalesce({value}, 0L)"


def located(lat: Column, lon: Column) -> Column:
    """True for usable coordinates; false for NULL, NaN and infinities."""
    return F.coalesce(lat.between(-360.0, 360.0) & lon.between(-360.0, 360.0), F.lit(False))


def in_box(lat: Column, lon: Column, south, north, west, east) -> Column:
    """Closed box test; edges are inside."""
    return lat.between(south, north) & lon.between(west, east)


def in_any_box(lat: Column, lon: Column, boxes) -> Column:
    """Inside at least one of a short fixed list of (code, south, north, west, east)."""
    tests = [in_box(lat, lon, s, n, w, e) for _, s, n, w, e in boxes]
    return F.coalesce(reduce(or_, tests), F.lit(False))


class CircleGrid:
    """Equi-join keys for points within ``radius_m`` of each other.

    Latitude is cut into bands ``span`` times 0.7 radii high, and every band into as many
    longitude cells as keep each at least that wide at its narrow edge. One side of a join keeps
    its home cell; the other is copied to every cell its circle touches: about four with span 3,
    three with span 4, for a larger number of pairs to test.
    ``wrap`` joins the cells on both sides of the 180th meridian.
    """

    def __init__(self, radius_m: float, wrap: bool = True, span: int = 3):
        if radius_m <= 0:
            raise ValueError("the radius must be positive")
        angle = min(radius_m / EARTH_RADIUS_M, math.pi / 2)
        self.wrap = wrap
        self.reach = math.degrees(radius_m / EARTH_RADIUS_M) * _WIDER
        self.sin_reach = math.sin(angle)
        # two points of a square with this side are never farther apart than the radius
        self.tight = math.degrees(math.sqrt(2) * math.sin(angle / 2)) * _NARROWER
        self.height = span * self.tight

    # Cell numbers are SQL text: short to read, and one call each to build.

    def _band(self, lat: str) -> str:
        return f"floor(({lat} + 90) / {self.height!r}D)"

    def _cells_in(self, band: str) -> str:
        south = f"({band} * {self.height!r}D - 90)"
        outer = f"least(greatest(abs({south}), abs({south} + {self.height!r}D)), 90D)"
        return f"greatest(floor(cos(radians({outer})) * {360 / self.height!r}D), 1)"

    def _wrapped(self, cell: str, cells: str) -> str:
        return _sure_key(f"pmod({cell}, {cells})" if self.wrap else cell)

    def _cell_of(self, lon: str, cells: str) -> str:
        return f"floor(({lon} + 180) / 360 * {cells})"

    def home(self, df: DataFrame, lat: str, lon: str, band: str, cell: str) -> DataFrame:
        """Adds the one cell each point lies in."""
        return (
            df.selectExpr("*", f"{_sure_key(self._band(lat))} AS {band}")
            .selectExpr("*", f"{self._cells_in(band)} AS _cells")
            .selectExpr("*", f"{self._wrapped(self._cell_of(lon, '_cells'), '_cells')} AS {cell}")
            .drop("_cells")
        )

    def touched(
        self, df: DataFrame, lat: str, lon: str, band: str, cell: str, only: str = "true"
    ) -> DataFrame:
        """One copy of each row per cell its circle touches, none twice.

        Rows for which ``only`` is false are passed on once, in band -1, which holds no point.
        """
        reach, sin_reach = f"{self.reach!r}D", f"{self.sin_reach!r}D"
        # a circle around a pole, or one wider than the band has cells, takes the whole band
        whole = f"(cos(radians({lat})) <= {sin_reach} OR _last - _first + 1 >= _cells)"
        end = "_cells - 1" if self.wrap else "_cells"
        half = f"degrees(asin(least({sin_reach} / cos(radians({lat})), 1D))) * {_WIDER}D"
        return (
            df.selectExpr("*", f"explode(if({only}, sequence({self._band(f'{lat} - {reach}')},"
                               f" {self._band(f'{lat} + {reach}')}), array(-1L))) AS {band}")
            .selectExpr("*", f"{self._cells_in(band)} AS _cells", f"{half} AS _half")
            .selectExpr("*", f"{self._cell_of(f'{lon} - _half', '_cells')} AS _first",
                        f"{self._cell_of(f'{lon} + _half', '_cells')} AS _last")
            .selectExpr("*", f"explode(if({only}, sequence(if({whole}, 0, _first),"
                             f" if({whole}, {end}, _last)), array(0L))) AS _touched")
            .selectExpr("*", f"{self._wrapped('_touched', '_cells')} AS {cell}")
            .drop("_cells", "_half", "_first", "_last", "_touched")
        )

    def sure(self, df: DataFrame, lat: str, lon: str, band: str, cell: str) -> DataFrame:
        """Adds a cell so small that all points in it are within the radius of each other."""
        south = f"({band} * {self.tight!r}D - 90)"
        north = f"({south} + {self.tight!r}D)"
        # width is bounded at the edge nearer the equator; a band across it, or off the globe,
        # counts as widest
        widest = (f"if({south} * {north} <= 0 OR {south} < -90 OR {north} > 90, 1D,"
                  f" cos(radians(least(abs({south}), abs({north})))))")
        return (
            df.selectExpr(
                "*", _sure_key(f"floor(({lat} + 90) / {self.tight!r}D)") + f" AS {band}")
            .selectExpr("*", f"greatest(ceil({widest} * {360 / self.tight!r}D), 1) AS _cells")
            .selectExpr("*", f"{self._wrapped(self._cell_of(lon, '_cells'), '_cells')} AS {cell}")
            .drop("_cells")
        )
