"""A space-filling order of coordinates: the bits of latitude and longitude cells, interleaved."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Bits of each coordinate; cells are 0.0055 degrees of longitude and half that of latitude.
BITS = 16
_SIDE = 1 << BITS
#: Shift and mask pairs that put a zero between neighbouring bits of a 16-bit number.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _cell(value: Column, low: float, width: float) -> Column:
    at = F.floor((value - low) / width * _SIDE)
    # greatest() and least() would pass over a NULL
    return F.when(value.isNotNull(), F.greatest(F.lit(0), F.least(at, F.lit(_SIDE - 1)))).cast("bigint")


def _cell_of(value: float, low: float, width: float) -> int:
    return max(0, min(int((value - low) / width * _SIDE // 1), _SIDE - 1))


def _spread(cell: Column) -> Column:
    for shift, mask in _SPREAD:
        cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return cell


def morton(lat: Column, lon: Column) -> Column:
    """The code of a point, from 0 to 2**32 - 1; coordinates beyond the globe count as its edge, and
    one that is missing gives NULL. Points of one cell of any size are neighbours in the order."""
    return _spread(_cell(lat, -90.0, 180.0)).bitwiseOR(
        F.shiftleft(_spread(_cell(lon, -180.0, 360.0)), 1))


def ranges(south: float, north: float, west: float, east: float, most: int = 64
           ) -> list[tuple[int, int]]:
    """At most ``most`` closed ranges of codes that together hold every point of a closed box, and
    few others: quarters of the globe are cut further where the box has a part of them."""
    if south > north or west > east:
        return []
    y0, y1 = (_cell_of(v, -90.0, 180.0) for v in (south, north))
    x0, x1 = (_cell_of(v, -180.0, 360.0) for v in (west, east))
    done: list[tuple[int, int]] = []
    cut = [(0, 0, 0, BITS)]  # first code, first cells, and level of a square
    while cut:
        after = []
        for code, y, x, level in cut:
            side = 1 << level
            if y > y1 or x > x1 or y + side <= y0 or x + side <= x0:
                continue
            if y0 <= y and y + side - 1 <= y1 and x0 <= x and x + side - 1 <= x1 or level == 0:
                done.append((code, code + side * side - 1))
                continue
            half, quarter = side // 2, side * side // 4
            after += [(code, y, x, level - 1), (code + quarter, y + half, x, level - 1),
                      (code + 2 * quarter, y, x + half, level - 1),
                      (code + 3 * quarter, y + half, x + half, level - 1)]
        if len(done) + len(after) > most:  # what is not cut further is taken whole
            done += [(code, code + (1 << 2 * level) - 1) for code, y, x, level in after
                     if not (y > y1 or x > x1 or y + (1 << level) <= y0 or x + (1 << level) <= x0)]
            break
        cut = after
    merged: list[tuple[int, int]] = []
    for a, b in sorted(done):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    while len(merged) > most:  # the two nearest ranges become one
        k = min(range(len(merged) - 1), key=lambda i: merged[i + 1][0] - merged[i][1])
        merged[k:k + 2] = [(merged[k][0], merged[k + 1][1])]
    return merged
