"""Cells of the map: latitude and longitude as one number whose order keeps near places near, and boxes as few ranges of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of each coordinate; a cell is some 300 by 600 metres at the equator.
BITS = 16


def _scaled(value: Column, low: float, width: float) -> Column:
    size = 1 << BITS
    return F.greatest(F.lit(0), F.least(F.lit(size - 1), F.floor((value - low) / width * size))).cast("long")


def _spread(value: Column) -> Column:
    """Bits apart from each other by one zero."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return value


def cell(lat: Column, lon: Column) -> Column:
    """Interleaved bits of both coordinates (latitude first), null where one is null or not a number."""
    known = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat.cast("double")) & ~F.isnan(lon.cast("double"))
    return F.when(known, F.shiftleft(_spread(_scaled(lat, -90.0, 180.0)), 1).bitwiseOR(_spread(_scaled(lon, -180.0, 360.0))))


def cover(south: float, west: float, north: float, east: float, most: int = 24) -> list[tuple[int, int]]:
    """At most `most` ranges of cells, both ends included, that hold every place of a box. Quarters of the map that the box cuts are split, the largest first, while ranges are left; none for an empty box."""
    size = 1 << BITS
    scale = lambda v, low, width: max(0, min(size - 1, int((v - low) / width * size // 1)))
    if south > north or west > east:
        return []
    y0, y1, x0, x1 = scale(south, -90.0, 180.0), scale(north, -90.0, 180.0), scale(west, -180.0, 360.0), scale(east, -180.0, 360.0)
    done, open_ = [], [(0, 0, 0, BITS)]  # first cell, y, x, bits of a square
    while open_ and len(done) + len(open_) + 3 <= most * 2:
        start, y, x, bits = open_.pop(0)
        side = 1 << bits
        if y0 <= y and y + side - 1 <= y1 and x0 <= x and x + side - 1 <= x1:
            done.append((start, start + side * side - 1))
            continue
        half, quarter = side // 2, side * side // 4
        for k, (dy, dx) in enumerate(((0, 0), (0, half), (half, 0), (half, half))):
            if y + dy <= y1 and y + dy + half > y0 and x + dx <= x1 and x + dx + half > x0:
                open_.append((start + k * quarter, y + dy, x + dx, bits - 1))
    ranges = sorted(done + [(s, s + (1 << (2 * b)) - 1) for s, _, _, b in open_])
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    while len(out) > most:  # close the smallest gap
        gaps = [out[i + 1][0] - out[i][1] for i in range(len(out) - 1)]
        i = gaps.index(min(gaps))
        out[i : i + 2] = [(out[i][0], out[i + 1][1])]
    return out


def in_ranges(column: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether a cell lies in one of the ranges: a filter that Parquet readers hold against the statistics of row groups."""
    found = F.lit(False)
    for a, b in ranges:
        found = found | column.between(a, b)
    return found
