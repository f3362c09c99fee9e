"""Small rules as columns, and the parameter checks of a release run."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_list(text: str) -> list[int]:
    """``2017,2019``, ``2017-2020`` (either way round, at most 200 apart) or one year; sorted, without repeats."""
    text = text.strip()
    if re.fullmatch(r"[0-9]{4}\s*-\s*[0-9]{4}", text):
        first, last = sorted(int(y) for y in text.split("-"))
        if last - first > 200:
            raise ValueError("a range of years spans at most 200")
        return list(range(first, last + 1))
    if not re.fullmatch(r"[0-9]{4}(\s*,\s*[0-9]{4})*", text):
        raise ValueError(f"not a list of years: {text!r}")
    return sorted({int(y) for y in text.split(",")})


def instant_of_http_date(value: Column) -> Column:
    """``Sat, 07 Feb 2026 00:00:00 GMT`` as an ISO instant; null if it isn't one."""
    # The name of the day says nothing that the date doesn't.
    bare = F.regexp_extract(value, r"^[A-Z][a-z]{2}, ([0-9]{2} [A-Z][a-z]{2} [0-9]{4} [0-9:]{8}) GMT$", 1)
    return F.date_format(F.try_to_timestamp(bare, F.lit("dd MMM yyyy HH:mm:ss")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def effective_steps(steps: Column, strength: Column) -> Column:
    """At least so many steps that one of them is run at this strength."""
    return F.greatest(steps, F.ceil(F.lit(1.0) / strength)).cast("int")


def raised_steps(steps: Column, strength: Column) -> Column:
    """As above, but only where no step would be run."""
    return F.when(F.floor(strength * steps) < 1, effective_steps(steps, strength)).otherwise(steps).cast("int")


def multiple_of_eight(size: Column) -> Column:
    return F.greatest(F.lit(8), F.floor(size / 8).cast("int") * 8)


def bbox_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Five corners from the south-west, counter-clockwise."""
    return F.array(*[F.array(x, y) for x, y in ((west, south), (east, south), (east, north), (west, north), (west, south))])


def bbox_of(points: Column) -> Column:
    """West, south, east and north of an array of points, finite ones only; null if there is none."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    sound = F.filter(points, lambda p: finite(p[0]) & finite(p[1]))
    x, y = F.transform(sound, lambda p: p[0]), F.transform(sound, lambda p: p[1])
    return F.when(F.size(sound) > 0, F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))


def bbox_over(x: Column, y: Column) -> Column:
    """The same as an aggregate over rows, which adds up before a shuffle."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    sound = finite(x) & finite(y)
    own = lambda v: F.when(sound, v)
    return F.when(F.count_if(sound) > 0, F.array(F.min(own(x)), F.min(own(y)), F.max(own(x)), F.max(own(y))))


def covers(outer: Column, inner: Column, slack: float = 1e-9) -> Column:
    return (inner[0] >= outer[0] - slack) & (inner[1] >= outer[1] - slack) & (inner[2] <= outer[2] + slack) & (inner[3] <= outer[3] + slack)


def first_geometry(document: Column) -> Column:
    """GeoJSON text of the geometry of a collection's first feature, of a feature, or the geometry itself."""
    return F.coalesce(F.get_json_object(document, "$.features[0].geometry"), F.get_json_object(document, "$.geometry"), F.when(F.get_json_object(document, "$.coordinates").isNotNull(), document))


def usable_overlap(tileset: Column) -> Column:
    """The overlap of a tile set's description, 0 where it is missing or out of range."""
    found = F.get_json_object(tileset, "$.overlap").try_cast("double")
    return F.when((found >= 0) & (found <= 0.49), found).otherwise(F.lit(0.0))


def layer_list(query: Column, known: tuple[str, ...]) -> Column:
    """Known layers of a comma-separated list, in the known order, without repeats."""
    asked = F.transform(F.split(F.coalesce(query, F.lit("")), ","), lambda name: F.trim(name))
    return F.filter(F.array(*map(F.lit, known)), lambda name: F.array_contains(asked, name))


def byte_range(header: str | None, size: int) -> tuple[int, int] | None:
    """First and last byte of a single range; None without a header; a ValueError where it can't be served."""
    if header is None:
        return None
    m = re.fullmatch(r"bytes=([0-9]*)-([0-9]*)", header.strip())
    if not m or not (m[1] or m[2]):
        raise ValueError("not a single byte range")
    first, last = (int(m[1]), min(int(m[2]) if m[2] else size - 1, size - 1)) if m[1] else (max(size - int(m[2]), 0), size - 1)
    if first >= size or first > last:
        raise ValueError("the range lies outside")
    return first, last
