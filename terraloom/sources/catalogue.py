"""Scene catalogues as a Spark source: pages are fetched in tasks, and filters become part of the request.

    catalogue.register(spark)
    spark.read.format("scene_catalogue").option("url", ...).option("collection", ...).option("datetime", "2023-05-01T00:00:00Z/2024-09-30T23:59:59Z").load()
        .where("datetime >= '2024-05-01T00:00:00Z' AND cloud_cover <= 20")

A time range is read in as many parts as it has months: each is a partition that follows its own next links, one page in
memory at a time, so a task that is run again asks for its own months only. Bounds on ``datetime`` (as text in the catalogue's form) narrow the range and drop
months, an upper bound on ``cloud_cover`` goes into the query; Spark keeps checking both, as a catalogue may answer with more. Other filters stay with Spark.

``cells_for_bbox(west, south, east, north, size)`` is a table function: the cells of a grid that a box covers.
"""

from __future__ import annotations

import json
import math
import re
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from terraloom.sources.stac import ASSETS, MOST_PAGES, pages

SCHEMA = "id string, datetime string, cloud_cover double, tile_id string, proj_epsg int, assets struct<red: string, nir: string, scl: string>"
#: The form of an instant, and how many items a page asks for.
INSTANT, PAGE = "%Y-%m-%dT%H:%M:%SZ", 200
_INSTANT = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z")


def time_range(text: str) -> tuple[datetime, datetime]:
    """Start and end of ``start/end``; both must be full instants in UTC."""
    ends = text.split("/") if isinstance(text, str) else []
    if len(ends) != 2 or not all(_INSTANT.fullmatch(e) for e in ends):
        raise ValueError(f"a time range is start/end, each like 2024-05-01T00:00:00Z: {text!r}")
    start, end = (datetime.strptime(e, INSTANT).replace(tzinfo=timezone.utc) for e in ends)
    if end < start:
        raise ValueError(f"the range ends before it starts: {text!r}")
    return start, end


def months(start: datetime, end: datetime) -> Iterator[tuple[datetime, datetime]]:
    """The parts of a range by calendar month, in whole seconds, without overlap."""
    while start <= end:
        following = (start.replace(day=1, hour=0, minute=0, second=0) + timedelta(days=32)).replace(day=1)
        last = min(end, following - timedelta(seconds=1))
        yield start, last
        start = following


def post(url: str, body: dict, seconds: float) -> dict:
    request = urllib.request.Request(f"{url.rstrip('/')}/search", json.dumps(body).encode(), {"content-type": "application/json"})
    with urllib.request.urlopen(request, timeout=seconds) as answer:
        return json.load(answer)


def normal(item: dict) -> tuple:
    """One row of an item; without an identifier or an asset it is refused."""
    properties, assets = item.get("properties") or {}, item.get("assets") or {}
    if not isinstance(item.get("id"), str) or not item["id"]:
        raise ValueError("an item without id")
    links = [(assets.get(key) or {}).get("href") for key in ASSETS.values()]
    if not all(isinstance(x, str) and x for x in links):
        raise ValueError(f"item {item['id']} lacks one of {', '.join(ASSETS.values())}")
    grid = [properties.get(f"mgrs:{part}") for part in ("utm_zone", "latitude_band", "grid_square")]
    tile = properties.get("s2:tile_id") or ("".join(map(str, grid)) if all(x is not None for x in grid) else None)
    number = lambda name, kind: kind(properties[name]) if isinstance(properties.get(name), (int, float)) else None
    return item["id"], properties.get("datetime"), number("eo:cloud_cover", float), tile, number("proj:epsg", int), tuple(links)


@dataclass
class Month(InputPartition):
    start: str
    end: str


class CatalogueReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        for name in ("url", "collection", "datetime"):
            if not options.get(name):
                raise ValueError(f"option {name} is missing")
        self.options = dict(options)
        self.start, self.end = time_range(options["datetime"])
        self.most_cloud = math.inf

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrows the request; all filters are left to Spark too."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("cloud_cover",) and isinstance(f, (LessThan, LessThanOrEqual)):
                self.most_cloud = min(self.most_cloud, float(value))
            elif column == ("datetime",) and isinstance(value, str) and _INSTANT.fullmatch(value):
                at = datetime.strptime(value, INSTANT).replace(tzinfo=timezone.utc)
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.start = max(self.start, at)
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    # Items carry fractions of a second, which sort before the Z of the bound.
                    self.end = min(self.end, at + timedelta(seconds=1))
            yield f

    def body(self, part: Month) -> dict:
        body: dict = {"collections": [self.options["collection"]], "datetime": f"{part.start}/{part.end}", "limit": int(self.options.get("limit", PAGE))}
        if "bbox" in self.options:
            body["bbox"] = [float(x) for x in self.options["bbox"].split(",")]
        if self.most_cloud < math.inf:
            body["query"] = {"eo:cloud_cover": {"lte": self.most_cloud}}
        return body

    def partitions(self) -> list[Month]:
        found = [Month(a.strftime(INSTANT), b.strftime(INSTANT)) for a, b in months(self.start, self.end)]
        return found or [Month("", "")]

    def read(self, partition: Month) -> Iterator[tuple]:
        if not partition.start:
            return
        seconds, most = float(self.options.get("timeout", 30)), int(self.options.get("most_pages", MOST_PAGES))
        last = datetime.strptime(partition.end, INSTANT)
        for page in pages(lambda body: post(self.options["url"], body, seconds), self.body(partition), most):
            for item in page.get("features") or []:
                row = normal(item)
                # An item within the last second of a month belongs to it alone.
                if row[1] is None or row[1][:19] <= last.strftime(INSTANT)[:19]:
                    yield row


class SceneCatalogue(DataSource):
    @classmethod
    def name(cls) -> str:
        return "scene_catalogue"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> CatalogueReader:
        return CatalogueReader(self.options)


@F.udtf(returnType="ix: bigint, iy: bigint")
class CellsForBox:
    """The cells (floor of a coordinate by the size) that a box covers; a box without width or height lies in one. Null, infinite or turned boxes have none."""

    def eval(self, west: float, south: float, east: float, north: float, size: float) -> Iterator[tuple[int, int]]:
        box = (west, south, east, north)
        if size is None or not size > 0 or any(x is None or not math.isfinite(x) for x in box) or east < west or north < south:
            return
        for ix in range(math.floor(west / size), max(math.ceil(east / size), math.floor(west / size) + 1)):
            for iy in range(math.floor(south / size), max(math.ceil(north / size), math.floor(south / size) + 1)):
                yield ix, iy


def register(spark: SparkSession) -> None:
    """Makes the source and the table function known to a session; pushing filters into Python sources must be on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SceneCatalogue)
    spark.udtf.register("cells_for_bbox", CellsForBox)
