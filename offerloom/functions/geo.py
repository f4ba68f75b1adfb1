"""Region lookup from a free-text location, as one expression (no join, no shuffle)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.functions.text import fold_place

MAX_REFERENCE_ENTRIES = 100_000


@dataclass(frozen=True)
class Region:
    name: str
    lat: float
    lon: float
    cities: Sequence[str] = field(default_factory=tuple)


def _region_struct(region: Region) -> Column:
    return F.struct(F.lit(region.name).alias("region"), F.lit(float(region.lat)).alias("lat"),
                    F.lit(float(region.lon)).alias("lon"))


def _places(entries: Sequence[tuple[str, Region]]) -> Column:
    return F.array(*[F.struct(fold_place(F.lit(name)).alias("place"), _region_struct(r).alias("hit"))
                     for name, r in entries])


def geo_region(location: Column, regions: Sequence[Region], departments: Mapping[str, str]) -> Column:
    """struct<region, lat, lon> by département code, else city, else region name.

    The reference rows are a driver-side parameter whose size is checked; they
    become one constant-folded literal that ships with the task.
    """
    entries = sum(len(r.cities) + 1 for r in regions) + len(departments)
    if entries > MAX_REFERENCE_ENTRIES:
        raise ValueError(f"region reference has {entries} entries; join it as a table instead")
    by_name = {r.name: r for r in regions}
    known = {d: r for d, r in departments.items() if r in by_name}
    by_code = F.lit(None)
    if known:
        table = F.create_map(*[c for d, r in known.items() for c in (F.lit(d), _region_struct(by_name[r]))])
        by_code = F.try_element_at(table, F.regexp_extract(location, r"(?U)\b(\d{2,3}|2[AB])\b", 1))
    cities = _places([(city, r) for r in regions for city in r.cities])
    names = _places([(r.name, r) for r in regions])

    def by_place(folded: Column) -> Column:
        in_city = F.filter(cities, lambda x: F.contains(folded, x.place) | F.contains(x.place, folded))
        in_name = F.filter(names, lambda x: F.contains(folded, x.place))
        return F.when(folded != "", F.coalesce(F.get(in_city, F.lit(0)).hit, F.get(in_name, F.lit(0)).hit))

    # The one-element array binds the folded location, so that it is computed once per row.
    place_hit = F.get(F.transform(F.array(fold_place(location)), by_place), F.lit(0))
    return F.coalesce(by_code, place_hit)
