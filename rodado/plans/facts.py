"""A small declarative query dialect over collections, compiled to DataFrame operations.

A fact is a mapping: ``template`` with {names}, or ``text``; ``query`` with ``type``, ``filter``, ``sort``, ``order``
or ``direction``, ``pick``, ``fields`` and ``count_as``. It compiles to a frame of at most one row; a fact of no row
or of count zero is left out. Unknown types raise ValueError.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fill_template
from ..operators import nearby


@dataclass
class Query:
    type: str
    filter: dict = field(default_factory=dict)
    sort: str | None = None
    order: str = "asc"
    pick: str = "first"
    fields: tuple[str, ...] = ()
    count_as: str = "count"

    @classmethod
    def of(cls, spec: dict) -> Query:
        order = spec.get("order") or spec.get("direction") or "asc"
        if order not in ("asc", "desc"):
            raise ValueError(f"unknown order {order!r}")
        return cls(spec["type"], dict(spec.get("filter") or {}), spec.get("sort"), order, spec.get("pick") or "first", tuple(spec.get("fields") or ()), spec.get("count_as") or "count")


#: Metres within which a route passes a place.
REACH_M = 500.0


def _where(df: DataFrame, wanted: dict, today) -> DataFrame:
    for k, v in wanted.items():
        if k == "year":
            df = df.where(F.year("start_date") == (F.year(today) if v == "current" else F.lit(int(v))))
        else:
            df = df.where(F.col(k).cast("string") == str(v))
    return df


def compile_query(spec: dict, tables: dict[str, DataFrame], today=None, reach_m: float = REACH_M) -> DataFrame:
    """The frame of a query. tables: places (name, category, lng, lat), routes (slug, name, distance_km), organizers,
    events (start_date), tracks (track = a route's slug, lng, lat), as the types need them. today: a date column."""
    q = Query.of(spec)
    today = F.current_date() if today is None else today
    if q.type in ("places", "organizers", "events"):
        return _where(tables[q.type], q.filter, today).agg(F.count("*").alias(q.count_as)).where(F.col(q.count_as) > 0)
    if q.type == "routes":
        df = _where(tables["routes"], q.filter, today)
        if not q.sort:
            return df.agg(F.count("*").alias(q.count_as)).where(F.col(q.count_as) > 0)
        key = F.col(q.sort)
        first = key.desc() if q.order == "desc" else key.asc()
        cols = q.fields or tuple(df.columns)
        out = df.where(key.isNotNull()).orderBy(first, *(F.col(c) for c in ("slug", "name") if c in df.columns))
        return (out.limit(1) if q.pick == "first" else out).select(*cols)
    if q.type in ("routes_near_places", "route_place_density"):
        hits = passes(tables["tracks"], _where(tables["places"], q.filter, today), reach_m)
        if q.type == "routes_near_places":
            return hits.agg(F.count_distinct("track").alias(q.count_as)).where(F.col(q.count_as) > 0)
        n = hits.groupBy("track").agg(F.count("*").alias(q.count_as))
        return n.orderBy(F.col(q.count_as).desc(), "track").limit(1)
    if q.type == "aggregate":
        return tables["routes"].agg(F.round(F.sum("distance_km"), 1).alias("total_km")).where("total_km is not null")
    raise ValueError(f"unknown query type {q.type!r}")


def passes(tracks: DataFrame, places: DataFrame, reach_m: float = REACH_M) -> DataFrame:
    """Distinct (track, place_id): tracks with a point within reach of a place."""
    p = places.select("place_id", F.col("lng").alias("_x"), F.col("lat").alias("_y"))
    return nearby.within(tracks.select("track", "lng", "lat"), p, reach_m, ["track"], centre_xy=("_x", "_y")).select("track", "place_id").distinct()


def fact(spec: dict, tables: dict[str, DataFrame], today=None) -> DataFrame:
    """(text) of a fact: no row if its query finds nothing."""
    if "text" in spec:
        any_table = next(iter(tables.values()))
        return any_table.sparkSession.range(1).select(F.lit(spec["text"]).alias("text"))
    df = compile_query(spec["query"], tables, today)
    return df.select(fill_template(spec["template"], {c: F.col(c) for c in df.columns}).alias("text"))
