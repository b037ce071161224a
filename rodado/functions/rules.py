"""Classifications of ways, stretches and places as ordered rules in native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values throughout: tag values, points and their order are given, not derived.
TRAIL_WORDS = ("cerro", "sendero", "mtb", "trail", "mahuida", "manquehue")
LOOSE_SURFACES, STONE_SURFACES = ("gravel", "unpaved", "dirt"), ("cobblestone", "sett")
SURVEYED_COMFORT = {"parque": 5, "bandejón": 5, "mediana": 4, "acera": 3, "calzada": 0}
GREEN_PLACEMENT = ("parque", "mediana", "bandejón")
PLAIN_ROADS = ("primary", "secondary", "tertiary", "residential", "living_street")
REGISTRY_ROADS = ("tertiary", "secondary", "primary", "residential", "unclassified")
CAR_ROADS = ("primary", "secondary", "trunk", "motorway")
CONDITIONS = ("buena", "regular", "mala", "muy mala")
UTILITY_PLACES = ("wc", "parking", "utility", "detour", "flooding", "toilets", "bicycle_parking", "waste_basket")
ANCHOR_POINTS = {
    "beach": 9, "park": 9, "garden": 8, "water": 8, "bridge": 7, "viewpoint": 8, "camp_site": 7, "square": 7, "marketplace": 7, "station": 6,
    "metro": 5, "museum": 6, "ferry_terminal": 6, "bicycle_rental": 4, "bicycle": 4, "ice_cream": 3, "pub": 3, "cafe": 2, "curated": 10,
}
ROAD_WEIGHTS = {
    "cycleway": 1.0, "path": 1.1, "living_street": 1.2, "footway": 1.3, "pedestrian": 1.3, "residential": 1.5, "service": 1.5, "tertiary": 1.8, "secondary": 2.5,
}
KIND_BY_WORD = (("parque", "park"), ("plaza|plazoleta", "park"), ("mercado", "restaurant"), ("museo", "something-interesting"), ("río|lago", "chill-spot"), ("cerro|mirador", "lookout"))
KIND_BY_TYPE = {
    "park": "park", "parque": "park", "garden": "park", "square": "park", "beach": "beach", "viewpoint": "lookout", "museum": "something-interesting",
    "bridge": "bridge", "water": "chill-spot", "marketplace": "restaurant", "cafe": "cafe", "ice_cream": "ice-cream", "pub": "beer", "station": "meeting-point",
    "bicycle_rental": "bike-rental", "bicycle": "bike-shop", "camp_site": "camping-spot", "ferry_terminal": "ferry", "curated": "park",
}


def tag(tags: Column, *names: str) -> Column:
    """First non-empty value of the tags of these names."""
    return F.coalesce(*(F.nullif(F.try_element_at(tags, F.lit(n)), F.lit("")) for n in names))


def lane_tag(tags: Column) -> Column:
    return tag(tags, "cycleway", "cycleway:left", "cycleway:right", "cycleway:both")


def _map(table: dict, key: Column) -> Column:
    out = F.lit(None)
    for k, v in reversed(table.items()):
        out = F.when(key == k, v).otherwise(out)
    return out


def comfort(tags: Column, placement: Column | None = None) -> Column:
    """0 (traffic) to 5 (free of it); a surveyed placement overrules the tags."""
    hw, cw, bike = tag(tags, "highway"), lane_tag(tags), tag(tags, "bicycle")
    by_tags = (
        F.when(hw == "cycleway", 5).when(cw.isin("track", "separate"), 5)
        .when((hw == "path") & bike.isin("designated", "yes"), 4)
        .when((hw == "footway") & (bike == "yes"), 3).when(hw == "path", 3)
        .when(hw.isin("residential", "living_street") & cw.isNotNull(), 2)
        .when(cw.isin("lane", "shared_lane"), 1).otherwise(0)
    )
    return by_tags if placement is None else F.coalesce(_map(SURVEYED_COMFORT, placement), by_tags)


def way_class(tags: Column) -> Column:
    """'cycleway', 'lane', 'road', or null for ways that aren't for cycling."""
    hw, bike = tag(tags, "highway"), tag(tags, "bicycle")
    allowed = bike.isin("designated", "yes")
    return (
        F.when(hw == "cycleway", "cycleway").when(hw.isin("path", "footway") & allowed, "cycleway")
        .when((tag(tags, "leisure") == "park") | hw.isin("path", "pedestrian"), "cycleway")
        .when(lane_tag(tags).isNotNull(), "lane").when(hw.isin(*PLAIN_ROADS), "road").when(allowed, "cycleway")
    )


def ground_class(tags: Column) -> Column:
    """'bike', 'car', 'green' or null, in this order."""
    return (
        F.when((tag(tags, "highway") == "cycleway") | tag(tags, "cycleway").isNotNull() | (tag(tags, "bicycle") == "designated"), "bike")
        .when(tag(tags, "highway").isin(*CAR_ROADS), "car")
        .when(tag(tags, "leisure").isNotNull() | (tag(tags, "natural") == "water") | tag(tags, "waterway").isNotNull(), "green")
    )


def bike_direction(tags: Column) -> Column:
    """'both', 'forward' or 'reverse' against the order of the vertices."""
    ob, o = tag(tags, "oneway:bicycle"), tag(tags, "oneway")
    fwd = F.coalesce(ob == "yes", F.lit(False)) | (F.coalesce(o == "yes", F.lit(False)) & ~F.coalesce(ob == "no", F.lit(False)))
    return F.when(fwd, "forward").when(ob == "-1", "reverse").otherwise("both")


def leading_number(c: Column) -> Column:
    """The number a text begins with, as double; null if there is none."""
    return F.regexp_extract(c, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+))", 1).try_cast("double")


def place_kind(name: Column, kind: Column) -> Column:
    """By a word of the name, else by type, else 'park'."""
    out = F.coalesce(_map(KIND_BY_TYPE, kind), F.lit("park"))
    for words, k in reversed(KIND_BY_WORD):
        out = F.when(F.lower(name).rlike(words), k).otherwise(out)
    return out


def anchor_points(kind: Column) -> Column:
    return F.coalesce(_map(ANCHOR_POINTS, kind), F.lit(1))


def road_weight(highway: Column) -> Column:
    """Cost of a metre; a missing class counts as residential."""
    return F.coalesce(_map(ROAD_WEIGHTS, F.coalesce(F.nullif(highway, F.lit("")), F.lit("residential"))), F.lit(2.0))


def best_condition(label: Column, order: Column) -> Column:
    """Aggregate: the best known label; without a known one the last label by ``order``."""
    rank = condition_rank(F.lower(label))
    best = F.min_by(label, F.when(rank.isNotNull(), F.struct(rank.alias("r"), order.alias("o"))))
    return F.coalesce(best, F.max_by(label, F.when(label.isNotNull(), order)))


def worst_condition(label: Column, order: Column) -> Column:
    """Aggregate: the first unknown label by ``order`` if there is one, else the worst."""
    rank = condition_rank(F.lower(label))
    unknown = F.min_by(label, F.when(label.isNotNull() & rank.isNull(), order))
    return F.coalesce(unknown, F.min_by(label, F.when(rank.isNotNull(), F.struct((-rank).alias("r"), order.alias("o")))))


def condition_rank(c: Column) -> Column:
    """0 (best) to 3; null for other labels."""
    return _map({k: i for i, k in enumerate(CONDITIONS)}, c)
