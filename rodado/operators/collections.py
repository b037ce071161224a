"""Operators on catalogued records: parsing, filters, key lookups, upserts, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, rules
from ..functions.text import loose_name, normal_name, slug
from ..session import stage
from .skew import numbered, salted_join


def survey_segments(catastro: DataFrame) -> DataFrame:
    """Surveyed features as normalised segments, one row a feature; empty texts and zeros count as unknown."""
    lines = F.filter(F.col("geometry.coordinates"), lambda ln: ln.isNotNull())
    pts = F.filter(
        F.transform(F.flatten(lines), lambda p: F.struct(F.try_element_at(p, F.lit(1)).alias("lng"), F.try_element_at(p, F.lit(2)).alias("lat"))),
        lambda p: geo.on_earth(p["lng"], p["lat"]),
    )
    each = F.transform(
        lines,
        lambda ln: geo.line_length(F.filter(F.transform(ln, lambda p: F.struct(F.try_element_at(p, F.lit(1)).alias("lng"), F.try_element_at(p, F.lit(2)).alias("lat"))), lambda p: geo.on_earth(p["lng"], p["lat"]))),
    )
    none = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    zero = lambda c: F.nullif(F.col(c), F.lit(0))
    df = catastro.where("feature_id is not null").dropDuplicates(["feature_id"]).withColumn("_p", F.coalesce(pts, F.array().cast("array<struct<lng:double,lat:double>>")))
    start, end = geo.endpoints(F.col("_p"))
    nombre = F.coalesce(none("nombre"), F.concat(F.lit("unnamed-"), F.col("feature_id")))
    return df.select(
        "feature_id", nombre.alias("nombre"), normal_name(nombre).alias("normal_name"), F.lower(F.coalesce(none("comuna"), F.lit("unknown"))).alias("comuna"),
        F.coalesce("km", F.lit(0.0)).alias("km"), F.coalesce(F.aggregate(each, F.lit(0.0), lambda s, v: s + v), F.lit(0.0)).alias("length_m"),
        F.lower(none("tipo")).alias("tipo"), F.lower(none("emplazamiento")).alias("emplazamiento"), zero("ancho_cm").alias("ancho_cm"),
        F.lower(none("clasificacion")).alias("clasificacion"), zero("score").alias("score"), F.coalesce("invalida", F.lit(False)).alias("invalida"), none("video").alias("video"),
        start["lng"].alias("lng0"), start["lat"].alias("lat0"), end["lng"].alias("lng1"), end["lat"].alias("lat1"),
        geo.centroid(F.col("_p"))["lng"].alias("clng"), geo.centroid(F.col("_p"))["lat"].alias("clat"), F.size("_p").alias("points"),
    )


def way_segments(ways: DataFrame) -> DataFrame:
    """OSM ways as normalised segments: widths in cm, sense of riding, placement told from tags or name."""
    t = F.col("tags")
    pts = F.coalesce(F.filter("geometry", lambda p: geo.on_earth(p["lon"], p["lat"])), F.array().cast("array<struct<lon:double,lat:double>>"))
    df = ways.where("way_id is not null").dropDuplicates(["way_id"]).withColumn("_p", pts)
    start, end = geo.endpoints(F.col("_p"))
    name = F.coalesce(rules.tag(t, "name", "name:es"), F.lit(""))
    trail = rules.tag(t, "highway").isin("path", "footway") & ((rules.tag(t, "leisure") == "park") | (rules.tag(t, "landuse") == "recreation_ground") | (rules.tag(t, "route") == "mtb") | rules.tag(t, "sac_scale").isNotNull())
    park = F.coalesce(trail, F.lit(False)) | F.lower(name).rlike("parque|sendero")
    yes = lambda k: F.coalesce(rules.tag(t, k) == "yes", F.lit(False))
    return df.select(
        "way_id", name.alias("nombre"), normal_name(name).alias("normal_name"), geo.line_length(F.col("_p"), "lon", "lat").alias("length_m"),
        rules.tag(t, "cycleway", "highway").alias("tipo"), F.when(park, "parque").alias("emplazamiento"),
        geo.half_up(rules.leading_number(rules.tag(t, "width")) * 100).cast("int").alias("ancho_cm"), rules.tag(t, "surface").alias("surface"), yes("lit").alias("lit"),
        rules.leading_number(rules.tag(t, "maxspeed")).cast("int").alias("maxspeed"), yes("segregated").alias("segregated"), rules.bike_direction(t).alias("bike_direction"),
        rules.comfort(t).alias("comfort"), start["lon"].alias("lng0"), start["lat"].alias("lat0"), end["lon"].alias("lng1"), end["lat"].alias("lat1"),
    )


def cycling_ways(ways: DataFrame, group: str, cls: str = "way_class") -> DataFrame:
    """Keeps ways with cycling infrastructure; plain roads only in groups that have nothing else."""
    known = ways.where(F.col(cls).isNotNull())
    better = known.where(F.col(cls) != "road").select(group).distinct()
    roads = known.where(F.col(cls) == "road")
    alone = salted_join(roads, better.where(F.col(group).isNotNull()), [group], roads.columns, how="left_anti")
    # roads without a group are one group, as nulls are in a grouping
    unknown = better.where(F.col(group).isNull()).select(F.lit(True).alias("_b")).limit(1)
    alone = alone.join(F.broadcast(unknown), F.col(group).isNull(), "left").where("_b is null").drop("_b")
    return known.where(F.col(cls) != "road").unionByName(alone.select(known.columns))


def last_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row a key, the last by ``order`` (which must tell all rows of a key apart)."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("_r")).select(key, "_r.*")


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, order: Column, default) -> DataFrame:
    """Adds ``value`` of the last row of each key in ``table``, or a default."""
    one = last_per_key(table.select(key, value, order.alias("_o")), key, F.col("_o")).drop("_o")
    return df.join(one, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def by_slug(df: DataFrame, name: str, table: DataFrame, other: str) -> DataFrame:
    """Rows of both sides whose names have the same non-empty slug."""
    a = df.withColumn("_slug", slug(F.col(name))).where("_slug <> ''")
    b = table.withColumn("_slug", slug(F.col(other))).where("_slug <> ''")
    return a.join(b, "_slug").withColumnRenamed("_slug", "slug")


def fuzzy_names(a: DataFrame, left: str, b: DataFrame, right: str, least: int = 8, share: float = 0.5) -> DataFrame:
    """Pairs of rows whose loose names are equal, or where one (of ``least`` characters or more) lies within the other and
    is at least ``share`` as long.

    Blocking: a name that lies within a longer one has all its windows of ``least`` characters in it; the window of it that
    the fewest of the longer names have is looked up among all of theirs. So only names with a rare common window meet, not
    all pairs, nor all that begin alike. Names meet once, whatever the rows that have them.
    """
    x = stage(a.withColumn("_x", loose_name(F.col(left))), "names")
    y = stage(b.withColumn("_y", loose_name(F.col(right))), "names")
    equal = x.join(y, F.col("_x") == F.col("_y")).drop("_x", "_y")

    def windows(df: DataFrame, k: str) -> DataFrame:
        n = F.length(k)
        w = F.array_distinct(F.transform(F.sequence(F.lit(1), n - least + 1), lambda i: F.col(k).substr(i, F.lit(least))))
        return stage(df.select(k).where(n >= least).distinct().select(k, F.explode(w).alias("_w")), "windows")

    wins = {"_x": windows(x, "_x"), "_y": windows(y, "_y")}

    def within(inner: DataFrame, i: str, outer: DataFrame, o: str) -> DataFrame:
        # merged, as in first_name_match
        held = wins[i].join(wins[o].groupBy("_w").agg(F.count("*").alias("_n")).hint("merge"), "_w", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
        head = held.groupBy(i).agg(F.min(F.struct("_n", "_w")).alias("_r")).where("_r._n > 0").select(i, "_r._w")
        cond = F.contains(F.col(o), F.col(i)) & (F.length(i) < F.length(o)) & (F.length(i) / F.length(o) >= share)
        pairs = head.join(wins[o].hint("merge"), "_w").where(cond).select(i, o)
        return inner.join(pairs, i).join(outer, o)

    cols = equal.columns
    return equal.unionByName(within(x, "_x", y, "_y").select(cols)).unionByName(within(y, "_y", x, "_x").select(cols))


def cascade(df: DataFrame, key: str, sources: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Adds (source, target): the first source that knows the key; each source is (name, table(key, value), value)."""
    out = df
    hits = []
    for name, table, value in sources:
        one = table.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).cast("string").alias(f"_{name}"))
        out = out.join(one, key, "left")
        hits.append((name, f"_{name}"))
    source = F.coalesce(*(F.when(F.col(c).isNotNull(), n) for n, c in hits))
    return out.withColumn("source", source).withColumn("target", F.coalesce(*(F.col(c) for _, c in hits))).drop(*(c for _, c in hits))


def upsert(old: DataFrame, new: DataFrame, key: str, fresh: list[str]) -> DataFrame:
    """Full outer merge: columns ``fresh`` come from ``new`` where it has the key, the others stay if present."""
    cols = [c for c in old.columns if c != key]
    o = old.select(key, *(F.col(c).alias(f"_o_{c}") for c in cols), F.lit(True).alias("_old"))
    n = new.select(key, *(F.col(c).alias(f"_n_{c}") for c in cols), F.lit(True).alias("_new"))
    j = o.join(n, key, "full")
    pick = lambda c: F.coalesce(f"_n_{c}", f"_o_{c}") if c in fresh else F.coalesce(f"_o_{c}", f"_n_{c}")
    return j.select(key, *(pick(c).alias(c) for c in cols))


def insert_missing(old: DataFrame, new: DataFrame, key: str, first: Column) -> DataFrame:
    """``old`` and the rows of ``new`` with keys it lacks, the first of each key."""
    add = new.join(old.select(key), key, "left_anti")
    add = add.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(first))).where("_n = 1").drop("_n")
    return old.unionByName(add.select(old.columns))


def numbered_slugs(df: DataFrame, name: str, order: Column) -> DataFrame:
    """Adds slug: the second row of a slug gets -2, the third -3, and so on."""
    return numbered(df.withColumn("_s", slug(F.col(name))), "_s", order, "_k").withColumn("slug", F.when(F.col("_k") == 1, F.col("_s")).otherwise(F.concat("_s", F.lit("-"), F.col("_k")))).drop("_s", "_k")


def most_frequent(df: DataFrame, by: str, value: str, order: Column) -> DataFrame:
    """(by, value): the most frequent non-null value; ties go to the one met first."""
    n = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_n"), F.min(order).alias("_o"))
    return n.groupBy(by).agg(F.max_by(value, F.struct("_n", -F.col("_o"))).alias(value))


def corridors(segments: DataFrame, by: str, order: str = "feature_id") -> DataFrame:
    """Roll-up of segments to corridors: totals, gaps over 10 m if segments have gap_m, mean known score, best and worst
    condition, towns, and videos in the order they are first met."""
    label, at = F.col("clasificacion"), F.col(order)
    firsts = segments.where("video is not null").groupBy(by, "video").agg(F.min(at).alias("_at"))
    videos = firsts.groupBy(by).agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "video"))), lambda v: v["video"]).alias("videos"))
    gap = F.when(F.col("gap_m") > 10, F.col("gap_m")) if "gap_m" in segments.columns else F.lit(None).cast("double")
    g = segments.groupBy(by).agg(
        F.count("*").alias("segments"), F.sum("length_m").alias("length_m"), F.avg("score").alias("mean_score"),
        F.coalesce(F.sum(gap), F.lit(0.0)).alias("gap_m"), F.transform(F.sort_array(F.collect_list(F.when(gap.isNotNull(), F.struct(at.alias("at"), gap.alias("m"))))), lambda x: x["m"]).alias("gaps"),
        rules.best_condition(label, at).alias("best"), rules.worst_condition(label, at).alias("worst"),
        F.sort_array(F.collect_set("comuna")).alias("comunas"),
        (F.sum(F.when(F.col("emplazamiento").isin(*rules.GREEN_PLACEMENT), F.col("length_m")).otherwise(0.0)) / F.nullif(F.sum("length_m"), F.lit(0.0))).alias("green_share"),
        F.avg(F.when(F.col("ancho_cm") > 0, F.col("ancho_cm"))).alias("mean_width_cm"),
    )
    return g.join(videos, by, "left").withColumn("videos", F.coalesce("videos", F.array().cast("array<string>")))


def corridor_tags(segments: DataFrame, by: str, routes: DataFrame, order: str) -> DataFrame:
    """(by, tags): descriptive tags by rules over the segments of each route or corridor, and its towns, sorted.

    segments: (by, order, tipo, emplazamiento, surface, lit, ancho_cm, comuna). routes: (by, kind, infra_pct,
    gap_max_m), a row each. Of surfaces that are equally frequent the one met first rules.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    any_ = lambda c: yes(F.max(c))
    surface = most_frequent(segments, by, "surface", F.col(order))
    g = segments.groupBy(by).agg(
        any_(F.col("tipo") == "unidireccional").alias("_one"), any_(F.col("emplazamiento") == "parque").alias("_park"),
        any_(F.col("emplazamiento") == "mediana").alias("_median"), F.coalesce(F.avg(F.when(F.col("ancho_cm") > 0, F.col("ancho_cm"))), F.lit(0.0)).alias("_wide"),
        (F.count_if(F.col("lit")) > F.count("*") * 0.7).alias("_lit"), F.sort_array(F.collect_set(F.nullif("comuna", F.lit("")))).alias("_towns"),
    )
    g = routes.join(g, by, "left").join(surface, by, "left")
    c = F.col
    easy = yes((c("infra_pct") > 80) & (c("gap_max_m") < 300) & (c("_wide") >= 150))
    rules_ = [
        ("bike path", c("_wide").isNotNull()), ("protected lane", c("_one")), ("park path", c("_park")), ("median lane", c("_median")),
        ("gravel", c("surface").isin(*rules.LOOSE_SURFACES)), ("cobblestone", c("surface").isin(*rules.STONE_SURFACES)), ("lit", c("_lit")),
        ("loop", c("kind") == "loop"), ("mountain", c("kind") == "mountain"), ("flat", F.lit(True)), ("easy", easy), ("family friendly", easy),
        ("hard", (c("infra_pct") < 50) | (c("gap_max_m") > 1000)),
    ]
    tags = F.array_compact(F.array(*(F.when(cond, F.lit(t)) for t, cond in rules_)))
    return g.select(by, F.sort_array(F.array_union(tags, F.coalesce("_towns", F.array().cast("array<string>")))).alias("tags"))


def dangling(df: DataFrame, key: str, target: DataFrame, other: str) -> DataFrame:
    """Rows whose non-null reference has no target."""
    return df.where(F.col(key).isNotNull()).join(target.select(F.col(other).alias(key)).distinct(), key, "left_anti")


def hierarchy_edges(parents: DataFrame, parent: str, members: str, children: DataFrame, child: str, member_of: str) -> DataFrame:
    """Distinct (parent, child) told by lists on the parents or by references on the children."""
    down = parents.select(F.col(parent).alias("parent"), F.explode(members).alias("child"))
    up = children.where(F.col(member_of).isNotNull()).select(F.col(member_of).alias("parent"), F.col(child).alias("child"))
    return down.unionByName(up).where("child is not null").distinct()


def majority(df: DataFrame, by: str, yes: Column) -> DataFrame:
    """(by, yes): whether at least half of a group's rows say yes; rows that say neither count as no."""
    return df.groupBy(by).agg((F.count_if(yes) * 2 >= F.count("*")).alias("yes"))


def runs_north(lng0, lat0, lng1, lat1) -> Column:
    """True for lines that run at least as far north or south as east or west."""
    north, east = F.abs(F.col(lat1) - F.col(lat0)), F.abs(F.col(lng1) - F.col(lng0)) * F.cos(F.radians((F.col(lat0) + F.col(lat1)) / 2))
    return F.coalesce(north >= east, F.lit(False))


def corridor_slugs(segments: DataFrame, by: str, key: str) -> DataFrame:
    """(by, slug): the longest segment's name (of equal ones the first by ``key``) and the towns: up to two, or the first and
    'y-mas'. segments: (by, key, nombre, comuna, length_m)."""
    g = segments.groupBy(by).agg(F.max_by("nombre", F.struct("length_m", (-F.col(key)).alias("k"))).alias("_n"), F.array_sort(F.collect_set("comuna")).alias("_t"))
    towns = F.when(F.size("_t") <= 2, F.array_join("_t", "-")).otherwise(F.concat(F.try_element_at("_t", F.lit(1)), F.lit("-y-mas")))
    return g.select(by, slug(F.concat("_n", F.lit("-"), towns)).alias("slug"))


def first_name_match(names: DataFrame, name: str, items: DataFrame, item: str, order: str) -> DataFrame:
    """(name, order): for each name the first item (by ``order``) of the same loose name, else the first one that holds it or
    that it holds.

    Blocking: of two texts where one holds the other, the shorter one's first four letters (all, if it has fewer) are among
    the windows of that length of the longer one; windows shorter than four are made for the lengths alone that names of
    the other side have. Loose names meet, each once, and what they find goes to the names. Empty names match nothing.
    """
    named = names.select(name).distinct().withColumn("_x", loose_name(F.col(name))).where("_x <> ''")
    x = stage(named.select("_x").distinct(), "names")
    y = stage(items.groupBy(loose_name(F.col(item)).alias("_y")).agg(F.min(F.struct(order)).alias("_o")).where("_y <> ''").select("_y", f"_o.{order}"), "names")
    exact = x.join(y, F.col("_x") == F.col("_y")).select("_x", order, F.lit(0).alias("_rank"))
    head = lambda c: F.substring(c, 1, 4)

    def meet(inner: DataFrame, i: str, outer: DataFrame, o: str) -> DataFrame:
        sizes = [r[0] for r in inner.select(F.length(head(i))).distinct().collect()]  # four at most
        of = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(o) - k + 1, F.lit(1))), lambda n: F.col(o).substr(n, F.lit(k)))
        wins = outer.withColumn("_w", F.explode(F.array_distinct(F.flatten(F.array(*(of(k) for k in sorted(sizes) or [4]))))))
        # merged: Spark takes the windows for as small as the names, and would send them out whole
        return inner.withColumn("_w", head(i)).join(wins.hint("merge"), "_w").where(F.contains(o, i)).select("_x", order, F.lit(1).alias("_rank"))

    every = exact.unionAll(meet(x, "_x", y, "_y")).unionAll(meet(y, "_y", x, "_x"))
    best = every.groupBy("_x").agg(F.min(F.struct("_rank", order)).alias("_m"))
    return named.join(best, "_x").select(name, F.col(f"_m.{order}").alias(order))


#: What a line of a page may begin with for the page to hold nothing but videos.
VIDEO_LINES = ("https://youtu.be/", "https://www.youtube.com/")


def only_videos(body: Column) -> Column:
    """True for a body without any line but blank ones and links to videos."""
    link = "|".join(v.replace(".", "\\.") for v in VIDEO_LINES)
    return F.coalesce(F.trim(body), F.lit("")).rlike(rf"^(\s*({link})[^\n]*(\n|$)|[ \t\r]*(\n|$))*$")


def page_upsert(old: DataFrame, new: DataFrame, key: str, day: Column) -> DataFrame:
    """Pages after a new run: of those that are there the distance, the day and the first variant's distance are renewed, and
    the body only if it has nothing but videos; pages that aren't come new.

    old: (key, name, distance_km, variants array<struct<name,gpx,distance_km>>, body, updated_at); new: (key, name,
    distance_km, videos array<string>), a row a key. Old pages without a new run stay as they are.
    """
    c = F.col
    n = new.select(key, c("name").alias("_n"), c("distance_km").alias("_km"), F.array_join(F.array_distinct(F.coalesce("videos", F.array().cast("array<string>"))), "\n").alias("_v"), F.lit(True).alias("_new"))
    o = old.withColumn("_old", F.lit(True))
    j = o.join(n, key, "full")
    variant = lambda name, gpx: F.struct(name.cast("string").alias("name"), gpx.cast("string").alias("gpx"), c("_km").cast("double").alias("distance_km"))
    first = F.try_element_at("variants", F.lit(1))
    renewed = F.when(F.size("variants") > 0, F.concat(F.array(variant(first["name"], first["gpx"])), F.slice("variants", 2, F.greatest(F.size("variants"), F.lit(1))))).otherwise(c("variants"))
    fresh, met = c("_new") & c("_old").isNull(), c("_new") & c("_old")
    return j.select(
        key, F.when(fresh, c("_n")).otherwise(c("name")).alias("name"), F.when(c("_new"), c("_km")).otherwise(c("distance_km")).alias("distance_km"),
        F.when(fresh, F.array(variant(c("_n"), F.lit("main.gpx")))).when(met, renewed).otherwise(c("variants")).alias("variants"),
        F.when(fresh | (met & only_videos(c("body"))), c("_v")).otherwise(c("body")).alias("body"), F.when(c("_new"), day).otherwise(c("updated_at")).alias("updated_at"),
    )


def replaced(old: DataFrame, new: DataFrame, key: str, stays: Column) -> DataFrame:
    """The new rows in place of the old ones, but for old rows that are to stay, which also win over new ones of their key."""
    kept = old.where(F.coalesce(stays, F.lit(False)))
    return kept.unionByName(new.join(kept.select(key).distinct(), key, "left_anti").select(old.columns))


def proposal_summary(segments: DataFrame, axis: str, anchors: DataFrame, routes: DataFrame) -> DataFrame:
    """One row: how many segments, axes, anchors and routes there are, and the kilometres of the segments to one decimal."""
    s = segments.agg(F.count("*").alias("segments"), F.count_distinct(axis).alias("axes"), geo.half_up(F.coalesce(F.sum("length_m"), F.lit(0.0)) / 1000, 1).alias("infra_km"))
    return s.join(anchors.agg(F.count("*").alias("anchors"))).join(routes.agg(F.count("*").alias("routes")))


def curation_stats(routes: DataFrame) -> DataFrame:
    """One row on chosen routes (total_m, infra_pct, comunas): how many are short (under 5 km), medium and long (from 10 km),
    how many towns they touch, and the mean share on segments in whole percents."""
    km = F.col("total_m") / 1000
    towns = F.array_distinct(F.flatten(F.collect_list("comunas")))
    return routes.agg(
        F.count("*").alias("routes"), F.count_if(km < 5).alias("short"), F.count_if((km >= 5) & (km < 10)).alias("medium"), F.count_if(km >= 10).alias("long"),
        F.size(towns).cast("long").alias("comunas"), geo.half_up(F.avg("infra_pct")).cast("long").alias("infra_pct"),
    )


def curated(routes: DataFrame, cells: DataFrame, target: int = 30) -> DataFrame:
    """The launch set, best first by how interesting a route is (scores.interest): one route a base name, eight mountain
    routes, one a pair of anchors but for loops, none that shares over half its ground with a better one, eight a town, five
    an anchor.

    routes: as from suggest.assembled, with route and, if zones are known, zone; cells: (route, gx, gy), their ground.
    """
    from ..functions import scores
    from ..functions.text import base_name, name_quality
    from .greedy import select_diverse
    from .spatial import footprint_overlap

    c = F.col
    zone = c("zone") if "zone" in routes.columns else F.lit(0.0)
    interest = scores.interest(c("start_points"), c("end_points"), c("total_m") / 1000, c("infra_pct"), c("condition"), c("videos"), name_quality(c("start_name"), c("end_name")), c("park"), c("kind") == "loop", F.size("comunas"), zone, c("gap_max_m"))
    pair = F.when(c("kind") != "loop", F.array_join(F.array_sort(F.array("start_name", "end_name")), "|"))
    r = routes.withColumns({
        "interest": interest, "_base": base_name(c("name")), "_mountain": F.when(c("kind") == "mountain", "mountain"), "_pair": pair,
        "_anchors": F.array_distinct(F.array("start_name", "end_name")), "_city": F.lit("all"),
    })
    near = footprint_overlap(cells, "route", 0.5).select("a", "b")
    chosen = select_diverse(r, near, "route", "_city", "interest", {"_base": 1, "_mountain": 8, "_pair": 1, "comunas": 8, "_anchors": 5}, target)
    return r.join(chosen.select("route", "place"), "route").drop("_base", "_mountain", "_pair", "_anchors", "_city")
