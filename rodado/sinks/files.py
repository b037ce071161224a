"""Writers of tracks, records, reports and drawings, as columns first, so that files are written by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import half_up
from ..functions.text import decimal_comma, spoken_list, xml_text, yaml_text


def gpx_text(points: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """(key, gpx) of points (key, ord, lng, lat and, if there, part, sub, ele, name): a track segment for each part.

    Coordinates have seven decimals. A key's points are one document, so they meet in one row.
    """
    cols = set(points.columns)
    part = F.col("part") if "part" in cols else F.lit(1)
    order = F.struct(F.col("ord"), *([F.col("sub")] if "sub" in cols else []))
    ele = F.when(F.col("ele").isNotNull(), F.format_string("<ele>%.1f</ele>", F.col("ele"))).otherwise("") if "ele" in cols else F.lit("")
    pt = F.concat(F.format_string('<trkpt lat="%.7f" lon="%.7f">', F.col("lat"), F.col("lng")), ele, F.lit("</trkpt>"))
    seg = points.select(key, part.alias("_part"), order.alias("_o"), pt.alias("_t"), (F.col(name) if name else F.lit("track")).cast("string").alias("_name"))
    seg = seg.groupBy(key, "_part").agg(F.sort_array(F.collect_list(F.struct("_o", "_t"))).alias("_p"), F.min("_name").alias("_name"))
    seg = seg.withColumn("_s", F.concat(F.lit("<trkseg>"), F.array_join(F.transform("_p", lambda p: p["_t"]), ""), F.lit("</trkseg>")))
    g = seg.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_part", "_s"))).alias("_p"), F.min("_name").alias("_name"))
    head = '<?xml version="1.0" encoding="UTF-8"?><gpx version="1.1" creator="rodado" xmlns="http://www.topografix.com/GPX/1/1"><trk><name>'
    return g.select(key, F.concat(F.lit(head), xml_text(F.col("_name")), F.lit("</name>"), F.array_join(F.transform("_p", lambda p: p["_s"]), ""), F.lit("</trk></gpx>")).alias("gpx"))


def write_texts(df: DataFrame, path: str, text: str, partition: str | None = None) -> None:
    """Texts as files, a folder for each value of ``partition``; a second write replaces the first."""
    w = df.select(*([partition] if partition else []), text).write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).text(path)


def markdown(rows: DataFrame, title: Column, fields: dict[str, Column], body: list[Column]) -> Column:
    """A Markdown document with front matter: null fields are left out, null paragraphs too."""
    head = F.array_compact(F.array(*(F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in {"name": yaml_text(title), **fields}.items())))
    text = F.array_join(F.array_compact(F.array(*body)), "\n\n")
    return F.concat(F.lit("---\n"), F.array_join(head, "\n"), F.lit("\n---\n\n"), text, F.lit("\n"))


def route_page(r: DataFrame) -> DataFrame:
    """(route_id, page) of routes (route_id, name, distance_km, tags, tagline): a page with a summary sentence."""
    km = F.when(F.col("distance_km").isNotNull(), F.concat(F.lit("Recorrido de "), decimal_comma(F.col("distance_km")), F.lit(" km.")))
    tags = F.array_distinct(F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: t.isNotNull() & (F.trim(t) != "")))
    kinds = F.when(F.size(tags) > 0, F.concat(F.lit("Etiquetas: "), spoken_list(tags), F.lit(".")))
    return r.select("route_id", markdown(r, F.coalesce("name", F.lit("")), {"distance_km": F.col("distance_km"), "tagline": F.when(F.col("tagline").isNotNull(), yaml_text(F.col("tagline")))}, [km, kinds]).alias("page"))


def nested(rows: DataFrame) -> DataFrame:
    """(document): each row as one JSON text."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("document"))


def report_lines(cards: DataFrame) -> DataFrame:
    """(line): one text line for each score card."""
    return cards.select(F.format_string("%6.1f  %s  %s  %s", "composite", F.col("track").cast("string"), "shape", F.array_join("issues", "; ")).alias("line"))


def draw(points: DataFrame, width: int = 60, height: int = 24) -> DataFrame:
    """(row, line) of a raster of two tracks (track, ord, lng, lat): 'a' and 'b' trails, '*' where they share a cell.

    Tracks are numbered in the order of their keys; further tracks share 'b'. Row 0 is the north.
    """
    ext = points.agg(F.min("lng").alias("_x0"), F.max("lng").alias("_x1"), F.min("lat").alias("_y0"), F.max("lat").alias("_y1"), F.min("track").alias("_first"))
    p = points.join(F.broadcast(ext))
    col = lambda v, a, b, n: F.least(F.floor((F.col(v) - F.col(a)) / F.greatest(F.col(b) - F.col(a), F.lit(1e-12)) * n), F.lit(n - 1)).cast("int")
    p = p.select(col("lng", "_x0", "_x1", width).alias("c"), (height - 1 - col("lat", "_y0", "_y1", height)).alias("row"), F.when(F.col("track") == F.col("_first"), "a").otherwise("b").alias("m"))
    cells = p.groupBy("row", "c").agg(F.when(F.count_distinct("m") > 1, "*").otherwise(F.min("m")).alias("m"))
    lines = cells.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("c", "m"))).alias("_m"))
    all_rows = points.sparkSession.range(height).select(F.col("id").cast("int").alias("row"))
    blank = F.lit(" ")
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), blank)), "")
    return all_rows.join(lines, "row", "left").select("row", F.when(F.col("_m").isNull(), "").otherwise(F.rtrim(text)).alias("line"))


def sample_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """About n rows, evenly along the order (which must tell the rows apart): a sampling operator for fixtures. The rows are
    numbered over ranges of the order, not in one task."""
    from ..operators.skew import numbered

    step = max(1, df.count() // n)
    rows = numbered(df.withColumn("_one", F.lit(0)), "_one", F.struct(*order), "_i")
    return rows.where((F.col("_i") - 1) % step == 0).drop("_one", "_i")


def rounded(c: Column, digits: int = 1) -> Column:
    """Numbers as reports show them."""
    return half_up(c, digits)


def condition_text(c: Column) -> Column:
    """A condition as pages show it: lower case, nothing for unknown ones."""
    t = F.lower(F.trim(c))
    return F.when(~t.isin("", "nan"), t)


def full_page(routes: DataFrame, day: Column) -> DataFrame:
    """(route, page): front matter and prose of whole routes. The phrases are fixed values.

    routes: (route, name, kind, total_m, infra_pct, start_name, end_name, tags, runs array<struct<name,comunas,length_m,
    tipos,places,widths,conditions>> in riding order, gaps array<struct<from,to,metres>>, videos array). ``day`` is the date
    of the pages. Gaps up to 50 m aren't told; conditions are told as a range from the last to the first that differ.
    """
    c, lit = F.col, F.lit
    none = F.array().cast("array<string>")
    title = lambda x: F.initcap(F.lower(x))
    km = decimal_comma(c("total_m") / 1000)
    said = lambda x: F.array_distinct(F.filter(F.coalesce(x, none), lambda v: v.isNotNull() & (v != "")))
    towns = spoken_list(F.transform(said(F.flatten(F.transform("runs", lambda r: F.coalesce(r["comunas"], none)))), title))
    known = c("start_name").isNotNull() & c("end_name").isNotNull() & (c("start_name") != c("end_name"))
    opening = F.when(c("kind") == "loop", F.concat(lit("Un circuito de "), km, lit(" kilómetros por "), towns, F.when(c("start_name").isNotNull(), F.concat(lit(", saliendo desde "), c("start_name"))).otherwise(""), lit(".")))
    opening = opening.otherwise(F.concat(km, lit(" kilómetros por "), towns, F.when(known, F.concat(lit(", desde "), c("start_name"), lit(" hasta "), c("end_name"))).otherwise(""), lit(".")))
    pct = F.floor(c("infra_pct") + 0.5).cast("long").cast("string")
    cover = F.when(c("infra_pct") >= 90, " Prácticamente todo el recorrido tiene ciclovía.").when(c("infra_pct") >= 70, F.concat(lit(" El "), pct, lit("% del recorrido tiene ciclovía."))).when(c("infra_pct") >= 50, " Alrededor de la mitad del recorrido tiene ciclovía.").otherwise("")

    def run_line(r: Column) -> Column:
        own, tipos, places = F.transform(said(r["comunas"]), title), said(r["tipos"]), said(r["places"])
        wide = F.filter(F.coalesce(r["widths"], F.array().cast("array<int>")), lambda w: w > 0)
        span = F.when(F.array_min(wide) == F.array_max(wide), F.array_min(wide).cast("string")).otherwise(F.concat(F.array_min(wide).cast("string"), lit("–"), F.array_max(wide).cast("string")))
        states = F.array_distinct(F.filter(F.transform(F.coalesce(r["conditions"], none), condition_text), lambda v: v.isNotNull()))
        state = F.when(F.size(states) == 1, F.concat(lit('\nEvaluación: "'), states[0], lit('".'))).when(F.size(states) > 1, F.concat(lit('\nEvaluación: de "'), F.element_at(states, -1), lit('" a "'), states[0], lit('".'))).otherwise("")
        return F.concat(
            lit("**"), title(F.coalesce(F.nullif(r["name"], lit("")), lit("Sin nombre"))), lit("**"), F.when(F.size(own) > 0, F.concat(lit(" ("), spoken_list(own), lit(")"))).otherwise(""), lit(" — "), decimal_comma(r["length_m"] / 1000), lit(" km"),
            F.when(F.size(tipos) > 0, F.concat(lit(", "), F.array_join(tipos, "/"))).otherwise(""), F.when(F.size(places) > 0, F.concat(lit(", en "), spoken_list(places))).otherwise(""),
            F.when(F.size(wide) > 0, F.concat(lit(", "), span, lit(" cm de ancho"))).otherwise(""), lit("."), state,
        )

    def gap_line(g: Column) -> Column:
        far = F.when(g["metres"] >= 1000, F.concat(decimal_comma(g["metres"] / 1000), lit(" km"))).otherwise(F.concat(F.floor(g["metres"] + 0.5).cast("long").cast("string"), lit(" m")))
        name = lambda x, other: title(F.coalesce(F.nullif(x, lit("")), lit(other)))
        return F.concat(lit("Entre **"), name(g["from"], "tramo anterior"), lit("** y **"), name(g["to"], "siguiente tramo"), lit("** — "), far, lit(" sin infraestructura ciclista."))

    part = lambda head, lines_: F.when(F.size(lines_) > 0, F.concat(lit(head + "\n\n"), F.array_join(lines_, "\n\n")))
    gaps = F.filter(F.coalesce("gaps", F.array().cast(routes.schema["gaps"].dataType)), lambda g: g["metres"] > 50)
    videos = said(F.transform(F.coalesce("videos", none), lambda v: F.trim(v)))
    shown = F.when(F.size(videos) > 0, F.concat(lit("Videos a nivel de calle de cada tramo:\n\n"), F.array_join(videos, "\n")))
    body = [F.concat(opening, cover), part("### Tramos", F.transform("runs", run_line)), part("### Tramos sin infraestructura", F.transform(gaps, gap_line)), shown]
    plain_km, date = F.format_string("%.1f", c("total_m") / 1000), F.concat(lit('"'), day.cast("string"), lit('"'))
    fields = {
        "status": lit("published"), "distance_km": plain_km, "tags": F.concat(lit("\n"), F.array_join(F.transform(said(c("tags")), lambda t: F.concat(lit("  - "), t)), "\n")),
        "created_at": date, "updated_at": date, "variants": F.concat(lit("\n  - name: "), yaml_text(c("name")), lit("\n    gpx: main.gpx\n    distance_km: "), plain_km),
    }
    return routes.select("route", F.regexp_replace(markdown(routes, c("name"), fields, body), r"(?m)^(tags|variants): $", "$1:").alias("page"))
