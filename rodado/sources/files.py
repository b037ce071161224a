"""Readers of the file formats around cycling content.

Whole small files are read as binary or text by Spark's own sources, so listing, splitting and retries are Spark's;
parsing runs in Arrow batches. A file that can't be parsed gives no row, or a row with ``error`` where that says so.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FRONT = r"(?s)\A﻿?---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n(.*))?\z"


def _yaml(text: str):
    """YAML with dates, times and yes/no kept as text; None if it isn't YAML."""
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    Loader.yaml_implicit_resolvers = {
        k: [(tag, rx) for tag, rx in v if tag not in ("tag:yaml.org,2002:timestamp", "tag:yaml.org,2002:bool")] for k, v in yaml.SafeLoader.yaml_implicit_resolvers.items()
    }
    Loader.add_implicit_resolver("tag:yaml.org,2002:bool", re.compile(r"^(?:true|false|True|False)$"), list("tfTF"))
    # 17:30 is a time of day here, not a number in base sixty
    Loader.yaml_implicit_resolvers = {k: [(t, re.compile(r"^[-+]?(?:0x[0-9a-fA-F]+|\d+)$")) if t.endswith(":int") else (t, rx) for t, rx in v] for k, v in Loader.yaml_implicit_resolvers.items()}
    try:
        return yaml.load(text, Loader=Loader)
    except yaml.YAMLError:
        return None


def text_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, text) of whole files below a folder."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def front_matter(files: DataFrame) -> DataFrame:
    """(path, fields JSON string, body) of Markdown files (path, text); files without front matter have null fields."""
    split = files.select("path", F.regexp_extract("text", _FRONT, 1).alias("_y"), F.when(F.col("text").rlike(_FRONT), F.regexp_extract("text", _FRONT, 2)).otherwise(F.col("text")).alias("body"))

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            out = [_yaml(y) if y else None for y in pdf["_y"]]
            pdf["fields"] = [json.dumps(d, ensure_ascii=False, default=str) if isinstance(d, dict) else None for d in out]
            yield pdf[["path", "fields", "body"]]

    return split.mapInPandas(run, "path string, fields string, body string")


def records(files: DataFrame, schema: str) -> DataFrame:
    """Front matter as typed columns by a DDL schema: (path, ..., body); unknown fields are ignored."""
    f = front_matter(files).where("fields is not null")
    return f.select("path", F.from_json("fields", schema).alias("_r"), "body").select("path", "_r.*", "body")


def yaml_list(files: DataFrame, key: str, schema: str) -> DataFrame:
    """Rows of the list under ``key`` in YAML files (path, text), with a DDL schema."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"]):
                d = _yaml(text)
                items = d.get(key) if isinstance(d, dict) else d if isinstance(d, list) else None
                rows += [(path, i, json.dumps(x, ensure_ascii=False, default=str)) for i, x in enumerate(items or [])]
            yield pd.DataFrame(rows, columns=["path", "ord", "_j"])

    j = files.mapInPandas(run, "path string, ord int, _j string")
    return j.select("path", "ord", F.from_json("_j", schema).alias("_r")).select("path", "ord", "_r.*")


def gpx_points(files: DataFrame, text: str = "text", key: str = "path") -> DataFrame:
    """(key, ord, lng, lat, ele) of the track points in GPX texts, attributes in either order; JVM only.

    Points whose coordinates aren't numbers on earth are left out; ord counts the rest from 0.
    """
    pts = F.regexp_extract_all(F.col(text), F.lit(r"(?s)(<trkpt\b[^>]*(?:/>|>.*?</trkpt>))"), F.lit(1))
    num = lambda c, k: F.regexp_extract(c, rf'\b{k}\s*=\s*["\']\s*([-+0-9.eE]+)', 1).try_cast("double")
    pt = lambda p: F.struct(num(p, "lon").alias("lng"), num(p, "lat").alias("lat"), F.regexp_extract(p, r"<ele>\s*([-+0-9.eE]+)\s*</ele>", 1).try_cast("double").alias("ele"))
    good = F.filter(F.transform(pts, pt), lambda p: p["lat"].between(-90, 90) & p["lng"].between(-180, 180))
    return files.select(F.col(key), F.posexplode(good).alias("ord", "_p")).select(key, "ord", "_p.*")


def geojson_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """(properties..., geometry struct<type,coordinates>) of a FeatureCollection; lines are wrapped to multi-lines.

    properties: DDL of the wanted ones. Other geometry types have null coordinates.
    """
    raw = spark.read.text(path, wholetext=True)
    f = raw.select(F.explode(F.from_json("value", "features array<string>")["features"]).alias("_f"))
    head = F.from_json("_f", f"properties struct<{properties}>, geometry struct<type:string,coordinates:string>")
    f = f.select(head.alias("_r")).select("_r.properties.*", F.col("_r.geometry.type").alias("_t"), F.col("_r.geometry.coordinates").alias("_c"))
    multi = F.from_json("_c", "array<array<array<double>>>")
    line = F.array(F.from_json("_c", "array<array<double>>"))
    coords = F.when(F.col("_t") == "MultiLineString", multi).when(F.col("_t") == "LineString", line)
    return f.withColumn("geometry", F.struct(F.col("_t").alias("type"), coords.alias("coordinates"))).drop("_t", "_c")


def point_list(spark: SparkSession, path: str) -> DataFrame:
    """(ord, lng, lat) of a JSON array of [lng, lat] pairs."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.posexplode(F.from_json("value", "array<array<double>>")).alias("ord", "_p")).select("ord", F.col("_p")[0].alias("lng"), F.col("_p")[1].alias("lat"))


def decode_polyline(text: str | None) -> list[tuple[float, float]]:
    """(lng, lat) points of an encoded polyline: zigzag deltas of 1e-5 degrees in chunks of five bits, latitude first."""
    out, at, k = [], [0, 0], 0
    value = shift = 0
    for ch in text or "":
        b = ord(ch) - 63
        value |= (b & 31) << shift
        shift += 5
        if b < 32:
            at[k] += ~(value >> 1) if value & 1 else value >> 1
            value = shift = 0
            if k:
                out.append((at[1] / 1e5, at[0] / 1e5))
            k ^= 1
    return out


def encode_polyline(points: list[tuple[float, float]]) -> str:
    """The inverse of :func:`decode_polyline`, for points of five decimals."""
    out, last = [], [0, 0]
    for lng, lat in points:
        for k, v in enumerate((lat, lng)):
            n = round(v * 1e5)
            d, last[k] = n - last[k], n
            d = ~(d << 1) if d < 0 else d << 1
            while d >= 32:
                out.append(chr((32 | d & 31) + 63))
                d >>= 5
            out.append(chr(d + 63))
    return "".join(out)


def polylines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ord, lng, lat) of encoded polylines."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            rows = [(k, i, *p) for k, t in zip(pdf["_k"], pdf["_t"]) for i, p in enumerate(decode_polyline(t))]
            yield pd.DataFrame(rows, columns=[key, "ord", "lng", "lat"])

    return df.select(F.col(key).alias("_k"), F.col(text).alias("_t")).mapInPandas(run, f"`{key}` {kind}, ord int, lng double, lat double")


def nested_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents with a given schema; nothing is inferred."""
    return spark.read.schema(schema).json(path, multiLine=True)


def settings(files: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """One row of the named settings in YAML files (path, text), each with its default."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            ds = [_yaml(t) or {} for t in pdf["text"]]
            yield pd.DataFrame({"path": pdf["path"], **{k: [None if d.get(k) is None else str(d[k]) for d in ds] for k in defaults}})

    s = files.mapInPandas(run, "path string, " + ", ".join(f"`{k}` string" for k in defaults))
    return s.select("path", *(F.coalesce(k, F.lit(v)).alias(k) for k, v in defaults.items()))


def in_box(ways: DataFrame, box: tuple[float, float, float, float], pad: float = 0.0, name: Column | None = None, **tags: str) -> DataFrame:
    """OSM ways with a vertex in the box (min lng, min lat, max lng, max lat), with all given tags, optionally by name."""
    a, b, c, d = box
    hit = F.exists("geometry", lambda p: p["lon"].between(a - pad, c + pad) & p["lat"].between(b - pad, d + pad))
    for k, v in tags.items():
        hit = hit & (F.try_element_at("tags", F.lit(k.replace("__", ":"))) == v)
    return ways.where(hit if name is None else hit & name)
