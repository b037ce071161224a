"""Corridors: segments that continue one another, as components, and merged with their likely continuations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .graph import _metres, components
from .lines import Line, order_lines, turn_between
from .nearby import within
from .spatial import line_links

#: Limits of a continuation.
CONTINUES_M, SMALL_M, SMALL_GAP_M, SMALL_TURN, LONG_GAP_M, LONG_TURN = 200.0, 1000.0, 300.0, 30.0, 400.0, 25.0


def continuations(segments: DataFrame, gap_m: float = CONTINUES_M) -> DataFrame:
    """(a, b), a < b, of segments (seg_id, normal_name, length_m, lng0, lat0, lng1, lat1) of one name where one ends
    within ``gap_m`` of the other's start, and that don't run side by side.

    Two that only start or only end together don't continue each other. Side by side are two over ``gap_m`` long with
    both pairs of ends nearer than that, in either sense.
    """
    s = segments.where("normal_name <> ''")
    tips = s.select(F.col("seg_id").alias("_s"), "normal_name", F.col("lng1").alias("lng"), F.col("lat1").alias("lat"))
    heads = s.select(F.col("seg_id").alias("_t"), "normal_name", F.col("lng0").alias("_x"), F.col("lat0").alias("_y"))
    links = within(tips, heads, gap_m, ["_s"], centre_xy=("_x", "_y"), equal=("normal_name",)).where("_s <> _t")
    links = links.select(F.least("_s", "_t").alias("a"), F.greatest("_s", "_t").alias("b")).distinct()
    side = lambda k: s.select(F.col("seg_id").alias(k), *(F.col(c).alias(f"{c}{k}") for c in ("length_m", "lng0", "lat0", "lng1", "lat1")))
    j = links.join(side("a"), "a").join(side("b"), "b")
    near = lambda p, q: geo.haversine(f"lng{p}a", f"lat{p}a", f"lng{q}b", f"lat{q}b") < gap_m
    beside = ((near(0, 0) & near(1, 1)) | (near(0, 1) & near(1, 0))) & (F.col("length_ma") > gap_m) & (F.col("length_mb") > gap_m)
    return j.where(~beside).select("a", "b")


def axes_of(segments: DataFrame, gap_m: float = CONTINUES_M) -> DataFrame:
    """(seg_id, axis): the smallest segment of each corridor; segments without a name are corridors of their own."""
    return components(segments, continuations(segments, gap_m), "seg_id").withColumnRenamed("component", "axis")


def merge_axes(axes: list[dict]) -> list[list[int]]:
    """Groups of axis ids. axes: {id, name, start, end, length_m, names}; start and end are (lng, lat).

    A small axis joins a neighbour whose end is near and whose heading goes on; longer ones need a narrower turn.
    Merging starts again after each merge, the largest first, until nothing changes.
    """
    live = [dict(a, ids=[a["id"]]) for a in sorted(axes, key=lambda a: (-a["length_m"], a["id"]))]

    def joint(a, b):
        ends = [(_metres(*p, *q), p, q) for p in (a["start"], a["end"]) for q in (b["start"], b["end"])]
        gap, p, q = min(ends)
        far_a, far_b = (a["end"] if p == a["start"] else a["start"]), (b["end"] if q == b["start"] else b["start"])
        into, out = Line(0, [far_a, p]), Line(0, [q, far_b])
        return gap, turn_between(into.heading, out.heading) if far_a != p and far_b != q else 180.0, far_a, far_b

    changed = True
    while changed:
        changed = False
        for i, a in enumerate(live):
            for j in range(len(live) - 1, i, -1):
                b = live[j]
                gap, turn, fa, fb = joint(a, b)
                small = min(a["length_m"], b["length_m"]) <= SMALL_M and gap <= SMALL_GAP_M and turn <= SMALL_TURN and len(a["names"] | b["names"]) <= 10
                same = a["name"] == b["name"] and a["name"] != ""
                if small and (not a["name"] or not b["name"] or same) or same and gap <= LONG_GAP_M and turn <= LONG_TURN:
                    live[i] = dict(a, start=fa, end=fb, length_m=a["length_m"] + b["length_m"], names=a["names"] | b["names"], ids=a["ids"] + b["ids"], name=a["name"] or b["name"])
                    del live[j]
                    changed = True
                    break
            if changed:
                live.sort(key=lambda a: (-a["length_m"], a["id"]))
                break
    return [sorted(a["ids"]) for a in live]


def merged_axes(axes: DataFrame, region: str) -> DataFrame:
    """(region, axis, corridor) by :func:`merge_axes` in each region; axes has (axis, name, lng0, lat0, lng1, lat1, length_m)."""
    kind = axes.schema[region].dataType.simpleString()

    def run(pdf):
        import pandas as pd

        rows = [dict(id=int(r["axis"]), name=r["name"] or "", start=(r["lng0"], r["lat0"]), end=(r["lng1"], r["lat1"]), length_m=r["length_m"], names={r["name"]}) for r in pdf.to_dict("records")]
        out = [(pdf[region].iloc[0], i, g[0]) for g in merge_axes(rows) for i in g]
        return pd.DataFrame(out, columns=[region, "axis", "corridor"])

    return axes.groupBy(region).applyInPandas(run, f"`{region}` {kind}, axis bigint, corridor bigint")


def mergeable(axes: DataFrame) -> DataFrame:
    """(axis, group): axes that :func:`merge_axes` may bring together. A merged axis has the ends of its parts, is no
    shorter and has no name that they lack, so the groups can be merged one by one."""
    side = lambda k: axes.select(F.col("axis").alias(k), F.col("name").alias(f"_n{k}"), F.col("length_m").alias(f"_l{k}"))
    j = line_links(axes, "axis", LONG_GAP_M).join(side("a"), "a").join(side("b"), "b")
    same = (F.col("_na") == F.col("_nb")) & (F.col("_na") != "")
    small = (F.least("_la", "_lb") <= SMALL_M) & (F.col("gap_m") <= SMALL_GAP_M) & ((F.col("_na") == "") | (F.col("_nb") == "") | same)
    return components(axes, j.where(same | small), "axis").withColumnRenamed("component", "group")


def axis_ends(members: DataFrame, segments: DataFrame, axis: str = "axis") -> DataFrame:
    """(axis, lng0, lat0, lng1, lat1): where the chain of each axis starts and ends. members: as from :func:`chained`."""
    j = members.join(segments.select("seg_id", "lng0", "lat0", "lng1", "lat1"), "seg_id")
    end = lambda c, k: F.when(F.col("turned"), F.col(f"{c}{1 - k}")).otherwise(F.col(f"{c}{k}"))
    ends = [F.min_by(end(c, 0), "ord").alias(f"{c}0") for c in ("lng", "lat")] + [F.max_by(end(c, 1), "ord").alias(f"{c}1") for c in ("lng", "lat")]
    return j.groupBy(axis).agg(*ends)


def chained(segments: DataFrame, by: str) -> DataFrame:
    """(by, ord, seg_id, turned, gap_m): the segments of each corridor in riding order with the gap to the one before."""
    kind = segments.schema[by].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            own, ords, ids, turned, gaps = [], [], [], [], []
            for i, rows in enumerate(b.column(1).to_pylist()):
                o = order_lines([Line(r["seg_id"], [(r["lng0"], r["lat0"]), (r["lng1"], r["lat1"])]) for r in rows], every=True)
                own += [i] * len(o)
                ords += range(len(o))
                ids += [x.id for x in o]
                turned += [x.turned for x in o]
                gaps += [0.0, *(_metres(*x.end, *y.start) for x, y in zip(o, o[1:]))]
            cols = [b.column(0).take(pa.array(own, pa.int64())), pa.array(ords, pa.int32()), pa.array(ids, pa.int64()), pa.array(turned, pa.bool_()), pa.array(gaps, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, [by, "ord", "seg_id", "turned", "gap_m"])

    # most corridors have one segment: a row each, as groups cost far more
    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = F.collect_list(F.struct(F.col("seg_id").cast("long").alias("seg_id"), "lng0", "lat0", "lng1", "lat1"))
    src = segments.select(by, "seg_id", "lng0", "lat0", "lng1", "lat1").repartition(parts, by).groupBy(by).agg(rows)
    return src.mapInArrow(run, f"`{by}` {kind}, ord int, seg_id bigint, turned boolean, gap_m double")


def segment_edges(members: DataFrame, segments: DataFrame, gap_m: float = 500.0) -> DataFrame:
    """(a, b, cost, length) of the segment graph: neighbours within a corridor cost nothing, in the sense that may be
    ridden; others the gap between their nearest ends. members: (axis, ord, seg_id); segments also has bike_direction."""
    from pyspark.sql import Window

    w = Window.partitionBy("axis").orderBy("ord")
    n = members.withColumn("_b", F.lead("seg_id").over(w)).where("_b is not null").join(segments.select("seg_id", "bike_direction"), "seg_id")
    way = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    fwd, back = F.when(F.col("bike_direction") != "reverse", way("seg_id", "_b")), F.when(F.col("bike_direction") != "forward", way("_b", "seg_id"))
    inner = n.select(F.explode(F.array_compact(F.array(fwd, back))).alias("_w"), F.lit(0.0).alias("cost")).select("_w.*", "cost")
    ax = members.select("seg_id", "axis")
    cross = line_links(segments, "seg_id", gap_m).join(ax.withColumnsRenamed({"seg_id": "a", "axis": "_xa"}), "a").join(ax.withColumnsRenamed({"seg_id": "b", "axis": "_xb"}), "b").where("_xa <> _xb")
    cross = cross.select(F.explode(F.array(way("a", "b"), way("b", "a"))).alias("_w"), F.col("gap_m").alias("cost")).select("_w.*", "cost")
    size = segments.select(F.col("seg_id").alias("b"), "length_m")
    return inner.unionAll(cross).groupBy("a", "b").agg(F.min("cost").alias("cost")).join(size, "b").select("a", "b", "cost", F.col("length_m").alias("length"))
