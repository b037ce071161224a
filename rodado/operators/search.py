"""Bounded searches for routes over the segment graph, one start at a time, starts spread over the tasks.

A search starts at a segment near an anchor and grows paths segment by segment. Each step takes the oldest open path,
hands it out if it has become a route, and grows it by the few neighbours that promise most: those of its own corridor,
then those that keep the direction, belong to long corridors and lie near. Too many open paths are cut to the best.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from . import graph
from .graph import GRAPH_EDGES, Graph, _metres, collect_graph, components
from .lines import turn_between

#: Steps of one search, open paths kept when there are too many, and from how many; segments of a path.
STEPS, BEAM, FULL, LONGEST = 1000, 30, 50, 120
#: Kilometres of a route, corridors it may use, segments of a loop, neighbours a path grows by.
KM, MOST_AXES, LOOP_SEGMENTS, GROW = (2.0, 80.0), 12, 6, 4
#: Metres within which the end of a path is at an anchor, and which that must be away from the start's.
END_M, AWAY_M = 2000.0, 1500.0
#: Distances in metres that loops reach before they turn home.
RADII = (2_000.0, 4_000.0, 6_000.0)
#: Ranked ways on that are kept at a time: a bound of memory, they are ranked again when asked for.
KNOWN = 50_000


class Network(Graph):
    """Segments with their ends, middles, lengths and corridors, the edges between them, and anchors in a grid."""

    CELL = 0.02

    def __init__(self, edges, segments, anchors=()):
        super().__init__(edges, [(s, ((x0 + x1) / 2, (y0 + y1) / 2)) for s, _, _, x0, y0, x1, y1 in segments])
        self.axis = {s: a for s, a, *_ in segments}
        self.length = {s: ln or 0.0 for s, _, ln, *_ in segments}
        self.ends = {s: ((x0, y0), (x1, y1)) for s, _, _, x0, y0, x1, y1 in segments}
        self.axis_m: dict = {}
        for s, a in self.axis.items():
            self.axis_m[a] = self.axis_m.get(a, 0.0) + self.length[s]
        self.anchor: dict = {}
        self.ways: dict = {}
        self.grid: dict = {}
        for place, x, y in anchors:
            self.grid.setdefault((math.floor(x / self.CELL), math.floor(y / self.CELL)), []).append((place, x, y))

    def anchor_at(self, x: float, y: float, within_m: float):
        """The nearest anchor, the smaller one on ties, None if there is none."""
        reach = within_m / 111_194.9
        wide = reach / max(math.cos(math.radians(y)), 0.01)
        best = None
        for gx in range(math.floor((x - wide) / self.CELL), math.floor((x + wide) / self.CELL) + 1):
            for gy in range(math.floor((y - reach) / self.CELL), math.floor((y + reach) / self.CELL) + 1):
                for place, u, v in self.grid.get((gx, gy), ()):
                    d = _metres(x, y, u, v)
                    if d < within_m and (best is None or (d, place) < best[:2]):
                        best = (d, place, u, v)
        return best and best[1:]

    def anchor_near(self, n):
        """The nearest anchor to the end of a segment, told once."""
        if n not in self.anchor:
            self.anchor[n] = self.anchor_at(*self.ends[n][1], END_M)
        return self.anchor[n]

    def ways_from(self, last) -> list[tuple]:
        """(segment, cost, of the same corridor, heading, points for a long corridor) of the neighbours, told once."""
        if (ways := self.ways.get(last)) is None:
            at, axis = self.ends[last][1], self.axis[last]
            ways = self.ways[last] = [(n, cost, self.axis[n] == axis, _heading(at, self.at[n]), min(self.axis_m[self.axis[n]] / 3000, 2.0)) for n, cost, _ in self.out.get(last, ()) if n in self.ends]
        return ways


def _heading(a, b) -> float:
    return math.degrees(math.atan2(b[0] - a[0], b[1] - a[1])) % 360


class _Path:
    __slots__ = ("segs", "runs", "on_m", "gap_m", "heading", "home")

    def __init__(self, segs, runs, on_m, gap_m, heading, home=False):
        self.segs, self.runs, self.on_m, self.gap_m, self.heading, self.home = segs, runs, on_m, gap_m, heading, home


class _Ways:
    """The ways on from a segment, the most promising first: they depend on where a path stands, its heading and whether it
    is homeward, not on how it came there, so they are ranked once. ``more`` adds points for a neighbour."""

    def __init__(self, g: Network, turn: float, same: float, per_turn: float, more=None):
        self.g, self.turn, self.same, self.per_turn, self.more, self.known = g, turn, same, per_turn, more, {}

    def __call__(self, p: _Path) -> list[tuple]:
        key = p.segs[-1], p.heading, p.home
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            found = self.known[key] = self._ranked(*key)
        return found

    def _ranked(self, last, heading: float, home: bool) -> list[tuple]:
        g, found = self.g, []
        for n, cost, inside, to, pull in g.ways_from(last):
            off = turn_between(heading, to)
            if not inside and off > self.turn:
                continue
            points = self.same if inside else (180 - off) / self.per_turn + pull - cost / 1000
            found.append((-(points + (self.more(last, n, to, home) if self.more else 0.0)), n, cost, inside, to))
        return [(n, 0 if inside else 1, g.length[n], 0.0 if inside else cost, _heading(*g.ends[n]) if inside else to) for _, n, cost, inside, to in sorted(found)]


def _steps(g: Network, start, ways: _Ways, worth) -> Iterator[_Path]:
    """The paths of a search in its order; each grows when the next one is asked for."""
    open_ = deque([_Path([start], 1, g.length[start], 0.0, _heading(*g.ends[start]))])
    steps = 0
    while open_ and steps < STEPS:
        p = open_.popleft()
        steps += 1
        yield p
        segs = p.segs
        if p.on_m + p.gap_m > KM[1] * 1000 or len(segs) > LONGEST:
            continue
        grown = 0
        for n, run, on_m, gap_m, heading in ways(p):
            if n not in segs:
                open_.append(_Path([*segs, n], p.runs + run, p.on_m + on_m, p.gap_m + gap_m, heading, p.home))
                grown += 1
                if grown == GROW:
                    break
        if len(open_) > FULL:
            open_ = deque(sorted(open_, key=lambda s: (-worth(s), s.segs))[:BEAM])


def reached(g: Network, start, fits=lambda p: True, ways: _Ways | None = None) -> Iterator[tuple]:
    """(anchor, path, metres on segments, metres of gaps) of the paths from a segment that are long enough to be a route and
    end near an anchor (place, lng, lat), in the order of the search; they are the same for all places near the segment.
    ways: as from :func:`onward`."""
    for p in _steps(g, start, ways or onward(g), lambda s: s.on_m - s.gap_m):
        if p.on_m + p.gap_m >= KM[0] * 1000 and p.runs <= MOST_AXES and fits(p):
            if end := g.anchor_near(p.segs[-1]):
                yield end, p.segs, p.on_m, p.gap_m


def onward(g: Network) -> _Ways:
    """The ways on for searches of one-way routes, whatever their start."""
    return _Ways(g, 120.0, 10.0, 30.0)


class _Kept:
    """What an iterator gives, to be read again from the start; no further than anyone read."""

    def __init__(self, source: Iterator):
        self.source, self.seen = source, []

    def __iter__(self) -> Iterator:
        i = 0
        while True:
            if i == len(self.seen):
                try:
                    self.seen.append(next(self.source))
                except StopIteration:
                    return
            yield self.seen[i]
            i += 1


def one_way(g: Network, start, origin: tuple[float, float], place, fits=lambda p: True, paths=None) -> list[tuple]:
    """(end place, path, metres on segments, metres of gaps) of the routes from a segment near an anchor that end near
    another one; a search ends when its routes have three different lengths of 3 km each. paths: as from :func:`reached`."""
    if start not in g.ends:
        return []
    found, lengths = [], set()
    for end, segs, on_m, gap_m in reached(g, start, fits) if paths is None else paths:
        if end[0] != place and _metres(*origin, end[1], end[2]) > AWAY_M:
            found.append((end[0], segs, on_m, gap_m))
            lengths.add(int((on_m + gap_m) // 3000))
            if len(lengths) >= 3:
                break
    return found


class _Around:
    """What loops around one anchor share, whatever their start and radius: metres from it, and the ways on."""

    def __init__(self, g: Network, origin: tuple[float, float]):
        self.g, self.origin, self.away, self.mid, self.back = g, origin, {}, {}, {}
        self.ways = _Ways(g, 150.0, 6.0, 45.0, self.more)

    def metres(self, n) -> float:
        """From the end of a segment."""
        if (d := self.away.get(n)) is None:
            d = self.away[n] = _metres(*self.origin, *self.g.ends[n][1])
        return d

    def more(self, last, n, to: float, home: bool) -> float:
        if (then := self.mid.get(n)) is None:
            then = self.mid[n] = _metres(*self.origin, *self.g.at[n])
        away = self.metres(last)
        if not home:
            return 2.0 if then > away else 0.0
        if (back := self.back.get(last)) is None:
            back = self.back[last] = _heading(self.g.ends[last][1], self.origin)
        return (3.0 if then < away else 0.0) + (90 - min(turn_between(to, back), 90)) / 30


def loops(g: Network, start, origin: tuple[float, float], radius_m: float, fits=lambda p: True, most: int = 2, around: _Around | None = None) -> list[tuple]:
    """(path, metres on segments, metres of gaps) of at most ``most`` loops around an anchor: outward until half the
    radius is behind, then homeward until near again, over at least two corridors. around: of the same anchor."""
    if start not in g.ends:
        return []
    found, around = [], around or _Around(g, origin)
    for p in _steps(g, start, around.ways, lambda s: s.on_m - s.gap_m + (2000 if s.home else 0)):
        away = around.metres(p.segs[-1])
        p.home = p.home or away > radius_m / 2
        if p.home and away < END_M and p.on_m + p.gap_m >= KM[0] * 1000 and len(p.segs) >= LOOP_SEGMENTS and 2 <= p.runs <= MOST_AXES and fits(p):
            found.append((p.segs, p.on_m, p.gap_m))
            if len(found) == most:
                break
    return found


def rides_well(p: _Path) -> bool:
    """At least 60 % of a path, rounded, lies on segments."""
    total = p.on_m + p.gap_m
    return total > 0 and math.floor(p.on_m / total * 100 + 0.5) >= 60


def collect_network(segments: DataFrame, edges: DataFrame, anchors: DataFrame, most_anchors: int = 1_000_000):
    """The network as a broadcast, after checks of the sizes of its three tables."""
    box = collect_graph(edges)
    seg = segments.select("seg_id", "axis", "length_m", "lng0", "lat0", "lng1", "lat1").dropDuplicates(["seg_id"]).limit(GRAPH_EDGES + 1).collect()
    if len(seg) > GRAPH_EDGES:
        raise ValueError(f"more than {GRAPH_EDGES} segments; cut the region")
    rows = anchors.select("place_id", "lng", "lat").limit(most_anchors + 1).collect()
    if len(rows) > most_anchors:
        raise ValueError(f"more than {most_anchors} anchors; cut the region")
    return segments.sparkSession.sparkContext.broadcast((box.value[0], [tuple(r) for r in seg], [tuple(r) for r in rows]))


#: Searches that a task does at about; those of one component are spread over several tasks beyond that.
TASK_SEARCHES = 2_000


def connected(segments: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) of the segments (seg_id, axis) that edges and corridors connect: no search leaves a component."""
    c = F.col
    seg = stage(segments.select("seg_id", "axis").dropDuplicates(["seg_id"]).withColumn("_first", F.min("seg_id").over(Window.partitionBy("axis"))), "segments")
    links = edges.select("a", "b").unionAll(seg.select(c("seg_id").alias("a"), c("_first").alias("b")))
    return stage(components(seg.select(c("seg_id").alias("id")), links, "id"), "components")


def search_routes(starts: DataFrame, segments: DataFrame, edges: DataFrame, anchors: DataFrame, how: str = "one_way", radii: tuple[float, ...] = RADII, known: DataFrame | None = None) -> DataFrame:
    """(start, end, seg_id, path, on_m, gap_m) from each of ``starts`` (place_id, lng, lat, seg_id): an anchor and a segment
    near it. segments: (seg_id, axis, length_m, ends); anchors: (place_id, lng, lat). Loops end where they start.

    No search leaves a component of edges and corridors: a task holds the segments and edges of some components, and the
    anchors around them. A component of more than GRAPH_EDGES edges or segments is an error. known: the components as from
    :func:`connected`, where they are known already.
    """
    c = F.col
    place, kind = (starts.schema[k].dataType for k in ("place_id", "seg_id"))
    seg = segments.select("seg_id", "axis", "length_m", "lng0", "lat0", "lng1", "lat1").dropDuplicates(["seg_id"])
    comp = connected(segments, edges) if known is None else known
    at = comp.withColumnRenamed("id", "seg_id")
    e = edges.join(comp.withColumnRenamed("id", "a"), "a").select("component", "a", "b", "cost", "length")
    for what, rows in (("edges", e), ("segments", comp)):
        most = rows.groupBy("component").agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
        if most > graph.GRAPH_EDGES:
            raise ValueError(f"{most} {what} in one component; cut the region")
    st = stage(starts.select("place_id", "lng", "lat", "seg_id").join(at, "seg_id"), "starts")
    n = st.groupBy("component").agg(F.count("*").alias("_n"))
    parts = max(int(starts.sparkSession.conf.get("spark.sql.shuffle.partitions")), st.count() // TASK_SEARCHES, edges.count() // graph.TASK_EDGES)
    # the components that are searched, and the parts that share the searches of each
    part = n.select("component", F.least(F.ceil(c("_n") / TASK_SEARCHES), F.lit(parts)).cast("int").alias("_salts"))
    part = stage(part, "parts")
    to = F.pmod(F.xxhash64("component") + c("_salt"), F.lit(parts)).alias("_part")
    st = st.join(part, "component").withColumn("_salt", F.pmod(F.xxhash64("seg_id"), c("_salts"))).select(to, "place_id", "lng", "lat", "seg_id")
    spread = part.select("component", F.explode(F.sequence(F.lit(0), c("_salts") - 1)).alias("_salt")).select("component", to).distinct()
    seg = stage(seg.join(at, "seg_id").join(spread, "component").select("_part", "seg_id", "axis", "length_m", "lng0", "lat0", "lng1", "lat1"), "segments")
    # the anchors that the end of a segment can be near, by the cells of the grid that Network looks into
    reach = F.lit(END_M / 111_194.9 + 1e-9)
    wide = reach / F.greatest(F.cos(F.radians("lat1")), F.lit(0.01))
    cell = lambda v: F.floor(v / Network.CELL)
    cells = seg.select("_part", *(F.sequence(cell(c(k) - r), cell(c(k) + r)).alias(g) for g, k, r in (("_gx", "lng1", wide), ("_gy", "lat1", reach)))).distinct()
    cells = cells.select("_part", F.explode("_gx").alias("_gx"), "_gy").select("_part", "_gx", F.explode("_gy").alias("_gy")).distinct()
    near = anchors.select("place_id", "lng", "lat").where("lng is not null and lat is not null").withColumns({"_gx": cell(c("lng")), "_gy": cell(c("lat"))}).join(cells, ["_gx", "_gy"])

    none = lambda t: F.lit(None).cast(t)
    num = [none("double")] * 4
    ax = seg.schema["axis"].dataType
    names = ["_part", "a", "b", "axis", "place_id", "x", "y", "lng0", "lat0", "lng1", "lat1"]
    rows = e.join(spread, "component").select("_part", "a", "b", none(ax), none(place), "cost", "length", *num).toDF(*names)
    rows = rows.unionAll(seg.select("_part", "seg_id", none(kind), "axis", none(place), "length_m", none("double"), "lng0", "lat0", "lng1", "lat1").toDF(*names))
    rows = rows.unionAll(near.select("_part", none(kind), none(kind), none(ax), "place_id", "lng", "lat", *num).toDF(*names))

    def run(left, right):
        import pyarrow as pa

        net, segs, places = [], [], []
        for a, b, axis, p, x, y, *ends in zip(*(right.column(k).to_pylist() for k in names[1:])):
            if b is not None:
                net.append((a, b, x, y))
            elif a is not None:
                segs.append((a, axis, x, *ends))
            else:
                places.append((p, x, y))
        g = Network(net, sorted(segs, key=lambda s: s[0]), places)
        out, last, ways = [], None, onward(g)
        at = ("seg_id", "place_id") if how == "one_way" else ("place_id", "seg_id")
        for u, v, x, y in sorted(zip(*(left.column(k).to_pylist() for k in (*at, "lng", "lat")))):
            if how == "one_way":
                if u != last:
                    last, paths = u, _Kept(reached(g, u, rides_well, ways))
                out += [(v, e, u, *r) for e, *r in one_way(g, u, (x, y), v, rides_well, paths)]
            else:
                if (u, x, y) != last:
                    last, around = (u, x, y), _Around(g, (x, y))
                out += [(u, u, v, *r) for m in radii for r in loops(g, v, (x, y), m, rides_well, around=around)]
        p, s = left.schema.field("place_id").type, left.schema.field("seg_id").type
        cols = list(zip(*out)) or [()] * 6
        return pa.table([pa.array(v, t) for v, t in zip(cols, (p, p, s, pa.list_(s), pa.float64(), pa.float64()))], ["start", "end", "seg_id", "path", "on_m", "gap_m"])

    p, s = place.simpleString(), kind.simpleString()
    return st.groupBy("_part").cogroup(rows.groupBy("_part")).applyInArrow(run, f"start {p}, end {p}, seg_id {s}, path array<{s}>, on_m double, gap_m double")
