"""Components, flood fill, shortest paths and small cycles on edge tables."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import drop, stage


def _are_stars(e: DataFrame) -> bool:
    """True if every u of the edges (u > v) has one v, and no v is a u: then v is the smallest of its component."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("_out"), F.lit(0).alias("_in")).unionAll(e.select(F.col("v").alias("x"), F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("_out").alias("_out"), F.max("_in").alias("_in"))
    return ends.where((F.col("_out") > 1) | ((F.col("_out") > 0) & (F.col("_in") > 0))).isEmpty()


def components(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """(node, component): the smallest id that each node is connected to. edges: (a, b) in either direction.

    Large-star and small-star rounds until only stars are left; their number grows with the logarithm of the diameter
    and isn't limited. Each round is written to the shared folder, so neither lineage nor a lost executor piles up
    work, and the round before is dropped. No hot node is collected: stars are aggregates.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = stage(e, "edges")
    while not _are_stars(e):
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself go to the smallest
        low = large.where("v < u")
        m = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        old, e = e, stage(small.unionAll(m.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop(old)
    root = e.select(F.col("u").alias(node), F.col("v").alias("component"))
    return nodes.select(F.col(node)).distinct().join(root, node, "left").select(node, F.coalesce("component", node).alias("component"))


def flood_fill(cells: DataFrame) -> DataFrame:
    """(gx, gy, component) of grid cells joined over edges and corners; cells keep within 31 bits either way."""
    code = lambda x, y: F.shiftleft(x.cast("long"), 32) + (y.cast("long") + 2**31)
    c = cells.select("gx", "gy").distinct().withColumn("id", code(F.col("gx"), F.col("gy")))
    steps = [(1, -1), (1, 0), (1, 1), (0, 1)]
    n = c.select(F.col("id").alias("a"), F.explode(F.array(*(F.struct((F.col("gx") + i).alias("gx"), (F.col("gy") + j).alias("gy")) for i, j in steps))).alias("_g")).select("a", "_g.*")
    edges = n.join(c.withColumnRenamed("id", "b"), ["gx", "gy"]).select("a", "b")
    return c.join(components(c, edges), "id").select("gx", "gy", "component")


#: Edges of a graph that tasks search whole; larger ones must be cut by region first.
GRAPH_EDGES = 5_000_000


class _Far(dict):
    """Metres from nodes to one goal, each told once; 0 for nodes without a place."""

    def __init__(self, at: dict, goal):
        super().__init__()
        self.at, self.goal = at, goal

    def __missing__(self, n) -> float:
        self[n] = d = _metres(*self.at[n], *self.at[self.goal]) if n in self.at else 0.0
        return d


class Graph:
    """Adjacency of one region, with node places where searches need them."""

    def __init__(self, edges, places=()):
        self.out: dict = {}
        for a, b, cost, length in edges:
            self.out.setdefault(a, []).append((b, cost, length))
        self.at = dict(places)
        self.far = _Far(self.at, None)

    def dijkstra(self, start, goals, most: float = math.inf) -> dict:
        """{goal: (cost, length, path)} of the cheapest paths, none beyond ``most`` cost; equal costs by the smaller node."""
        best, seen, heap = {start: 0.0}, set(), [(0.0, 0.0, start, None)]
        back, out, open_ = {}, {}, set(goals)
        while heap and open_:
            cost, length, n, came = heapq.heappop(heap)
            if n in seen:
                continue
            seen.add(n)
            back[n] = came
            if n in open_:
                open_.discard(n)
                path = [n]
                while back[path[-1]] is not None:
                    path.append(back[path[-1]])
                out[n] = cost, length, path[::-1]
            for m, c, ln in self.out.get(n, ()):
                k = cost + c
                if m not in seen and k <= most and k < best.get(m, math.inf):
                    best[m] = k
                    heapq.heappush(heap, (k, length + ln, m, n))
        return out

    def a_star(self, start, goal, most: float = 15_000.0):
        """Search led by the straight distance to the goal. A node's length is paid on entering it and nodes aren't
        reopened, so the path need not be the shortest; paths over ``most`` metres are given up. Distances to the goal
        are kept until another is asked for."""
        if start not in self.at or goal not in self.at:
            return None
        if self.far.goal != goal:
            self.far = _Far(self.at, goal)
        h = self.far
        g, back, closed, heap = {start: 0.0}, {start: None}, set(), [(h[start], start)]
        while heap:
            _, n = heapq.heappop(heap)
            if n == goal:
                path = [n]
                while back[path[-1]] is not None:
                    path.append(back[path[-1]])
                return g[n], g[n], path[::-1]
            if n in closed or g[n] > most:
                continue
            closed.add(n)
            for m, c, ln in self.out.get(n, ()):
                k = g[n] + c + ln
                if m not in closed and k < g.get(m, math.inf):
                    g[m], back[m] = k, n
                    heapq.heappush(heap, (k + h[m], m))
        return None


def _metres(a, b, c, d) -> float:
    p, q = math.radians(b), math.radians(d)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(c - a) / 2) ** 2
    return 2 * geo.EARTH_M * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def collect_graph(edges: DataFrame, places: DataFrame | None = None, most: int = GRAPH_EDGES):
    """The edge table (a, b, cost, length) as a broadcast graph, after a check of its size and of its places'."""
    n = edges.count()
    if n > most:
        raise ValueError(f"{n} edges; cut the graph into regions of at most {most}")
    if places is not None:
        ends = edges.select(F.col("a").alias("id")).unionAll(edges.select("b")).distinct()
        places = places.dropDuplicates(["id"]).join(ends, "id", "left_semi")  # at most two for each edge
    rows = [tuple(r) for r in edges.select("a", "b", "cost", "length").collect()]
    at = [(r[0], (r[1], r[2])) for r in places.select("id", "lng", "lat").collect()] if places is not None else []
    return edges.sparkSession.sparkContext.broadcast((rows, at))


#: Searches of one component that a task does at least before they are spread over several, each with a copy of its edges.
TASK_STARTS = 5_000
#: Edges that a task holds at about, of many small components together.
TASK_EDGES = 100_000


def paths(requests: DataFrame, edges: DataFrame, places: DataFrame | None = None, how: str = "dijkstra", most: float = math.inf, known: DataFrame | None = None) -> DataFrame:
    """(src, dst, cost, length, path) of each request (src, dst) with a path; what starts at one node is one search.

    Requests may tell the most cost of a path themselves, as a column ``most`` (for "dijkstra"). known: the components of
    the nodes (id, component), where they are known already.

    No path leaves a component: a task holds the edges of some components, whatever the size of the whole graph, and
    those of no other. A component of more than GRAPH_EDGES edges is an error, and many searches in one are spread.
    """
    c = F.col
    own = "most" in requests.columns
    r = requests.select("src", "dst", c("most") if own else F.lit(float(most)).alias("most"))
    comp = known
    if comp is None:
        edges = edges if hasattr(edges, "_staged_path") else stage(edges.select("a", "b", "cost", "length"), "edges")
        ends = edges.select(c("a").alias("id")).unionAll(edges.select("b")).distinct()
        comp = stage(components(ends, edges, "id"), "components")
    # what lies in two components has no path
    for k in ("src", "dst"):
        r = r.join(comp.select(c("id").alias(k), c("component").alias(f"_c{k}")), k, "left").withColumn(f"_c{k}", F.coalesce(f"_c{k}", k))
    r = stage(r.where("_csrc = _cdst").select("src", "dst", "most", c("_csrc").alias("component")), "requests")
    if known is not None:
        comp = stage(comp.join(r.select("component").distinct(), "component", "left_semi").select("id", "component"), "components")
        edges = stage(edges.select("a", "b", "cost", "length").join(comp.select(c("id").alias("a")), "a", "left_semi").select("a", "b", "cost", "length"), "edges")
    e = edges.select("a", "b", "cost", "length").join(comp.withColumnRenamed("id", "a"), "a")
    size = stage(e.groupBy("component").agg(F.count("*").alias("_n")), "sizes")
    most_edges, n = size.agg(F.coalesce(F.max("_n"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if most_edges > GRAPH_EDGES:
        raise ValueError(f"{most_edges} edges in one component; cut the graph into regions of at most {GRAPH_EDGES}")
    parts = max(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // TASK_EDGES)
    starts = r.select("component", "src").distinct().groupBy("component").agg(F.count("*").alias("_starts"))
    salts = starts.where(c("_starts") > TASK_STARTS).select("component", F.least(F.ceil(c("_starts") / TASK_STARTS), F.lit(parts)).cast("int").alias("_salts"))
    salts = stage(salts, "salts")
    many = F.coalesce("_salts", F.lit(1))
    part = F.pmod(F.xxhash64("component") + c("_salt"), F.lit(parts)).alias("_part")
    r = r.join(salts, "component", "left").withColumn("_salt", F.pmod(F.xxhash64("src"), many)).select(part, "src", "dst", "most")
    none = F.lit(None)
    rows = e.select("component", "a", "b", "cost", "length", none.cast("double").alias("lng"), none.cast("double").alias("lat"))
    if places is not None:
        at = places.dropDuplicates(["id"]).join(comp, "id")  # at most two for each edge
        rows = rows.unionAll(at.select("component", "id", none.cast(edges.schema["b"].dataType), none.cast("double"), none.cast("double"), "lng", "lat"))
    asked = r.select("_part").distinct()
    rows = rows.join(salts, "component", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1))).select(part, "a", "b", "cost", "length", "lng", "lat").join(asked, "_part", "left_semi")
    kind = requests.schema["src"].dataType.simpleString()

    def run(left, right):
        import pyarrow as pa

        net, at = [], []
        for a, b, cost, length, x, y in zip(*(right.column(k).to_pylist() for k in ("a", "b", "cost", "length", "lng", "lat"))):
            if b is None:
                at.append((a, (x, y)))
            else:
                net.append((a, b, cost, length))
        g = Graph(net, at)
        asked = list(zip(*(left.column(k).to_pylist() for k in ("src", "dst", "most"))))
        out, by = [], {}
        if how == "dijkstra":
            for s, t, m in asked:
                by.setdefault(s, []).append((t, m))
            for s, goals in by.items():
                found = g.dijkstra(s, [t for t, _ in goals], max(m for _, m in goals))
                out += [(s, t, float(x[0]), float(x[1]), x[2]) for t, m in goals if (x := found.get(t)) and x[0] <= m]
        else:
            for s, t, m in sorted(asked, key=lambda r: r[1]):
                if (s, t) not in by:
                    by[s, t] = g.a_star(s, t, m)
                if x := by[s, t]:
                    out.append((s, t, float(x[0]), float(x[1]), x[2]))
        node = left.schema.field("src").type
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(v, t) for v, t in zip(cols, (node, node, pa.float64(), pa.float64(), pa.list_(node)))], ["src", "dst", "cost", "length", "path"])

    return r.groupBy("_part").cogroup(rows.groupBy("_part")).applyInArrow(run, f"src {kind}, dst {kind}, cost double, length double, path array<{kind}>")


def triangles(edges: DataFrame, least: float, most: float) -> DataFrame:
    """(a, b, c, total) with a < b < c of undirected edges (a < b, length) whose sum lies in the limits."""
    e = edges.select("a", "b", "length")
    ab, bc = e.withColumnRenamed("length", "_1"), e.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("length").alias("_2"))
    ac = e.select("a", F.col("b").alias("c"), F.col("length").alias("_3"))
    t = ab.where(F.col("_1") <= most).join(bc.where(F.col("_2") <= most), "b").where(F.col("_1") + F.col("_2") <= most).join(ac, ["a", "c"])
    return t.withColumn("total", F.col("_1") + F.col("_2") + F.col("_3")).where(F.col("total").between(least, most)).select("a", "b", "c", "total")


def rectangles(edges: DataFrame, least: float, most: float) -> DataFrame:
    """(a, b, c, d, total) of cycles a-b-c-d with a < b < c < d of undirected edges (a < b, length) whose sum lies in
    the limits. Cycles that don't rise along their way aren't told."""
    e = edges.select("a", "b", "length")
    ab = e.withColumnRenamed("length", "_1")
    bc = e.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("length").alias("_2"))
    cd = e.select(F.col("a").alias("c"), F.col("b").alias("d"), F.col("length").alias("_3"))
    ad = e.select("a", F.col("b").alias("d"), F.col("length").alias("_4"))
    p = ab.join(bc, "b").where(F.col("_1") + F.col("_2") <= most)
    q = p.join(cd, "c").where(F.col("_1") + F.col("_2") + F.col("_3") <= most).join(ad, ["a", "d"])
    return q.withColumn("total", F.col("_1") + F.col("_2") + F.col("_3") + F.col("_4")).where(F.col("total").between(least, most)).select("a", "b", "c", "d", "total")


def collinear(ax, ay, bx, by, cx, cy, least: float = 0.001, side_m: float = 1000.0):
    """True if three places lie on a line, or so near each other that their cross product in degrees is tiny or no side
    of their triangle reaches ``side_m``."""
    sides = F.greatest(geo.haversine(ax, ay, bx, by), geo.haversine(bx, by, cx, cy), geo.haversine(cx, cy, ax, ay))
    return (F.abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax)) < least) | (sides < side_m)


def quadrants(xs: list, ys: list):
    """Number of quadrants around their mean that the points fall into."""
    n = len(xs)
    mx, my = sum(xs[1:], xs[0]) / n, sum(ys[1:], ys[0]) / n
    q = F.array(*(F.when(x >= mx, F.when(y >= my, 0).otherwise(1)).otherwise(F.when(y >= my, 2).otherwise(3)) for x, y in zip(xs, ys)))
    return F.size(F.array_distinct(q))


def node_key(lng, lat):
    """Number of the point that a road's vertex snaps to: coordinates rounded to 1e-4 degrees."""
    snap = lambda c: F.floor(c / 1e-4 + 0.5).cast("long")
    return F.shiftleft(snap(lng), 32) + (snap(lat) + 2**31)


def road_graph(ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes (id, lng, lat), edges (a, b, cost, length)) of roads, both ways: vertices snap to a grid of 1e-4 degrees, the
    first that snaps to a node places it, a metre costs by the road's class.

    ways: (way_id, points array<struct<lng,lat>>, highway). Of parallel edges the cheapest stays.
    """
    from ..functions.rules import road_weight

    v = ways.select("way_id", road_weight(F.col("highway")).alias("_w"), F.posexplode("points").alias("_i", "_p"), "points")
    v = v.withColumns({"a": node_key(F.col("_p.lng"), F.col("_p.lat")), "_q": F.try_element_at("points", F.col("_i") + 2)})
    nodes = v.groupBy(F.col("a").alias("id")).agg(F.min_by("_p", F.struct("way_id", "_i")).alias("_p")).select("id", "_p.lng", "_p.lat")
    e = v.where("_q is not null").withColumn("b", node_key(F.col("_q.lng"), F.col("_q.lat"))).where("a <> b")
    e = e.withColumn("length", geo.haversine("_p.lng", "_p.lat", "_q.lng", "_q.lat")).select("a", "b", (F.col("length") * F.col("_w")).alias("cost"), "length")
    both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "cost", "length"))
    best = both.groupBy("a", "b").agg(F.min(F.struct("cost", "length")).alias("_e"))
    return nodes, best.select("a", "b", "_e.cost", "_e.length")


def road_components(ways: DataFrame) -> DataFrame:
    """(id, component) of the nodes of :func:`road_graph`: ways that share a node are one component, told way by way."""
    v = ways.select("way_id", F.explode(F.transform("points", lambda p: node_key(p["lng"], p["lat"]))).alias("id")).distinct()
    at = stage(v.groupBy("id").agg(F.min("way_id").alias("a"), F.max("way_id").alias("_z")), "nodes")
    # a node tells of its smallest way; the others of it are linked to that one
    shared = v.join(at.where("a <> _z").select("id", "a"), "id").select("a", F.col("way_id").alias("b"))
    comp = components(ways.select(F.col("way_id").alias("a")), shared, "a")
    return at.join(comp, "a").select("id", "component")
