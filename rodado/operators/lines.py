"""Putting the pieces of a path into a rideable order, one path at a time.

A path's pieces are few (a road has at most some thousand ways), so each path is one group of a grouped pandas
function, and paths spread over the cluster. The functions on plain lists are usable and tested by themselves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import _metres

#: Ends this close are one place.
SNAP_M = 40.0
TURN = 120.0


@dataclass
class Line:
    """A piece: id, points (lng, lat), whether it may be ridden only forward, and whether it is turned round."""

    id: int
    points: list[tuple[float, float]]
    oneway: bool = False
    turned: bool = False
    path: int = 0
    extra: dict = field(default_factory=dict)

    @property
    def ridden(self) -> list[tuple[float, float]]:
        return self.points[::-1] if self.turned else self.points

    @property
    def start(self):
        return self.ridden[0]

    @property
    def end(self):
        return self.ridden[-1]

    @property
    def length(self) -> float:
        return sum(_metres(*a, *b) for a, b in zip(self.points, self.points[1:]))

    @property
    def heading(self) -> float:
        (a, b), (c, d) = self.start, self.end
        return math.degrees(math.atan2((c - a) * math.cos(math.radians((b + d) / 2)), d - b))

    def flipped(self) -> Line:
        return Line(self.id, self.points, self.oneway, not self.turned, self.path, self.extra)


def turn_between(a: float, b: float) -> float:
    d = abs(a - b) % 360
    return min(d, 360 - d)


def middle(line: Line) -> tuple[float, float]:
    return (line.points[0][0] + line.points[-1][0]) / 2, (line.points[0][1] + line.points[-1][1]) / 2


def beside(short: Line, long: Line, within_m: float = 150.0, angle: float = 30.0, share: float = 0.5) -> bool:
    """True if the shorter line runs along the longer: alike in direction either way, and so much of it alongside."""
    d = turn_between(short.heading, long.heading)
    if min(d, 180 - d) > angle:
        return False
    (ox, oy), k = long.points[0], math.cos(math.radians(long.points[0][1]))
    flat = lambda p: ((p[0] - ox) * k * 111_195, (p[1] - oy) * 111_195)
    ex, ey = flat(long.points[-1])
    size = math.hypot(ex, ey)
    if size == 0:
        return False
    ux, uy = ex / size, ey / size
    a, b, m = flat(short.points[0]), flat(short.points[-1]), flat(middle(short))
    if abs(m[0] * uy - m[1] * ux) > within_m:
        return False
    lo, hi = sorted((a[0] * ux + a[1] * uy, b[0] * ux + b[1] * uy))
    return hi > lo and (min(hi, size) - max(lo, 0.0)) / (hi - lo) >= share


def distinct_lines(lines: list[Line]) -> list[Line]:
    """Longest first, without closed or tiny pieces and without those beside a piece already kept."""
    kept: list[Line] = []
    real = [x for x in lines if len(x.points) > 1 and x.length >= SNAP_M and _metres(*x.points[0], *x.points[-1]) >= SNAP_M]
    for x in sorted(real, key=lambda x: (-x.length, x.id)):
        if not any(_metres(*middle(x), *middle(y)) <= max(200.0, y.length / 2) and beside(x, y, 50.0 if not (x.oneway and y.oneway) else 60.0) for y in kept):
            kept.append(x)
    return kept


def _walk(first: Line, others: list[Line]) -> list[Line]:
    """Appends the piece that is nearest to the end reached, a gap counting more the sharper the turn into it."""
    out, left = [first], {x.id: x for x in others}
    while left:
        at, heading = out[-1].end, out[-1].heading
        best = None
        for x in left.values():
            for y in (x, x.flipped()):
                gap, turn = _metres(*at, *y.start), turn_between(heading, y.heading)
                cost = gap + (turn / 180) ** 2 * 300 + (500 if turn > TURN else 0) + (2000 if y.oneway and y.turned else 0)
                key = (cost, gap, y.id, y.turned)
                if best is None or key < best[0]:
                    best = (key, y)
        out.append(best[1])
        del left[best[1].id]
    return out


def count_turns(lines: list[Line], angle: float = TURN) -> int:
    return sum(turn_between(a.heading, b.heading) > angle for a, b in zip(lines, lines[1:]))


def by_convention(lines: list[Line]) -> list[Line]:
    """West to east, or north to south if that is the main direction."""
    if not lines:
        return lines
    (a, b), (c, d) = lines[0].start, lines[-1].end
    deg = math.degrees(math.atan2(c - a, d - b)) % 360
    wrong = c < a if 45 <= deg < 135 or 225 <= deg < 315 else d > b
    return [x.flipped() for x in reversed(lines)] if wrong else lines


def order_lines(lines: list[Line], tries: int = 12, every: bool = False) -> list[Line]:
    """The pieces in riding order, each turned as ridden. The order given doesn't matter.

    Closed, tiny and parallel pieces are left out (:func:`distinct_lines`), or with ``every`` ordered like the others.

    Starts are tried from the ends that have no neighbour and the outermost ends; fewest sharp turns win, then the
    least sum of gaps.
    """
    kept = sorted(lines, key=lambda x: x.id) if every else distinct_lines(lines)
    if len(kept) < 2:
        return by_convention([Line(x.id, x.points, x.oneway, False, x.path, x.extra) for x in kept])
    ends = [(p, x, turned) for x in kept for p, turned in ((x.points[0], False), (x.points[-1], True))]
    lone = [(x, t) for p, x, t in ends if not any(y is not x and min(_metres(*p, *q) for q in (y.points[0], y.points[-1])) <= SNAP_M for y in kept)]
    mx, my = sum(p[0] for p, _, _ in ends) / len(ends), sum(p[1] for p, _, _ in ends) / len(ends)
    outer = [(x, t) for _, x, t in sorted(ends, key=lambda e: (-_metres(mx, my, *e[0]), e[1].id, e[2]))]
    starts = list({(x.id, t): (x, t) for x, t in [*sorted(lone, key=lambda s: (s[0].id, s[1])), *outer]}.values())[:tries]
    best = None
    for x, t in starts:
        first = Line(x.id, x.points, x.oneway, t, x.path, x.extra)
        walked = _walk(first, [y for y in kept if y.id != x.id])
        gaps = sum(_metres(*a.end, *b.start) for a, b in zip(walked, walked[1:]))
        against = sum(y.oneway and y.turned for y in walked)
        key = (count_turns(walked), against, round(gaps, 3), x.id, t)
        if best is None or key < best[0]:
            best = (key, walked)
    return by_convention(best[1])


def measure(lines: list[Line]) -> tuple[list, list, list]:
    """(points, metres from the start, (from, to) of each line) along ordered lines, gaps between them included."""
    pts, cum, spans = [], [], []
    for x in lines:
        begin = None
        for p in x.ridden:
            d = _metres(*pts[-1], *p) if pts else 0.0
            pts.append(p)
            cum.append((cum[-1] if cum else 0.0) + d)
            begin = cum[-1] if begin is None else begin
        spans.append((begin, cum[-1]))
    return pts, cum, spans


def project(pts: list, cum: list, at: tuple[float, float]) -> tuple[float, float]:
    """(metres along, distance) of the nearest place on a measured line; the earliest on ties."""
    best = (0.0, _metres(*pts[0], *at)) if pts else (0.0, math.inf)
    k = math.cos(math.radians(at[1]))
    for i in range(1, len(pts)):
        (a, b), (c, d) = pts[i - 1], pts[i]
        vx, vy, wx, wy = (c - a) * k, d - b, (at[0] - a) * k, at[1] - b
        n = vx * vx + vy * vy
        t = min(1.0, max(0.0, (vx * wx + vy * wy) / n)) if n else 0.0
        q = (a + (c - a) * t, b + (d - b) * t)
        dist = _metres(*q, *at)
        if dist < best[1] - 1e-9:
            best = (cum[i - 1] + (cum[i] - cum[i - 1]) * t, dist)
    return best


def junctions(a: list, acum: list, b: list, bcum: list, touch_m: float = 50.0) -> list[tuple[str, float, float, float]]:
    """(kind, metres along a, along b, gap) where two measured lines cross, touch with an end, or come nearest; best first."""
    out = []
    for i in range(1, len(a)):
        for j in range(1, len(b)):
            (x1, y1), (x2, y2), (x3, y3), (x4, y4) = a[i - 1], a[i], b[j - 1], b[j]
            det = (x2 - x1) * (y4 - y3) - (y2 - y1) * (x4 - x3)
            if abs(det) < 1e-18:
                continue
            t = ((x3 - x1) * (y4 - y3) - (y3 - y1) * (x4 - x3)) / det
            u = ((x3 - x1) * (y2 - y1) - (y3 - y1) * (x2 - x1)) / det
            if 0 <= t <= 1 and 0 <= u <= 1:
                out.append(("cross", acum[i - 1] + t * (acum[i] - acum[i - 1]), bcum[j - 1] + u * (bcum[j] - bcum[j - 1]), 0.0))
    gaps = []
    for p, at in ((b[0], 0.0), (b[-1], bcum[-1])):
        s, d = project(a, acum, p)
        gaps.append(("touch" if d <= touch_m else "gap", s, at, d))
    for p, at in ((a[0], 0.0), (a[-1], acum[-1])):
        s, d = project(b, bcum, p)
        gaps.append(("touch" if d <= touch_m else "gap", at, s, d))
    kind = {"cross": 0, "touch": 1, "gap": 2}
    return sorted(out + gaps, key=lambda c: (kind[c[0]], c[3], c[1], c[2]))


def _between(pts: list, cum: list, lo: float, hi: float) -> list:
    """The part of a measured line from lo to hi, with points made at the cuts."""

    def at(m: float):
        i = next((i for i in range(1, len(cum)) if cum[i] >= m), len(cum) - 1)
        t = (m - cum[i - 1]) / (cum[i] - cum[i - 1]) if cum[i] > cum[i - 1] else 0.0
        return tuple(a + (b - a) * t for a, b in zip(pts[i - 1], pts[i]))

    inner = [p for p, c in zip(pts, cum) if lo <= c <= hi]
    head = [at(lo)] if 0 < lo < cum[-1] and lo not in cum else []
    tail = [at(hi)] if 0 < hi < cum[-1] and hi not in cum and hi > lo else []
    return head + inner + tail


def cut(lines: list[Line], begin: float, end: float, least_share: float = 0.2) -> list[Line]:
    """The ordered lines between two measures, in the sense from begin to end, trimmed there.

    Lines over 100 m that lie inside for less than ``least_share`` of their length are left out, but if no other is left the
    one with the longest stretch inside stays.
    """
    _, _, spans = measure(lines)
    lo, hi = min(begin, end), max(begin, end)
    out = []
    inner = [min(hi, b) - max(lo, a) for a, b in spans]
    enough = [i >= 0 and (b - a <= 100 or i / (b - a) >= least_share) for i, (a, b) in zip(inner, spans)]
    if not any(enough) and max(inner, default=0.0) > 0:
        enough[inner.index(max(inner))] = True
    for x, (a, b), ok in zip(lines, spans, enough):
        if not ok:
            continue
        pts, cum, at = x.ridden, [0.0], a
        for p, q in zip(pts, pts[1:]):
            cum.append(cum[-1] + _metres(*p, *q))
        keep = _between(pts, cum, lo - at, hi - at)
        if len(keep) < 2:
            continue
        out.append(Line(x.id, keep[::-1] if x.turned else keep, x.oneway, x.turned, x.path, x.extra))
    return out if begin <= end else [x.flipped() for x in reversed(out)]


def chain(stops: list) -> list[list[Line]]:
    """Lines through stops in order, cut where paths meet; a stop is a place (lng, lat) or a list of ordered lines.

    A path is entered and left at its junctions with its neighbours, or at the points nearest to places beside it. A
    new part begins where a path begins more than 200 m from where the last ended. Of pieces told twice the first stays.
    """
    made = []
    for s in stops:
        if isinstance(s, tuple):
            made.append(("place", s, None, None))
        elif s:
            pts, cum, _ = measure(s)
            made.append(("path", s, pts, cum))
    bounds = [[None, None] for _ in made]
    for i, (x, y) in enumerate(zip(made, made[1:])):
        if x[0] == "place" and y[0] == "path":
            bounds[i + 1][0] = project(y[2], y[3], x[1])[0]
        elif x[0] == "path" and y[0] == "place":
            bounds[i][1] = project(x[2], x[3], y[1])[0]
        elif x[0] == y[0] == "path":
            _, s, t, _ = junctions(x[2], x[3], y[2], y[3])[0]
            bounds[i][1], bounds[i + 1][0] = s, t
    parts, seen = [[]], set()
    for k, (kind, lines, pts, cum) in enumerate(made):
        if kind == "place":
            continue
        a, b = bounds[k]
        a = (0.0 if b is None or b >= cum[-1] / 2 else cum[-1]) if a is None else a
        b = (cum[-1] if a <= cum[-1] / 2 else 0.0) if b is None else b
        piece = [x for x in cut(lines, a, b) if x.id not in seen]
        seen.update(x.id for x in piece)
        if not piece:
            continue
        if parts[-1] and _metres(*parts[-1][-1].end, *piece[0].start) > 200:
            parts.append([])
        parts[-1] += [Line(x.id, x.points, x.oneway, x.turned, k, x.extra) for x in piece]
    return [ridden for p in parts if p for s in split_jumps(p) if (ridden := without_backtracks(s))]


def split_jumps(part: list[Line], over_m: float = 1000.0) -> list[list[Line]]:
    """A part cut where another path goes on more than ``over_m`` away."""
    out = [part[:1]]
    for a, b in zip(part, part[1:]):
        if a.path != b.path and _metres(*a.end, *b.start) > over_m:
            out.append([])
        out[-1].append(b)
    return [p for p in out if p]


def without_backtracks(part: list[Line], back_m: float = 100.0) -> list[Line]:
    """A part without the lines that begin more than ``back_m`` behind the end of the last line kept, along the part's main
    direction, if they are of its path or were kept before. Parts of less than 0.001 degrees have no direction."""
    if len(part) < 2:
        return part
    (x0, y0), (x1, y1) = part[0].start, part[-1].end
    k = 1 if abs(y1 - y0) >= abs(x1 - x0) else 0  # north and south, or east and west
    run = (x1 - x0, y1 - y0)[k]
    if abs(run) < 0.001:
        return part
    metre = 111_195 * math.copysign(1.0 if k else math.cos(math.radians(y0)), run)
    kept = part[:1]
    for x in part[1:]:
        behind = (kept[-1].end[k] - x.start[k]) * metre
        if behind <= back_m or x.path != kept[-1].path and all(x.id != y.id for y in kept):
            kept.append(x)
    return kept


def near_corridor(line: list, a: tuple, b: tuple, buffer_m: float = 2000.0, samples: int = 20) -> bool:
    """True if any of about 20 samples lies within half the distance of the places plus a buffer from their middle."""
    mid, reach = ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2), _metres(*a, *b) / 2 + buffer_m
    step = max(1, len(line) // samples)
    return any(_metres(*mid, *p) <= reach for p in line[::step])


def plan(a: tuple, b: tuple, paths: dict[int, list], score, most: int = 3, near_m: float = 2000.0) -> list[int]:
    """Ids of up to ``most`` paths chosen one after the other to get from a to b, until within ``near_m`` of b.

    score(points, at, goal): higher is better; a path that doesn't come nearer to the goal isn't chosen.
    """
    out, at, open_ = [], a, dict(paths)
    while len(out) < most and _metres(*at, *b) > near_m:
        best = None
        for k in sorted(open_):
            pts = open_[k]
            if not near_corridor(pts, at, b):
                continue
            exit_ = min(pts, key=lambda p: _metres(*p, *b))
            if _metres(*exit_, *b) >= _metres(*at, *b):
                continue
            s = score(pts, at, b)
            if best is None or s > best[0]:
                best = (s, k, exit_)
        if best is None:
            break
        out.append(best[1])
        at = best[2]
        del open_[best[1]]
    return out


def axis_order(axes: list[tuple[tuple, tuple]], loop: bool = False) -> list[tuple[int, bool]]:
    """(index, turned) of axes (start, end) in an order of small gaps: around the middle for loops, else nearest first;
    then pairs are exchanged while that shortens the gaps."""
    n = len(axes)
    if n < 2:
        return [(i, False) for i in range(n)]
    # tips are numbered 2 i for the start and 2 i + 1 for the end of axis i; all distances are told once
    tips = [p for ax in axes for p in ax]
    far = [[0.0] * len(tips) for _ in tips]
    for x, p in enumerate(tips):
        for y in range(x):
            far[x][y] = far[y][x] = _metres(*tips[y], *p)
    # the tip by which each axis is entered from a tip
    enter = [[2 * i + (d[2 * i + 1] < d[2 * i]) for i in range(n)] for d in far]
    known: dict = {}

    def better(order: list[int]) -> tuple[float, list[int]]:
        """Metres of gaps and the tips by which the axes are entered, from the better tip of the first one."""
        key = tuple(order)
        if key not in known:
            both = []
            for x in (2 * order[0], 2 * order[0] + 1):
                o, steps = [x], []
                for i in order[1:]:
                    d, y = x ^ 1, enter[x ^ 1][i]
                    steps.append(far[d][y])
                    o.append(y)
                    x = y
                both.append((round(sum(steps) + (far[x ^ 1][o[0]] if loop else 0.0), 6), o))
            known[key] = min(both)
        return known[key]

    orders = []
    if loop:
        mids = [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in axes]
        cx, cy = sum(m[0] for m in mids) / n, sum(m[1] for m in mids) / n
        ring = sorted(range(n), key=lambda i: (math.atan2(mids[i][1] - cy, mids[i][0] - cx), i))
        for r in (ring, ring[::-1]):
            orders += [r[k:] + r[:k] for k in range(n)]
    else:
        nearest = [sorted(range(n), key=lambda i, d=d, e=e: (d[e[i]], i)) for d, e in zip(far, enter)]
        for s in range(2 * n):
            order, at = [s // 2], s ^ 1
            while len(order) < n:
                i = next(i for i in nearest[at] if i not in order)
                at = enter[at][i] ^ 1
                order.append(i)
            orders.append(order)
    best = min(better(o) for o in orders)
    improved = True
    while improved:
        improved = False
        for i in range(n):
            for j in range(i + 1, n):
                o = [x // 2 for x in best[1]]
                o[i], o[j] = o[j], o[i]
                c = better(o)
                if c[0] < best[0] - 1e-6:
                    best, improved = c, True
    return [(x // 2, bool(x & 1)) for x in best[1]]


def ordered_paths(pieces: DataFrame, by: str) -> DataFrame:
    """(by, ord, way_id, turned) of pieces (by, way_id, points array<struct<lng,lat>>, oneway), each path for itself."""
    kind = pieces.schema[by].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            own, ords, ids, turned = [], [], [], []
            for i, rows in enumerate(b.column(1).to_pylist()):
                lines = [Line(r["way_id"], [(p["lng"], p["lat"]) for p in r["points"]], r["oneway"]) for r in rows if r["points"]]
                out = order_lines(list({x.id: x for x in lines}.values()))
                own += [i] * len(out)
                ords += range(len(out))
                ids += [x.id for x in out]
                turned += [x.turned for x in out]
            cols = [b.column(0).take(pa.array(own, pa.int64())), pa.array(ords, pa.int32()), pa.array(ids, pa.int64()), pa.array(turned, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, [by, "ord", "way_id", "turned"])

    # a path has few pieces: a row each, as groups cost far more
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = F.collect_list(F.struct(F.col("way_id").cast("long").alias("way_id"), "points", F.coalesce("oneway", F.lit(False)).alias("oneway")))
    return pieces.select(by, "way_id", "points", "oneway").repartition(parts, by).groupBy(by).agg(rows).mapInArrow(run, f"`{by}` {kind}, ord int, way_id bigint, turned boolean")
