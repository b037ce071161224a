"""Probabilistic record linkage of surveyed stretches and OSM ways, which share no key.

1. Blocking in two passes. The first: cells of the ground that the way touches and the feature comes near to, where both
   run alike; its pairs count up to NEAR_M apart. The second: the words of the name in common, in larger cells; its pairs
   count up to REACH_M apart, where only the name makes them likely. A pair found by both counts once.
2. Agreement levels of each pair: name, town, distance between the lines, share of the shorter line run along, and
   whether the feature runs along another way much nearer.
3. Expectation-maximisation over the counts of level patterns gives, for each level, its probability among matches
   and among the others. The patterns are at most the product of the levels, so their counts may go to the driver.
4. The posterior of a pair's pattern is its confidence. Lines that don't run along each other for a tenth of the
   shorter can't be the same stretch: their confidence is 0, and they don't bear on the estimates.

What is defined here: repeated deliveries count once; should they differ, the pair that runs along most counts. A record without a usable line (two different points on earth)
has no pair. Of coordinates with more than two numbers the first two count; other malformed points are left out. A
missing name or town says nothing for or against a pair. A way without any cycling tag is no bike facility.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import DEGREE_M, on_earth
from ..operators.skew import salted_join
from ..session import stage
from .names import likeness, name_key, town_key, with_name_words

#: Metres within which two lines can be the same facility, with and without the words of the name in common.
REACH_M, NEAR_M = 45.0, 32.0
CELL_DEG = 0.001
#: Stored units of one degree.
UNITS = 1e7
#: Added to cell indices so that they are positive; they take 20 bits then.
HALF = 1 << 19
#: Sectors of the half circle of directions, and how many apart two that go the same way (:data:`ALIKE`) can be.
SECTORS, SECTORS_APART = 8, 2
#: Cosine of the angle up to which parts of lines go the same way.
ALIKE = 0.85
PIECE_M = 120.0
STEP_M = 10.0
#: Upper bounds in metres of the levels of distance.
OFFSET_LEVELS = (4.0, 8.0, 12.0, 16.0, 20.0, 24.0, NEAR_M, REACH_M)
#: Metres by which another way must be nearer to be a rival.
RIVAL_M = 8.0
#: Lower bounds of the levels of the share run along.
SHARE_LEVELS = (0.9, 0.7, 0.5, 0.1)
NAME_LEVELS = (0.999, 0.8, 0.6)
TOWN_LEVELS = (0.75,)
#: Elements of the products of sample points and line parts handled at a time.
WORK = 400_000


def cycling(tags: Column) -> Column:
    """True for ways with any cycling tag that doesn't deny cycling."""
    lanes = F.exists(
        F.map_entries(tags),
        lambda e: e["key"].rlike("^(cycleway|sidewalk)(:(left|right|both))?(:bicycle)?$") & e["key"].contains("cycl") & ~F.lower(e["value"]).isin("no", "none", "separate"),
    )
    allowed = F.lower(F.try_element_at(tags, F.lit("bicycle"))).isin("yes", "designated", "permissive", "official")
    yes = lambda c: F.coalesce(c, F.lit(False))
    return yes(F.try_element_at(tags, F.lit("highway")) == "cycleway") | yes(lanes) | yes(allowed)


def _parts(line: Column, x: str, y: str) -> Column:
    """Consecutive points of one line as array<array(x1,y1,x2,y2)>."""
    n = F.size(line)
    a, b = F.slice(line, 1, F.greatest(n - 1, F.lit(0))), F.slice(line, 2, F.greatest(n - 1, F.lit(0)))
    return F.zip_with(a, b, lambda p, q: F.array(p[x], p[y], q[x], q[y]))


def _stored(parts: Column) -> Column:
    """Parts as they are stored and shuffled: (x1,y1,x2,y2) in whole units of 1e-7 degrees (about a centimetre)."""
    whole = F.transform(parts, lambda s: F.transform(s, lambda v: F.floor(v * UNITS + 0.5).cast("int")))
    return F.filter(whole, lambda s: (s[0] != s[2]) | (s[1] != s[3]))


def _packed(parts: Column) -> Column:
    """Stored parts as one array x,y,dx,dy,...: the ends as differences, which are small and pack well."""
    return F.flatten(F.transform(parts, lambda s: F.array(s[0], s[1], s[2] - s[0], s[3] - s[1])))


def survey_lines(catastro: DataFrame) -> DataFrame:
    """(feature_id, words, town, line, cells) of the records with a geometry, a row for each row.

    Records without a usable line come out with an empty line and no cells; :func:`link` leaves them out.
    """
    pair = lambda p: F.struct(F.try_element_at(p, F.lit(1)).alias("x"), F.try_element_at(p, F.lit(2)).alias("y"))
    lines = F.transform(
        F.filter(F.col("geometry.coordinates"), lambda ln: ln.isNotNull()),
        lambda ln: F.filter(F.transform(ln, pair), lambda p: on_earth(p["x"], p["y"])),
    )
    parts = F.flatten(F.transform(lines, lambda ln: _parts(ln, "x", "y")))
    df = catastro.where(F.col("feature_id").isNotNull() & F.col("geometry").isNotNull())
    df = with_name_words(df, "nombre", "words").withColumn("_stored", _stored(parts))
    return df.select("feature_id", "words", town_key(F.col("comuna")).alias("town"), _packed(F.col("_stored")).alias("line"), _cells(F.col("_stored"), REACH_M).alias("cells"))


def way_lines(ways: DataFrame) -> DataFrame:
    """(way_id, words, town, line, cells) of the ways with a cycling tag and any geometry, a row for each row."""
    line = F.filter("geometry", lambda p: on_earth(p["lon"], p["lat"]))
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    df = ways.where(F.col("way_id").isNotNull() & F.col("geometry").isNotNull() & cycling(F.col("tags")))
    df = with_name_words(df.withColumn("_name", F.coalesce(tag("name"), tag("official_name"))), "_name", "words")
    town = town_key(F.coalesce(tag("is_in:city"), tag("addr:city")))
    df = df.withColumn("_stored", _stored(_parts(line, "lon", "lat")))
    return df.select("way_id", "words", town.alias("town"), _packed(F.col("_stored")).alias("line"), _cells(F.col("_stored"), 0.0).alias("cells"))


def _cells(parts: Column, reach_m: float) -> Column:
    """Distinct (ground cell, sector of direction) of the boxes around the line's parts, widened by ``reach_m``, as numbers:
    x in 20 bits, y in 20, sector in 4.

    Parts over PIECE_M are cut first, so that the boxes stay close to the line. Any two lines with points that close,
    going the same way there, have a cell in common with sectors at most SECTORS_APART, if one of them is widened.
    """
    degrees = F.transform(parts, lambda s: F.transform(s, lambda v: v / UNITS))
    dy = reach_m / DEGREE_M
    at = lambda v: F.floor(v / CELL_DEG).cast("long")

    def boxes(s: Column) -> Column:
        n = F.greatest(F.ceil(F.greatest(F.abs(s[2] - s[0]), F.abs(s[3] - s[1])) * (DEGREE_M / PIECE_M)), F.lit(1)).cast("int")
        cut = lambda i, k: s[i] + (s[i + 2] - s[i]) * k / n
        piece = lambda k: F.array(cut(0, k), cut(1, k), cut(0, k + 1), cut(1, k + 1))
        return F.when(n == 1, F.array(s)).otherwise(F.transform(F.sequence(F.lit(0), n - 1), piece))

    def touched(b: Column) -> Column:
        east = F.greatest(F.cos(F.radians(b[1])), F.lit(0.01))
        dx = F.lit(dy) / east if reach_m else F.lit(0.0)
        xs = F.sequence(at(F.least(b[0], b[2]) - dx), at(F.greatest(b[0], b[2]) + dx))
        ys = F.sequence(at(F.least(b[1], b[3]) - dy), at(F.greatest(b[1], b[3]) + dy))
        turn = F.pmod(F.atan2(b[3] - b[1], (b[2] - b[0]) * east), F.lit(math.pi))
        sector = F.least(F.floor(turn * (SECTORS / math.pi)), F.lit(SECTORS - 1)).cast("long")
        return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.shiftleft(x + HALF, 24) + F.shiftleft(y + HALF, 4) + sector)))

    return F.array_distinct(F.flatten(F.transform(F.flatten(F.transform(degrees, boxes)), touched)))


def candidate_pairs(features: DataFrame, ways: DataFrame) -> DataFrame:
    """Distinct (feature_id, way_id, named) of both blocking passes; ``named`` is true for pairs of the second.

    Both passes are one join on numbers (the cell, or a hash of name and block), so that keys that hold many features are
    told and split once. Two names of one hash would only bring pairs together that are compared and found apart.
    """
    # blocks of 4 by 4 cells for the second pass
    blocks = F.array_distinct(F.transform("cells", lambda c: c.bitwiseAND(F.lit(~0x300003F))))

    def side(df: DataFrame, key: str, sector: str) -> DataFrame:
        by_cell = df.select(key, F.explode("cells").alias("_c")).select(key, F.shiftright("_c", 4).alias("_key"), F.col("_c").bitwiseAND(F.lit(15)).cast("byte").alias(sector))
        by_name = df.where("words is not null").select(key, name_key(F.col("words")).alias("_name"), F.explode(blocks).alias("_c"))
        return by_cell.unionAll(by_name.select(key, F.xxhash64("_name", "_c"), F.lit(SECTORS).cast("byte")))

    apart = F.abs(F.col("_sf") - F.col("_sw"))
    alike = (F.col("_sf") < SECTORS) & (F.col("_sw") < SECTORS) & (F.least(apart, SECTORS - apart) <= SECTORS_APART)
    by_word = (F.col("_sf") == SECTORS) & (F.col("_sw") == SECTORS)
    met = salted_join(side(features, "feature_id", "_sf"), side(ways, "way_id", "_sw"), ["_key"], ["feature_id"], on=alike | by_word)
    return met.groupBy("feature_id", "way_id").agg(F.max(F.col("_sf") == SECTORS).alias("named"))


def run_along(f_parts, w_parts, reach):
    """For pairs of lines: (share of the shorter that runs along the other within its reach, mean distance there or nan).

    f_parts, w_parts: lists of flat arrays x,y,dx,dy,... in stored units; reach: metres for each pair. Points every
    STEP_M of the first line are measured against all parts of the second; a point counts if the nearest part that it
    lies beside goes its way.
    """
    import numpy as np

    n = len(f_parts)
    nf, nw = (np.array([len(p) // 4 for p in ps]) for ps in (f_parts, w_parts))
    fa, wa = (np.concatenate(ps).reshape(-1, 4) / UNITS if sum(map(len, ps)) else np.zeros((0, 4)) for ps in (f_parts, w_parts))
    for a in (fa, wa):
        a[:, 2:] += a[:, :2]
    lat = np.array([p[1] for p in f_parts]) / UNITS
    east = DEGREE_M * np.cos(np.radians(lat))
    lng = np.array([p[0] for p in f_parts]) / UNITS

    def metres(a, count):
        own = np.repeat(np.arange(n), count)
        m = np.empty_like(a)
        m[:, 0::2] = (a[:, 0::2] - lng[own, None]) * east[own, None]
        m[:, 1::2] = (a[:, 1::2] - lat[own, None]) * DEGREE_M
        size = np.hypot(m[:, 2] - m[:, 0], m[:, 3] - m[:, 1])
        return own, m, size

    f_own, f, f_len = metres(fa, nf)
    w_own, w, w_len = metres(wa, nw)
    total_f, total_w = np.bincount(f_own, f_len, n), np.bincount(w_own, w_len, n)
    k = np.maximum(1, np.round(f_len / STEP_M).astype(int))
    of = np.repeat(np.arange(len(f)), k)
    t = (np.arange(len(of)) - np.repeat(np.cumsum(k) - k, k) + 0.5) / k[of]
    px, py = f[of, 0] + t * (f[of, 2] - f[of, 0]), f[of, 1] + t * (f[of, 3] - f[of, 1])
    ux, uy = ((f[:, 2] - f[:, 0]) / f_len)[of], ((f[:, 3] - f[:, 1]) / f_len)[of]
    weight, own = (f_len / k)[of], f_own[of]
    first = np.cumsum(nw) - nw
    count = nw[own]
    near = np.full(len(of), np.inf)
    ends = np.cumsum(count)
    at = 0
    while at < len(of):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WORK)))
        c = count[at:to]
        s = np.repeat(np.arange(at, to), c)
        starts = np.cumsum(c) - c
        j = np.arange(len(s)) - np.repeat(starts, c) + np.repeat(first[own[at:to]], c)
        vx, vy = w[j, 2] - w[j, 0], w[j, 3] - w[j, 1]
        size = np.maximum(w_len[j], 1e-9)
        qx, qy = px[s] - w[j, 0], py[s] - w[j, 1]
        r = (qx * vx + qy * vy) / size
        off = np.abs(qx * vy - qy * vx) / size
        over = np.maximum(np.maximum(-r, r - size), 0)
        beside = (over <= STEP_M) & (off <= reach[own[s]]) & (np.abs(ux[s] * vx + uy[s] * vy) >= ALIKE * size)
        near[at:to] = np.minimum.reduceat(np.where(beside, off, np.inf), starts)
        at = to
    hit = np.isfinite(near)
    covered = np.bincount(own, np.where(hit, weight, 0), n)
    with np.errstate(invalid="ignore", divide="ignore"):
        offset = np.bincount(own, np.where(hit, near, 0) * weight, n) / covered
        share = np.minimum(covered / np.minimum(total_f, total_w), 1.0)
    return share, offset, total_f, total_w


def compare(pairs: DataFrame, features: DataFrame, ways: DataFrame) -> DataFrame:
    """Each pair with (name_sim, town_sim, share, offset_m); pairs of repeated deliveries as often as those are there."""
    f = features.select("feature_id", F.col("words").alias("_fw"), F.col("town").alias("_ft"), F.col("line").alias("_fp"))
    w = ways.select("way_id", F.col("words").alias("_ww"), F.col("town").alias("_wt"), F.col("line").alias("_wp"))
    j = pairs.join(f, "feature_id").join(w, "way_id")
    straight = likeness(F.array_join("_fw", " "), F.array_join("_ww", " "))
    name = F.greatest(straight, likeness(name_key(F.col("_fw")), name_key(F.col("_ww"))))
    j = j.select("feature_id", "way_id", name.alias("name_sim"), likeness(F.col("_ft"), F.col("_wt")).alias("town_sim"), "named", "_fp", "_wp")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            fp, wp = ([x.values.to_numpy(zero_copy_only=False) for x in b.column(c)] for c in (5, 6))
            reach = np.where(b.column(4).to_numpy(zero_copy_only=False).astype(bool), REACH_M, NEAR_M)
            share, offset, *_ = run_along(fp, wp, reach)
            num = lambda a: pa.array(np.where(np.isfinite(a), a, np.nan), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], num(share), num(offset)], ["feature_id", "way_id", "name_sim", "town_sim", "share", "offset_m"])

    return j.mapInArrow(run, "feature_id bigint, way_id bigint, name_sim double, town_sim double, share double, offset_m double")


def _level_down(c: Column, bounds: tuple[float, ...]) -> Column:
    """0 if null, 1 for values from bounds[0], 2 from bounds[1], ...; one more below the last."""
    out = F.lit(len(bounds) + 1)
    for i, b in reversed(list(enumerate(bounds, 1))):
        out = F.when(c >= b, i).otherwise(out)
    return F.when(c.isNull(), 0).otherwise(out)


def _level_up(c: Column, bounds: tuple[float, ...]) -> Column:
    out = F.lit(len(bounds) + 1)
    for i, b in reversed(list(enumerate(bounds, 1))):
        out = F.when(c < b, i).otherwise(out)
    return F.when(c.isNull(), 0).otherwise(out)


def with_levels(compared: DataFrame) -> DataFrame:
    """(feature_id, way_id, share, offset_m, levels...), each pair once. A pair has a rival if the feature runs along half
    of another way and much nearer."""
    # both windows are by feature: the second needs no other exchange
    best = F.row_number().over(Window.partitionBy("feature_id", "way_id").orderBy(F.col("share").desc_nulls_last(), F.col("offset_m").asc_nulls_last(), F.col("name_sim").desc_nulls_last()))
    nearest = F.min(F.when(F.col("share") >= 0.5, F.col("offset_m"))).over(Window.partitionBy("feature_id"))
    compared = compared.withColumn("_nearest", nearest).withColumn("_best", best).where("_best = 1")
    rival = F.coalesce(F.col("_nearest") + RIVAL_M < F.col("offset_m"), F.lit(False))
    level = {
        "l_rival": F.when(rival, 2).otherwise(1),
        "l_name": _level_down(F.col("name_sim"), NAME_LEVELS), "l_town": _level_down(F.col("town_sim"), TOWN_LEVELS),
        "l_share": _level_down(F.coalesce("share", F.lit(0.0)), SHARE_LEVELS), "l_offset": _level_up(F.col("offset_m"), OFFSET_LEVELS),
    }
    return compared.select("feature_id", "way_id", "share", "offset_m", *(v.cast("int").alias(k) for k, v in level.items()))


LEVELS = ("l_name", "l_town", "l_share", "l_offset", "l_rival")


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], start, rounds: int = 200, eps: float = 1e-7):
    """Posterior of a match for each pattern of levels, level 0 meaning no evidence.

    start: first guess of the posterior for each pattern. Returns (posteriors, share of matches, m, u).
    """
    import numpy as np

    if not patterns:
        return [], 0.0, [], []
    lv = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], dtype=float)
    g = np.array(start, dtype=float)
    top = lv.max(0) + 1
    for _ in range(rounds):
        share = float((g * n).sum() / n.sum())
        tables = []
        for weight in (g * n, (1 - g) * n):
            t = []
            for k, size in enumerate(top):
                c = np.bincount(lv[:, k], weight, size) + 0.5  # half a pair in each level: none is impossible
                c[0] = 0
                t.append(c / max(c.sum(), 1e-9))
            tables.append(t)
        odds = np.full(len(lv), math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        for k in range(len(top)):
            seen = lv[:, k] > 0
            odds[seen] += np.log(tables[0][k][lv[seen, k]] / tables[1][k][lv[seen, k]])
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(new - g).max() < eps:
            g = new
            break
        g = new
    return g.tolist(), share, *tables


def _first_guess(p: tuple[int, ...]) -> float:
    name, _, share, offset, _ = p
    same = share in (1, 2, 3) and 0 < offset <= 4 and name in (0, 1, 2)
    return 0.95 if same else 0.05


def link(catastro: DataFrame, ways: DataFrame) -> DataFrame:
    """(feature_id, way_id, confidence, share, offset_m) of all candidate pairs."""
    f, w = (stage(df, name).where(F.size("line") > 0) for df, name in ((survey_lines(catastro), "features"), (way_lines(ways), "ways")))
    pairs = stage(with_levels(compare(candidate_pairs(f, w), f, w)), "pairs")
    along = F.col("l_share") <= len(SHARE_LEVELS)
    rows = pairs.where(along).groupBy(*LEVELS).count().orderBy(*LEVELS).collect()
    patterns = [(tuple(r[k] for k in LEVELS), r["count"]) for r in rows]
    post, *_ = expectation_maximisation(patterns, [_first_guess(p) for p, _ in patterns])
    known = [(*p, g) for (p, _), g in zip(patterns, post)]
    table = catastro.sparkSession.createDataFrame(known, ", ".join(f"{k} int" for k in LEVELS) + ", confidence double")
    out = pairs.join(F.broadcast(table), list(LEVELS), "left").drop(*LEVELS)
    return out.withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


def same_facilities(catastro: DataFrame, ways: DataFrame, least: float = 0.5) -> DataFrame:
    """The pairs of :func:`link` with at least this confidence that share at least half of the shorter line."""
    return link(catastro, ways).where((F.col("confidence") >= least) & (F.col("share") >= 0.5))
