"""Greedy selections as rounds over conflict edges.

"Take rows best first; leave out a row that conflicts with one taken" is the first maximal independent set in rank
order. In rounds: every open row that outranks all its open neighbours is taken, its neighbours are left out. Chains of
ranks decide the number of rounds, not the number of rows; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop, stage
from .graph import components
from .skew import set_overlaps
from .spatial import pairs_within


#: Rounds between two looks at what is left, and edges of a component that one task may settle by itself.
ROUNDS, TASK_EDGES = 6, 200_000


def _settle(e: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(keys left out of the components of at most ``most`` edges, edges of the larger ones), both staged."""
    kind = e.schema["a"].dataType.simpleString()
    own = stage(components(e.select("a").distinct(), e.where("a < b"), "a"), "parts")
    e = e.join(own, "a")
    size = e.groupBy("component").agg(F.count("*").alias("_n"))
    e = stage(e.join(size, "component"), "parted")

    def choose(pdf):
        import pandas as pd

        near: dict = {}
        for a, b in zip(pdf["a"], pdf["b"]):
            near.setdefault(a, []).append(b)
        gone: set = set()
        for a in pdf.sort_values("_place")["a"].drop_duplicates():
            if a not in gone:
                gone.update(near[a])
        return pd.DataFrame({"a": sorted(gone)})

    # ranks may be of any type: their order is what counts
    place = F.dense_rank().over(Window.partitionBy("component").orderBy("ra"))
    few = e.where(F.col("_n") <= most).select("component", "a", "b", place.alias("_place"))
    out = stage(few.groupBy("component").applyInPandas(choose, f"a {kind}"), "gone")
    left = stage(e.where(F.col("_n") > most).drop("component", "_n"), "conflicts")
    drop(own, e)
    return out, left


def keep_best(rows: DataFrame, conflicts: DataFrame, key: str, rank: Column, rounds: int = ROUNDS, task_edges: int = TASK_EDGES) -> DataFrame:
    """The rows taken. conflicts: (a, b) of keys in either order. rank: smaller is better; ties by the key.

    After every ``rounds`` rounds the components still open that have at most ``task_edges`` edges are settled in a
    task each, in rank order; larger ones go on in rounds, as many as they need. The choice is the same either way.
    """
    r = rows.select(F.col(key).alias("_k"), F.struct(rank.alias("r"), F.col(key).alias("k")).alias("_r"))
    e = conflicts.select("a", "b").where("a <> b")
    e = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = e.join(r.select(F.col("_k").alias("a"), F.col("_r").alias("ra")), "a").join(r.select(F.col("_k").alias("b"), F.col("_r").alias("rb")), "b")
    e = stage(e, "conflicts")
    out, n = None, 0
    while not e.isEmpty():
        n += 1
        if n % rounds == 0:
            gone, left = _settle(e, task_edges)
            out = gone if out is None else out.unionAll(gone)
            drop(e)
            e = left
            continue
        # taken now: nodes whose best open neighbour is worse than they are
        taken = e.groupBy("a").agg(F.min("rb").alias("m"), F.first("ra").alias("ra")).where(F.col("ra") < F.col("m")).select("a")
        gone = stage(e.join(taken, "a", "left_semi").select(F.col("b").alias("a")).distinct(), "gone")
        out = gone if out is None else out.unionAll(gone)
        done = stage(taken.unionAll(gone).distinct(), "done")
        old, e = e, stage(e.join(done, "a", "left_anti").join(done.withColumnRenamed("a", "b"), "b", "left_anti"), "conflicts")
        drop(old, done)
    return rows if out is None else rows.join(out.withColumnRenamed("a", key), key, "left_anti")


def without_repeats(points: DataFrame, key: str, name: str, radius_m: float, rank: Column) -> DataFrame:
    """Points (key, name, lng, lat) without those near a better one of the same name, upper and lower case alike."""
    p = pairs_within(points, key, radius_m)
    n = points.select(F.col(key), F.lower(name).alias("_n"))
    same = p.join(n.withColumnsRenamed({key: "a", "_n": "_na"}), "a").join(n.withColumnsRenamed({key: "b", "_n": "_nb"}), "b").where("_na = _nb")
    return keep_best(points, same, key, rank)


def cluster(points: DataFrame, key: str, radius_m: float, rank: Column) -> DataFrame:
    """(key, centre): the best open point takes all open points within the radius, itself included, and so on."""
    near = stage(pairs_within(points, key, radius_m), "near")
    centres = stage(keep_best(points, near, key, rank).select(F.col(key), rank.alias("_r")), "centres")
    both = near.select("a", "b").unionAll(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    reach = both.join(centres.withColumnRenamed(key, "a"), "a").groupBy("b").agg(F.min(F.struct("_r", "a")).alias("_c"))
    reach = reach.select(F.col("b").alias(key), F.col("_c.a").alias("_by")).join(centres.select(key), key, "left_anti")
    return points.select(key).join(reach, key, "left").select(key, F.coalesce("_by", key).alias("centre"))


def cluster_report(points: DataFrame, clusters: DataFrame, key: str, kind: str) -> DataFrame:
    """(centre, members, kinds, bonus): a bonus of up to 3 for kinds and up to 3 for members beyond the first."""
    j = points.select(key, kind).join(clusters, key)
    g = j.groupBy("centre").agg(F.count("*").alias("members"), F.count_distinct(kind).alias("kinds"))
    return g.withColumn("bonus", F.least(F.greatest(F.col("kinds") - 1, F.lit(0)), F.lit(3)) + F.least(F.col("members") - 1, F.lit(3)))


def set_conflicts(rows: DataFrame, key: str, items: str, more_than: float) -> DataFrame:
    """(a, b) with a < b whose item sets share more than that part of the smaller set."""
    return set_overlaps(rows, key, items, more_than).select("a", "b")


def select_diverse(rows: DataFrame, conflicts: DataFrame, key: str, group: str, score: str, caps: dict[str, int], limit: int) -> DataFrame:
    """(key, group, place): best first, skipping conflicts, also with rows of other groups, and rows whose value in a
    capped column is used up in their group; at most ``limit`` rows a group.

    caps: column to number of rows a value may have; array columns count each element. Every choice bears on the later
    ones, so the groups that conflicts connect are one ordered stream in one task. It passes by in batches: what a task
    holds are the rows taken and the values used, not the rows it looks at, however many they are.
    """
    cols = [key, group, score, *caps]
    own = rows.select(key, group)
    across = conflicts.join(own.withColumnsRenamed({key: "a", group: "_ga"}), "a").join(own.withColumnsRenamed({key: "b", group: "_gb"}), "b").where("_ga <> _gb")
    parts = stage(components(rows, across.select(F.col("_ga").alias("a"), F.col("_gb").alias("b")), group).withColumnRenamed("component", "_part"), "parts")
    near = conflicts.select("a", "b").unionAll(conflicts.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.collect_set("b").alias("_near"))
    src = rows.select(*cols).join(parts, group).join(near.withColumnRenamed("a", key), key, "left")
    src = src.repartition("_part").sortWithinPartitions("_part", F.col(score).desc(), key)
    kk, gk = (rows.schema[c].dataType.simpleString() for c in (key, group))

    def choose(batches):
        import pandas as pd

        part, used, full, taken = None, {}, {}, set()
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                if row["_part"] != part:
                    part, used, full, taken = row["_part"], {}, {}, set()
                near, g = row["_near"], row[group]
                if full.get(g, 0) == limit or near is not None and taken.intersection(near):
                    continue
                values = {c: list(row[c]) if hasattr(row[c], "__len__") and not isinstance(row[c], str) else [row[c]] for c in caps if row[c] is not None}
                if any(used.get((g, c, v), 0) >= caps[c] for c, vs in values.items() for v in vs):
                    continue
                for c, vs in values.items():
                    for v in vs:
                        used[g, c, v] = used.get((g, c, v), 0) + 1
                taken.add(row[key])
                full[g] = full.get(g, 0) + 1
                out.append((row[key], g, full[g]))
            yield pd.DataFrame(out, columns=[key, group, "place"])

    return src.mapInPandas(choose, f"`{key}` {kk}, `{group}` {gk}, place int")


def top_groups(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows by a total order: a top-k report, planned as one."""
    return rows.orderBy(*order).limit(n)


def fraction_near(a: DataFrame, b: DataFrame, radius_m: float) -> DataFrame:
    """(a, b, share): of the points of each line a (line, ord, lng, lat), the share near any point of each line b that
    comes within the radius at all."""
    from .nearby import within

    p = a.select(F.col("line").alias("a"), "ord", "lng", "lat")
    q = b.select(F.col("line").alias("b"), F.col("lng").alias("_x"), F.col("lat").alias("_y"))
    hit = within(p, q, radius_m, ["a", "ord"], centre_xy=("_x", "_y")).where("a <> b").select("a", "b", "ord").distinct()
    n = p.groupBy("a").agg(F.count("*").alias("_n"))
    return hit.groupBy("a", "b").agg(F.count("*").alias("_k")).join(n, "a").select("a", "b", (F.col("_k") / F.col("_n")).alias("share"))


def overlapping(lines: DataFrame, radius_m: float = 30.0, share: float = 0.5) -> DataFrame:
    """(a, b) with a < b where either line runs along the other for that share of its points."""
    f = fraction_near(lines, lines, radius_m).where(F.col("share") >= share)
    return f.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def best_per(rows: DataFrame, by: str, *order: Column) -> DataFrame:
    """The first row of each key in a total order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where("_n = 1").drop("_n")
