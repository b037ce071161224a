"""Joins that keep their speed when a few keys hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: Rows a part of a hot key should hold; keys with more are hot.
SALT_ROWS = 50_000
#: Most keys that may be hot: the size of a part grows with the table once there could be more, so that the list stays small.
HOT_KEYS = 100_000


#: One row key in this many is counted to tell the hot keys.
COUNTED = 16


def hot_keys(df: DataFrame, keys: list[str], row_key: list[str], rows: int = SALT_ROWS, most: int = HOT_KEYS) -> DataFrame:
    """(keys..., _salts): the hot keys and into how many parts each is to be split.

    A key is hot if it has more than ``rows`` rows, and more than one row in ``most``: a part of a table of 1e11 rows
    holds a million. By that rule there are never more than ``most`` result rows, so the result may be broadcast.

    Row numbers are estimates, from the rows of one in COUNTED row keys by their hash: the same ones whenever they are
    counted. They decide how a join is split and nothing else: what it gives is the same for any list of hot keys.
    """
    share = COUNTED if rows >= COUNTED * 100 else 1
    counted = df if share == 1 else df.where(F.pmod(F.xxhash64(F.lit("counted"), *row_key), F.lit(share)) == 0)
    n = counted.groupBy(*keys).agg((F.count("*") * share).alias("_n"))
    total = n.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_all"))
    part = F.greatest(F.lit(float(rows)), F.col("_all") / most)
    return n.where(F.col("_n") > rows).join(F.broadcast(total), F.col("_n") > part).select(*keys, F.ceil(F.col("_n") / part).cast("int").alias("_salts"))


#: Parts that rows with a null key are spread over where they stay in the result.
NULL_PARTS = 1000


def salted_join(
    big: DataFrame, other: DataFrame, keys: list[str], row_key: list[str], on=None, rows: int = SALT_ROWS, how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` (and condition ``on``), with the hot keys of ``big`` split by a hash of ``row_key``.

    Every part of a hot key meets a copy of that key's rows of ``other``; no row is lost or repeated. Null keys match
    nothing. how: inner, left, left_semi or left_anti; ``on`` goes with inner alone.
    """
    hot = hot_keys(big, keys, row_key, rows)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    parts = salts
    if how != "inner":
        parts = F.when(F.greatest(*(F.col(k).isNull().cast("int") for k in keys), F.lit(0)) > 0, F.lit(NULL_PARTS)).otherwise(salts)
    a = big.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*row_key), parts).cast("int")).drop("_salts")
    b = other.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    j = a.join(b, [*keys, "_salt"], how).drop("_salt")
    return j if on is None else j.where(on)


def numbered(df: DataFrame, key: str, order: Column, out: str) -> DataFrame:
    """Adds ``out``: the place of each row among the rows of its key, by an order that tells them apart, from 1.

    Rows are cut into ranges of (key, order), so a key with any share of all rows is spread over the tasks; the places
    in a range are raised by the rows of the key in the ranges before. Rows with a null key have no place.
    """
    p = stage(df.withColumn("_order", order).repartitionByRange(key, "_order").withColumn("_range", F.spark_partition_id()), "ranges")
    n = p.where(F.col(key).isNotNull()).groupBy(key, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    n = n.select(key, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(key, "_range").orderBy("_order"))
    j = p.withColumn("_place", place).join(n, [key, "_range"], "left")
    return j.select(*df.columns, (F.col("_place") + F.col("_before")).alias(out))


def set_overlaps(rows: DataFrame, key: str, items: str, more_than: float) -> DataFrame:
    """(a, b, share) with a < b of rows whose item sets share more than ``more_than`` of the smaller set.

    The items of each set are ordered from the rarest. Two sets that share enough have in common one of the first items
    of the smaller one: as many as may be missing, and one more. So sets meet only over those, hardly ever over the
    items that nearly all rows hold, and what meets is counted exactly. Nulls among the items count for nothing.
    """
    x = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.explode(F.array_distinct(items)).alias("_i")).where("_i is not null").distinct()
    known = salted_join(x, x.groupBy("_i").agg(F.count("*").alias("_f")), ["_i"], ["_k"])
    sets = stage(known.groupBy("_k").agg(F.sort_array(F.collect_list(F.struct("_f", "_i"))).alias("_s")).withColumn("_n", F.size("_s")), "sets")
    head = F.slice("_s", 1, F.col("_n") - F.floor(F.col("_n") * more_than - 1e-9).cast("int"))
    small = sets.select("_k", "_n", F.explode(head).alias("_e")).select("_k", "_n", F.col("_e._i").alias("_i"))
    full = sets.select(F.col("_k").alias("_o"), F.col("_n").alias("_no"), F.explode("_s").alias("_e")).select("_o", "_no", F.col("_e._i").alias("_i"))
    met = salted_join(full, small, ["_i"], ["_o"], on=(F.col("_n") < F.col("_no")) | ((F.col("_n") == F.col("_no")) & (F.col("_k") < F.col("_o"))))
    met = met.select("_k", "_o", "_n").distinct()
    plain = lambda c: F.transform(c, lambda e: e["_i"])
    j = met.join(sets.select("_k", plain("_s").alias("_a")), "_k").join(sets.select(F.col("_k").alias("_o"), plain("_s").alias("_b")), "_o")
    j = j.withColumn("share", F.size(F.array_intersect("_a", "_b")) / F.col("_n")).where(F.col("share") > more_than)
    return j.select(F.least("_k", "_o").alias("a"), F.greatest("_k", "_o").alias("b"), "share")
