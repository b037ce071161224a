"""Items that appear together: a blocked Gram matrix over baskets.

Baskets become rows of a binary sparse matrix X. For blocks of records and pairs of blocks of items, the products
transpose(X_i) X_j are summed: in a task over its record blocks, then by a shuffle of the nonzero sums alone. Counts
are set against the expected ones, n_a n_b / N.

Items that can't be in any result are left out before the products, by bounds that follow from the three conditions
(n_ab is at most n_a): n_a below the least count or the least share, and n_a above N / lift. The second bound also
takes out the items that nearly every basket holds. An item kept holds at least ``1 / share`` of the baskets, so their
number is at most ``share`` times the mean basket: that is why the list of kept items may go to the driver and to
every task. Their number is checked all the same, against callers' larger shares.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import stage

RECORDS = 8192
ITEMS = 1024
#: Nonzero sums a task keeps before it hands them on.
KEEP = 2_000_000
#: Most items that may be kept, as their names are sent to every task.
MOST_ITEMS = 2_000_000


def baskets(df: DataFrame, record: str, items: str) -> DataFrame:
    """(record, items): the distinct non-blank items of each record with at least one, whatever rows they came in."""
    one = df.where(F.col(record).isNotNull()).select(F.col(record).alias("_r"), F.explode(F.array_distinct(items)).alias("_i"))
    one = one.where(F.col("_i").isNotNull() & ~is_blank(F.col("_i")))
    return one.groupBy("_r").agg(F.collect_set("_i").alias("_items"))


def gram_blocks(rows: list, codes: dict[str, int], width: int = ITEMS) -> Iterator[tuple]:
    """(codes a * n + b with a < b, counts) of one block of records, one pair of item blocks at a time."""
    import numpy as np

    n = len(codes)
    own = [np.array([c for x in r if (c := codes.get(x)) is not None], dtype=np.int64) for r in rows]
    own = [r for r in own if len(r) > 1]
    if not own:
        return
    size = np.array([len(r) for r in own])
    rec, item = np.repeat(np.arange(len(own)), size), np.concatenate(own)
    order = np.lexsort((item, item // width, rec))
    order = order[np.argsort(item[order] // width, kind="stable")]  # by item block, then record, then item
    rec, item = rec[order], item[order]
    block = item // width
    cuts = {int(b): (int(lo), int(hi)) for b, lo, hi in zip(*_runs(block))}
    for bi, (i0, i1) in cuts.items():
        for bj, (j0, j1) in cuts.items():
            if bj < bi:
                continue
            # rows of the transposed left block against rows of the right block that share the record
            start = np.searchsorted(rec[j0:j1], rec[i0:i1], "left") + j0
            end = np.searchsorted(rec[j0:j1], rec[i0:i1], "right") + j0
            if bi == bj:
                start = np.maximum(start, np.arange(i0, i1) + 1)
            count = end - start
            total = int(count.sum())
            if not total:
                continue
            left = np.repeat(item[i0:i1], count)
            at = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
            yield np.unique(left * n + item[at], return_counts=True)


def _runs(a):
    import numpy as np

    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    return a[starts], starts, np.r_[starts[1:], len(a)]


def item_pairs(df: DataFrame, record: str, items: str, least: int = 4, share: int = 10_000, lift: int = 3) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n, lift): the pairs with n_ab >= least, share * n_ab >= n, n_ab * n >= lift * n_a * n_b.

    item_a comes first by code point. n counts the records with an item. Null and blank items, null records and empty
    arrays count for nothing; repeated rows of a record count once.
    """
    spark = df.sparkSession
    # the baskets are read for the counts and for the products: they are worked out once
    base = stage(baskets(df, record, items), "baskets")
    # a null beside the items of each basket counts the baskets
    counts = base.select(F.explode(F.concat("_items", F.array(F.lit(None).cast("string")))).alias("_item")).groupBy("_item").agg(F.count("*").alias("_n"))
    counts = stage(counts.where((F.col("_n") >= least) | F.col("_item").isNull()), "counts")
    n = (counts.where("_item is null").first() or [None, 0])[1]
    kept = counts.where(F.col("_item").isNotNull() & (F.col("_n") * share >= n) & (F.col("_n") * lift <= n))
    rows = kept.limit(MOST_ITEMS + 1).collect()
    if len(rows) > MOST_ITEMS:
        raise ValueError(f"more than {MOST_ITEMS} items hold the share; give a smaller one")
    rows.sort(key=lambda r: r["_item"])
    names = spark.createDataFrame([(i, r["_item"], r["_n"]) for i, r in enumerate(rows)], "_id int, _item string, _n bigint")
    codes = spark.sparkContext.broadcast({r["_item"]: i for i, r in enumerate(rows)})
    m = max(1, len(rows))

    def products(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        code, cnt, held = [], [], 0

        def compact():
            nonlocal code, cnt, held
            c, at = np.unique(np.concatenate(code), return_inverse=True)
            code, cnt, held = [c], [np.bincount(at, weights=np.concatenate(cnt)).astype(np.int64)], len(c)

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array((code[0] // m).astype(np.int32)), pa.array((code[0] % m).astype(np.int32)), pa.array(cnt[0])], ["_a", "_b", "_n_ab"]
            )

        for b in batches:
            rows = b.column(0).to_pylist()
            for at in range(0, len(rows), RECORDS):
                for c, k in gram_blocks(rows[at : at + RECORDS], codes.value):
                    code.append(c)
                    cnt.append(k)
                    held += len(c)
                    if held > KEEP:
                        compact()
                        if held > KEEP // 2:
                            yield out()
                            code, cnt, held = [], [], 0
        if code:
            compact()
            yield out()

    gram = base.select("_items").mapInArrow(products, "_a int, _b int, _n_ab bigint").groupBy("_a", "_b").agg(F.sum("_n_ab").alias("_n_ab"))
    side = lambda x: names.select(F.col("_id").alias(f"_{x}"), F.col("_item").alias(f"item_{x}"), F.col("_n").alias(f"n_{x}"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    enough = gram.where((F.col("_n_ab") >= least) & (F.col("_n_ab") * share >= n))
    out = enough.join(F.broadcast(side("a")), "_a").join(F.broadcast(side("b")), "_b")
    out = out.where(big("_n_ab") * F.lit(n).cast("decimal(19,0)") >= big("n_a") * big("n_b") * lift)
    return out.select(
        "item_a", "item_b", F.col("_n_ab").alias("n_ab"), "n_a", "n_b", F.lit(n).cast("long").alias("n"),
        (F.col("_n_ab").cast("double") * n / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
    )


def tag_pairs(routes: DataFrame) -> DataFrame:
    """(tag_a, tag_b, ...) of routes.tags, by the bounds of :func:`item_pairs`."""
    return item_pairs(routes, "route_id", "tags").withColumnsRenamed({"item_a": "tag_a", "item_b": "tag_b"})
