"""Filling containers of a fixed capacity with items, by best-two-fit.

Items are spread over shards by a hash of their key; each shard is packed for itself, so no task ever holds more than
about ``SHARD_ITEMS`` items, and a shard wastes at most one container's space more than one packing of everything would.
Within a shard a container is filled greedily, largest fitting item first. If space is left, its smallest item is
replaced with the two unpacked items that together fill the widened gap best, if those fill more than it did.

An item larger than the capacity is cut into full containers and a rest that is packed like an item. An item of size
null, zero or less takes no space and goes to the first container of its shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenize import count_tokens

CAPACITY = 2048
#: Items a shard should hold.
SHARD_ITEMS = 20_000
#: Copies of one row that are numbered at a time.
COPIES = 10_000


def best_two_fit(sizes: list[int], capacity: int) -> list[int]:
    """Container number of each item; sizes from 1 to ``capacity``.

    Sizes in stock are the bits of one integer, so "the largest not above x" is one mask and one bit length.
    """
    stock: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), key=lambda i: -i):
        stock.setdefault(sizes[i], []).append(i)
    have = sum(1 << s for s in stock)
    place, n = [0] * len(sizes), 0

    def largest(limit: int) -> int:
        """Largest size in stock up to ``limit``, 0 if none."""
        return (have & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 and have & ((1 << (limit + 1)) - 1) else 0

    def take(s: int) -> int:
        nonlocal have
        i = stock[s].pop()
        if not stock[s]:
            have &= ~(1 << s)
        return i

    while have:
        inside: list[tuple[int, int]] = []
        gap = capacity
        while s := largest(gap):
            inside.append((s, take(s)))
            gap -= s
        if gap and have:
            small, i = inside[-1]  # taken in falling order
            room, best = gap + small, (small, 0, 0)
            a = largest(room - 1)
            while a * 2 >= best[0] and a:  # a is the larger of the two
                b = largest(min(room - a, a))
                if b == a and len(stock[a]) < 2:
                    b = largest(a - 1)
                if b and a + b > best[0]:
                    best = (a + b, a, b)
                    if a + b == room:
                        break
                a = largest(a - 1)
            if best[1]:
                inside.pop()
                stock.setdefault(small, []).append(i)
                have |= 1 << small
                inside += [(best[1], take(best[1])), (best[2], take(best[2]))]
        for _, i in inside:
            place[i] = n
        n += 1
    return place


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, count: int | None = None) -> DataFrame:
    """(key, piece, size, container): every row of ``items`` once, cut rows once for each piece. The containers depend on
    the rows alone, not on their order or the files they come in.

    ``count`` is the number of rows, if the caller has it cheaper than by a scan. Rows of the same key and size are
    apart: each is packed.
    """
    n = items.count() if count is None else count
    shards = max(1, -(-n // shard_items))
    s = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    # equal rows are counted and numbered, so that copies spread over the shards, alike however the table is split
    base = items.groupBy(F.col(key).alias("_k"), s.alias("_s")).agg(F.count("*").alias("_copies"))
    base = base.withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(COPIES))))
    base = base.withColumn("_copy", F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES, F.col("_copies")) - 1)))
    base = base.withColumn("_shard", F.pmod(F.xxhash64("_k", "_s", "_copy"), F.lit(shards)).cast("int"))
    full = F.floor((F.greatest(F.col("_s"), F.lit(1)) - 1) / capacity).cast("int")
    pieces = base.select("_shard", "_k", "_s", F.explode(F.sequence(F.lit(0), full)).alias("_piece"))
    pieces = pieces.select("_shard", "_k", "_piece", F.least(F.col("_s") - F.col("_piece") * capacity, F.lit(capacity)).cast("int").alias("_n"))
    kind = items.schema[key].dataType.simpleString()

    def run(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["_k", "_piece", "_n"], kind="stable", ignore_index=True)
        where = np.zeros(len(pdf), dtype=np.int64)
        real = np.flatnonzero(pdf["_n"].to_numpy() > 0)
        where[real] = best_two_fit(pdf["_n"].to_numpy()[real].tolist(), capacity)
        return pd.DataFrame({key: pdf["_k"], "piece": pdf["_piece"], size: pdf["_n"], "container": (int(pdf["_shard"].iloc[0]) << 32) + where})

    return pieces.groupBy("_shard").applyInPandas(run, f"`{key}` {kind}, piece int, `{size}` int, container bigint")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocab: str | None = None) -> DataFrame:
    """(doc_id, piece, n_tokens, container) of every document, sizes in tokens of the public tokenizer."""
    return pack(count_tokens(docs, key, text, vocab), key, "n_tokens", capacity, count=docs.count())


def fill_report(packed: DataFrame, size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """(containers, pieces, tokens, least_possible, unused_share): how tight a packing is."""
    by = packed.groupBy("container").agg(F.sum(size).alias("_t"), F.count("*").alias("_n"))
    t = F.sum("_t")
    return by.agg(
        F.count("*").alias("containers"), F.sum("_n").alias("pieces"), t.alias("tokens"),
        F.ceil(t / capacity).alias("least_possible"), (1 - t / (F.count("*") * capacity)).alias("unused_share"),
    )
