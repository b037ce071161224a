import itertools
import random
from collections import Counter

from rodado.llm import cooccur as C


def brute(rows, least, share, lift):
    sets = {}
    for r, items in rows:
        if r is not None:
            sets.setdefault(r, set()).update(x for x in items or [] if x is not None and x.strip())
    sets = {k: v for k, v in sets.items() if v}
    n, one, two = len(sets), Counter(), Counter()
    for v in sets.values():
        one.update(v)
        two.update(itertools.combinations(sorted(v), 2))
    return {(a, b, k, one[a], one[b], n) for (a, b), k in two.items() if k >= least and share * k >= n and k * n >= lift * one[a] * one[b]}


def rows(seed):
    rnd = random.Random(seed)
    items = [f"t{i}" for i in range(40)] + ["ñandú", "Ünïx", "zz"]
    out = [(i, [rnd.choice(items[: rnd.randint(2, 43)]) for _ in range(rnd.randint(0, 9))] + (["common"] if rnd.random() < 0.6 else [])) for i in range(400)]
    return out + out[:40] + [(None, ["t1", "t2"]), (900, None), (901, []), (902, [None, "", "  ", " "]), (903, [f"t{i}" for i in range(40)] * 50)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "RECORDS", 64)
    for seed, lift in ((1, 3), (2, 1)):
        data = rows(seed)
        df = spark.createDataFrame([(*r, "x") for r in data], "rid bigint, tags array<string>, n string")
        got = {tuple(r)[:6] for r in C.item_pairs(df, "rid", "tags", 4, 10_000, lift).collect()}
        assert got == brute(data, 4, 10_000, lift)


def test_blocks_of_any_width():
    base = [["a", "b", "c", "d", "e"], ["b", "d"], ["c", "e", "zz"]]
    codes = {c: i for i, c in enumerate("abcde")}
    want = Counter(codes[x] * 5 + codes[y] for r in base for x, y in itertools.combinations([i for i in r if i in codes], 2))
    for width in (1, 2, 3, 100):
        got = Counter()
        for c, k in C.gram_blocks(base, codes, width):
            got.update(dict(zip(c.tolist(), k.tolist())))
        assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], "rid bigint, tags array<string>")
    assert C.item_pairs(df, "rid", "tags").collect() == []
