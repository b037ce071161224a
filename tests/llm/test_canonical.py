import random

from rodado.llm import canonical as C

TERMS = [("tags", 1, "gravel", "ripio", "gravier"), ("tags", 2, "bike path", "ciclovía", "piste cyclable"), ("tags", 3, "long haul", None, None), ("category", 9, "bakery", "panadería", None)]


def test_distance_is_the_metric():
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(0, 7))) for _ in range(120)})
    alphabet = {c: i for i, c in enumerate("abc", 1)}
    pairs = [(rnd.choice(words), rnd.choice(words)) for _ in range(800)]
    d = C.distances(*C._codes([a for a, _ in pairs], alphabet), *C._codes([b for _, b in pairs], alphabet), 3)
    assert d.tolist() == [C.distance(a, b) for a, b in pairs]
    assert C.distance("ca", "abc") == 2 and C.distance("ab", "ba") == 1
    for _ in range(500):
        a, b, c = (rnd.choice(words) for _ in range(3))
        assert C.distance(a, c) <= C.distance(a, b) + C.distance(b, c)


def test_tree_finds_all():
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 8))) for _ in range(200)]
    tree, asked = C.BKTree(words), [*words[:30], "zzzz", "éa", "", "abcdabcdabcd"]
    got = {(q, tree.words[w], d) for q, w, d in tree.search(asked, [2] * len(asked))}
    assert got == {(q, w, C.distance(x, w)) for q, x in enumerate(asked) for w in set(words) if C.distance(x, w) <= 2}


def values(spark, rows):
    return spark.createDataFrame(rows, "field string, record_id bigint, raw_value string, _d int")


def test_mapping(spark):
    terms = spark.createDataFrame(TERMS, "field string, term_id bigint, term string, label_es string, label_fr string")
    want = {
        ("tags", "Gravle"): 1, ("tags", "#bikepath"): 2, ("tags", "path bike"): 2, ("tags", "CICLOVIA"): 2, ("tags", "bik. path"): 2, ("tags", "gravel / ripio"): 1,
        ("tags", "bakery"): 0, ("category", "Bakery!"): 9, ("tags", "???"): 0, ("tags", "the gravel one"): 1, ("tags", "x" * 30_000): 0, ("tags", "Рipio"): 1, ("other", "gravel"): 0,
    }
    rows = [(f, i, v, 1) for i, (f, v) in enumerate(want)] + [("tags", 99, None, 1), ("tags", 98, "  ", 1), ("tags", 97, "gravel", 1), ("tags", 0, "Gravle", 1)]
    for options in ({}, {"shard_entries": 1}, {"shard_entries": 2, "sent_bytes": 0}):
        got = C.map_values(values(spark, rows).distinct(), terms, **options).collect()
        assert {(r["field"], r["raw_value"]): r["term_id"] for r in got} == want
    more = spark.createDataFrame([("tags", 2, "cycle lane"), ("tags", 2, None), ("category", 9, "bread shop")], "field string, term_id bigint, alias string")
    asked = values(spark, [("tags", 1, "Cycle lanes", 1), ("tags", 2, "bread shop", 1), ("category", 3, "bread shop", 1)])
    assert {(r["field"], r["raw_value"]): r["term_id"] for r in C.map_values(asked, terms, aliases=more).collect()} == {("tags", "Cycle lanes"): 2, ("tags", "bread shop"): 0, ("category", "bread shop"): 9}
    assert {r["term_id"] for r in C.map_values(asked, terms).collect()} == {0}
    assert C.map_values(values(spark, rows).limit(0), terms).collect() == []
    assert {r["term_id"] for r in C.map_values(values(spark, rows), terms.limit(0)).collect()} == {0}


def test_typed_values(spark):
    r = spark.createDataFrame([(1, ["a", "a", None, ""]), (2, None), (None, ["b"]), (1, ["a"])], "route_id bigint, tags array<string>")
    p = spark.createDataFrame([(5, "bakery"), (6, None), (5, "bakery")], "place_id bigint, category string")
    assert sorted(map(tuple, C.typed_values(r, p).collect())) == [("category", 5, "bakery"), ("tags", 1, ""), ("tags", 1, "a")]


def test_shards_change_nothing(spark):
    rows = [("tags", 5, "gravelroad", None, None), ("tags", 1, "park", None, None), ("tags", 7, "big park", None, None), ("tags", 2, "lane", None, None), ("tags", 9, "track", None, None), ("tags", 3, "other", "track", None)]
    terms = spark.createDataFrame(rows, "field string, term_id bigint, term string, label_es string, label_fr string")
    want = {"gravel roads": 5, "the big park lane": 7, "park gravelroat": 1, "lane or park": 2, "a track there": 9, "gravelroad park": 5}
    src = values(spark, [("tags", i, v, 1) for i, v in enumerate(want)])
    whole, split = ({r["raw_value"]: (r["term_id"], r["edits"]) for r in C.match_values(src, terms, shard_entries=n).collect()} for n in (5000, 1))
    assert whole == split and {k: v[0] for k, v in whole.items()} == want


def test_a_whole_match_in_another_shard_wins(spark):
    terms = spark.createDataFrame([("tags", 1, "park", None, None), ("tags", 2, "park avenue", None, None)], "field string, term_id bigint, term string, label_es string, label_fr string")
    src = values(spark, [("tags", 1, "park avenua", 1)])
    assert [C.match_values(src, terms, shard_entries=n).first()["term_id"] for n in (5000, 1)] == [2, 2]
