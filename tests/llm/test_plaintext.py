import random
import unicodedata

from rodado.llm import plaintext as P


def plain(spark, names):
    df = spark.createDataFrame([(x, 1) for x in names], "name string, _t int")  # an extra column with a clashing name
    got = {r["name"]: r["plain_name"] for r in P.plain_names(df).collect()}
    return {x: got.get(x, x) for x in names if x is not None}


CASES = {
    "Ｃａｆé": "Café", "Café": "Café", "Av. Los Ríos": "Av. Los Ríos", "Pla​za­": "Plaza", " a  b ": "a b", "a\tb\n": "a b",
    "Pаsеo Sаn": "Paseo San", "S/Ν": "S/N", "ﬁn": "fin", "\U0001d400v. １": "Av. 1", "Norte‐Sur": "Norte-Sur",
    "1ª Nº 3 ½ m²": "1ª Nº 3 ½ m²", "A – B": "A – B", "Кафе Зорянка": "Кафе Зорянка", "Café Дом": "Café Дом", "Πλατεία Νεφέλη": "Πλατεία Νεφέλη",
    "자전거": "자전거", "👨‍👩‍👧 x": "👨‍👩‍👧 x", "​": "", "": "", "plain": "plain", "Νº 2 Tramo": "Nº 2 Tramo",
}


def test_cases(spark):
    assert plain(spark, list(CASES)) == CASES


def test_nulls_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([("Ａ",), ("Ａ",), (None,)], "name string")
    assert [tuple(r) for r in P.plain_names(df).collect()] == [("Ａ", "A")]
    assert P.plain_names(df.limit(0)).collect() == []
    recs = spark.createDataFrame([(1, "Ａ"), (1, "Ａ"), (2, "Ａ"), (None, "Ａ"), (3, None), (4, "A")], "id bigint, n string")
    assert sorted(map(tuple, P.plain_records(recs, "id", "n", "t").collect())) == [("t", 1, "A"), ("t", 2, "A")]


def test_very_long_name(spark):
    long = "Ｐ" * 20_000 + "́"
    assert plain(spark, [long])[long] == unicodedata.normalize("NFC", "P" * 20_000 + "́")


def test_recomposition_is_canonical(spark):
    """Names of marks in any order come out as NFC makes them, where no look-alike is involved."""
    rnd = random.Random(7)
    bases, marks = "aeiounAEcyZ가か", "゙̧̨̣̱̀́̂̃̈"
    names = ["".join(rnd.choice(bases) + "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 3))) for _ in range(4)) for _ in range(300)]
    got = plain(spark, names)
    bad = {x: got[x] for x in names if got[x] != unicodedata.normalize("NFC", x)}
    assert not bad, list(bad.items())[:3]


def test_imitations_alone(spark):
    assert plain(spark, ["ОСО verde", "ОСО", "ОΡА"]) == {"ОСО verde": "OCO verde", "ОСО": "ОСО", "ОΡА": "OPA"}
