"""Names that look plain but are stored in other characters, brought to their plain form.

Each name is exploded to positioned code points; broadcast tables give every point its decomposition, the plain
character it imitates, its combining class and whether it is visible; combining marks are put in the order of their
classes, clusters are recomposed, spaces are settled, and the string is rebuilt.

What is defined here:

* A name without any character outside printable ASCII, with single inner spaces and none at the ends, is its own
  plain form. Null stays null, a name of nothing but invisible characters becomes the empty string.
* Full-width and half-width forms, styled mathematical letters and digits and the various spaces become the plain
  characters. Ordinals, superscripts, fractions, dashes and symbols stay. Hyphens that look like the ASCII one become it.
* A letter of another script that imitates a Latin letter is replaced if its word has a Latin letter. A word of
  imitations alone is replaced if the name has Latin letters or mixes scripts. A word with a letter that imitates none
  is a real word of its script and stays, and so do the look-alike words beside it.
* Joiners stay between emoji and between letters of scripts that join, where they have an effect; elsewhere they go.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import salted_join

# Letters of other scripts that look like a Latin letter, by that letter, in natural order.
LOOKALIKES = {
    "A": "ΑАᎪꓮ", "B": "ΒВᏴꓐ", "C": "ϹСᏟꓚⅭ",
    "D": "ᎠꓓⅮ", "E": "ΕЕᎬꓰ", "F": "Ϝꓝ", "G": "ԌᏀꓖ",
    "H": "ΗНᎻꓧ", "I": "ΙІӀⅠꓲ", "J": "ͿЈᎫꓙ",
    "K": "ΚКKᏦꓗ", "L": "ᏞꓡⅬ", "M": "ΜМᎷϺꓟⅯ",
    "N": "Νꓠ", "O": "ΟОՕꓳ", "P": "ΡРᏢꓑ", "Q": "Ԛ",
    "R": "ᎡᏒꓣ", "S": "ЅՏᏚᏕꓢ", "T": "ΤТᎢꓔ", "U": "Սꓴ",
    "V": "ѴᏙⅤꓦ", "W": "ԜᎳᏔꓪ", "X": "ΧХⅩꓫ",
    "Y": "ΥҮᎩꓬ", "Z": "ΖᏃꓜ",
    "a": "ɑαа", "b": "ЬᏏ", "c": "ϲсᴄⅽ", "d": "ԁⅾ", "e": "е℮",
    "g": "ɡց", "h": "һհ", "i": "іιⅰ", "j": "јϳ", "k": "кκ",
    "l": "ӏⅼ", "m": "ⅿ", "n": "ո", "o": "οоօᴏഠ", "p": "рρ",
    "q": "ԛզ", "r": "гᴦ", "s": "ѕꜱ", "u": "սυᴜ", "v": "νѵⅴᴠ", "w": "ԝѡᴡ",
    "x": "хⅹ", "y": "уү", "z": "ᴢ",
}
# Signs that look like an ASCII sign.
SIGNS = {
    "-": "‐‑˗−⁃﹣", "'": "ʹʼˈ’‘′‛׳", '"': "“”″‟״",
    ",": "‚", ".": "․", ":": "ː։꞉∶", ";": ";", "!": "ǃ", "/": "⁄∕", "*": "∗", "~": "∼", "|": "∣ǀ",
}
#: Compatibility decompositions that don't change the look.
_SAME_LOOK = {"<wide>", "<narrow>", "<font>", "<noBreak>"}
#: First words of the names of letters that belong to no script of their own.
NO_SCRIPT = {"MASCULINE", "FEMININE", "MODIFIER", "MICRO", "OHM", "INVERTED", "TURNED", "SCRIPT", "BLACK-LETTER", "DOUBLE-STRUCK", "MATHEMATICAL"}
INVISIBLE = {0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0}


def _invisible(c: int, cat: str) -> bool:
    """Default-ignorable and control characters; the white space among the controls is a space."""
    return (
        c in INVISIBLE
        or cat == "Cf"
        or cat == "Cc"
        or 0x180B <= c <= 0x180F
        or 0xFE00 <= c <= 0xFE0F
        or 0xE0000 <= c <= 0xE0FFF
    )


@cache
def _tables() -> tuple[list[tuple], list[tuple], list[tuple]]:
    """(points, marks, compositions), from Python's Unicode data and the fixed values above.

    points: (code, canonical decomposition, plain look or null, kind, script, whether it is a letter of another script
    that imitates a Latin one). Kinds: s space, i invisible, j joiner or selector, l Latin letter, f letter of another
    script, e emoji, o other. marks: (character, class), with the class-0 characters that compose with one before them.
    compositions: (starter, {marks: composite}).
    """
    twin = {x: latin for latin, xs in LOOKALIKES.items() for x in xs}
    sign = {x: s for s, xs in SIGNS.items() for x in xs}
    points, groups, marks = [], {}, {}
    for c in [*range(0x3400), *range(0xA000, 0xD7A4), *range(0xF900, 0xFFFE), *range(0x10000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)]:
        ch = chr(c)
        cat, deco, nfd = unicodedata.category(ch), unicodedata.decomposition(ch), unicodedata.normalize("NFD", ch)
        if cat in ("Cn", "Cs", "Co"):
            continue
        if k := unicodedata.combining(ch):
            marks[ch] = k
        base = nfd
        if deco.split(" ")[0] in _SAME_LOOK and cat != "Zs" or 0xFB00 <= c <= 0xFB06 or 0x2160 <= c <= 0x217F:
            base = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", ch))
        look = "".join(twin.get(x, sign.get(x, x)) for x in base)
        name = unicodedata.name(ch, "")
        script = name.split(" ")[0]
        if cat in ("Zs", "Zl", "Zp") or c in (9, 10, 11, 12, 13, 0x85):
            kind, look = "s", " "
        elif c in (0x200C, 0x200D, 0xFE0E, 0xFE0F) or 0xE0020 <= c <= 0xE007F:
            kind = "j"
        elif _invisible(c, cat):
            kind = "i"
        elif cat[0] == "L":
            kind = "l" if script == "LATIN" or base[0].isascii() else "o" if script in NO_SCRIPT else "f"
        else:
            kind = "e" if cat == "So" and c > 0x2000 or 0x1F3FB <= c <= 0x1F3FF else "o"
        imitates = kind == "f" and any(x in twin for x in base)
        if nfd != ch or look != nfd or kind not in "o":
            points.append((c, nfd, look if look != nfd else None, kind, script if kind == "f" else None, imitates))
        if nfd != ch and not deco.startswith("<") and unicodedata.normalize("NFC", nfd) == ch:
            groups.setdefault(nfd[0], {})[nfd[1:]] = ch
            marks.update((x, 0) for x in nfd[1:] if x not in marks and not unicodedata.combining(x))
    return points, sorted(marks.items()), sorted(groups.items())


def point_table(spark: SparkSession) -> DataFrame:
    """One row for each code point with a role. Its size is bounded by Unicode, whatever the input."""
    return spark.createDataFrame(_tables()[0], "_cp int, _nfd string, _look string, _kind string, _script string, _imitates boolean")


def mark_table(spark: SparkSession) -> DataFrame:
    """(_c, _class): combining marks with their canonical classes."""
    return spark.createDataFrame(_tables()[1], "_c string, _class int")


def composition_table(spark: SparkSession) -> DataFrame:
    """(_starter, _made): for each starter the composites by the marks they take, in canonical order."""
    return spark.createDataFrame(_tables()[2], "_starter string, _made map<string,string>")


def needs_work(text: Column) -> Column:
    """False only for strings that are their own plain form: printable ASCII with single inner spaces."""
    return text.rlike(r"[^\x20-\x7e]|^ | $|  ")


def _code_point(ch: Column) -> Column:
    return F.conv(F.hex(F.encode(ch, "UTF-32")), 16, 10).cast("int")


def _compose(made: Column, starter: Column, marks: Column) -> Column:
    """Canonical composition of a starter with its marks (array<struct<k,at,c>>), which are in canonical order."""

    def state(used: Column, rest: Column, last: Column) -> Column:
        return F.struct(used.alias("used"), rest.alias("rest"), last.alias("last"))

    def step(a: Column, m: Column) -> Column:
        free = (a["rest"] == "") | (a["last"] < m["k"])
        takes = free & F.coalesce(F.map_contains_key(made, F.concat(a["used"], m["c"])), F.lit(False))
        return F.when(takes, state(F.concat(a["used"], m["c"]), a["rest"], a["last"])).otherwise(state(a["used"], F.concat(a["rest"], m["c"]), m["k"]))

    zero = state(F.lit(""), F.lit(""), F.lit(-1))
    done = lambda a: F.concat(F.coalesce(F.when(a["used"] != "", F.try_element_at(made, a["used"])), starter), a["rest"])
    return F.aggregate(marks, zero, step, done)


def plain_names(names: DataFrame, col: str = "name", out: str = "plain_name") -> DataFrame:
    """Distinct (col, out) of the non-null strings of ``col`` that differ from their plain form.

    Names that :func:`needs_work` tells to be plain never leave the scan; each other distinct name is handled once,
    however many rows hold it. The only shuffle is that of the distinct names: everything after it, windows and
    groups, is by name and keeps that partitioning. The broadcast tables are bounded by Unicode.
    """
    spark = names.sparkSession
    points, marks, made = map(F.broadcast, (point_table(spark), mark_table(spark), composition_table(spark)))
    text = F.col("_t")
    src = names.select(F.col(col).alias("_t")).where(text.isNotNull() & needs_work(text)).distinct()
    # 1. positioned code points, with what the tables know of each
    x = src.select("_t", F.posexplode(F.split("_t", "")).alias("_at", "_ch")).where("_ch <> ''")
    x = x.withColumn("_cp", _code_point(F.col("_ch"))).join(points, "_cp", "left")
    x = x.withColumns({"_kind": F.coalesce("_kind", F.lit("o")), "_own": (F.col("_kind") == "f") & ~F.col("_imitates")})
    # 2. words, and whether they are Latin, real words of another script, or imitations
    order = Window.partitionBy("_t").orderBy("_at")
    name, word = Window.partitionBy("_t"), Window.partitionBy("_t", "_word")
    any_ = lambda c, w: F.coalesce(F.max(c).over(w), F.lit(False))
    x = x.withColumns({
        "_word": F.sum((F.col("_kind") == "s").cast("int")).over(order),
        "_prev": F.lag("_kind").over(order), "_next": F.lead("_kind").over(order),
        "_prev_own": F.lag("_own").over(order), "_next_own": F.lead("_own").over(order),
    })
    latin = F.col("_kind") == "l"
    x = x.withColumns({
        "_name_latin": any_(latin, name), "_name_own": any_(F.col("_own"), name),
        "_scripts": ~F.min("_script").over(name).eqNullSafe(F.max("_script").over(name)),
        "_word_latin": any_(latin, word), "_word_own": any_(F.col("_own"), word),
    })
    replaced = F.col("_word_latin") | (~F.col("_word_own") & ~F.col("_name_own") & (F.col("_name_latin") | F.col("_scripts")))
    look = F.when(~F.coalesce("_imitates", F.lit(False)) | replaced, F.col("_look"))
    beside = F.when(F.col("_ch").isin("\u200c", "\u200d"), (F.col("_next") == "e") & F.col("_prev").isin("e", "j", "o") & (F.col("_ch") == "\u200d") | F.col("_prev_own") & F.col("_next_own")).otherwise(F.col("_prev").isin("e", "j"))
    kept = F.when(F.col("_kind") == "j", F.coalesce(beside, F.lit(False))).otherwise(F.col("_kind") != "i")
    x = x.where(kept).select("_t", "_at", F.posexplode(F.split(F.coalesce(look, "_nfd", "_ch"), "")).alias("_sub", "_c")).where("_c <> ''")
    # 3. clusters: a starter and what combines with it, marks in the order of their classes
    x = x.join(marks, "_c", "left")
    step = Window.partitionBy("_t").orderBy("_at", "_sub")
    more = (F.col("_class") > 0) | ((F.col("_class") == 0) & (F.coalesce(F.lag("_class").over(step), F.lit(0)) == 0))
    x = x.withColumn("_starts", ~F.coalesce(more & (F.row_number().over(step) > 1), F.lit(False)))
    x = x.withColumn("_cluster", F.sum(F.col("_starts").cast("int")).over(step))
    entry = F.struct(F.coalesce("_class", F.lit(0)).alias("k"), F.col("_at"), F.col("_sub"), F.col("_c").alias("c"))
    g = x.groupBy("_t", "_cluster").agg(
        F.max(F.when(F.col("_starts"), F.col("_c"))).alias("_starter"),
        F.sort_array(F.collect_list(F.when(~F.col("_starts"), entry))).alias("_marks"),
    )
    # 4. recomposed and rebuilt
    g = g.join(made, "_starter", "left")
    done = F.when(F.size("_marks") == 0, F.col("_starter")).otherwise(_compose(F.col("_made"), F.col("_starter"), F.col("_marks")))
    r = g.groupBy("_t").agg(F.sort_array(F.collect_list(F.struct("_cluster", done.alias("_d")))).alias("_d"))
    plain = F.trim(F.regexp_replace(F.array_join(F.transform("_d", lambda d: d["_d"]), ""), " +", " "))
    # names of nothing visible have no points left
    r = src.join(r, "_t", "left").select("_t", F.coalesce(plain, F.lit("")).alias("_p"))
    return r.where(F.col("_t") != F.col("_p")).select(F.col("_t").alias(col), F.col("_p").alias(out))


def plain_records(df: DataFrame, key: str, col: str, tbl: str) -> DataFrame:
    """(tbl, rec_id, plain_name) of the records whose name differs from its plain form, each once.

    Records without an id don't come out.
    """
    recs = df.select(F.col(key).alias("rec_id"), F.col(col).alias("_name"))
    recs = recs.where(F.col("rec_id").isNotNull() & needs_work(F.col("_name")))
    out = salted_join(recs, plain_names(recs, "_name"), ["_name"], ["rec_id"]).select(F.lit(tbl).alias("tbl"), "rec_id", "plain_name")
    return out.distinct()


def plain_all(catastro: DataFrame, places: DataFrame) -> DataFrame:
    """(tbl, rec_id, plain_name) of both tables; distinct names of both are handled together."""
    recs = catastro.select(F.lit("catastro").alias("tbl"), F.col("feature_id").alias("rec_id"), F.col("nombre").alias("_name")).unionAll(
        places.select(F.lit("places"), "place_id", "name")
    )
    recs = recs.where(F.col("rec_id").isNotNull() & needs_work(F.col("_name")))
    # a name that many records hold is split
    return salted_join(recs, plain_names(recs, "_name"), ["_name"], ["tbl", "rec_id"]).select("tbl", "rec_id", "plain_name").distinct()
