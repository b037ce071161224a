"""Names of streets and towns folded to comparable keys, as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import squeeze, unaccent
from .plaintext import LOOKALIKES

_FROM = "".join(x for xs in LOOKALIKES.values() for x in xs)
_TO = "".join(latin * len(xs) for latin, xs in LOOKALIKES.items())
#: Full-width letters and digits and their plain forms, by rule.
_WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)) + "　"
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F)) + " "

# Abbreviations of titles in street names.
TITLES = {
    "gral": "general", "dr": "doctor", "dra": "doctora", "pdte": "presidente", "mons": "monsenor", "ing": "ingeniero",
    "cap": "capitan", "alm": "almirante", "prof": "profesor", "sta": "santa", "sto": "santo", "sgto": "sargento", "tte": "teniente",
}
# Words that tell the kind of street or facility, not its name.
KINDS = (
    "ciclovia ciclobanda ciclopista ciclorruta ciclofaja bicisenda avenida av avda calle c paseo pso pasaje psje pje camino cno costanera cost "
    "boulevard blvd ruta sendero street avenue road path bike tramo"
)
# What stands where a name is missing.
NAMELESS = "sin nombre|s n|sn|no name|none|null|na|n a|xxx|x|por definir|desconocid[ao]|nuevo|nueva|proyecto|sin informacion|sin dato|s i|si|ciclov[ií]a( urbana)?|otr[ao]s?|unnamed|calle|existente|prueba|test|pendiente|por confirmar|n d|nan"


def folded(c: Column) -> Column:
    """Lower case ASCII words with single spaces; null for null."""
    plain = unaccent(F.translate(F.translate(c, _WIDE, _PLAIN), _FROM, _TO))
    seen = F.regexp_replace(plain, r"[\p{Cf}\p{Cc}͏&&[^\t\n\r]]", "")
    return squeeze(F.regexp_replace(F.lower(seen), r"[^a-z0-9]+", " "))


def with_name_words(df: DataFrame, col: str, out: str) -> DataFrame:
    """Adds the words that name a street, in order; null where there is no name.

    In steps of one column each, so that no step's result is worked out more than once a row.
    """
    df = df.withColumn("_folded", folded(F.col(col)))
    t = F.regexp_replace("_folded", r"\btramo( n[ro]?)?( \d+)?\b|\bn[ro]? \d+$", " ")
    words = F.filter(F.split(t, " "), lambda w: (w != "") & ~w.isin(*KINDS.split()))
    full = F.transform(words, lambda w: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in TITLES.items() for x in kv)), w), w))
    df = df.withColumn(out, full).withColumn("_joined", F.array_join(out, " "))
    real = (F.col("_joined") != "") & ~F.col("_folded").rlike(rf"^({NAMELESS})$") & ~F.col("_joined").rlike(rf"^({NAMELESS})$")
    return df.withColumn(out, F.when(real, F.col(out))).drop("_folded", "_joined")


def name_key(words: Column) -> Column:
    """Words in sorted order, joined: equal for names written in another order."""
    return F.array_join(F.array_sort(words), " ")


def town_key(c: Column) -> Column:
    t = F.regexp_replace(folded(c), r"^(comuna|ilustre municipalidad|municipalidad|ciudad|comuna de) (de |del )?", "")
    return F.nullif(t, F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal strings, falling with the edit distance against the longer length; null if either is null."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
