"""Text rules as native Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script, as a Java character class.
SPACE = r"[\s\u001c-\u001f\u0085   -     　]"
#: Accented Latin letters and their base letters, in the same order.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
UNACCENTED = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"


def is_blank(c: Column) -> Column:
    """True for strings of nothing but white space, also the empty one; null for null."""
    return c.rlike(rf"^{SPACE}*$")


def unaccent(c: Column) -> Column:
    """Without the accents of Latin letters, composed or as combining marks."""
    return F.regexp_replace(F.translate(c, ACCENTED, UNACCENTED), r"[̀-ͯ]", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))


#: Letters of any script with accents, and their base letters, in the same order: canonical decompositions without marks.
_BASE = {chr(i): "".join(x for x in unicodedata.normalize("NFD", chr(i)) if not "\u0300" <= x <= "\u036f") for i in range(0xC0, 0x20000) if unicodedata.decomposition(chr(i))}
_BASE = {k: v for k, v in _BASE.items() if len(v) == 1 and v != k}


def _bare(c: Column) -> Column:
    """As :func:`unaccent`, for letters of any script; a byte order mark is white space."""
    return unaccent(F.translate(c, "".join(_BASE) + "\ufeff", "".join(_BASE.values()) + " "))


#: Words for the kind of way that may stand before a street's name; one is taken off.
KIND_PREFIX = r"AV\.|AVENIDA|CALLE|PASEO|CICLOVIA|CICLOVÍA|CICLOBANDA|SENDERO"


def normal_name(c: Column) -> Column:
    """Upper case, no accents, one kind prefix taken off, single spaces; '' for null."""
    t = squeeze(_bare(F.upper(F.coalesce(c, F.lit("")))))
    return squeeze(F.regexp_replace(t, rf"^({KIND_PREFIX}) +", ""))


def loose_name(c: Column) -> Column:
    """Lower case, no accents, single spaces."""
    return squeeze(_bare(F.lower(c)))


def slug(c: Column) -> Column:
    """Lower case words without accents, joined by dashes."""
    return F.regexp_replace(F.regexp_replace(_bare(F.lower(c)), "[^a-z0-9]+", "-"), "^-|-$", "")


def title_of_slug(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))


def base_name(c: Column) -> Column:
    """Without a number at the end."""
    return F.regexp_replace(c, r"\s+\d+$", "")


def distance_text(m: Column) -> Column:
    """'850 m' below a kilometre, '1.2 km' from there."""
    return F.when(m < 1000, F.concat(F.floor(m + 0.5).cast("long").cast("string"), F.lit(" m"))).otherwise(
        F.concat(F.format_string("%.1f", F.floor(m / 100 + 0.5) / 10), F.lit(" km"))
    )


def decimal_comma(x: Column, digits: int = 1) -> Column:
    return F.replace(F.format_string(f"%.{digits}f", x), F.lit("."), F.lit(","))


def spoken_list(items: Column, last: str = "y") -> Column:
    """'A, B y C' of an array."""
    n = F.size(items)
    head = F.array_join(F.slice(items, 1, F.greatest(n - 1, F.lit(0))), ", ")
    return F.when(n < 2, F.array_join(items, "")).otherwise(F.concat(head, F.lit(f" {last} "), F.array_join(F.slice(items, -1, 1), "")))


def yaml_text(c: Column) -> Column:
    """A double-quoted YAML scalar."""
    t = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), F.replace(t, F.lit("\n"), F.lit("\\n")), F.lit('"'))


def xml_text(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Replaces {name} by each value's text; null values by nothing."""
    out = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def names_match(a: Column, b: Column, least: int = 8, share: float = 0.5) -> Column:
    """Equal loosely, or one within the other with both at least ``least`` long and the lengths at least ``share`` alike."""
    x, y = loose_name(a), loose_name(b)
    inside = F.contains(x, y) | F.contains(y, x)
    long = (F.length(x) >= least) & (F.length(y) >= least)
    ratio = F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y), F.lit(1))
    return (x == y) | (long & inside & (ratio >= share))


#: Points for what either name of a route contains.
NAME_POINTS = ((2, "parque|plaza"), (2, "mercado|museo"), (2, "río|cerro"), (1, "estación|station"), (-1, "bandejon|rotonda"), (-1, "acceso|óvalo"))


def name_quality(start: Column, end: Column) -> Column:
    """Points for recognisable names at both ends; -6 if they are equal, never below 0."""
    score = F.lit(0)
    for c in (start, end):
        for points, words in NAME_POINTS:
            score = score + F.when(F.lower(c).rlike(words), points).otherwise(0)
    return F.greatest(score - F.when(start == end, 6).otherwise(0), F.lit(0))
