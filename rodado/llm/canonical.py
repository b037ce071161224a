"""Mapping freely typed values to the entries of a reference list.

Entries and values are brought to a folded form (no case, accents, signs or spaces). The folded entries form BK-trees
under the Damerau-Levenshtein distance with adjacent transpositions and anything inserted between them, which is a true
metric; so the triangle inequality prunes subtrees and still every entry within the threshold is found. A reference
list larger than ``SHARD_ENTRIES`` becomes several trees, each built once in a task of its own; each value visits all of
them and the shards' winners merge. The list itself never goes to the driver.

What is defined here:

* Null and blank values, and values that are exactly a term of their field, don't come out.
* An entry is known by its term, by the given label columns and by the aliases that the caller gives; also with its
  words in another order.
* "a / b" means what either part means. A word that ends in a full stop may be the start of an entry's word.
* A value that matches nothing as a whole means the entry whose name it holds as neighbouring words, the longest first.
* Accepted distance: 0 for folded forms under 4 characters, 1 under 6, otherwise 2.
* The nearest entry wins; ties go to the term before labels and aliases, then to the smallest id. None: id 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..operators.skew import salted_join
from ..session import stage

SHARD_ENTRIES = 5_000
#: Bytes of trees that are sent to every task, and values of a group where they aren't.
SENT_BYTES, VALUES = 64 << 20, 100_000
#: A folded form longer than the longest entry by more than the largest threshold can't match; it isn't compared.
MAX_EDITS = 2

def fold(text: str) -> str:
    """Lower case, without accents; everything but letters and digits becomes single spaces."""
    t = unicodedata.normalize("NFKD", text).casefold()
    t = "".join(c for c in t if not unicodedata.combining(c))
    t = t.replace("œ", "oe").replace("æ", "ae").replace("ß", "ss").replace("ø", "o").replace("ł", "l")
    return " ".join(re.findall(r"[^\W_]+", t))


def edits_allowed(n: int) -> int:
    return 0 if n < 4 else 1 if n < 6 else MAX_EDITS


def distance(a: str, b: str) -> int:
    """Damerau-Levenshtein distance, one pair; the plain form of :func:`distances`."""
    far = len(a) + len(b)
    last: dict[str, int] = {}
    h = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        h[i + 1][1] = i
    for j in range(len(b) + 1):
        h[1][j + 1] = j
    for i in range(1, len(a) + 1):
        seen = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), seen
            same = a[i - 1] == b[j - 1]
            if same:
                seen = j
            h[i + 1][j + 1] = min(h[i][j] + (not same), h[i + 1][j] + 1, h[i][j + 1] + 1, h[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return h[-1][-1]


def _codes(words: list[str], alphabet: dict[str, int]):
    """(matrix of letter numbers, lengths); letters outside the alphabet all get a number no other string has."""
    import numpy as np

    size = np.array([len(w) for w in words], dtype=np.int32)
    m = np.zeros((len(words), max(1, int(size.max(initial=0)))), dtype=np.int32)
    other = len(alphabet) + 1
    for i, w in enumerate(words):
        m[i, : len(w)] = [alphabet.get(c, other) for c in w]
    return m, size


def distances(a, la, b, lb, letters: int):
    """Distances of many pairs at once (numpy): the recurrence runs over positions, each of its steps over all pairs.

    a and b are matrices of letter numbers with lengths la and lb, from :func:`_codes`.
    """
    import numpy as np

    n = len(la)
    wa, wb = int(la.max(initial=0)), int(lb.max(initial=0))
    h = np.empty((wa + 2, wb + 2, n), dtype=np.int32)
    h[0, :] = h[:, 0] = la + lb
    h[1:, 1] = np.arange(wa + 1)[:, None]
    h[1, 1:] = np.arange(wb + 1)[:, None]
    rows = np.arange(n)
    last = np.zeros((n, letters + 2), dtype=np.int32)
    for i in range(1, wa + 1):
        ai = a[:, i - 1]
        seen = np.zeros(n, dtype=np.int32)
        for j in range(1, wb + 1):
            bj = b[:, j - 1]
            k = last[rows, bj]
            same = ai == bj
            best = np.minimum(h[i, j] + ~same, np.minimum(h[i + 1, j], h[i, j + 1]) + 1)
            np.minimum(best, h[k, seen, rows] + (i - k) + (j - seen) - 1, out=best)
            h[i + 1, j + 1] = best
            seen = np.where(same, j, seen)
        last[rows, ai] = i
    return h[la + 1, lb + 1, rows]


class BKTree:
    """A metric tree over distinct strings. ``search`` answers many queries together, level by level."""

    #: Pairs compared in one step of the recurrence.
    STEP = 20_000

    def __init__(self, words: Iterable[str]):
        self.words: list[str] = list(dict.fromkeys(words))
        self.kids: list[dict[int, int]] = [{} for _ in self.words]
        self.number = {w: i for i, w in enumerate(self.words)}
        self.alphabet = {c: i for i, c in enumerate(sorted({*"".join(self.words)}), 1)}
        self.codes, self.sizes = _codes(self.words, self.alphabet)
        for new in range(1, len(self.words)):
            at = 0
            while at != new:
                at = self.kids[at].setdefault(distance(self.words[new], self.words[at]), new)

    def search(self, queries: list[str], limits: list[int]) -> Iterator[tuple[int, int, int]]:
        """Every (query, word, distance) within the query's limit."""
        import numpy as np

        if not self.words or not queries:
            return
        codes, sizes = _codes(queries, self.alphabet)
        front = [(q, 0) for q in range(len(queries))]
        while front:
            down = []
            for at in range(0, len(front), self.STEP):
                part = front[at : at + self.STEP]
                q, w = np.array(part).T
                la, lb = sizes[q], self.sizes[w]
                d = distances(codes[q], la, self.codes[w], lb, len(self.alphabet))
                for (x, y), e in zip(part, d.tolist()):
                    t, kids = limits[x], self.kids[y]
                    if e <= t:
                        yield x, y, e
                    if kids:
                        down += [(x, kids[k]) for k in range(max(1, e - t), e + t + 1) if k in kids]
            front = down


def entry_forms(term: str, others: Iterable[str | None]) -> Iterator[tuple[str, int]]:
    """(folded form without spaces, rank): 0 the term, 1 another name, 2 words in another order."""
    for rank, name in [(0, term), *((1, o) for o in others)]:
        words = fold(name).split() if name else []
        if not words:
            continue
        yield "".join(words), rank
        if 2 <= len(words) <= 3:
            for p in permutations(words):
                yield "".join(p), 2


def value_forms(value: str, starts: dict[str, list[tuple[str, ...]]]) -> Iterator[str]:
    """Folded forms a value may be compared by: itself, the parts around slashes, abbreviated words written out.

    starts: entries' words by the first letter of the entry.
    """
    parts = [value, *value.split("/")] if "/" in value else [value]
    for part in dict.fromkeys(parts):
        words = fold(part).split()
        if not words:
            continue
        yield "".join(words)
        if "." in part.rstrip(". "):
            marked = [fold(w) for w in re.findall(r"[^\s.]+\.?", part)]
            dots = [w.endswith(".") for w in re.findall(r"[^\s.]+\.?", part)]
            for entry in starts.get(words[0][0], []):
                if len(entry) == len(marked) and all(e == m or dot and m and e.startswith(m) for e, m, dot in zip(entry, marked, dots)):
                    yield "".join(entry)


def inner_forms(value: str, longest: int) -> Iterator[str]:
    """Runs of neighbouring words of a longer value, folded together, from the longest."""
    words = fold(value).split()
    runs = {}
    for i in range(len(words)):
        run = ""
        for j in range(i, len(words)):
            run += words[j]
            if len(run) > longest:
                break
            if j - i + 1 < len(words):
                runs[run] = None
    return iter(sorted(runs, key=lambda r: (-len(r), r)))


class Canon:
    """The reference list of one shard, ready to look up values of any of its fields."""

    def __init__(self, entries: list[tuple[str, int, str, list[str | None]]]):
        self.forms: dict[str, dict[str, tuple[int, int]]] = {}
        self.starts: dict[str, dict[str, list[tuple[str, ...]]]] = {}
        for field, term_id, term, others in entries:
            forms, starts = self.forms.setdefault(field, {}), self.starts.setdefault(field, {})
            for form, rank in entry_forms(term, others):
                if form not in forms or (rank, term_id) < forms[form]:
                    forms[form] = (rank, term_id)
            for name in (term, *others):
                if name and (words := tuple(fold(name).split())):
                    starts.setdefault(words[0][0], []).append(words)
        self.trees = {f: BKTree(forms) for f, forms in self.forms.items()}
        self.longest = {f: max(map(len, forms)) for f, forms in self.forms.items()}

    def best(self, field: str, values: list[str]) -> list[tuple[int, int, int, str, int, int] | None]:
        """For each value the best (stage, distance, -length, run, rank, term_id), or None, alike for any split of the list.

        Stage 0 are matches of the whole value, stage 1 inner words, of which the longest run wins.
        """
        found: list[tuple[int, int, int, str, int, int] | None] = [None] * len(values)
        if field not in self.trees:
            return found
        asked, owner = [], []
        for i, v in enumerate(values):
            for form in dict.fromkeys(value_forms(v, self.starts[field])):
                if len(form) <= self.longest[field] + MAX_EDITS:
                    asked.append(form)
                    owner.append(i)
        tree, forms = self.trees[field], self.forms[field]
        # a form that is an entry has distance 0 to it: nothing in the tree is nearer, only ranks count
        for i in {owner[q] for q, form in enumerate(asked) if form in forms}:
            rank, term_id = min(forms[f] for f in value_forms(values[i], self.starts[field]) if f in forms)
            found[i] = (0, 0, 0, "", rank, term_id)
        open_ = [q for q in range(len(asked)) if found[owner[q]] is None]
        asked, owner = [asked[q] for q in open_], [owner[q] for q in open_]
        for q, w, d in tree.search(asked, [edits_allowed(len(x)) for x in asked]):
            rank, term_id = forms[tree.words[w]]
            if found[owner[q]] is None or (0, d, 0, "", rank, term_id) < found[owner[q]]:
                found[owner[q]] = (0, d, 0, "", rank, term_id)
        for i, v in enumerate(values):
            if found[i] is None:
                hit = next((r for r in inner_forms(v, self.longest[field]) if len(r) > 3 and r in forms and forms[r][0] < 2), None)
                if hit:
                    found[i] = (1, 0, -len(hit), hit, *forms[hit])
        return found


#: Columns of a match, the better the smaller.
_KEY = ("_stage", "_d", "_len", "_run", "_rank", "_id")


def reference_entries(terms: DataFrame, labels: tuple[str, ...], aliases: DataFrame | None) -> DataFrame:
    """(field, term_id, term, others): the entries with their other names, labels before aliases."""
    e = terms.where("term is not null and field is not null and term_id is not null")
    e = e.select("field", "term_id", "term", F.array(*labels).cast("array<string>").alias("others"))
    if aliases is None:
        return e
    more = aliases.where("alias is not null").groupBy("field", "term_id").agg(F.array_sort(F.collect_set("alias")).alias("_more"))
    e = e.join(more, ["field", "term_id"], "left")
    return e.select("field", "term_id", "term", F.concat("others", F.coalesce("_more", F.array().cast("array<string>"))).alias("others"))


def shard_trees(entries: DataFrame, shard_entries: int) -> tuple[DataFrame, int]:
    """((shard, tree binary), number of shards): each shard's trees, built once, in a task of its own, and stored."""
    import pickle

    shards = max(1, -(-entries.count() // shard_entries))
    e = entries.withColumn("_shard", F.pmod(F.xxhash64("field", "term_id", "term"), F.lit(shards)).cast("int"))

    def build(pdf):
        import pandas as pd

        rows = sorted(zip(pdf["field"], pdf["term_id"].tolist(), pdf["term"], (list(o) for o in pdf["others"])), key=lambda r: r[:3])
        return pd.DataFrame({"shard": [int(pdf["_shard"].iloc[0])], "tree": [pickle.dumps(Canon(rows), protocol=5)]})

    return stage(e.groupBy("_shard").applyInPandas(build, "shard int, tree binary"), "trees"), shards


def match_values(
    values: DataFrame, terms: DataFrame, field: str = "field", value: str = "raw_value", labels: tuple[str, ...] = ("label_es", "label_fr"),
    aliases: DataFrame | None = None, shard_entries: int = SHARD_ENTRIES, sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """Distinct (field, raw_value, term_id, edits) of the non-blank values that aren't exactly a term of their field.

    aliases: (field, term_id, alias), other names of entries that the caller knows; none are built in. The trees are
    built once. Up to ``sent_bytes`` in all they are sent to every task, and the values pass them in one go; beyond that
    the values meet each shard's tree in groups of at most VALUES values, and the shards' winners merge.
    """
    import pickle

    spark = values.sparkSession
    built, shards = shard_trees(reference_entries(terms, labels, aliases), shard_entries)
    exact = terms.select(F.col("field").alias(field), F.col("term").alias(value)).distinct()
    todo = values.select(field, value).where(F.col(field).isNotNull() & F.col(value).isNotNull() & ~is_blank(F.col(value))).distinct()
    todo = todo.join(exact, [field, value], "left_anti").select(F.col(field).alias("_f"), F.col(value).alias("_v"))
    shape = "_f string, _v string, _stage int, _d int, _len int, _run string, _rank int, _id bigint"
    # lookups cost far more than their bytes tell, so the number of parts is set, not left to sizes
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = (9, 99, 0, "", 9, 0)

    def winners(canons, pdf):
        for f, part in pdf.groupby("_f", sort=False):
            asked = part["_v"].tolist()
            best = [none] * len(asked)
            for canon in canons:
                best = [min(x, y) if y else x for x, y in zip(best, canon.best(f, asked))]
            yield part.assign(**dict(zip(_KEY, map(list, zip(*best)))))[["_f", "_v", *_KEY]]

    if (built.agg(F.sum(F.length("tree"))).first()[0] or 0) <= sent_bytes:
        box = spark.sparkContext.broadcast([bytes(r["tree"]) for r in built.collect()])

        def run(batches):
            canons = [pickle.loads(b) for b in box.value]
            for pdf in batches:
                yield from winners(canons, pdf)

        out = todo.repartition(parts).mapInPandas(run, shape)
    else:
        todo = stage(todo, "values")
        parts = max(parts, -(-todo.count() // VALUES))
        v = todo.withColumn("_part", F.pmod(F.xxhash64("_f", "_v"), F.lit(parts)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        w = built.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

        def meet(asked, tree):
            import pandas as pd

            got = [*winners([pickle.loads(t) for t in tree["tree"]], asked[["_f", "_v"]])]
            return pd.concat(got) if got else pd.DataFrame(columns=["_f", "_v", *_KEY])

        out = v.groupBy("shard", "_part").cogroup(w.groupBy("shard", "_part")).applyInPandas(meet, shape)
        out = out.groupBy("_f", "_v").agg(F.min(F.struct(*_KEY)).alias("_b")).select("_f", "_v", "_b.*")
    return out.select(F.col("_f").alias(field), F.col("_v").alias(value), F.col("_id").alias("term_id"), F.when(F.col("_id") > 0, F.col("_d")).alias("edits"))


def typed_values(routes: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct (field, record_id, raw_value) of routes.tags and places.category, nulls left out."""
    tags = routes.select(F.lit("tags").alias("field"), F.col("route_id").alias("record_id"), F.explode(F.array_distinct("tags")).alias("raw_value"))
    cats = places.select(F.lit("category"), "place_id", "category")
    return tags.unionAll(cats).where("record_id is not null and raw_value is not null").distinct()


def map_values(records: DataFrame, terms: DataFrame, **options) -> DataFrame:
    """(field, record_id, raw_value, term_id): each record's values with the entry they mean, 0 if none."""
    found = match_values(records, terms, **options)
    return salted_join(records, found, ["field", "raw_value"], ["record_id"]).select("field", "record_id", "raw_value", "term_id")
