"""Subject areas of documents, by subject-specific interpolated n-gram language models.

1. Each text is reduced to the sentences of its prose: front matter, tables, code, comments and headings are left out.
2. For each subject and for the background, bigram models interpolated with unigrams are trained on the sentences of
   hand-labelled documents. Which sentence of a labelled document deals with its subject isn't given, so training
   alternates: sentences are shared out between the background and the document's subjects by the models so far, and
   the models are re-estimated from the shares. A small share may go to subjects the document isn't labelled with.
3. A sentence deals with the subject whose per-token cross-entropy is lowest, if it is enough below the background's.
4. A document is accepted for every subject with at least a share ``cut`` of its sentences. Cut and margin are
   calibrated on held-out folds of the labelled documents.

Only the labelled documents train the models, those with the smallest hashed ids, at most ``LABELLED`` of them and
``LABELLED_CHARS`` characters; the models' size is bounded by that. Every document is scored, whole, in one pass without a shuffle.

What is defined here: null, empty and blank texts and texts without prose have no subject. Without any labelled
document no document has one. Repeated ids come out once for each subject.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: Labelled documents that may train the models, and characters they may have together: both bound what goes to the driver.
LABELLED, LABELLED_CHARS = 3_000, 50_000_000
ROUNDS = 8
FOLDS = 4
#: Weights of the bigram and unigram estimates; the rest of the mass lies on the words of all classes together.
BIGRAM, UNIGRAM = 0.3, 0.69
#: Weight of a subject's own model; the rest is the background's, so that words of any subject cost little.
OWN = 0.5
#: Words met in fewer labelled documents say nothing.
MIN_DOCS = 2
#: Share of subjects that aren't among a document's labels, in the first guess.
STRAY = 0.05

_FRONT = re.compile(r"\A\s*---[ \t]*\n.*?\n---[ \t]*(?:\n|\Z)", re.S)
_FENCE = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1[^\n]*$|\Z)", re.S | re.M)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_SKIP = re.compile(r"^\s*(\||#|(?:\*\s*){3,}$|(?:-\s*){3,}$|:?-+:?\s*\|)")
_LINK = re.compile(r"!?\[([^\]]*)\]\([^)]*\)")
_CODE = re.compile(r"`[^`\n]*`")
_URL = re.compile(r"\S*(?:://|@)\S*")
_MARK = re.compile(r"^\s*(?:[-*+>]|\d+[.)])\s+|[*_]{1,3}(?=\S)|(?<=\S)[*_]{1,3}")
_END = re.compile(r"[.!?…]+[\"»”’)]*(?:\s+|$)")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> list[str]:
    """The sentences of a Markdown text's prose."""
    if not text:
        return []
    t = text.replace("​", "").replace("﻿", "").replace("\r\n", "\n")
    if "---" in t:
        t = _FRONT.sub("", t, count=1)
    if "<!--" in t:
        t = _COMMENT.sub(" ", t)
    if "```" in t or "~~~" in t:
        t = _FENCE.sub("", t)
    out = []
    for line in t.split("\n"):
        if not line or _SKIP.match(line):
            continue
        if "](" in line:
            line = _LINK.sub(r"\1", line)
        if "`" in line:
            line = _CODE.sub(" ", line)
        if "://" in line or "@" in line:
            line = _URL.sub(" ", line)
        line = _MARK.sub("", line)
        out += [s for s in _END.split(line) if _WORD.search(s)]
    return out


@lru_cache(maxsize=200_000)
def _token(w: str) -> str:
    t = unicodedata.normalize("NFKD", w)
    return "".join(c for c in t if not unicodedata.combining(c)).casefold()


def words(sentence: str) -> list[str]:
    """Folded words; those with a capital inside a sentence are names and become one token."""
    if not sentence.isascii():
        sentence = unicodedata.normalize("NFC", sentence)
    out = []
    for i, w in enumerate(_WORD.findall(sentence)):
        out.append("<name>" if i and w[0].isupper() else _token(w))
    return out


class Models:
    """Log-probability tables of the background (class 0) and the subjects, ready to score sentences."""

    def __init__(self, subjects: list[str], vocab: dict[str, int], pairs, uni, bi):
        # vocab: word -> 1.. (0 is any other word); pairs: sorted keys h * size + w; uni, bi: (classes, entries)
        self.subjects, self.vocab, self.pairs, self.uni, self.bi = subjects, vocab, pairs, uni, bi
        self.size = len(vocab) + 1

    def ids(self, tokenised: list[list[str]]):
        """(flat word numbers with a 0 before each sentence, lengths)."""
        import numpy as np

        get = self.vocab.get
        flat = [get(w, 0) for s in tokenised for w in ("", *s)]
        return np.array(flat, dtype=np.int64), np.array([len(s) + 1 for s in tokenised], dtype=np.int64)

    def gains(self, tokenised: list[list[str]]):
        """(sentences, subjects): bits per token that each subject's model saves against the background's."""
        import numpy as np

        if not tokenised:
            return np.zeros((0, len(self.subjects)))
        flat, size = self.ids(tokenised)
        starts = np.cumsum(size) - size
        lp = self._tokens(flat)
        lp[:, starts] = 0  # the marker before a sentence isn't a word
        total = np.add.reduceat(lp, starts, axis=1)
        return ((total[1:] - total[0]) / np.maximum(size - 1, 1) / np.log(2)).T

    def _tokens(self, flat):
        import numpy as np

        key = np.empty_like(flat)
        key[0], key[1:] = flat[0], flat[:-1] * self.size + flat[1:]
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        known = self.pairs[at] == key if len(self.pairs) else np.zeros(len(key), bool)
        lp = self.uni[:, flat]
        lp[:, known] = self.bi[:, at[known]]
        return lp


def train(docs: list[list[list[str]]], labels: list[set[int]], subjects: list[str], rounds: int = ROUNDS) -> Models:
    """Models from tokenised sentences of labelled documents; labels number the subjects from 0."""
    import numpy as np

    k = len(subjects) + 1
    df: dict[str, int] = {}
    for d in docs:
        for w in {w for s in d for w in s}:
            df[w] = df.get(w, 0) + 1
    vocab = {w: i for i, w in enumerate(sorted(w for w, n in df.items() if n >= MIN_DOCS), 1)}
    size = len(vocab) + 1
    sents = [s for d in docs for s in d if s]
    own = np.array([i for i, d in enumerate(docs) for s in d if s], dtype=np.int64)
    blank = Models(subjects, vocab, np.zeros(0, np.int64), np.zeros((k, size)), np.zeros((k, 0)))
    if not sents:
        return blank
    flat, length = blank.ids(sents)
    starts = np.cumsum(length) - length
    key = np.empty_like(flat)
    key[0], key[1:] = flat[0], flat[:-1] * size + flat[1:]
    real = np.ones(len(flat), bool)
    real[starts] = False
    key, word = key[real], flat[real]
    sent = np.repeat(np.arange(len(sents)), length - 1)
    pairs, pair_of = np.unique(key, return_inverse=True)
    head, tail = pairs // size, pairs % size
    n_tok = length - 1
    first = np.cumsum(n_tok) - n_tok
    allowed = np.full((len(docs), k), STRAY)
    allowed[:, 0] = 1.0
    for i, l in enumerate(labels):
        for s in l:
            allowed[i, s + 1] = 1.0
    prior = allowed[own]
    share = prior / prior.sum(1, keepdims=True)
    everything = np.bincount(word, minlength=size) + 0.5
    q = everything / everything.sum()
    def estimate(w_sent):
        """Interpolated estimates from sentences by weight: P(word), P(word | word before) at the known pairs."""
        w = w_sent[sent]
        u, b = np.bincount(word, w, size), np.bincount(pair_of, w, len(pairs))
        heads = u.copy()
        heads[0] += w_sent.sum()  # a sentence's start is number 0, too
        pu = UNIGRAM * u / max(u.sum(), 1e-9) + (1 - BIGRAM - UNIGRAM) * q
        return pu, BIGRAM * np.minimum(b / np.maximum(heads[head], 1e-9), 1.0) + pu[tail]

    all_uni, all_bi = estimate(np.ones(len(sents)))
    uni, bi = np.empty((k, size)), np.empty((k, len(pairs)))
    for turn in range(rounds + 1):
        for c in range(k):
            u, b = estimate(share[:, c])
            uni[c], bi[c] = np.log(OWN * u + (1 - OWN) * all_uni), np.log(OWN * b + (1 - OWN) * all_bi)
        if turn == rounds:
            break
        lp = np.stack([np.add.reduceat(bi[c][pair_of], first) for c in range(k)], axis=1)
        post = lp + np.log(prior * np.maximum(share.mean(0), 1e-4))
        post = np.exp(post - post.max(1, keepdims=True))
        share = post / post.sum(1, keepdims=True)
    return Models(subjects, vocab, pairs, uni, bi)


#: Bits per token that a subject must save for a sentence to deal with it: what calibration chooses from.
MARGINS = (0.15, 0.03, 0.06, 0.1, 0.25, 0.4)
CUTS = tuple(round(0.10 + 0.005 * i, 3) for i in range(61))


def judged(models: Models, docs: list[list[list[str]]]):
    """For each sentence of the documents: its document, the best subject, and what it saves; and sentences a document."""
    import numpy as np

    n = np.array([len(d) for d in docs], dtype=np.int64)
    flat = [s for d in docs for s in d]
    if not flat or not models.subjects:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), n
    g = models.gains(flat)
    best = g.argmax(1)
    return np.repeat(np.arange(len(docs)), n), best, g[np.arange(len(g)), best], n


def shares_of(models: Models, docs: list[list[list[str]]], margin: float):
    """(documents, subjects): the share of each document's sentences that deal with each subject; and sentence counts."""
    own, best, saved, n = judged(models, docs)
    return _shares(own, best, saved, n, len(models.subjects), margin), n


def _shares(own, best, saved, n, subjects: int, margin: float):
    import numpy as np

    out = np.zeros((len(n), subjects))
    deals = saved >= margin
    np.add.at(out, (own[deals], best[deals]), 1)
    return out / np.maximum(n, 1)[:, None]


def calibrate(docs, labels, subjects, folds: int = FOLDS):
    """(margin, cut, F1) that tell labelled subjects from others best, on held-out folds.

    Of cuts that do about as well the middle one. With few documents the defaults stay.
    """
    import numpy as np

    if len(docs) < 2 * folds:
        return MARGINS[0], 0.25, 0.0
    held = []
    for f in range(folds):
        inside = [i for i in range(len(docs)) if i % folds != f]
        outside = [i for i in range(len(docs)) if i % folds == f]
        m = train([docs[i] for i in inside], [labels[i] for i in inside], subjects, rounds=4)
        held.append((judged(m, [docs[i] for i in outside]), np.array([[k in labels[i] for k in range(len(subjects))] for i in outside])))
    truth = np.concatenate([t for _, t in held]).ravel()
    best = (MARGINS[0], 0.25, -1.0)
    for margin in MARGINS:
        s = np.concatenate([_shares(*j, len(subjects), margin) for j, _ in held]).ravel()
        f1 = [2 * ((s >= c) & truth).sum() / max(1, (s >= c).sum() + truth.sum()) for c in CUTS]
        if max(f1) > best[2] + 0.003:
            best = (margin, float(np.median([c for c, v in zip(CUTS, f1) if v > max(f1) - 0.002])), float(max(f1)))
    return best


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "subject", most: int = LABELLED, chars: int = LABELLED_CHARS) -> tuple[Models, float, float]:
    """(models, margin, cut) from at most ``most`` labelled documents with at most ``chars`` characters in all."""
    own = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.collect_set(label).alias("_labels"))
    own = own.orderBy(F.xxhash64(key), key).limit(most)
    held = stage(docs.select(key, F.col(text).cast("string").alias("_t")).join(F.broadcast(own), key).dropDuplicates([key]), "labelled")
    # a running sum over at most ``most`` rows; the texts themselves don't take part in the sort
    sizes = held.select(F.col(key).alias("_key"), F.coalesce(F.length("_t"), F.lit(0)).alias("_n"))
    so_far = F.sum("_n").over(Window.orderBy(F.xxhash64("_key"), "_key").rowsBetween(Window.unboundedPreceding, 0))
    fits = sizes.withColumn("_sum", so_far).where(F.col("_sum") <= chars).select(F.col("_key").alias(key))
    rows = held.join(F.broadcast(fits), key, "left_semi").collect()
    rows.sort(key=lambda r: r[key])
    subjects = sorted({s for r in rows for s in r["_labels"]})
    number = {s: i for i, s in enumerate(subjects)}
    tokens = [[words(s) for s in sentences(r["_t"])] for r in rows]
    given = [{number[s] for s in r["_labels"]} for r in rows]
    margin, cut, _ = calibrate(tokens, given, subjects)
    return train(tokens, given, subjects), margin, cut


def score(docs: DataFrame, models: Models, margin: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, subject, share, sentences) for each document and each subject that any of its sentences deals with."""
    box = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        m = box.value
        for b in batches:
            s, n = shares_of(m, [[words(x) for x in sentences(t)] for t in b.column(1).to_pylist()], margin)
            i, k = np.nonzero(s)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(i)), pa.array([m.subjects[x] for x in k], pa.string()), pa.array(s[i, k]), pa.array(n[i].astype(np.int32))],
                [key, "subject", "share", "sentences"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("_t")).mapInArrow(run, f"`{key}` {kind}, subject string, share double, sentences int")


def subject_areas(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "subject") -> DataFrame:
    """(key, subject, share, sentences) of the accepted subjects of every document, labelled ones included."""
    models, margin, cut = fit(docs, labels, key, text, label)
    return score(docs, models, margin, key, text).where(F.col("share") >= cut)


def unlabelled_areas(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """As :func:`subject_areas`, of the documents that no hand has labelled."""
    return subject_areas(docs, labels, key).join(labels.select(key).distinct(), key, "left_anti")
