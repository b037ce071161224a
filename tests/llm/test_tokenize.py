import random

import pytest

from rodado.llm import tokenize as T

RANKS = {bytes([i]): i for i in range(256)}
for n, w in enumerate(("ab", "abc", "bc", "aa", "aaaa", " a", "é", "ló"), 256):
    RANKS[w.encode()] = n


def brute(piece: bytes, ranks) -> list[int]:
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        r, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if r == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_merges_against_brute_force():
    rnd = random.Random(3)
    for _ in range(500):
        p = "".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 40))).encode()
        assert T.merge_short(p, RANKS) == T.merge_long(p, RANKS) == brute(p, RANKS)


@pytest.fixture(scope="module")
def lib():
    tok = pytest.importorskip("tokenizers")
    t = tok.Tokenizer.from_file(T.vocabulary().replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_same_ids_as_the_library(lib):
    rnd = random.Random(5)
    pool = [chr(c) for c in (*range(0x20, 0x250), 0x85, 0xA0, 0x2028, 0x3000, 0x1C, 0x660, 0x4E00, 0x1F600, 0xAC00, 0x301, 0xB2, 0x2160, 0xFEFF, 0x200D)]
    enc = T.encoder(T.vocabulary())
    for _ in range(2000):
        s = "".join(rnd.choice(pool) if rnd.random() < 0.5 else rnd.choice(" \n\tabcs't<|endoftext|>12") for _ in range(rnd.randint(1, 40)))
        assert enc.encode(s) == lib(s)
    for s in ("a" * 5000, " " * 3000 + "x", "é" * 700, "<|endoftext|>"):
        assert enc.encode(s) == lib(s)


def test_corpus(spark, lib):
    rows = [(1, "Hola, ¿qué tal?", 0), (2, None, 0), (3, "", 0), (4, "x" * 100_000, 0), (1, "Hola, ¿qué tal?", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = [(r["doc_id"], r["ids"]) for r in T.encode_corpus(df).collect()]
    assert sorted(got) == sorted((i, lib(t) if t else []) for i, t, _ in rows)
    n = {(r["doc_id"], r["n_tokens"]) for r in T.count_tokens(df).collect()}
    assert n == {(i, len(x)) for i, x in got}
    assert T.encode_corpus(df.limit(0)).collect() == []


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "REMEMBER", 3)
    e = T.Encoder(T.load_ranks(T.vocabulary()))
    text = "uno dos tres cuatro cinco seis siete dos uno"
    assert e.encode(text) == T.Encoder(e.ranks).encode(text) and len(e) <= 4
