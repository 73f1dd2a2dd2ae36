"""Byte-pair encoding against the tokenizers library."""

import hashlib
import random
from array import array

import pytest
from tokenizers import Tokenizer

from wirelens.llm import queries, trie_bpe

SCHEMA = "doc_id long, text string, ids string, decoded string, n_tokens int"
BITS = ["the", "in", "g", "er", "ing", "aaaa", "a", "b", "'s", "'", "'ll", " ", "  ", "\n", "É", "Σ", "ΟΔΟΣ", "é", "<|endoftext|>", "<|startoftext|>", "<", "12", "...", "'S", "日本", "ß", "İ", "՘", "\U0001f600", "\x1c", "\x85", "​", "Ᲊ", "\U00010d50"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.WORD_VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    return trie_bpe.Encoder(trie_bpe.load_vocabulary(queries.WORD_VOCABULARY))


def one(encoder, text):
    return array("I", next(b"".join(x) for x in encoder.encode([text]))).tolist()


def test_equals_library_on_random_texts(library, encoder):
    r = random.Random(3)
    for k in range(6000):
        text = "".join(r.choice(BITS) for _ in range(r.randrange(1, 25))) if k % 2 else "".join(r.choice("abcdethinorsgl" if k % 4 else "aab") for _ in range(r.randrange(1, 40)))
        assert one(encoder, text) == library.encode(text, add_special_tokens=False).ids, text


def test_equals_library_on_characters(library, encoder):
    for c in [*range(0x3200), *range(0xA600, 0xA800), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F400)]:
        text = f"a{chr(c)}b {chr(c)}́"
        assert one(encoder, text) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_states_of_shared_prefixes_are_found_once(encoder, monkeypatch):
    trie = trie_bpe.Trie(encoder.vocabulary)
    words = ["station", "stationary", "stations", "stay", "station"]
    path, before, seen = [0], "", set()
    for w in sorted(words):
        trie.insert(w, path, trie_bpe.shared_prefix(before, w))
        before = w
        seen |= {w[:i] for i in range(1, len(w) + 1)}
        assert len(trie) == 1 + len(seen)


def test_emptied_caches_change_nothing(library, monkeypatch, sf):
    import pyarrow.parquet as pq

    monkeypatch.setattr(trie_bpe, "MOST_NODES", 50)
    monkeypatch.setattr(trie_bpe, "MOST_RUNS", 20)
    monkeypatch.setattr(trie_bpe, "MOST_PAIRS", 10)
    monkeypatch.setattr(trie_bpe, "PIECE_CHARS", 100)
    small = trie_bpe.Encoder(trie_bpe.load_vocabulary(queries.WORD_VOCABULARY))
    for text in pq.read_table(f"{sf}/documents.parquet").column("text").to_pylist()[:40]:
        assert one(small, text) == library.encode(text, add_special_tokens=False).ids


def test_query(spark, library, tmp_path):
    texts = [None, "", " \t\n", "x" * 30_000, "w " * 200_000, "é" * 70_000, "Hello, <|endoftext|>it's", "Hello, <|endoftext|>it's", "ab" * 100_000]
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)] + [(None, "lost id", "x", "y", 1), (3, "twice", "x", "y", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op11_bpe(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert trie_bpe.digests(docs.limit(0), trie_bpe.load_vocabulary(queries.WORD_VOCABULARY)).count() == 0


def test_encode_and_decode(spark, library):
    vocabulary = trie_bpe.load_vocabulary(queries.WORD_VOCABULARY)
    docs = spark.createDataFrame([(1, "The cat's <|endoftext|> Été", "x", "y", 1), (2, None, "x", "y", 1)], SCHEMA)
    coded = {r["doc_id"]: r for r in trie_bpe.encode(docs, vocabulary).collect()}
    assert coded[1]["ids"] == library.encode("The cat's <|endoftext|> Été", add_special_tokens=False).ids and coded[2]["ids"] == []
    rows = spark.createDataFrame([(1, coded[1]["ids"]), (2, []), (3, None), (4, [320, 9_999_999, -1, 2368])], "k int, ids array<int>")
    out = {r["k"]: r["decoded"] for r in trie_bpe.decode(rows, vocabulary).collect()}
    assert out == {1: coded[1]["decoded"], 2: "", 3: "", 4: library.decode([320, 2368], skip_special_tokens=False)} and coded[1]["decoded"] == library.decode(coded[1]["ids"], skip_special_tokens=False)
