import random
from itertools import product

import pytest

from tests.helpers import table
from tidemark.llm import bpe, encoding

PATH = f"{encoding.TOKENIZERS}/{encoding.VOCABULARY}"


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def corpus():
    return encoding.CorpusEncoder(bpe.read_ranks(PATH))


def ids(packed: bytes) -> list[int]:
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def test_random_texts(corpus, reference):
    rng = random.Random(8)
    letters = list("abcdefgh  \n\t'se\r.,12²½é中文🙂� 　\xa0　ßЖا") + ["'re", "'ll", " the", "\n\n", "  ", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(4000)]
    assert [ids(p) for p in corpus.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_all_blank_and_break_mixes(corpus, reference):
    texts = ["".join(t) for n in range(1, 7) for t in product(" \na", repeat=n)]
    assert [ids(p) for p in corpus.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_plain_bpe_on_a_small_vocabulary():
    """Against merging pair by pair, for every word over two letters."""
    ranks = {b"a": 0, b"b": 1, b"ab": 2, b"aa": 3, b"bab": 4, b"aab": 5, b"abab": 6, b"bb": 7, b"bbb": 8, b"aaaa": 9}

    def plain(word: bytes) -> list[int]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            best = min(((ranks.get(x + y, 99), i) for i, (x, y) in enumerate(zip(parts, parts[1:]))), default=(99, 0))
            if best[0] == 99:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    words = ["".join(t) for n in range(1, 11) for t in product("ab", repeat=n)]
    trie = bpe.TrieEncoder(ranks)
    trie.add(words)
    assert {w: ids(trie.words[w]) for w in words} == {w: plain(w.encode()) for w in words}


def test_long_words_and_full_caches(reference, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 10)
    monkeypatch.setattr(encoding, "PIECES_KEPT", 10)
    monkeypatch.setattr(encoding, "TEXTS_AT_ONCE", 2)
    small = encoding.CorpusEncoder(bpe.read_ranks(PATH))
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdef") for _ in range(20_000)), "=" * 5000, "一" * 3000] + [f"w{i} x{i} y{i}" for i in range(200)] * 2
    assert [ids(p) for p in small.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_operator(spark, reference):
    rows = [(1, "One text.\n\nTwo."), (2, None), (3, ""), (4, "  \n "), (4, "twin"), (None, "no id")]
    df = table(spark, "doc_id bigint, text string, ids string, tokens string", [(*r, "x", "y") for r in rows])
    got = sorted(((r["doc_id"], r["ids"]) for r in encoding.token_ids(df, "doc_id", "text").collect()), key=repr)
    assert got == sorted(((i, reference.encode_ordinary(t or "")) for i, t in rows), key=repr)
    counts = sorted(((r["doc_id"], r["tokens"]) for r in encoding.token_counts(df, "doc_id", "text").collect()), key=repr)
    assert counts == sorted(((i, len(reference.encode_ordinary(t or ""))) for i, t in rows), key=repr)
    assert encoding.token_ids(df.limit(0), "doc_id", "text").collect() == []


def test_whole_documents(spark, data, reference):
    from tidemark.llm.queries import p7_ids

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = {r["doc_id"]: r["ids"] for r in p7_ids(spark, data).collect()}
    assert got == {d: reference.encode_ordinary(t or "") for d, t in texts.items()}
