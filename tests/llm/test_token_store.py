from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import ODD
from tickforge.llm import token_store as ts
from tickforge.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _truth(rows):
    tok = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def _run(spark, docs):
    root = scratch_path(spark, "t")
    df = ts.read_store(ts.write_store(docs, root, PATH), root)
    return sorted(map(tuple, df.collect()), key=lambda r: r[1])


def test_store_equals_whole_text_encoding(spark, make_docs, some_docs, monkeypatch):
    monkeypatch.setattr(ts, "SHARD_TOKENS", 5_000)
    assert _run(spark, make_docs(some_docs + ODD)) == _truth(some_docs + ODD)


def test_empty_table(spark, make_docs):
    assert _run(spark, make_docs([])) == []


def test_words_join_like_whole_texts(monkeypatch):
    monkeypatch.setattr(ts, "CACHE_BYTES", 5_000)
    monkeypatch.setattr(ts, "JOINED", 7)
    tok, enc, rnd = Tokenizer.from_file(PATH), ts.WordEncoder(PATH), random.Random(5)
    alphabet = ["a", "B", "'s", " ", " ", "\n", "\t", " ", "1", ".", "é", "<|endoftext|>", "\x1c", " "]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(0, 25))) for _ in range(3_000)]
    codes = [c for k in range(0, len(texts), 9) for c in enc.encode(texts[k:k + 9])]
    for text, code in zip(texts, codes):
        assert np.frombuffer(code, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_without_spaces_and_the_cache_bound(monkeypatch):
    """Single words of any length: the same ids, and the cache turns over by bytes."""
    monkeypatch.setattr(ts, "CACHE_BYTES", 200_000)
    tok, enc, rnd = Tokenizer.from_file(PATH), ts.WordEncoder(PATH), random.Random(6)
    texts = ["".join(rnd.choices("abcé漢字😀", k=rnd.choice([1, 50, 20_000]))) for _ in range(60)]
    texts += [f"{a} {b}" for a, b in zip(texts, reversed(texts))]
    for k in range(0, len(texts), 10):
        for text, code in zip(texts[k:k + 10], enc.encode(texts[k:k + 10])):
            assert np.frombuffer(code, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        # one generation more than the bound, and the words of one group
        assert enc.held <= 200_000 + 10 * 20_000 * 12


def test_texts_are_encoded_in_large_bounded_groups():
    """Groups share their new words: few calls of the tokenizer, and never more letters than the bound."""
    rnd = random.Random(9)
    rows = [(i, " ".join(f"w{rnd.randrange(300)}" for _ in range(20))) for i in range(2_500)]
    rows += [(9_000 + i, "x" * n) for i, n in enumerate([ts.GROUP_LETTERS + 5, 3, ts.GROUP_LETTERS - 3, 1, 0])]
    groups = list(ts.grouped(iter(rows)))
    assert [r for g in groups for r in g] == rows and list(ts.grouped([])) == []
    assert [len(g) for g in groups] == [1_000, 1_000, 500, 1, 2, 2]
    assert all(len(g) == 1 or sum(len(t) for _, t in g) <= ts.GROUP_LETTERS for g in groups)
    tok, enc, calls, learn = Tokenizer.from_file(PATH), ts.WordEncoder(PATH), [], ts.WordEncoder._learn
    enc._learn = lambda words: (calls.append(len(words)), learn(enc, words))
    got = [c for g in groups[:3] for c in enc.encode([t for _, t in g])]
    assert sum(calls) == 300 and len(calls) == 3
    assert all(np.frombuffer(c, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids for c, (_, t) in zip(got, rows))


def test_direct_access():
    rnd = random.Random(7)
    ids = [rnd.choice([0, 5, 255, 256, 50_256, 70_000, 2**32 - 1, 1 << 24]) for _ in range(1_000)]
    codes = [np.asarray(ids[:400], "<u4").tobytes(), b"", np.asarray(ids[400:], "<u4").tobytes()]
    shard = ts.shard_from_bytes(ts.pack_shard([4, None, 9], codes))
    assert [shard.token(i) for i in range(1_000)] == ids == shard.tokens().tolist()
    assert [shard.doc_id(k) for k in range(3)] == [4, None, 9]
    assert shard.first.tolist() == [0, 400, 400, 1_000]
