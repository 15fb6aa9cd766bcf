"""SentencePiece codec and token blocks against the libraries."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from intake.llm import sentencepiece_bpe as S
from intake.llm import token_blocks as B

from .conftest import texts

ODD = list("abcdethe  \n\t  ▁éß0123🙂中́\xa0<s>\x00ñIS'sdremvl.,!?$%²½ªµº\x85\x1c") + [
    "  ", "the", "ing", "<0x0A>", "</s>", " " * 15, " " * 40, "<|endoftext|>", "<|", "'re", "İ", "Σ", "K", "é"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.default_model())


def test_sentencepiece_on_odd_texts(library):
    codec = S.Codec(S.default_model())
    for t in odd_texts(4000, 1):
        ids = library.encode(t)
        assert codec.encode(t) == ids, t
        assert codec.decode(ids) == library.decode(ids), t
    rng = random.Random(2)
    for _ in range(1000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 31999)]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_sentencepiece_caches_may_overflow(library, small, monkeypatch):
    monkeypatch.setattr(S, "CACHE", 50)
    monkeypatch.setattr(S, "PAIRS", 20)
    codec = S.Codec(S.default_model())
    for t in list(texts(small).values())[:40]:
        n, ids, _ = codec.digest(t)
        want = library.encode(t)
        assert (n, ids) == (len(want), S.hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())


def test_sentencepiece_round_trip(small):
    out = S.decode_documents(S.encode_documents(small.select("doc_id", "text")), out="back")
    assert all(r["back"] == r["text"] for r in out.collect())


def test_digests(library, small):
    import hashlib
    want = {d: library.encode(t) for d, t in texts(small).items()}
    for r in S.digest_documents(small).collect():
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for ids in ([], [0], [2**32 - 1], [5] * 9000, [0, 2**32 - 1] * 3000, rng.integers(0, 49408, 10_000),
                np.where(rng.random(9000) < 0.05, 2**31, rng.integers(300, 400, 9000))):
        ids = np.array(ids, np.uint32)
        at, blob = B.pack_all(ids)
        assert len(at) == -(-len(ids) // B.BLOCK)
        assert all((B.unpack(blob, a) == ids[k * B.BLOCK:(k + 1) * B.BLOCK]).all() for k, a in enumerate(at))


def test_block_width_is_of_the_many():
    ids = np.array([100 + i % 8 for i in range(4000)] + [60_000] * 96, np.uint32)
    blob = B.pack(ids)
    assert len(blob) == B._HEAD.size + 4096 * 3 // 8 + 96 * 6 and (B.unpack(blob) == ids).all()


def test_words_have_the_ids_of_the_whole_text():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), B.Encoder(path)
    for t in odd_texts(4000, 3):
        assert np.frombuffer(encoder.encode(t, b""), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encoder = Tokenizer.from_file(path), B.Encoder(path)
    for t in odd_texts(300, 4):
        assert np.frombuffer(encoder.encode(t, b""), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_files(small, monkeypatch):
    tokenizer = Tokenizer.from_file(B.default_tokenizer())
    got = {r["doc_id"]: r for r in B.round_trip(small).collect()}
    at = 0
    for d, t in sorted(texts(small).items()):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        r = got[d]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)


def test_starts_are_in_id_order_with_nulls_first(edge):
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"]) for r in B.round_trip(edge).collect()),
                 key=lambda r: (r[0], r[1], r[2]))
    at = 0
    for _, _, start, n in got:
        assert start == at
        at += n
