"""Packing: every id in exactly one place, sequences gapless and full, whatever the partitions."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from intake.llm import packing as P
from intake.llm import token_blocks as B

from .conftest import rows


def blob(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def check(sequences, want, limit):
    """``sequences`` as collected from ``read``; ``want``: (doc_id, ids) of every document."""
    whole = Counter((d, blob(ids)) for d, ids in want)
    parts = defaultdict(list)
    tail = []
    for r in sequences:
        size = len(r["ids"]) // 4
        at = 0
        for p in sorted(r["pieces"], key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            parts[p["doc_id"], p["doc_tokens"]].append((p["start"], r["ids"][4 * at:4 * (at + p["length"])]))
            at += p["length"]
        assert at == size
        if size != limit:
            tail.append(size)
    # no padding: all full but the last, which are different powers of two
    assert len(tail) == len(set(tail)) and all(s & (s - 1) == 0 for s in tail)
    assert sum(tail) < limit
    assert len({r["sequence_id"] for r in sequences}) == len(sequences)
    got = Counter()
    for (doc_id, n), found in parts.items():
        copies = sum(k for (d, ids), k in whole.items() if d == doc_id and len(ids) == 4 * n)
        if copies == 1:
            found.sort()
            assert [s for s, _ in found] == np.cumsum([0] + [len(i) // 4 for _, i in found])[:-1].tolist()
            got[doc_id, b"".join(i for _, i in found)] += 1
        else:  # rows of one id: as many ids at each place
            assert sum(len(i) // 4 for _, i in found) == copies * n
            got[doc_id, None] += copies
    again = Counter()
    for (d, ids), k in whole.items():
        same = sum(v for (e, i), v in whole.items() if e == d and len(i) == len(ids))
        again[(d, ids) if same == 1 else (d, None)] += k
    assert got == again


def test_packer_is_best_fit_and_bounded():
    p = P.Packer(8, 2)
    put = lambda d, n: p.place(d, False, 0, n, blob([d] * n))
    put(1, 5)
    put(2, 6)                                  # does not fit in room 3: second window
    put(3, 2)                                  # best fit: room 2, not 3
    assert [[x[0] for x in w] for w in p.done] == [[2, 3]]
    put(4, 7)
    assert len(p.held) == 2 and not p.done[1:]
    put(5, 4)                                  # none fits, none may open: the fullest (room 1) is topped up and goes
    assert [[(x[0], len(x[4]) // 4) for x in w] for w in p.done[1:]] == [[(4, 7), (5, 1)], [(1, 5), (5, 3)]]
    put(6, 20)                                 # whole sequences first
    assert [[(x[0], x[2]) for x in w] for w in p.done[3:]] == [[(6, 0)], [(6, 8)]]
    assert [[(x[0], x[2], len(x[4]) // 4) for x in w] for w in p.leave()] == [[(6, 16, 4)]]


def test_rest_is_cut_into_powers_of_two():
    rng = random.Random(4)
    for _ in range(200):
        windows = [[(i, False, 0, n, blob([i] * n)) for i, n in enumerate(rng.choices(range(1, 9), k=3))] for _ in range(rng.randint(0, 5))]
        out = P.cut_rest(windows, 16)
        total = sum(len(x[4]) // 4 for w in windows for x in w)
        sizes = [sum(len(x[4]) // 4 for x in w) for w in out]
        assert sum(sizes) == total and sizes == [16] * (total // 16) + [1 << k for k in (3, 2, 1, 0) if total % 16 >> k & 1]


@pytest.mark.parametrize("parts, limit, windows", [(1, 4096, 32), (40, 64, 3), (23, 512, 1), (7, 4, 8)])
def test_pack_real_texts(small, parts, limit, windows, monkeypatch):
    monkeypatch.setattr(P, "FAN", 3)           # several rounds
    tokenizer = Tokenizer.from_file(B.default_tokenizer())
    docs = small.limit(60)
    want = [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]
    check(P.pack(docs.repartition(parts), limit=limit, windows=windows).collect(), want, limit)


def test_edges(edge, nothing):
    tokenizer = Tokenizer.from_file(B.default_tokenizer())
    want = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _ in rows()]
    check(P.pack(edge).collect(), want, P.LIMIT)
    assert P.pieces(P.pack(nothing)).count() == 0


def test_pieces_and_rerun(spark, small, tmp_path):
    docs = small.select("doc_id", "text")
    first = P.pieces(P.pack(docs, str(tmp_path / "a")))
    assert first.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    again = P.pieces(P.pack(docs, str(tmp_path / "b")))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    tokenizer = Tokenizer.from_file(B.default_tokenizer())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in first.limit(50).collect():
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [2]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(blob(ids[r["start"]:r["start"] + r["length"]]))


def test_settings_are_checked(small):
    for bad in ({"limit": 100}, {"windows": 0}, {"limit": 0}):
        with pytest.raises(ValueError):
            P.pack(small, **bad)
