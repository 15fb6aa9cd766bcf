import random

import pytest
import xxhash

from intake.llm.graph import connected_components
from intake.llm.simhash import fingerprint, simhash_components, star_edges

from .conftest import Sets, texts


def slow_fingerprint(text, words=3):
    found = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
        "\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


@pytest.mark.parametrize("text", [None, "", " ", "a", "a B", "a b c", "É A b c d", "x y z " * 50, "\x1cq \x85 w e r"])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_components_of_documents(small):
    got = {r["doc_id"]: r for r in simhash_components(small).collect()}
    prints = {d: slow_fingerprint(t) for d, t in texts(small).items()}
    sets = Sets()
    for a in prints:
        sets.find(a)
        for b in prints:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3:
                sets.join(a, b)
    assert {d: (r["fp"] % 2**64, r["component_id"]) for d, r in got.items()} == {d: (prints[d], sets.find(d)) for d in prints}


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_links_of_dense_balls(spark, bits):
    """Closure over stars equals closure over all pairs, and every star edge is a link."""
    rng = random.Random(bits)
    values = {0, 2**64 - 1}
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(6):
            v = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                v ^= 1 << b
            values.add(v)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    edges = star_edges(spark.createDataFrame([(signed(v),) for v in values], "fp long"), bits).collect()
    got, want = Sets(), Sets()
    for a, b in edges:
        assert 0 < bin((a ^ b) % 2**64).count("1") <= bits
        got.join(a, b)
    values = sorted(map(signed, values))
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if bin((a ^ b) % 2**64).count("1") <= bits:
                want.join(a, b)
    assert all(got.find(v) == want.find(v) for v in values)


def test_connected_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    noise = [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    pairs = chain + star + noise + [(7, 7), (-3, 7), (7, -3)]
    want = Sets()
    for a, b in pairs:
        want.join(a, b)
    frame = spark.createDataFrame(pairs + [(None, 1), (2, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert got == {x: want.find(x) for p in pairs for x in p if p[0] != p[1]}
    assert connected_components(frame.where("false")).count() == 0
