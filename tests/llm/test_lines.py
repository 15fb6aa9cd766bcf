import numpy as np

from intake.llm import line_dedup as L

from .conftest import texts


def brute(docs: dict, min_docs=3, min_chars=20):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for d, t in docs.items():
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(d)
    lost = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    return {d: "\n".join(x for x in (t or "").split("\n") if lost.get(key(x), d) == d) for d, t in docs.items()}


def result(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_batch(small):
    assert result(L.dedup_lines(small)) == brute(texts(small))


def test_insert_and_delete_are_reversible(small):
    docs = small.select("doc_id", "text")
    first, second = docs.where("doc_id % 3 <> 0").cache(), docs.where("doc_id % 3 = 0").cache()
    one = L.build(first)
    both = L.insert(one, second)
    assert result(L.clean(both, docs)) == brute(texts(docs))
    back = L.delete(both, second.select("doc_id"))
    assert result(L.clean(back, first)) == brute(texts(first))
    assert sorted(back.refs.collect()) == sorted(one.refs.collect())
    held = {(r["k1"], r["k2"]) for r in L.common_keys(one.refs, 3).collect()}
    for blob in back.filters.collect():
        mine = np.array([k1 for k1, k2 in held if k2 % back.shards == blob["shard"]], np.int64).view(np.uint64)
        chain = L.Chain(bytes(blob["blob"]))
        assert chain.contains(mine).all()
        assert sum(np.count_nonzero(f.slots) + len(f.stash) for f in chain.filters) == len(mine)


def test_many_shards_and_salts(small, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 5)
    monkeypatch.setattr(L, "GROUP_ROWS", 20)
    assert result(L.dedup_lines(small)) == brute(texts(small))


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    chain = L.Chain()
    chain.add(h[:300])
    chain.add(h[300:])
    assert chain.contains(h).all()
    again = L.Chain(chain.blob())
    assert again.contains(h).all() and again.contains(rng.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.01
    again.remove(h[:10_000])
    assert again.contains(h[10_000:]).all() and again.contains(h[:10_000]).mean() < 0.01
    same = np.full(50, h[0])  # more equal tags than both buckets hold: the stash takes the rest
    chain = L.Chain()
    chain.add(same)
    assert chain.contains(same).all()
    chain.remove(same)
    assert not chain.contains(same).any()


def test_long_texts_whose_lines_are_all_shared(spark):
    lines = [f"this line is shared by all copies {i % 2900}" for i in range(3000)]
    rows = [(i, "\n".join(lines + [f"own line of document number {i}", "short"])) for i in range(3)]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"])
           for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in (0, 1):
        assert got[i] == (3002, 3000, f"own line of document number {i}\nshort")
    assert got[2] == (3002, 0, rows[2][1])


def test_large_removals_after_small_insertions_lose_no_key():
    """Keys of the large first filter that look like a later one's in the small filter."""
    rng = np.random.default_rng(3)
    first = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    large = L.Chain()
    large.add(first)
    large.filters[-1].stash += [(0, 0)] * large.filters[-1].slots.size  # counts as full: the next keys open a filter
    later = first[:64] ^ np.uint64(1 << 12)  # same tag, same buckets in a filter of 2^12 buckets or fewer
    large.add(later)
    assert len(large.filters) == 2 and len(large.filters[1].slots) < 1 << 12 < len(large.filters[0].slots)
    again = L.Chain(large.blob())
    again.remove(first[:10_000])
    assert again.contains(later).all() and again.contains(first[10_000:]).all()
    again.remove(later)
    again.remove(first[10_000:])
    assert not any(np.count_nonzero(f.slots) for f in again.filters)


def test_groups_of_a_hot_shard_are_bounded(spark, monkeypatch):
    """Half of the rows are one line's, in one of 50 shards."""
    monkeypatch.setattr(L, "GROUP_ROWS", 100)
    rows = spark.range(10_000).selectExpr("id as k1", "case when id % 2 = 0 then 7 else id end as k2", "id as doc_id")
    lines, salts = L.salted(rows, 50)
    sizes = {(r["shard"], r["salt"]): r["count"] for r in lines.groupBy("shard", "salt").count().collect()}
    assert sum(sizes.values()) == 10_000 and max(sizes.values()) <= 200
    number = {r["shard"]: r["salts"] for r in salts.collect()}
    assert all(0 <= salt < number[shard] for shard, salt in sizes) and number[7] == 52 and number[9] == 2


def test_a_hot_line_in_several_groups_is_dropped_alike(small, monkeypatch):
    docs = small.selectExpr("doc_id", "concat('A line that every one of the documents holds.\n', text) as text")
    monkeypatch.setattr(L, "GROUP_ROWS", 50)
    assert result(L.dedup_lines(docs)) == brute(texts(docs))
