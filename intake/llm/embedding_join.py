"""Embedding near-dedup by a subspace pigeonhole join.

Vectors are scaled to length one, rotated by a fixed random rotation, which
spreads differences evenly over coordinates, and rounded to 16-bit whole
numbers.  cosine >= c means a squared distance of at most 2 - 2c, and of at most
a known ``most`` between rounded vectors; with the vector split into blocks, at
least one block then has at most its proportional share of that.  So each block
is range-joined under its own share, and the union over blocks misses no pair.
All of this is whole-number arithmetic, the same in every task.

The range join of a block sweeps its rows in order of one coordinate; pairs must
then be in range in each coordinate before their distance is evaluated.  A label
of at most ``CHUNK`` vectors is one task that joins block by block.  A larger one
is cut by a grid over the first coordinates of each block, the more of them the
larger the label: a vector is at home in one cell and a guest in those later
neighbour cells that its range touches; guests meet hosts only.  Cells that are
still crowded (copies by the thousand) are dealt in chunk pairs of bounded size.

A pair is counted in its first block in range only.  Its rounded distance tells
whether it links, but for a narrow band around the threshold: pairs in it leave
the task and are settled by the cosine of their original components.  No other
pair leaves a task: it returns one row per vector with its number of links and
the smallest vector of its group there.

Equal vectors of one label are one node with a count.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import cut, frozen
from intake.llm.graph import connected_components

BLOCK_DIMS, GRID_DIMS = 8, 3                # GRID_DIMS: most coordinates of a block that the grid cuts
CHUNK, TILE, WIDE = 16384, 128, 8192        # rows of a task's chunk; rows swept at once and their partners
STEP = 1 << 21                              # components of pairs gathered at once
SCALE = 32766                               # whole units of a component of 1
SEED = 11


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int, block_dims: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    n = -(-dims // block_dims)
    edges = [round(i * dims / n) for i in range(n + 1)]
    return list(zip(edges, edges[1:]))


def usable(v: Column) -> Column:
    """Not null, finite and not zero, in every component and as a whole."""
    return (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))


def _scaled(vectors: pd.Series) -> np.ndarray:
    """Vectors of equal length, each divided by a power of two: exact, and squares neither overflow nor vanish."""
    v = np.array(vectors.tolist(), np.float64)
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def turned(vectors: pd.Series) -> np.ndarray:
    """Rotated unit vectors in whole units of 1 / SCALE."""
    v = _scaled(vectors)
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.rint(v @ rotation(v.shape[1]) * SCALE).astype(np.int16)


def bounds(dims: int, cosine: float) -> tuple[float, float]:
    """(surely, most): squared distances of rounded vectors up to which a pair links for sure, and may link.
    A component is off by at most half a unit, so a distance by at most the root of ``dims``."""
    at, off = (2 - 2 * cosine) ** 0.5 * SCALE, dims ** 0.5 + 0.01
    return (at - off) ** 2 if at > off else -1.0, (at + off) ** 2


def shares(dims: int, block_dims: int, cosine: float) -> list[float]:
    """Each block's part of the largest squared distance of a link."""
    most = bounds(dims, cosine)[1]
    return [most * (b - a) / dims + 1e-3 for a, b in blocks(dims, block_dims)]


def grid_of(rows: int, chunk: int, grid_dims: int) -> int:
    """Coordinates the grid cuts for a label of ``rows`` vectors; a coordinate tells about three cells apart."""
    g = 0
    while rows > chunk and g < grid_dims:
        g, rows = g + 1, rows // 3
    return g


def placements(q: np.ndarray, share: float, g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home) of a block's rows (n, k) in the grid over its first ``g`` coordinates: the home cell and the
    cells after it, in order, that hold points in range.  Cells are wider than the range, so these are neighbours."""
    width = int(share ** 0.5) + 1
    at = q[:, :g].astype(np.int64)
    home = at // width
    rows, cells, own = [np.arange(len(q))], [home], [np.ones(len(q), bool)]
    below, above = at - home * width + 1, (home + 1) * width - at  # to the cell before and after
    for step in product((-1, 0, 1), repeat=g):
        if step > (0,) * g:
            s = np.array(step)
            gap = np.where(s > 0, above, np.where(s < 0, below, 0))
            hit = np.flatnonzero((gap * gap).sum(axis=1) <= share)
            rows.append(hit)
            cells.append(home[hit] + s)
            own.append(np.zeros(len(hit), bool))
    return np.concatenate(rows), np.concatenate(cells), np.concatenate(own)


def place(nodes: DataFrame, cosine: float, block_dims: int, grid_dims: int, chunk: int) -> DataFrame:
    """(label, cell, home, rep, n, q): a row per vector and cell, where ``cell`` is ``dims:block:place`` and
    block -1 stands for all blocks; q holds the rounded vector."""
    def emit(batches):
        for pdf in batches:
            for (dims, rows), part in pdf.groupby([pdf["v"].map(len), "rows"], sort=True):
                q = turned(part["v"])
                raw = [x.tobytes() for x in q]
                g = grid_of(rows, chunk, grid_dims)
                names = ("label", "rep", "n")
                label, rep, n = (part[c].to_numpy() for c in names)
                if not g:
                    yield pd.DataFrame({"label": label, "cell": f"{dims}:-1:", "home": True, "rep": rep, "n": n, "q": raw})
                    continue
                for b, ((lo, hi), share) in enumerate(zip(blocks(dims, block_dims), shares(dims, block_dims, cosine))):
                    i, at, home = placements(q[:, lo:hi], share, min(g, hi - lo))
                    yield pd.DataFrame({"label": label[i], "cell": [f"{dims}:{b}:" + ",".join(map(str, c)) for c in at.tolist()],
                                        "home": home, "rep": rep[i], "n": n[i], "q": [raw[k] for k in i]})

    return nodes.mapInPandas(emit, "label string, cell string, home boolean, rep long, n long, q binary")


def close_pairs(own: np.ndarray, share: float, meets=None, tile: int = TILE, count: list | None = None):
    """Pairs (x, y) of rows of a block (n, k) whose squared distance is at most ``share``, each once, in
    portions.  ``meets(x rows, y rows)`` tells which pairs count at all, as a table of booleans.  ``count`` collects
    the numbers of distances evaluated."""
    own = own.astype(np.int32)
    reach = int(share ** 0.5)
    wide = np.argsort(-own.astype(np.float64).std(axis=0), kind="stable")  # coordinates that tell most first
    order = np.argsort(own[:, wide[0]], kind="stable")
    s = np.ascontiguousarray(own[order][:, wide].T)
    ends = np.searchsorted(s[0], s[0] + reach, "right")
    for p in range(0, len(own), tile):
        for q in range(p, ends[min(p + tile, len(own)) - 1], WIDE):
            to = min(q + WIDE, ends[min(p + tile, len(own)) - 1])
            near = np.abs(s[0, p:p + tile, None] - s[0, None, q:to]) <= reach
            for c in s[1:3]:
                near &= np.abs(c[p:p + tile, None] - c[None, q:to]) <= reach
            if meets is not None:
                near &= meets(order[p:p + tile], order[q:to])
            x, y = np.nonzero(near)
            x, y = x + p, y + q
            once = x < y
            x, y = x[once], y[once]
            for c in s[3:]:
                hit = np.abs(c[x] - c[y]) <= reach
                x, y = x[hit], y[hit]
            if count is not None:
                count.append(len(x))
            far = np.zeros(len(x))
            for c in s:
                far += (c[x] - c[y]).astype(np.float64) ** 2
            hit = far <= share
            if hit.any():
                yield order[x[hit]], order[y[hit]]


def compare(cosine: float, block_dims: int, tile: int):
    """Links within one chunk or between two chunks of a cell: (rep, links, root, other), where ``other``
    marks a pair that only the original components settle."""
    def pairs(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, cell, i, j = key
        dims, b = (int(x) for x in cell.split(":")[:2])
        pdf = pdf.sort_values("rep", kind="stable")
        rep, n, home, chunk = (pdf[c].to_numpy() for c in ("rep", "n", "home", "chunk"))
        q = np.frombuffer(b"".join(pdf["q"]), np.int16).reshape(-1, dims)
        parts, share = blocks(dims, block_dims), shares(dims, block_dims, cosine)
        surely, most = bounds(dims, cosine)
        links, root, open_pairs = np.zeros(len(pdf), np.int64), np.arange(len(pdf)), []

        def meets(x, y):
            ok = home[x][:, None] | home[y][None, :]
            return ok & (chunk[x][:, None] != chunk[y][None, :]) if i != j else ok

        def far(x, y, lo, hi):
            d = q[x, lo:hi].astype(np.float64) - q[y, lo:hi]
            return (d * d).sum(axis=1)

        for e in range(len(parts)) if b < 0 else [b]:
            lo, hi = parts[e]
            for x, y in close_pairs(q[:, lo:hi], share[e], meets if i != j or not home.all() else None, tile):
                for k in range(0, len(x), max(1, STEP // dims)):
                    a, c = x[k:k + max(1, STEP // dims)], y[k:k + max(1, STEP // dims)]
                    for (s, t), most_here in zip(parts[:e], share):
                        first = far(a, c, s, t) > most_here
                        a, c = a[first], c[first]
                    d = far(a, c, 0, dims)
                    band = (d > surely) & (d <= most)
                    open_pairs += zip(rep[a[band]].tolist(), rep[c[band]].tolist())
                    a, c = a[d <= surely], c[d <= surely]
                    np.add.at(links, a, n[c])
                    np.add.at(links, c, n[a])
                    while len(a):  # smallest vector reachable in this task
                        low = np.minimum(root[a], root[c])
                        before = root.copy()
                        np.minimum.at(root, a, low)
                        np.minimum.at(root, c, low)
                        np.minimum.at(root, before[a], low)
                        np.minimum.at(root, before[c], low)
                        root = root[root]
                        if (root[a] == root[c]).all():
                            break
        hit = links > 0
        return pd.DataFrame({"rep": [*rep[hit], *(x for x, _ in open_pairs)],
                             "links": [*links[hit], *(0 for _ in open_pairs)],
                             "root": [*rep[root[hit]], *(x for x, _ in open_pairs)],
                             "other": pd.array([*(None for _ in rep[hit]), *(y for _, y in open_pairs)], "Int64")})

    return pairs


def settle(pairs: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """Of pairs (a, b) of nodes those whose original components have the cosine: (a, b, na, nb)."""
    def side(x: str) -> DataFrame:
        return nodes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("v").alias(f"v{x}"))

    def keep(batches):
        for pdf in batches:
            good = []
            for _, part in pdf.groupby(pdf["va"].map(len), sort=True):
                x, y = _scaled(part["va"]), _scaled(part["vb"])
                likeness = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
                good.append(part[likeness >= cosine])
            if good:
                yield pd.concat(good)[["a", "b", "na", "nb"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "va", "vb").mapInPandas(
        keep, "a long, b long, na long, nb long")


def near_vectors(vectors: DataFrame, cosine: float = 0.93, block_dims: int = BLOCK_DIMS, grid_dims: int = GRID_DIMS,
                 id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vec_id.

    Vectors link when their labels are equal and not null, their numbers of
    components are equal and their cosine is at least ``cosine`` (above 0).
    Null, zero and empty vectors and those with null or non-finite components
    link with nothing and are kept.  Rows of one vec_id are one vector (the
    smallest of label and components where they differ); rows without id are one
    row that links with nothing.  Other columns are not read."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    one = frozen(vectors.groupBy(F.col(id_col).cast("long").alias("vec_id"))
                 .agg(F.min(F.struct(F.col(label_col).cast("string").alias("label"),
                                     F.col(vec_col).cast("array<double>").alias("v"))).alias("x"))
                 .select("vec_id", "x.label", "x.v"), "vectors")
    good = one.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    nodes = frozen(good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "vector-nodes")
    dims = F.size("v").alias("dims")
    sizes = cut(nodes.groupBy("label", dims).agg(F.count(F.lit(1)).alias("rows")))
    sized = nodes.select("label", "v", "rep", "n", dims).join(sizes, ["label", "dims"]).select("label", "v", "rep", "n", "rows")
    placed = frozen(place(sized, cosine, block_dims, grid_dims, CHUNK), "vector-cells")
    crowds = cut(placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    dealt = placed.join(crowds, ["label", "cell"]).withColumn("chunk", chunk).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "label", "cell", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        "chunk", "home", "rep", "n", "q")
    found = cut(dealt.groupBy("label", "cell", "i", "j").applyInPandas(
        compare(cosine, block_dims, TILE), "rep long, links long, root long, other long"))
    band = found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
    settled = cut(settle(band, nodes, cosine))
    sure = found.where("other is null")
    groups = connected_components(sure.select(F.col("rep").alias("a"), F.col("root").alias("b"))
                                  .unionByName(settled.select("a", "b")))
    links = (sure.select("rep", "links").unionByName(settled.select(F.col("a").alias("rep"), F.col("nb").alias("links")))
             .unionByName(settled.select(F.col("b").alias("rep"), F.col("na").alias("links")))
             .groupBy("rep").agg(F.sum("links").alias("links")))
    named = cut(nodes.join(links, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id")))
    out = one.join(named, ["label", "v"], "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull() & F.col("n_links").isNotNull(), F.col("n_links"))
        .otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
