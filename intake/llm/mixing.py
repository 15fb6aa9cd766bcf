"""Mixing sources to target weights by min-cost flow over membership patterns.

1. Documents are aggregated by membership pattern (the set of sources a
   document belongs to): one row per pattern, whatever the number of documents.
2. A min-cost flow routes each pattern's words to source quotas.  A pattern's
   first pass is free and every further pass costs more (convex), so nothing is
   repeated before everything useful was taken once.
3. Each pattern's words are realised with whole documents in a seeded order:
   whole passes for all, then one more pass up to a threshold of the seeded
   hash.  The threshold is found digit by digit from small histograms, so no
   pattern (one may hold a third of all rows) is sorted or gathered; the last
   digit's few documents fill the rest.

Patterns and quotas are driver-side tables; documents never are.  Of patterns of
several sources there are at most ``MAX_PATTERNS`` (checked); where there are more
patterns in all, those that alone feed their only source are served by its quota.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Callable
from fractions import Fraction
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import cut, frozen

MAX_PATTERNS = 10_000
HASH, DIGIT = 60, 3 # bits of the seeded hash, and of these read a round
LAST_ROWS = 512     # documents of a pattern that are few enough to be filled in one by one
WEIGHTS, SHARE, MOST = (5, 2, 1), Fraction(3, 2), 2


def quotas(sizes: dict, weights: tuple = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> dict:
    """Target words of each source: ``share`` of all words by weight (repeating,
    in code point order, the null source last), never above ``most`` times the
    source's own; the excess goes to the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in free}
        for s in above:
            target[s] = Fraction(most * sizes[s])
        left -= sum(target[s] for s in above)
        free -= above
    return target


def min_cost_flow(capacity: dict, members: dict, wanted: dict, passes: int = MOST) -> dict:
    """Words each pattern gives to each source: {(pattern, source): words}.

    capacity: words of one pass of each pattern; members: its sources; wanted:
    whole words of each source.  Pass k costs k - 1 a word.  Successive shortest
    paths with potentials; as much as possible is routed if not all can be."""
    nodes = {("p", p): i for i, p in enumerate(capacity)}
    nodes |= {("s", s): len(nodes) + i for i, s in enumerate(wanted)}
    source, sink = len(nodes), len(nodes) + 1
    graph: list[list[int]] = [[] for _ in range(len(nodes) + 2)]
    ends, room, cost = [], [], []

    def arc(a: int, b: int, cap: int, c: int) -> int:
        for x, y, r, w in ((a, b, cap, c), (b, a, 0, -c)):
            graph[x].append(len(ends))
            ends.append(y)
            room.append(r)
            cost.append(w)
        return len(ends) - 2

    for p, size in capacity.items():
        for k in range(passes):
            arc(source, nodes["p", p], size, k)
    arcs = {(p, s): arc(nodes["p", p], nodes["s", s], passes * capacity[p], 0)
            for p in capacity for s in members[p] if s in wanted}
    for s, w in wanted.items():
        arc(nodes["s", s], sink, w, 0)
    potential = [0] * len(graph)
    while True:
        far, by = {source: 0}, {}
        heap, done = [(0, source)], set()
        while heap:
            d, x = heappop(heap)
            if x in done:
                continue
            done.add(x)
            for e in graph[x]:
                y, reach = ends[e], d + cost[e] + potential[x] - potential[ends[e]]
                if room[e] and reach < far.get(y, reach + 1):
                    far[y], by[y] = reach, e
                    heappush(heap, (reach, y))
        if sink not in by:
            return {k: room[e ^ 1] for k, e in arcs.items() if room[e ^ 1]}
        for x, d in far.items():
            potential[x] += d
        path, x = [], sink
        while x != source:
            path.append(by[x])
            x = ends[by[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


def given_words(capacity: dict, members: dict, wanted: dict, passes: int = MOST) -> dict:
    """Words each pattern gives, by the flow.  Only beyond ``MAX_PATTERNS`` patterns is it for those of
    several sources and their neighbours; where one pattern and one source have only each other, the quota
    then says what the flow would."""
    shared = {s for p in members if len(members[p]) > 1 or len(capacity) <= MAX_PATTERNS for s in members[p]}
    lone = {p for p in capacity if not shared.intersection(members[p])}
    given = {p: min(sum(wanted.get(s, 0) for s in members[p]), passes * capacity[p]) for p in lone}
    given |= {p: 0 for p in capacity if p not in lone}
    if shared:
        flow = min_cost_flow({p: c for p, c in capacity.items() if p not in lone}, members,
                             {s: w for s, w in wanted.items() if s in shared}, passes)
        for (p, _), words in flow.items():
            given[p] += words
    return given


def _pattern(sources: Column) -> Column:
    """The sources of a document as JSON: the null source stays apart from any name."""
    return F.to_json(F.struct(F.array_sort(F.array_distinct(sources)).alias("s")), {"ignoreNullFields": "false"})


def _small(df: DataFrame, patterns: int) -> DataFrame:
    """A table of one row a pattern, broadcast unless there are many."""
    return F.broadcast(df) if patterns <= MAX_PATTERNS else df


def fill(sizes: list[int], room: int) -> list[bool]:
    """Documents, in order, that fit into ``room`` words; then swaps of a picked one
    for a larger one, the best first, while that leaves less room."""
    picked, left = [], room
    for s in sizes:
        picked.append(0 < s <= left)
        left -= s if picked[-1] else 0
    while left:
        inside = sorted((s, -i) for i, s in enumerate(sizes) if picked[i])
        best = (0, 0, 0)
        for j, s in enumerate(sizes):
            if s and not picked[j] and (k := bisect_left(inside, (s - left, -len(sizes)))) < len(inside):
                best = max(best, (s - inside[k][0], inside[k][1], -j))
        if best[0] <= 0:
            break
        left -= best[0]
        picked[-best[1]], picked[-best[2]] = False, True
    over = [(s, i) for i, s in enumerate(sizes) if s and not picked[i]]
    if over and abs(left - min(over)[0]) < left:
        picked[min(over)[1]] = True
    return picked


def _select(sized: DataFrame, take: dict, seed: int) -> DataFrame:
    """(key columns of ``sized``, taken): whole passes plus one more up to the threshold.

    sized: (rid, pattern, size, u, ...); take: {pattern: (words of a pass, rows, words to take)}."""
    spark = sized.sparkSession
    plan = {p: (int(t // s) if s else 0, int(t % s) if s else 0) for p, (s, _, t) in take.items()}
    edge = {p: (0, HASH, r, take[p][1]) for p, (_, r) in plan.items() if r}  # pattern -> prefix, shift, words left, rows
    shift = HASH
    while shift and (wide := [p for p, x in edge.items() if x[1] == shift and x[3] > LAST_ROWS]):
        at = _small(spark.createDataFrame([(p, edge[p][0]) for p in wide], "p string, prefix long"), len(wide))
        rows = (sized.join(at, F.col("pattern").eqNullSafe(F.col("p")))
                .where(F.shiftright("u", shift) == F.col("prefix"))
                .groupBy("pattern", F.shiftright("u", shift - DIGIT).alias("digit"))
                .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect())  # 8 rows a pattern
        shift -= DIGIT
        found: dict = {p: [] for p in wide}
        for r in rows:
            found[r["pattern"]].append((r["digit"], r["size"], r["n"]))
        for p in wide:
            mine = sorted(found[p])
            left = edge[p][2]
            for digit, size, n in mine:
                if size > left or digit == mine[-1][0]:
                    edge[p] = (digit, shift, left, n)
                    break
                left -= size
    table = _small(spark.createDataFrame(
        [(p, plan[p][0], *edge.get(p, (None, 0, 0))[:3]) for p in plan],
        "p string, passes long, edge long, shift int, room long"), len(plan))
    marked = sized.join(table, F.col("pattern").eqNullSafe(F.col("p"))).withColumn(
        "digit", F.expr("shiftright(u, shift)"))

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("u")
        more = fill([int(s) for s in pdf["size"]], int(pdf["room"].iloc[0]))
        return pd.DataFrame({"q": [pdf["pattern"].iloc[0]], "picked": [[int(u) for u, m in zip(pdf["u"], more) if m]]})

    # repeated rows fall together: however many there are, a pattern has at most LAST_ROWS rows here
    few = marked.where("digit = edge").groupBy("pattern", "u").agg(F.sum("size").alias("size"), F.first("room").alias("room"))
    picked = _small(few.groupBy("pattern").applyInPandas(finish, "q string, picked array<long>"), len(plan))
    more = (F.col("digit") < F.col("edge")) | ((F.col("digit") == F.col("edge")) & F.array_contains("picked", F.col("u")))
    return marked.join(picked, F.col("pattern") == F.col("q"), "left").select(
        *sized.columns, (F.col("size") * (F.col("passes") + F.when(more, 1).otherwise(0))).alias("taken"))


def mix(docs: DataFrame, size: Column, sources: Column, targets: Callable[[dict], dict] = quotas,
        passes: int = MOST, seed: int = 7, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, size, sources, source_size, target, taken), one row per input row.

    size: words of a document (null: 0).  sources: array of the sources it
    belongs to (null entries are a source of their own; no entry: never taken).
    targets: {source: words} -> {source: target}.  source_size and target are
    sums over the row's sources.  taken is a whole multiple of size, at most
    ``passes`` times.  The seeded order is a hash of id and size: reruns agree,
    repeated rows of an id fall together.  Null ids are ids like any other.
    An empty table gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    sized = frozen(docs.select(F.col(id_col).alias("doc_id"), _pattern(sources).alias("pattern"),
                               F.coalesce(size, F.lit(0)).cast("long").alias("size"))
                   .withColumn("u", F.xxhash64(F.lit(seed), "doc_id", "size").bitwiseAND(F.lit((1 << HASH) - 1))), "mix")
    summed = cut(sized.groupBy("pattern").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
    if summed.where(F.size(F.from_json("pattern", "s array<string>")["s"]) > 1).limit(MAX_PATTERNS + 1).count() > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of several sources: group rare sources first")
    total = summed.collect()
    capacity = {r["pattern"]: r["words"] for r in total}
    members = {p: json.loads(p).get("s") or [] for p in capacity}
    sizes: dict = {}
    for p, words in capacity.items():
        for s in members[p]:
            sizes[s] = sizes.get(s, 0) + words
    target = targets(sizes)
    given = given_words(capacity, members, {s: round(t) for s, t in target.items()}, passes)
    chosen = _select(sized, {r["pattern"]: (r["words"], r["n"], given[r["pattern"]]) for r in total}, seed)
    facts = _small(spark.createDataFrame(
        [(p, sum(sizes[s] for s in members[p]), float(sum(target[s] for s in members[p]))) for p in capacity],
        "p string, source_size long, target double"), len(capacity))
    return chosen.join(facts, F.col("pattern").eqNullSafe(F.col("p"))).select(
        "doc_id", "size", F.from_json("pattern", "s array<string>")["s"].alias("sources"),
        "source_size", "target", "taken")


def repeat_rows(docs: DataFrame, mixed: DataFrame, size: Column, sources: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it.

    size, sources: the expressions that ``mix`` was given (sources: by default the column
    ``source``).  Rows of one id are told apart by them; those that agree in all
    three are taken alike, each as often."""
    pattern = _pattern(F.array("source") if sources is None else sources)
    times = cut(mixed.where("taken > 0").select(
        F.col("doc_id").alias("__doc"), F.col("size").alias("__size"), _pattern(F.col("sources")).alias("__from"),
        F.expr("int(taken div size)").alias("__times")).distinct())
    out = docs.withColumn("__words", size.cast("long")).withColumn("__pattern", pattern)
    out = out.join(times, F.col(id_col).eqNullSafe(F.col("__doc")) & (F.col("__words") == F.col("__size"))
                   & F.col("__pattern").eqNullSafe(F.col("__from")))
    return out.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__copy")).drop("__copy")
