"""Batch formation over a file inventory: which files a scan takes, whether
the scan fires, and the cut of a whole backlog into consecutive batches.

Files are taken per feed in ``(mtime, path)`` order (the reference takes the
file system's listing order).  Limits below zero are off.  Counts and bytes
compare with ``>=``, age with a strict ``>``.  Every running total goes
through :func:`intake.operators.prefix.running_totals`, so a feed holding a
third of all files is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intake.config import ScanConfig
from intake.functions.ids import age_micros
from intake.operators.joins import broadcast_if_small
from intake.operators.prefix import running_totals

ORDER = ["mtime", "path"]
#: Larger file limits are cut by doubling: the walk keeps a row per slice and file of the limit.
WALK_FILES = 1000
#: Slices whose walks are composed in one group, at most ``WALK_FILES`` rows each.
FAN = 32


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null feed matches a null feed."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def _with_admitted(files: DataFrame, admitted: str | None) -> DataFrame:
    if admitted and admitted in files.columns:
        return files.withColumn("admitted", F.col(admitted).cast("boolean"))
    return files.withColumn("admitted", F.lit(True))


LIMIT_COLS = ["max_files", "max_size", "max_age"]


def _with_limits(df: DataFrame, cfg: ScanConfig, limits: DataFrame | None) -> DataFrame:
    """Add ``_mf, _ms, _ma``: the feed's limits from the settings table
    ``limits`` (``feed, max_files, max_size, max_age``; one row per
    configured feed, broadcast after a size check), else those of ``cfg``.
    With literals only, Catalyst folds the limit tests away."""
    if limits is None:
        return df.select("*", F.lit(cfg.max_files).cast("long").alias("_mf"),
                         F.lit(cfg.max_size).cast("long").alias("_ms"),
                         F.lit(cfg.max_age).cast("long").alias("_ma"))
    lim = broadcast_if_small(limits.select(
        F.col("feed").alias("_lf"), *[F.col(c).cast("long").alias(f"_l_{c}") for c in LIMIT_COLS]))
    j = df.join(lim, df["feed"].eqNullSafe(lim["_lf"]), "left")
    return j.select(*df.columns,
                    F.coalesce("_l_max_files", F.lit(cfg.max_files).cast("long")).alias("_mf"),
                    F.coalesce("_l_max_size", F.lit(cfg.max_size).cast("long")).alias("_ms"),
                    F.coalesce("_l_max_age", F.lit(cfg.max_age).cast("long")).alias("_ma"))


def threshold_batch(files: DataFrame, cfg: ScanConfig, as_of, admitted: str | None = "admitted",
                    chunks: int | None = None, limits: DataFrame | None = None) -> DataFrame:
    """One scan of each feed, as the reference's loop does it.

    Input: ``feed, path, length, mtime`` (+ ``admitted``: the file passed
    pairing; default all), already cleared of quarantined, ignored and
    pre-check-failed files.  Output per file: ``seq`` (1-based),
    ``prior_taken`` / ``prior_bytes`` (totals before it), ``scanned`` (the
    loop reached it), ``taken`` (scanned and admitted) and ``over_age``.

    The loop reaches a file when no limit was reached before it; the first
    file is always reached, and the file that reaches a limit is included.
    Un-admitted files still add bytes and age.  ``limits`` gives feeds their
    own limits (``feed, max_files, max_size, max_age``), so feeds with
    different profiles are scanned in one job; ``cfg`` covers the others.
    """
    f = _with_admitted(files, admitted)
    f = f.withColumn("_adm", F.col("admitted").cast("long"))
    run = _with_limits(running_totals(f, ["feed"], ORDER, ["_adm", "length"], chunks), cfg, limits)
    reach = (((F.col("_mf") < 0) | (F.col("_adm_before") < F.col("_mf")))
             & ((F.col("_ms") < 0) | (F.col("length_before") < F.col("_ms"))))
    scanned = (F.col("seq") == 1) | reach
    old = (F.col("_ma") > -1) & (age_micros("mtime", as_of) > F.col("_ma") * 1000)
    return run.select(
        "feed", "path", "length", "mtime", "admitted", "seq",
        F.col("_adm_before").alias("prior_taken"), F.col("length_before").alias("prior_bytes"),
        scanned.alias("scanned"), (scanned & F.col("admitted")).alias("taken"),
        (scanned & old).alias("over_age"))


def threshold_trigger(scan: DataFrame, cfg: ScanConfig, limits: DataFrame | None = None) -> DataFrame:
    """Does the scan of each feed fire?  ``taken >= max_files`` (always true
    when ``max_files`` is off, as in the reference) or any scanned file over
    age or ``bytes >= max_size``."""
    agg = (scan.where("scanned").groupBy("feed").agg(
        F.count(F.lit(1)).alias("n_scanned"),
        F.sum(F.col("taken").cast("long")).alias("n_taken"),
        F.sum("length").alias("bytes"),
        F.max(F.col("over_age")).alias("aged")))
    agg = _with_limits(agg, cfg, limits)
    fired = ((F.col("n_taken") >= F.col("_mf")) | F.col("aged")
             | ((F.col("_ms") > -1) & (F.col("bytes") >= F.col("_ms"))))
    return agg.withColumn("fired", fired).drop("_mf", "_ms", "_ma")


def batch_plan(files: DataFrame, cfg: ScanConfig, as_of, admitted: str | None = "admitted",
               chunks: int | None = None, chunk_rows: int = 100_000,
               limits: DataFrame | None = None) -> DataFrame:
    """Cut the whole backlog of admitted files of each feed into consecutive
    batches, as repeated scans would: a batch closes at the file that reaches
    ``max_files`` or ``max_size``, the next one starts fresh.

    Output per admitted file: ``seq``, ``batch_no`` (0-based per feed),
    ``batch_files``, ``batch_bytes`` and ``fired`` of its batch (full batches
    fire; the last, partial one fires by the rule of :func:`threshold_trigger`).
    ``limits`` (``feed, max_files, max_size, max_age``) gives feeds their own
    limits; ``cfg`` covers the others.

    The restart makes the cut sequential; it runs distributed anyway.  Each
    feed falls in one of three regimes, each run once for all its feeds with
    the limits as columns: count-only and degenerate limits have closed
    forms; with both a file and a byte limit every batch has at most
    ``max_files`` files, so each slice of ``chunk_rows`` files (by rank) can be
    entered at only ``max_files`` places — :func:`_cut_by_chunks` walks every
    slice from each of them in parallel, :func:`compose_slices` picks the true
    entries by composing neighbouring slices level by level and a second slice
    pass numbers the batches, O(files); with only a byte limit batches are
    unbounded and :func:`_cut_by_doubling` uses pointer doubling over ``next``
    in ``log2(batches)`` join rounds.
    """
    f = _with_admitted(files, admitted).where(F.col("admitted"))
    ranked = running_totals(f, ["feed"], ORDER, ["length"], chunks)
    old = (F.col("_ma") > -1) & (age_micros("mtime", as_of) > F.col("_ma") * 1000)
    # ranked once, limits attached, frozen: every regime below reads it
    run = _with_limits(ranked, cfg, limits).withColumn("_old", old).checkpoint(eager=True)
    mf, ms = F.col("_mf"), F.col("_ms")
    # slices stay within chunk_rows rows and have few entries: a larger file limit goes to doubling
    most = min(chunk_rows, WALK_FILES)
    bounded = (mf > 0) & (ms > 0) & (mf <= most)
    size_only = (ms > 0) & ((mf < 0) | (mf > most))
    regimes = _regimes_present(f, cfg, limits, most)
    parts = []
    if regimes["closed"]:
        batch_no = (F.when((mf == 0) | (ms == 0), F.col("seq") - 1)
                    .when(mf > 0, F.floor((F.col("seq") - 1) / mf))
                    .otherwise(F.lit(0)).cast("long"))
        parts.append(_with_stats(run.where(~(bounded | size_only)).withColumn("batch_no", batch_no)))
    if regimes["bounded"]:
        parts.append(_cut_by_chunks(run.where(bounded), regimes["max_files"], chunk_rows))
    if regimes["size_only"]:
        parts.append(_with_stats(_cut_by_doubling(run.where(size_only), chunks)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _regimes_present(files: DataFrame, cfg: ScanConfig, limits: DataFrame | None, most: int) -> dict:
    """Which regimes occur, and the largest file limit of the slice regime.
    Without a settings table this is known from ``cfg``; with one, it is read
    from the (few) distinct profiles of the feeds present."""
    if limits is None:
        profiles = [(cfg.max_files, cfg.max_size)]
    else:
        feeds = _with_limits(files.select("feed").distinct(), cfg, limits)
        profiles = [(r["_mf"], r["_ms"]) for r in feeds.select("_mf", "_ms").distinct().collect()]
    sliced = [m for m, s in profiles if s > 0 and 0 < m <= most]
    doubled = [m for m, s in profiles if s > 0 and (m < 0 or m > most)]
    return {"closed": len(profiles) > len(sliced) + len(doubled), "bounded": bool(sliced),
            "max_files": max(sliced, default=1), "size_only": bool(doubled)}


def _with_stats(planned: DataFrame) -> DataFrame:
    """Files, bytes and ``fired`` of each batch, joined back to its files (a
    partial-aggregated ``groupBy``; AQE splits a hot batch in the join)."""
    stats = planned.groupBy("feed", "batch_no").agg(
        F.count(F.lit(1)).alias("batch_files"), F.sum("length").alias("batch_bytes"),
        F.max("_old").alias("_aged"), F.max("_mf").alias("_bmf"), F.max("_ms").alias("_bms"))
    fired = ((F.col("batch_files") >= F.col("_bmf")) | F.col("_aged")
             | ((F.col("_bms") > -1) & (F.col("batch_bytes") >= F.col("_bms"))))
    stats = stats.select("feed", "batch_no", "batch_files", "batch_bytes", fired.alias("fired"))
    out = _join_null_safe(planned, stats, ["feed", "batch_no"])
    return out.select("feed", "path", "length", "mtime", "seq", "batch_no",
                      "batch_files", "batch_bytes", "fired")


def _next_starts(lengths, mf: int, ms: int):
    """Local index of the next batch start for a batch starting at each index
    (``len`` = past the end).  Exact for every index whose batch ends inside
    the array, which the halo guarantees for core rows."""
    import numpy as np
    n = len(lengths)
    incl = np.cumsum(lengths)
    prev = incl - lengths
    ms = min(ms, int(incl[-1]) + 1)  # beyond all bytes: never reached, and no overflow
    k_size = np.searchsorted(incl, prev + ms, side="left")
    idx = np.arange(n)
    end = np.minimum(np.minimum(idx + (mf - 1), k_size), n - 1)
    return end + 1


def _cut_by_chunks(run: DataFrame, max_mf: int, chunk_rows: int) -> DataFrame:
    """Exact cut when every batch holds at most ``_mf`` files (see
    batch_plan); ``_mf`` / ``_ms`` are per-feed columns, ``max_mf`` their
    largest value."""
    import numpy as np
    import pandas as pd

    size = max(int(chunk_rows), max_mf)
    chunk = F.floor((F.col("seq") - 1) / F.lit(size)).cast("long")
    # every row goes to its slice; the first mf-1 rows of a slice also go to
    # the slice before (its halo), so a batch starting near a slice end is
    # fully visible there.  One pass over the input.
    in_halo = ((F.col("seq") - 1) % F.lit(size) < F.col("_mf") - 1) & (chunk > 0)
    home = F.struct(chunk.alias("_chunk"), F.lit(True).alias("_core"))
    guest = F.struct((chunk - 1).alias("_chunk"), F.lit(False).alias("_core"))
    slices = (run.select("feed", "path", "length", "mtime", "seq", "_old", "_mf", "_ms",
                         F.explode(F.when(in_halo, F.array(home, guest)).otherwise(F.array(home))).alias("_s"))
              .select("feed", "path", "length", "mtime", "seq", "_old", "_mf", "_ms", "_s._chunk", "_s._core"))

    def entries_of_slice(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        seq0 = int(pdf["seq"].iloc[0])
        ncore = int(pdf["_core"].sum())
        mf, ms = int(pdf["_mf"].iloc[0]), int(pdf["_ms"].iloc[0])
        nxt = _next_starts(pdf["length"].to_numpy(dtype="int64"), mf, ms)
        exit_, count = nxt[:ncore].astype("int64"), np.ones(ncore, dtype="int64")
        inside = np.flatnonzero(exit_ < ncore)
        while len(inside):  # every chain of starts doubles its step until it leaves the core
            via = exit_[inside]
            count[inside], exit_[inside] = count[inside] + count[via], exit_[via]
            inside = inside[exit_[inside] < ncore]
        m = min(mf, ncore)
        return pd.DataFrame({"feed": pdf["feed"].iloc[0], "_chunk": pdf["_chunk"].iloc[0],
                             "entry": seq0 + np.arange(m), "exit": seq0 + exit_[:m], "starts": count[:m]})

    # (slice, entry): where the walk that enters a slice there leaves it, and the batches it starts within
    table = (slices.select("feed", "_chunk", "seq", "length", "_core", "_mf", "_ms").groupBy("feed", "_chunk")
             .applyInPandas(entries_of_slice, "feed string, _chunk long, entry long, exit long, starts long"))

    last = run.agg(F.max(chunk)).first()[0]
    walk = compose_slices(table, int(last or 0) + 1)

    def number_slice(pdf: pd.DataFrame) -> pd.DataFrame:
        # Emits every row whose batch starts in this slice's core (halo rows
        # included), with that batch's stats: a batch holds at most mf files,
        # so it is fully visible here.  Core rows before the entry belong to a
        # batch of the slice before, which emits them from its halo.
        pdf = pdf.sort_values("seq").reset_index(drop=True)
        seq0 = int(pdf["seq"].iloc[0])
        ncore = int(pdf["_core"].sum())
        mf, ms = int(pdf["_mf"].iloc[0]), int(pdf["_ms"].iloc[0])
        lengths = pdf["length"].to_numpy(dtype="int64")
        nxt = _next_starts(lengths, mf, ms)
        starts, p = [], int(pdf["entry"].iloc[0]) - seq0
        while p < ncore:
            starts.append(p)
            p = int(nxt[p])
        first, stop = (starts[0], min(int(nxt[starts[-1]]), len(pdf))) if starts else (0, 0)
        rows = pdf.iloc[first:stop]
        which = np.searchsorted(np.asarray(starts, dtype="int64"), np.arange(first, stop), side="right") - 1
        n = np.bincount(which, minlength=len(starts))
        size = np.add.reduceat(lengths[first:stop], np.asarray(starts, "int64") - first) if starts else n
        old = np.bincount(which, weights=rows["_old"].to_numpy(dtype="int64"), minlength=len(starts)) > 0
        fired = (n >= mf) | old | (size >= ms)
        return pd.DataFrame({
            "feed": rows["feed"], "path": rows["path"], "length": rows["length"], "mtime": rows["mtime"],
            "seq": rows["seq"], "batch_no": int(pdf["offset"].iloc[0]) + which,
            "batch_files": n[which], "batch_bytes": size[which], "fired": fired[which]})

    return (_join_null_safe(slices, walk, ["feed", "_chunk"])
            .groupBy("feed", "_chunk")
            .applyInPandas(number_slice, OUT_SCHEMA))


def _through(pdf, entry: int | None = None, offset: int = 0):
    """The maps of consecutive slices one after the other (rows ``_chunk, entry, exit, starts``).

    Without ``entry``: their composition, a row per entry of the first slice.  With it:
    (_chunk, entry, offset) of the walk that enters the first slice there."""
    import numpy as np

    pdf = pdf.sort_values(["_chunk", "entry"], kind="stable")
    chunk, entries, exits, n = (pdf[c].to_numpy(np.int64) for c in ("_chunk", "entry", "exit", "starts"))
    slices, first = np.unique(chunk, return_index=True)
    bounds = list(zip(slices.tolist(), first.tolist(), [*first[1:].tolist(), len(chunk)]))
    begin = entries[bounds[0][1]:bounds[0][2]] if entry is None else np.array([entry])
    at, count, rows = begin.copy(), np.full(len(begin), offset, np.int64), []
    for c, lo, hi in bounds:
        if entry is not None:
            rows.append((c, int(at[0]), int(count[0])))
        k = lo + np.minimum(np.searchsorted(entries[lo:hi], at), hi - lo - 1)
        inside = entries[k] == at           # else the walk has left the feed's files
        at, count = np.where(inside, exits[k], at), np.where(inside, count + n[k], count)
    return rows if entry is not None else (begin, at, count)


def compose_slices(table: DataFrame, n_slices: int, fan: int = FAN) -> DataFrame:
    """(feed, _chunk, entry, offset): where the walk from file 1 of each feed enters each of its
    slices, and the batches started before, from ``table`` (feed, _chunk, entry, exit, starts).

    Maps compose associatively, so ``fan`` neighbouring slices become one map in a
    group, ``fan`` of those again, up to one group per feed; then the entries are handed
    down the same levels.  No group holds more than ``fan`` slices, whatever the feed."""
    import pandas as pd

    maps = "feed string, _chunk long, entry long, exit long, starts long"
    parent = F.floor(F.col("_chunk") / F.lit(fan)).cast("long")

    def up(pdf: pd.DataFrame) -> pd.DataFrame:
        begin, at, count = _through(pdf)
        return pd.DataFrame({"feed": pdf["feed"].iloc[0], "_chunk": pdf["_chunk"].iloc[0] // fan,
                             "entry": begin, "exit": at, "starts": count})

    def down(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = _through(pdf, int(pdf["_entry"].iloc[0]), int(pdf["_offset"].iloc[0]))
        out = pd.DataFrame(rows, columns=["_chunk", "entry", "offset"])
        out.insert(0, "feed", pdf["feed"].iloc[0])
        return out

    levels, n = [table], n_slices
    while n > fan:
        levels[-1] = levels[-1].checkpoint()
        levels.append(levels[-1].groupBy("feed", parent.alias("_block")).applyInPandas(up, maps))
        n = -(-n // fan)
    walk = None
    for level in reversed(levels):
        if walk is None:
            begun = level.withColumn("_entry", F.lit(1).cast("long")).withColumn("_offset", F.lit(0).cast("long"))
        else:
            above = walk.select("feed", F.col("_chunk").alias("_block"), F.col("entry").alias("_entry"), F.col("offset").alias("_offset"))
            begun = _join_null_safe(level.withColumn("_block", parent), above, ["feed", "_block"]).drop("_block")
        walk = begun.groupBy("feed", parent.alias("_block")).applyInPandas(down, "feed string, _chunk long, entry long, offset long")
    return walk


OUT_SCHEMA = ("feed string, path string, length long, mtime timestamp_ntz, seq long, batch_no long, "
              "batch_files long, batch_bytes long, fired boolean")


def _cut_by_doubling(run: DataFrame, chunks: int | None) -> DataFrame:
    """Batch numbers when a byte limit is on and batches may be longer than
    a slice (``_ms > 0``; ``_mf`` off or large; per-feed columns)."""
    counts = run.groupBy("feed").agg(F.max("seq").alias("n_total"), F.max("_mf").alias("_cap"))
    # First file k >= r with bytes(r..k) >= ms: k = 1 + #{j : S[j] < S[r-1] + ms},
    # counted by merging the inclusive sums S with the thresholds in one order.
    sums = run.select("feed", "seq", (F.col("length_before") + F.col("length")).alias("key"),
                      F.lit(1).alias("kind"), F.lit(1).cast("long").alias("w"))
    asks = run.select("feed", "seq", (F.col("length_before") + F.least("_ms", F.lit(1 << 62))).alias("key"),
                      F.lit(0).alias("kind"), F.lit(0).cast("long").alias("w"))
    merged = running_totals(sums.unionByName(asks), ["feed"], ["key", "kind", "seq"], ["w"],
                            chunks, seq_col="_pos")
    size_end = (merged.where(F.col("kind") == 0)
                .select("feed", F.col("seq").alias("r"), (F.col("w_before") + 1).alias("k_size")))
    nodes = _join_null_safe(size_end, counts, ["feed"])
    end = F.greatest(F.col("r"), F.col("k_size"))
    end = F.when(F.col("_cap") > 0, F.least(end, F.col("r") + F.col("_cap") - 1)).otherwise(end)
    end = F.least(end, F.col("n_total"))
    level = nodes.select("feed", "r", "n_total", (end + 1).alias("nx")).checkpoint(eager=True)

    # levels[k] maps r -> next^(2^k)(r); n_total + 1 is the end of the chain.
    levels = [level]
    while _chain_open(levels[-1]):
        a = levels[-1]
        b = a.select(F.col("feed").alias("_bf"), F.col("r").alias("_br"), F.col("nx").alias("_bnx"))
        step = a.join(b, (F.col("feed").eqNullSafe(F.col("_bf"))) & (F.col("nx") == F.col("_br")), "left")
        levels.append(step.select("feed", "r", "n_total",
                                  F.coalesce(F.col("_bnx"), F.col("nx")).alias("nx")).checkpoint(eager=True))

    # Starts reachable from r = 1: add next^(2^k) of every known start, top level first.
    starts = levels[0].where(F.col("r") == 1).select("feed", "r")
    for lv in reversed(levels):
        hop = (_join_null_safe(starts, lv, ["feed", "r"]).where(F.col("nx") <= F.col("n_total"))
               .select("feed", F.col("nx").alias("r")))
        starts = starts.unionByName(hop).checkpoint(eager=True)

    marked = (_join_null_safe(run, starts.withColumn("_start", F.lit(1).cast("long"))
                              .withColumnRenamed("r", "seq"), ["feed", "seq"], "left")
              .withColumn("_start", F.coalesce(F.col("_start"), F.lit(0).cast("long"))))
    numbered = running_totals(marked.drop("length_before").withColumnRenamed("seq", "_seq0"),
                              ["feed"], ORDER, ["_start"], chunks, seq_col="_seq1")
    return (numbered.withColumn("batch_no", F.col("_start_before") + F.col("_start") - 1)
            .withColumnRenamed("_seq0", "seq").drop("_seq1", "_start", "_start_before"))


def _chain_open(level: DataFrame) -> bool:
    """Is there a feed whose chain from file 1 has not ended at this level?
    (``next`` is monotone, so the chain from 1 is the longest one.)"""
    return level.where((F.col("r") == 1) & (F.col("nx") <= F.col("n_total"))).limit(1).count() > 0
