"""Work items: describe, parse, route and track the files a scan took.

The reference sends a text message ``path,format,dataType`` over a broker and
tracks delivery attempts in message headers; here both are tables, so the
lifecycle can be joined and audited like any other data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.functions.ids import content_id, epoch_micros
from intake.functions.paths import flagged_path, path_key
from intake.operators.joins import broadcast_if_small
from intake.operators.prefix import running_totals
from intake.session import checkpoint_dir

# Input formats a work item may name (Spark file sources).
KNOWN_FORMATS = ("csv", "json", "parquet", "orc", "text", "avro", "binaryFile")


def work_items(taken: DataFrame, target_dir: str, input_format: str, data_type: str,
               input_dir: str | None = None, preserve_path: bool = False) -> DataFrame:
    """One descriptor per taken file: flagged target, format, data type, a
    repeatable ``work_id`` (md5 of target, length and mtime, so a new file
    under an old name gets a new id) and the text ``message`` form."""
    target = flagged_path("path", target_dir, input_dir, preserve_path)
    out = taken.select(
        "*",
        target.alias("target_path"),
        F.lit(input_format).alias("format"),
        F.lit(data_type).alias("data_type"),
    )
    out = out.withColumn("work_id", content_id("target_path", "length", epoch_micros("mtime")))
    return out.withColumn("message", F.concat_ws(",", "target_path", "format", "data_type"))


def flagged_collisions(items: DataFrame) -> DataFrame:
    """Targets that more than one file would be moved to (flat mode moves
    equal names from different folders onto each other)."""
    return (items.groupBy("target_path").agg(F.count(F.lit(1)).alias("n_sources"))
            .where(F.col("n_sources") > 1))


def parse_work_items(messages: DataFrame, inventory: DataFrame | None = None,
                     known_formats: Iterable[str] = KNOWN_FORMATS,
                     message_col: str = "message") -> DataFrame:
    """Parse ``path,format,dataType`` messages into columns plus a ``status``.

    Like Java's ``String.split(",")``, trailing empty fields are dropped
    first; anything but three fields is ``bad_fields``.  An unknown format is
    ``unknown_format`` (the reference only logs it).  With an ``inventory``
    (``path, length``), a missing file is ``missing`` and ``length`` is filled
    in by a join, not by one file-system call per message; ``read_path`` is where
    the file is (the inventory's ``read_path`` if it has one, for files that are
    listed under the path they will be moved to).  Local paths match with or
    without their scheme.
    """
    stripped = F.regexp_replace(F.col(message_col), ",+$", "")
    parts = F.split(stripped, ",", -1)
    parsed = messages.select(
        "*",
        F.when(F.col(message_col) == "", F.lit(0)).otherwise(F.size(parts)).alias("n_fields"),
        F.get(parts, 0).alias("path"),
        F.get(parts, 1).alias("format"),
        F.get(parts, 2).alias("data_type"),
    )
    fmts = list(known_formats)
    status = (F.when(F.col("n_fields") != 3, F.lit("bad_fields"))
              .when(~F.col("format").isin(fmts), F.lit("unknown_format")))
    if inventory is not None:
        where = "read_path" if "read_path" in inventory.columns else "path"
        inv = inventory.select(path_key("path").alias("_inv_path"), F.col("length"), F.col(where).alias("read_path"))
        parsed = parsed.join(inv, path_key(parsed["path"]) == inv["_inv_path"], "left")
        status = status.when(F.col("_inv_path").isNull(), F.lit("missing"))
    parsed = parsed.withColumn("data_type", F.trim(F.col("data_type")))
    parsed = parsed.withColumn("status", status.otherwise(F.lit("ok")))
    return parsed.drop("_inv_path") if inventory is not None else parsed


def config_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small settings table (feeds, pools): its size is that of the config."""
    return spark.createDataFrame(list(rows), schema)


def route_work(items: DataFrame, feeds: DataFrame, pools: DataFrame,
               max_broadcast_rows: int = 100_000) -> DataFrame:
    """Feed -> queue -> pool, with a ``route`` status.  Every item stays: one of
    a feed without config (or without feed) has a null queue (``no_queue``), one
    whose queue no pool reads a null pool (``no_pool``), the rest is ``ok``.

    ``feeds`` and ``pools`` are settings tables (one row per configured feed
    or pool); they are broadcast once their size is checked.
    """
    f = broadcast_if_small(feeds.select("feed", "queue"), max_broadcast_rows)
    p = broadcast_if_small(pools.select("pool", "queue", "replicas"), max_broadcast_rows)
    routed = items.join(f, "feed", "left").join(p, "queue", "left")
    return routed.withColumn("route", F.when(F.col("queue").isNull(), "no_queue")
                             .when(F.col("pool").isNull(), "no_pool").otherwise("ok"))


def route_orphans(feeds: DataFrame, pools: DataFrame) -> DataFrame:
    """Feeds whose queue no pool reads, and pools whose queue no feed fills."""
    lonely_feeds = (feeds.join(pools, "queue", "left_anti")
                    .select(F.lit("feed_without_pool").alias("kind"), F.col("feed").alias("name"), "queue"))
    lonely_pools = (pools.join(feeds, "queue", "left_anti")
                    .select(F.lit("pool_without_feed").alias("kind"), F.col("pool").alias("name"), "queue"))
    return lonely_feeds.unionByName(lonely_pools)


def attempt_ledger(outcomes: DataFrame, max_attempts: int) -> DataFrame:
    """Delivery state per work item from its outcome rows (``work_id, attempt,
    at, status``).  The number of attempts is the greatest ``attempt``, so a
    delivery reported several times counts once.  An ``ok`` is final: ``done``;
    else ``dead_letter`` from ``max_attempts`` on, else ``retry``.
    ``last_status`` is that of the greatest attempt (``ok`` first, then the
    latest report).

    A partial-aggregated ``groupBy``: an item redelivered a million times is
    one row per map task in the shuffle.
    """
    led = outcomes.groupBy("work_id").agg(
        F.max("attempt").alias("attempts"),
        F.max_by("status", F.struct("attempt", F.col("status") == "ok", "at", "status")).alias("last_status"),
        F.max("at").alias("last_at"),
        F.max(F.col("status") == "ok").alias("_ok"),
    )
    state = (F.when(F.col("_ok"), F.lit("done"))
             .when(F.col("attempts") >= F.lit(max_attempts), F.lit("dead_letter"))
             .otherwise(F.lit("retry")))
    return led.withColumn("state", state).drop("_ok")


def select_retries(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Work items to deliver again, with the number of the next ``attempt``."""
    again = ledger.where(F.col("state") == "retry").select("work_id", (F.col("attempts") + 1).alias("attempt"))
    return items.join(again, "work_id")


def deal_to_replicas(routed: DataFrame, slack: float = 1.25, rounds: int = 64, load: str = "length", id_col: str = "work_id") -> DataFrame:
    """Items of each pool dealt to its replicas: ``replica`` (0-based) and ``deal`` (``ok``, or ``over`` where an item
    alone is beyond the bound) added to ``routed`` (``pool, replicas, length, work_id``).

    Rendezvous hashing with bounded loads: every item ranks the replicas by a hash of itself
    and the replica and goes to the best one whose bound (``slack`` times the pool's mean bytes a replica) still
    has room.  So equal input is dealt alike, and a new replica takes its share from the others and moves nothing
    else but what the bounds push on.

    In each round the items not placed yet ask their next replica, in the order of their hashes; a replica takes
    what fits below its bound by running totals (no replica's items are gathered in one task), the others go on to the
    next round, until a full turn places nothing.  Rows of one work item are one item.  An item of a pool without
    replicas or without pool keeps a null replica."""
    spark = routed.sparkSession
    checkpoint_dir(spark)
    size = F.coalesce(F.col(load), F.lit(0)).cast("long")
    items = routed.withColumn("_size", size).withColumn("_key", F.xxhash64(id_col, *[c for c in ("path",) if c in routed.columns]))
    pools = items.where("pool is not null and replicas > 0").groupBy("pool").agg(
        F.max("replicas").alias("_n"), F.sum("_size").alias("_all"))
    pools = broadcast_if_small(pools.select("pool", "_n", F.ceil(F.lit(slack) * F.col("_all") / F.col("_n")).cast("long").alias("_bound")))
    todo = items.where("pool is not null and replicas > 0").select("pool", "_key", "_size").distinct().join(pools, "pool")
    # replicas by falling hash of item and replica
    rank = F.transform(F.reverse(F.array_sort(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda r: F.struct(
        F.xxhash64(F.col("_key"), r).alias("h"), r.alias("r"))))), lambda x: x["r"])
    todo = todo.withColumn("_rank", rank).withColumn("_at", F.lit(0)).checkpoint()
    used = spark.createDataFrame([], "pool string, replica int, _used long")
    placed, idle = [], 0
    most = todo.agg(F.max("_n")).first()[0] or 0
    for _ in range(rounds):
        if idle >= most or todo.isEmpty():
            break
        asks = todo.withColumn("replica", F.get("_rank", F.col("_at") % F.col("_n")))
        ordered = running_totals(asks.select("pool", "replica", "_key", "_size", "_rank", "_at", "_n", "_bound"), ["pool", "replica"], ["_key", "_size"], ["_size"])
        taken = broadcast_if_small(used)      # a row a replica
        fit = F.coalesce("_used", F.lit(0)) + F.col("_size_before") + F.col("_size") <= F.col("_bound")
        asked = ordered.join(taken, ["pool", "replica"], "left").withColumn("_fits", fit).drop("_used").checkpoint()
        idle = idle + 1 if asked.where("_fits").isEmpty() else 0
        placed.append(asked.where("_fits").select("pool", "_key", "_size", "replica"))
        used = used.unionByName(asked.where("_fits").groupBy("pool", "replica").agg(F.sum("_size").alias("_used"))).groupBy(
            "pool", "replica").agg(F.sum("_used").alias("_used")).checkpoint()
        todo = asked.where("not _fits").select("pool", "_key", "_size", "_n", "_bound", "_rank", (F.col("_at") + 1).alias("_at"))
    out = placed[0] if placed else spark.createDataFrame([], "pool string, _key long, _size long, replica int")
    for p in placed[1:]:
        out = out.unionByName(p)
    keys = ["pool", "_key", "_size"]
    dealt = items.join(out, keys, "left")
    # what fits nowhere goes to the replica it ranks first
    n = F.col("replicas")
    best = F.when((n > 0) & F.col("pool").isNotNull(), F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda r: F.struct(
        F.xxhash64(F.col("_key"), r).alias("h"), r.alias("r"))))["r"])
    deal = F.when(best.isNull(), F.lit(None)).when(F.col("replica").isNull(), "over").otherwise("ok")
    return dealt.select(*routed.columns, F.coalesce("replica", best).cast("int").alias("replica"), deal.alias("deal"))
