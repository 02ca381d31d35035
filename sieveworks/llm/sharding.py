"""Sharding by balanced label propagation, in DataFrame functions only.

Documents that share a group (here: equal texts) are linked. Linked documents start on evenly dealt shards; in each round
a document wants to go to the shard with room that has the most of its group, and the moves are admitted in order of
group size while the shard's quota lasts. What a quota turns away goes on to other shards with room, in one run, so that a
group larger than a shard fills whole shards and is cut as seldom as can be. Documents without a link fill up the places
that are left, so that the counts of the shards differ by one at most (law `rows`). In the rounds a shard may hold a tenth
more than its quota of groups that fit in a shard; the last step evens that out. Rounds end when PATIENCE of them in a row have not lowered the number
of places (group and shard) that the groups take, the measure of the links that are cut; the best labels stay.

No task gets a whole group: sizes and votes are partial aggregates, groups above a share of all rows (at most 1 / HOT_SHARE
of them can be) are joined by broadcast and dealt over salted buckets, and ranks are added up over buckets.

Null texts have size 16 and crc32 of no bytes, and are linked to nothing. Repeated rows are separate documents; rows that
agree in all of doc_id, size and text are told apart by their place. An empty table gives no rows; with fewer rows than
shards the last shards stay empty. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, documents, global_rank, materialise, table

SHARDS = 40
PATIENCE = 2
#: A group with more than this share of all rows counts as hot.
HOT_SHARE = 1 / 500
SALTS = 64


def _load(labels: DataFrame, shards: int, caps: DataFrame) -> DataFrame:
    """shard, cap, load and room of all shards; one row per shard."""
    load = labels.groupBy("shard").agg(F.count(F.lit(1)).alias("load"))
    return caps.join(F.broadcast(load), "shard", "left").select("shard", "cap", (F.col("cap") - F.coalesce("load", F.lit(0))).alias("room"))


def _votes(labels: DataFrame, rooms: DataFrame, free: list[int], most: int, slack: int) -> DataFrame:
    """For each group the shard it wants: of those with room that have members of it, the one with most of them, and how
    many these are. A divided group none of whose shards has room wants one of the free shards, where it has none yet.
    Groups of more than `most` rows, which no shard can hold, have no use of the slack.
    """
    cells = labels.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    open_ = cells.join(F.broadcast(rooms), "shard").withColumn("open", F.col("room") > F.when(F.col("size") > most, slack).otherwise(0))
    best = F.max(F.when(F.col("open"), F.struct("n", F.xxhash64("grp", "shard").alias("h"), "shard")))
    wants = open_.groupBy("grp").agg(best["shard"].alias("best"), best["n"].alias("n"), F.count(F.lit(1)).alias("parts"))
    other = F.when(F.col("parts") > 1, F.element_at(F.array(*map(F.lit, free)), (F.pmod(F.xxhash64("grp"), F.lit(len(free))) + 1).cast("int"))) if free else F.lit(None)
    return wants.select("grp", F.coalesce("best", other).cast("int").alias("want"), F.coalesce("n", F.lit(0)).alias("there"))


def _places(labels: DataFrame) -> int:
    """How many shards the groups take, all in all."""
    return labels.select("grp", "shard").distinct().count()


def _joined(left: DataFrame, right: DataFrame, hot: DataFrame, how: str = "inner") -> DataFrame:
    """left joined to right (a row per group): the hot groups, few by their definition, by broadcast, the others by a shuffle."""
    few = right.join(F.broadcast(hot), "grp", "left_semi")
    rest = right.join(F.broadcast(hot), "grp", "left_anti")
    return left.where("hot").join(F.broadcast(few), "grp", how).unionByName(left.where("not hot").join(rest, "grp", how))


def _bucket(buckets: int) -> Column:
    """Members of a group are neighbours: one bucket for a group, SALTS buckets in a row for a hot one."""
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("key"), F.lit(SALTS))).otherwise(0)
    return F.pmod(F.xxhash64("grp"), F.lit(buckets)) * SALTS + salt


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """key and shard of all rows of docs (key, grp): grp links rows, null links to nothing."""
    spark = docs.sparkSession
    docs = docs.select("key", "grp")
    n = docs.count()
    sizes = docs.where(F.col("grp").isNotNull()).groupBy("grp").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = materialise(sizes, "shard-groups")
    hot_size = max(2, int(n * HOT_SHARE))
    hot = sizes.where(F.col("size") > hot_size).select("grp")
    caps = spark.range(shards).select(F.col("id").cast("int").alias("shard"), (F.lit(n // shards) + (F.col("id") < n % shards).cast("int")).alias("cap"))
    is_hot = F.broadcast(hot.withColumn("hot", F.lit(True)))
    marked = docs.join(is_hot, "grp", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    linked = _joined(marked, sizes, hot)
    buckets = max(16, -(-n // (SALTS * 200)))
    # an even start: every shard gets every shards-th linked document
    start = global_rank(linked, [], F.pmod(F.xxhash64("key", F.lit(1)), F.lit(buckets)), [F.col("key")], "rank")
    labels = materialise(start.withColumn("shard", (F.col("rank") % shards).cast("int")).drop("rank"), "shard-labels")
    slack, large = max(1, n // shards // 10), F.col("size") > n // shards
    best, fewest, waited = labels, _places(labels), 0
    while fewest and waited < PATIENCE:
        seen = _load(labels, shards, caps.withColumn("cap", F.col("cap") + slack)).collect()  # one row per shard
        rooms = spark.createDataFrame([tuple(r) for r in seen], "shard int, cap long, room long")
        votes = _votes(labels, rooms, [r["shard"] for r in seen if r["room"] > slack], n // shards, slack)
        here = labels.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("mine"))
        here = here.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("shard", "mine"))).alias("cells"))  # at most one entry per shard
        voted = _joined(labels, votes.join(here, "grp"), hot)
        better = F.col("want").isNotNull() & (F.col("want") != F.col("shard")) & (
            (F.col("there") > F.col("cells")[F.col("shard")])
            | ((F.col("there") == F.col("cells")[F.col("shard")]) & (F.xxhash64("grp", "want") > F.xxhash64("grp", "shard")))
            | ((F.col("there") == 0) & ~large)
        )
        movers = voted.where(better).drop("cells", "there")
        in_order = F.when(large, _bucket(buckets)).otherwise(_bucket(buckets) + buckets * SALTS)
        ranked = global_rank(movers, ["want"], in_order, [F.col("size").desc(), F.col("grp"), F.col("key")], "rank")
        ranked = materialise(ranked, "shard-moves")
        asked = ranked.groupBy(F.col("want").alias("shard")).agg(F.count(F.lit(1)).alias("asked"), F.count_if(large).alias("large"))
        plan = rooms.join(F.broadcast(asked), "shard", "left").fillna(0, ["asked", "large"])
        # rows of large groups rank first: `first` of them are taken, and so many of all
        plan = plan.withColumn("first", F.least(F.greatest(F.col("room") - slack, F.lit(0)), "large")).withColumn("over", F.col("large") - F.col("first"))
        plan = plan.withColumn("taken", F.least(F.greatest("room", F.lit(0)), "asked"))
        runs = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # over one row per shard
        left_over = plan.withColumn("left", F.greatest(F.col("room") - slack - F.col("taken"), F.lit(0)))
        left_over = left_over.withColumn("over_from", F.coalesce(F.sum("over").over(runs), F.lit(0))).withColumn("left_from", F.coalesce(F.sum("left").over(runs), F.lit(0)))
        few = left_over.collect()  # one row per shard
        if not sum(r["asked"] for r in few):
            break
        # the overflow of all shards, in order, takes the room that is left, in order
        plan_df = spark.createDataFrame([(r["shard"], r["first"], r["taken"], r["over_from"]) for r in few], "want int, first long, taken long, over_from long")
        room_rows = [(r["left_from"], r["left_from"] + r["left"], r["shard"]) for r in few if r["left"] > 0]
        room_df = spark.createDataFrame(room_rows, "lo long, hi long, to int")
        # only a group that no shard can hold goes on at once; others ask again in the next round
        goes_on = large & (F.col("rank") >= F.col("first"))
        moved = ranked.join(F.broadcast(plan_df), "want").withColumn("at", F.when(goes_on, F.col("rank") - F.col("first") + F.col("over_from")))
        moved = moved.join(F.broadcast(room_df), (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi")), "left")
        moved = moved.select("key", F.when(F.col("rank") < F.when(large, F.col("first")).otherwise(F.col("taken")), F.col("want")).otherwise(F.coalesce("to", "shard")).cast("int").alias("new"))
        moved = labels.join(moved, "key", "left").withColumn("shard", F.coalesce("new", "shard")).drop("new")
        moved, was = materialise(moved, "shard-labels"), labels
        discard(ranked)
        labels, now = moved, _places(moved)
        if was is not best:
            discard(was)
        if now < fewest:
            discard(best)
            best, fewest, waited = labels, now, 0
        else:
            waited += 1
    labels = best

    # exact quotas: what a shard has above its quota, smallest groups last in, and all unlinked rows fill the free places
    placed = global_rank(labels, ["shard"], _bucket(buckets), [F.col("size").desc(), F.col("grp"), F.col("key")], "rank")
    placed = placed.join(F.broadcast(caps), "shard").withColumn("stays", F.col("rank") < F.col("cap"))
    placed = materialise(placed.select("key", "shard", "stays"), "shard-placed")
    held = {r["shard"]: r["n"] for r in placed.where("stays").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    free, at = [], 0
    for s in range(shards):
        room = n // shards + (s < n % shards) - held.get(s, 0)
        if room:
            free.append((at, at + room, s))
        at += room
    rest = docs.select("key").join(placed.where("stays").select("key"), "key", "left_anti")
    rest = global_rank(rest, [], F.pmod(F.xxhash64("key", F.lit(2)), F.lit(buckets)), [F.col("key")], "rank")
    free_df = spark.createDataFrame(free, "lo long, hi long, shard int")
    filled = rest.join(F.broadcast(free_df), (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select("key", "shard")
    return placed.where("stays").select("key", "shard").unionByName(filled)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: all documents, law `rows`; documents with equal texts are linked."""
    docs = documents(table(spark, sf_dir, "documents"))
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
        F.sha2(F.col("text"), 256).alias("grp"),
        F.monotonically_increasing_id().alias("key"),
    )
    rows = materialise(rows, "shard-rows")
    shards = balanced_shards(rows)
    out = rows.join(shards, "key")
    n = rows.count()
    out = global_rank(out, ["shard"], F.pmod(F.xxhash64("key"), F.lit(max(1, n // 20_000))), [F.col("doc_id"), F.col("key")], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("grp").alias("text_sha256"))
