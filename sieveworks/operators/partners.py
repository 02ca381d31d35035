"""Partners of chunks by counting: the one wanted is computed from ranks and counts, and no pairs are formed inside a group.

All groups may hold most of the rows: ranks are taken in parts of a group (ranges of places, or the first digits of a hash) and
moved up by the counts of the parts before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import dims

#: Values of a part of a group in `counts_up_to`.
PART = 4_096
#: Digits of a hash that make a part of a ring: 16 to this power are ranked apart.
SALT_DIGITS = 2


def hashed(*parts: Column | str) -> Column:
    """32 hexadecimal digits for a row."""
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def number(digest: Column) -> Column:
    """A number of 32 bits from a hash."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def counts_up_to(points: DataFrame, asks: DataFrame, keys: list[str]) -> DataFrame:
    """asks (keys, value and others) with `upto`: the sum of n of those points (keys, value, n) whose value is no larger.

    Values are whole numbers, null keys are a group. Points should be added up by value, so that a part has PART of them at most.
    """
    more = [c for c in asks.columns if c not in (*keys, "value")]
    both = points.select(*keys, "value", "n", F.lit(0).alias("_ask"), *[F.lit(None).cast(asks.schema[c].dataType).alias(c) for c in more])
    both = both.unionByName(asks.select(*keys, "value", F.lit(0).cast("long").alias("n"), F.lit(1).alias("_ask"), *more)).withColumn("_part", F.floor(F.col("value") / PART))
    within = Window.partitionBy(*keys, "_part").orderBy("value", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("_within", F.sum("n").over(within)).where("_ask = 1")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = both.groupBy(*keys, "_part").agg(F.sum("n").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    parts = parts.select(*[F.col(c).alias(f"_{c}") for c in (*keys, "_part")], "_before")
    met = rows.join(parts, [rows[c].eqNullSafe(parts[f"_{c}"]) for c in (*keys, "_part")])
    return met.select(*keys, "value", *more, (F.col("_within") + F.col("_before")).alias("upto"))


def remote_by_section(chunks: DataFrame, gap: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, position, partner, other_section: for each chunk one of its document that stands `gap` or more places off, by hash.

    chunks: doc_id, position (0 to n - 1 in a document), section_path. A partner of another top section is taken where there is
    any, each with equal odds; else one of the same section. Chunks without a section are a section of their own, null and
    empty paths alike. Chunks with no partner are left out.

    Of a section's places s_0 < s_1 < ..., the t-th place outside of it is t plus the number of those i with s_i - i <= t. So the
    wanted rank becomes a place by two rounds of counting.
    """
    keys = ["doc_id", "top"]
    rows = chunks.select("doc_id", F.col("position").cast("long").alias("position"), F.get("section_path", F.lit(0)).alias("top"))
    n = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("size"))
    of_section = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_section"))
    points = rows.select(*keys, F.col("position").alias("value"), F.lit(1).cast("long").alias("n"))
    # how many of its section stand before the chunk, up to the near places, and up to the far ones
    asked = F.array(*[F.struct(F.lit(i).alias("which"), (F.col("position") + d).alias("value")) for i, d in enumerate((-1, -gap, gap - 1))])
    asks = rows.select(*keys, "position", F.explode(asked).alias("a")).select(*keys, "position", "a.which", "a.value")
    got = counts_up_to(points, asks, keys)
    got = got.groupBy(*keys, "position").agg(*[F.max(F.when(F.col("which") == i, F.col("upto"))).alias(c) for i, c in enumerate(("index", "near", "far"))])
    got = got.join(n, "doc_id")
    got = got.join(of_section.withColumnsRenamed({"doc_id": "_doc", "top": "_top"}), (F.col("doc_id") == F.col("_doc")) & F.col("top").eqNullSafe(F.col("_top"))).drop("_doc", "_top")

    # a run of places of one section has one value of s_i - i
    runs = got.select(*keys, (F.col("position") - F.col("index")).alias("value")).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))

    p, last = F.col("position"), F.col("size") - 1
    pick = number(hashed(F.lit(str(seed)), F.col("doc_id").cast("string"), p.cast("string")))
    low = F.greatest(p - gap + 1, F.lit(0))  # places before the near ones
    high = F.greatest(last - p - gap + 1, F.lit(0))
    others = low - F.col("near")  # of them in other sections
    skipped = F.least(p + gap, F.col("size")) - F.col("far")  # places of other sections before the far ones
    beyond = F.col("size") - F.col("in_section") - skipped
    got = got.withColumns({"_low": low, "_high": high, "_others": others, "_beyond": beyond, "_skipped": skipped, "_pick": pick}).where("_low + _high > 0")
    r = F.pmod(F.col("_pick"), F.nullif(F.col("_others") + F.col("_beyond"), F.lit(0)))
    got = got.withColumn("value", F.when(r < F.col("_others"), r).otherwise(F.col("_skipped") + r - F.col("_others")))
    far = counts_up_to(runs, got.where("value is not null").select(*keys, "value", "position"), keys)
    far = far.select("doc_id", "position", (F.col("value") + F.col("upto")).cast("int").alias("partner"), F.lit(True).alias("other_section"))
    r = F.pmod(F.col("_pick"), F.nullif(F.col("_low") + F.col("_high"), F.lit(0)))
    own = got.where("value is null").select("doc_id", "position", F.when(r < F.col("_low"), r).otherwise(p + gap + r - F.col("_low")).cast("int").alias("partner"), F.lit(False).alias("other_section"))
    return far.unionByName(own).withColumn("position", F.col("position").cast("int"))


def within(known: DataFrame) -> DataFrame:
    """whole, ref: which of the distinct references (column ref) hold which, themselves included.

    Only parts of a reference that are as long as some reference are looked up; there are as many lengths as the longest has
    characters at most.
    """
    lengths = known.agg(F.array_sort(F.collect_set(F.length("ref"))).alias("lengths"))  # one row
    rows = known.select(F.col("ref").alias("whole")).crossJoin(F.broadcast(lengths))
    size = F.explode(F.filter("lengths", lambda k: k <= F.length("whole")))
    rows = rows.select("whole", size.alias("k"))
    rows = rows.select("whole", "k", F.explode(F.sequence(F.lit(1), F.length("whole") - F.col("k") + 1)).alias("at"))
    parts = rows.select("whole", F.substr("whole", F.col("at"), F.col("k")).alias("ref")).distinct()
    return parts.join(known, "ref")


def reference_partners(chunks: DataFrame, seed: int = 42) -> DataFrame:
    """chunk_id, ref, specific, holders, target: for each reference of a chunk one of the other chunks that hold it, by hash.

    chunks: chunk_id, refs. A chunk holds a reference that it names, or that stands in a longer one which it names. The holders
    of a reference stand on a ring in the order of a hash; a chunk's partner stands a hashed number of places further on,
    so all holders are equally likely. Ranks are taken for the first digits of the hash apart and counts are added up. References
    with one holder are left out; null and empty ones are none. specific: it names a part of a document (dims.SPECIFIC_REFERENCE).
    """
    held = chunks.select("chunk_id", F.explode(F.array_distinct("refs")).alias("ref")).where("ref <> ''").distinct()
    parts = within(held.select("ref").distinct())
    ring = held.withColumnRenamed("ref", "whole").join(parts, "whole").select("chunk_id", "ref").distinct()
    order = hashed(F.lit(str(seed)), "ref", "chunk_id")
    ring = ring.withColumn("_order", order).withColumn("_salt", F.substring("_order", 1, SALT_DIGITS))
    ranked = ring.withColumn("_rank", F.row_number().over(Window.partitionBy("ref", "_salt").orderBy("_order", "chunk_id")) - 1)
    of_ref = Window.partitionBy("ref")
    salts = ring.groupBy("ref", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    salts = salts.select("ref", "_salt", (F.sum("_n").over(of_ref.orderBy("_salt")) - F.col("_n")).alias("_before"), F.sum("_n").over(of_ref).alias("holders"))
    ranked = ranked.join(salts.where("holders > 1"), ["ref", "_salt"]).select("ref", "chunk_id", (F.col("_rank") + F.col("_before")).alias("rank"), "holders")
    step = 1 + F.pmod(number(hashed(F.lit(str(seed)), F.lit("step"), "ref", "chunk_id")), F.nullif(F.col("holders") - 1, F.lit(0)))
    asks = held.join(ranked, ["ref", "chunk_id"]).select("chunk_id", "ref", "holders", F.pmod(F.col("rank") + step, F.col("holders")).alias("rank"))
    met = asks.join(ranked.select("ref", "rank", F.col("chunk_id").alias("target")), ["ref", "rank"])
    return met.select("chunk_id", "ref", F.col("ref").rlike(dims.SPECIFIC_REFERENCE).alias("specific"), "holders", "target")
