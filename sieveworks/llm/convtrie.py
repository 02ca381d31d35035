"""Prefix trie of conversations, built level by level.

Each conversation is rebuilt first: the first h turns of the conversation it continues (its id rounded down to a multiple of
100), then its own turns after its first h, where h is the unsigned crc32 of its decimal id modulo 6. A node of depth d is a
distinct sequence of first d turns (role, text). Its members are the conversations that start with it, and its name is the
smallest of their ids.

Construction: per depth, live conversations are grouped by (parent node, next turn) and take the group's smallest id. A
conversation alone in its node has nothing left to share: it leaves the rounds, and the chain of nodes below is read off its
turns. So there are as many rounds as the deepest shared prefix has turns, not as the longest conversation has. Then levels
are joined in reverse, each adding its children's leaves and savings to their parents.

Turns are numbered by a range sort over the cluster (`row_numbers`), so a conversation with most of the rows is divided. The
ids that end in a node are sorted by range and joined to blocks there; the blocks of a node go through one stream, which
holds one block at a time, as SHA-256 has to read its input in order.

Null roles and texts count as empty, null turns stand first, equal turns are ordered by role and text, and repeated rows are
turns of their own. Rows without conv_id belong to no conversation. Remainders have the sign of the id. An empty table
has no node; else there is a root, even if no conversation has turns. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, table

#: Continued conversations have ids that are multiples of FAMILY; up to MOST_SHARED - 1 of their turns are taken over.
FAMILY = 100
MOST_SHARED = 6
#: Ids in a block that a node at the edge of a range hands on.
BLOCK = 4_096

NOTHING = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over."""
    return F.crc32(conv_id.cast("string").cast("binary")) % F.lit(MOST_SHARED)


def row_numbers(df: DataFrame, key: str, order: list[Column], name: str, label: str) -> DataFrame:
    """A 1-based number in each group of `key` by `order`, from a range sort: a group may lie in many tasks. df is written, without
    what only `order` needs (columns that start with an underscore)."""
    by = [F.col(key), *order]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by).select(*(c for c in df.columns if c[0] != "_"), F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    dealt = materialise(dealt, label)
    parts = dealt.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_lo"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(key, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_lo")).alias("_o"))
    return dealt.join(offsets, [key, "_part"]).withColumn(name, (F.col("_at") + F.col("_o")).cast("long")).drop("_part", "_at", "_o")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, mark, chars) of all rebuilt turns, and (conv_id, turns) of all conversations. mark stands for (role, text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"), text("role").alias("_role"), text("text").alias("_text")).where("conv_id is not null")
    rows = rows.select("*", F.unhex(F.sha2(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"), 256)).alias("mark"), F.length("_text").cast("long").alias("chars"))
    own = materialise(row_numbers(rows, "conv_id", [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_text")], "i", "trie-dealt"), "trie-turns")

    shared = shared_turns(F.col("conv_id"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = own.groupBy("conv_id").agg(F.max("i").alias("n")).select("conv_id", "n", shared.alias("h"), base.alias("base"))
    convs = materialise(convs, "trie-conversations")
    first = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("i") < MOST_SHARED)).withColumnRenamed("conv_id", "base")
    given = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("given"))

    taken = F.least(F.col("h"), F.coalesce("given", F.lit(0)))
    convs = convs.join(given, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("turns"))
    heads = convs.join(first, "base").where("i <= h").select("conv_id", F.col("i").alias("depth"), "mark", "chars")
    # what h is follows from the id, so only the number of turns taken over has to be joined to the turns
    tails = own.where(F.col("i") > shared).join(convs.select("conv_id", "taken", "h"), "conv_id").select("conv_id", (F.col("taken") + F.col("i") - F.col("h")).alias("depth"), "mark", "chars")
    turns = heads.unionByName(tails).repartitionByRange("depth", "conv_id").sortWithinPartitions("depth", "conv_id")
    return materialise(turns, "trie-rebuilt"), materialise(convs.select("conv_id", "turns"), "trie-lengths")


def grow(turns: DataFrame, lengths: DataFrame, root: int) -> list[DataFrame]:
    """Per depth from 1: (conv_id, parent, node, n, chars) of each conversation that shared its node one level above."""
    live, levels = lengths.select("conv_id", F.lit(root).cast("long").alias("node")), []
    while True:
        depth = len(levels) + 1
        step = live.withColumnRenamed("node", "parent").join(turns.where(F.col("depth") == depth).drop("depth"), "conv_id")
        nodes = step.groupBy("parent", "mark").agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n"))
        level = materialise(step.join(nodes, ["parent", "mark"]).select("conv_id", "parent", "node", "n", "chars"), "trie-level")
        levels.append(level)
        live = level.where("n > 1").select("conv_id", "node")
        if live.isEmpty():
            return levels


def roll_up(levels: list[DataFrame], root: int, members: int) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens) of the root and of all nodes with several members."""
    columns = ("node", "parent", "n", "kids", "leaves", "saved")
    out, below = None, None
    spark = levels[0].sparkSession
    top = spark.createDataFrame([(root, None, members, 0)], "node long, parent long, n long, own long")
    for depth in range(len(levels), -1, -1):
        nodes = top if depth == 0 else levels[depth - 1].where("conv_id = node").select("node", "parent", "n", ((F.col("n") - 1) * F.col("chars")).alias("own"))
        inner = nodes if depth == 0 else nodes.where("n > 1")
        if below is not None:
            inner = inner.join(below, "node", "left")
        else:
            inner = inner.select("*", *(F.lit(None).cast("long").alias(c) for c in columns[3:]))
        inner = inner.select("node", "parent", "n", F.coalesce("kids", F.lit(0)).alias("kids"), F.coalesce("leaves", F.lit(1)).alias("leaves"), (F.col("own") + F.coalesce("saved", F.lit(0))).alias("saved"))
        inner = materialise(inner, "trie-rolled")
        done = inner.withColumn("depth", F.lit(depth).cast("long"))
        out = done if out is None else out.unionByName(done)
        if depth:
            alone = nodes.where("n = 1").select("parent", F.lit(1).alias("leaves"), F.lit(0).alias("saved"))
            kids = inner.select("parent", "leaves", "saved").unionByName(alone)
            below = kids.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return out.select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) from (depth, node, conv_id): SHA-256 of the ids in order, joined by commas."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, ids = None, []
        for pdf in batches:
            out: list[tuple] = []
            for depth, node, conv in zip(pdf["depth"].tolist(), pdf["node"].tolist(), pdf["conv_id"].tolist(), strict=True):
                if ids and ((depth, node) != here or len(ids) == BLOCK):
                    out.append((*here, ids[0], ",".join(map(str, ids))))
                    ids = []
                here = (depth, node)
                ids.append(conv)
            yield pd.DataFrame(out, columns=["depth", "node", "first", "ids"])
        yield pd.DataFrame([(*here, ids[0], ",".join(map(str, ids)))] if ids else [], columns=["depth", "node", "first", "ids"])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, sha = None, hashlib.sha256()
        for pdf in batches:
            out: list[tuple] = []
            for depth, node, ids in zip(pdf["depth"].tolist(), pdf["node"].tolist(), pdf["ids"], strict=True):
                if (depth, node) == here:
                    sha.update(b",")
                else:
                    if here:
                        out.append((*here, sha.hexdigest()))
                    here, sha = (depth, node), hashlib.sha256()
                sha.update(ids.encode())
            yield pd.DataFrame(out, columns=["depth", "node", "ends_sha256"])
        yield pd.DataFrame([(*here, sha.hexdigest())] if here else [], columns=["depth", "node", "ends_sha256"])

    dealt = ends.repartitionByRange("depth", "node", "conv_id").sortWithinPartitions("depth", "node", "conv_id")
    packed = dealt.mapInPandas(blocks, "depth long, node long, first long, ids string")
    return packed.repartition("depth", "node").sortWithinPartitions("depth", "node", "first").mapInPandas(digests, "depth long, node long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuild(conversations)
    root, members = lengths.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if not members:
        schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return conversations.sparkSession.createDataFrame([], schema)
    levels = grow(turns, lengths, root)
    leveled = None
    for depth, level in enumerate(levels, 1):
        level = level.withColumn("depth", F.lit(depth).cast("long"))
        leveled = level if leveled is None else leveled.unionByName(level)

    several = leveled.where("n > 1").select("conv_id", "depth", "node").join(lengths, "conv_id").where("depth = turns").select("depth", "node", "conv_id")
    turnless = lengths.where("turns = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), "conv_id")
    ends = ends_digest(several.unionByName(turnless)).withColumnRenamed("node", "conv_id")
    shared = roll_up(levels, root, members).join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))

    # a node with one member, and the chain below it
    alone = leveled.where("n = 1").select("conv_id", F.col("depth").alias("top"), "parent").join(lengths, "conv_id")
    chain = turns.select("conv_id", "depth").join(alone, "conv_id").where("depth >= top")
    last = F.col("depth") == F.col("turns")
    chain = chain.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    return shared.unionByName(chain)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


# crc32 bit by bit over the digits of an id; the trie by one recursion over depths
SQL = """
with recursive crc_table as (
    select list(v order by b) as t from (
        select b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as v
        from (select unnest(range(256)) as b)
    )
),
own as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
    from conversations where conv_id is not null
),
convs as (
    select c, n, c - c % 100 as base,
        xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1)))), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 6 as h
    from (select conv_id as c, max(i) as n, conv_id::varchar as s from own group by conv_id), crc_table
),
lengths as (
    select a.c, a.h, a.base, least(a.h, coalesce(b.n, 0)) as taken, least(a.h, coalesce(b.n, 0)) + greatest(0, a.n - a.h) as turns
    from convs a left join convs b on b.c = a.base
),
rebuilt as (
    select l.c, o.i as d, o.role, o.text from lengths l join own o on o.conv_id = l.base and o.i <= l.h
    union all
    select l.c, l.taken + o.i - l.h, o.role, o.text from lengths l join own o on o.conv_id = l.c and o.i > l.h
),
member as (
    select c, 0::bigint as d, (select min(c) from lengths) as node, null::bigint as parent, '' as text from lengths
    union all
    select r.c, r.d, min(r.c) over (partition by m.node, r.role, r.text), m.node, r.text from member m join rebuilt r on r.c = m.c and r.d = m.d + 1
),
nodes as (
    select m.d, m.node, any_value(m.parent) as parent, count(*) as n, (count(*) - 1) * length(any_value(m.text)) as own,
        sha256(coalesce(string_agg(m.c::varchar, ',' order by m.c) filter (l.turns = m.d), '')) as ends
    from member m join lengths l on l.c = m.c group by m.d, m.node
),
kids as (select d - 1 as d, parent as node, count(*) as k from nodes where d > 0 group by d, parent),
full_nodes as (select n.*, coalesce(k, 0) as k from nodes n left join kids on kids.d = n.d and kids.node = n.node),
under as (
    select m.d, m.node, sum(case when x.k = 0 then 1 else 0 end) as leaves, sum(x.own) as saved
    from full_nodes x join member m on m.c = x.node and m.d <= x.d group by m.d, m.node
)
select f.node as conv_id, f.d as depth, f.parent as parent_conv_id, f.n as n_convs, f.k as n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens, ends as ends_sha256
from full_nodes f join under u on u.d = f.d and u.node = f.node
"""
