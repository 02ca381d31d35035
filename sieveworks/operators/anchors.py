"""Anchors for requests: which chunks a new item is to be built on.

A request names an aspect; each aspect has a strategy. First anchors are compatible chunks in the order of a hash, some more
than there are requests; partners come from tables of pairs that are made for these anchors alone. A request whose aspect
fits no chunk takes one of all chunks; one that finds no partner in any attempt has its first anchor only and is marked as a
miss, which `generate` leaves out and counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import dims
from ..functions.rules import aspect_fits
from ..session import stored
from . import partners, similarity

# How the anchors of an aspect are joined, how many there are, and the least similarity; others stand alone.
STRATEGIES = {
    "multi_source_integration": ("near", 3, 0.5),
    "multi_doc_reference": ("near_other_doc", 2, 0.55),
    "remote_reference": ("remote", 2, 0.0),
    "standards_reference": ("reference", 2, 0.0),
    "multi_hop": ("near", 2, 0.5),
    "reference_follow": ("reference", 2, 0.0),
}


#: Requests that need partners try so many first anchors.
ATTEMPTS = 20
#: Digits of a hash that chunks are counted by.
SALT_DIGITS = 3


#: Order of the flags in `marked`.
_FLAGS = tuple(a for a, _, _ in dims.ASPECT_ROWS) + ("reference_follow",)


def marked(chunks: DataFrame) -> DataFrame:
    """chunks without their text, and `flags`: which aspects they fit. Written once, as texts are slow to look through."""
    fits = aspect_fits(F.col("text"), F.col("section_path"), F.col("references"))
    flags = F.array(*[F.coalesce(fits[a], F.lit(False)) for a in _FLAGS])
    return stored(chunks.select("chunk_id", "doc_id", "position", "section_path", "references", flags.alias("flags")), "marks")


def first_anchors(requests: DataFrame, marks: DataFrame, seed: int = 42) -> DataFrame:
    """request_id, aspect, attempt, chunk_id, fits. requests: request_id, aspect (one of a fixed few); marks: as `marked` gives them.

    Aspects whose anchors stand alone have one attempt, the others ATTEMPTS, each with the next chunk in the order of a hash.

    Chunks are counted by the first digits of their hashes, so those that no request can reach are left out before any are sorted,
    and ranks are taken for these digits apart and moved up by the counts before. Requests find their chunk by its rank.
    """
    counts = {r["aspect"]: r["n"] for r in requests.groupBy("aspect").agg(F.count(F.lit(1)).alias("n")).collect()}  # the aspects
    flag = {a: F.col("flags")[i] for i, a in enumerate(_FLAGS)}
    wanted = F.array(*[F.struct(F.lit(a).alias("aspect"), flag.get(a, F.lit(True)).alias("fits")) for a in counts])
    pool = marks.select("chunk_id", F.explode(wanted).alias("w")).select("chunk_id", "w.aspect", "w.fits")
    pool = pool.withColumn("order", partners.hashed(F.lit(str(seed)), "aspect", "chunk_id")).withColumn("salt", F.substring("order", 1, SALT_DIGITS))
    of_aspect = Window.partitionBy("aspect")
    salts = pool.groupBy("aspect", "fits", "salt").agg(F.count(F.lit(1)).alias("n")).withColumn("any", F.max("fits").over(of_aspect))
    salts = salts.where(F.col("fits") == F.col("any"))  # chunks that do not fit serve only where none does
    most = max(counts.values(), default=0) + ATTEMPTS
    before = F.sum("n").over(of_aspect.orderBy("salt")) - F.col("n")
    salts = salts.select("aspect", "fits", "salt", before.alias("before"), F.least(F.sum("n").over(of_aspect), F.lit(most)).alias("of")).where("before < of")
    best = pool.join(F.broadcast(salts), ["aspect", "fits", "salt"])  # 16 ** SALT_DIGITS rows an aspect at most
    within = F.row_number().over(Window.partitionBy("aspect", "salt").orderBy("order", "chunk_id"))
    best = best.select("aspect", (F.col("before") + within).alias("n"), "chunk_id", "fits")
    sizes = salts.select("aspect", "of").distinct()
    numbered = requests.withColumn("i", F.row_number().over(Window.partitionBy("aspect").orderBy("request_id")) - 1)
    last = F.when(F.col("aspect").isin(*STRATEGIES), ATTEMPTS - 1).otherwise(0)
    tries = numbered.join(F.broadcast(sizes), "aspect").withColumn("attempt", F.explode(F.sequence(F.lit(0), last)))  # a row an aspect
    tries = tries.withColumn("n", F.pmod(F.col("i") + F.col("attempt"), F.col("of")) + 1)
    return tries.join(best, ["aspect", "n"]).select("request_id", "aspect", "attempt", "chunk_id", "fits")


def _partners(firsts: DataFrame, chunks: DataFrame, vectors: DataFrame | None) -> DataFrame:
    """request_id, attempt, place, partner: the further anchors of each attempt, by the strategy of its aspect."""
    rules = [(a, *s) for a, s in STRATEGIES.items()]
    rows = firsts.join(F.broadcast(firsts.sparkSession.createDataFrame(rules, "aspect string, how string, n int, least double")), "aspect")  # six rules
    of = lambda how: rows.where(F.col("how") == how).select("request_id", "attempt", "chunk_id", "n", "least")
    keep = ("request_id", "attempt", "place", "partner")
    spots = chunks.select("chunk_id", "doc_id", "position")
    # partners depend on their own document alone, so only the documents of these anchors are looked at
    docs = spots.join(of("remote").select("chunk_id").distinct(), "chunk_id", "left_semi").select("doc_id").distinct()
    spots = spots.join(docs, "doc_id", "left_semi")
    remote = partners.remote_by_section(chunks.join(docs, "doc_id", "left_semi")).join(spots, ["doc_id", "position"])
    remote = remote.join(spots.select("doc_id", F.col("position").alias("partner"), F.col("chunk_id").alias("other")), ["doc_id", "partner"])
    out = of("remote").join(remote.select("chunk_id", F.col("other").alias("partner")), "chunk_id").withColumn("place", F.lit(1)).select(*keep)
    held = partners.reference_partners(chunks.select("chunk_id", F.col("references").alias("refs")))
    # specific references first; of several one by the hash that also orders them
    followed = held.groupBy("chunk_id").agg(F.min(F.struct((~F.col("specific")).alias("vague"), partners.hashed("ref", "chunk_id").alias("order"), "target"))["target"].alias("partner"))
    out = out.unionByName(of("reference").join(followed, "chunk_id").withColumn("place", F.lit(1)).select(*keep))
    if vectors is None:
        return out
    corpus = vectors.join(chunks.select("chunk_id", "doc_id"), "chunk_id").select(F.xxhash64("chunk_id").alias("id"), "vec", F.xxhash64("doc_id").alias("label"), "chunk_id")

    def met(asked: DataFrame, k: int, same: bool) -> DataFrame:
        queries = corpus.join(asked.select("chunk_id").distinct(), "chunk_id")
        found = similarity.nearest(corpus, queries, k, same=same)
        found = found.join(corpus.select(F.col("id").alias("query"), "chunk_id"), "query").join(corpus.select("id", F.col("chunk_id").alias("partner")), "id")
        rows = asked.join(found, "chunk_id").where((F.col("rank") < F.col("n")) & (F.col("sim") >= F.col("least")))
        return rows.select("request_id", "attempt", F.col("rank").alias("place"), "partner")

    width = {how: max(n for _, h, n, _ in rules if h == how) - 1 for how in ("near", "near_other_doc")}
    other = met(of("near_other_doc"), width["near_other_doc"], same=True)
    alone = of("near_other_doc").join(other, ["request_id", "attempt"], "left_anti")  # near chunks in their own document only
    return out.unionByName(met(of("near"), width["near"], same=False)).unionByName(other).unionByName(met(alone, 1, same=False))


def anchor_sets(requests: DataFrame, chunks: DataFrame, vectors: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """request_id, aspect, key, anchors (array of chunk structs) and miss: null, `compat` or `partner`.

    A request that needs partners takes its first attempt that has any. What is read more than once (chunks without their text, and
    first anchors) is written to the folder that spark.checkpoint.dir names, which a cluster needs.
    """
    marks = marked(chunks)
    firsts = stored(first_anchors(requests.select("request_id", "aspect"), marks, seed), "firsts")  # read by each strategy
    more = _partners(firsts, marks, vectors)
    tries = more.groupBy("request_id", "attempt").agg(F.array_sort(F.collect_list(F.struct("place", "partner"))).alias("partners"))  # two at most
    chosen = tries.groupBy("request_id").agg(F.min(F.struct("attempt", "partners")).alias("c"))
    firsts = firsts.join(chosen, "request_id", "left").where(F.col("attempt") == F.coalesce("c.attempt", F.lit(0)))
    lead = F.array(F.struct(F.lit(0).alias("place"), F.col("chunk_id").alias("partner")))
    every = firsts.select("request_id", F.inline(F.concat(lead, F.coalesce("c.partners", F.filter(lead, lambda x: F.lit(False))))))
    body = every.join(chunks, every["partner"] == chunks["chunk_id"])
    fields = F.struct("place", F.struct("chunk_id", "doc_id", "page", "section_path", "text", "position").alias("c"))
    sets = body.groupBy("request_id").agg(F.transform(F.array_sort(F.collect_list(fields)), lambda x: x["c"]).alias("anchors"))
    joint = F.col("aspect").isin(*STRATEGIES)
    miss = F.when(joint & (F.size("anchors") < 2), "partner").when(~F.col("fits"), "compat")
    return firsts.join(sets, "request_id").select("request_id", "aspect", F.col("aspect").alias("key"), "anchors", miss.alias("miss"))
