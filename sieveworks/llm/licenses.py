"""License scans by diagonal voting.

Texts become words: A to Z are lower-cased, and digits, a to z and all beyond ASCII are letters of words. All rolling runs of k
words of all texts are joined by their hash to their places in templates (a phrase, or the words of a notice), and the words
themselves are compared in the join, so no vote rests on a hash. A run at word p of a text that stands at word q of a
template votes for the diagonal p - q. Votes are added up by diagonal; neighbouring diagonals, as words put in or left
out leave them, are merged into one span. A span is verified where it holds enough of the template's words and little else:
all of them, in a row, for phrases; LEAST_SHARE of them for notices.

Phrases are the base: their places are counted, and they label a text by themselves. Notices add their own labels. The score is
the largest share of a template's words in one span, whether it was verified or not: 1 for a text with a base phrase.

Null and empty texts have no words: no labels, no places, score 0. Each of several equal rows gets the same result. Null ids stay
null. An empty table gives no rows. Templates with fewer than two words find nothing. Extra columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, table

#: Words of a run: of templates of fewer than NOTICE words, and of the others.
K_PHRASE, K_NOTICE = 2, 5
NOTICE = 8
#: The part of a notice's words that a span has to hold, and the part of a span's words that have to be the notice's.
LEAST_SHARE, LEAST_DENSITY = 0.6, 0.6
#: Diagonals of a notice that are this many words apart, per word of the notice, are merged.
SLACK = 0.125
#: What all templates together may have: their runs are broadcast.
MOST_WORDS = 200_000

_NOT_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False


# Names of licenses, and sentences of their public notices.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
)
TEMPLATES = (*PHRASES, *NOTICES)


def words_of(text: Column) -> Column:
    """The words of a text in order."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _NOT_WORDS, -1), "")


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_NOT_WORDS, text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def _runs(words: Column, k: int) -> Column:
    """All runs of k words, each as one string."""
    n = F.size(words) - (k - 1)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(words, i, k), " "))
    return F.when(n > 0, each).otherwise(F.expr("array()").cast("array<string>"))


def places(spark, templates: tuple[Template, ...]) -> DataFrame:
    """Each run of each template: hash, its words, template, place q; and the template's label, base, size k and slack."""
    rows = []
    for t, (label, text, base) in enumerate(templates):
        words = template_words(text)
        notice = len(words) >= NOTICE
        k = K_NOTICE if notice else K_PHRASE
        rows += [(t, label, base, len(words), k, int(len(words) * SLACK) if notice else 0, q, " ".join(words[q : q + k])) for q in range(len(words) - k + 1)]
    if sum(r[3] for r in {r[0]: r for r in rows}.values()) > MOST_WORDS:
        raise ValueError(f"templates of more than {MOST_WORDS} words: scan in several passes")
    got = spark.createDataFrame(rows, "template int, label string, base boolean, size int, k int, slack int, q int, run string")
    return got.withColumn("hash", F.xxhash64("run"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """The votes of all texts: doc_id, digest (of the text), n_words, p, q and the template's columns; and a row without template
    for each text, so that one scan of the texts is enough."""
    runs = F.broadcast(places(docs.sparkSession, templates).withColumnRenamed("k", "run_words"))
    rows = documents(docs).select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), words_of(F.col("text")).alias("words"))
    both = F.concat(F.array(F.lit("")), _runs(F.col("words"), K_PHRASE), _runs(F.col("words"), K_NOTICE))
    rows = rows.select("doc_id", "digest", F.size("words").alias("n"), both.alias("runs"))
    # outer, although no array is empty: for a plain explode the optimizer tests the size first, in a filter that splits the text once per run
    rows = rows.select("doc_id", "digest", "n", F.posexplode_outer("runs").alias("at", "words"))
    # place 0 is the text itself, then come the short runs, then the long ones
    short = F.greatest(F.col("n") - (K_PHRASE - 1), F.lit(0))
    p = F.when(F.col("at") == 0, -1).when(F.col("at") <= short, F.col("at") - 1).otherwise(F.col("at") - 1 - short)
    found = rows.withColumn("gram", F.xxhash64("words")).join(runs, (F.col("gram") == F.col("hash")) & (F.col("words") == F.col("run")), "left")
    found = found.where("at = 0 or template is not null")
    return found.select("doc_id", "digest", F.col("n").cast("long").alias("n_words"), p.alias("p"), "template", "label", "base", "size", "run_words", "slack", "q")


def spans(votes: DataFrame) -> DataFrame:
    """Verified and other spans of all texts, and a row without template for each text; votes are dealt out by text once."""
    text = ["doc_id", "digest", "n_words"]
    kind = ["template", "label", "base", "size", "run_words", "slack"]
    votes = votes.repartition("doc_id", "digest").withColumn("diagonal", F.col("p") - F.col("q"))
    lines = votes.groupBy(*text, *kind, "diagonal").agg(F.count(F.lit(1)).alias("rows"), F.min("p").alias("start"), F.max(F.col("p") + F.col("run_words")).alias("end"), F.collect_set("q").alias("qs"))
    order = Window.partitionBy(*text, "template").orderBy("diagonal")
    lines = lines.withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(order) > F.col("slack")).cast("int"))
    lines = lines.withColumn("island", F.sum(F.coalesce("new", F.lit(0))).over(order))
    out = lines.groupBy(*text, *kind, "island").agg(F.first("rows").alias("rows"), F.min("start").alias("start"), F.max("end").alias("end"), F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("qs", lambda q: F.sequence(q, q + F.col("run_words") - 1)))))
    out = out.withColumn("covered", F.when(F.col("template").isNotNull(), covered)).withColumn("share", F.col("covered") / F.col("size"))
    whole = (F.col("covered") == F.col("size")) & (F.col("end") - F.col("start") == F.col("size"))
    loose = (F.col("share") >= LEAST_SHARE) & (F.col("covered") >= LEAST_DENSITY * (F.col("end") - F.col("start")))
    return out.withColumn("verified", F.when(F.col("size") < NOTICE, whole).otherwise(loose)).drop("qs", "island", "covered")


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of the scanned table."""
    base = F.col("verified") & F.col("base")
    labels = lambda where: F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")
    each = found.groupBy("doc_id", "digest", "n_words").agg(
        F.max(F.when(F.col("template").isNull(), F.col("rows"))).alias("twins"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("verified")).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    twins = F.explode(F.sequence(F.lit(1).cast("long"), F.col("twins")))
    return each.select("*", twins.alias("twin")).drop("twins", "twin", "digest")


def query(spark, sf_dir: str) -> DataFrame:
    """op11: all documents."""
    return summary(spans(scan(table(spark, sf_dir, "documents"))))


# runs are joined as words, not as hashes
SQL = f"""
with templates as (
    select t, label, base, string_split(x, ' ') as w from (values {", ".join(f"({t}, '{x.label}', {x.base}, '{' '.join(template_words(x.text))}')" for t, x in enumerate(TEMPLATES))}) v(t, label, base, x)
),
sized as (select *, len(w) as size, case when len(w) >= {NOTICE} then {K_NOTICE} else {K_PHRASE} end as k, case when len(w) >= {NOTICE} then floor(len(w) * {SLACK})::int else 0 end as slack from templates),
runs as (select t, label, base, size, k, slack, q - 1 as q, array_to_string(w[q : q + k - 1], ' ') as run from (select *, unnest(range(1, size - k + 2)) as q from sized)),
docs as (select row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
grams as (
    select id, p, k, array_to_string(w[p : p + k - 1], ' ') as run
    from (select id, w, k, unnest(range(1, len(w) - k + 2)) as p from docs, (values ({K_PHRASE}), ({K_NOTICE})) v(k))
),
votes as (select g.id, r.t, r.label, r.base, r.size, r.k, r.slack, r.q, g.p - 1 as p, g.p - 1 - r.q as diagonal from grams g join runs r on r.k = g.k and r.run = g.run),
lines as (
    select *, case when diagonal - lag(diagonal) over (partition by id, t order by diagonal) > slack then 1 else 0 end as fresh
    from (select distinct id, t, slack, diagonal from votes)
),
islands as (select *, sum(fresh) over (partition by id, t order by diagonal) as island from lines),
found as (
    select v.id, v.t, v.label, v.base, v.size, i.island, min(v.p) as start, max(v.p + v.k) as stop, len(list_distinct(flatten(list(range(v.q, v.q + v.k))))) as covered
    from votes v join islands i on i.id = v.id and i.t = v.t and i.diagonal = v.diagonal group by all
),
judged as (
    select *, covered / size as share, case when size < {NOTICE} then covered = size and stop - start = size else covered / size >= {LEAST_SHARE} and covered >= {LEAST_DENSITY} * (stop - start) end as verified
    from found
)
select any_value(d.doc_id) as doc_id, any_value(len(d.w)) as n_words, count(*) filter (j.verified and j.base) as n_base,
    min(j.start) filter (j.verified and j.base) as first_word, max(j.start) filter (j.verified and j.base) as last_word,
    coalesce(string_agg(distinct j.label, ',' order by j.label) filter (j.verified and j.base), '') as base_labels,
    coalesce(string_agg(distinct j.label, ',' order by j.label) filter (j.verified), '') as labels, coalesce(max(j.share), 0)::double as score
from docs d left join judged j on j.id = d.id group by d.id
"""
