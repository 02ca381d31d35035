"""Named queries over the tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims, schemas
from ..functions import rules, text
from ..operators import anchors, asking, chunking, partners, reports, sampling, similarity
from ..operators import items as ops
from ..session import shared_dir, stored
from ..sources import files
from ..streaming import verification
from . import jobs, requests
from .derived import QA_SQL, items, qa_rows, read


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SPACES_SQL = "concat(" + ",".join(f"chr({ord(c)})" for c in dims.SPACES) + ")"

# ---------------------------------------------------------------- chunks

_PIECES_SQL = rf"""
WITH d AS (SELECT doc_id, text, {_SPACES_SQL} AS ws FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, text, ws,
  list_filter(string_split_regex(text, '\n\n+'), lambda x: x<>'') AS p1,
  list_filter(string_split(regexp_replace(text, '([。．.!?！？]){_WS}', '\1' || chr(1), 'g'), chr(1)), lambda x: x<>'') AS p2,
  list_filter(string_split(text, chr(10)), lambda x: x<>'') AS p3,
  list_filter(string_split_regex(text, '{_WS}'), lambda x: x<>'') AS p4 FROM d WHERE length(text) > 800),
b AS (SELECT doc_id, ws, CASE WHEN list_max(list_transform(p1, lambda x: length(x))) < 800 THEN p1
  WHEN list_max(list_transform(p2, lambda x: length(x))) < 800 THEN p2 WHEN list_max(list_transform(p3, lambda x: length(x))) < 800 THEN p3
  WHEN list_max(list_transform(p4, lambda x: length(x))) < 800 THEN p4 ELSE regexp_extract_all(text, '(?s).') END AS parts FROM s),
m AS (SELECT doc_id, list_reduce(list_prepend({{'c': []::VARCHAR[], 'b': ''}}, list_transform(parts, lambda x: {{'c': []::VARCHAR[], 'b': x}})),
  lambda a, x: CASE WHEN length(a.b) + length(x.b) + 1 <= 800 THEN {{'c': a.c, 'b': CASE WHEN a.b='' THEN x.b ELSE trim(a.b || ' ' || x.b, ws) END}}
    ELSE {{'c': CASE WHEN a.b='' THEN a.c ELSE list_append(a.c, a.b) END,
           'b': CASE WHEN a.b='' AND len(a.c)=0 THEN x.b ELSE trim(right(CASE WHEN a.b='' THEN a.c[-1] ELSE a.b END, 100) || ' ' || x.b, ws) END}} END) AS r FROM b),
pieces AS (SELECT doc_id, CASE WHEN r.b='' THEN r.c ELSE list_append(r.c, r.b) END AS c FROM m
  UNION ALL SELECT doc_id, [text] FROM d WHERE length(text) <= 800 AND trim(text, ws) <> '')
"""


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(chunking.pieces(F.col("text"))).alias("position", "text"))


@query(_PIECES_SQL + "SELECT doc_id, (i-1)::INT AS position, doc_id || '__c' || lpad((i-1)::VARCHAR, 4, '0') AS chunk_id, length(c[i])::INT AS n_chars, md5(c[i]) AS text_md5 FROM (SELECT doc_id, c, unnest(range(1, len(c)+1)) AS i FROM pieces)")
def chunk_greedy(spark, sf_dir):
    chunk = text.chunk_id(F.col("doc_id"), F.col("position"))
    return _chunks(spark, sf_dir).select("doc_id", "position", chunk.alias("chunk_id"), F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(_PIECES_SQL + "SELECT doc_id, len(c)::BIGINT AS n_chunks, list_max(list_transform(c, lambda x: length(x)))::INT AS longest FROM pieces WHERE len(c) > 0")
def chunk_stats(spark, sf_dir):
    return _chunks(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.max(F.length("text")).alias("longest"))


_WINDOWS_SQL = "w AS (SELECT doc_id, i::INT AS position, substr(text, i*700+1, 800) AS text FROM (SELECT doc_id, text, unnest(range(0, greatest(1, ceil((length(text)-100)/700.0)::BIGINT))) AS i FROM documents WHERE length(text)>0))"


@query("WITH " + _WINDOWS_SQL + " SELECT doc_id, position, (row_number() OVER (PARTITION BY doc_id ORDER BY position)-1)::INT AS running, length(text)::INT AS n_chars FROM w")
def chunk_positions(spark, sf_dir):
    """The running position of each window in its document."""
    w = chunking.windows(read(spark, sf_dir, "documents")).withColumn("place", F.col("position"))
    return chunking.running(w, F.col("place")).select("doc_id", F.col("place").alias("position"), F.col("position").alias("running"), F.length("text").alias("n_chars"))


@query(r"""SELECT page_id, (i-1)::INT AS pos, regexp_extract(h[i], '<h([1-6])', 1)::INT AS level, regexp_replace(regexp_replace(h[i], '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g') AS title
FROM (SELECT page_id, h, unnest(range(1, len(h)+1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>') AS h FROM pages))""")
def section_paths(spark, sf_dir):
    """Headings of pages in order, with their level."""
    found = read(spark, sf_dir, "pages").select("page_id", F.posexplode(chunking.headings(F.col("html"))).alias("pos", "h"))
    return found.select("page_id", "pos", "h.level", "h.title")


_ASCII_REFS = (r"Version\s+\d+\.\d+", r"GPL-\d", r"BY(?:-[A-Z]{2})*\s+\d\.\d")
_REFS_RE = "|".join(f"(?:{p})" for p in (*dims.REFERENCES, *_ASCII_REFS)).replace(r"\d", "[0-9]").replace(r"\s", r"\s")


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '{_REFS_RE}'), lambda m: trim(regexp_replace(m, '\\s+', ' ', 'g'))))), '|') AS refs FROM documents WHERE len(regexp_extract_all(text, '{_REFS_RE}')) > 0")
def refs_extract(spark, sf_dir):
    refs = text.references(F.col("text"), _ASCII_REFS)
    return read(spark, sf_dir, "documents").select("doc_id", refs.alias("refs")).where(F.size("refs") > 0).select("doc_id", F.array_join(F.array_sort("refs"), "|").alias("refs"))


@query(f"SELECT doc_id, md5(regexp_replace(text, '{_WS}', '', 'g')) AS squeezed_md5 FROM documents WHERE text IS NOT NULL")
def norm_match(spark, sf_dir):
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.md5(text.squeeze(F.col("text")).cast("binary")).alias("squeezed_md5"))


@query(QA_SQL + "SELECT k, qa_id, regexp_replace(doc_id || '__c' || lpad((k%1000)::VARCHAR,4,'0'), '__c[0-9]+$', '') AS plain_id FROM qa")
def stable_id(spark, sf_dir):
    said = F.concat(F.col("doc_id").cast("string"), F.lit("__c"), F.lpad((F.col("k") % 1000).cast("string"), 4, "0"))
    return items(spark, sf_dir).select("k", "qa_id", text.plain_doc_id(said).alias("plain_id"))


@query(QA_SQL + "SELECT k, len(list_filter(list_distinct(regexp_extract_all(answer, '[A-Za-z]{8,}')), lambda p: NOT contains(question, p)))::INT AS n_new FROM qa")
def novel_terms(spark, sf_dir):
    """Long words of an answer that its question does not have."""
    return items(spark, sf_dir).select("k", F.size(text.unseen_terms(F.col("answer"), F.col("question"), "[A-Za-z]{8,}")).alias("n_new"))


_UNABLE_SQL = "coalesce(lower(translate(trim(t, {ws}), '{marks}', '')) IN ({words}), true)".format(
    ws=_SPACES_SQL, marks=dims.UNABLE_MARKS.replace("'", "''"), words=",".join(f"'{w}'" for w in ("", *dims.UNABLE))
)


@query(f"SELECT conv_id, turn, {_UNABLE_SQL} AS unable FROM (SELECT conv_id, turn, CASE WHEN turn%5=0 THEN ' 「不明」。' WHEN turn%5=1 THEN 'Not available.' ELSE text END AS t FROM conversations)")
def unable_answer(spark, sf_dir):
    said = F.when(F.col("turn") % 5 == 0, " 「不明」。").when(F.col("turn") % 5 == 1, "Not available.").otherwise(F.col("text"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", text.is_unable(said).alias("unable"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_extract_verdict(spark, sf_dir):
    """Fields of replies that come fenced, bare, or inside prose."""
    wrapped = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Sure.\n```json\n"), "props", F.lit("\n```\nDone."))).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit("Reply: "), "props", F.lit(" as asked"))).otherwise(F.col("props"))
    return read(spark, sf_dir, "events").select("event_id", text.parsed(wrapped, "k bigint")["k"].alias("k"))


# ---------------------------------------------------------------- aspects

def _compat(spark, sf_dir) -> DataFrame:
    pages = read(spark, sf_dir, "pages").where("html is not null").select("page_id", F.col("html").alias("text"))
    refs = text.references(F.col("text"), _ASCII_REFS)
    path = F.when(F.col("page_id") % 3 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    fits = rules.aspect_fits(F.col("text"), F.col("path"), F.col("refs"))
    return pages.withColumns({"refs": refs, "path": path}).select("page_id", *[v.alias(k) for k, v in fits.items()])


def _any_sql(column: str, markers) -> str:
    return "(" + " OR ".join("contains({}, '{}')".format(column, m.replace("'", "''")) for m in markers) + ")"


def _count_sql(pattern: str) -> str:
    return f"len(regexp_extract_all(t, '{pattern}'))"


_T, _FIG, _CMP = _any_sql("t", dims.TABLE_MARKERS), _any_sql("t", dims.FIGURE_HINTS), _any_sql("t", dims.COMPARISON_HINTS)
_CALC = f"({_count_sql(dims.NUMBER)} >= 2 AND {_CMP})"
_FIT_SQL = {
    "standards_reference": "len(list_filter(r, lambda x: regexp_matches(x, '^(?:JIS|ISO|IEC|ASME)'))) > 0",
    "quantitative_calc": _CALC, "negation": _any_sql("t", dims.NEGATION_HINTS), "causal": _any_sql("t", dims.CAUSAL_HINTS),
    "temporal": _any_sql("t", dims.TEMPORAL_HINTS), "comparison_conditional": _CMP, "numeric_inclusion": _CALC, "simple_table": _T,
    "complex_form": f"(contains(t,'rowspan') OR contains(t,'colspan') OR ({_T} AND (length(t)-length(replace(t, chr(10)||'|', '')))//2 >= 4))",
    "concept_diagram": f"({_any_sql('t', dims.DIAGRAM_HINTS)} OR {_FIG})", "flowchart": _any_sql("t", dims.FLOW_HINTS),
    "chart_graph": f"({_any_sql('t', dims.CHART_HINTS)} OR {_FIG})", "complex_layout": "page_id%3=0",
    "large_enumeration": f"{_count_sql('(?m)' + dims.LIST_LINE)} >= 5", "reference_follow": "len(r) > 0",
}
_ALL = [a for a, _, _ in dims.ASPECT_ROWS] + ["reference_follow"]
_COMPAT_SQL = f"WITH p AS (SELECT page_id, html AS t, regexp_extract_all(html, '{_REFS_RE}') AS r FROM pages WHERE html IS NOT NULL), f AS (SELECT page_id, " + ", ".join(f"{_FIT_SQL.get(a, 'true')} AS {a}" for a in _ALL) + " FROM p) "


@query(_COMPAT_SQL + "SELECT * FROM f")
def aspect_compat_matrix(spark, sf_dir):
    return _compat(spark, sf_dir)


@query(_COMPAT_SQL + "SELECT " + ", ".join(f"count(*) FILTER ({a})::BIGINT AS {a}" for a in _ALL) + " FROM f")
def compat_counts(spark, sf_dir):
    return _compat(spark, sf_dir).agg(*[F.count_if(F.col(a)).alias(a) for a in _ALL])


# ---------------------------------------------------------------- anchors

def _window_chunks(spark, sf_dir) -> DataFrame:
    w = chunking.windows(read(spark, sf_dir, "documents"))
    return w.select(
        text.chunk_id(F.col("doc_id"), F.col("position")).alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("doc_id") % 2 == 0, F.col("position") + 1).cast("int").alias("page"), F.col("position").alias("ord"), "position", "text",
    )


_CHUNK_SQL = _WINDOWS_SQL + ", c AS (SELECT doc_id || '__c' || lpad(position::VARCHAR, 4, '0') AS chunk_id, doc_id::VARCHAR AS doc_id, CASE WHEN doc_id%2=0 THEN position+1 END AS page, position AS ord, position, text FROM w)"


def _quotes(spark, sf_dir) -> DataFrame:
    """Two quotes for each item: its own, and one from further on in the document, said of a chunk id or of no page."""
    qa = items(spark, sf_dir)
    docs = read(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1501, 80).alias("late"))
    rows = qa.join(docs, "doc_id")
    doc = F.col("doc_id").cast("string")
    one = F.struct(F.lit(1).alias("quote_no"), doc.alias("doc_id"), F.lit(1).alias("page"), F.col("quote").alias("quote"))
    two = F.struct(
        F.lit(2).alias("quote_no"), F.when(F.col("k") % 3 == 0, F.concat(doc, F.lit("__c0001"))).when(F.col("k") % 3 == 1, doc).otherwise(F.lit("nowhere")).alias("doc_id"),
        F.when(F.col("k") % 4 == 0, 2).alias("page"), F.coalesce("late", F.lit("")).alias("quote"),
    )
    return rows.select("k", F.explode(F.array(one, two)).alias("q")).select(F.col("k").alias("qa_id"), "q.quote_no", "q.doc_id", "q.page", "q.quote")


_QUOTE_SQL = """, quotes AS (SELECT k AS qa_id, 1 AS quote_no, doc_id::VARCHAR AS doc_id, 1 AS page, quote FROM qa
 UNION ALL SELECT k, 2, CASE WHEN k%3=0 THEN doc_id || '__c0001' WHEN k%3=1 THEN doc_id::VARCHAR ELSE 'nowhere' END, CASE WHEN k%4=0 THEN 2 END, substr(d.text,1501,80) FROM qa JOIN documents d USING (doc_id))"""


def _sq(column: str) -> str:
    return f"regexp_replace({column}, '{_WS}', '', 'g')"


_ANCHOR_SQL = QA_SQL + ", " + _CHUNK_SQL + _QUOTE_SQL + f""", q AS (SELECT *, regexp_replace(doc_id,'__c[0-9]+$','') AS base, {_sq('quote')} AS needle FROM quotes),
cand AS (SELECT q.qa_id, q.quote_no, q.needle, 1 AS prio, c.* FROM q JOIN c ON c.doc_id=q.doc_id AND c.page IS NOT DISTINCT FROM q.page
 UNION ALL SELECT q.qa_id, q.quote_no, q.needle, 2, c.* FROM q JOIN c ON c.doc_id=q.base AND c.page IS NOT DISTINCT FROM q.page
 UNION ALL SELECT q.qa_id, q.quote_no, q.needle, 3, c.* FROM q JOIN c ON c.chunk_id=q.doc_id
 UNION ALL SELECT q.qa_id, q.quote_no, q.needle, 4, c.* FROM q JOIN c ON c.doc_id=q.base),
anchors AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY qa_id, quote_no ORDER BY prio, NOT (needle<>'' AND contains({_sq('text')}, needle)), ord)=1)
"""


@query(_ANCHOR_SQL + "SELECT qa_id, quote_no, chunk_id, coalesce(page,0)::INT AS page FROM anchors")
def anchor_resolve(spark, sf_dir):
    return ops.resolve_anchors(_quotes(spark, sf_dir), _window_chunks(spark, sf_dir)).select("qa_id", "quote_no", "chunk_id", F.coalesce("page", F.lit(0)).alias("page"))


@query(_ANCHOR_SQL + f""", u AS (SELECT qa_id, chunk_id, min(quote_no) AS quote_no, any_value(text) AS text FROM anchors GROUP BY ALL), b AS (SELECT qa_id, string_agg({_sq('text')}, '' ORDER BY quote_no, text) AS blob FROM u GROUP BY qa_id)
SELECT qa_id, round(avg(CASE WHEN needle<>'' AND contains(blob, needle) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS rationale_grounded FROM q LEFT JOIN b USING (qa_id) GROUP BY qa_id""".replace("GROUP BY ALL", "GROUP BY qa_id, chunk_id"))
def grounding_ratio(spark, sf_dir):
    quotes = _quotes(spark, sf_dir)
    got = ops.grounding(quotes, ops.resolve_anchors(quotes, _window_chunks(spark, sf_dir)))
    return got.select("qa_id", F.round("rationale_grounded", 6).alias("rationale_grounded"))


def _escape_sql(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(_ANCHOR_SQL + f""", h AS (SELECT qa_id, quote_no, text, needle, CASE WHEN length(needle) >= 4 THEN strpos({_sq('text')}, needle) ELSE 0 END AS a FROM anchors),
p AS (SELECT *, list_filter(range(1, length(text)+1), lambda i: NOT regexp_matches(substr(text, i, 1), '{_WS}')) AS places FROM h),
m AS (SELECT *, CASE WHEN a > 0 THEN places[a] ELSE 0 END AS s, CASE WHEN a > 0 THEN places[a+length(needle)-1] ELSE 0 END AS e FROM p)
SELECT qa_id, quote_no, s::INT AS hit_from, e::INT AS hit_to, md5(CASE WHEN s = 0 THEN {_escape_sql('text')} ELSE {_escape_sql('substr(text, 1, s-1)')} || '<mark>' || {_escape_sql('substr(text, s, e-s+1)')} || '</mark>' || {_escape_sql('substr(text, e+1)')} END) AS html_md5 FROM m""")
def marked_quotes(spark, sf_dir):
    """The chunk that each quote rests on, as HTML with the quote marked."""
    quotes = _quotes(spark, sf_dir)
    rows = ops.resolve_anchors(quotes, _window_chunks(spark, sf_dir)).join(quotes.select("qa_id", "quote_no", "quote"), ["qa_id", "quote_no"])
    hit = text.span_of(F.col("text"), F.col("quote"))
    return rows.select("qa_id", "quote_no", hit["start"].alias("hit_from"), hit["end"].alias("hit_to"), F.md5(text.highlighted(F.col("text"), F.col("quote")).cast("binary")).alias("html_md5"))


@query("WITH " + _CHUNK_SQL + """, n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id) SELECT doc_id, count(*)::BIGINT AS n_chunks, max(position)-min(position) >= 3 AS has_remote FROM c GROUP BY doc_id""")
def remote_eligible(spark, sf_dir):
    """Documents whose chunks reach far enough apart for a remote pair."""
    c = _window_chunks(spark, sf_dir)
    return c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"), (F.max("position") - F.min("position") >= 3).alias("has_remote"))


@query("WITH " + _CHUNK_SQL + """, n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
r AS (SELECT doc_id, position, greatest(position-2,0) AS b, greatest(n-position-3,0) AS a, ('0x' || substr(md5('42:' || doc_id || ':' || position),1,8))::BIGINT AS h FROM c JOIN n USING (doc_id))
SELECT doc_id, position, (CASE WHEN h%(a+b) < b THEN h%(a+b) ELSE position+3+h%(a+b)-b END)::INT AS partner FROM r WHERE a+b > 0""")
def remote_pairs(spark, sf_dir):
    """One partner for each chunk, three or more places off in its document."""
    return ops.remote_partners(_window_chunks(spark, sf_dir))


_REF_CHUNKS_SQL = f"WITH {_CHUNK_SQL}, h AS (SELECT DISTINCT chunk_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '{_REFS_RE}'), lambda m: trim(regexp_replace(m, '\\s+', ' ', 'g'))))) AS ref FROM c)"


@query(_REF_CHUNKS_SQL + ", u AS (SELECT DISTINCT ref FROM h), g AS (SELECT h.chunk_id, u.ref FROM h JOIN u ON contains(h.ref, u.ref)), f AS (SELECT ref, min(chunk_id) AS first FROM g GROUP BY ref), s AS (SELECT g.ref, first, min(chunk_id) AS second FROM g JOIN f ON f.ref=g.ref AND g.chunk_id<>f.first GROUP BY g.ref, first) SELECT h.chunk_id, h.ref, CASE WHEN h.chunk_id=first THEN second ELSE first END AS target FROM h JOIN s USING (ref)")
def ref_follow_pairs(spark, sf_dir):
    chunks = _window_chunks(spark, sf_dir).select("chunk_id", text.references(F.col("text"), _ASCII_REFS).alias("refs"))
    return ops.followed_references(chunks)


def _sectioned(spark, sf_dir) -> DataFrame:
    """Chunks in sections named after the kind of their text's first letter; a third of them has no section."""
    first = F.ascii("text") % 3
    return _window_chunks(spark, sf_dir).withColumn("section_path", F.when(first > 0, F.array(F.concat(F.lit("part "), first.cast("string")), F.lit("x"))))


@query("WITH " + _CHUNK_SQL + """, s AS (SELECT doc_id, position, chunk_id, ascii(text)%3 AS top FROM c),
near AS (SELECT a.doc_id, a.position, b.position AS partner, a.top<>b.top AS other FROM s a JOIN s b ON a.doc_id=b.doc_id AND abs(a.position-b.position)>=3),
best AS (SELECT *, max(other) OVER (PARTITION BY doc_id, position) AS any_other FROM near),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, position ORDER BY partner)-1 AS r, count(*) OVER (PARTITION BY doc_id, position) AS n FROM best WHERE other = any_other)
SELECT doc_id, position, partner, other AS other_section FROM ranked WHERE r = ('0x' || substr(md5('42:' || doc_id || ':' || position),1,8))::BIGINT % n""")
def remote_other_section(spark, sf_dir):
    """One partner for each chunk, three or more places off in its document, of another section where there is one."""
    return partners.remote_by_section(_sectioned(spark, sf_dir))


@query(_REF_CHUNKS_SQL + f""", u AS (SELECT DISTINCT ref FROM h), g AS (SELECT DISTINCT h.chunk_id, u.ref FROM h JOIN u ON contains(h.ref, u.ref)),
ring AS (SELECT ref, chunk_id, row_number() OVER (PARTITION BY ref ORDER BY md5('42:' || ref || ':' || chunk_id), chunk_id)-1 AS r, count(*) OVER (PARTITION BY ref) AS holders FROM g),
asks AS (SELECT h.chunk_id, h.ref, holders, (r + 1 + ('0x' || substr(md5('42:step:' || h.ref || ':' || h.chunk_id),1,8))::BIGINT % (holders-1)) % holders AS r FROM h JOIN ring USING (ref, chunk_id) WHERE holders > 1)
SELECT a.chunk_id, a.ref, regexp_matches(a.ref, '{dims.SPECIFIC_REFERENCE}') AS specific, a.holders, ring.chunk_id AS target FROM asks a JOIN ring ON ring.ref=a.ref AND ring.r=a.r""")
def reference_partners(spark, sf_dir):
    """One of all other holders for each reference of each chunk."""
    chunks = _window_chunks(spark, sf_dir).select("chunk_id", text.references(F.col("text"), _ASCII_REFS).alias("refs"))
    return partners.reference_partners(chunks)


_FITS_SQL = "CASE aspect " + " ".join(f"WHEN '{a}' THEN {c.replace('page_id%3=0', 'top > 0')}" for a, c in _FIT_SQL.items() if a != "reference_follow") + " ELSE true END"
_JOINT_SQL = "(" + ",".join(f"'{a}'" for a in anchors.STRATEGIES) + ")"


@query(QA_SQL + ", " + _CHUNK_SQL + f""", ch AS (SELECT *, text AS t, ascii(text)%3 AS top, list_distinct(list_transform(regexp_extract_all(text, '{_REFS_RE}'), lambda m: trim(regexp_replace(m, '\\s+', ' ', 'g')))) AS r FROM c),
rq AS (SELECT k AS request_id, aspect, row_number() OVER (PARTITION BY aspect ORDER BY k)-1 AS i, count(*) OVER (PARTITION BY aspect) AS cnt FROM qa),
fit AS (SELECT chunk_id, aspect, {_FITS_SQL} AS fits FROM ch CROSS JOIN (SELECT DISTINCT aspect FROM rq)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY aspect ORDER BY fits DESC, md5('42:' || aspect || ':' || chunk_id), chunk_id) AS n FROM fit),
top AS (SELECT *, count(*) OVER (PARTITION BY aspect, fits) AS of, bool_or(fits) OVER (PARTITION BY aspect) AS any_fits FROM ranked WHERE n <= (SELECT max(cnt) FROM rq) + {anchors.ATTEMPTS}),
best AS (SELECT * FROM top WHERE fits = any_fits),
tries AS (SELECT request_id, rq.aspect, attempt, chunk_id, fits FROM (SELECT *, unnest(range(0, CASE WHEN aspect IN {_JOINT_SQL} THEN {anchors.ATTEMPTS} ELSE 1 END)) AS attempt FROM rq) rq JOIN best ON best.aspect=rq.aspect AND n = (i + attempt) % of + 1),
near AS (SELECT a.chunk_id, b.chunk_id AS partner, a.doc_id, a.position, b.position AS place, a.top<>b.top AS other FROM ch a JOIN ch b ON a.doc_id=b.doc_id AND abs(a.position-b.position)>=3),
pool AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY place)-1 AS r, count(*) OVER (PARTITION BY chunk_id) AS n FROM (SELECT *, max(other) OVER (PARTITION BY chunk_id) AS any_other FROM near) WHERE other = any_other),
remote AS (SELECT chunk_id, partner FROM pool WHERE r = ('0x' || substr(md5('42:' || doc_id || ':' || position),1,8))::BIGINT % n),
h AS (SELECT DISTINCT chunk_id, unnest(r) AS ref FROM ch), u AS (SELECT DISTINCT ref FROM h), g AS (SELECT DISTINCT h.chunk_id, u.ref FROM h JOIN u ON contains(h.ref, u.ref)),
ring AS (SELECT ref, chunk_id, row_number() OVER (PARTITION BY ref ORDER BY md5('42:' || ref || ':' || chunk_id), chunk_id)-1 AS r, count(*) OVER (PARTITION BY ref) AS holders FROM g),
asks AS (SELECT h.chunk_id, h.ref, (r + 1 + ('0x' || substr(md5('42:step:' || h.ref || ':' || h.chunk_id),1,8))::BIGINT % (holders-1)) % holders AS r FROM h JOIN ring USING (ref, chunk_id) WHERE holders > 1),
followed AS (SELECT a.chunk_id, ring.chunk_id AS partner FROM asks a JOIN ring ON ring.ref=a.ref AND ring.r=a.r QUALIFY row_number() OVER (PARTITION BY a.chunk_id ORDER BY NOT regexp_matches(a.ref, '{dims.SPECIFIC_REFERENCE}'), md5(a.ref || ':' || a.chunk_id))=1),
met AS (SELECT t.*, CASE WHEN aspect='remote_reference' THEN remote.partner WHEN aspect='standards_reference' THEN followed.partner END AS partner FROM tries t LEFT JOIN remote USING (chunk_id) LEFT JOIN followed USING (chunk_id))
SELECT request_id, aspect, chunk_id || coalesce('+' || partner, '') AS anchors, CASE WHEN aspect IN {_JOINT_SQL} AND partner IS NULL THEN 'partner' WHEN NOT fits THEN 'compat' END AS miss
FROM met QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY partner IS NULL, attempt)=1""")
def anchor_requests(spark, sf_dir):
    """Anchors for a request of each item's aspect: alone, with a remote partner, or with one that holds a reference; there are no vectors, so what needs near chunks is a miss."""
    chunks = _sectioned(spark, sf_dir).withColumn("references", text.references(F.col("text"), _ASCII_REFS))
    wanted = items(spark, sf_dir).select(F.col("k").alias("request_id"), "aspect")
    sets = anchors.anchor_sets(wanted, chunks)
    return sets.select("request_id", "aspect", F.array_join(F.transform("anchors", lambda c: c["chunk_id"]), "+").alias("anchors"), "miss")


# ---------------------------------------------------------------- vectors

def _vectors(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


_V_SQL = "WITH e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings), "
_SIM = "list_dot_product(a.v, b.v)/(a.n*b.n)"


@query(_V_SQL + f"s AS (SELECT a.id AS query, b.id AS id, {_SIM} AS sim FROM e a JOIN e b ON a.id<>b.id WHERE a.id%20=0) SELECT query, id, round(sim,6) AS sim, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(sim,9) DESC, id) AS rank FROM s) WHERE rank<=5")
def retrieval_topk(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return similarity.nearest(v, v.where("id % 20 = 0"), 5).select("query", "id", F.round("sim", 6).alias("sim"), "rank")


@query(_V_SQL + f"s AS (SELECT a.id AS query, a.label AS ql, b.id AS id, b.label AS l, {_SIM} AS sim FROM e a JOIN e b ON a.id<>b.id WHERE a.id%20=0), t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(sim,9) DESC, id) AS rank FROM s) SELECT query, count(*) FILTER (l=ql)::BIGINT AS same_label, max(l=ql) AS hit_doc FROM t WHERE rank<=5 GROUP BY query")
def retrieval_hits(spark, sf_dir):
    """Whether a query finds its own label (as its document) among the five nearest."""
    v = _vectors(spark, sf_dir)
    got = similarity.nearest(v, v.where("id % 20 = 0"), 5).join(v.select(F.col("id").alias("query"), F.col("label").alias("own")), "query")
    return got.groupBy("query").agg(F.count_if(F.col("label") == F.col("own")).alias("same_label"), F.max(F.col("label") == F.col("own")).alias("hit_doc"))


@query(_V_SQL + f"s AS (SELECT a.id AS id, max({_SIM}) AS sim FROM e a JOIN e b ON a.id<>b.id GROUP BY a.id) SELECT id, round(1-greatest(sim,0),6) AS uniqueness FROM s")
def uniqueness_scores(spark, sf_dir):
    return similarity.uniqueness(_vectors(spark, sf_dir)).select("id", F.round("uniqueness", 6).alias("uniqueness"))


@query(_V_SQL + f"s AS (SELECT a.id AS id, max({_SIM}) AS sim FROM e a JOIN e b ON a.id<>b.id GROUP BY a.id) SELECT id FROM s WHERE round(1-greatest(sim,0),6) >= round(1.0-0.92,6)")
def duplicate_drop(spark, sf_dir):
    """Items that the uniqueness gate keeps; all members of a duplicate pair go."""
    return similarity.uniqueness(_vectors(spark, sf_dir)).where(F.round("uniqueness", 6) >= round(1 - dims.UNIQUENESS_MOST, 6)).select("id")


@query(_V_SQL + f"s AS (SELECT a.id AS query, b.id AS id, {_SIM} AS sim FROM e a JOIN e b ON a.id<>b.id AND a.label<>b.label WHERE {_SIM} >= 0.1) SELECT query, id, round(sim,6) AS sim FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(sim,9) DESC, id)=1")
def neighbour_pairs_distinct(spark, sf_dir):
    """For every vector the nearest one of another label, if it is near enough."""
    v = _vectors(spark, sf_dir).where(F.size("vec") > 0)
    return similarity.nearest(v, v, 1, least=0.1, same=True).select("query", "id", F.round("sim", 6).alias("sim"))


# ---------------------------------------------------------------- difficulty

def _sets(spark, sf_dir) -> DataFrame:
    """Anchor sets: three chunk places for each item, some in other documents."""
    k = F.col("k")
    places = F.array(
        F.struct(F.col("doc_id").alias("d"), F.lit(0).alias("p")),
        F.struct((F.col("doc_id") + F.when(k % 3 == 0, 1).otherwise(0)).alias("d"), (k % 13).cast("int").alias("p")),
    )
    sets = items(spark, sf_dir).select("k", F.explode(F.array_distinct(places)).alias("a"), (F.pmod(k, F.lit(4)) * 500).alias("longest"))
    per_doc = sets.groupBy("k", "a.d").agg(F.count(F.lit(1)).alias("n"), (F.max("a.p") - F.min("a.p")).alias("gap"), F.max("longest").alias("longest"))
    return per_doc.groupBy("k").agg(F.sum("n").alias("n_chunks"), F.count(F.lit(1)).alias("n_docs"), F.max("gap").alias("gap"), F.max("longest").alias("longest"))


_SETS_SQL = QA_SQL + """, a AS (SELECT DISTINCT k, d, p, (k%4)*500 AS longest FROM (SELECT k, doc_id AS d, 0 AS p FROM qa UNION ALL SELECT k, doc_id + CASE WHEN k%3=0 THEN 1 ELSE 0 END, (k%13)::INT FROM qa)),
pd AS (SELECT k, d, count(*) AS n, max(p)-min(p) AS gap, max(longest) AS longest FROM a GROUP BY k, d),
st AS (SELECT k, sum(n) AS n_chunks, count(*) AS n_docs, max(gap) AS gap, max(longest) AS longest FROM pd GROUP BY k) """


@query(_SETS_SQL + "SELECT k, CASE WHEN n_chunks<=1 THEN 'Easy' WHEN n_docs>=2 OR gap>=10 THEN 'Hard' ELSE 'Medium' END AS retrieval_level FROM st")
def retrieval_level(spark, sf_dir):
    return _sets(spark, sf_dir).select("k", rules.retrieval_level(F.col("n_chunks"), F.col("n_docs"), F.col("gap")).alias("retrieval_level"))


@query(_SETS_SQL + "SELECT k, n_docs>=2 AS multi_doc, n_chunks>=2 AS multi_chunk, gap>=3 AS low_locality, gap>=10 AS remote_reference, longest>=1200 AS chunk_size_large FROM st")
def retrieval_flags(spark, sf_dir):
    flags = rules.retrieval_flags(F.col("n_chunks"), F.col("n_docs"), F.col("gap"), F.col("longest"))
    return _sets(spark, sf_dir).select("k", *[v.alias(n) for n, v in flags.items()])


@query(QA_SQL + "SELECT k, difficulty_match FROM qa")
def difficulty_match(spark, sf_dir):
    return items(spark, sf_dir).select("k", "difficulty_match")


# ---------------------------------------------------------------- gates

_REASONS_SQL = """list_filter([CASE WHEN answerability<4 THEN 'answerability' END, CASE WHEN leakage='fail' THEN 'leakage' END, CASE WHEN grounding<4 THEN 'grounding' END,
 CASE WHEN uniqueness<1.0::DOUBLE-0.92::DOUBLE THEN 'uniqueness' END, CASE WHEN rationale_grounded<0.5 THEN 'rationale_grounded' END{more}], lambda x: x IS NOT NULL)"""


@query(QA_SQL + f"SELECT qa_id, k FROM qa WHERE len({_REASONS_SQL.format(more='')})=0")
def quality_gate(spark, sf_dir):
    return items(spark, sf_dir).where(F.size(rules.reject_reasons()) == 0).select("qa_id", "k")


@query(QA_SQL + f"SELECT reason, count(*)::BIGINT AS n FROM (SELECT unnest({_REASONS_SQL.format(more='')}) AS reason FROM qa) WHERE reason <> 'rationale_grounded' GROUP BY reason")
def gate_reasons(spark, sf_dir):
    """Rejections by reason; the share of grounded rationales is a gate, but not in this report."""
    return items(spark, sf_dir).select(F.explode(rules.reject_reasons()).alias("reason")).where("reason <> 'rationale_grounded'").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_RAG = ", CASE WHEN difficulty_match='too_easy' THEN 'difficulty_match' END, CASE WHEN (SELECT count(answer_match)>0 FROM qa) AND answer_match<>'match' THEN 'rag_no_match' END, CASE WHEN (SELECT count(answer_match)>0 FROM qa) AND answer_match IS NOT NULL AND NOT retrieval_hit_chunk AND NOT (NOT retrieval_hit_doc AND NOT retrieval_hit_chunk AND retrieval_hit) THEN 'not_retrieved' END"


@query(QA_SQL + f"SELECT k, array_to_string({_REASONS_SQL.format(more=_RAG)}, ',') AS reasons FROM qa")
def rag_conditions(spark, sf_dir):
    """Conditions on retrieval are void where no item has been verified."""
    qa = items(spark, sf_dir)
    some = qa.agg((F.count("answer_match") > 0).alias("some"))
    reasons = rules.reject_reasons(reject_too_easy=True, rag_hit=True, rationale_retrieved=True, verified=F.col("some"))
    return qa.crossJoin(F.broadcast(some)).select("k", F.array_join(reasons, ",").alias("reasons"))  # one row


# ---------------------------------------------------------------- reports

def _domain_sql(name: str, values) -> str:
    return f"(SELECT unnest({list(values)!r}) AS {name}, unnest(range(0,{len(values)})) AS ord)"


@query(QA_SQL + f"SELECT d.level, d.ord::INT AS ord, count(qa.k)::BIGINT AS n, round(count(qa.k)/(SELECT greatest(count(*),1) FROM qa)::DOUBLE,6) AS ratio FROM {_domain_sql('level', dims.LEVELS)} d LEFT JOIN qa ON qa.retrieval_level=d.level GROUP BY d.level, d.ord")
def level_distribution(spark, sf_dir):
    return ops.distribution(items(spark, sf_dir), "retrieval_level", dims.domain(spark, "level", dims.LEVELS), "level")


@query(QA_SQL + "".join(f"{'' if not i else ' UNION ALL '}SELECT '{kind}' AS kind, '{lv}' AS level, round(count(*) FILTER ({kind}='{lv}')/greatest(count(*),1)::DOUBLE - {t},6) AS gap FROM qa" for i, (kind, lv, t) in enumerate((kind, lv, t) for kind, ts in (("retrieval_level", dims.TARGET_RETRIEVAL), ("answer_level", dims.TARGET_ANSWER)) for lv, t in ts.items())))
def target_gap(spark, sf_dir):
    """How far the shares of the levels are from their targets."""
    return reports.target_gaps(items(spark, sf_dir))


@query(QA_SQL + "SELECT count(*) FILTER (category='Abstention')::BIGINT AS n, round(count(*) FILTER (category='Abstention')/greatest(count(*),1)::DOUBLE,6) AS ratio, CASE WHEN count(*) FILTER (category='Abstention')/greatest(count(*),1)::DOUBLE < 0.1 THEN 'short' WHEN count(*) FILTER (category='Abstention')/greatest(count(*),1)::DOUBLE > 0.15 THEN 'over' ELSE 'ok' END AS status FROM qa")
def abstention_share(spark, sf_dir):
    return reports.abstention(items(spark, sf_dir))


_CROSS_SQL = QA_SQL + f", x AS (SELECT c.category, d.retrieval_level, count(qa.k)::BIGINT AS n FROM {_domain_sql('category', dims.CATEGORIES)} c CROSS JOIN {_domain_sql('retrieval_level', dims.LEVELS)} d LEFT JOIN qa ON qa.category=c.category AND qa.retrieval_level=d.retrieval_level GROUP BY c.category, d.retrieval_level) "


def _cross(spark, sf_dir):
    return ops.crosstab(items(spark, sf_dir), ("category", dims.domain(spark, "category", dims.CATEGORIES)), ("retrieval_level", dims.domain(spark, "retrieval_level", dims.LEVELS)))


@query(_CROSS_SQL + "SELECT * FROM x")
def crosstab_zero_filled(spark, sf_dir):
    return _cross(spark, sf_dir)


@query(_CROSS_SQL + "SELECT category, retrieval_level FROM x WHERE n=0")
def uncovered_cells(spark, sf_dir):
    return _cross(spark, sf_dir).where("n = 0").drop("n")


@query(QA_SQL + f"SELECT d.aspect, d.category, count(qa.k)::BIGINT AS n, CASE WHEN count(qa.k)>=3 THEN 'reached' WHEN count(qa.k)>0 THEN 'some' ELSE 'none' END AS status FROM (SELECT unnest({[a for a, _, _ in dims.ASPECT_ROWS]!r}) AS aspect, unnest({[c for _, c, _ in dims.ASPECT_ROWS]!r}) AS category) d LEFT JOIN qa ON qa.aspect=d.aspect GROUP BY d.aspect, d.category")
def aspect_coverage(spark, sf_dir):
    return reports.aspect_coverage(items(spark, sf_dir))


@query(QA_SQL + "SELECT aspect, count(*)::BIGINT AS n, count(*) FILTER (answer_match='match')::BIGINT AS match, count(*) FILTER (answer_match='partial')::BIGINT AS partial, count(*) FILTER (answer_match='no_match')::BIGINT AS no_match, round(count(*) FILTER (answer_match='no_match')/count(*)::DOUBLE,6) AS no_match_rate FROM qa WHERE answer_match IS NOT NULL GROUP BY aspect")
def aspect_verdicts(spark, sf_dir):
    return reports.verdicts_by_aspect(items(spark, sf_dir))


@query("WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT coalesce(least(9, floor((value-lo)/nullif(hi-lo, 0)*10)), 0)::INT AS bin, value >= 10 AS passed FROM events, r WHERE value IS NOT NULL) SELECT bin, passed, count(*)::BIGINT AS n FROM b GROUP BY bin, passed")
def score_histogram(spark, sf_dir):
    """Ten equal bins between the least and the largest score, split by a threshold; the first one where all scores are equal."""
    return reports.histogram(read(spark, sf_dir, "events"), "value", 10)


_KPI = {
    "scored": "answerability IS NOT NULL", "pending": "review_status='pending'", "accepted": "review_status='accepted'", "rejected": "review_status='rejected'",
    "verified": "answer_match IS NOT NULL", "rag_pass": "answer_match='match'", "cleared": "answerability >= 4 AND leakage IS DISTINCT FROM 'fail'",
}


@query(QA_SQL + "SELECT count(*)::BIGINT AS total, count(DISTINCT doc_id)::BIGINT AS n_docs, " + ", ".join(f"count(*) FILTER ({c})::BIGINT AS {n}" for n, c in _KPI.items()) + " FROM qa")
def kpi_row(spark, sf_dir):
    return reports.kpis(items(spark, sf_dir))


@query(QA_SQL + "SELECT doc_id, count(*)::BIGINT AS n FROM qa GROUP BY doc_id")
def doc_counts(spark, sf_dir):
    return items(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query(QA_SQL + f"SELECT d.review_status, d.ord::INT AS ord, count(qa.k)::BIGINT AS n, round(count(qa.k)/(SELECT greatest(count(*),1) FROM qa)::DOUBLE,6) AS ratio FROM {_domain_sql('review_status', dims.REVIEW_STATUS)} d LEFT JOIN qa USING (review_status) GROUP BY d.review_status, d.ord")
def status_counts(spark, sf_dir):
    return ops.distribution(items(spark, sf_dir), "review_status", dims.domain(spark, "review_status", dims.REVIEW_STATUS), "review_status")


@query(QA_SQL + f"SELECT a.kg_query_type, b.kg_novelty, count(qa.k)::BIGINT AS n, count(qa.k) FILTER (llm_knowledge='unknown')::BIGINT AS unknown FROM {_domain_sql('kg_query_type', dims.KG_QUERY_TYPES)} a CROSS JOIN {_domain_sql('kg_novelty', dims.KG_NOVELTY)} b LEFT JOIN qa ON qa.kg_query_type=a.kg_query_type AND qa.kg_novelty=b.kg_novelty GROUP BY a.kg_query_type, b.kg_novelty")
def kg_matrix(spark, sf_dir):
    return reports.knowledge_matrix(items(spark, sf_dir))


@query(QA_SQL + "SELECT k, qa_id, doc_id FROM qa WHERE (answerability IS NULL OR answerability>=4) AND answer_match='no_match'")
def kg_candidates(spark, sf_dir):
    return reports.candidates(items(spark, sf_dir)).select("k", "qa_id", "doc_id")


@query(QA_SQL + "SELECT qa_id, doc_id, category AS category_primary, aspect AS aspect_primary, track, CASE WHEN answer_match IS NULL THEN '-' ELSE answer_match END AS verdict, retrieval_level || ' / ' || answer_level AS difficulty, 1::INT AS n_rationale FROM qa")
def qa_flat(spark, sf_dir):
    return schemas.flat(qa_rows(spark, sf_dir)).select("qa_id", F.col("doc_id").cast("long").alias("doc_id"), "category_primary", "aspect_primary", "track", F.coalesce("rag_answer_match", F.lit("-")).alias("verdict"), F.format_string("%s / %s", "retrieval_level", "answer_level").alias("difficulty"), F.col("n_rationale").cast("int").alias("n_rationale"))


@query(QA_SQL + f"SELECT k, kg_query_type, kg_novelty, CASE WHEN kg_query_type='single_fact' THEN 'quantitative_calc' WHEN kg_query_type IN ('multi_hop','traceability') OR kg_novelty IN ('unknown_relation','procedural_relation') THEN 'reference_follow' WHEN kg_query_type='aggregation' THEN 'multi_source_integration' ELSE 'reference_follow' END AS aspect FROM qa WHERE track='kg_poc'")
def kg_strategy(spark, sf_dir):
    qa = items(spark, sf_dir).where("track = 'kg_poc'")
    return qa.select("k", "kg_query_type", "kg_novelty", rules.kg_aspect(F.col("kg_query_type"), F.col("kg_novelty")).alias("aspect"))


@query("SELECT user_id, event_id, event_type AS status FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)=1")
def latest_review(spark, sf_dir):
    """The last decision on each item, from a log of decisions."""
    last = ops.latest(read(spark, sf_dir, "events"), "user_id", [F.desc("ts"), F.desc("event_id")])
    return last.select("user_id", "event_id", F.col("event_type").alias("status"))


@query("WITH " + _CHUNK_SQL + " SELECT doc_id, position, cum::BIGINT AS cum FROM (SELECT doc_id, position, sum(length(text)) OVER (PARTITION BY doc_id ORDER BY position) AS cum FROM c) WHERE cum <= 12000")
def sample_prefix(spark, sf_dir):
    """The chunks of each document that fit a prompt of 12,000 characters, in order; the first overflow ends it."""
    c = _window_chunks(spark, sf_dir).select("doc_id", "position", "text")
    return sampling.prefix(c, F.length("text"), 12_000, ["position"], ("doc_id",)).select("doc_id", "position", "cum")


_CELLS_SQL = f"cells AS (SELECT a.kg_query_type, b.kg_novelty FROM {_domain_sql('kg_query_type', dims.KG_QUERY_TYPES)} a CROSS JOIN {_domain_sql('kg_novelty', dims.KG_NOVELTY)} b)"
_COPIES_SQL = "SELECT kg_query_type, kg_novelty, copy, md5('42:' || kg_query_type || ':' || kg_novelty || ':' || copy) AS draw FROM (SELECT *, unnest(range(0, copies))::INT AS copy FROM n)"


@query(QA_SQL + f", {_CELLS_SQL}, t AS (SELECT *, row_number() OVER (ORDER BY md5('42:rest:' || kg_query_type || ':' || kg_novelty)) AS turn, (SELECT count(*) FROM qa WHERE track='kg_poc') AS wanted FROM cells), n AS (SELECT *, wanted//15 + CASE WHEN turn <= wanted%15 THEN 1 ELSE 0 END AS copies FROM t) " + _COPIES_SQL)
def kg_cell_queue(spark, sf_dir):
    """As many requests as there are items of the track, split equally over the cells, with the order in which they are taken."""
    total = items(spark, sf_dir).where("track = 'kg_poc'").agg(F.count(F.lit(1)).alias("n"))
    return requests.split_cells(total)


@query(QA_SQL + ", n AS (SELECT kg_query_type, kg_novelty, count(*) AS copies FROM qa WHERE track='kg_poc' AND answer_match='no_match' GROUP BY kg_query_type, kg_novelty) " + _COPIES_SQL)
def kg_mix_queue(spark, sf_dir):
    """A mix of cells: a request for each item of the track that was not answered."""
    failed = items(spark, sf_dir).where("track = 'kg_poc' and answer_match = 'no_match'")
    return requests.copies_of(failed.groupBy("kg_query_type", "kg_novelty").agg(F.count(F.lit(1)).alias("copies")))


@query(QA_SQL + f"SELECT count(*)::BIGINT AS total, count(*) FILTER (n=0)::BIGINT AS kept, count(*) FILTER (n>0)::BIGINT AS dropped, round(count(*) FILTER (n=0)/greatest(count(*),1)::DOUBLE, 6) AS ratio FROM (SELECT len({_REASONS_SQL.format(more='')}) AS n FROM qa)")
def gate_counts(spark, sf_dir):
    return reports.gate_counts(items(spark, sf_dir).select(rules.reject_reasons().alias("reasons")))


_CLEARED_SQL = "answerability >= 4 AND leakage IS DISTINCT FROM 'fail'"


@query(QA_SQL + f"""SELECT count(*)::BIGINT AS total, CASE WHEN count(*)<30 THEN 'short' WHEN count(*)>50 THEN 'over' ELSE 'ok' END AS size,
round(count(*) FILTER (review_status IN ('accepted','edited','rejected'))/greatest(count(*),1)::DOUBLE,6) AS review_rate,
round(count(*) FILTER ({_CLEARED_SQL})/greatest(count(answerability),1)::DOUBLE,6) AS quality_rate, round(count(*) FILTER (answer_match='match')/greatest(count(answer_match),1)::DOUBLE,6) AS rag_rate FROM qa""")
def scorecard(spark, sf_dir):
    return reports.scorecard(items(spark, sf_dir))


@query(QA_SQL + f""", n AS (SELECT d.aspect, d.category, d.ord, count(qa.k) AS n FROM (SELECT unnest({[a for a, _, _ in dims.ASPECT_ROWS]!r}) AS aspect, unnest({[c for _, c, _ in dims.ASPECT_ROWS]!r}) AS category, unnest(range(0,25)) AS ord) d
LEFT JOIN (SELECT k, aspect FROM qa WHERE category IN ('Figure','Logic')) qa ON qa.aspect=d.aspect GROUP BY d.aspect, d.category, d.ord)
SELECT category, count(*)::BIGINT AS aspects, count(*) FILTER (n>0)::BIGINT AS some, count(*) FILTER (n>=3)::BIGINT AS reached, coalesce(string_agg(aspect, ',' ORDER BY ord) FILTER (n=0), '') AS missing FROM n GROUP BY category""")
def category_coverage(spark, sf_dir):
    """Coverage where two categories alone have items: the others' aspects are all missing."""
    return reports.category_coverage(items(spark, sf_dir).where("category in ('Figure', 'Logic')"))


@query(QA_SQL + "SELECT count(answer_match)::BIGINT AS verified, " + ", ".join(f"count(*) FILTER (answer_match='{v}')::BIGINT AS {v}" for v in dims.VERDICTS) + ", " + ", ".join(f"count(*) FILTER ({h})::BIGINT AS {h}" for h in ("retrieval_hit_doc", "retrieval_hit_chunk", "retrieval_hit")) + " FROM qa")
def verification_counts(spark, sf_dir):
    return reports.verification_counts(items(spark, sf_dir))


@query(QA_SQL + "SELECT count(llm_knowledge)::BIGINT AS probed, count(*) FILTER (llm_knowledge='known')::BIGINT AS known, count(*) FILTER (llm_knowledge='unknown')::BIGINT AS unknown, round(count(*) FILTER (llm_knowledge='unknown')/greatest(count(llm_knowledge),1)::DOUBLE,6) AS unknown_rate FROM qa")
def knowledge_counts(spark, sf_dir):
    return reports.knowledge_counts(items(spark, sf_dir))


# ---------------------------------------------------------------- jobs

_STATUS_SQL = "CASE event_type WHEN 'error' THEN 'rejected' WHEN 'signup' THEN 'accepted' WHEN 'purchase' THEN 'edited' ELSE 'pending' END"


@query(QA_SQL + f""", ev AS (SELECT qa_id, {_STATUS_SQL} AS status, 'u' || user_id AS reviewer, ts, 'edit ' || event_id AS question FROM events JOIN qa ON qa.k=events.user_id),
last AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY qa_id ORDER BY ts DESC, status DESC, reviewer DESC, question DESC)=1)
SELECT qa.qa_id, CASE WHEN status='edited' THEN last.question ELSE qa.question END AS question, coalesce(status, qa.review_status) AS review_status, reviewer AS reviewed_by FROM qa LEFT JOIN last USING (qa_id)""")
def reviewed_items(spark, sf_dir):
    """Items with the last decision of a review log merged into them."""
    qa = qa_rows(spark, sf_dir)
    kinds = F.when(F.col("event_type") == "error", "rejected").when(F.col("event_type") == "signup", "accepted").when(F.col("event_type") == "purchase", "edited").otherwise("pending")
    log = read(spark, sf_dir, "events").join(items(spark, sf_dir).select("qa_id", F.col("k").alias("user_id")), "user_id").select(
        "qa_id", kinds.alias("status"), F.concat(F.lit("u"), "user_id").alias("reviewer"), F.col("ts").cast("timestamp_ntz").alias("reviewed_at"),
        F.concat(F.lit("edit "), "event_id").alias("question"), F.lit(None).cast("string").alias("answer"))
    return jobs.reviewed(qa, log).select("qa_id", "question", "review_status", "reviewed_by")


@query(QA_SQL + """, p AS (SELECT k, qa_id, concat_ws(',', CASE WHEN k%13=0 THEN 'question' END, CASE WHEN k%17=0 THEN 'answer_level' END, CASE WHEN k%9=0 THEN 'retrieval_level_domain' END,
CASE WHEN k%10=0 THEN 'aspect_domain' END, CASE WHEN k%11=0 THEN 'review_status_domain' END) AS problems FROM qa) SELECT k, qa_id, problems FROM p WHERE problems <> ''""")
def item_problems(spark, sf_dir):
    """Items that a strict read rejects, with all that is wrong with them."""
    k = F.col("k")
    broken = qa_rows(spark, sf_dir).withColumns({
        "question": F.when(k % 13 != 0, F.col("question")), "answer_level": F.when(k % 17 != 0, F.col("answer_level")),
        "retrieval_level": F.when(k % 9 == 0, "Extreme").otherwise(F.col("retrieval_level")), "aspect": F.when(k % 10 == 0, F.array(F.lit("other"))).otherwise(F.col("aspect")),
        "review_status": F.when(k % 11 == 0, "lost").otherwise(F.col("review_status")),
    })
    return schemas.checked(broken)[1].select("k", "qa_id", F.array_join("problems", ",").alias("problems"))


@query(QA_SQL + f"""SELECT k, CASE WHEN k%9<>0 THEN (k%5+1)::DOUBLE END AS answerability, CASE WHEN k%7<>0 THEN 'pass' END AS leakage, CASE WHEN k%8<>0 THEN (k%4)::DOUBLE END AS grounding,
CASE WHEN k%6<>0 THEN measured_level ELSE answer_level END AS answer_level, CASE WHEN k%6<>0 THEN difficulty_match END AS difficulty_match FROM qa""")
def judge_scores(spark, sf_dir):
    """Four replies an item (plain, fenced, inside prose, or of no use) become its scores."""
    qa = items(spark, sf_dir)
    k = F.col("k")
    said = {
        "ANSWERABILITY": F.when(k % 9 == 0, "I can't say.").otherwise(F.format_string('{"answerability": %d}', k % 5 + 1)),
        "LEAKAGE": F.format_string('Sure.\n```json\n{"leakage": "%s"}\n```', F.when(k % 7 == 0, "maybe").otherwise("pass")),
        "GROUNDING": F.format_string('The score is {"grounding": "%s"} here.', F.when(k % 8 == 0, "high").otherwise((k % 4).cast("string"))),
        "DIFFICULTY_MATCH": F.format_string('{"answer_level": "%s"}', F.when(k % 6 == 0, "None").otherwise(F.col("measured_level"))),
    }
    rows = F.array(*[F.struct(F.lit(name).alias("perspective"), reply.alias("reply")) for name, reply in said.items()])
    replies = qa.select(k.alias("qa_id"), F.explode(rows).alias("r")).select("qa_id", "r.perspective", "r.reply")
    got = asking.scored(qa.select(k.alias("qa_id"), "answer_level"), asking.collated(replies))
    return got.select(F.col("qa_id").alias("k"), "answerability", "leakage", "grounding", "answer_level", "difficulty_match")


@query(QA_SQL + """SELECT k, CASE WHEN k%5=0 THEN 'no_match' WHEN k%4=0 THEN 'match' WHEN k%4=1 THEN 'partial' ELSE 'no_match' END AS answer_match,
CASE WHEN k%5=0 THEN NULL WHEN k%4=0 THEN 'match' WHEN k%4=1 THEN 'partial' WHEN k%4=3 THEN 'maybe' END AS judge_raw,
CASE WHEN k%5<>0 AND k%3=0 THEN 'known' ELSE 'unknown' END AS llm_knowledge FROM qa""")
def answer_verdicts(spark, sf_dir):
    """What judges say of answers, and of answers given without any document."""
    k = F.col("k")
    judge = F.when(k % 4 == 0, '{"match": " Match"}').when(k % 4 == 1, '```\n{"match": "partial"}\n```').when(k % 4 == 2, "none").otherwise('{"match": "maybe"}')
    answer = F.when(k % 5 == 0, "「不明」。").otherwise(F.concat(F.lit("it is "), "answer"))
    rows = asking.verdicts(items(spark, sf_dir).select("k", answer.alias("rag_answer"), judge.alias("judge_reply")))
    rows = rows.withColumns({"candidate": F.when(k % 5 == 0, " ").otherwise("x"), "judge_reply": F.when(k % 3 == 0, '{"match": "known"}').otherwise('{"match": "no"}')})
    return asking.knowledge(rows).select("k", "answer_match", "judge_raw", "llm_knowledge")


@query(QA_SQL + ", " + _CHUNK_SQL + _QUOTE_SQL + f""", r AS (SELECT k AS qa_id, c.* FROM qa JOIN c ON c.doc_id=(qa.doc_id + CASE WHEN k%3=0 THEN 1 ELSE 0 END)::VARCHAR AND c.position<3),
b AS (SELECT qa_id, string_agg({_sq('text')}, '' ORDER BY position) AS blob, list(doc_id) AS docs, list(chunk_id) AS ids FROM r GROUP BY qa_id)
SELECT qa_id, bool_or(coalesce(list_contains(docs, regexp_replace(q.doc_id,'__c[0-9]+$','')) OR list_contains(ids, q.doc_id), false)) AS hit_doc, bool_or(coalesce(needle<>'' AND contains(blob, needle), false)) AS hit_chunk
FROM (SELECT *, {_sq('quote')} AS needle FROM quotes) q LEFT JOIN b USING (qa_id) GROUP BY qa_id""")
def quote_hits(spark, sf_dir):
    """Whether three retrieved chunks, for a third of the items those of another document, hold an item's document and quotes."""
    asked = items(spark, sf_dir).select(F.col("k").alias("qa_id"), (F.col("doc_id") + F.when(F.col("k") % 3 == 0, 1).otherwise(0)).cast("string").alias("doc_id"))
    retrieved = asked.join(_window_chunks(spark, sf_dir).where("position < 3"), "doc_id").withColumn("rank", F.col("position") + 1)
    return ops.retrieval_hits(_quotes(spark, sf_dir), retrieved)


@query(QA_SQL + ", " + _CHUNK_SQL + """, b AS (SELECT doc_id, string_agg('[' || (position+1) || '] ' || chunk_id || ' (p.' || coalesce(page::VARCHAR,'?') || ') part > ' || doc_id || chr(10) || text, chr(10)||chr(10) ORDER BY position) AS block FROM c WHERE position<2 GROUP BY doc_id)
SELECT k, md5('Q {x} ' || question || chr(10) || coalesce(block,'') || chr(10) || answer) AS prompt_md5 FROM qa LEFT JOIN b ON b.doc_id=qa.doc_id::VARCHAR""")
def prompt_texts(spark, sf_dir):
    """Prompts of a template, with numbered blocks of an item's first chunks."""
    c = _window_chunks(spark, sf_dir).where("position < 2").withColumn("section_path", F.array(F.lit("part"), "doc_id"))
    blocks = c.groupBy("doc_id").agg(text.page_blocks(F.array_sort(F.collect_list(F.struct("position", "chunk_id", "page", "section_path", "text")))).alias("block"))
    qa = items(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("string")).join(blocks, "doc_id", "left")
    prompt = asking.rendered("Q {x} {question}\n{block}\n{answer}", question=F.col("question"), block=F.col("block"), answer=F.col("answer"))
    return qa.select("k", F.md5(prompt.cast("binary")).alias("prompt_md5"))


_PAGES_SQL = f"""WITH d AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, '. ', '.'||chr(1)), chr(1)), lambda x: trim(x, {_SPACES_SQL})), lambda x: x<>'') AS p FROM documents WHERE trim(text, {_SPACES_SQL})<>'')"""


@query(_PAGES_SQL + " SELECT doc_id::VARCHAR AS doc_id, (i+6)::INT AS page, (i-1)::INT AS position, doc_id || '__c' || CASE WHEN i>10000 THEN (i-1)::VARCHAR ELSE lpad((i-1)::VARCHAR, 4, '0') END AS chunk_id, md5(p[i]) AS text_md5 FROM (SELECT doc_id, p, unnest(range(1, len(p)+1)) AS i FROM d)")
def page_chunks(spark, sf_dir):
    """Layout Markdown, a sentence a page from page 7 on, one chunk each: positions and ids run through a document's pages."""
    docs = read(spark, sf_dir, "documents").where(text.strip(F.col("text")) != "")
    layout = F.concat(F.lit('<!-- PageNumber="7" -->'), F.replace("text", F.lit(". "), F.lit(".<!-- PageBreak -->")))
    pages = files.layout_documents(docs.select(F.col("doc_id").cast("string").alias("doc_id"), layout.alias("text")))
    got = chunking.chunk_documents(pages, size=10**7)
    return got.select("doc_id", "page", "position", "chunk_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _heading_lines(text_column, replace):
    for level in range(1, 7):
        text_column = replace(text_column, f"(?is)<h{level}[^>]*>(.*?)</h{level}>", level)
    return text_column


_HEADINGS_SQL = _heading_lines("html", lambda c, p, level: f"regexp_replace({c}, '{p}', chr(10) || '{'#' * level} ' || '\\1' || chr(10), 'g')")


@query(rf"""WITH t AS (SELECT page_id, regexp_replace({_HEADINGS_SQL}, '<[^>]*>', '', 'g') AS t, {_SPACES_SQL} AS ws FROM pages WHERE html IS NOT NULL),
l AS (SELECT page_id, ws, i, a[i] AS line, length(regexp_extract(a[i], '^(#{{1,6}})\s+\S', 1)) AS marks FROM (SELECT page_id, ws, string_split(t, chr(10)) AS a, unnest(range(1, len(string_split(t, chr(10)))+1)) AS i FROM t)),
s AS (SELECT *, count(*) FILTER (marks>0) OVER (PARTITION BY page_id ORDER BY i) AS sec FROM l),
h AS (SELECT page_id, sec, marks, trim(regexp_replace(line, '^#{{1,6}}\s+', ''), ws) AS title FROM s WHERE marks>0),
f AS (SELECT *, count(*) FILTER (line<>'') OVER (PARTITION BY page_id, sec ORDER BY i) AS seen FROM s WHERE marks=0),
b AS (SELECT page_id, sec, string_agg(line, chr(10) ORDER BY i) AS body FROM f WHERE seen>0 GROUP BY page_id, sec, ws HAVING trim(string_agg(line, chr(10) ORDER BY i), ws)<>''),
e AS (SELECT b.page_id, b.sec, v.lv, arg_max(CASE WHEN o.marks=v.lv THEN o.title ELSE '' END, o.sec) AS part FROM b JOIN h ON h.page_id=b.page_id AND h.sec=b.sec JOIN (SELECT unnest(range(1,7)) AS lv) v ON v.lv<=h.marks
  LEFT JOIN h o ON o.page_id=b.page_id AND o.sec<=b.sec AND o.marks<=v.lv GROUP BY b.page_id, b.sec, v.lv),
p AS (SELECT page_id, sec, string_agg(coalesce(part,''), ' > ' ORDER BY lv) AS path FROM e GROUP BY page_id, sec)
SELECT b.page_id, (row_number() OVER (PARTITION BY b.page_id ORDER BY b.sec)-1)::INT AS n, coalesce(path,'') AS path, md5(body) AS body_md5 FROM b LEFT JOIN p USING (page_id, sec)
UNION ALL SELECT page_id, 0, '', md5(t) FROM t WHERE page_id NOT IN (SELECT page_id FROM b)""")
def markdown_sections(spark, sf_dir):
    """Pages with their headings as Markdown lines, cut into sections with the path of headings above each."""
    lines = _heading_lines(F.col("html"), lambda c, p, level: F.regexp_replace(c, p, "\n" + "#" * level + " $1\n"))
    pages = read(spark, sf_dir, "pages").where("html is not null").select("page_id", F.regexp_replace(lines, "<[^>]*>", "").alias("t"))
    cut = pages.select("page_id", F.posexplode(chunking.sections(F.col("t"))).alias("n", "s"))
    return cut.select("page_id", "n", F.array_join("s.path", " > ").alias("path"), F.md5(F.col("s.body").cast("binary")).alias("body_md5"))


@query("WITH " + _CHUNK_SQL + ", s AS (SELECT *, sum(length(text)) OVER (ORDER BY doc_id, position) AS cum FROM c) SELECT md5(string_agg('### ' || doc_id || chr(10) || text, chr(10)||chr(10) ORDER BY doc_id, position)) AS sample_md5 FROM s WHERE cum <= 12000")
def prompt_sample(spark, sf_dir):
    """The chunks that fit one prompt of 12,000 characters, from which a model is to find patterns."""
    sample = jobs.pattern_sample(_window_chunks(spark, sf_dir))
    return spark.createDataFrame([(sample,)], "sample string").select(F.md5(F.col("sample").cast("binary")).alias("sample_md5"))


# ---------------------------------------------------------------- samples, files, streams

@query("SELECT lang, pick::INT AS pick, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || coalesce(doc_id::VARCHAR, '')), doc_id) AS pick FROM documents) WHERE pick <= 20")
def seed_sample(spark, sf_dir):
    """Twenty documents of each language as seeds, the same whatever order they come in."""
    return sampling.bottom_k(read(spark, sf_dir, "documents").select("lang", "doc_id"), "doc_id", 20, ("lang",)).select("lang", "pick", "doc_id")


@query(QA_SQL + """SELECT 'part=' || k%5 AS part, count(*) FILTER (ok AND track='kg_poc')::BIGINT AS kg_items, count(*) FILTER (ok AND track='general')::BIGINT AS general_items, count(*) FILTER (NOT ok)::BIGINT AS skipped
FROM (SELECT *, k%13<>0 AND k%17<>0 AND k%10<>0 AS ok FROM qa) GROUP BY k%5""")
def lenient_items(spark, sf_dir):
    """Items as JSON lines in five folders, some lines cut in half, some with values outside their domains: what a lenient read keeps."""
    k = F.col("k")
    rows = qa_rows(spark, sf_dir).withColumns({"answer_level": F.when(k % 17 != 0, F.col("answer_level")), "aspect": F.when(k % 10 == 0, F.array(F.lit("other"))).otherwise(F.col("aspect"))})
    line = F.to_json(F.struct(*[c for c in rows.columns if c != "k"]))
    cut = F.when(k % 13 == 0, F.substr(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    place = f"{shared_dir(spark)}/items-{uuid.uuid4().hex}"
    rows.select(cut.alias("value"), (k % 5).alias("part")).write.partitionBy("part").text(place)
    found = None
    for i in range(5):
        name = F.lit(f"part={i}").alias("part")
        for track in ("kg_poc", "general"):
            good, skipped = files.qa_lenient(spark, f"{place}/part={i}", track)
            counts = [good.select(name, F.lit(f"{track.split('_')[0]}_items").alias("kind"), F.lit(1).cast("long").alias("n"))] + ([skipped.select(name, F.lit("skipped").alias("kind"), F.col("skipped").alias("n"))] if track == "general" else [])
            for part in counts:
                found = part if found is None else found.unionByName(part)
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == c, F.col("n"))), F.lit(0)).alias(c) for c in ("kg_items", "general_items", "skipped")]
    return found.groupBy("part").agg(*sums)


def _said(prompt: str, model: str) -> str:
    """A client that answers from the prompt: the first words of a question, and a verdict by the length of what is judged."""
    if model == "answer":
        return json.dumps({"answer": prompt.partition("\n")[0][:25]})
    return json.dumps({"match": dims.VERDICTS[len(prompt) % 3]})


@query(QA_SQL + """, s AS (SELECT k, question, answer, left(string_split(question, chr(10))[1], 25) AS said FROM qa),
a AS (SELECT k, trim(said, ' ') AS said, answer FROM s)
SELECT k, said AS rag_answer, ['match','partial','no_match'][length(answer || '|' || said) % 3 + 1] AS answer_match FROM a""")
def verified_stream(spark, sf_dir):
    """Items verified as micro-batches of files: first half of them, then the rest, by a client that answers from the prompt."""
    qa = qa_rows(spark, sf_dir).withColumn("qa_id", F.col("k").cast("string")).drop("k", "rag_verification").withColumn("rag_verification", F.lit(None).cast(schemas.VERIFICATION))
    qa = stored(qa, "verified-items")
    place = f"{shared_dir(spark)}/verified-{uuid.uuid4().hex}"
    found = read(spark, sf_dir, "documents").where("doc_id = 0").select(F.lit("0__c0000").alias("chunk_id"), F.lit("0").alias("doc_id"), F.lit(None).cast("int").alias("page"), F.array().cast("array<string>").alias("section_path"), F.substring("text", 1, 80).alias("text"))
    found = stored(found, "verified-chunk")

    def verify(batch: DataFrame) -> DataFrame:
        retrieved = batch.select("qa_id", F.lit(1).alias("rank")).crossJoin(F.broadcast(found))  # one chunk
        done = jobs.verify(batch, retrieved, _said, ("answer", "judge"), {"RAG_ANSWER": "{question}", "JUDGE": "{ground_truth}|{candidate}"}, f"{place}/replies", 1)
        return batch.drop("rag_verification").join(done, "qa_id")

    for part in (qa.where(F.pmod(F.xxhash64("qa_id"), F.lit(2)) == 0), qa):
        verification.verify_new(part, f"{place}/out", verify, batch=20_000, most=8)
    done = spark.read.schema(schemas.QA).json(f"{place}/out")
    return done.select(F.col("qa_id").cast("long").alias("k"), "rag_verification.rag_answer", "rag_verification.answer_match")
