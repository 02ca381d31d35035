"""Column functions over text: splitting, normalising, identifiers, and replies of language models.

All stay in Spark's own expressions. Null in gives null out, unless the function says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims


def strip(text: Column) -> Column:
    """Without white space (of any script) at both ends."""
    return F.btrim(text, F.lit(dims.SPACES))


def squeeze(text: Column) -> Column:
    """Without any white space: quotes are compared like this, since models reflow them."""
    return F.regexp_replace(text, r"(?U)\s+", "")


def plain_doc_id(doc_id: Column) -> Column:
    """A chunk id that stands for its document becomes the document's id."""
    return F.regexp_replace(doc_id, "__c[0-9]+$", "")


def chunk_id(doc_id: Column, position: Column) -> Column:
    return F.format_string("%s__c%04d", doc_id.cast("string"), position.cast("int"))


def qa_id(chunk_ids: Column, key: Column, question: Column) -> Column:
    """A stable id from the anchors, the aspect or query type, and the question."""
    return F.concat(F.lit("auto_"), F.substring(F.sha1(F.concat(F.array_join(chunk_ids, "+"), F.lit("::"), key, F.lit("::"), question)), 1, 8))


def references(text: Column, more: Iterable[str] = ()) -> Column:
    """Distinct references in order of discovery, with single spaces inside."""
    pattern = "(?U)" + "|".join(f"(?:{p})" for p in (*dims.REFERENCES, *more))
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: strip(F.regexp_replace(m, r"(?U)\s+", " "))))


def has_any(text: Column, markers: Iterable[str]) -> Column:
    out = F.lit(False)
    for marker in markers:
        out = out | F.contains(text, F.lit(marker))
    return out


def unseen_terms(text: Column, known: Column, pattern: str = "[ァ-ヴー・]{4,}") -> Column:
    """Distinct matches in text that the known text does not have: terms that a model may have made up."""
    return F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), lambda m: ~F.contains(known, m))


def is_unable(answer: Column) -> Column:
    """Whether an answer says that there is none; null and blank answers do."""
    bare = F.lower(F.translate(strip(answer), dims.UNABLE_MARKS, ""))
    return F.coalesce((bare == "") | bare.isin(*dims.UNABLE), F.lit(True))


def unfenced(reply: Column) -> Column:
    """The body of the first code fence of a reply, or the trimmed reply."""
    body = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(F.regexp_like(reply, F.lit(r"(?s)```(?:json)?\s*.*?\s*```")), body).otherwise(strip(reply))


def first_object(reply: Column) -> Column:
    """The text from the first opening brace to the brace that balances it; null if there is none."""
    start = F.instr(reply, "{")
    tail = F.when(start > 0, F.substr(reply, start)).otherwise(None)
    marks = F.split(F.regexp_replace(tail, r"[^{}]", ""), "")
    # which brace of the tail closes the object: the first where opens and closes are level
    closing = F.aggregate(
        marks,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("level"), F.lit(0).alias("at")),
        lambda s, m: F.when((s["at"] > 0) | (m == ""), s).otherwise(
            F.struct(
                (s["n"] + F.when(m == "}", 1).otherwise(0)).alias("n"),
                (s["level"] + F.when(m == "{", 1).otherwise(-1)).alias("level"),
                F.when((m == "}") & (s["level"] == 1), s["n"] + 1).otherwise(0).alias("at"),
            )
        ),
        lambda s: s["at"],
    )
    return F.when(closing > 0, F.concat(F.array_join(F.slice(F.split(tail, "}"), 1, closing), "}"), F.lit("}")))


def parsed(reply: Column, schema: str) -> Column:
    """The fields of a model's JSON reply: of its code fence or text, else of its first braced object; null fields if none."""
    first = F.from_json(unfenced(reply), schema)
    valid = F.try_parse_json(unfenced(reply)).isNotNull()
    return F.when(valid, first).otherwise(F.from_json(first_object(reply), schema))


def page_blocks(texts: Column) -> Column:
    """Numbered prompt blocks of an array of structs (chunk_id, page, section_path, text)."""
    return F.array_join(
        F.transform(
            texts,
            lambda c, i: F.format_string(
                "[%d] %s (p.%s) %s\n%s", i + 1, c["chunk_id"], F.coalesce(c["page"].cast("string"), F.lit("?")), F.array_join(c["section_path"], " > "), c["text"]
            ),
        ),
        "\n\n",
    )


def span_of(body: Column, quote: Column) -> Column:
    """Where the first hit of a quote stands in a text, white space aside: struct (start, end) of places from 1, zeros for no hit.

    The quote is looked up in the squeezed text, and the two ends are carried back to the text by counts: the runs of white space
    and of other characters are gone through once, with the characters of either kind that lie before. Quotes that have
    under 4 characters besides white space hit nothing.
    """
    needle = squeeze(quote)
    first = F.when(F.length(needle) >= 4, F.instr(squeeze(body), needle)).otherwise(0)
    runs = F.regexp_extract_all(body, F.lit(r"(?U)\s+|\S+"), F.lit(0))
    # the places that are looked for are in the state, as a lambda would compute them anew for each run
    state = F.struct(first.alias("a"), (first + F.length(needle) - 1).alias("b"), F.lit(0).alias("seen"), F.lit(0).alias("at"), F.lit(0).alias("start"), F.lit(0).alias("end"))

    def step(s: Column, run: Column) -> Column:
        n = F.length(run)
        solid = ~run.rlike(r"(?U)^\s")
        place = lambda k, known: F.when((known == 0) & solid & (s[k] > s["seen"]) & (s[k] <= s["seen"] + n), s["at"] + s[k] - s["seen"]).otherwise(known)
        return F.struct(s["a"].alias("a"), s["b"].alias("b"), (s["seen"] + F.when(solid, n).otherwise(0)).alias("seen"), (s["at"] + n).alias("at"), place("a", s["start"]).alias("start"), place("b", s["end"]).alias("end"))

    found = F.aggregate(runs, state, step, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.coalesce(first, F.lit(0)) > 0, found).otherwise(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")))


def escaped(text: Column) -> Column:
    """text as HTML text."""
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text


def highlighted(body: Column, quote: Column) -> Column:
    """body as HTML text with the first hit of the quote (`span_of`) marked."""
    hit = span_of(body, quote)
    parts = F.transform(F.array(hit), lambda s: F.when(s["start"] == 0, escaped(body)).otherwise(F.concat(
        escaped(F.substr(body, F.lit(1), s["start"] - 1)), F.lit("<mark>"), escaped(F.substr(body, s["start"], s["end"] - s["start"] + 1)), F.lit("</mark>"), escaped(F.substr(body, s["end"] + 1)),
    )))
    return parts[0]


def bullets(lines: Column, none: str = "(該当なし)") -> Column:
    """Lines as a list, or the text for none."""
    return F.when(F.size(lines) > 0, F.array_join(F.transform(lines, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise(F.lit(none))
