"""Records out of markup held in a string column, which need not parse.

The expressions are for flat elements, ``nested_elements`` for those that hold others of their name. Whole
well-formed documents are read by ``notemill.operators.parsing``.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx


_PREFIX = r"(?:[\w.-]+:)?"


def _start(tag: str) -> str:
    """Start tag of an element up to its attributes' end, with any prefix."""
    return rf"<{_PREFIX}{tag}(?:\s[^>]*?)?"


def elements(markup: Column, tag: str) -> Column:
    """Every ``<tag ...>...</tag>`` or ``<tag .../>`` of the string, in document order, with any prefix."""
    return F.regexp_extract_all(markup, F.lit(rf"(?s){_start(tag)}(?:/>|>.*?</{_PREFIX}{tag}>)"), F.lit(0))


def nested_elements(markup: Column, tag: str) -> Column:
    """(depth, element) of every ``<tag ...>...</tag>`` or ``<tag .../>``, those within others of the name too, in
    document order; depth counts from 1.

    One pass over the tags of that name. The open ones are a stack; an end tag closes the last of them. A tag that is
    never closed gives no element, an end tag without a beginning is passed over. Comments are no markup.
    """
    plain = F.regexp_replace(markup, "(?s)<!--.*?-->", "")
    pattern = rf"(?s)</?{_PREFIX}{tag}(?:\s[^>]*)?/?>"
    tags, between = F.regexp_extract_all(plain, F.lit(pattern), F.lit(0)), F.split(plain, pattern, -1)
    numbers = "array<struct<first:int,last:int,depth:int>>"

    def step(state: Column, at: Column, sign: Column) -> Column:
        stack, found = state["stack"], state["found"]
        here = F.array(F.struct(at.alias("first"), at.alias("last"), (F.size(stack) + 1).alias("depth")))
        top = F.array(F.struct(F.element_at(stack, -1).alias("first"), at.alias("last"), F.size(stack).alias("depth")))
        ends, alone = F.startswith(sign, F.lit("</")), F.endswith(sign, F.lit("/>"))
        return F.struct(
            F.when(ends, F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))).when(alone, stack)
            .otherwise(F.concat(stack, F.array(at))).alias("stack"),
            F.when(ends & (F.size(stack) > 0), F.concat(found, top)).when(~ends & alone, F.concat(found, here))
            .otherwise(found).alias("found"))

    begin = F.struct(F.array().cast("array<int>").alias("stack"), F.array().cast(numbers).alias("found"))
    pairs = F.transform(tags, lambda t, i: F.struct(i.cast("int").alias("at"), t.alias("tag"), F.get(between, i + 1).alias("after")))

    def written(held: Column) -> Column:
        """Elements out of the tags and the text after each, both taken once."""
        found = F.aggregate(held, begin, lambda s, x: step(s, x["at"], x["tag"]), lambda s: F.array_sort(s["found"]))
        return F.transform(found, lambda f: F.struct(f["depth"].alias("depth"), F.concat(
            F.array_join(F.transform(F.slice(held, f["first"] + 1, f["last"] - f["first"]), lambda x: F.concat(x["tag"], x["after"])), ""),
            F.get(held, f["last"])["tag"]).alias("element")))

    return F.element_at(F.transform(F.array(pairs), written), 1)


def root_elements(document: Column, tag: str) -> Column:
    """Elements with the prefix of the document's root; comments are no markup, CDATA sections are text."""
    def of_root(plain: Column) -> Column:
        opening = F.concat(F.lit("<"), F.regexp_extract(plain, r"<([\w.-]+:)?[\w.-]+", 1), F.lit(tag))
        both = F.array(F.struct(opening.alias("opening"), elements(plain, tag).alias("all")))
        return F.element_at(F.transform(both, lambda b: F.filter(b["all"], lambda e: F.startswith(e, b["opening"]))), 1)

    plain = F.regexp_replace(without_cdata(document), "(?s)<!--.*?-->", "")
    return F.element_at(F.transform(F.array(plain), of_root), 1)


def without_cdata(document: Column) -> Column:
    """The document with the text of its CDATA sections written with named characters instead. A section that is not
    closed stays as it was."""
    def plain(piece: Column) -> Column:
        end = F.instr(piece, "]]>")
        text = F.substring(piece, F.lit(1), end - 1)
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(sign), F.lit(name))
        return F.when(end > 0, F.concat(text, F.substring(piece, end + 3, F.length(piece)))).otherwise(
            F.concat(F.lit("<![CDATA["), piece))

    pieces = F.transform(F.split(document, r"<!\[CDATA\["), lambda t, i: F.when(i == 0, t).otherwise(plain(t)))
    return F.when(F.contains(document, F.lit("<![CDATA[")), F.array_join(pieces, "")).otherwise(document)


def element_texts(markup: Column, tag: str) -> Column:
    """Whole text of every element, inline tags taken out and their text kept, stripped; empty ones are left out.

    An element that is not closed ends where the next one starts, or with the document.
    """
    pieces = F.split(markup, rf"<{tag}(?:\s[^>]*)?>")
    own = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)),
                      lambda t: F.regexp_replace(t, rf"(?s)</{tag}\s*>.*", ""))
    return F.filter(F.transform(own, lambda t: tx.strip(F.regexp_replace(t, "<[^>]*>", ""))), lambda t: t != "")


def note_text(element: Column, full_text: bool = False) -> Column:
    """First paragraph that is a child of the element's own ``notes``; without one, the notes' own leading text.

    Notes of inner parts (``fv.INNER_ELEMENTS``) and paragraphs below other elements of the notes do not
    count. Only text before the paragraph's first child is taken; ``full_text`` keeps the children's text.
    """
    outer = strip_elements(element, fv.INNER_ELEMENTS)
    notes = F.regexp_extract(outer, rf"(?s){_start('notes')}>(.*?)</{_PREFIX}notes>", 1)
    if full_text:
        paragraph = F.regexp_extract(notes, rf"(?s){_start('p')}>(.*?)</{_PREFIX}p>", 1)
        paragraph = F.regexp_replace(paragraph, "<[^>]*>", "")
    else:
        other = rf"(?s)<(?!{_PREFIX}p[\s/>])({_PREFIX}[\w.-]+)(?:\s[^>]*?)?(?<!/)>.*?</\1>"
        paragraph = F.regexp_extract(F.regexp_replace(notes, other, "<x/>"), rf"{_start('p')}>([^<]*)", 1)
    own = F.regexp_extract(notes, "^([^<]*)", 1)
    text = tx.strip(F.coalesce(F.nullif(paragraph, F.lit("")), F.nullif(own, F.lit(""))))
    return unescape(text)


def unescape(text: Column) -> Column:
    """Named characters of XML and numbered ones, in one pass, so that nothing is decoded twice."""
    return F.array_join(F.transform(F.split(text, "&"), lambda t, i: F.when(i == 0, t).otherwise(_decoded(t))), "")


def _decoded(piece: Column) -> Column:
    """A piece that followed an ampersand; what names no character stays as it was."""
    name = F.regexp_extract(piece, r"^(#x[0-9A-Fa-f]{1,6}|#[0-9]{1,7}|[a-z]+);", 1)
    code = F.when(F.startswith(name, F.lit("#x")), F.conv(F.substring(name, 3, 6), 16, 10)).when(
        F.startswith(name, F.lit("#")), F.substring(name, 2, 7)).cast("long")
    valid = (code > 0) & (code < 0xD800) | code.between(0xE000, 0x10FFFF)
    sign = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    for known, value in fv.NAMED_CHARACTERS.items():
        sign = F.when(name == known, F.lit(value)).otherwise(sign)
    return F.coalesce(F.concat(sign, F.substr(piece, F.length(name) + 2)), F.concat(F.lit("&"), piece))


def first_text(element: Column, tag: str) -> Column:
    """Text of the first such element up to its first child, stripped; null when there is none."""
    own = F.regexp_extract(element, rf"<{tag}(?:\s[^>]*)?>([^<]*)", 1)
    return F.when(element.rlike(rf"<{tag}[\s>]"), tx.strip(own))


def attribute(element: Column, name: str) -> Column:
    """Attribute of the element's own start tag, decoded; null when absent."""
    pattern = rf"^<[^\s>]+(?:\s[^>]*?)?\s{re.escape(name)}=(?:\"([^\"]*)\"|'([^']*)')"
    return F.when(element.rlike(pattern),
                  unescape(F.concat(F.regexp_extract(element, pattern, 1), F.regexp_extract(element, pattern, 2))))


def strip_elements(markup: Column, tags) -> Column:
    """Drop whole subtrees and comments."""
    names = "|".join(tags)
    return F.regexp_replace(markup, rf"(?s)<({_PREFIX}(?:{names}))(?:\s[^>]*?)?(?:/>|>.*?</\1>)|<!--.*?-->", "")


def strip_namespaces(markup: Column, dropped_attribute: str = fv.DROPPED_ATTRIBUTE) -> Column:
    """Drop namespace declarations, one attribute name, and all prefixes of tags and attributes."""
    value = r"(?:\"[^\"]*\"|'[^']*')"
    for pattern, replacement in (
            (rf"\s(?:xmlns(?::[\w.-]+)?|(?:[\w.-]+:)?{dropped_attribute})={value}", ""),
            (r"(</?)[\w.-]+:", "$1"),
            (rf"(\s)[\w.-]+:([\w.-]+={value})", "$1$2")):
        markup = F.regexp_replace(markup, pattern, replacement)
    return markup


def snippet(element: Column, dropped=fv.DROPPED_ELEMENTS) -> Column:
    """The element without notes, annotation, prefixes and blank lines."""
    return tx.normalise_lines(strip_namespaces(strip_elements(element, dropped)))


def explode_elements(df: DataFrame, column: str, tag: str) -> DataFrame:
    """One row per element, with its position in the document; documents without one give no row."""
    return df.select("*", F.posexplode(elements(F.col(column), tag)).alias("position", "element"))


def element_counts(df: DataFrame, key: str, column: str, tag: str) -> DataFrame:
    """Elements per document, 0 included: a row-wise size, nothing is shuffled."""
    return df.select(key, F.size(elements(F.col(column), tag)).cast("long").alias("element_count"))
