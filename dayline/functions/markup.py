"""Pages as event arrays, read by column expressions.

A page is cut into tags and texts by one pattern, and the events are folded once, in document
order: the fold holds the depth of skipped elements, the path of open elements (newest first, each with whether a
container is open there), and the block that is being read.  A closing tag is matched with the newest open
element of its name and closes all that was opened since.  No part of it leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.once import once
from dayline.functions.text import plain_spacing

OPEN, CLOSE, TEXT = 1, -1, 0
#: Comments, declarations, instructions, and elements whose content is no markup.
_IGNORED = r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?:\s(?:[^>]*(?:[^/>]|=[^\s\"'>]*/))?)?>.*?(?:</\1\s*>|\z)|<[!?][^>]*(?:>|\z)|</[^a-z>][^>]*(?:>|\z)|</>"
#: A tag with its attributes, a text, or a sign that opens nothing (as in a tag that the page's end cuts off).
_ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+){0,200}+"""
_TOKENS = rf"(?s)</?[a-zA-Z]{_ATTRIBUTES}>|</?[a-zA-Z][^>]*+>|[^<]++|<"
#: A slash that ends the value of an attribute, and so doesn't close the element.
_VALUE_SLASH = r"""=\s*[^\s"'>]*/>$"""
_TAG = r"(?s)^</?([a-zA-Z][^\t\n\f\r />\x00]*)"
_ATTRIBUTE = r"""(?s)[^\s"'>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]*)"""
# Entities by name; numbers are decoded by rule.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\xa0", "copy": "©", "reg": "®", "trade": "™", "middot": "·",
    "hellip": "…", "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«",
    "raquo": "»", "bull": "•", "euro": "€", "pound": "£", "deg": "°", "times": "×", "sect": "§", "para": "¶",
}


_REFERENCE = r"(?s)&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]+);|[^&]+|&"


def _referred(part: Column) -> Column:
    """The character that a reference stands for; anything else stays."""
    named = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    name = F.regexp_extract(part, "^&([A-Za-z]+);$", 1)
    decimal = F.regexp_extract(part, "^&#([0-9]{1,7});$", 1)
    digits = F.regexp_extract(part, "^&#[xX]([0-9a-fA-F]{1,6});$", 1)
    number = F.coalesce(decimal.try_cast("int"), F.conv(digits, 16, 10).try_cast("int"))
    is_point = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    char = F.when(is_point, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).when(number.isNotNull(), "\ufffd")
    return F.coalesce(F.try_element_at(named, name), char, part)


def decoded(text: Column) -> Column:
    """Text with character references decoded once: numbers in either notation, and the common names."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), _referred)
    return F.when(text.rlike("&[#A-Za-z][0-9A-Za-z]*;"), F.array_join(parts, "")).otherwise(text)


def _holds(token: Column, tag: Column) -> Column:
    """Whether an element is a container, by its name or by a hint in one of the attributes that name it."""
    names = "|".join(lexicon.CONTAINER_ATTRIBUTES)
    given = F.filter(F.regexp_extract_all(token, F.lit(_ATTRIBUTE), F.lit(0)), lambda a: a.rlike(rf"(?is)^({names})\s*="))
    hinted = F.exists(given, lambda a: F.regexp_replace(a, "(?s)^[^=]*=", "").rlike("(?i)" + "|".join(lexicon.CONTAINER_HINTS)))
    return tag.isin(*lexicon.CONTAINER_TAGS) | (F.contains(token, F.lit("=")) & hinted)


def events(html: Column) -> Column:
    """``array<struct<kind, tag, holds, text>>`` of a page in document order; an element closed by its own tag gives two."""
    page = F.regexp_replace(F.coalesce(html, F.lit("")), _IGNORED, " ")

    def read(token: Column) -> Column:
        tag = F.lower(F.regexp_extract(token, _TAG, 1))
        event = lambda kind, holds, text: F.struct(F.lit(kind).alias("kind"), tag.alias("tag"), holds.alias("holds"), text.alias("text"))
        no, none = F.lit(False), F.lit("")
        own_end = token.endswith("/>") & ~token.rlike(_VALUE_SLASH)
        return (
            F.when(tag == "", F.array(event(TEXT, no, decoded(token))))
            .when(token.startswith("</"), F.array(event(CLOSE, no, none)))
            .when(own_end, F.array(event(OPEN, _holds(token, tag), none), event(CLOSE, no, none)))
            .otherwise(F.array(event(OPEN, _holds(token, tag), none)))
        )

    return F.flatten(F.transform(F.regexp_extract_all(page, F.lit(_TOKENS), F.lit(0)), read))


def _named(found: Column, kind: int) -> Column:
    return F.array_distinct(F.transform(F.filter(found, lambda e: e["kind"] == kind), lambda e: e["tag"]))


def _decides(event: Column, opened: Column, closed: Column) -> Column:
    """Whether an event may change what is read: not an element that never closes and is no block or container, nor what closes none."""
    known = (*lexicon.BLOCK_TAGS, *lexicon.SKIP_TAGS)
    return (
        F.when(event["kind"] == OPEN, event["holds"] | event["tag"].isin(*known) | F.array_contains(closed, event["tag"]))
        .when(event["kind"] == CLOSE, event["tag"].isin(*lexicon.SKIP_TAGS) | F.array_contains(opened, event["tag"]))
        .otherwise(event["text"] != "")
    )


_PATH = "array<struct<tag:string,inside:boolean>>"
_BLOCKS = "array<struct<in_container:boolean,text:string>>"
_STATE = f"skipped:int,path:{_PATH},tag:string,parts:array<string>"
#: Events of a slice.  A fold copies its state at each step, so blocks are gathered slice by slice.
SLICE = 256


def _inside(path: Column) -> Column:
    return F.coalesce(F.get(path, F.lit(0))["inside"], F.lit(False))


def _step(state: Column, event: Column) -> Column:
    """The state behind an event."""
    skips = event["tag"].isin(*lexicon.SKIP_TAGS)
    is_open, is_close = event["kind"] == OPEN, event["kind"] == CLOSE
    nothing = F.array().cast("array<string>")
    path, tag = state["path"], event["tag"]
    entered = F.struct(tag.alias("tag"), (event["holds"] | _inside(path)).alias("inside"))
    starts = tag.isin(*lexicon.BLOCK_TAGS)
    opened = F.struct(
        state["skipped"].alias("skipped"), F.concat(F.array(entered), path).alias("path"),
        F.when(starts, tag).otherwise(state["tag"]).alias("tag"), F.when(starts, nothing).otherwise(state["parts"]).alias("parts"),
        state["blocks"].alias("blocks"),
    )
    ends = tag == state["tag"]
    at = F.array_position(F.transform(path, lambda p: p["tag"]), tag).cast("int")
    block = F.struct(_inside(path).alias("in_container"), F.array_join(state["parts"], " ").alias("text"))
    closed = F.struct(
        state["skipped"].alias("skipped"), F.when(at > 0, F.slice(path, at + 1, F.size(path) + 1)).otherwise(path).alias("path"),
        F.when(ends, "").otherwise(state["tag"]).alias("tag"), F.when(ends, nothing).otherwise(state["parts"]).alias("parts"),
        F.when(ends, F.concat(state["blocks"], F.array(block))).otherwise(state["blocks"]).alias("blocks"),
    )
    deeper, higher = state.withField("skipped", state["skipped"] + 1), state.withField("skipped", state["skipped"] - 1)
    return (
        F.when(is_open & skips, deeper)
        .when(state["skipped"] > 0, F.when(is_close & skips, higher).otherwise(state))
        .when(is_open, opened)
        .when(is_close, closed)
        .when(state["tag"] != "", state.withField("parts", F.concat(state["parts"], F.array(event["text"]))))
        .otherwise(state)
    )


def _folded(found: Column) -> Column:
    """The state behind all events, with the blocks of each slice."""
    kept = lambda state: [state[name].alias(name) for name in ("skipped", "path", "tag", "parts")]
    none = F.array().cast(_BLOCKS)

    def over_slice(state: Column, i: Column) -> Column:
        begun = F.struct(*kept(state), none.alias("blocks")).cast(f"struct<{_STATE},blocks:{_BLOCKS}>")
        gathered = lambda s: F.struct(*kept(s), F.concat(state["slices"], F.array(s["blocks"])).alias("slices"))
        return F.aggregate(F.slice(found, i * SLICE + 1, F.lit(SLICE)), begun, _step, gathered)

    parts = {"skipped": F.lit(0), "path": F.array(), "tag": F.lit(""), "parts": F.array(), "slices": F.array()}
    start = F.struct(*[c.alias(n) for n, c in parts.items()]).cast(f"struct<{_STATE},slices:array<{_BLOCKS}>>")
    return F.aggregate(F.sequence(F.lit(0), F.floor((F.greatest(F.size(found), F.lit(1)) - 1) / SLICE).cast("int")), start, over_slice)


def _finish(state: Column) -> Column:
    """Blocks of the last state, with the one that the page's end closes."""
    last = F.struct(_inside(state["path"]).alias("in_container"), F.array_join(state["parts"], " ").alias("text"))
    read = F.flatten(state["slices"])
    return F.when(state["tag"] != "", F.concat(read, F.array(last))).otherwise(read)


def page_error(html: Column, found: Column) -> Column:
    """Why a page has no text to read: nothing landed, no markup in it, no block of text; else null."""
    text = F.coalesce(html, F.lit(""))
    return (
        F.when(~text.rlike(r"\S"), "no_page")
        .when(~F.exists(found, lambda e: e["kind"] != TEXT), "no_markup")
        .when(~F.exists(found, lambda e: (e["kind"] == OPEN) & e["tag"].isin(*lexicon.BLOCK_TAGS)), "no_blocks")
    )


def with_blocks(pages: DataFrame, html: str, blocks: str = "blocks", error: str = "error") -> DataFrame:
    """Adds ``blocks``, ``array<struct<pos, in_container, block>>``, and ``error``, why there is none to read (else null).

    A block is the text from an opening block tag to its closing one.  One in which another opens is lost;
    skipped elements have no text; it is in a container if one is open where it closes.  Arrays that
    every event is held against are columns of their own, so each is made once for a page.
    """
    rows = once(pages, {"_events": events(F.col(html))})
    rows = rows.withColumn(error, page_error(F.col(html), F.col("_events")))
    rows = once(rows, {"_opened": _named(F.col("_events"), OPEN), "_closed": _named(F.col("_events"), CLOSE)})
    decisive = F.filter("_events", lambda e: _decides(e, F.col("_opened"), F.col("_closed")))
    rows = once(rows, {"_events": decisive}).drop("_opened", "_closed")
    rows = once(rows, {"_state": _folded(F.col("_events"))}).drop("_events")
    clean = F.transform(_finish(F.col("_state")), lambda b: F.struct(b["in_container"].alias("in_container"), plain_spacing(b["text"]).alias("block")))
    rows = once(rows, {"_clean": F.filter(clean, lambda b: b["block"] != "")}).drop("_state")
    numbered = F.transform("_clean", lambda b, i: F.struct(i.alias("pos"), b["in_container"].alias("in_container"), b["block"].alias("block")))
    return rows.withColumn(blocks, numbered).drop("_clean")
