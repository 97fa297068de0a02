"""JVM-side readings of simple HTML, for pages whose markup is regular.

The general extractor is :mod:`newsloom.operators.extract`; these expressions
cover the common fields without leaving the engine.
"""

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, bind, strip

_HIDDEN = r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>"
_COMMENT = r"(?s)<!--.*?-->"
_TAG = r"(?s)<[!/?a-zA-Z][^>]*>"


_ENTITY = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"
#: What Unicode leaves open among the numeric references: none, surrogates, beyond the last code point.
_UNKNOWN = "\ufffd"


#: Names that nearly all references of real pages are among; they are looked up first.
_COMMON = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "mdash;", "ndash;", "rsquo;", "lsquo;", "rdquo;", "ldquo;", "hellip;")


@lru_cache(maxsize=1)
def _names_json() -> str:
    return json.dumps(html5, sort_keys=True)


def _named(name: Column) -> Column:
    """Sign of an entity name, as HTML 5 defines it; from Python's own table, which is one literal of the plan."""
    few = F.create_map(*[F.lit(x) for n in _COMMON for x in (n, html5[n])])
    every = F.from_json(F.lit(_names_json()), "map<string,string>")
    return F.coalesce(F.try_element_at(few, name), F.try_element_at(every, name))


def _old_numbers() -> dict[int, str]:
    """References 128 to 159 mean the Windows code page, where it has a sign."""
    return {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}


def _decoded(entity: Column) -> Column:
    hexadecimal = F.regexp_extract(entity, r"^&#[xX]0*([0-9a-fA-F]{1,8});?$", 1)
    decimal = F.regexp_extract(entity, r"^&#0*([0-9]{1,10});?$", 1)
    number = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).otherwise(F.nullif(decimal, F.lit(""))).cast("bigint")

    def sign(n: Column) -> Column:
        char = F.decode(F.unhex(F.lpad(F.hex(n), F.lit(8), F.lit("0"))), "UTF-32")
        valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        old = F.create_map(*[F.lit(x) for pair in _old_numbers().items() for x in pair])
        return F.when(n.between(128, 159), F.try_element_at(old, n.cast("int"))).when(valid, char).otherwise(F.lit(_UNKNOWN))

    name = F.substring(entity, F.lit(2), F.length(entity))
    return F.when(
        F.substring(entity, F.lit(2), F.lit(1)) == "#", F.coalesce(bind(number, sign), F.lit(_UNKNOWN))
    ).otherwise(F.coalesce(_named(name), entity))


def unescape(c) -> Column:
    """Decode numeric and named character references.

    As in browsers, the old names also count without their semicolon.
    """
    text = as_col(c)
    found = F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), _decoded)
    between = F.split(text, _ENTITY, -1)
    joined = F.array_join(
        F.transform(F.arrays_zip(between.alias("a"), found.alias("b")), lambda p: F.concat(p["a"], F.coalesce(p["b"], F.lit("")))),
        "",
    )
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def page_title(html) -> Column:
    return strip(unescape(F.regexp_extract(as_col(html), r"(?is)<title[^>]*>(.*?)</title\s*>", 1)))


def body_fragment(html) -> Column:
    """Inner HTML of the first ``<article>``, with articles inside it; empty when there is none.

    An article that is not closed reaches to the end of the page.
    """
    rest = F.regexp_extract(as_col(html), r"(?is)<article\b[^>]*>(.*)\z", 1)

    def closed(parts: Column) -> Column:
        """Parts up to the closing tag at which as many articles were closed as opened."""
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("used"))

        def step(state: Column, part: Column) -> Column:
            depth = state["depth"] + F.regexp_count(part, F.lit(r"(?i)<article\b")) - 1
            done = state["depth"] == 0
            return F.struct(
                F.when(done, F.lit(0)).otherwise(depth).alias("depth"),
                F.when(done, state["used"]).otherwise(state["used"] + 1).alias("used"),
            )

        used = F.aggregate(parts, start, step, lambda state: state["used"])
        return F.array_join(F.slice(parts, F.lit(1), used), "</article>")

    return bind(F.split(rest, r"(?i)</article\s*>", -1), closed)


def visible_text(html, separator: str = "\n") -> Column:
    """Text pieces between tags, each trimmed, empties dropped, then joined."""
    shown = F.regexp_replace(as_col(html), _HIDDEN, "<br>")
    shown = F.regexp_replace(shown, _COMMENT, "<br>")
    pieces = F.transform(F.split(shown, _TAG), lambda x: strip(unescape(x)))
    return F.array_join(F.filter(pieces, lambda x: x != ""), separator)
