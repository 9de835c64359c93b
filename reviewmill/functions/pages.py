"""Page addresses and page text."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.text import once, trim_ws
from reviewmill.lexicons import BINARY_EXTENSIONS, COOKIE_PHRASES, DROPPED_TAGS, ERROR_PHRASES

# Names of elements that speak of a cookie, consent or banner.
_NOTICE_NAME = r"(?=[a-z])[\w:.-]*(?:cookie|consent|banner)[\w:.-]*"
# Line ends that a line splitter honours.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_body(c) -> Column:
    """Bytes to text, bytes that are not UTF-8 dropped."""
    return F.translate(F.make_valid_utf8(_col(c).cast("string")), "�", "")


def site_root(c) -> Column:
    """Scheme and authority of an address, port kept."""
    return F.concat(
        F.try_parse_url(_col(c), F.lit("PROTOCOL")),
        F.lit("://"),
        F.try_parse_url(_col(c), F.lit("AUTHORITY")),
    )


def is_binary_url(c) -> Column:
    path = F.lower(F.regexp_replace(_col(c), r"[?#][^\n]*$", ""))
    endings = "|".join(e.replace(".", r"\.") for e in BINARY_EXTENSIONS)
    return path.rlike(rf"(?:{endings})$")


@cache
def _named() -> dict[str, str]:
    """Characters by entity name, from the table of the language's own library; a name that
    may stand without its semicolon is there both ways."""
    return dict(html5)


def _numbered(n: Column) -> Column:
    """The character of a number; numbers of no character give U+FFFD, 128 to 159 are read as cp1252."""
    low = [bytes([i]).decode("cp1252", "replace") for i in range(128, 160)]
    wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    none = (n <= 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    old = F.get(F.array(*[F.lit(c) for c in low]), (n - 128).cast("int"))
    return F.when(n.isNull() | none, F.lit("\ufffd")).when(n.between(128, 159), old).otherwise(wide)


def unescape(c) -> Column:
    """Character references to characters, in one pass: names, decimal and hexadecimal numbers.

    A name that is not known stays as it is; old names need no semicolon where
    no letter or digit follows.
    """
    number = r"&#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
    reference = rf"{number}|&[A-Za-z][A-Za-z0-9]*;?"

    def char(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"&#([0-9]+)", 1)
        hexes = F.regexp_extract(ref, r"&#[xX]([0-9a-fA-F]+)", 1)
        # numbers of more than ten digits are beyond the last character
        short = lambda d: F.when(F.length(d) <= 10, d).otherwise(F.lit("9999999999"))
        value = F.when(digits != "", short(F.ltrim(digits, F.lit("0"))).try_cast("bigint")).otherwise(
            F.conv(F.right(F.concat(F.lit("0"), hexes), F.lit(9)), 16, 10).cast("bigint")
        )
        table = F.create_map(*[F.lit(x) for pair in _named().items() for x in pair])
        named = F.try_element_at(table, F.substring(ref, F.lit(2), F.length(ref)))
        return F.when(F.startswith(ref, F.lit("&#")), _numbered(value)).otherwise(F.coalesce(named, ref))

    def replaced(t: Column) -> Column:
        texts, refs = F.split(t, reference), F.regexp_extract_all(t, F.lit(f"({reference})"), F.lit(1))
        chars = F.concat(F.transform(refs, char), F.array(F.lit("")))
        return F.when(t.rlike(reference), F.array_join(F.zip_with(texts, chars, lambda x, y: F.concat(x, y)), "")).otherwise(t)

    return once(_col(c), replaced)


def _tag(names: str, slash: str = "/?") -> str:
    return rf"(?i)<{slash}(?:{names})(?:[\s/][^>]*)?>"


def _ends(names: str, text: Column) -> Column:
    """Per tag of ``names`` in order: "/" for an end tag, nothing for a start tag."""
    return F.regexp_extract_all(text, F.lit(_tag(names, "(/?)")), F.lit(1))


def without(text: Column, names: str) -> Column:
    """``text`` without the elements ``names`` (a pattern), nested ones and unclosed rests included."""

    def kept(t: Column) -> Column:
        parts = F.struct(_ends(names, t).alias("ends"), F.split(t, _tag(names)).alias("texts"))
        start = lambda p: F.struct(F.lit(0).alias("depth"), p["texts"][0].alias("out"))

        def step(p: Column, s: Column, i: Column) -> Column:
            depth = F.when(p["ends"][i] == "", s["depth"] + 1).otherwise(F.greatest(s["depth"] - 1, F.lit(0)))
            return once(depth, lambda d: F.struct(
                d.alias("depth"), F.when(d == 0, F.concat(s["out"], F.lit("\n"), p["texts"][i + 1])).otherwise(s["out"]).alias("out")
            ))

        found = once(parts, lambda p: F.aggregate(
            F.sequence(F.lit(0), F.size(p["ends"]) - 1), start(p), lambda s, i: step(p, s, i), lambda s: s["out"]
        ))
        return F.when(t.rlike(_tag(names, "")), found).otherwise(t)

    return once(text, kept)


def inside(text: Column, start: str, name: str) -> Column:
    """The content of the first element whose start tag is ``start``, up to its own end tag; null if there is none."""

    def content(rest: Column) -> Column:
        state = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"))

        def step(s: Column, end: Column) -> Column:
            # once the element is closed nothing changes any more
            depth = s["depth"] + F.when(end == "", 1).otherwise(-1)
            return F.when(s["depth"] == 0, s).otherwise(F.struct(depth.alias("depth"), (s["seen"] + 1).alias("seen")))

        size = F.aggregate(_ends(name, rest), state, step, lambda s: F.when(s["depth"] == 0, s["seen"]).otherwise(s["seen"] + 1))
        return F.array_join(F.slice(F.split(rest, _tag(name)), F.lit(1), size), "\n")

    after = F.regexp_extract(text, rf"(?s){start}(.*)", 1)
    return F.when(text.rlike(start), once(after, content))


def html_main_text(c) -> Column:
    """Text of the main part of a page, one text node per line.

    Comments, seven element kinds and elements whose *name* speaks of a cookie,
    consent or banner go first.  The root is the first of main, article,
    ``div#content`` and body, up to the end tag that closes it, whatever is
    nested in it; an element that is never closed lasts to the end of the page.
    An end tag of another kind closes nothing, and ``>`` inside an attribute
    ends its tag.
    """
    html = F.regexp_replace(_col(c), r"(?s)<!--.*?(?:-->|\z)", "")
    for tag in DROPPED_TAGS[:2]:  # their content is no markup
        html = F.regexp_replace(html, rf"(?is)<{tag}(?:[\s/][^>]*)?>.*?(?:</{tag}\s*>|\z)", "\n")
    for names in [*DROPPED_TAGS[2:], _NOTICE_NAME]:
        html = without(html, names)
    content = r"(?i)<div(?:\s[^>]*)?\sid\s*=\s*(?:\"content\"|'content'|content(?=[\s>]))[^>]*>"
    root = once(html, lambda h: F.coalesce(
        inside(h, _tag("main", ""), "main"), inside(h, _tag("article", ""), "article"), inside(h, content, "div"),
        inside(h, _tag("body", ""), "body"), F.lit(""),
    ))
    return unescape(F.regexp_replace(root, r"(?s)<[^>]+>", "\n"))


def _holds_any(text: Column, phrases: list[str]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | text.contains(phrase)
    return found


def keep_lines(c) -> Column:
    """Lines longer than 50 characters that are not cookie notices."""
    lines = F.transform(F.split(_col(c), LINE_ENDS), trim_ws)
    kept = F.filter(
        lines, lambda x: (F.length(x) > 50) & ~_holds_any(F.lower(x), COOKIE_PHRASES)
    )
    return F.array_join(kept, "\n")


def is_accepted(c) -> Column:
    """At least 200 characters and none of the error phrases."""
    text = _col(c)
    return (F.length(text) >= 200) & ~_holds_any(F.lower(text), ERROR_PHRASES)
