"""Text normalisation and token helpers (Column in, Column out, JVM side).

Patterns say ``[^\\n]`` instead of ``.`` because Java's dot excludes more line
ends than a newline, and use ``(?U)`` so that whitespace is Unicode whitespace.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.lexicons import EMOJI_GENDERS, EMOJI_PEOPLE, EMOJI_RANGES, EMOJI_ROLES, SKIN_TONES, emoji_names

# Unicode White_Space plus the four ASCII separators that also count as blanks.
WS = r"[\s\x1c-\x1f]"
NOT_WS = r"[^\s\x1c-\x1f]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed a single time, however often
    ``fn`` refers to it."""
    return F.transform(F.array(value), fn)[0]


def norm_case(c) -> Column:
    """Lower-case; null becomes the empty string."""
    return F.lower(F.coalesce(_col(c), F.lit("")))


def strip_urls(c) -> Column:
    return F.regexp_replace(_col(c), rf"(?U)https?://{NOT_WS}+|www\.{NOT_WS}+", "")


def strip_tags(c) -> Column:
    return F.regexp_replace(_col(c), r"<[^\n]*?>", "")


def squeeze(c) -> Column:
    """Runs of three or more equal characters become two."""
    return F.regexp_replace(_col(c), r"([^\n])\1{2,}", "$1$1")


_JOINER, _PICTURE = "\u200d", "\ufe0f"
_LETTERS = "".join(chr(c) for c in range(0x1F1E6, 0x1F200))


def _emoji_pattern(names: dict[str, str]) -> str:
    """One whole emoji: a table entry that is no picture, a keycap, a flag, or pictures with tones, joined or not."""
    ranges = [(int(a, 16), int(b or a, 16)) for a, _, b in (r.partition("-") for r in EMOJI_RANGES.split())]
    one = "[" + "".join(rf"\x{{{a:x}}}" + (rf"-\x{{{b:x}}}" if b > a else "") for a, b in ranges) + "]"
    tone = r"[\x{1f3fb}-\x{1f3ff}]"
    picture = rf"{one}\x{{fe0f}}?{tone}?"
    others = (k for k in names if _JOINER not in k and not (len(k) == 1 and any(a <= ord(k) <= b for a, b in ranges)))
    own = "".join(re.escape(k) + "|" for k in sorted(others, key=len, reverse=True))
    # the look ahead spares ordinary letters the walk through all ranges
    return (
        rf"{own}[0-9#*]\x{{fe0f}}?\x{{20e3}}|(?=[\x{{a9}}\x{{ae}}\x{{203c}}-\x{{1faff}}])"
        rf"(?:[\x{{1f1e6}}-\x{{1f1ff}}]{{2}}|{picture}(?:\x{{200d}}{picture})*|{tone})"
    )


def _literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _emoji_name(emoji: Column, names: dict[str, str]) -> Column:
    """``:name:`` of a whole emoji; parts that have no name stay as they are."""
    table, tones, roles = _literal_map(names), _literal_map(SKIN_TONES), _literal_map(EMOJI_ROLES)
    people, genders = _literal_map(EMOJI_PEOPLE), _literal_map(EMOJI_GENDERS)
    named = lambda t, key: F.try_element_at(t, key)
    base = lambda p: F.substring(p, 1, 1)
    coded = lambda n: F.concat(F.lit(":"), n, F.lit(":"))

    def toned(name: Column, part: Column) -> Column:
        tone = named(tones, F.substring(part, 2, 1))
        return coded(F.concat(name, F.coalesce(F.concat(F.lit("_"), tone), F.lit(""))))

    def of_parts(parts: Column) -> Column:
        first, second = parts[0], F.get(parts, F.lit(1))
        family = (F.size(parts) > 1) & F.forall(parts, lambda p: named(people, p).isNotNull())
        together = F.concat(F.lit("family_"), F.array_join(F.transform(parts, lambda p: named(people, p)), "_"))
        acting = F.concat(named(genders, base(second)), F.lit("_"), F.regexp_replace(named(table, base(first)), "^person_", ""))
        working = F.concat(named(people, base(first)), F.lit("_"), named(roles, base(second)))
        each = F.transform(parts, lambda p: F.coalesce(toned(F.coalesce(named(table, base(p)), named(tones, base(p))), p), p))
        return F.coalesce(F.when(family, coded(together)), toned(acting, first), toned(working, first), F.array_join(each, ""))

    plain = F.replace(emoji, F.lit(_PICTURE), F.lit(""))
    flag = F.concat(F.lit("flag_"), F.translate(plain, _LETTERS, "abcdefghijklmnopqrstuvwxyz"))
    return F.coalesce(
        coded(named(table, plain)),
        F.when(plain.rlike(r"^[\x{1f1e6}-\x{1f1ff}]"), coded(flag)),
        F.when(plain.rlike(r"\x{20e3}$"), coded(F.concat(F.lit("keycap_"), base(plain)))),
        once(F.split(plain, _JOINER), of_parts),
    )


def verbalize_emoji(c, names: dict[str, str] | None = None) -> Column:
    """Emoji become ``[name] ``; a literal ``:word:`` in the text does as well.

    An emoji is taken whole: flags are named by their two letters, pictures with
    a skin tone by both, joined ones by their own name, their role or their
    family.  Texts without any emoji are left alone.
    """
    names = emoji_names() if names is None else names
    text = _col(c)
    if names:
        pattern = _emoji_pattern(names)

        def spelled(t: Column) -> Column:
            # each different emoji of the text is named once
            def named(every: Column) -> Column:
                return once(F.array_distinct(every), lambda d: once(
                    F.transform(d, lambda e: _emoji_name(e, names)),
                    lambda n: F.transform(every, lambda e: F.element_at(n, F.array_position(d, e).cast("int"))),
                ))

            found = once(F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(1)), named)
            both = F.zip_with(F.split(t, pattern), F.concat(found, F.array(F.lit(""))), lambda x, y: F.concat(x, y))
            return F.when(t.rlike(pattern), F.array_join(both, "")).otherwise(t)

        text = once(text, spelled)
    return F.regexp_replace(text, r":([a-z_]+):", r"[$1] ")


def underscores(c) -> Column:
    return F.translate(_col(c), "_", " ")


def trim_ws(c) -> Column:
    return F.regexp_replace(_col(c), rf"(?U)^{WS}+|{WS}+\z", "")


def squash_ws(c) -> Column:
    """Collapse whitespace runs to one blank and trim both ends."""
    return F.trim(F.regexp_replace(_col(c), rf"(?U){WS}+", " "))


def squash_punct(c) -> Column:
    """Runs of ``! ? .`` become the last mark of the run."""
    return F.regexp_replace(_col(c), r"([!?.]){2,}", "$1")


def ascii_only(c) -> Column:
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "")


def clean_core(c, names: dict[str, str] | None = None) -> Column:
    """The normalisation chain up to (not including) token repair."""
    text = strip_tags(strip_urls(norm_case(c)))
    text = underscores(verbalize_emoji(squeeze(text), names))
    return ascii_only(squash_punct(squash_ws(text)))


def tokens(c) -> Column:
    """Whitespace tokens in order, no empty strings."""
    return F.filter(F.split(_col(c), rf"(?U){WS}+"), lambda t: t != "")


def token_prefix(c) -> Column:
    return F.regexp_extract(_col(c), r"(?U)^(\W*)", 1)


def token_suffix(c) -> Column:
    """Trailing non-word run; the whole token when it has no word character."""
    return F.regexp_extract(_col(c), r"(?U)(\W*)\z", 1)


def token_core(c) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^\W+|\W+\z", "")


def token_parts(c) -> Column:
    return F.struct(
        token_prefix(c).alias("prefix"),
        token_core(c).alias("core"),
        token_suffix(c).alias("suffix"),
    )


def keeps_token(t: Column) -> Column:
    """A token stays when it has a word character or is wrapped in brackets."""
    return t.rlike(r"(?U)\w") | (t.startswith("[") & t.endswith("]"))


def drop_punct_tokens(c) -> Column:
    return F.array_join(F.filter(tokens(c), keeps_token), " ")


def shingles(c, k: int = 5) -> Column:
    """Distinct character k-grams; a text shorter than k is its own shingle.
    None begins within a character that Java holds as two.

    One lookahead regular-expression pass is linear in the text, where
    ``substring`` per position would be quadratic.
    """
    text = _col(c)
    grams = F.regexp_extract_all(text, F.lit(rf"(?s)(?![\x{{dc00}}-\x{{dfff}}])(?=(.{{{k}}}))"), F.lit(1))
    return F.when(F.length(text) < k, F.array(text)).otherwise(F.array_distinct(grams))


def word_set(c) -> Column:
    """Distinct whitespace tokens, case kept."""
    return F.array_distinct(tokens(c))


def overlap(a, b) -> Column:
    """Shared words over the size of the smaller set; 0.0 when it is empty."""
    left, right = word_set(a), word_set(b)
    smaller = F.least(F.size(left), F.size(right))
    shared = F.size(F.array_intersect(left, right))
    return F.when(smaller == 0, F.lit(0.0)).otherwise(shared / smaller)


def keyword_pattern(keyword: str) -> str:
    escaped = "".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in keyword)
    return rf"(?U)\b{escaped}\b"


def count_keyword(c, keyword: str) -> Column:
    """Whole-word occurrences of a keyword in the lower-cased text."""
    return F.regexp_count(F.lower(_col(c)), F.lit(keyword_pattern(keyword)))


def nonblank(c) -> Column:
    """True when the text has anything but whitespace."""
    return _col(c).rlike(rf"(?U){NOT_WS}")


def slug(c) -> Column:
    return F.translate(F.lower(_col(c)), " ", "_")


def ids_json(c) -> Column:
    return F.to_json(_col(c))


def list_text(c) -> Column:
    return F.array_join(_col(c), ", ")
