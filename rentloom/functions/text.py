"""Text to typed values.

All helpers return NULL for NULL input and never throw on odd text, so they are
safe under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentloom import fixed_values as fixed


def parse_number(text: Column) -> Column:
    """First number in the text as a double; NULL if there is none."""
    # '' where there is no number; that casts to NULL.
    digits = F.regexp_extract(text, fixed.NUMBER, 0)
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("double")


def extract(text: Column, pattern: str) -> Column:
    """First match of the pattern, NULL without a match."""
    return F.regexp_substr(text, F.lit(pattern))


def number_in(text: Column, pattern: str) -> Column:
    """First number of the first match of the pattern."""
    return parse_number(F.regexp_extract(text, pattern, 0))


def replace_first(text: Column, pattern: str, replacement: str = "") -> Column:
    """Change the first match only; the replacement is taken literally."""
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, f"(?s:^(?<lead>.*?))(?:{pattern})", "${lead}" + literal)


def replace_first_text(text: Column, part: str, replacement: str = "") -> Column:
    """The same for plain text: split once there and join again."""
    return F.array_join(F.split(text, rf"\Q{part}\E", 2), replacement)


def cut_first(text: Column, part: Column) -> Column:
    """Cut the first occurrence of another column's value, read as plain text.

    Both are mentioned several times, so pass plain columns.
    """
    at = F.position(part, text)
    return F.when(
        at > 0,
        F.concat(F.substring(text, F.lit(1), at - 1),
                 F.substring(text, at + F.length(part), F.length(text))),
    ).when(at == 0, text)


def replace_all(text: Column, pattern: str, replacement: str = "") -> Column:
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, pattern, literal)


def piece_or_empty(text: Column, pattern: str, count: int, k: int) -> Column:
    """k-th (from 1) of at most `count` pieces, '' where the text has fewer."""
    found = F.try_element_at(F.split(text, pattern, count), F.lit(k))
    return F.when(text.isNotNull(), F.coalesce(found, F.lit("")))


def piece(text: Column, pattern: str, k: int, count: int = -1) -> Column:
    """k-th (from 1) of all, or at most `count`, pieces; NULL where the text has fewer."""
    return F.try_element_at(F.split(text, pattern, count), F.lit(k))


def trim_space(text: Column) -> Column:
    """Strip every kind of white space, newlines included, from both ends."""
    return F.btrim(text, F.lit(fixed.BLANKS))


def one_line(text: Column) -> Column:
    return trim_space(F.replace(text, F.lit("\n"), F.lit(" ")))


def pad_left(text: Column, width: int, pad: str) -> Column:
    """Fill up to the width; longer text stays whole."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(pad))


def joined(sep: str, *parts: Column, spell_missing: bool = True) -> Column:
    """Join texts; a missing part is spelled 'NA' or, on request, left out."""
    if spell_missing:
        parts = tuple(F.coalesce(p, F.lit("NA")) for p in parts)
    return F.concat_ws(sep, *parts)


def code_text(number: Column) -> Column:
    """Number as text, a whole one without a decimal point."""
    return F.regexp_replace(number.cast("string"), r"\.0$", "")


def studio_as_zero(text: Column) -> Column:
    return replace_first_text(text, "Studio", "0")


def scaled_rent(text: Column, suffix_only: bool = False, scale_millions: bool = False) -> Column:
    """Rent with an optional thousands letter.

    By default a K anywhere multiplies by 1000 and an M is dropped without
    scaling. `suffix_only` wants the letter right behind a digit,
    `scale_millions` also multiplies by a million for M.
    """
    before = "(?<=[0-9])" if suffix_only else ""
    factor = F.when(text.rlike(before + "K"), F.lit(1000.0))
    if scale_millions:
        factor = factor.when(text.rlike(before + "M"), F.lit(1000000.0))
    return factor.otherwise(F.lit(1.0)) * parse_number(replace_first(text, "K|M"))


def bedroom_class(beds: Column) -> Column:
    """'0' to '3', '4+', or NULL for halves and negatives."""
    out = F.when(beds >= 4, F.lit("4+"))
    for n in range(4):
        out = out.when(beds == n, F.lit(str(n)))
    return out


def drop_unit(address: Column) -> Column:
    """Cut what follows '#' or 'UNIT' up to the comma, once each."""
    for tail in (fixed.AFTER_HASH, fixed.AFTER_UNIT):
        address = replace_first(address, tail, ",")
    return replace_all(address, fixed.UNIT_LEFTOVER)


def zip5(text: Column) -> Column:
    return F.substring(extract(text, fixed.ZIP), 1, 5)


def with_short_zip(text: Column) -> Column:
    """Shorten the first ZIP+4 to its five digits; text without a ZIP stays as it is."""
    replacement = F.concat(F.lit("${lead}"), zip5(text))
    short = F.regexp_replace(text, F.lit(f"(?s:^(?<lead>.*?))(?:{fixed.ZIP})"), replacement)
    return F.coalesce(short, text)
