"""Text expressions: list-literal parsing, stripping, fixed-width formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading/trailing whitespace as Python's str.strip() sees it: Unicode
# white space plus the four information separators U+001C..U+001F.
_EDGE_SPACE = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()``: remove leading and trailing (Unicode) white space."""
    return F.regexp_replace(_c(col), _EDGE_SPACE, "")


# One quoted string of a list literal, and a list of them (adjacent strings join, one trailing comma is allowed).
_STR = r"""(?:'(?:[^'\\\n]|\\.)*+'|"(?:[^"\\\n]|\\.)*+")"""
_ELEM = rf"(?:{_STR}\s*)++"
_LIST = rf"^\s*\[\s*(?:{_ELEM}(?:,\s*{_ELEM})*+(?:,\s*)?)?\]\s*$"


# An escape that is cut short or beyond the last code point: such a literal is none.
_BAD_ESCAPE = (r"(?<!\\)(?:\\\\)*\\(?:x(?![0-9a-fA-F]{2})|u(?![0-9a-fA-F]{4})"
               r"|U(?!(?:000[0-9a-fA-F]|0010)[0-9a-fA-F]{4}))")


def _unescape(s: Column) -> Column:
    """The text of a string literal's inside: hexadecimal, octal and letter escapes, others stay as they are.

    The inside is cut before every escape; the cuts depend on whole escapes, so
    a doubled backslash never joins the characters after it.  A surrogate is no
    character and becomes U+FFFD; characters by name stay as they are.
    """
    parts = F.regexp_extract_all(s, F.lit(
        r"(?s)(\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|\\.|[^\\]+)"), 1)

    def one(x):
        code = F.when(x.rlike(r"^\\x"), F.conv(F.substring(x, 3, 2), 16, 10)).when(
            x.rlike(r"^\\U"), F.conv(F.substring(x, 3, 8), 16, 10)).when(
            x.rlike(r"^\\u[0-9a-fA-F]{4}$"), F.conv(F.substring(x, 3, 4), 16, 10)).when(
            x.rlike(r"^\\[0-7]"), F.conv(F.substring(x, 2, 3), 8, 10)).cast("int")
        code = F.when(code.between(0xD800, 0xDFFF), F.lit(0xFFFD)).otherwise(code)
        # a code point as text, by way of its UTF-32 form after a byte order mark
        char = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(code), 8, "0"))), "UTF-32")
        letters = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\\": "\\", "'": "'", '"': '"'}
        out = F.when(code.isNotNull(), char)
        for k, v in letters.items():
            out = out.when(x == F.lit("\\" + k), F.lit(v))
        return out.when(x == F.lit("\\\n"), F.lit("")).otherwise(x)

    return F.array_join(F.transform(parts, one), "")


def _unescaped(s: Column) -> Column:
    return F.when(F.contains(s, F.lit("\\")), _unescape(s)).otherwise(s)


def main_artist(col) -> Column:
    """First element of a Python list literal, stripped.

    ``['A', 'B']`` -> ``A``; a quoted scalar ``'solo'`` -> ``solo``; adjacent
    strings join; an empty first element stays ``''``.  An empty list, anything
    that is no list of strings as a whole (trailing text, nested lists, other
    literals, a broken escape) and null give null.
    """
    s = _c(col)
    whole = s.rlike(_LIST) | s.rlike(rf"^\s*{_ELEM}$")
    first = F.regexp_extract(s, rf"^\s*\[?\s*({_ELEM})", 1)
    pieces = F.regexp_extract_all(first, F.lit(rf"({_STR})"), 1)
    text = F.array_join(F.transform(pieces, lambda x: _unescaped(F.substr(x, F.lit(2), F.length(x) - 2))), "")
    # escapes are looked at only where there is a backslash: they cost many times the rest
    return F.when(whole & (F.size(pieces) > 0) & (~F.contains(s, F.lit("\\")) | ~s.rlike(_BAD_ESCAPE)), py_strip(text))


def clip_text(col, width: int, default: str = "N/A") -> Column:
    """``coalesce(col, default)[:width]``."""
    return F.substring(F.coalesce(_c(col).cast("string"), F.lit(default)), 1, width)


def decimal_text(col, decimals: int = 4, from_decimals: int = 6) -> Column:
    """Fixed-decimal text of a value already rounded to ``from_decimals``, rounding
    half away from zero on its integer scaled form (engine-independent)."""
    c = _c(col).cast("double")
    scaled = F.round(F.abs(c) * F.lit(10.0 ** from_decimals)).cast("long")
    step = 10 ** (from_decimals - decimals)
    q = ((scaled + F.lit(step // 2)) / F.lit(step)).cast("long")
    unit = F.lit(10 ** decimals)
    body = F.concat((q / unit).cast("long").cast("string"), F.lit("."),
                    F.lpad(F.pmod(q, unit).cast("string"), decimals, "0"))
    return F.concat(F.when((c < 0) & (q > 0), F.lit("-")).otherwise(F.lit("")), body)


def fixed_width_line(rank, name, score, name_width: int = 50) -> Column:
    """``f"{rank:2d}. {name:<50} {score:.4f}"`` as a Spark expression."""
    r = _c(rank).cast("string")
    r = F.when(F.length(r) < 2, F.lpad(r, 2, " ")).otherwise(r)
    n = F.coalesce(_c(name), F.lit(""))
    n = F.when(F.length(n) < name_width, F.rpad(n, name_width, " ")).otherwise(n)
    return F.concat(r, F.lit(". "), n, F.lit(" "), decimal_text(score))
