"""String helpers with Python ``str`` semantics, as native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character for which Python's str.isspace() is true,
# i.e. what str.strip() without arguments removes (Python 3 definition).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The line boundaries of Python's str.splitlines().
PY_LINE_BREAK_RE = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

def _decimal_digits() -> tuple[str, str]:
    import unicodedata
    src, dst = [], []
    for cp in range(0x80, 0x110000):
        d = unicodedata.decimal(chr(cp), None)
        if d is not None:
            src.append(chr(cp))
            dst.append(str(d))
    return "".join(src), "".join(dst)


# Every non-ASCII Unicode decimal digit and its ASCII digit (Python's int()
# and float() accept them), generated from the Unicode database.
UNICODE_DIGITS, ASCII_DIGITS = _decimal_digits()

# Truthy spellings accepted for boolean inventory fields.
TRUTHY = ("true", "1", "yes", "y")

# Html.escape(quote=True) replacements, '&' first.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove Unicode whitespace from both ends.

    ``trim`` alone removes only spaces, so the full set is passed to btrim.
    """
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def blank_to_null(c) -> Column:
    """NULL when the stripped value is empty, else the stripped value."""
    s = py_strip(c)
    return F.when(s != "", s)


def safe_str(c) -> Column:
    """None -> '' else the stripped string."""
    return F.coalesce(py_strip(_col(c).cast("string")), F.lit(""))


def is_truthy(c) -> Column:
    """strip + lower in {true, 1, yes, y}; NULL counts as false."""
    return F.coalesce(F.lower(py_strip(_col(c).cast("string"))).isin(*TRUTHY), F.lit(False))


# Python float() grammar: optional sign, then inf/infinity/nan or a decimal
# literal with optional underscores between digits and an optional exponent.
_FLOAT_RE = (
    r"(?i)^[+-]?(inf|infinity|nan|"
    r"([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)(e[+-]?[0-9](_?[0-9])*)?)$"
)


def ascii_digits(c) -> Column:
    """Unicode decimal digits -> ASCII digits."""
    return F.translate(_col(c), UNICODE_DIGITS, ASCII_DIGITS)


def safe_float(c, default: float | None = 0.0) -> Column:
    """``float(value)`` or ``default`` when Python would raise.

    Spark's cast also accepts forms like ``1d``/``0.5f`` and rejects ``1_000``
    and non-ASCII digits; the grammar check and the digit mapping make the
    result follow Python.
    """
    s = ascii_digits(py_strip(_col(c).cast("string")))
    low = F.lower(s)
    # signed nan/inf words are read by Python but not by Spark's cast
    special = (F.when(low.rlike("^[+-]?nan$"), F.lit(float("nan")))
               .when(low.rlike("^[+]?inf(inity)?$"), F.lit(float("inf")))
               .when(low.rlike("^-inf(inity)?$"), F.lit(float("-inf"))))
    parsed = F.coalesce(special, F.when(s.rlike(_FLOAT_RE), F.regexp_replace(s, "_", "").try_cast("double")))
    if default is None:
        return parsed
    return F.coalesce(parsed, F.lit(float(default)))


def split_lines(c) -> Column:
    """``str.splitlines()`` for text without a trailing line break."""
    return F.split(_col(c), PY_LINE_BREAK_RE)


def html_escape(c) -> Column:
    out = _col(c)
    for raw, escaped in HTML_ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def strip_code_fences(c) -> Column:
    """Drop a leading fenced line and a trailing fenced line (P25).

    Column form for one-off use; ``replies.with_fences_stripped`` is the
    DataFrame form used in jobs.
    """
    def body(s: Column) -> Column:
        rest = F.slice(split_lines(s), 2, 1 << 30)
        drop_last = (F.size(rest) > 0) & F.startswith(py_strip(F.element_at(rest, -1)), F.lit("```"))
        kept = F.when(drop_last, F.slice(rest, 1, F.greatest(F.size(rest) - 1, F.lit(0)))).otherwise(rest)
        return F.when(F.startswith(s, F.lit("```")), py_strip(F.array_join(kept, "\n"))).otherwise(s)
    return F.element_at(F.transform(F.array(py_strip(c)), body), 1)
