"""HTML body -> plain text (P18), as native Spark expressions.

The rules follow an HTML parser that only collects character data:

* ``<script>`` and ``<style>`` contents are raw text: kept as they are,
  tags and entities inside them included;
* elsewhere comments and tags are dropped, a newline is written for each
  line-breaking tag (start tags br p div li tr, end tags p div li tr; a tag
  closed by ``/>`` is a start and an end tag), and character references are
  decoded: every HTML5 named reference written with ``;``, the old ones
  without it too, and decimal/hex numeric references;
* runs of 3+ newlines become 2 and the result is stripped.

The named-reference table and the invalid numeric reference rules are
taken from Python's ``html`` module at import time, so they are the same
tables Python's parser uses. As in a parser that is fed the text and not
closed, what may go on is held back and leaves nothing: comments, raw elements
and tags that are not closed, a last ``<``, and text after the last markup (or
``<``) if a reference that is not finished stands at its end.
"""

from __future__ import annotations

import html as _stdlib_html

from pyspark.sql import Column, functions as F

from vellum.functions.text import _col, py_strip

# Patterns of the SQL oracle, which removes one kind of markup after the other.
RAW_ELEMENT_RE = (r"(?is)<script\b[^>]*>(.*?)</script(?:[\t\n\r\f /][^>]*)?>"
                  r"|<style\b[^>]*>(.*?)</style(?:[\t\n\r\f /][^>]*)?>")
COMMENT_RE = "(?s)<!--.*?-->"
CDATA_RE = "(?s)<!\\[CDATA\\[.*?\\]\\]>"
# An attribute value after its '=': only there a quote opens a value that may
# hold '>'. Possessive quantifiers keep the regex from backtracking (or
# recursing) on long tags.
_VALUE = r"""=++\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^>\s"'][^>\s]*+)?+"""
_TAG_REST = r"(?:[^>=]++|" + _VALUE + ")*+"
# The same of a tag that is not closed by '/>'.
_OPEN_REST = r"(?:[^>=/]++|/(?!>)|" + _VALUE + ")*+"
# All markup in one left-to-right alternation: whatever starts first takes all
# it holds, so a tag in a comment and a comment in a script stay what they are.
# Each kind ends at its own end or with the text. Group RAW_GROUP is the
# content of a closed raw-text element.
MARKUP_RE = (r"(?is)<(script|style)(?=[\s/>])" + _OPEN_REST + r">(?:(.*?)</\1(?:[\t\n\r\f /][^>]*+)?>|.*+)"
             r"|<!--.*?(?:--\s*>|\z)"
             r"|<!\[CDATA\[.*?(?:\]\]>|\z)"
             r"|<[!?/][^>]*+(?:>|\z)"
             r"|<[a-z][^\s/>]*+" + _TAG_REST + r"(?:>|\z)")
RAW_RE = r"(?is)^<(script|style)(?=[\s/>])" + _OPEN_REST + r">(?:(.*?)</\1(?:[\t\n\r\f /][^>]*+)?>|.*+)"
RAW_GROUP = 2
# Start tags br p div li tr and end tags p div li tr break lines.
BREAK_TAG_RE = r"(?i)^<(?:/(?:p|div|li|tr)[\s/>]|(?:p|div|li|tr|br)[\s/>]|/\s+(?:p|div|li|tr)\s*>)"
# Of those, the tags that '/>' may close as well, when it does not.
_STAYS_OPEN_RE = r"(?is)^<(?:p|div|li|tr)(?=[\s/>])" + _OPEN_REST + ">"
_MAY_CLOSE_RE = r"(?i)^<(?:p|div|li|tr)[\s/]"
# A reference that is not finished, in the last 34 characters; the whitespace
# of Python's patterns.
_SPACES = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNFINISHED_RE = "&[^<&;" + _SPACES + r"]{0,33}\z"
# Stands between text and markup; texts that hold it take a slower way.
_CUT = "\ufdd0"
BLANK_RUN_RE = "\n{3,}"
# A character reference as Python's unescape finds them: decimal or hex
# (';' optional), or up to 32 name characters (';' optional).
CHARREF_RE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names of references that may be written without ';' are at most this long.
LEGACY_NAME_MAX = 6
# Looked up first, ahead of the full table (the XML-predefined five and nbsp).
FREQUENT_REFERENCES = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")

# Tables of Python's html module (HTML5 named references; numeric references
# that map to another character or to nothing).
NAMED_REFERENCES = dict(_stdlib_html.entities.html5)
INVALID_CHARREFS = dict(_stdlib_html._invalid_charrefs)
INVALID_CODEPOINTS = sorted(_stdlib_html._invalid_codepoints)
MAX_CODEPOINT = 0x10FFFF
REPLACEMENT_CHAR = "�"


def _sql_string(value: str) -> str:
    """A Spark SQL string literal written with \\u escapes only (UTF-16 code
    units), so any character survives the parser unchanged."""
    units = value.encode("utf-16-be")
    return "'" + "".join("\\u%02x%02x" % (units[i], units[i + 1]) for i in range(0, len(units), 2)) + "'"


# The tables are parsed once per session from one SQL expression each
# (constant-folded into literals by the optimizer).
_TABLES: dict = {}


def _table(name: str) -> Column:
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    try:
        owner = session.sparkContext.applicationId
    except Exception:  # no SparkContext on this client: cache per session object
        owner = id(session)
    key = (name, owner)
    if key not in _TABLES:
        if name == "named":
            # names written with ';', indexed by their first character
            by_initial: dict[str, list] = {}
            for k, v in sorted(NAMED_REFERENCES.items()):
                if k.endswith(";"):
                    by_initial.setdefault(k[0], []).append((k, v))
            sql = "map(" + ", ".join(
                f"{_sql_string(i)}, map(" + ", ".join(f"{_sql_string(k)}, {_sql_string(v)}" for k, v in kv) + ")"
                for i, kv in sorted(by_initial.items())) + ")"
        elif name == "legacy":
            # names that may be written without ';'
            sql = "map(" + ", ".join(f"{_sql_string(k)}, {_sql_string(v)}"
                                     for k, v in sorted(NAMED_REFERENCES.items()) if not k.endswith(";")) + ")"
        elif name == "charrefs":
            sql = "map(" + ", ".join(f"CAST({k} AS BIGINT), {_sql_string(v)}"
                                     for k, v in sorted(INVALID_CHARREFS.items())) + ")"
        else:
            sql = "array(" + ", ".join(f"CAST({c} AS BIGINT)" for c in INVALID_CODEPOINTS) + ")"
        _TABLES[key] = F.expr(sql)
    return _TABLES[key]


def _lookup(name: Column) -> Column:
    """Value of a reference name (with or without its ';'), or NULL."""
    with_semicolon = F.element_at(F.element_at(_table("named"), F.substring(name, 1, 1)), name)
    return F.when(F.endswith(name, F.lit(";")), with_semicolon).otherwise(F.element_at(_table("legacy"), name))


def _charref_map() -> Column:
    return _table("charrefs")


def decode_charref(tok: Column) -> Column:
    """One character reference token -> its text, as Python's unescape
    does for the forms matched by ``CHARREF_RE``; unknown names stay."""
    is_hex = tok.rlike("^&#[xX]")
    digits = F.ltrim(F.regexp_extract(tok, "^&#[xX]?([0-9a-fA-F]+)", 1), F.lit("0"))
    too_long = F.length(digits) > 7
    num = F.when(digits == "", F.lit(0).cast("bigint")).when(
        is_hex, F.conv(digits, 16, 10).try_cast("bigint")).otherwise(digits.try_cast("bigint"))
    num = F.when(too_long, F.lit(MAX_CODEPOINT + 1).cast("bigint")).otherwise(num)
    as_char = F.decode(F.unhex(F.lpad(F.hex(num), 8, "0")), "UTF-32")
    numeric = (F.when(F.element_at(_charref_map(), num).isNotNull(), F.element_at(_charref_map(), num))
               .when((num > MAX_CODEPOINT) | num.between(0xD800, 0xDFFF), F.lit(REPLACEMENT_CHAR))
               .when(F.array_contains(_table("codepoints"), num), F.lit(""))
               .otherwise(as_char))
    # Named: the whole name (with its ';' if any) is a key, else the longest
    # shorter prefix that is a name allowed without ';', else unchanged.
    legacy = _table("legacy")
    s = F.substring(tok, 2, 1 << 20)
    n = F.length(s)
    # a shorter prefix has no ';', so only the names allowed without ';' can match it
    prefixes = [F.when(n - 1 >= k, F.concat(F.element_at(legacy, F.substring(s, 1, k)), F.substring(s, k + 1, 1 << 20)))
                for k in range(LEGACY_NAME_MAX, 1, -1)]
    named = F.coalesce(_lookup(s), *prefixes, tok)
    # The most frequent references are resolved before the table scan;
    # their values come from the same table.
    fast = None
    for ref in FREQUENT_REFERENCES:
        cond, val = tok == F.lit("&" + ref), F.lit(NAMED_REFERENCES[ref])
        fast = F.when(cond, val) if fast is None else fast.when(cond, val)
    return fast.when(F.startswith(tok, F.lit("&#")), numeric).otherwise(named)


def decode_charrefs(text: Column) -> Column:
    """Replace every character reference in ``text`` (text without '&' is
    returned as it is)."""
    parts = F.split(text, CHARREF_RE)
    tokens = F.regexp_extract_all(text, F.lit("(" + CHARREF_RE + ")"), 1)
    decoded = F.transform(tokens, decode_charref)
    joined = F.array_join(F.zip_with(parts, decoded, lambda p, d: F.concat(p, F.coalesce(d, F.lit("")))), "")
    return F.when(F.instr(text, "&") > 0, joined).otherwise(text)


def _markup_text(m: Column) -> Column:
    """What one piece of markup leaves: line breaks or a raw element's text."""
    raw = F.regexp_extract(m, RAW_RE, RAW_GROUP)
    twice = F.endswith(m, F.lit("/>")) & m.rlike(_MAY_CLOSE_RE) & ~m.rlike(_STAYS_OPEN_RE)
    breaks = F.when(twice, F.lit("\n\n")).when(m.rlike(BREAK_TAG_RE), F.lit("\n")).otherwise(F.lit(""))
    return F.when(F.lower(F.substring(m, 1, 3)).isin("<sc", "<st"), raw).otherwise(breaks)


def _not_held_back(last: Column) -> Column:
    """The text after the last markup without what the parser waits with."""
    after = F.instr(F.reverse(last), "<")  # counted from the end; 0 if none
    kept = F.when(after > 0, F.substring(last, F.lit(1), F.length(last) - after + 1)).otherwise(F.lit(""))
    return F.when(F.endswith(last, F.lit("<")), F.substring(last, F.lit(1), F.length(last) - 1)).when(
        last.rlike(_UNFINISHED_RE), kept).otherwise(last)


def _pieces_text(pieces: Column) -> Column:
    """Text and markup in turns, text first and last."""
    def joined(held: Column) -> Column:
        last = F.size(held) - 1
        return F.array_join(F.transform(held, lambda p, k: F.when(k % 2 == 1, _markup_text(p)).otherwise(
            decode_charrefs(F.when(k == last, _not_held_back(p)).otherwise(p)))), "")
    # bound in a lambda, so that the pieces are worked out once a row and not once an element
    return F.element_at(F.transform(F.array(pieces), joined), 1)


def html_to_text(html) -> Column:
    x = F.coalesce(_col(html), F.lit(""))
    # the markup is searched once, and marked; a text that holds the mark is searched twice
    marked = F.split(F.regexp_replace(x, MARKUP_RE, _CUT + "$0" + _CUT), _CUT)
    texts = F.split(x, MARKUP_RE)
    found = F.concat(F.regexp_extract_all(x, F.lit(MARKUP_RE), 0), F.array(F.lit("")))
    turns = F.flatten(F.zip_with(texts, found, lambda t, m: F.array(t, m)))
    pieces = F.when(F.instr(x, _CUT) > 0, F.slice(turns, 1, F.size(turns) - 1)).otherwise(marked)
    return py_strip(F.regexp_replace(_pieces_text(pieces), BLANK_RUN_RE, "\n\n"))
