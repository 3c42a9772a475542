"""File-name parsing: revision groups (P2, P3), names and stems, time format."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vellum.functions.text import PY_WHITESPACE, _col, ascii_digits

_WS_CLASS = "".join(PY_WHITESPACE)

# The revision suffix is whitespace/underscore separators, then
# "rev", digits and an optional letter, case-insensitive, at the end of the
# stem (a final newline is allowed, as with Python's '$').
REVISION_RE = "(?isU)^(.*?)[" + _WS_CLASS + "_]+(rev\\d+[a-z]?)(?=\\n?\\z)"
REVISION_NUMBER_RE = "(?iU)^rev(\\d+)"
# Characters stripped from the group key.
GROUP_KEY_STRIP = " _"
REDUCED_SUFFIX = "-reduced"


def revision_group_key(stem) -> Column:
    s = _col(stem)
    return F.when(s.rlike(REVISION_RE),
                  F.btrim(F.regexp_extract(s, REVISION_RE, 1), F.lit(GROUP_KEY_STRIP))).otherwise(s)


def revision_label(stem) -> Column:
    s = _col(stem)
    return F.when(s.rlike(REVISION_RE), F.regexp_extract(s, REVISION_RE, 2)).otherwise(F.lit(""))


def revision_number(revision) -> Column:
    """Digits after 'rev' as a number, -1 when absent; the letter is ignored."""
    digits = F.regexp_extract(F.coalesce(_col(revision), F.lit("")), REVISION_NUMBER_RE, 1)
    return F.coalesce(ascii_digits(digits).try_cast("bigint"), F.lit(-1).cast("bigint"))


def file_name(path) -> Column:
    """Last path component (either separator)."""
    return F.regexp_extract(_col(path), r"[^/\\]*$", 0)


def file_stem(path) -> Column:
    """``Path.stem``: the name without its last suffix; a dot at the start or
    at the end of the name does not begin a suffix."""
    return F.regexp_replace(file_name(path), r"^(.+)\.[^.]+$", "$1")


def with_suffix(path, suffix: str) -> Column:
    """``Path.with_suffix``: replace the last suffix of the name, or add one."""
    p = _col(path)
    stem_path = F.regexp_replace(p, r"^(.*/)?([^/]+)\.[^./]+$", "$1$2")
    return F.concat(stem_path, F.lit(suffix))


def has_reduced_suffix(path) -> Column:
    """Stem ends with '-reduced', case-insensitive."""
    return F.endswith(F.lower(file_stem(path)), F.lit(REDUCED_SUFFIX))


def format_epoch(epoch_seconds) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a UTC epoch, independent of the session time
    zone (P5)."""
    e = _col(epoch_seconds).cast("bigint")
    day = F.floor(e / 86400).cast("int")
    sec = F.pmod(e, F.lit(86400))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(
        F.date_from_unix_date(day).cast("string"), F.lit(" "),
        two(F.floor(sec / 3600)), F.lit(":"), two(F.floor(sec / 60) % 60), F.lit(":"),
        two(sec % 60),
    )
