"""Path keys and portable upload names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vellum.functions.text import _col

# German letters and their ASCII spellings.
GERMAN_TRANSLITERATION = (
    ("ä", "ae"),
    ("ö", "oe"),
    ("ü", "ue"),
    ("Ä", "Ae"),
    ("Ö", "Oe"),
    ("Ü", "Ue"),
    ("ß", "ss"),
)

# Characters allowed in object-store names.
UNSUPPORTED_CHAR_RE = "[^A-Za-z0-9._-]"
UNSUPPORTED_RUN_RE = "[^A-Za-z0-9._-]+"
DROPPED_CHAR_RE = "[#?]"
DASHES_BEFORE_EXT_RE = r"-+(?=\.[A-Za-z0-9]+$)"


def transliterate_german(c) -> Column:
    """One letter to two, so ``translate`` (1:1) cannot be used."""
    out = _col(c)
    for letter, ascii_form in GERMAN_TRANSLITERATION:
        out = F.replace(out, F.lit(letter), F.lit(ascii_form))
    return out


def path_key(c) -> Column:
    """Identity key of an inventory row: backslashes become slashes."""
    return F.replace(_col(c), F.lit("\\"), F.lit("/"))


def generated_upload_name(relative_path) -> Column:
    """'/' -> '--', transliterate, each unsupported character -> '-' (P11)."""
    name = F.replace(path_key(relative_path), F.lit("/"), F.lit("--"))
    return F.regexp_replace(transliterate_german(name), UNSUPPORTED_CHAR_RE, "-")


def explicit_upload_name(name) -> Column:
    """Sanitise a user-given name: drop '#?', collapse unsupported runs to
    '-', drop dashes before the final extension, strip dashes (P12)."""
    out = transliterate_german(_col(name))
    out = F.regexp_replace(out, DROPPED_CHAR_RE, "")
    out = F.regexp_replace(out, UNSUPPORTED_RUN_RE, "-")
    out = F.regexp_replace(out, DASHES_BEFORE_EXT_RE, "")
    return F.btrim(out, F.lit("-"))


def upload_name(relative_path, explicit=None) -> Column:
    """Explicit name when non-empty, else the generated one."""
    generated = generated_upload_name(relative_path)
    if explicit is None:
        return generated
    e = _col(explicit)
    return F.when(F.coalesce(e, F.lit("")) != "", explicit_upload_name(e)).otherwise(generated)
