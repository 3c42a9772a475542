"""Column -> Column helpers. All run as built-in JVM expressions."""

from vellum.functions.text import (  # noqa: F401
    PY_WHITESPACE, py_strip, blank_to_null, safe_str, is_truthy, safe_float,
    split_lines, html_escape, strip_code_fences,
)
from vellum.functions.naming import (  # noqa: F401
    transliterate_german, path_key, generated_upload_name, explicit_upload_name,
    upload_name,
)
from vellum.functions.revision import (  # noqa: F401
    revision_group_key, revision_label, revision_number, file_name, file_stem,
    has_reduced_suffix, format_epoch, with_suffix,
)
from vellum.functions.html import html_to_text  # noqa: F401
