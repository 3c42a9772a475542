"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on the driver's tables registered as views. The SQL is
written independently of the Spark code, with DuckDB's own functions; only
the fixed values (whitespace set, patterns, labels) are shared.
"""

from __future__ import annotations

from vellum.functions.html import (CDATA_RE, CHARREF_RE, COMMENT_RE, INVALID_CHARREFS, INVALID_CODEPOINTS,
                                   LEGACY_NAME_MAX, MAX_CODEPOINT, NAMED_REFERENCES, RAW_ELEMENT_RE,
                                   REPLACEMENT_CHAR)
from vellum.functions.naming import GERMAN_TRANSLITERATION
from vellum.functions.replies import (DOCUMENT_TYPES, IMAGE_ALIASES, NO_REASON, TEXT_ALIASES)
from vellum.functions.text import HTML_ESCAPES, PY_LINE_BREAK_RE, PY_WHITESPACE, TRUTHY
from vellum.operators.messages import HEADER_LABELS, NO_BODY
from vellum.operators.scoring import DEFAULT_PROMPT
from vellum.sources.fixtures import EARLIER_SCAN_AT, EPOCH0


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NL = lit("\n")
WS = lit(PY_WHITESPACE)
WS_CLASS = "[" + PY_WHITESPACE + "]"
LINE_BREAKS = PY_LINE_BREAK_RE
REV = "(?is)^(.*?)[" + PY_WHITESPACE + "_]+(rev[0-9]+[a-z]?)$"
FLOAT = (r"(?i)^[+-]?(inf|infinity|nan|([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)"
         r"(e[+-]?[0-9](_?[0-9])*)?)$")


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def blank_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def truthy(x: str) -> str:
    return f"coalesce(lower({strip(x)}) IN ({', '.join(lit(t) for t in TRUTHY)}), false)"


def safe_float(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN regexp_matches({s}, {lit(FLOAT)}) THEN TRY_CAST(replace({s}, '_', '') AS DOUBLE) END)"


def translit(x: str) -> str:
    for a, b in GERMAN_TRANSLITERATION:
        x = f"replace({x}, {lit(a)}, {lit(b)})"
    return x


def gen_name(path: str) -> str:
    return (f"regexp_replace({translit(f'replace(replace({path}, {lit(chr(92))}, {lit(chr(47))}), {lit(chr(47))}, {lit(chr(45) * 2)})')}, "
            f"'[^A-Za-z0-9._-]', '-', 'g')")


def exp_name(x: str) -> str:
    y = f"regexp_replace({translit(x)}, '[#?]', '', 'g')"
    y = f"regexp_replace({y}, '[^A-Za-z0-9._-]+', '-', 'g')"
    y = f"regexp_replace({y}, '-+(\\.[A-Za-z0-9]+)$', '\\1')"
    return f"trim({y}, '-')"


def name_of(p: str) -> str:
    return f"regexp_extract({p}, '[^/\\\\]*$', 0)"


def stem_of(p: str) -> str:
    return f"regexp_replace({name_of(p)}, '^(.+)\\.[^.]+$', '\\1')"


def with_pdf(p: str) -> str:
    return f"(regexp_replace({p}, '^(.*/)?([^/]+)\\.[^./]+$', '\\1\\2') || '.pdf')"


def reduced_name(p: str) -> str:
    d = f"regexp_replace({p}, '[^/\\\\]*$', '')"
    return (f"({d} || {stem_of(p)} || '-reduced' || "
            f"substr({name_of(p)}, length({stem_of(p)}) + 1))")


def epoch_text(e: str) -> str:
    return f"strftime(make_timestamp(CAST({e} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


# RE2 forms of the tag patterns (RE2 has no possessive quantifiers).
ATTRS_RE2 = """(?:[^>"']+|"[^"]*"|'[^']*')*"""
BREAK_TAG_RE2 = "(?i)<(?:/(?:p|div|li|tr)|p|div|li|tr|br)(?:[\\s/]" + ATTRS_RE2 + ")?>"
ANY_TAG_RE2 = "<[A-Za-z/!?]" + ATTRS_RE2 + ">"

# The reference tables as one row; queries that convert HTML add these
# columns with scalar subqueries so lambdas can use them.
REFS = ("refs AS (SELECT MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in sorted(NAMED_REFERENCES.items()))
        + "} AS refmap, MAP {" + ", ".join(f"{k}: {lit(v)}" for k, v in sorted(INVALID_CHARREFS.items()))
        + "} AS badrefs, [" + ", ".join(str(c) for c in INVALID_CODEPOINTS) + "] AS badcps)")
REF_COLS = ("(SELECT refmap FROM refs) AS refmap, (SELECT badrefs FROM refs) AS badrefs, "
            "(SELECT badcps FROM refs) AS badcps")


def _charref(tok: str) -> str:
    digits = f"ltrim(regexp_extract({tok}, '^&#[xX]?([0-9a-fA-F]+)', 1), '0')"
    num = (f"(CASE WHEN {digits} = '' THEN 0 WHEN length({digits}) > 7 THEN {MAX_CODEPOINT + 1} "
           f"WHEN regexp_matches({tok}, '^&#[xX]') THEN TRY_CAST('0x' || {digits} AS BIGINT) "
           f"ELSE TRY_CAST({digits} AS BIGINT) END)")
    numeric = (f"(CASE WHEN map_extract_value(badrefs, {num}) IS NOT NULL THEN map_extract_value(badrefs, {num}) "
               f"WHEN {num} > {MAX_CODEPOINT} OR {num} BETWEEN 55296 AND 57343 THEN {lit(REPLACEMENT_CHAR)} "
               f"WHEN list_contains(badcps, {num}) THEN '' ELSE chr(CAST({num} AS INTEGER)) END)")
    sname = f"substr({tok}, 2)"
    prefixes = ", ".join(
        f"CASE WHEN length({sname}) - 1 >= {k} THEN map_extract_value(refmap, substr({sname}, 1, {k})) "
        f"|| substr({sname}, {k + 1}) END" for k in range(LEGACY_NAME_MAX, 1, -1))
    named = f"coalesce(map_extract_value(refmap, {sname}), {prefixes}, {tok})"
    return f"(CASE WHEN starts_with({tok}, '&#') THEN {numeric} ELSE {named} END)"


def decode_charrefs(x: str) -> str:
    toks = f"regexp_extract_all({x}, {lit('(' + CHARREF_RE + ')')}, 1)"
    return (f"array_to_string(list_transform(regexp_split_to_array({x}, {lit(CHARREF_RE)}), "
            f"lambda p, i: p || coalesce({_charref(toks + '[i]')}, '')), '')")


def html_text(x: str) -> str:
    """Needs the REF_COLS columns in scope."""
    def markup(o: str) -> str:
        y = f"regexp_replace({o}, {lit(COMMENT_RE)}, '', 'g')"
        y = f"regexp_replace({y}, {lit(CDATA_RE)}, '', 'g')"
        y = f"regexp_replace({y}, {lit(BREAK_TAG_RE2)}, {NL}, 'g')"
        y = f"regexp_replace({y}, {lit(ANY_TAG_RE2)}, '', 'g')"
        return decode_charrefs(y)
    raw1 = f"regexp_extract_all({x}, {lit(RAW_ELEMENT_RE)}, 1)"
    raw2 = f"regexp_extract_all({x}, {lit(RAW_ELEMENT_RE)}, 2)"
    joined = (f"array_to_string(list_transform(regexp_split_to_array({x}, {lit(RAW_ELEMENT_RE)}), "
              f"lambda o, i: {markup('o')} || coalesce({raw1}[i], {raw2}[i], '')), '')")
    return strip(f"regexp_replace({joined}, '\\n{{3,}}', {lit(chr(10) * 2)}, 'g')")


def html_escape(x: str) -> str:
    for raw, esc in HTML_ESCAPES:
        x = f"replace({x}, {lit(raw)}, {lit(esc)})"
    return x


def fence_strip(x: str) -> str:
    s = strip(x)
    parts = f"regexp_split_to_array({s}, {lit(LINE_BREAKS)})"
    rest = f"list_slice({parts}, 2, len({parts}))"
    body = (f"(CASE WHEN len({rest}) > 0 AND starts_with({strip(f'{rest}[len({rest})]')}, '```') "
            f"THEN list_slice({rest}, 1, len({rest}) - 1) ELSE {rest} END)")
    return f"(CASE WHEN starts_with({s}, '```') THEN {strip(f'array_to_string({body}, {NL})')} ELSE {s} END)"


def brace_slice(s: str) -> str:
    first = f"(length(regexp_extract({s}, '^[^{{]*', 0)) + 1)"
    last = f"(length({s}) - length(regexp_extract({s}, '[^}}]*$', 0)))"
    return (f"(CASE WHEN strpos({s}, '{{') > 0 AND strpos({s}, '}}') > 0 AND {last} > {first} "
            f"THEN substr({s}, {first}, {last} - {first} + 1) END)")


# ---- shared CTEs -------------------------------------------------------------

K = "(doc_id // 20)"
FILES = f"""files AS (
  SELECT doc_id, lang, source, text, stem,
         'docs/' || lang || '/b' || CAST(doc_id AS VARCHAR) || '/' || stem || '.pdf' AS relative_path,
         CAST(strlen(text) AS BIGINT) AS file_size, md5(text) AS md5_hash,
         CAST({EPOCH0} + (doc_id * 7919) % 86400 AS BIGINT) AS creation_epoch
  FROM (SELECT *, 'Prüfung ' || source || '-' || CAST(doc_id % 2 AS VARCHAR) ||
          (CASE {K} % 4 WHEN 1 THEN ' rev' || lpad(CAST({K} % 7 AS VARCHAR), 2, '0')
                        WHEN 2 THEN '_rev' || lpad(CAST({K} % 7 AS VARCHAR), 2, '0') || 'a'
                        WHEN 3 THEN ' REV' || CAST({K} % 7 AS VARCHAR) ELSE '' END) AS stem
        FROM documents) d
)"""

SCAN = FILES + f""",
scan0 AS (
  SELECT doc_id, lang, source, stem, stem || '.pdf' AS filename, '/srv/' || relative_path AS full_path,
         relative_path, file_size, ends_with(lower(stem), '-reduced') AS reduced,
         CASE WHEN regexp_matches(stem, {lit(REV)}) THEN trim(regexp_extract(stem, {lit(REV)}, 1), ' _')
              ELSE stem END AS group_key,
         CASE WHEN regexp_matches(stem, {lit(REV)}) THEN regexp_extract(stem, {lit(REV)}, 2) ELSE '' END AS revision,
         creation_epoch, md5_hash, text
  FROM files),
scan AS (
  SELECT *, coalesce(TRY_CAST(regexp_extract(revision, '(?i)^rev([0-9]+)', 1) AS BIGINT), -1) AS revision_number
  FROM scan0)"""

LATEST_ORDER = "ORDER BY revision_number DESC, creation_epoch DESC, relative_path"
COLS = ("doc_id, filename, full_path, relative_path, file_size, reduced, group_key, revision, "
        "revision_number, creation_epoch, md5_hash, is_latest")

FLAGGED = SCAN + f""",
dedup AS (SELECT * FROM scan QUALIFY row_number() OVER (PARTITION BY md5_hash ORDER BY relative_path) = 1),
flagged AS (SELECT *, (row_number() OVER (PARTITION BY group_key {LATEST_ORDER}) = 1) AS is_latest FROM dedup),
e_dedup AS (SELECT * FROM scan WHERE creation_epoch < {EARLIER_SCAN_AT}
            QUALIFY row_number() OVER (PARTITION BY md5_hash ORDER BY relative_path) = 1),
earlier AS (SELECT * REPLACE ('docs\\' || substr(relative_path, 6) AS relative_path),
                   (row_number() OVER (PARTITION BY group_key {LATEST_ORDER}) = 1) AS is_latest
            FROM e_dedup),
new_rows AS (SELECT * FROM flagged
             WHERE relative_path NOT IN (SELECT replace(relative_path, '\\', '/') FROM earlier)),
appended AS (SELECT {COLS} FROM earlier UNION ALL SELECT {COLS} FROM new_rows)"""

LISTING = """listing AS (
  SELECT CASE WHEN doc_id % 11 = 5 THEN NULL WHEN doc_id % 5 = 0 THEN '/srv/inv/' || relative_path
              ELSE '/srv/' || relative_path END AS path
  FROM files)"""


def cands(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN nullif({s}, '') IS NULL THEN []::VARCHAR[] WHEN starts_with({s}, '/') THEN [{s}] "
            f"ELSE ['/srv/inv/' || {s}, '/srv/' || {s}] END)")


RESOLVED = FILES + ",\n" + LISTING + f""",
rrows AS (SELECT doc_id, relative_path,
                 CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN relative_path
                      ELSE '/srv/' || relative_path END AS full_path
          FROM files),
cl AS (SELECT relative_path, list_concat({cands('full_path')}, {cands('relative_path')}) AS c FROM rrows),
ex AS (SELECT relative_path, unnest(c) AS cand, generate_subscripts(c, 1) AS pos FROM cl),
best AS (SELECT relative_path, arg_min(cand, pos) AS resolved_path FROM ex
         WHERE cand IN (SELECT path FROM listing WHERE path IS NOT NULL) GROUP BY relative_path),
resolved AS (SELECT r.relative_path, r.full_path, b.resolved_path FROM rrows r LEFT JOIN best b USING (relative_path))"""

MSGS = REFS + f""",
msgs AS (
  SELECT 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id,
         'mail/conv' || CAST(conv_id AS VARCHAR) || '/turn' || lpad(CAST(turn AS VARCHAR), 3, '0') || '.msg' AS source_path,
         CASE WHEN turn % 4 = 3 THEN '  ' ELSE role END AS sender,
         role || '@example.com' AS sender_email,
         'conv' || CAST(conv_id AS VARCHAR) || '@example.com' AS "to",
         CASE WHEN turn % 2 = 0 THEN '' ELSE 'cc@example.com' END AS cc,
         {epoch_text(f'{EPOCH0} + conv_id * 3600 + turn * 60')} AS date,
         CASE WHEN turn % 5 = 0 THEN '' ELSE 'Thread ' || CAST(conv_id AS VARCHAR) END AS subject,
         CASE WHEN turn % 7 = 6 THEN {lit('  ' + chr(10) + ' ')} ELSE text END AS body,
         CASE WHEN turn % 7 = 6 THEN '<div>' || replace(text, {NL}, '<br>') || '</div>' END AS body_html
  FROM conversations
  UNION ALL
  SELECT 'p' || CAST(page_id AS VARCHAR), CASE WHEN page_id % 13 = 5 THEN '' ELSE 'mail/web/page' || CAST(page_id AS VARCHAR) || '.msg' END, '',
         regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '', '', '', '', '', html
  FROM pages),
msgs_r AS (SELECT *, {REF_COLS} FROM msgs),
fields AS (
  SELECT *, coalesce({blank_null('sender')}, coalesce({strip('sender_email')}, '')) AS hdr_from,
         coalesce({strip('"to"')}, '') AS hdr_to, coalesce({strip('cc')}, '') AS hdr_cc,
         coalesce({strip('date')}, '') AS hdr_date,
         coalesce({blank_null('subject')}, {stem_of('source_path')}) AS hdr_subject,
         coalesce({blank_null('body')},
                  CASE WHEN {strip("coalesce(body_html, '')")} <> '' THEN {html_text(strip('body_html'))} END,
                  '') AS body_text
  FROM msgs_r),
hdr AS (
  SELECT *, concat_ws({NL}, {', '.join(f"CASE WHEN {v} <> '' THEN {lit(lab + ': ')} || {html_escape(v)} END" for lab, v in zip(HEADER_LABELS, ['hdr_from', 'hdr_to', 'hdr_cc', 'hdr_date', 'hdr_subject']))}) AS header_text,
         CAST({' + '.join(f"CAST({v} <> '' AS INTEGER)" for v in ['hdr_from', 'hdr_to', 'hdr_cc', 'hdr_date', 'hdr_subject'])} AS INTEGER) AS n_headers,
         list_transform(
           list_filter(list_transform(regexp_split_to_array(
               CASE WHEN {strip('body_text')} = '' THEN {lit(NO_BODY)} ELSE {strip('body_text')} END,
               {lit(chr(10) + WS_CLASS + '*' + chr(10))}), lambda x: {strip('x')}), lambda x: x <> ''),
           lambda x: replace({html_escape('x')}, {NL}, '<br/>')) AS blocks
  FROM fields)"""


def _confidence(j: str) -> str:
    t = f"json_type({j}, '$.confidence')"
    return (f"greatest(0.0, least(1.0, coalesce(CASE WHEN {t} = 'VARCHAR' THEN {safe_float(f'json_extract_string({j}, {lit(chr(36) + '.confidence')})')} "
            f"WHEN {t} = 'BOOLEAN' THEN (CASE WHEN json_extract_string({j}, '$.confidence') = 'true' THEN 1.0 ELSE 0.0 END) "
            f"WHEN {t} IN ('DOUBLE', 'UBIGINT', 'BIGINT') THEN CAST(json_extract({j}, '$.confidence') AS DOUBLE) "
            f"ELSE 0.0 END, 0.0)))")


def _pystr(j: str, key: str) -> str:
    t = f"json_type({j}, '$.{key}')"
    return (f"(CASE WHEN {t} = 'VARCHAR' THEN json_extract_string({j}, '$.{key}') WHEN {t} = 'NULL' THEN 'None' "
            f"WHEN {t} = 'BOOLEAN' THEN (CASE WHEN json_extract_string({j}, '$.{key}') = 'true' THEN 'True' ELSE 'False' END) "
            f"WHEN {t} IN ('UBIGINT', 'BIGINT') THEN json_extract_string({j}, '$.{key}') "
            f"ELSE CAST(json_extract({j}, '$.{key}') AS VARCHAR) END)")


def _label(j: str) -> str:
    has = lambda k: f"list_contains(json_keys({j}), '{k}')"
    src = lambda k: f"(CASE WHEN json_type({j}, '$.{k}') = 'VARCHAR' THEN json_extract_string({j}, '$.{k}') ELSE '' END)"
    raw = f"(CASE WHEN {has('asset_type')} THEN {src('asset_type')} WHEN {has('document_type')} THEN {src('document_type')} ELSE '' END)"
    t = f"replace(replace(lower({strip(raw)}), '-', '_'), ' ', '_')"
    return (f"(CASE WHEN {t} IN ({', '.join(map(lit, TEXT_ALIASES))}) THEN 'text' "
            f"WHEN {t} IN ({', '.join(map(lit, IMAGE_ALIASES))}) THEN 'image' "
            f"WHEN {t} IN ({', '.join(map(lit, DOCUMENT_TYPES))}) THEN {t} ELSE 'error' END)")


def _reason(j: str) -> str:
    has = lambda k: f"list_contains(json_keys({j}), '{k}')"
    raw = f"(CASE WHEN {has('reasoning')} THEN {_pystr(j, 'reasoning')} WHEN {has('reason')} THEN {_pystr(j, 'reason')} ELSE '' END)"
    return f"coalesce({blank_null(raw)}, {lit(NO_REASON)})"


LABEL_REPLIES = """lr AS (
  SELECT doc_id, CASE doc_id % 10
    WHEN 0 THEN '{"asset_type": "Text-Based", "confidence": 0.' || CAST(quality * 5 + toxic * 3 + 1 AS VARCHAR) || ', "reasoning": "quality ' || CAST(quality AS VARCHAR) || '"}'
    WHEN 1 THEN '{"document_type": "image", "confidence": " 0.75 ", "reason": "toxic ' || CAST(toxic AS VARCHAR) || '"}'
    WHEN 2 THEN '{"asset_type": "diagram", "confidence": -' || CAST(quality AS VARCHAR) || '.5}'
    WHEN 3 THEN '{"asset_type": null, "document_type": "text", "confidence": 1' || CAST(toxic AS VARCHAR) || '.5}'
    WHEN 4 THEN '{"reasoning": "", "reason": "hidden", "asset_type": "image document", "confidence": true}'
    WHEN 5 THEN '  {"asset_type": "  IMAGE_BASED ", "confidence": "high"}  '
    WHEN 6 THEN '```json' || chr(10) || '{"asset_type": "textdocument", "confidence": "1_0e-1", "reasoning": null}' || chr(10) || '```'
    WHEN 7 THEN 'Sure! {"asset_type": "image_based", "confidence": 0.6, "reasoning": "plan ' || CAST(doc_id AS VARCHAR) || '"} Hope this helps.'
    WHEN 8 THEN '[{"asset_type": "text"}]'
    ELSE 'I cannot classify this document.' END AS reply
  FROM labels)"""


def parsed_cte(name: str, source: str, keys: str) -> str:
    """CTE ``name`` over ``source`` (with a ``reply`` column): cleaned text,
    recovered JSON ``j`` and ``err``."""
    c = fence_strip("reply")
    return f"""{name}_c AS (SELECT {keys}, {c} AS cleaned FROM {source}),
{name}_j AS (SELECT {keys}, cleaned,
    CASE WHEN json_valid(cleaned) THEN cleaned
         WHEN json_valid({brace_slice('cleaned')}) THEN {brace_slice('cleaned')} END AS jv FROM {name}_c),
{name} AS (SELECT {keys}, jv, CASE WHEN json_type(jv) = 'OBJECT' THEN jv END AS j,
    CASE WHEN jv IS NULL THEN 'reply was not valid JSON'
         WHEN json_type(jv) <> 'OBJECT' THEN 'reply JSON must be an object' END AS err FROM {name}_j)"""


NORM = LABEL_REPLIES + ",\n" + parsed_cte("lp", "lr", "doc_id") + f""",
norm AS (SELECT doc_id,
    CASE WHEN err IS NULL THEN {_label('j')} ELSE 'error' END AS document_type,
    CASE WHEN err IS NULL THEN {_confidence('j')} ELSE 0.0 END AS confidence,
    CASE WHEN err IS NULL THEN {_reason('j')} ELSE err END AS reason,
    err AS error, jv AS raw_json
  FROM lp)"""

RESULTS = f""",
results AS (SELECT f.relative_path, n.document_type AS llm_document_type, n.confidence AS llm_confidence,
                   n.reason AS llm_reason FROM norm n JOIN files f USING (doc_id))"""

PAGES = """pg AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rk
        FROM conversations)"""

REDUCTION = FILES + f""",
rinv AS (
  SELECT doc_id, source, text,
         CASE WHEN doc_id % 6 = 0 THEN '' ELSE '/srv/' || rel END AS full_path,
         CASE WHEN doc_id % 12 = 6 THEN '' ELSE rel END AS relative_path,
         ['False', 'True', '', ' yes', '0'][doc_id % 5 + 1] AS reduced
  FROM (SELECT *, CASE WHEN doc_id % 9 = 4 THEN regexp_replace(relative_path, '\\.pdf$', '-Reduced.pdf')
                       ELSE relative_path END AS rel FROM files)),
p0 AS (SELECT *, coalesce(nullif(full_path, ''), nullif(relative_path, '')) AS raw FROM rinv),
p1 AS (SELECT *, CASE WHEN starts_with(raw, '/') THEN raw ELSE '/srv/inv/' || raw END AS src FROM p0),
plan AS (
  SELECT *, CASE WHEN raw IS NULL THEN 'no_path'
                 WHEN {truthy('reduced')} OR ends_with(lower({stem_of('src')}), '-reduced') THEN 'already_reduced'
                 ELSE 'reduce' END AS action
  FROM p1)"""

UPLOAD = FILES + ",\n" + LISTING + f""",
up AS (SELECT relative_path, '/srv/' || relative_path AS full_path,
              CASE WHEN explicit <> '' THEN {exp_name('explicit')} ELSE {gen_name('relative_path')} END AS upload_name
       FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN text || '.pdf' ELSE '' END AS explicit FROM files)),
man AS (SELECT relative_path, upload_name,
               full_path IN (SELECT path FROM listing WHERE path IS NOT NULL) AS file_exists,
               relative_path = min(relative_path) OVER (PARTITION BY upload_name) AS first_for_name
        FROM up),
manifest AS (SELECT *, CASE WHEN NOT file_exists THEN 'missing' WHEN first_for_name THEN 'upload'
                            ELSE 'duplicate_name' END AS status FROM man)"""

REDUCE_TEXT = ("array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), chr(10))")

NEW_FILES_SQL = f"WITH {FLAGGED} SELECT relative_path, group_key, is_latest, md5_hash FROM new_rows"

REDUCTION_ACCOUNTING_SQL = f"""WITH {REDUCTION},
red AS (SELECT source, CAST(strlen(text) AS BIGINT) AS o, CAST(strlen({REDUCE_TEXT}) AS BIGINT) AS r
        FROM (SELECT source, text, string_split(regexp_replace(text, '[ \t]+', ' ', 'g'), chr(10)) AS l
              FROM plan WHERE action = 'reduce'))
SELECT source, count(*) AS n_reduced, CAST(sum(o) AS BIGINT) AS original_bytes, CAST(sum(r) AS BIGINT) AS reduced_bytes,
       CAST(sum(o) - sum(r) AS BIGINT) AS saved_bytes, round(CAST(sum(o) - sum(r) AS DOUBLE) / 1048576, 2) AS saved_mib,
       round(CAST(sum(o) - sum(r) AS DOUBLE) / 1073741824, 2) AS saved_gib
FROM red GROUP BY source"""

ORACLE: dict[str, str] = {
    "inventory_scan": f"""WITH {SCAN}
SELECT doc_id, filename, full_path, relative_path, file_size, reduced, group_key, revision, revision_number,
       {epoch_text('creation_epoch')} AS creation_time, md5_hash, {gen_name('relative_path')} AS upload_name
FROM scan""",
    "revision_parse": f"WITH {SCAN} SELECT doc_id, stem, group_key, revision, revision_number FROM scan",
    "dedup_exact": f"WITH {FLAGGED} SELECT doc_id, md5_hash, relative_path FROM dedup",
    "duplicate_groups": f"""WITH {SCAN}
SELECT md5_hash, count(*) AS copies, min(relative_path) AS kept_path FROM scan GROUP BY md5_hash HAVING count(*) > 1""",
    "latest_revision": f"WITH {FLAGGED} SELECT relative_path, group_key, revision, revision_number, is_latest FROM flagged",
    "latest_only": f"""WITH {FLAGGED}
SELECT relative_path, group_key, revision, revision_number, {epoch_text('creation_epoch')} AS creation_time
FROM flagged WHERE is_latest""",
    "group_summary": f"""WITH {FLAGGED}
SELECT group_key, count(*) AS n_files, max(revision_number) AS max_revision,
       max(CASE WHEN is_latest THEN relative_path END) AS latest_path
FROM flagged GROUP BY group_key""",
    "new_files": NEW_FILES_SQL,
    "scan_summary": f"""WITH {FLAGGED}, k AS (
  SELECT relative_path IN (SELECT replace(relative_path, '\\', '/') FROM earlier) AS known FROM flagged)
SELECT count(*) AS total_files, count(*) FILTER (WHERE NOT known) AS added_files,
       count(*) FILTER (WHERE known) AS skipped_files FROM k""",
    "stale_latest": f"""WITH {FLAGGED}
SELECT group_key, count(*) FILTER (WHERE is_latest) AS n_latest, count(*) AS n_files
FROM appended GROUP BY group_key HAVING count(*) FILTER (WHERE is_latest) > 1""",
    "recomputed_latest": f"""WITH {FLAGGED}
SELECT relative_path, (row_number() OVER (PARTITION BY group_key {LATEST_ORDER}) = 1) AS is_latest FROM appended""",
    "inventory_align": f"""WITH {FLAGGED}
SELECT filename, full_path, relative_path, CAST(file_size AS VARCHAR) AS file_size, 'False' AS reduced,
       {gen_name('relative_path')} AS upload_name, group_key, revision,
       CAST(revision_number AS VARCHAR) AS revision_number, {epoch_text('creation_epoch')} AS creation_time,
       CASE WHEN is_latest THEN 'True' ELSE 'False' END AS is_latest, md5_hash,
       '' AS llm_document_type, '' AS llm_confidence, '' AS llm_reason, '' AS llm_raw_json
FROM appended""",
    "upload_name_generated": f"""WITH {FILES}, s AS (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'docs\\' || substr(relative_path, 6) ELSE relative_path END AS stored_path
  FROM files)
SELECT doc_id, stored_path, {gen_name('stored_path')} AS upload_name FROM s""",
    "upload_name_explicit": f"""WITH {FILES}, e AS (
  SELECT doc_id, relative_path, CASE WHEN doc_id % 2 = 0 THEN text || '  (v2)+ .pdf' ELSE '' END AS explicit FROM files)
SELECT doc_id, CASE WHEN explicit <> '' THEN {exp_name('explicit')} ELSE {gen_name('relative_path')} END AS upload_name
FROM e""",
    "upload_collisions": f"""WITH {FILES}, n AS (SELECT relative_path, {exp_name("text || '.pdf'")} AS upload_name FROM files)
SELECT upload_name, count(*) AS n_paths, min(relative_path) AS kept_path FROM n GROUP BY upload_name HAVING count(*) > 1""",
    "truthy_flags": f"""WITH t AS (
  SELECT doc_id, [{', '.join(lit(s) for s in ['True', ' yes ', 'Y', '1', 'false', '0', 'no', ' TRUE' + chr(9), ''])}][doc_id % 9 + 1] AS flag_text
  FROM documents)
SELECT doc_id, flag_text, {truthy('flag_text')} AS flag FROM t""",
    "path_resolution": f"WITH {RESOLVED} SELECT relative_path, full_path, resolved_path FROM resolved",
    "unresolved_paths": f"WITH {RESOLVED} SELECT relative_path, 'file not found' AS error FROM resolved WHERE resolved_path IS NULL",
    "message_body": f"WITH {MSGS} SELECT message_id, body_text FROM hdr",
    "message_headers": f"WITH {MSGS} SELECT message_id, {html_escape('hdr_subject')} AS title, header_text, n_headers FROM hdr",
    "body_blocks": f"""WITH {MSGS}
SELECT message_id, CAST(generate_subscripts(blocks, 1) - 1 AS INTEGER) AS block_no, unnest(blocks) AS block FROM hdr""",
    "converted_rows": f"""WITH {MSGS}, cv AS (
  SELECT message_id, 'emails/' || {with_pdf("regexp_replace(source_path, '^mail/', '')")} AS rel,
         concat_ws({NL}, {html_escape('hdr_subject')}, header_text, array_to_string(blocks, {NL})) AS rendered
  FROM hdr WHERE source_path <> '')
SELECT message_id, rel AS relative_path, {name_of('rel')} AS filename,
       CASE WHEN regexp_matches({stem_of('rel')}, {lit(REV)}) THEN trim(regexp_extract({stem_of('rel')}, {lit(REV)}, 1), ' _') ELSE {stem_of('rel')} END AS group_key,
       CASE WHEN regexp_matches({stem_of('rel')}, {lit(REV)}) THEN regexp_extract({stem_of('rel')}, {lit(REV)}, 2) ELSE '' END AS revision,
       coalesce(TRY_CAST(regexp_extract(CASE WHEN regexp_matches({stem_of('rel')}, {lit(REV)}) THEN regexp_extract({stem_of('rel')}, {lit(REV)}, 2) ELSE '' END, '(?i)^rev([0-9]+)', 1) AS BIGINT), -1) AS revision_number,
       true AS is_latest, false AS reduced, md5(rendered) AS md5_hash, CAST(strlen(rendered) AS BIGINT) AS file_size
FROM cv""",
    "conversion_summary": f"""WITH {MSGS}
SELECT count(*) AS detected, count(*) FILTER (WHERE coalesce(source_path, '') <> '') AS converted,
       count(*) FILTER (WHERE coalesce(source_path, '') = '') AS failed FROM msgs""",
    "html_text_native": f"""WITH {REFS}, p AS (SELECT *, {REF_COLS} FROM pages)
SELECT page_id, {html_text("coalesce(html, '')")} AS text FROM p""",
    "response_text": f"""WITH resp AS (
  SELECT conv_id, turn,
         CASE WHEN turn % 4 = 0 THEN text WHEN turn % 4 = 1 THEN '   ' END AS output_text,
         CASE WHEN turn % 4 = 1 THEN [{{'content': [{{'text': text}}, {{'text': '  '}}]}}, {{'content': NULL::STRUCT(text VARCHAR)[]}}]
              WHEN turn % 4 = 2 THEN [{{'content': [{{'text': 'part ' || CAST(turn AS VARCHAR)}}, {{'text': text}}, {{'text': NULL::VARCHAR}}]}}]
         END AS output
  FROM conversations)
SELECT conv_id, turn,
       coalesce({blank_null('output_text')},
                {blank_null(f"array_to_string(list_filter(list_transform(flatten(list_transform(coalesce(output, []), lambda o: coalesce(o.content, []))), lambda p: {strip('p.text')}), lambda t: t <> ''), {NL})")},
                '') AS reply_text
FROM resp""",
    "fence_strip": f"""WITH r AS (
  SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '```json' || chr(10) || text || chr(10) || '```'
                                       WHEN 1 THEN '  ' || text ELSE '```' || chr(10) || text END AS reply
  FROM conversations)
SELECT conv_id, turn, {fence_strip('reply')} AS stripped FROM r""",
    "json_brace_slice": f"""WITH pr AS (
  SELECT conv_id, turn, 'Result for turn ' || CAST(turn AS VARCHAR) || ': ' ||
         CAST(json_object('reasoning', text, 'turn', turn) AS VARCHAR) || ' (end)' AS reply
  FROM conversations),
{parsed_cte('pp', 'pr', 'conv_id, turn')}
SELECT conv_id, turn, err IS NULL AS json_ok, json_extract_string(j, '$.reasoning') AS reasoning,
       CAST(json_extract(j, '$.turn') AS BIGINT) AS turn_value
FROM pp""",
    "reply_normalise": f"WITH {NORM} SELECT doc_id, document_type, confidence, reason, error FROM norm",
    # DuckDB's JSON takes neither repeated keys nor NaN: what each shape must give is written out
    "reply_raw_json": f"""WITH d AS (SELECT doc_id, doc_id % 7 AS k, CAST(doc_id AS VARCHAR) AS n, CAST(quality AS VARCHAR) AS q
                     FROM labels)
SELECT doc_id, CASE WHEN k IN (0, 1, 3) THEN 'text' WHEN k IN (2, 4) THEN 'image' ELSE 'error' END AS document_type,
       CASE k WHEN 0 THEN '0.6250' WHEN 1 THEN '1.0000' WHEN 3 THEN '0.2500' WHEN 4 THEN '0.5000' ELSE '0.0000' END AS confidence,
       CASE k WHEN 1 THEN 'row ' || n WHEN 3 THEN 'été/' || n
              WHEN 4 THEN '{{''q'': ' || q || ', ''ok'': True, ''none'': None}}'
              WHEN 5 THEN 'reply was not valid JSON' WHEN 6 THEN 'reply was not valid JSON'
              ELSE {lit(NO_REASON)} END AS reason,
       CASE k WHEN 0 THEN '{{"asset_type": "text", "confidence": 0.62505, "n": ' || n || '}}'
              WHEN 1 THEN '{{"asset_type": "text", "confidence": NaN, "reasoning": "row ' || n || '"}}'
              WHEN 2 THEN '{{"document_type": "image", "confidence": -Infinity, "id": ' || n || '}}'
              WHEN 3 THEN '{{"reasoning": "été/' || n || '", "asset_type": "text", "confidence": 0.25, "x": [1, 2.5, 1000.0]}}'
              WHEN 4 THEN '{{"asset_type": "image", "confidence": "0.5", "reasoning": {{"q": ' || q || ', "ok": true, "none": null}}}}'
       END AS raw_json,
       CASE WHEN k > 4 THEN 'reply was not valid JSON' END AS error FROM d""",
    "request_payload": f"""WITH {PAGES},
parts AS (
  SELECT conv_id, 0 AS part_no, 'input_text' AS part_type, {lit(DEFAULT_PROMPT)} AS payload
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, rk, 'input_image', 'data:image/jpeg;base64,' || base64(encode(text)) FROM pg WHERE rk <= 2)
SELECT conv_id, CAST(part_no AS INTEGER) AS part_no, part_type, payload FROM parts""",
    "first_pages": f"""WITH {PAGES}
SELECT conv_id, turn, CAST(rk AS INTEGER) AS page_rank, CAST(strlen(text) AS BIGINT) AS n_bytes FROM pg WHERE rk <= 2""",
    "score_candidates": f"""WITH {FLAGGED}, {NORM}{RESULTS}
SELECT relative_path FROM flagged WHERE is_latest AND relative_path NOT IN (
  SELECT relative_path FROM results WHERE {blank_null('llm_document_type')} IS NOT NULL)""",
    "score_writeback": f"""WITH {FLAGGED}, {NORM}{RESULTS}
SELECT f.relative_path, f.is_latest,
       CASE WHEN f.is_latest THEN r.llm_document_type END AS llm_document_type,
       CASE WHEN f.is_latest THEN r.llm_confidence END AS llm_confidence,
       CASE WHEN f.is_latest THEN r.llm_reason END AS llm_reason,
       coalesce({blank_null('f.filename')}, {blank_null('f.relative_path')}, '<unknown>') AS display_name
FROM flagged f LEFT JOIN results r USING (relative_path)""",
    "score_summary": f"""WITH {FLAGGED}, {NORM}{RESULTS},
j AS (SELECT f.is_latest, r.llm_document_type FROM flagged f LEFT JOIN results r USING (relative_path))
SELECT count(*) AS rows_loaded, count(*) FILTER (WHERE is_latest) AS latest_rows,
       count(*) FILTER (WHERE is_latest AND llm_document_type IS NOT NULL) AS cached,
       count(*) FILTER (WHERE is_latest AND llm_document_type IS NULL) AS to_score,
       count(*) FILTER (WHERE is_latest AND llm_document_type = 'error') AS errors
FROM j""",
    "reduction_plan": f"""WITH {REDUCTION}
SELECT doc_id, action, CASE WHEN raw IS NOT NULL THEN src END AS source_path,
       CASE WHEN action = 'reduce' THEN {reduced_name("'/srv/reduced/' || coalesce(nullif(relative_path, ''), " + name_of('src') + ")")}
            WHEN action = 'already_reduced' THEN src END AS destination,
       CASE WHEN raw IS NOT NULL THEN true ELSE {truthy('reduced')} END AS reduced_after
FROM plan""",
    "reduction_accounting": REDUCTION_ACCOUNTING_SQL,
    "reduction_run": REDUCTION_ACCOUNTING_SQL,
    "duplicate_summary": f"""WITH {SCAN}
SELECT CAST(count(*) AS BIGINT) AS files_seen, CAST(count(DISTINCT md5_hash) AS BIGINT) AS distinct_contents,
       CAST(count(*) - count(DISTINCT md5_hash) AS BIGINT) AS duplicates_skipped FROM scan""",
    "existing_paths": f"""WITH {FLAGGED}
SELECT DISTINCT replace(relative_path, '\\', '/') AS path_key FROM earlier WHERE replace(relative_path, '\\', '/') <> ''""",
    "score_run": f"""WITH {PAGES},
s AS (SELECT conv_id, count(*) AS n, sum(strlen(text)) AS total FROM pg WHERE rk <= 2 GROUP BY conv_id),
k AS (SELECT *, 'conversations/' || CAST(conv_id AS VARCHAR) || '.pdf' AS rel, conv_id % 6 = 4 AS gone FROM s)
SELECT conv_id, CASE WHEN conv_id % 6 = 5 THEN '/srv/' || rel ELSE rel END AS relative_path,
       CASE WHEN gone THEN 'error' WHEN total >= 1000 THEN 'text' ELSE 'image' END AS llm_document_type,
       CASE WHEN gone THEN '0.0000' ELSE printf('%.4f', least(1.0, CAST(total AS DOUBLE) / 4000.0)) END
         AS llm_confidence,
       CASE WHEN gone THEN 'file not found: ' || rel
            ELSE 'pass ' || CASE WHEN conv_id % 9 < 6 THEN '1' ELSE '2' END || ': ' || CAST(n AS VARCHAR)
                 || ' pages, ' || CAST(total AS VARCHAR) || ' bytes' END AS llm_reason
FROM k""",
    "cached_results": f"""WITH {FLAGGED}, {NORM},
r2 AS (SELECT f.relative_path, CASE WHEN n.document_type <> 'error' THEN n.document_type END AS t,
              printf('%.2f', n.confidence) AS c, n.reason AS r, n.raw_json AS j
       FROM norm n JOIN files f USING (doc_id)),
d AS (SELECT relative_path, filename, coalesce({blank_null('t')}, 'unclear') AS document_type,
             {safe_float('c')} AS confidence, coalesce({blank_null('r')}, 'Existing classification.') AS reason
      FROM flagged JOIN r2 USING (relative_path) WHERE is_latest)
SELECT relative_path, document_type, confidence, reason,
       coalesce({blank_null('filename')}, {blank_null('relative_path')}, '<unknown>') || ': skipped (already '
         || document_type || ')' AS message
FROM d""",
    "upload_manifest": f"WITH {UPLOAD} SELECT relative_path, upload_name, file_exists, first_for_name, status FROM manifest",
    "upload_summary": f"""WITH {UPLOAD}
SELECT count(*) FILTER (WHERE file_exists) AS uploaded, count(*) FILTER (WHERE NOT file_exists) AS failed,
       count(*) FILTER (WHERE status = 'duplicate_name') AS overwritten FROM manifest""",
    "incremental_ingest": NEW_FILES_SQL,
    "directory_scan": f"WITH {FLAGGED} SELECT relative_path, group_key, revision, revision_number, is_latest FROM flagged",
    "reduce_job": f"""WITH {FILES},
red AS (SELECT doc_id, relative_path, {REDUCE_TEXT} AS small
        FROM (SELECT *, string_split(regexp_replace(text, '[ \t]+', ' ', 'g'), chr(10)) AS l FROM files)),
named AS (SELECT *, 1 AS row_no FROM red UNION ALL SELECT *, 2 FROM red WHERE doc_id % 5 = 0)
SELECT doc_id, row_no, relative_path AS path, CASE WHEN doc_id % 7 = 3 THEN '' ELSE relative_path END AS relative_path,
       CAST(strlen(small) AS BIGINT) AS file_size, true AS reduced, md5(small) AS reduced_md5 FROM named""",
    "upload_run": f"""WITH {FILES},
named AS (SELECT doc_id, relative_path, md5_hash, CASE WHEN doc_id % 3 = 0 THEN lang || '-' || source || '.bin'
                 ELSE 'd' || CAST(doc_id AS VARCHAR) || '.bin' END AS upload_name FROM files),
ranked AS (SELECT *, row_number() OVER (PARTITION BY upload_name ORDER BY relative_path) AS k FROM named)
SELECT upload_name, CASE WHEN k > 1 THEN 'duplicate_name' WHEN doc_id % 6 = 5 THEN 'failed' ELSE 'uploaded' END AS status,
       CASE WHEN k = 1 AND doc_id % 6 <> 5 THEN md5_hash END AS object_md5 FROM ranked""",
    # the same pages: a self-closed tag is written out as a pair, and what
    # follows the last tag goes with its unfinished reference
    "html_text_exact": f"""WITH {REFS}, raw AS (
  SELECT page_id, replace(replace(replace(coalesce(html, ''), '</li>', '<li></li>'), '</h1>', '</h1><div></div>'),
                          '<br>', '<tr></tr>') AS html FROM pages),
p AS (SELECT page_id, regexp_replace(html, '[^<>]*$', '') AS html, {REF_COLS} FROM raw)
SELECT page_id, text, length(text) AS n_chars FROM (SELECT page_id, {html_text("html")} AS text FROM p)""",
    "message_listing": f"""WITH {FILES}, m AS (
  SELECT regexp_replace(relative_path, '[.]pdf$', '.MSG') AS relative_path, file_size FROM files WHERE doc_id % 3 = 0)
SELECT relative_path, file_size, row_number() OVER (ORDER BY relative_path) - 1 AS position,
       CAST(coalesce(sum(file_size) OVER (ORDER BY relative_path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS before FROM m""",
    "streaming_dedup": "SELECT DISTINCT md5(text) AS md5_hash FROM documents",
}
# a round trip through CSV and two appends leave the same rows
ORACLE["inventory_csv_append"] = ORACLE["inventory_align"]
# batches that arrive one after the other end as one scan of all does
ORACLE["ingest_in_batches"] = ORACLE["recomputed_latest"]
# the scan of what the files are after the changes
ORACLE["rescan"] = "WITH " + FLAGGED.replace("FROM documents", """FROM (
  SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN text || ' edited' ELSE text END AS text)
  FROM documents WHERE doc_id % 7 <> 3)""") + """
SELECT relative_path, file_size, md5_hash, is_latest FROM flagged"""
ORACLE["file_stream_scan"] = ORACLE["directory_scan"]
ORACLE["latest_by_events"] = ORACLE["recomputed_latest"]
