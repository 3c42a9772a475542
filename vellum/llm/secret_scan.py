"""Secret scans: keyword prefilter, anchored patterns, embedded checksums.

Method: one Aho-Corasick automaton runs over the whole text (ASCII letters
lower-cased, so offsets stay) and yields the places of all keywords; a kind's
pattern is only matched where one of its keywords begins. Tokens that carry a
checksum in their last characters count only if it is right. The base kind
``hex`` has no keyword; its runs are found on the bytes of a batch at once.

Per kind, matches are leftmost and do not overlap; a match that fails its
length or checksum is dropped, but what it covers is not searched again.
Offsets are code points, ends exclusive. Defined results: a null or empty text
has no spans; every row gives one row, repeated rows too; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellum.llm import textscan

# Kinds in the order in which spans of one start are listed.
KINDS = ["assign", "access", "hex", "github", "npm"]
BASE = KINDS[:3]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
_NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
_NOT_HEX = np.ones(256, dtype=bool)
_NOT_HEX[[*b"0123456789abcdef"]] = False
HEX_MIN, ACCESS_MIN, VALUE_MIN = 32, 16, 8


def checksum62(payload: str) -> str:
    """CRC-32 of the payload as six base-62 digits."""
    n, out = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def _right_checksum(m: re.Match) -> bool:
    return checksum62(m[1]) == m[2]


# kind: (keywords in lower case, pattern, what a match must meet)
RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), _ASSIGN, lambda m: len(m[2]) >= VALUE_MIN),
    "access": (("akia",), _ACCESS, lambda m: m.end() - m.start() >= ACCESS_MIN),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), _GITHUB, _right_checksum),
    "npm": (("npm_",), _NPM, _right_checksum),
}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick
    machine = ahocorasick.Automaton()
    for kind, (keywords, _, _) in RULES.items():
        for word in keywords:
            machine.add_word(word, (kind, len(word)))
    machine.make_automaton()
    return machine


def keyword_spans(text: str, folded: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the kinds that have keywords."""
    starts: dict[str, list[int]] = {}
    for end, (kind, size) in _automaton().iter(folded):
        starts.setdefault(kind, []).append(end - size + 1)
    out = []
    for kind, places in starts.items():
        _, pattern, holds = RULES[kind]
        done = 0
        for at in sorted(places):
            if at >= done and (m := pattern.match(text, at)):
                done = m.end()
                if holds(m):
                    out.append((at, KINDS.index(kind), done))
    return out


def hex_spans(data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Byte spans of long runs of hex digits, by document."""
    out: dict[int, list[tuple[int, int]]] = {}
    for i, j in textscan.slices(offsets):
        a = int(offsets[i])
        starts, ends = textscan.word_spans(data[a:offsets[j]], offsets[i:j + 1] - a, _NOT_HEX)
        long = np.flatnonzero(ends - starts >= HEX_MIN)
        docs = np.searchsorted(offsets, starts[long] + a, side="right") - 1
        for d, s, e in zip(docs.tolist(), (starts[long] + a - offsets[docs]).tolist(), (ends[long] + a - offsets[docs]).tolist()):
            out.setdefault(d, []).append((s, e))
    return out


def find_spans(column) -> list[list[tuple[int, int, int]]]:
    """Per text: (start, kind number, end), by start, then kind."""
    data, offsets = textscan.utf8(column)
    raw = data.tobytes()
    folded = raw.lower()  # bytes.lower changes ASCII letters only
    runs = hex_spans(data, offsets)
    out = []
    for d in range(len(offsets) - 1):
        a, b = int(offsets[d]), int(offsets[d + 1])
        text = raw[a:b].decode("utf-8", "surrogatepass")
        spans = keyword_spans(text, folded[a:b].decode("utf-8", "surrogatepass"))
        for s, e in runs.get(d, ()):
            start = s if b - a == len(text) else len(raw[a:a + s].decode("utf-8", "surrogatepass"))
            spans.append((start, KINDS.index("hex"), start + e - s))
        spans.sort()
        out.append(spans)
    return out


_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id and ``spans``, the secrets found."""
    id_type = dict(docs.dtypes)[doc_id]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in find_spans(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, spans {_SPAN}")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and digests of the spans of :func:`scan`."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str):
        return F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return found.select("doc_id", *(F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["kind"].isin(BASE))).cast("bigint").alias("n_verified"))


def base_digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
