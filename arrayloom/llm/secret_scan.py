"""Secret scans: Aho-Corasick keyword prefilter, anchored expressions only near hits, then checksum validation.

One automaton over all keywords reads each text once. An expression is tried only at a keyword's place (anchored
there), never over the text. Hexadecimal runs have no keyword: their prefilter is a byte-class scan that finds runs of
at least HEX_MIN. Access tokens that embed a checksum (last six characters: the CRC-32 of the random part in base 62)
are reported only if it is right.

Spans are (kind, start, end) in code points, end exclusive. Defined results: null text is empty and has no spans; an
empty text likewise; rows that repeat a doc_id are scanned separately; an empty table gives an empty result; other
columns are not read; a text of any length is scanned whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame

from .common import with_computed

# Keywords, patterns and least lengths of the kinds.
KINDS = ("assign", "access", "hex", "checked")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_MIN = 6
ACCESS_WORD = "AKIA"
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_MIN = 20
HEX_MIN = 24
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_MIN)
CHECKED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(r"(ghp_|gho_|ghu_|ghs_|ghr_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Lower-cases ASCII letters only and keeps every character's place.
_LOWER = {c: c + 32 for c in range(65, 91)}


def base62_crc(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_WORDS), ("access", (ACCESS_WORD.lower(),)), ("checked", CHECKED_WORDS)):
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def scan(text: str, words: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """Sorted (start, place of the kind in KINDS, end) of one text."""
    spans, ended, hits = [], {}, []
    low = text.translate(_LOWER) if not text.isascii() else text.lower()
    for end, (kind, n) in words.iter(low):
        hits.append((end + 1 - n, kind))
    hits.sort()
    for start, kind in hits:
        if start < ended.get(kind, 0):
            continue  # inside an earlier match of its kind
        if kind == "assign" and (m := ASSIGN.match(text, start)):
            ended[kind] = m.end()
            if len(m[2]) >= ASSIGN_MIN:
                spans.append((start, 0, m.end()))
        elif kind == "access" and (m := ACCESS.match(text, start)):
            ended[kind] = m.end()
            if m.end() - start >= ACCESS_MIN:
                spans.append((start, 1, m.end()))
        elif kind == "checked" and (m := CHECKED.match(text, start)) and base62_crc(m[2]) == m[3]:
            ended[kind] = m.end()
            spans.append((start, 3, m.end()))
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _row(text: str | None, words: ahocorasick.Automaton) -> tuple:
    spans = scan(text or "", words)
    said = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
    base = ",".join(s for s, (_, k, _) in zip(said, spans, strict=True) if k < 3)
    counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
    return (*counts[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(said), counts[3])


def secret_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_checked (tokens whose checksum holds)."""
    fields = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string", "n_checked": "long"}

    def make():
        words = automaton()
        return lambda texts: {f: [r[i] for r in rows] for rows in [[_row(t, words) for t in texts]] for i, f in enumerate(fields)}

    return with_computed(docs.selectExpr(f"`{key}` AS doc_id", f"`{text}` AS text"), "text", make, fields)
