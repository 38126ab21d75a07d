"""Secrets in texts: keyword automaton, anchored expressions near hits, checksums.

One pass of an Aho-Corasick automaton finds the keywords of all kinds. Only where one
ends is the expression of its kind tried, anchored at the keyword. What matches is then
validated: by its length, by a checksum that the token carries, or by its structure.
Bare hexadecimal runs have no keyword; one expression of a single character class looks
for those.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import string
import zlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.llm.common import append, free_name, whole_text

BASE = ("assign", "access", "hex")
#: Digits of the checksum at the end of a token, in order of value.
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def carries_crc32(body: str) -> bool:
    """Whether the last 6 characters are the CRC-32 of those before, in base 62."""
    value = 0
    for c in body[-6:]:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body[:-6].encode())


def is_signed_token(found: re.Match) -> bool:
    """Whether the first part decodes to a JSON header that names an algorithm."""
    head = found[1]
    try:
        content = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (binascii.Error, ValueError):
        return False
    return isinstance(content, dict) and "alg" in content


#: kind -> (keywords in lower case, expression anchored at a keyword, validation). Kinds
#: are listed in the order that spans of one start have. All flags are ASCII.
KINDS: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
        lambda m: len(m[2]) >= 6,
    ),
    "access": (("akia",), re.compile("AKIA[A-Z0-9]+", re.ASCII), lambda m: m.end() - m.start() >= 20),
    "hex": ((), re.compile("[0-9a-f]{24,}", re.ASCII), lambda m: True),
    "github": (
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile("gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", re.ASCII),
        lambda m: carries_crc32(m[1]),
    ),
    "npm": (("npm_",), re.compile("npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", re.ASCII), lambda m: carries_crc32(m[1])),
    "jwt": (("eyj",), re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", re.ASCII), is_signed_token),
    "private_key": (
        ("-----begin",),
        re.compile(r"-----BEGIN(?:\x20[A-Z]+)*\x20PRIVATE\x20KEY-----[A-Za-z0-9+/=\s]+-----END(?:\x20[A-Z]+)*\x20PRIVATE\x20KEY-----", re.ASCII),
        lambda m: True,
    ),
}
ORDER = {kind: n for n, kind in enumerate(KINDS)}


class Scanner:
    def __init__(self):
        self.keywords = ahocorasick.Automaton()
        for kind, (words, _, _) in KINDS.items():
            for word in words:
                self.keywords.add_word(word, (len(word), kind))
        self.keywords.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, leftmost and not overlapping per kind."""
        hits: dict[str, list[int]] = {}
        lower = text.encode().lower().decode()  # ASCII letters only; places stay
        for last, (length, kind) in self.keywords.iter(lower):
            hits.setdefault(kind, []).append(last + 1 - length)
        found = [("hex", *m.span()) for m in KINDS["hex"][1].finditer(text)]
        for kind, starts in hits.items():
            _, expression, valid = KINDS[kind]
            free = 0
            for start in sorted(starts):
                if start >= free and (m := expression.match(text, start)):
                    free = m.end()  # a match that is dropped takes its place all the same
                    if valid(m):
                        found.append((kind, start, free))
        return sorted(found, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every stretch of touching spans replaced by the kind of its first."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


FIELDS = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, spans_list array<struct<kind:string,start:bigint,end:bigint>>, text string"


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "secrets") -> DataFrame:
    """Scan every whole text; returns ``keep`` columns (all, if None) and struct ``name``.

    Its fields: ``n_assign``, ``n_access``, ``n_hex`` (counts of the base kinds),
    ``base_sha256`` (of the base spans ``kind:start:end``, comma-joined), ``spans`` (all
    spans, joined likewise, by start and kind), ``spans_list`` and ``text`` (redacted: the
    input where nothing was found). A null text counts as empty: no spans, text ''. Rows
    are independent, so null or repeated ids and repeated rows need no rule; other columns
    pass through. Expressions and automaton are linear in the text.
    """

    def make():
        scanner = Scanner()

        def run(texts: list[str]) -> list[tuple]:
            rows = []
            for t in texts:
                spans = scanner.spans(t)
                base = [s for s in spans if s[0] in BASE]
                counts = [sum(s[0] == kind for s in base) for kind in BASE]
                listed = [{"kind": k, "start": a, "end": b} for k, a, b in spans]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), listed, redacted(t, spans)))
            return rows

        return run

    return append(docs, make, [whole_text(text)], FIELDS, name, keep)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its secrets replaced by their kind; rows and columns stay.

    A text without secrets stays as it is, null included.
    """
    name = free_name(docs, "secrets")
    clean = F.when(F.size(f"{name}.spans_list") > 0, F.col(f"{name}.text")).otherwise(F.col(text))
    return scan(docs, text, None, name).select(*(clean.alias(c) if c == text else F.col(c) for c in docs.columns))
