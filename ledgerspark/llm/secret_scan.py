"""Secret scans: keyword automaton, anchored expressions at its hits, embedded checksums.

One pass of an Aho-Corasick automaton over the lower-cased text finds every place where a
secret with a keyword can begin. Only there an anchored expression is tried on the
original text. Vendor tokens that carry a checksum are kept only if it is right. Runs of
hexadecimal digits have no keyword; they are located by their own run.

Defined cases: a null text counts as empty; a null id is kept; every input row gives one
output row, repeated rows included; other columns of the input are not read, so clashing
names do no harm; an empty table gives an empty result; very long texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import beside

#: Kinds in the order in which they are listed; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = 3

# Keywords, patterns and least lengths.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
ASSIGN_LEAST = 12
ACCESS_LEAST = 18

BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base62_crc32(body: str) -> str:
    """Six base-62 digits of the CRC-32 of a token's random part."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits


@cache
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        machine.add_word(word, (kind, len(word)))
    machine.make_automaton()
    return machine


def _lowered(text: str) -> str:
    """Lower case with every code point at its old place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_LOWER)


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret in the whole text, by start, then kind as listed."""
    if not text:
        return []
    places: dict[str, list[int]] = {}
    for end, (kind, length) in _automaton().iter(_lowered(text)):
        places.setdefault(kind, []).append(end - length + 1)
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for kind, starts in places.items():
        done = 0
        for start in sorted(starts):
            if start < done:
                continue
            if kind == "assign":
                if m := ASSIGN.match(text, start):
                    done = m.end()
                    if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                        found.append((start, done, kind))
            elif kind == "access":
                if m := ACCESS.match(text, start):
                    done = m.end()
                    if done - start >= ACCESS_LEAST:
                        found.append((start, done, kind))
            elif m := (GITHUB if kind == "github" else NPM).match(text, start):
                done = m.end()
                if base62_crc32(m[1]) == m[2]:
                    found.append((start, done, kind))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts by kind, digest of the base spans, and all spans."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = {f"n_{kind}": "long" for kind in KINDS}

    def work(texts: list[str | None]) -> list[list]:
        each = [find_spans(text) for text in texts]
        base = [_joined([s for s in spans if s[2] in KINDS[:BASE_KINDS]]) for spans in each]
        found = [[sum(s[2] == kind for s in spans) for spans in each] for kind in KINDS]
        return [*found, [hashlib.sha256(b.encode()).hexdigest() for b in base], [_joined(spans) for spans in each]]

    return beside(rows, "text", counts | {"base_sha256": "string", "spans": "string"}, work).withColumnRenamed("id", id_col)


def redact_text(text: str | None, mask: str = "[SECRET]") -> str | None:
    """The text with every secret replaced; overlapping spans become one mask."""
    if not (spans := find_spans(text)):
        return text
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(text: Column) -> Column:
    """Column of texts without their secrets; null stays null."""

    @F.pandas_udf(T.StringType())
    def work(texts: pd.Series) -> pd.Series:
        return pd.Series([redact_text(x) for x in texts], dtype=object)

    return work(text)
