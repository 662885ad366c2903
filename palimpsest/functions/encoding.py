"""Decoding of mixed legacy encodings, Arrow-batched; never raises."""

from __future__ import annotations

import codecs
import re
import unicodedata
from itertools import takewhile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Declared names that mean windows-1252 or UTF-8, how much of a page is searched
#: for a declaration, and the lead bytes (with the lengths they announce) of doubly encoded text.
LEGACY_NAMES = ("iso-8859-1", "iso8859-1", "latin1", "latin-1", "windows-1252", "cp1252")
UTF8_NAMES = ("utf8", "utf-8")
HEAD = 8192
DOUBLED = {0xC2: 2, 0xC3: 2, 0xE2: 3, 0xF0: 4}

LEGACY, MODERN, MIXED = "windows-1252", "utf-8", "utf-8/windows-1252-mixed"
NAME = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789._-")
#: Every byte has a character: where windows-1252 has none, the code point of the byte.
TABLE = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256))
LEADS = {TABLE[b]: size for b, size in DOUBLED.items()}
ANY_LEAD = re.compile(f"[{''.join(LEADS)}]")


def legacy(raw: bytes) -> str:
    return codecs.charmap_decode(raw, "strict", TABLE)[0]


def _stray(error: UnicodeError) -> tuple[str, int]:
    """Decoding goes on behind the bytes that aren't UTF-8, which are read as windows-1252."""
    return legacy(error.object[error.start : error.end]), error.end


codecs.register_error("palimpsest-stray", _stray)


def declared(raw: bytes) -> str | None:
    """The first charset that the head of a page declares, in lower case."""
    for rest in raw[:HEAD].lower().split(b"charset")[1:]:
        rest = rest.lstrip()
        if not rest.startswith(b"="):
            continue
        rest = rest[1:].lstrip()
        if rest[:1] in (b'"', b"'"):
            rest = rest[1:].lstrip()
        name = bytes(takewhile(NAME.__contains__, rest))
        if name:
            return name.decode()
    return None


def undouble(text: str) -> str:
    """Runs of characters that announce UTF-8 sequences, read once more as UTF-8 if that is possible."""
    out, done = [], 0
    found = ANY_LEAD.search(text)
    while found:
        start = stop = found.start()
        while (size := LEADS.get(text[stop : stop + 1])) and len(group := text[stop : stop + size]) == size and "\n" not in group:
            stop += size
        if stop == start:
            stop += 1
        else:
            try:
                repaired = text[start:stop].encode("cp1252").decode("utf-8")
                out += [text[done:start], repaired]
                done = stop
            except UnicodeError:
                pass
        found = ANY_LEAD.search(text, stop)
    return "".join([*out, text[done:]])


def _read(raw: bytes) -> tuple[str, str]:
    name = declared(raw)
    if name in LEGACY_NAMES:
        return legacy(raw), LEGACY
    if name is not None and name not in UTF8_NAMES:
        try:
            return raw.decode(name), name
        except (LookupError, ValueError):
            pass
    try:
        return raw.decode("utf-8"), MODERN
    except UnicodeDecodeError:
        return raw.decode("utf-8", "palimpsest-stray"), MIXED


def decode(raw: bytes) -> tuple[str, str]:
    """Text in composed form and the encoding used."""
    text, name = _read(raw)
    return unicodedata.normalize("NFC", undouble(text)), name


DECODED = T.StructType([T.StructField("text", T.StringType()), T.StructField("source_encoding", T.StringType())])


@F.pandas_udf(DECODED)
def decode_html(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if r is None else decode(bytes(r)) for r in raw], columns=["text", "source_encoding"])
