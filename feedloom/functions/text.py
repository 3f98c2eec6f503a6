"""Whitespace handling with the Unicode rules of Python's ``str.strip`` and ``str.split``.

Patterns with all of these characters in a class are slow on long texts, so whitespace is first
turned into plain spaces, character by character, and patterns only look at those.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The characters Python counts as whitespace, without the plain space.
ODD_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")
ODD_SPACE = "".join(rf"\x{{{ord(c):x}}}" for c in ODD_SPACES)
SPACE = rf"[ {ODD_SPACE}]"
NOT_SPACE = rf"[^ {ODD_SPACE}]"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove whitespace of any kind at both ends; ``trim`` knows the plain space only."""
    return F.btrim(as_column(c), F.lit(" " + ODD_SPACES))


def squeeze(c: Column | str) -> Column:
    """Split on whitespace and join again with single spaces."""
    plain = F.translate(as_column(c), ODD_SPACES, " " * len(ODD_SPACES))
    return F.btrim(F.regexp_replace(plain, "  +", " "))


#: A packed text begins with its length, in so many bytes.
LENGTH_BYTES = 4


def _pack(texts: pa.Array) -> pa.Array:
    def one(text: bytes | None) -> bytes | None:
        return None if text is None else len(text).to_bytes(LENGTH_BYTES) + pa.compress(text, "zstd", asbytes=True)

    return pa.array((one(t.as_py()) for t in texts.cast(pa.binary())), pa.binary())


def _unpack(packed: pa.Array) -> pa.Array:
    def one(block: bytes | None) -> bytes | None:
        if block is None:
            return None
        length = int.from_bytes(block[:LENGTH_BYTES])
        return pa.decompress(block[LENGTH_BYTES:], length, "zstd", asbytes=True)

    return pa.array((one(b.as_py()) for b in packed), pa.binary()).view(pa.string())


_packed = F.arrow_udf(_pack, T.BinaryType())
_unpacked = F.arrow_udf(_unpack, T.StringType())


def packed(c: Column | str) -> Column:
    """A long text as zstd bytes, to go through shuffles that do not look at it; :func:`unpacked` gives it back."""
    return _packed(as_column(c))


def unpacked(c: Column | str) -> Column:
    return _unpacked(as_column(c))
