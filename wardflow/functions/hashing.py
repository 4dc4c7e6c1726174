"""Pseudonymisation digests (SHA-256, upper-case hex).

Three encodings exist in the source systems for the same identifier:

* ``hash_utf8``     – digest of the UTF-8 text (computed in Spark by the jobs).
* ``hash_utf16le``  – digest of the first 36 characters as UTF-16LE bytes
  (``nvarchar(36)``): the digest that is actually stored in the targets.
* ``hash_varchar``  – digest of the first 30 characters as single-byte text
  (``varchar`` default length); characters outside Latin-1 become '?'.

NULL in -> NULL out for all three.  All are computed before the write, so a
loaded row is never visible un-hashed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NVARCHAR_LEN = 36
VARCHAR_LEN = 30


def _s(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def hash_utf8(c) -> Column:
    return F.upper(F.sha2(_s(c), 256))


def hash_utf16le(c, length: int = NVARCHAR_LEN) -> Column:
    return F.upper(F.sha2(F.encode(F.substring(_s(c), 1, length), "UTF-16LE"), 256))


def hash_varchar(c, length: int = VARCHAR_LEN) -> Column:
    latin1 = F.regexp_replace(F.substring(_s(c), 1, length), "[^\\x{00}-\\x{FF}]", "?")
    return F.upper(F.sha2(F.encode(latin1, "ISO-8859-1"), 256))


ENCODINGS = {"utf8": hash_utf8, "utf16le": hash_utf16le, "varchar": hash_varchar}


def hash_columns(df, columns: dict[str, str], encoding: str = "utf16le"):
    """Add ``{source_col: digest_col}`` in one projection."""
    fn = ENCODINGS[encoding]
    return df.withColumns({dst: fn(src) for src, dst in columns.items()})
