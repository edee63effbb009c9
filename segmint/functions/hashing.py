"""Hashing: SHA-256 hex of the UTF-8 bytes, native (``sha2``), never a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import normalized


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def hashed(c: Column, pii_type: str, policy: str = "skip",
           lowercase_email: bool = False) -> Column:
    """Normalise then hash one identifier column (null stays null)."""
    return sha256_hex(normalized(c, pii_type, policy, lowercase_email))
