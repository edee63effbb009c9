"""Identifier normalisation as Column → Column functions.

Everything is a built-in expression (whole-stage codegen) except Unicode
NFKD, which Spark lacks; that one is an Arrow pandas UDF fed *only* the
non-ASCII values (ASCII text is its own NFKD form), so ASCII-only columns
send nulls through Arrow instead of the text.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: what counts as whitespace for strip --------------------
# Exactly the characters Python's str.strip() removes (str.isspace), derived
# by rule: 29 code points from U+0009 to U+3000.
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
# Phone numbers keep ASCII digits only, then lose leading zeros.
NON_DIGITS = "[^0-9]+"
# ---------------------------------------------------------------------------


def _nfkd_series(s: pd.Series) -> pd.Series:
    # Inputs are null for ASCII rows; touch only the others (most batches
    # have none, and a per-element pass over nulls would dominate).
    mask = s.notna()
    if not mask.any():
        return s
    out = s.copy()
    out[mask] = s[mask].str.normalize("NFKD")
    return out


# Ship this module's code with the UDF (pickled by value), so executors need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Marked non-deterministic only so that Catalyst does not copy the call into
# pushed-down filters (which would run the Python worker twice per row);
# the function itself is pure.
_nfkd_udf = F.pandas_udf(_nfkd_series, T.StringType()).asNondeterministic()


def is_ascii(c: Column) -> Column:
    """True when every character is one byte in UTF-8 (cheap: no regex)."""
    return F.length(c) == F.octet_length(c)


def nfkd(c: Column) -> Column:
    """Unicode NFKD; the UDF only ever sees non-ASCII values."""
    return F.coalesce(F.when(is_ascii(c), c), _nfkd_udf(F.when(~is_ascii(c), c)))


def strip(c: Column) -> Column:
    """Trim leading/trailing Unicode whitespace (same set as Python strip).

    ``btrim`` with an explicit set works on code points, natively and in
    linear time (no regex).
    """
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """The common first step for every identifier: NFKD, then strip."""
    return strip(nfkd(c))


def normalize_phone(c: Column) -> Column:
    return F.ltrim(F.regexp_replace(c, NON_DIGITS, ""), F.lit("0"))


def normalize_email(c: Column, lowercase: bool = False) -> Column:
    return F.lower(c) if lowercase else c


def normalize_ad_id(c: Column) -> Column:
    return F.lower(c)


def normalize_kind(c: Column, pii_type: str, lowercase_email: bool = False) -> Column:
    """Dispatch on identifier kind; ``c`` must already be ``clean_text``-ed."""
    if pii_type == "PHONE":
        return normalize_phone(c)
    if pii_type == "EMAIL":
        return normalize_email(c, lowercase_email)
    if pii_type in ("GAID", "IDFA", "MOBILE_AD_ID"):
        return normalize_ad_id(c)
    raise ValueError(f"unknown pii_type {pii_type!r}")


def apply_null_policy_before(c: Column, policy: str) -> Column:
    """``literal``: a missing value becomes the text ``None`` (old behaviour)."""
    return F.coalesce(c, F.lit("None")) if policy == "literal" else c


def apply_null_policy_after(c: Column, policy: str) -> Column:
    """``skip``: an empty normalised value is treated as missing."""
    return F.when(F.length(c) > 0, c) if policy == "skip" else c


def normalized(c: Column, pii_type: str, policy: str = "skip",
               lowercase_email: bool = False) -> Column:
    """Full normalisation of one identifier column.

    The null policy reads the value twice, so a plan built from this single
    expression calls the NFKD UDF twice per non-ASCII value; DataFrame code
    should prefer ``plans.transform.normalize_all``, which cleans in a
    projection of its own.
    """
    v = apply_null_policy_before(c, policy)
    v = normalize_kind(clean_text(v), pii_type, lowercase_email)
    return apply_null_policy_after(v, policy)
