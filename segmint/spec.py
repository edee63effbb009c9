"""AudienceSpec: what to read, which columns carry which identifier, and
how the destination wants the output shaped.

Validation happens on the driver before any Spark job starts, so a bad
mapping fails fast instead of producing wrong files.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: identifier kinds and destination limits ------------------
# Identifier kinds accepted per destination profile.
PII_KINDS = {
    "file": ("EMAIL", "PHONE", "GAID", "IDFA"),
    "batch": ("EMAIL", "PHONE", "MOBILE_AD_ID"),
}
# Output file cap of the file profile (bytes) and row cap of the batch profile.
FILE_CAP_BYTES = 50 * 1024 ** 2
BATCH_CAP_ROWS = 100_000
# A hashed line is 64 hex characters plus a newline.
HASH_LINE_BYTES = 65
# ---------------------------------------------------------------------------

AD_ID_KINDS = ("GAID", "IDFA", "MOBILE_AD_ID")
NULL_POLICIES = ("skip", "literal")

_TYPE_NAMES = {
    "STRING": T.StringType(),
    "DECIMAL": T.DecimalType(38, 10),
    "INTEGER": T.IntegerType(),
    "LONG": T.LongType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
}


@dataclass(frozen=True)
class PiiField:
    column_name: str
    pii_type: str

    @property
    def output_name(self) -> str:
        return f"{self.pii_type}_SHA256"


@dataclass(frozen=True)
class AudienceSpec:
    """Everything the transform needs; mirrors the job arguments.

    ``null_policy``: ``skip`` (default) emits no hash for a null or an
    empty normalised value; ``literal`` hashes the text ``None`` for a null
    or absent value, which a scan cannot tell apart, and hashes empty strings.
    ``include_unmapped`` (batch profile only) melts unmapped string columns
    in clear text too; it is off by default, and ``extra_columns`` must name
    these columns, since a scan reads only what the spec lists.
    """

    profile: str
    fields: tuple[PiiField, ...]
    segment_name: str
    source_key: str = "audience.json"
    null_policy: str = "skip"
    lowercase_email: bool = False
    include_unmapped: bool = False
    source_format: str = "json"
    extra_columns: tuple[tuple[str, str], ...] = field(default_factory=tuple)
    # FAILFAST: a malformed line fails the job (no silent loss);
    # PERMISSIVE: it reads as nulls and, under ``skip``, yields no hash.
    read_mode: str = "FAILFAST"

    @staticmethod
    def from_args(profile: str, pii_fields: str | list, segment_name: str,
                  source_key: str = "audience.json", **kw) -> "AudienceSpec":
        """Build from the job-style arguments (``pii_fields`` as JSON text)."""
        raw = json.loads(pii_fields) if isinstance(pii_fields, str) else pii_fields
        fields = tuple(PiiField(f["column_name"], f["pii_type"]) for f in raw)
        spec = AudienceSpec(profile, fields, segment_name, source_key, **kw)
        spec.validate()
        return spec

    def validate(self) -> None:
        if self.profile not in PII_KINDS:
            raise ValueError(f"unknown profile {self.profile!r}")
        if not self.fields:
            raise ValueError("pii_fields must name at least one column")
        allowed = PII_KINDS[self.profile]
        seen_cols, seen_types = set(), set()
        for f in self.fields:
            if f.pii_type not in allowed:
                raise ValueError(
                    f"pii_type {f.pii_type!r} not supported by profile "
                    f"{self.profile!r}; expected one of {allowed}")
            if f.column_name in seen_cols:
                raise ValueError(f"column {f.column_name!r} mapped twice")
            if f.pii_type in seen_types:
                raise ValueError(f"pii_type {f.pii_type} mapped to two columns")
            seen_cols.add(f.column_name)
            seen_types.add(f.pii_type)
        if not self.segment_name or "/" in self.segment_name:
            raise ValueError("segment_name must be non-empty and contain no '/'")
        if self.null_policy not in NULL_POLICIES:
            raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
        if self.include_unmapped and self.profile != "batch":
            raise ValueError("include_unmapped applies to the batch profile only")
        if self.include_unmapped and not any(t.upper() == "STRING" for _, t in self.extra_columns):
            raise ValueError("include_unmapped needs the string columns in extra_columns")
        if self.source_format not in ("json", "csv"):
            raise ValueError("source_format must be json or csv")
        if self.read_mode not in ("FAILFAST", "PERMISSIVE"):
            raise ValueError("read_mode must be FAILFAST or PERMISSIVE")
        for _, t in self.extra_columns:
            if t.upper() not in _TYPE_NAMES:
                raise ValueError(f"unsupported declared type {t!r}")

    @property
    def mapped_columns(self) -> list[str]:
        return [f.column_name for f in self.fields]

    @property
    def output_names(self) -> list[str]:
        return [f.output_name for f in self.fields]

    def read_schema(self) -> T.StructType:
        """Explicit schema: mapped columns as strings, never inferred."""
        out = [T.StructField(c, T.StringType(), True) for c in self.mapped_columns]
        for name, t in self.extra_columns:
            if name not in self.mapped_columns:
                out.append(T.StructField(name, _TYPE_NAMES[t.upper()], True))
        return T.StructType(out)

    @property
    def rows_per_file(self) -> int:
        """Strict per-file row cap for this profile."""
        if self.profile == "file":
            return FILE_CAP_BYTES // HASH_LINE_BYTES
        return BATCH_CAP_ROWS


def parts_for(n_rows: int, cap_rows: int) -> int:
    """Number of balanced parts so that none exceeds ``cap_rows`` (0 rows → 0)."""
    return 0 if n_rows <= 0 else math.ceil(n_rows / cap_rows)
