"""DuckDB oracle text shared by the registered queries.

DuckDB has no NFKD.  The derived contacts carry exactly two non-ASCII
characters, U+3000 and U+00A0, and only at the ends of e-mail values; NFKD
maps both to U+0020, which strip then removes, so for this input
``strip(nfkd(x)) == strip(x)`` and the oracle can use strip alone.  The
Spark side always runs the real NFKD.
"""

from __future__ import annotations

from ..spec import FILE_CAP_BYTES, HASH_LINE_BYTES
from .derived import contacts_sql

# RE2 form of Python's str.strip() whitespace set.
STRIP_RE2 = r"^[\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}]+|[\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}]+$"

FILE_CAP_ROWS = FILE_CAP_BYTES // HASH_LINE_BYTES


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP_RE2}', '', 'g')"


def phone_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({strip_sql(x)}, '[^0-9]+', '', 'g'), '^0+', '')"


def email_sql(x: str) -> str:
    return strip_sql(x)


def ad_id_sql(x: str) -> str:
    return f"lower({strip_sql(x)})"


def skip_empty(x: str) -> str:
    return f"CASE WHEN length({x}) > 0 THEN {x} END"


def literal_none(x: str) -> str:
    return f"coalesce({x}, 'None')"


CONTACTS_CTE = f"c AS ({contacts_sql()})"

NORMALIZED_CTE = (
    "n AS (SELECT contact_id, "
    f"{skip_empty(email_sql(chr(34) + 'e-mail' + chr(34)))} AS email_n, "
    f"{skip_empty(phone_sql('phone_number'))} AS phone_n, "
    f"{skip_empty(ad_id_sql('mobile_advertiser_id'))} AS ad_n FROM c)"
)


def hashed_cte(ad_kind: str) -> str:
    return ("h AS (SELECT contact_id, sha256(email_n) AS EMAIL_SHA256, "
            f"sha256(phone_n) AS PHONE_SHA256, sha256(ad_n) AS {ad_kind}_SHA256 FROM n)")


def long_cte(ad_kind: str) -> str:
    return (
        "l AS ("
        "SELECT 0 AS ord, contact_id, 'EMAIL_SHA256' AS schema, EMAIL_SHA256 AS hash "
        "FROM h WHERE EMAIL_SHA256 IS NOT NULL UNION ALL "
        "SELECT 1, contact_id, 'PHONE_SHA256', PHONE_SHA256 FROM h WHERE PHONE_SHA256 IS NOT NULL "
        f"UNION ALL SELECT 2, contact_id, '{ad_kind}_SHA256', {ad_kind}_SHA256 FROM h "
        f"WHERE {ad_kind}_SHA256 IS NOT NULL)"
    )


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def long_with(ad_kind: str) -> str:
    return with_ctes(CONTACTS_CTE, NORMALIZED_CTE, hashed_cte(ad_kind), long_cte(ad_kind))


def chunk_sql(idx: str, n: str, k: str) -> str:
    """Balanced contiguous split: part of 0-based ``idx`` for n rows in k parts."""
    q = f"({n} // {k})"
    big = f"(({n} - {q} * {k}) * ({q} + 1))"
    return (f"CAST(CASE WHEN {idx} < {big} THEN {idx} // ({q} + 1) "
            f"ELSE ({n} - {q} * {k}) + ({idx} - {big}) // {q} END AS BIGINT)")


def batch_split_sql(cap: int, segment: str = "contacts",
                    source_stem: str = "uploads/contacts") -> str:
    """Full batch-profile transform over the contacts (DuckDB)."""
    return long_with("MOBILE_AD_ID") + (
        ", i AS (SELECT schema, hash, row_number() OVER (ORDER BY ord, contact_id) - 1 AS row_id, "
        "count(*) OVER () AS total FROM l), "
        f"p AS (SELECT *, CAST(ceil(total / {cap}) AS BIGINT) AS n_parts FROM i), "
        f"q AS (SELECT *, {chunk_sql('row_id', 'total', 'n_parts')} AS chunk FROM p) "
        f"SELECT '{segment}' AS segment_name, schema, hash, row_id, chunk, n_parts, "
        f"concat('output/batch/{segment}/{source_stem}', "
        "lpad(CAST(chunk + 1 AS VARCHAR), CAST(length(CAST(n_parts AS VARCHAR)) AS INTEGER), '0'), '.csv.gz') AS object_key "
        "FROM q"
    )


def file_split_sql(cap: int, segment: str = "contacts",
                   source_stem: str = "uploads/contacts") -> str:
    """Full file-profile transform over the contacts (DuckDB)."""
    return long_with("GAID") + (
        ", i AS (SELECT schema, hash, "
        "row_number() OVER (PARTITION BY schema ORDER BY contact_id) - 1 AS row_id, "
        "count(*) OVER (PARTITION BY schema) AS total FROM l), "
        f"p AS (SELECT *, CAST(ceil(total / {cap}) AS BIGINT) AS n_parts FROM i), "
        f"q AS (SELECT *, {chunk_sql('row_id', 'total', 'n_parts')} AS chunk FROM p) "
        f"SELECT '{segment}' AS segment_name, schema, hash, row_id, chunk, n_parts, "
        f"concat('output/file/{segment}/', lower(schema), '/{source_stem}', "
        "CASE WHEN n_parts > 1 THEN lpad(CAST(chunk + 1 AS VARCHAR), "
        "CAST(length(CAST(n_parts AS VARCHAR)) AS INTEGER), '0') ELSE '' END, '.csv') AS object_key "
        "FROM q"
    )


# --- NFKD in DuckDB -----------------------------------------------------------
# Letters and signs of these ranges, as a table made from the Unicode data; texts
# with other decomposable code points, or with marks to reorder, need the UDF.
NFKD_RANGES = ((0x00A0, 0x0180), (0x2000, 0x2010), (0xFB00, 0xFB07), (0xFF01, 0xFF5F))


def nfkd_sql(column: str) -> str:
    """NFKD of ``column`` for code points of ``NFKD_RANGES``: one ``replace`` per code point."""
    import unicodedata
    out = column
    for low, high in NFKD_RANGES:
        for cp in range(low, high):
            form = unicodedata.normalize("NFKD", chr(cp))
            if form != chr(cp):
                out = f"replace({out}, chr({cp}), '{form.replace(chr(39), chr(39) * 2)}')"
    return out
