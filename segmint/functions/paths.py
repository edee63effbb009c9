"""Object-key helpers: decode, split, strip extension, zero-pad, hash lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: key and list formats ------------------------------------
# Extension = the base name from its last dot on, provided some non-dot
# character precedes that dot (leading dots do not count), as in
# os.path.splitext.  Groups: directory, root of the base name.
EXTENSION_PATTERN = r"^(.*/)?(\.*[^./][^/]*)\.[^./]*$"
# Hash lists arrive as one string joined by ", ".
HASH_LIST_SEPARATOR = ", "
# ---------------------------------------------------------------------------


def decode_key(c: Column) -> Column:
    """URL-decode an event key, '+' as space; undecodable text → null."""
    return F.try_url_decode(c)


def strip_extension(c: Column) -> Column:
    return F.regexp_replace(c, EXTENSION_PATTERN, "$1$2")


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def dir_part(c: Column, i: int) -> Column:
    """0-based directory component ``i`` of a key (null when too short).

    Only the directory part (everything before the last '/') is split, so
    the file name never counts as a directory.
    """
    dirs = F.split(F.regexp_replace(c, r"/?[^/]*$", ""), "/")
    return F.try_element_at(dirs, F.lit(i + 1))


def digits_for(n_parts: Column) -> Column:
    """Zero-pad width: number of decimal digits of the part count."""
    return F.length(n_parts.cast("string"))


def chunk_suffix(chunk: Column, n_parts: Column) -> Column:
    """1-based chunk number zero-padded to the width of ``n_parts``."""
    return F.lpad((chunk + 1).cast("string"), digits_for(n_parts), "0")


def split_hash_list(c: Column) -> Column:
    return F.split(c, HASH_LIST_SEPARATOR)
