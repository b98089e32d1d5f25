"""Column expressions; no Python UDF anywhere."""

from namewright.functions.exprs import (
    SHORT_KEY_CHARS,
    differs,
    dup_key,
    iso_utc,
    norm_key,
    not_blank,
    random_id,
    short_key,
    stable_id,
)

__all__ = [
    "SHORT_KEY_CHARS",
    "differs",
    "dup_key",
    "iso_utc",
    "norm_key",
    "not_blank",
    "random_id",
    "short_key",
    "stable_id",
]
