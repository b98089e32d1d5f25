"""Scalar expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Values up to this many characters are their own grouping key, see short_key().
SHORT_KEY_CHARS = 64

_SEPARATOR = "\u001f"
_NULL_MARK = "\u0000"


def not_blank(col: Column) -> Column:
    """True for content other than spaces. A tab counts as content."""
    return col.isNotNull() & (F.length(F.trim(col)) > 0)


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)


def norm_key(col: Column) -> Column:
    """Comparison key of any type: text form, case folded, outer spaces removed."""
    return F.trim(F.lower(col.cast("string")))


def dup_key(col: Column, dtype: DataType, case_insensitive: bool = True) -> Column:
    """Duplicate-check key: text folds case when asked, other types become text. Never trims."""
    text = col.cast("string")
    return F.lower(text) if case_insensitive and isinstance(dtype, StringType) else text


def short_key(value: Column) -> Column:
    """A grouping key of bounded width that is equal exactly when the text is equal.

    Long texts are replaced by a SHA-256 digest, so a shuffle on them moves 71 characters a row rather than whole
    documents. A digest key is longer than any short value, hence the two kinds never meet.
    """
    digest = F.concat(F.lit("sha256:"), F.sha2(value, 256))
    return F.when(F.length(value) <= SHORT_KEY_CHARS, value).otherwise(digest)


def joined_text(*cols: Column) -> Column:
    """The columns as one text, with nulls and boundaries kept apart."""
    return F.concat_ws(_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(_NULL_MARK)) for c in cols])


def random_id(prefix: str, seed: int | None = None) -> Column:
    """``prefix`` and eight hex digits of a random 32-bit number.

    Draws again when a task is repeated and collides soon (half a chance at 77,000 rows): use stable_id() for anything
    that is stored.
    """
    draw = F.round((F.rand(seed) if seed is not None else F.rand()) * F.lit(4294967295.0)).cast("bigint")
    return F.concat(F.lit(prefix), F.lpad(F.lower(F.hex(draw)), 8, "0"))


def stable_id(prefix: str, *cols: Column, width: int = 16) -> Column:
    """``prefix`` and ``width`` hex digits that depend on the given columns only, so that re-runs and retries agree."""
    if not 8 <= width <= 32:
        raise ValueError("width must lie between 8 and 32 hex digits")
    return F.concat(F.lit(prefix), F.substring(F.md5(joined_text(*cols)), 1, width))


def iso_utc(col: Column) -> Column:
    """A time zone aware timestamp as ISO-8601 text in UTC."""
    return F.date_format(F.to_utc_timestamp(col, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
