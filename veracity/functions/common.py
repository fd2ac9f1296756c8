"""Small numeric / JSON / time scalar functions (F7, F13-F16) and helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_hash(col, salt: str) -> Column:
    """Deterministic value in [0, 1): first 8 hex digits of md5(salt:id) / 2^32.

    Used for reproducible splits and as a stand-in model score; integer over a
    power of two, so it is exact in every engine."""
    key = F.concat(F.lit(salt + ":"), as_col(col).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def hash32(col, salt: str) -> Column:
    """The 32-bit integer behind :func:`unit_hash`."""
    key = F.concat(F.lit(salt + ":"), as_col(col).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def sigmoid(col) -> Column:
    """logit -> P(real)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_col(col)))


def softmax_pos(z0, z1) -> Column:
    """second entry of a two-class softmax, = sigmoid(z1 - z0)."""
    return sigmoid(as_col(z1) - as_col(z0))


def round4(col) -> Column:
    """metric rounding (HALF_UP, same as Python ``round`` off ties)."""
    return F.round(as_col(col), 4)


def confidence_pct(conf) -> Column:
    """numeric percentage with one decimal."""
    return F.round(as_col(conf) * 100.0, 1)


def confidence_label(conf) -> Column:
    """``f"{conf*100:.1f}%"``. Java rounds half-up on exact binary ties,
    Python half-even; documented, not emulated."""
    return F.format_string("%.1f%%", as_col(conf) * 100.0)


def json_int(col, key: str, default: int = 0) -> Column:
    """F16: ``int(obj.get(key, default))``; unparsable / non-integer -> null.

    ``get_json_object`` returns null both for a missing key and for a broken
    document, so the two are told apart with ``json_object_keys``."""
    c = as_col(col)
    raw = F.get_json_object(c, f"$.{key}")
    keys = F.json_object_keys(c)
    parsed_ok = keys.isNotNull()
    has_key = F.coalesce(F.array_contains(keys, key), F.lit(False))
    value = raw.try_cast("int")
    return (
        F.when(~parsed_ok, F.lit(None).cast("int"))
        .when(~has_key, F.lit(default))
        .otherwise(value)
    )


def json_text(col, key: str = "text") -> Column:
    """F16: ``obj.get(key, "").strip()``; unparsable -> null."""
    c = as_col(col)
    raw = F.get_json_object(c, f"$.{key}")
    parsed_ok = F.json_object_keys(c).isNotNull()
    from veracity.functions.text import strip_ws

    return F.when(parsed_ok, strip_ws(F.coalesce(raw, F.lit(""))))


def row_time(col) -> Column:
    """``%Y-%m-%d %H:%M:%S`` row time string."""
    return F.date_format(as_col(col), "yyyy-MM-dd HH:mm:ss")


def snapshot_file_name(col) -> Column:
    """``news_%Y%m%d_%H%M.csv`` snapshot file name."""
    return F.concat(F.lit("news_"), F.date_format(as_col(col), "yyyyMMdd_HHmm"), F.lit(".csv"))


def snapshot_time_from_name(col) -> Column:
    """F7 inverse: parse the time back out of a snapshot file name."""
    stamp = F.regexp_extract(as_col(col), r"(\d{8}_\d{4})", 1)
    return F.to_timestamp(F.nullif(stamp, F.lit("")), "yyyyMMdd_HHmm")
