"""Scalar column functions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "resource_location", "split_s3_url", "hash_from_path", "split_words",
    "strip_collection_suffix", "base_name", "dataset_from_path", "underscore",
    "hyphenate", "to_bigint", "in_range", "day_text", "content_hash",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def resource_location(remote_path, collection: str, bucket: str | None = None,
                      base_url: str | None = None) -> Column:
    """Location of an object under ``<collection>-collection/``.

    A bucket wins over a base URL; neither is an error. Trailing slashes of the
    base URL are trimmed to exactly one.
    """
    if bucket:
        prefix = f"s3://{bucket}/{collection}-collection/"
    elif base_url:
        prefix = base_url.rstrip("/") + "/" + f"{collection}-collection/"
    else:
        raise ValueError("Either bucket or base_url must be provided")
    return F.concat(F.lit(prefix), _c(remote_path))


def split_s3_url(url) -> Column:
    """``s3://bucket/key`` -> struct(bucket, key)."""
    u = _c(url)
    return F.struct(
        F.regexp_extract(u, r"^s3://([^/]+)/?(.*)$", 1).alias("bucket"),
        F.regexp_extract(u, r"^s3://([^/]+)/?(.*)$", 2).alias("key"),
    )


def hash_from_path(path) -> Column:
    """The lowercase hex resource hash after ``resource/`` in a path ('' if none)."""
    return F.regexp_extract(_c(path), r"resource/([a-f0-9]+)", 1)


def split_words(text) -> Column:
    """Split on whitespace; null or blank gives an empty list."""
    t = F.trim(_c(text))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")) \
        .otherwise(F.split(t, r"\s+"))


def strip_collection_suffix(name) -> Column:
    return F.regexp_replace(_c(name), r"-collection$", "")


def base_name(path) -> Column:
    """Last path component."""
    return F.element_at(F.split(_c(path), "/"), -1)


def dataset_from_path(path) -> Column:
    """``.../<dataset>/<file>`` -> dataset (the parent directory name)."""
    return F.regexp_extract(_c(path), r"([^/]+)/[^/]+$", 1)


def underscore(name) -> Column:
    return F.translate(_c(name), "-", "_")


def hyphenate(name) -> Column:
    return F.translate(_c(name), "_", "-")


def to_bigint(x) -> Column:
    """Tolerant integer parse: bad text or overflow gives null, never an error."""
    return F.expr(f"try_cast({x} AS BIGINT)") if isinstance(x, str) else x.try_cast("bigint")


def in_range(x, lo, hi) -> Column:
    """Inclusive range check."""
    return _c(x).between(lo, hi)


def day_text(d) -> Column:
    """A date as ``YYYY-MM-DD`` text."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def content_hash(col) -> Column:
    return F.sha2(_c(col), 256)
