"""Reproducible surrogate keys and hash buckets."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.constants import KEY_SEPARATOR


def hash_key(*parts: Column | str, sep: str = KEY_SEPARATOR) -> Column:
    """SHA-256 hex of the parts joined by `sep`; null parts are left out."""
    return F.sha2(F.concat_ws(sep, *[_col(p).cast("string") for p in parts]), 256)


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the key's MD5.

    Any engine with MD5 gives the same bucket, whatever the partitioning.
    """
    head = F.substring(F.md5(_col(key).cast("string")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def _col(part: Column | str) -> Column:
    return F.col(part) if isinstance(part, str) else part
