"""Content identifiers."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _digest(text: str | None) -> str | None:
    return None if text is None else hashlib.new("ripemd160", text.encode("utf-8")).hexdigest()


@F.pandas_udf(StringType())
def _ripemd160(text: pd.Series) -> pd.Series:
    return text.map(_digest)


@F.pandas_udf(StructType([StructField("raw_id", StringType()), StructField("norm_id", StringType())]))
def _ripemd160_pair(prefix: pd.Series, text: pd.Series) -> pd.DataFrame:
    raw = text.map(_digest)
    norm = [_digest(p + r) if p is not None and r is not None else None for p, r in zip(prefix, raw)]
    return pd.DataFrame({"raw_id": raw, "norm_id": norm})


def content_id(*parts: Column, algo: str = "ripemd160") -> Column:
    """Hex digest of the concatenated parts.

    ``ripemd160`` keeps identifiers already in use and needs an Arrow UDF; ``sha256`` and
    ``md5`` stay in the JVM and are the faster choice for a fresh store.
    """
    text = F.concat(*parts) if len(parts) > 1 else parts[0]
    if algo == "ripemd160":
        return _ripemd160(text)
    if algo == "sha256":
        return F.sha2(text, 256)
    if algo == "md5":
        return F.md5(text)
    raise ValueError(f"unknown digest {algo!r}")


def message_ids(organization: Column, host: Column, text: Column, algo: str = "ripemd160") -> Column:
    """A struct of ``raw_id``, the id of the text, and ``norm_id``, that of organization, host and raw id.

    Both digests of the default algorithm take one Arrow round trip.
    """
    if algo == "ripemd160":
        return _ripemd160_pair(F.concat(organization, host), text)
    raw = content_id(text, algo=algo)
    return F.struct(raw.alias("raw_id"), content_id(organization, host, raw, algo=algo).alias("norm_id"))


def md5_id(*parts: Column) -> Column:
    return content_id(*parts, algo="md5")
