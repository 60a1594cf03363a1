"""Binary bodies (EXT-16, SRC-5)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pageloom.functions.util import col_of
from pageloom.session import ship_package

# Leading bytes (hex) of the accepted image formats.
SIGNATURES = [
    ("jpeg", "FFD8FF"),
    ("png", "89504E470D0A1A0A"),
    ("gif", "474946383761"),
    ("gif", "474946383961"),
    ("bmp", "424D"),
]


def image_kind(body) -> Column:
    """EXT-16: image format by signature (RIFF....WEBP too), NULL when the
    bytes do not start like an image.  Full decoding is not attempted."""
    head = F.hex(F.substring(col_of(body), 1, 12))
    kind = F.lit(None).cast("string")
    for name, sig in reversed(SIGNATURES):
        kind = F.when(head.startswith(sig), F.lit(name)).otherwise(kind)
    webp = head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250")
    return F.when(webp, F.lit("webp")).otherwise(kind)


def image_signature(bodies: DataFrame, min_bytes: int = 20) -> DataFrame:
    """Rows kept only when the body is longer than ``min_bytes`` and starts
    with an image signature."""
    k = image_kind("body")
    return (bodies.where((F.octet_length("body") > min_bytes) & k.isNotNull())
            .select("page_id", k.alias("kind"), F.octet_length("body").cast("int").alias("n_bytes")))


@pandas_udf(T.StringType())
def decode_gb(body: pd.Series) -> pd.Series:
    """SRC-5: GB2312 page bytes to text (GB18030 is a superset); a truncated
    trailing character becomes U+FFFD instead of failing the row."""
    return body.map(lambda b: None if b is None else bytes(b).decode("gb18030", errors="replace"))


@pandas_udf(T.BinaryType())
def encode_gb(text: pd.Series) -> pd.Series:
    """Text to GB2312 bytes (fixture helper for SRC-5)."""
    return text.map(lambda t: None if t is None else t.encode("gb2312", errors="replace"))


def decode_bodies(df: DataFrame, body_col: str = "body") -> DataFrame:
    """SRC-5 as a job: decode, then everything downstream is native."""
    ship_package(df.sparkSession)
    return df.withColumn("html", decode_gb(F.col(body_col)))


def encode_bodies(df: DataFrame, text_col: str, body_col: str = "body") -> DataFrame:
    """Fixture helper: text to GB2312 bytes."""
    ship_package(df.sparkSession)
    return df.withColumn(body_col, encode_gb(F.col(text_col)))
