"""Helpers of the text operators: written intermediates, table access and word rules."""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.session import scratch_dir

#: Bytes that are not part of a word: ASCII other than letters and digits.
_NO_WORD = bytes(b for b in range(128) if not chr(b).isalnum())
#: Lower-cases A-Z and turns every such byte into a space.
ALNUM = bytes(32 if b in _NO_WORD else b + 32 if 65 <= b <= 90 else b for b in range(256))


def importable(spark: SparkSession) -> None:
    """Let Python workers of this context find this package where the driver has it.

    On a cluster that is given the package by other means this adds a path that may
    be absent there, which does no harm.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that does not exist yet, in the folder all executors share."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: work above it is not repeated, a lost executor only costs
    the tasks that read it, and row ids given before it stay as they are.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def text_key(text: str | None) -> bytes | None:
    """The MD5 of a text, which with the id tells rows apart."""
    return None if text is None else hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def without(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose id and text (by ``text_key``) are in ``found``; nulls equal nulls."""
    gone = found.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    same = F.col(doc_id).eqNullSafe(F.col("gone_id")) & F.unhex(F.md5(F.col(text))).eqNullSafe(F.col("gone_key"))
    return docs.join(staged(gone, "gone"), same, "left_anti")


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(ALNUM).split() if text else []


def crc_remainder(doc_id, divisor: int) -> int:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % divisor


def crc_remainder_column(doc_id: Column, divisor: int) -> Column:
    """The same as a column."""
    return F.crc32(text_of(doc_id).cast("binary")) % divisor
