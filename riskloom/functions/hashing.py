"""Hash, bucket and cipher column functions (FN1-FN4, ML2's bucket).

Everything here is a built-in JVM expression except the memory-hard hash,
which has no Spark builtin and runs as an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import base64
import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_int(*parts) -> Column:
    """Deterministic 60-bit unsigned integer from the md5 of ``parts`` joined
    with ':' — independent of partitioning, and repeatable in any SQL engine
    (first 15 hex digits of md5)."""
    text = F.concat_ws(":", *[_c(p) if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_bucket(n: int, *parts) -> Column:
    """``hash_int(parts) % n`` — a stable bucket in [0, n)."""
    return F.pmod(hash_int(*parts), F.lit(n))


def hash_unit(*parts, resolution: int = 1_000_000) -> Column:
    """A deterministic uniform number in [0, 1) with ``resolution`` steps."""
    return (F.pmod(hash_int(*parts), F.lit(resolution)) / F.lit(float(resolution))).cast("double")


def strip_newlines(col) -> Column:
    """FN21: remove newline characters from a field."""
    return F.regexp_replace(_c(col), "\n", "")


def hidden(spark, value: str) -> Column:
    """``value`` as a scalar subquery over a one-row table: a key or salt that
    no plan text, event log or literal shows.  The row comes as Arrow data, so
    the table is local to the plan and no job or Python worker reads it."""
    import pyarrow as pa

    return spark.createDataFrame(pa.table({"hidden": pa.array([value], pa.string())})).scalar()


def _text(x: str | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def salted_sha256(col, salt: str | Column) -> Column:
    """FN1: hex sha256 of salt || value; NULL hashes as the empty string.
    Pass the salt as :func:`hidden` to keep it out of the plan."""
    return F.sha2(F.concat(_text(salt), F.coalesce(_c(col).cast("string"), F.lit(""))), 256)


def aes_encrypt_b64(col, key_hex: str | Column) -> Column:
    """FN3: AES-CBC with PKCS padding and a random IV; base64(IV || ciphertext).
    Pass the key as :func:`hidden` to keep it out of the plan."""
    key = F.unhex(_text(key_hex))
    return F.base64(F.aes_encrypt(F.coalesce(_c(col).cast("string"), F.lit("")), key, F.lit("CBC"), F.lit("PKCS")))


def aes_decrypt_b64(col, key_hex: str | Column) -> Column:
    """Inverse of :func:`aes_encrypt_b64`."""
    key = F.unhex(_text(key_hex))
    return F.aes_decrypt(F.unbase64(_c(col)), key, F.lit("CBC"), F.lit("PKCS")).cast("string")


def encryption_context(wrapped_key_b64: str, key_id: str) -> Column:
    """FN4: ``base64(wrapped key):key id`` as a constant column."""
    return F.lit(f"{wrapped_key_b64}:{key_id}")


# Memory-hard hash parameters and output layout.  Fixed values.
SCRYPT_LOG2_N = 5
SCRYPT_R = 8
SCRYPT_P = 1
SCRYPT_DKLEN = 32


def scrypt_hash_udf(salt: str):
    """FN2: ``$scrypt$ln=5,r=8,p=1$$`` + unpadded base64 of scrypt(value).

    No Spark builtin computes scrypt, so this is an Arrow-batched pandas UDF
    (one hashlib call per distinct value of each batch, so a repeated value
    is hashed once per batch).  It is a narrow map: no shuffle, so a hot
    value cannot skew a task.
    """
    salt_b = salt.encode("utf-8")
    prefix = f"$scrypt$ln={SCRYPT_LOG2_N},r={SCRYPT_R},p={SCRYPT_P}$$"

    def one(v: str) -> str:
        h = hashlib.scrypt(
            (v or "").encode("utf-8"),
            salt=salt_b,
            n=1 << SCRYPT_LOG2_N,
            r=SCRYPT_R,
            p=SCRYPT_P,
            dklen=SCRYPT_DKLEN,
        )
        return prefix + base64.b64encode(h).decode("ascii").rstrip("=")

    @pandas_udf(StringType())
    def _scrypt(values: pd.Series) -> pd.Series:
        hashed = {v: one(v) for v in values.unique()}
        return values.map(hashed)

    return _scrypt
