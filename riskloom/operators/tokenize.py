"""Tokenise a table (JOB1, FN1-FN5, FN21).

Listed fields are replaced by a salted hash (or the memory-hard hash for a
subset) and their encrypted originals appended as ``<field>_enc``, followed
by the encryption-context column.  One narrow projection: no shuffle.
Key material and salt come in as parameters; nothing secret is stored here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import aes_encrypt_b64, encryption_context, hidden, salted_sha256, scrypt_hash_udf, strip_newlines

# Output naming of the tokenised table.  Fixed values.
ENC_SUFFIX = "_enc"
CONTEXT_COLUMN = "aws_enc_ctx"


def tokenized_columns(columns: Sequence[str], fields: Sequence[str], context_col: str = CONTEXT_COLUMN) -> list[str]:
    """FN5: originals, then ``<f>_enc`` in field order, then the context."""
    return list(columns) + [f"{f}{ENC_SUFFIX}" for f in fields] + [context_col]


def tokenize(
    df: DataFrame,
    fields: Sequence[str],
    salt: str,
    key_hex: str,
    context: tuple[str, str],
    slow_fields: Sequence[str] = (),
    context_col: str = CONTEXT_COLUMN,
) -> DataFrame:
    """JOB1.  ``context`` = (base64 wrapped key, key id)."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"fields not in table: {missing}")
    bad = [f for f in slow_fields if f not in fields]
    if bad:
        raise ValueError(f"slow_fields must be among fields; these are not: {bad}")
    spark = df.sparkSession
    salt_column, key_column = hidden(spark, salt), hidden(spark, key_hex)  # neither shows in a plan
    clean = {c: F.coalesce(strip_newlines(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns}
    slow = scrypt_hash_udf(salt) if slow_fields else None
    out = []
    for c in df.columns:
        if c in slow_fields:
            out.append(slow(clean[c]).alias(c))
        elif c in fields:
            out.append(salted_sha256(clean[c], salt_column).alias(c))
        else:
            out.append(clean[c].alias(c))
    for f in fields:
        out.append(aes_encrypt_b64(clean[f], key_column).alias(f"{f}{ENC_SUFFIX}"))
    out.append(encryption_context(*context).alias(context_col))
    return df.select(*out)
