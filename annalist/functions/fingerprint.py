"""Row fingerprints and stable tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SALT_CONF = "spark.annalist.salt"


def joined_text(
    columns: Sequence[Column], separator: str = "|", missing: str | None = None
) -> Column:
    """Columns as text joined by ``separator``.

    NULLs leave no trace in the text unless ``missing`` says what stands for them.
    """
    texts = [c.cast("string") for c in columns]
    if missing is not None:
        texts = [F.coalesce(t, F.lit(missing)) for t in texts]
    return F.concat_ws(separator, *texts)


def null_safe_text(columns: Sequence[Column]) -> Column:
    """Columns as one JSON text in which NULL, '' and the position of a value are distinct."""
    named = [c.cast("string").alias(f"c{i}") for i, c in enumerate(columns)]
    return F.to_json(F.struct(*named), {"ignoreNullFields": "false"})


def fingerprint(
    columns: Sequence[Column],
    separator: str = "|",
    null_safe: bool = False,
    missing: str | None = None,
) -> Column:
    text = null_safe_text(columns) if null_safe else joined_text(columns, separator, missing)
    return F.sha2(text, 256)


def configured_salt(spark) -> str:
    """The session's secret salt; tokens of a known salt could be looked up in a dictionary."""
    salt = spark.conf.get(SALT_CONF, None)
    if not salt:
        raise RuntimeError(f"set {SALT_CONF} to a secret text before building tokens")
    return salt


def stable_token(c: Column | str, salt: str) -> Column:
    """Salted SHA-256 of a value; a missing value is tokenised as the empty text."""
    value = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat_ws("|", F.lit(salt), F.coalesce(value.cast("string"), F.lit(""))), 256)
