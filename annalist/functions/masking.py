"""Deterministic masks as column expressions (no UDF).

Every mask maps equal inputs to equal outputs, so masked values stay groupable.  ``strict``
variants never let a malformed value through unmasked.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a published column shows when there is nothing safe to show.
REDACTED_EMAIL = "REDACTED_EMAIL"
REDACTED_PHONE = "REDACTED_PHONE"
REDACTED_POSTAL = "REDACTED_POSTAL"
REDACTED_NAME = "REDACTED_NAME"
REDACTED_BIRTHYEAR = "REDACTED_BIRTHYEAR"
BODY = "***"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _alnum(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z0-9]", "")


def _last(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))


def mask_email(c: Column | str, strict: bool = False) -> Column:
    """``first***last@domain`` from the letters and digits of the local part.

    Default: missing or blank is redacted, an address without ``@`` becomes NULL, and only the
    text between the first two ``@`` counts as domain.  Strict: anything without ``@`` is
    redacted, everything behind the first ``@`` is the domain, and a local part of one or two
    characters shows its first only.
    """
    mail = _col(c)
    local = _alnum(F.substring_index(mail, "@", 1))
    head, tail = F.left(local, F.lit(1)), _last(local, 1)
    if not strict:
        domain = F.get(F.split(mail, "@"), F.lit(1))
        shown = F.concat(head, F.lit(BODY), tail, F.lit("@"), domain)
        return F.when(mail.isNull() | (F.trim(mail) == ""), REDACTED_EMAIL).otherwise(shown)
    at = F.instr(mail, "@")
    domain = F.substr(mail, at + 1)
    tail = F.when(F.length(local) > 2, tail).otherwise("")
    shown = F.concat(head, F.lit(BODY), tail, F.lit("@"), domain)
    return F.when(at > 0, shown).otherwise(REDACTED_EMAIL)


def mask_phone(c: Column | str) -> Column:
    """Keeps a leading ``+`` and the last four digits."""
    kept = F.regexp_replace(_col(c), "[^0-9+]", "")
    digits = F.regexp_replace(kept, "[^0-9]", "")
    plus = F.when(F.startswith(kept, F.lit("+")), "+").otherwise("")
    shown = F.concat(plus, F.lit(BODY + BODY + "-"), _last(digits, 4))
    return F.when(F.length(digits) >= 4, shown).otherwise(REDACTED_PHONE)


def mask_postal(c: Column | str) -> Column:
    """Keeps the last three characters, or the last one of a code shorter than three."""
    code = _col(c)
    packed = F.replace(code, F.lit(" "), F.lit(""))
    tail = F.when(F.length(packed) >= 3, _last(packed, 3)).otherwise(_last(packed, 1))
    return F.when(F.length(code) > 0, F.concat(F.lit(BODY), tail)).otherwise(REDACTED_POSTAL)


def mask_name(c: Column | str) -> Column:
    """Initials of the first and last word; a one-word name shows its initial twice."""
    name = F.regexp_replace(_col(c), r"^\s+|\s+$", "")
    words = F.split(name, r"\s+")
    first = F.upper(F.left(F.get(words, F.lit(0)), F.lit(1)))
    last = F.upper(F.left(F.element_at(words, -1), F.lit(1)))
    shown = F.concat(first, F.lit(BODY + " "), last, F.lit("."))
    return F.when(F.length(name) > 0, shown).otherwise(REDACTED_NAME)


def birth_year(c: Column | str, strict: bool = False) -> Column:
    """Year of a date as text.  Strict reads ISO text and redacts a missing value."""
    if strict:
        year = F.substring_index(_col(c).cast("string"), "-", 1)
        return F.coalesce(year, F.lit(REDACTED_BIRTHYEAR))
    return F.year(_col(c)).cast("string")


def last4(c: Column | str, strict: bool = False) -> Column:
    """Last four characters; '' when missing.  Strict gives '' for values shorter than four."""
    value = F.coalesce(_col(c), F.lit(""))
    if strict:
        return F.when(F.length(value) >= 4, _last(value, 4)).otherwise("")
    return _last(value, 4)
