"""De-identification expressions: salted tokens, date shifts, text redaction."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the published tokens, shifts and masks.
TOKEN_PREFIX = "DEID-"
TOKEN_HEX_DIGITS = 64
SHIFT_SPAN_DAYS = 61
SHIFT_MIN_DAYS = -30
SSN_RULE = (r"\d{3}-\d{2}-\d{4}", "[REDACTED_SSN]")
TOP_CODED_AGE = 90


def _sha256_hex(value: Column, salt: str) -> Column:
    """Digest of the salted text; null for null and for empty text."""
    return F.sha2(F.concat(F.nullif(value.cast("string"), F.lit("")), F.lit(salt)), 256)


def token(value: Column, salt: str, hex_digits: int = TOKEN_HEX_DIGITS) -> Column:
    """Salted one-way token of a value; null and empty text give null.

    The whole digest by default, as tokens serve as keys. Fewer `hex_digits` make values
    collide: with ten, 40 bits, about 45 pairs of 10 million values.
    """
    if not salt:
        raise ValueError("token: a salt is required")
    if not 1 <= hex_digits <= 64:
        raise ValueError("token: hex_digits must be between 1 and 64")
    digest = _sha256_hex(value, salt)
    return F.concat(F.lit(TOKEN_PREFIX), digest if hex_digits == TOKEN_HEX_DIGITS else F.substring(digest, 1, hex_digits))


def packed(value: Column) -> Column:
    """Text as bytes for a shuffle: a whole token as its 32-byte digest, any other text as it is; see `unpacked`."""
    # bytes are cut, as a cut of text looks at every character; and no pattern, since each shuffled row is looked at
    digits = F.substring(value.cast("binary"), len(TOKEN_PREFIX) + 1, 64).cast("string")
    shape = (F.octet_length(value) == len(TOKEN_PREFIX) + 64) & value.startswith(TOKEN_PREFIX) & (F.lower(digits) == digits)
    digest = F.when(shape, F.unhex(digits))  # null for what is no digit
    return F.coalesce(F.concat(F.lit(b"\x01"), digest), F.concat(F.lit(b"\x00"), value.cast("binary")))


def unpacked(value: Column) -> Column:
    """The text that `packed` was given."""
    rest = F.substring(value, 2, 2**31 - 1)
    token_of = F.concat(F.lit(TOKEN_PREFIX), F.lower(F.hex(rest)))
    return F.when(F.substring(value, 1, 1) == F.lit(b"\x01"), token_of).otherwise(rest.cast("string"))


def shift_days(person: Column, salt: str = "") -> Column:
    """Stable shift between -30 and +30 days of a person; null without a person.

    This is the 256-bit SHA-256 number modulo 61. No Spark type holds 256 bits, so
    the remainder is a sum over words of 13 hex digits: 52 bits each, times a weight
    below 2^6, which a long holds for all five of them.
    """
    digest = _sha256_hex(person, salt)
    word_digits = 13
    parts = []
    for start in range(0, 64, word_digits):
        digits = min(word_digits, 64 - start)
        weight = pow(16, 64 - start - digits, SHIFT_SPAN_DAYS)
        word = F.substring(digest.cast("binary"), start + 1, digits).cast("string")  # bytes are cut faster than text
        parts.append(F.conv(word, 16, 10).cast("bigint") * weight)
    return (reduce(add, parts) % SHIFT_SPAN_DAYS + SHIFT_MIN_DAYS).cast("int")


def shifted_date(value: Column, person: Column, salt: str = "") -> Column:
    """Date of `value` moved by the person's shift; null without a person."""
    return F.date_add(value.cast("date"), shift_days(person, salt))


def redacted(text: Column, rules: Iterable[tuple[str, str]] = (SSN_RULE,)) -> Column:
    """Text with every match of every (pattern, replacement) replaced, in order."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def top_coded_age(age: Column) -> Column:
    """Ages over 89 become one group."""
    return F.when(age >= TOP_CODED_AGE, F.lit(TOP_CODED_AGE)).otherwise(age)


def masked(value: Column, role: Column, mask: str, clear_roles: Iterable[str]) -> Column:
    """The value for the named roles, the mask for anyone else, an unknown role included."""
    allowed = F.coalesce(F.upper(role).isin([r.upper() for r in clear_roles]), F.lit(False))
    return F.when(allowed, value.cast("string")).otherwise(F.lit(mask))
