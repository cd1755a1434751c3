"""Text expressions: hashing, padding, code extraction, pattern flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FNV-1a, 32 bit (offset basis, prime, word mask).
FNV_BASIS = 2166136261
FNV_PRIME = 16777619
WORD_MASK = 0xFFFFFFFF

# Fixed value: procedure code as it appears inside a level-of-service name.
PROCEDURE_PATTERN = r"HC PR ([A-Z]\d{4}|\d{4}[A-Z]|\d{5}) "


def _state_after(prefix: str) -> int:
    """Hash state once a constant prefix has been consumed."""
    state = FNV_BASIS
    for byte in prefix.encode("utf-8"):
        state = ((state ^ byte) * FNV_PRIME) & WORD_MASK
    return state


def fnv1a(text: Column, prefix: str = "") -> Column:
    """FNV-1a over the UTF-8 bytes of ``prefix + text``, as a bigint.

    The bytes are viewed as Latin-1 characters so ``ascii`` yields each byte; the
    constant prefix is folded on the driver and costs nothing per row.
    """
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    chars = F.filter(F.split(latin, ""), lambda c: c != F.lit(""))
    return F.aggregate(
        chars,
        F.lit(_state_after(prefix)).cast("bigint"),
        lambda h, c: (h.bitwiseXOR(F.ascii(c).cast("bigint")) * F.lit(FNV_PRIME)).bitwiseAND(
            F.lit(WORD_MASK).cast("bigint")
        ),
    )


def hash_id(source_id: Column, salt: str) -> Column:
    """Surrogate id: decimal text of the hash of ``salt#source_id``.

    This is a stable key, not anonymisation: 32 bits can be enumerated.
    """
    return fnv1a(source_id.cast("string"), f"{salt}#").cast("string")


def pad_left(text: Column, width: int, fill: str = "0") -> Column:
    """Pad short text; longer text is kept whole (``lpad`` alone would cut it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, fill)).otherwise(text)


def procedure_code(code: Column, name: Column, pattern: str = PROCEDURE_PATTERN) -> Column:
    """Keep ``code``; where it is null take the code written inside ``name``."""
    found = F.regexp_extract(name, pattern, 1)
    return F.coalesce(code, F.when(found != "", found))


def starts_with_any(text: Column, patterns: list[str]) -> Column:
    """Case-insensitive match at the start of the text; null counts as no match.

    Patterns are regular expressions, so an unescaped dot matches any character.
    """
    joined = "|".join(patterns)
    return F.coalesce(text.rlike(f"(?i)^({joined})"), F.lit(False))
