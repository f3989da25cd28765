"""Diagnosis-code string helpers (ICD-9 / ICD-10)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Candidate keys tried for one recorded code, in priority order.
# 1 the code itself, 2 the code without its last digit, 3 code + '0',
# 4 code + '9', 5 code + '1'.
CANDIDATE_SUFFIXES = ("0", "9", "1")


def strip_last_digit(code: Column) -> Column:
    """Drop one trailing digit; a code without a trailing digit is unchanged."""
    return F.regexp_replace(code, "[0-9]$", "")


def candidate_keys(code: Column) -> list[Column]:
    """The five candidate keys of a code, in lookup priority order."""
    return [code, strip_last_digit(code)] + [F.concat(code, F.lit(s)) for s in CANDIDATE_SUFFIXES]


def code_candidates(code: Column) -> Column:
    """Array of ``struct(candidate int, key string)`` in lookup priority order."""
    return F.array(*[F.struct(F.lit(i).alias("candidate"), key.alias("key"))
                     for i, key in enumerate(candidate_keys(code), start=1)])


def icd10_category(code: Column) -> Column:
    """Root category: the text before the first dot ('E11' for 'E11.5')."""
    return F.substring_index(code, ".", 1)


def like_family(code: Column, family: str, ignore_case: bool = False) -> Column:
    """``code LIKE '<family>.[A-Z0-9]%'`` with a character class.

    The family, a literal dot, then one letter or digit. Bare ``E11`` and
    ``E11.`` do not match. Case-sensitive unless ``ignore_case``.
    """
    flags = "(?i)" if ignore_case else ""
    return code.rlike(f"{flags}^{family}[.][A-Z0-9]")
