"""Text cleaning: header names, decimals with a comma, hours, dates, NA cells."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteomart.constants import NA_TOKENS


# --------------------------------------------------------------------------
# Header-name normalisation (NFKD -> ASCII, lower, non-alphanumerics to "_").
# Station files are decoded as latin-1, so every input character is one of
# the 256 latin-1 code points.  The ASCII folding of the 128 upper ones is
# derived here from the Unicode database, not typed in by hand.
# --------------------------------------------------------------------------
def _latin1_ascii_folding():
    single_src, single_dst, deleted, multi = [], [], [], []
    for code in range(0x80, 0x100):
        ch = chr(code)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if folded == "":
            deleted.append(ch)
        elif len(folded) == 1:
            single_src.append(ch)
            single_dst.append(folded)
        else:
            multi.append((ch, folded))
    return "".join(single_src), "".join(single_dst), "".join(deleted), multi


_FOLD_SRC, _FOLD_DST, _FOLD_DELETE, _FOLD_MULTI = _latin1_ascii_folding()


def fold_lower(c: Column) -> Column:
    """ASCII folding + lower case: the letters and digits a name normalises to."""
    x = c
    for ch, folded in _FOLD_MULTI:
        x = F.replace(x, F.lit(ch), F.lit(folded))
    # translate() deletes characters of the source list that have no partner.
    return F.lower(F.translate(x, _FOLD_SRC + _FOLD_DELETE, _FOLD_DST))


def normalize_col(c: Column) -> Column:
    """Spark version of the header-name normaliser (exact for latin-1 text)."""
    x = fold_lower(c)
    x = F.regexp_replace(x, "[^a-z0-9]+", "_")
    return F.regexp_replace(x, "^_+|_+$", "")


_PY_FOLD = {**{ord(a): b for a, b in zip(_FOLD_SRC, _FOLD_DST)},
            **{ord(ch): None for ch in _FOLD_DELETE},
            **{ord(ch): folded for ch, folded in _FOLD_MULTI}}
_NOT_ALNUM = re.compile("[^a-z0-9]+")


def py_normalize_col(name) -> str:
    """Plain-Python twin of :func:`normalize_col` (same fold table), for the
    handful of header names resolved at plan time."""
    return _NOT_ALNUM.sub("_", str(name).translate(_PY_FOLD).lower()).strip("_")


def py_parse_years(raw_years: str) -> list[int]:
    """``"2024, 2025"`` -> ``[2024, 2025]``; blanks skipped; empty is an error."""
    years = [int(tok.strip()) for tok in str(raw_years).split(",") if tok.strip()]
    if not years:
        raise ValueError("empty year list; expected e.g. '2026'")
    return years


# --------------------------------------------------------------------------
# Silver cleaning.
# --------------------------------------------------------------------------
def clean_text(c: Column) -> Column:
    """Strip every leading ';' (preamble values keep the separator)."""
    return F.ltrim(c, F.lit(";"))


def clean_decimal(c: Column, precision: int, scale: int, on_bad: str = "error") -> Column:
    """Decimal comma -> dot, '' and 'NULL' -> NULL, then cast to decimal(p, s).

    The cast rounds half-up.  ``on_bad='error'`` keeps the ANSI behaviour of
    failing the query on unparsable text; ``'null'`` turns it into NULL.
    """
    # Same result as NULLIF(NULLIF(REPLACE(c, ',', '.'), ''), 'NULL'): the comma
    # swap never makes or breaks '' / 'NULL', so test the input and replace once.
    text = F.when(~c.isin("", "NULL"), F.replace(c, F.lit(","), F.lit(".")))
    dtype = f"decimal({precision},{scale})"
    return text.try_cast(dtype) if on_bad == "null" else text.cast(dtype)


def na_to_null(c: Column) -> Column:
    """Cells spelled as a missing-value token become NULL (exact match)."""
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def try_numeric(c: Column, strict_dot: bool = False) -> Column:
    """Lenient number parse for validation: bad text -> NULL (double).

    By default a decimal comma is read as a dot; ``strict_dot=True`` keeps the
    upstream behaviour where ``"25,3"`` is not a number.
    """
    text = c if strict_dot else F.replace(c, F.lit(","), F.lit("."))
    return text.try_cast("double")


# --------------------------------------------------------------------------
# Raw shaping of station rows.
# --------------------------------------------------------------------------
def parse_hour(c: Column) -> Column:
    """'0100 UTC' -> '01:00:00'; digits only, left-padded to 4, first 4 used."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    # lpad pads short values and truncates long ones to their first 4 chars.
    hhmm = F.lpad(digits, 4, "0")
    return F.when(digits != "", F.concat(F.substring(hhmm, 1, 2), F.lit(":"),
                                         F.substring(hhmm, 3, 2), F.lit(":00")))


def coerce_date(c: Column) -> Column:
    """Year-first date text ('2024-01-31' or '2024/01/31') -> ISO text, else NULL."""
    # A pattern can only match text containing its literal separator; testing
    # that first skips the parser's (costly) failure path for the other form.
    parsed = F.coalesce(F.when(c.contains("-"), F.try_to_date(c, "yyyy-MM-dd")),
                        F.when(c.contains("/"), F.try_to_date(c, "yyyy/MM/dd")))
    return F.date_format(parsed, "yyyy-MM-dd")
