"""Column expressions (X1-X13, P5-P7, F3): all built-in, JVM-side, codegen'd.

Every helper takes and returns a ``Column`` so it composes inside one
projection; none of them triggers a job.  Casts are lenient the explicit way
(``try_cast``) so that ANSI mode stays on for the rest of the plan.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings

def clean_text(c: ColumnOrName) -> Column:
    """Trim surrounding spaces."""
    return F.trim(_col(c))


def clean_code(c: ColumnOrName) -> Column:
    """Trim and lower-case a categorical code such as ``" Left "`` (X1+X2)."""
    return F.trim(F.lower(_col(c)))


# ---------------------------------------------------------------- lenient casts

def to_int(c: ColumnOrName) -> Column:
    """Text or number to int; ``'3.7'`` -> 3, ``'1.0'`` -> 1, junk/overflow -> null.

    Goes through double first: a direct ``try_cast('3.7' as int)`` is null.
    Truncates toward zero like the non-ANSI cast the reference relied on.
    """
    return _col(c).try_cast("double").try_cast("int")


def to_id(c: ColumnOrName) -> Column:
    """Text or number to a 64-bit id: whole numbers only (``'5'``, ``'5.0'``, ``'5e3'``), anything else null.

    Never rounds: the text is tested, so ``'5.2'`` and ``'5.0000001'`` are no ids however long the fraction,
    and an id beyond 32 bits stays what it is.  Exponents are read up to 15 digits, which a double holds exactly.
    """
    text = F.trim(_col(c).cast("string"))
    whole = F.regexp_extract(text, r"^([+-]?\d+)(?:\.0*)?$", 1).try_cast("bigint")
    power = text.rlike(r"^[+-]?\d(?:\.\d{1,14})?[eE][+-]?\d{1,3}$")
    number = text.try_cast("double")
    return F.when(power, F.when((number == F.floor(number)) & (F.abs(number) < 2.0 ** 53), number.try_cast("bigint"))) \
        .otherwise(whole)


def to_float(c: ColumnOrName) -> Column:
    """Text or number to 32-bit float, junk -> null."""
    return _col(c).try_cast("float")


def to_double(c: ColumnOrName) -> Column:
    """Text or number to double, junk -> null (recommended for money)."""
    return _col(c).try_cast("double")


def to_date(c: ColumnOrName) -> Column:
    """Text or timestamp to date, junk -> null."""
    return _col(c).try_cast("date")


# ---------------------------------------------------------------- predicates

def is_positive(c: ColumnOrName) -> Column:
    """Strictly positive and a real number: NaN > 0 is true in Spark, so exclude it."""
    v = _col(c)
    return (v > 0) & ~F.isnan(v)


# ---------------------------------------------------------------- dates

def year_of(c: ColumnOrName) -> Column:
    """Calendar year of a date or timestamp, as int."""
    return F.year(_col(c))


def years_between(as_of: _dt.date | str, c: ColumnOrName) -> Column:
    """Calendar-year difference ``year(as_of) - year(c)`` as int.

    ``as_of`` is a parameter, never ``current_date()``, so results do not move
    with the wall clock.
    """
    as_of_year = (as_of if isinstance(as_of, _dt.date)
                  else _dt.date.fromisoformat(str(as_of))).year
    return (F.lit(as_of_year) - F.year(_col(c))).cast("int")


# ---------------------------------------------------------------- arithmetic

def ratio(numerators: list[ColumnOrName], denominator: ColumnOrName,
          scale: int | None = 2) -> Column:
    """``round(sum(numerators) / denominator, scale)``; null when the denominator is 0."""
    num = None
    for n in numerators:
        num = _col(n) if num is None else num + _col(n)
    out = F.try_divide(num, _col(denominator).cast("double"))
    return F.round(out, scale) if scale is not None else out


# ---------------------------------------------------------------- buckets

def bucket(c: ColumnOrName, edges: list[tuple[float, str]], otherwise: str) -> Column:
    """CASE WHEN c >= edge THEN label ... ELSE otherwise, edges checked in order."""
    v = _col(c)
    expr = None
    for edge, label in edges:
        expr = F.when(v >= edge, label) if expr is None else expr.when(v >= edge, label)
    return expr.otherwise(otherwise) if expr is not None else F.lit(otherwise)


# ---------------------------------------------------------------- formatting

def format_amount(c: ColumnOrName, unit: str = "EUR") -> Column:
    """``1234567.5`` -> ``'1,234,568 EUR'``.

    Rounds half-up first: ``format_number`` alone rounds half-even.
    """
    return F.concat(F.format_number(F.round(_col(c), 0), 0), F.lit(f" {unit}"))


def normalise_path(c: ColumnOrName) -> Column:
    """Backslashes to forward slashes."""
    return F.regexp_replace(_col(c), r"\\", "/")


def relative_to(c: ColumnOrName, root: str) -> Column:
    """Strip a root prefix from a normalised path."""
    root = root.replace("\\", "/").rstrip("/") + "/"
    # re.escape only puts backslashes before non-letters, which Java regex reads literally
    return F.regexp_replace(normalise_path(c), "^" + re.escape(root), "")


def bytes_to_mb(c: ColumnOrName, scale: int = 2) -> Column:
    """Bytes to MiB rounded to ``scale`` places."""
    return F.round(_col(c) / F.lit(1024 * 1024), scale)
