"""Group totals brought back to the rows of a group without gathering the group.

A group may hold a third of all rows.  Its rows carry a salt; totals are taken
per (group, salt), then per group over at most ``SALTS`` partial rows, and go
back to the salts that the group has.  A join on (group, salt) then spreads the
group's rows over as many keys, and no row is copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64
SALT = "__salt"


def with_salt(df: DataFrame, of: Column) -> DataFrame:
    """``df`` with a salt taken from ``of``, which must differ between the rows of a group."""
    return df.withColumn(SALT, F.pmod(F.xxhash64(of), F.lit(SALTS)).cast("int"))


def totals(rows: DataFrame, keys: list[str], partial: list[Column], merged: list[Column],
           keep: Column | None = None) -> DataFrame:
    """(keys, salt, the ``merged`` columns): the groups' totals, once per salt that occurs in the group.

    ``partial`` aggregates rows, ``merged`` the columns of ``partial``; ``keep`` filters groups.
    """
    found = rows.groupBy(*keys, SALT).agg(*partial).groupBy(*keys).agg(*merged, F.collect_list(SALT).alias("__salts"))
    if keep is not None:
        found = found.filter(keep)
    return found.withColumn(SALT, F.explode("__salts")).drop("__salts")
