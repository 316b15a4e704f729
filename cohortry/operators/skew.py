"""Joins that no key can bring to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has more than one of so many shares of the weight; there are fewer heavy keys than shares.
SHARES = 200


def lookup(left: DataFrame, right: DataFrame, on: list[str], weight: str, total: int, *, how: str = "inner") -> DataFrame:
    """``left`` with the row of ``right`` for its key; a key has one row in ``right``.

    ``weight``: a column of ``right`` that is at least the number of the key's rows in ``left``; ``total``: what counts as the
    whole. Rows of heavy keys are met by broadcast of those keys, at most the sum of weights / ``total`` * SHARES rows; all others by
    shuffle, where no key has more than ``total`` / SHARES rows. Null keys meet nothing. ``left`` is read twice: stage it.
    """
    is_heavy = F.coalesce(F.col(weight) * SHARES > F.lit(total), F.lit(False))
    heavy, light = right.where(is_heavy), right.where(~is_heavy)
    by_broadcast = left.join(F.broadcast(heavy), on)
    rest = left.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return by_broadcast.unionByName(rest.join(light, on, how))
