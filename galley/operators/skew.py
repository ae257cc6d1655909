"""A join by term that no frequent term can skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.session import materialize

#: A term with more than this part of all rows is frequent, so there are at most as many frequent terms.
FREQUENT_PARTS = 4096


def joined_by_term(pairs: DataFrame, terms: DataFrame, counted: str | None = None) -> DataFrame:
    """Inner join on ``term``; ``terms`` has one row per term and ``pairs`` is a written table.

    Frequent terms are those with more than a fixed part of all rows of ``pairs``: counted there, or told by
    the column ``counted`` of ``terms`` if that holds their rows in ``pairs``. Their rows of ``terms``, at
    most ``FREQUENT_PARTS``, are broadcast; none of the others holds more than that part of a shuffle.
    Both ways join the same rows as one plain join.
    """
    total = pairs.count()
    if counted:
        known = terms.where(F.col(counted) * FREQUENT_PARTS > total)
    else:
        known = pairs.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") * FREQUENT_PARTS > total)
    frequent = F.broadcast(materialize(known.select("term"), "frequent"))
    hot = pairs.join(F.broadcast(terms.join(frequent, "term", "left_semi")), "term")
    return hot.unionByName(pairs.join(frequent, "term", "left_anti").join(terms, "term"))
