"""Equi joins that stay balanced when a key is NULL or hot.

``spread_join`` adds one more join key. Rows whose key has a NULL part can
match nothing, so they get a scattered value there and spread over all tasks;
every other row gets zero and joins as usual. With that key neither side can
reuse an earlier partitioning, so both meet in an exchange of their own, which
is the shape adaptive execution needs to split the partition of a hot key. The
price is one more shuffle of a side that was already grouped by the key.
Catalyst and adaptive execution broadcast a side after looking at its size, and
shuffle beyond the threshold; a hint is only given behind a count of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _complete(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


#: Rows of one key column that a broadcast may hold: some megabytes in every task.
SMALL_ROWS = 100_000


def distinct_members(members: DataFrame, member: str, rows: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """The different values of a member column, and whether they were fetched and hinted for a broadcast.

    They are, if at most ``rows`` are found; more than that stay a plan, and
    joins with them shuffle. For a derived table: the planner overestimates it
    and would shuffle the large side before adaptive execution sees how small
    this one is, and every join would compute it again.
    """
    values = members.select(member).distinct()
    found = values.limit(rows + 1).toArrow()
    if found.num_rows > rows:
        return values, False
    return F.broadcast(values.sparkSession.createDataFrame(found, schema=values.schema)), True


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    scatter_by: Sequence[str] | None = None,
) -> DataFrame:
    """``left``, ``left_semi`` or ``left_anti`` join on equally named keys.

    ``scatter_by`` names the left columns that tell NULL-keyed rows apart
    (all of them by default); naming few lets the others be pruned.
    """
    scattered = F.xxhash64(*(scatter_by or left.columns))
    # Always zero, but no constant: that would be folded out of the join keys.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1).cast("long"))
    spread = left.withColumn("_spread", F.when(_complete(keys), zero).otherwise(scattered))
    anchored = right.withColumn("_spread", zero)
    return spread.join(anchored, [*keys, "_spread"], how).select(
        *left.columns, *([] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys])
    )


def left_lookup(
    df: DataFrame, other: DataFrame, keys: Sequence[str], scatter_by: Sequence[str] | None = None
) -> DataFrame:
    """All rows of ``df``, with the other side's columns where the keys match."""
    return spread_join(df, other, keys, "left", scatter_by)


def unmatched(
    df: DataFrame, other: DataFrame, keys: Sequence[str], scatter_by: Sequence[str] | None = None
) -> DataFrame:
    """Rows without a partner; a NULL key part never matches, so such rows stay.

    Copies of a key on the other side are merged map-side before the join.
    """
    return spread_join(df, other.select(*keys).distinct(), keys, "left_anti", scatter_by)


def matched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a partner, never multiplied; NULL keys go before the shuffle."""
    return spread_join(df, other.select(*keys).distinct(), keys, "left_semi")


def known_or_default(
    df: DataFrame,
    key: str,
    members: DataFrame,
    member: str,
    default: int,
    keep_null: bool = False,
    scatter_by: Sequence[str] | None = None,
    fetched: bool = False,
) -> DataFrame:
    """Replace ``key`` by ``default`` where it is no member.

    ``keep_null`` leaves a NULL key NULL; otherwise it counts as unknown. The
    member list is made distinct, which keeps rows from multiplying and lets
    Catalyst drop the whole join when the key is not read later. ``fetched``
    members (see ``distinct_members``) are distinct and small: no shuffle.
    """
    known = members.select(F.col(member).alias(key), F.lit(True).alias("_known"))
    if fetched:
        marked = df.join(known, key, "left")
    else:
        marked = left_lookup(df, known.dropDuplicates([key]), [key], scatter_by)
    fixed = F.when(F.col("_known"), F.col(key))
    if keep_null:
        fixed = fixed.when(F.col(key).isNull(), F.lit(None))
    return marked.withColumn(key, fixed.otherwise(default)).select(*df.columns)


def described(df: DataFrame, key: str, dimension: DataFrame, member: str, unknown: Mapping[str, object]) -> DataFrame:
    """Add the dimension's columns; a key that is no member gets the ``unknown`` ones.

    For few rows, such as totals per key: the same as ``known_or_default``
    followed by an inner join, in one join.
    """
    joined = df.join(dimension, F.col(key) == F.col(member), "left")
    filled = {c: F.when(F.col(member).isNull(), F.lit(v)).otherwise(F.col(c)) for c, v in unknown.items()}
    return joined.select(*df.columns, *(filled.get(c, F.col(c)).alias(c) for c in dimension.columns))


def role(dimension: DataFrame, prefix: str) -> DataFrame:
    """The dimension under a role: every column gets the prefix."""
    return dimension.select(*(F.col(c).alias(f"{prefix}_{c}") for c in dimension.columns))


def with_unknown_member(dimension: DataFrame, **values: object) -> DataFrame:
    """The dimension plus one constant row that stands for "not registered"."""
    types = dict(dimension.dtypes)
    constant = dimension.sparkSession.range(1).select(
        *(F.lit(values.get(c)).cast(types[c]).alias(c) for c in dimension.columns)
    )
    return dimension.unionByName(constant)
