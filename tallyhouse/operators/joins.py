"""Widening a fact by its dimensions: left equi-joins that survive hot keys."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot with this share of the rows, or with less if that is several average
# shuffle partitions.
HOT_SHARE = 0.005
SKEW_FACTOR = 5
# The least share Spark's sketch of frequent items takes; keys are counted exactly below it
LEAST_SUPPORT = 0.0001


@dataclass(frozen=True)
class DimSpec:
    """One dimension to join.

    ``on`` is (fact column, dimension column); ``columns`` maps dimension columns
    to their names in the result.  ``dt`` keeps one snapshot of a partitioned
    dimension: it is filtered before the join, so the partition is pruned and
    facts without a match stay (J3).  ``check`` makes sure that no key is there twice.
    """

    df: DataFrame
    on: tuple[str, str]
    columns: Mapping[str, str]
    dt: str | None = None
    part_col: str = "dt"
    check: bool = False

    def snapshot(self) -> DataFrame:
        rows = self.df if self.dt is None else self.df.filter(F.col(self.part_col) == self.dt)
        return require_unique(rows, self.on[1]) if self.check else rows

    def right(self, key: str) -> DataFrame:
        columns = [F.col(c).alias(name) for c, name in self.columns.items()]
        return self.snapshot().select(F.col(self.on[1]).alias(key), *columns)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate of ``df`` lets Spark broadcast it by itself.

    Over Spark Connect the estimate is out of reach, so nothing counts as small.
    """
    if not hasattr(df, "_jdf"):
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 <= size <= limit


@dataclass(frozen=True)
class HotKeys:
    """Keys of a fact too frequent for one task, with the number of pieces for each."""

    pieces: Mapping[object, int]
    nulls: bool = False

    @classmethod
    def among(cls, counts: Mapping[object, int], total: int, partitions: int) -> HotKeys:
        """The frequent ones of counted keys, cut into pieces of about one average partition.

        Pieces are powers of two, so that few different numbers occur; all together
        they are not more than about twice the partitions and the hot keys.
        """
        least = hot_share(partitions) * total
        hot = {key: n for key, n in counts.items() if n >= least}
        pieces = {}
        for key, n in hot.items():
            wanted = max(2, math.ceil(n * partitions / total))
            pieces[key] = 1 << (wanted - 1).bit_length()
        nulls = pieces.pop(None, None) is not None
        return cls(pieces, nulls)

    def __bool__(self) -> bool:
        return bool(self.pieces) or self.nulls

    def pieces_of(self, key: Column) -> Column:
        """Pieces of a key, 1 for all that are not hot."""
        same = defaultdict(list)
        for value, n in self.pieces.items():
            same[n].append(value)
        arms = F
        for n, values in same.items():
            arms = arms.when(key.isin(values), F.lit(n))
        return F.lit(1) if arms is F else arms.otherwise(F.lit(1))


def hot_share(partitions: int) -> float:
    """The share of rows from which a key counts as hot: some average partitions' worth."""
    return min(HOT_SHARE, SKEW_FACTOR / partitions)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(fact: DataFrame, key: str, partitions: int | None = None) -> HotKeys:
    """The hot keys of a fact, from two passes over one column.

    A frequent-item sketch names up to ``1 / hot_share`` candidates, all hot keys among
    them; counting the candidates leaves the hot ones.  No more values than that come
    to the driver, whatever the size of the fact.  For shares the sketch does not take
    (over 50,000 partitions) the rows are counted by key, and the hot keys alone come back.
    """
    partitions = partitions or shuffle_partitions(fact)
    keys = fact.select(key)
    share = hot_share(partitions)
    if share < LEAST_SUPPORT:
        total = keys.count()
        hot = keys.groupBy(key).count().filter(F.col("count") >= share * total).collect()
        return HotKeys.among({row[key]: row["count"] for row in hot}, max(1, total), partitions)
    candidates = keys.filter(F.col(key).isNotNull()).freqItems([key], share).first()[0] or []
    # one group per candidate, one for the rows without a key, one for all others
    candidate = F.when(F.col(key).isin(candidates), F.col(key))
    groups = keys.groupBy(candidate.alias("key"), F.col(key).isNull().alias("none")).count().collect()
    counts = {g["key"]: g["count"] for g in groups if g["key"] is not None or g["none"]}
    return HotKeys.among(counts, max(1, sum(g["count"] for g in groups)), partitions)


def split_left_join(
    fact: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Iterable[str],
    hot: HotKeys,
    partitions: int | None = None,
) -> DataFrame:
    """Left join on ``key`` between two large sides, hot keys spread out.

    Rows of a hot key are dealt to its pieces by a hash of ``spread_by``, and its right
    row is copied to all of them.  Rows without a key have no match and are spread over
    all partitions.  All other rows keep slot 0.  The hot keys are literals and the slot
    depends on the row alone: both sides agree on them, and a task that runs again sends
    its rows to the same place.
    """
    pieces = hot.pieces_of(F.col(key))
    slots = F.when(F.col(key).isNull(), F.lit(partitions or shuffle_partitions(fact))).otherwise(pieces)
    left = fact.withColumn("__slot", F.pmod(F.xxhash64(*spread_by), slots).cast("int"))
    copies = right.withColumn("__slot", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return left.join(copies, [key, "__slot"], "left").drop("__slot")


def left_join(
    fact: DataFrame, right: DataFrame, key: str, spread_by: Iterable[str], keys_of: DataFrame | None = None
) -> DataFrame:
    """Left join on ``key``, split if the right side is too large to broadcast and keys are hot.

    A plain join in all other cases, so that tables bucketed by the key stay in place.
    ``keys_of`` holds the same keys as the fact at less cost, to look for hot ones.
    """
    if not fits_broadcast(right):
        hot = hot_keys(fact if keys_of is None else keys_of, key)
        if hot:
            return split_left_join(fact, right, key, spread_by, hot)
    return fact.join(right, key, "left")


def widen(fact: DataFrame, dims: Iterable[DimSpec], spread_by: Iterable[str]) -> DataFrame:
    """Left join the dimensions in order; every fact row is kept exactly once.

    A dimension must hold each key at most once; ``DimSpec.check`` verifies it.
    ``spread_by`` names fact columns that tell rows of a hot key apart.
    """
    spread_by = list(spread_by)

    def step(left: DataFrame, dim: DimSpec) -> DataFrame:
        key = dim.on[0]
        # the joins made so far do not change the keys the fact brought along
        keys_of = fact if key in fact.columns else None
        return left_join(left, dim.right(key), key, spread_by, keys_of)

    return reduce(step, dims, fact)


def through(dim: DimSpec, outer: DimSpec | None) -> list[DimSpec]:
    """A dimension and one reached through its key (orders and their customer), for ``widen``.

    Two lookups in a row while both can be broadcast.  Else the second dimension is
    joined to the first, at the first one's grain, so that the fact is moved once.
    """
    if outer is None:
        return [dim]
    if fits_broadcast(dim.right(dim.on[0])) and fits_broadcast(outer.right(outer.on[0])):
        return [dim, outer]
    link = {name: column for column, name in dim.columns.items()}[outer.on[0]]
    inner = replace(outer, on=(link, outer.on[1]))
    known = widen(dim.snapshot().select(dim.on[1], *dim.columns), [inner], [dim.on[1]])
    return [DimSpec(known, dim.on, {**dim.columns, **{name: name for name in outer.columns.values()}})]


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fail if a dimension holds a key twice, which would multiply the fact's rows."""
    repeated = df.groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"key {', '.join(keys)} is not unique")
    return df

