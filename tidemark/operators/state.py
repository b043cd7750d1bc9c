"""Current state of a table from its change rows.

The newest row of a key wins; only then are deleted keys dropped. Filtering
first would bring superseded versions back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Newest last: a change is ordered by version, then by its place in the topic.
POSITION = ("_version", "partition", "offset")


def _position() -> Column:
    return F.struct(*(F.col(c) for c in POSITION))


def latest_versions(changes: DataFrame, key: str = "id") -> DataFrame:
    """The newest row of each key, deletes included.

    The rank filter lets Spark cut every map task's output to one row per key
    before the shuffle, so a key with very many versions costs no more there
    than any other.
    """
    newest_first = Window.partitionBy(key).orderBy(*(F.col(c).desc() for c in POSITION))
    ranked = changes.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def live(state: DataFrame) -> DataFrame:
    """Drop deleted keys. ``state`` must hold one row per key."""
    return state.filter(F.col("_deleted") == 0)


def current_rows(changes: DataFrame, key: str = "id") -> DataFrame:
    return live(latest_versions(changes, key))


def overlay(
    state: DataFrame, newest: DataFrame, key: str = "id", shown: DataFrame | None = None
) -> DataFrame:
    """Put ``newest`` (one row per key) over ``state`` by joins alone.

    ``state`` is only streamed past the few changed keys; it is not shuffled
    when those are small enough to broadcast. ``shown`` is the part of the state
    whose unchanged rows are wanted: it is read in full width, the whole state
    just for its keys and positions.
    """
    offered = newest.select(key, _position().alias("_offered"))
    wanted = state if shown is None else shown
    not_newer = F.col("_offered").isNull() | (_position() > F.col("_offered"))
    untouched = wanted.join(offered, key, "left").filter(not_newer).drop("_offered")
    beaten = (
        offered.join(state.select(key, *POSITION), key)
        .filter(_position() > F.col("_offered"))
        .select(key)
    )
    return untouched.unionByName(newest.join(beaten, key, "left_anti"))


def offered_over(state: DataFrame, newest: DataFrame, key: str = "id") -> DataFrame:
    """The rows of ``newest`` that ``overlay`` would let in: new keys, and newer rows of old ones."""
    held = state.select(F.col(key).alias("_held_key"), _position().alias("_held"))
    better = F.col("_held").isNull() | (F.col("_held") <= _position())
    joined = newest.join(held, F.col(key) == F.col("_held_key"), "left")
    return joined.filter(better).drop("_held_key", "_held")


def merge_changes(
    state: DataFrame, changes: DataFrame, key: str = "id", shown: DataFrame | None = None
) -> DataFrame:
    """Fold change rows into a state; equals ``latest_versions`` of everything.

    With ``shown``, exactly the unchanged rows of that part of the state and the
    changed rows are returned. The rows do not depend on sizes: Spark broadcasts
    the changes if it finds them small, and shuffles both sides if not.
    """
    return overlay(state, latest_versions(changes, key), key, shown)


def expired_tombstone(before_version: int) -> Column:
    """Whether a key was deleted before a version no replay can go back to."""
    return (F.col("_deleted") == 1) & (F.col("_version") < before_version)


def expire_tombstones(state: DataFrame, before_version: int) -> DataFrame:
    return state.filter(~expired_tombstone(before_version))
