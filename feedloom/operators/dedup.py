"""First record per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import staged

#: So many hashes of places are sent to all tasks at most.
SENT = 2_000_000


def first_per_key(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Keep the record with the lowest ``seq`` of each key.

    Every map task already keeps one row per key (a group limit below the shuffle), so a key
    that holds a third of all rows sends one row per task and no more.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(seq))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_long_per_key(df: DataFrame, key: str, seq: str = "seq", sent: int = SENT) -> DataFrame:
    """The same for records with long texts, most of which stay where they are.

    Key and ``seq`` alone tell which keys occur again and where those are first. Hashes of both go to the
    records: the ones whose key occurs once pass as they are, and of the others only those in a first place
    are shuffled. A hash that is shared brings in some more, and changes nothing. With more than ``sent``
    such keys all records are shuffled. ``df`` is read several times, so let it be a written table.
    """
    known = df.withColumns({"_key": F.xxhash64(key), "_place": F.xxhash64(key, seq)})
    places = known.select(key, seq, "_key", "_place")
    again = staged(places.groupBy("_key").count().where("count > 1").select("_key"), "again")
    if again.count() > sent:
        return first_per_key(df, key, seq)
    again = F.broadcast(again)
    firsts = staged(first_per_key(places.join(again, "_key", "left_semi"), key, seq).select("_place").distinct(), "firsts")
    met = known.join(again, "_key", "left_semi").join(F.broadcast(firsts), "_place", "left_semi").select(*df.columns)
    once = known.join(again, "_key", "left_anti").select(*df.columns)
    return once.unionByName(first_per_key(met, key, seq))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The set of keys seen."""
    return df.select(key).distinct()


def first_unseen(df: DataFrame, history: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """First record per key among the keys that ``history`` does not have.

    Duplicates go first on both sides, so the join meets every key once.
    """
    return first_per_key(df, key, seq).join(distinct_keys(history, key), key, "left_anti")
