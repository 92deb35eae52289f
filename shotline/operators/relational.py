"""Filters, joins, merges and set operations with the engine's rules for nulls, empties and order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import IncompleteError, InputError, MissingRowsError

#: Ids that a filter takes as literals; more are joined.
LITERALS = 1_000
#: Ids that a request may name.
MOST_IDS = 65_536


def in_videos(df: DataFrame, videos: Sequence[str] | None, column: str = "video_id") -> DataFrame:
    """No list and an empty list are no filter."""
    return _member(df, videos, column) if videos else df


def in_frames(df: DataFrame, frames: Sequence | None, column: str = "keyframe_id") -> DataFrame:
    """No list is no filter; an empty list leaves no rows."""
    if frames is None:
        return df
    if len(frames) > MOST_IDS:
        raise InputError(f"{len(frames)} ids; {MOST_IDS} at most")
    return _member(df, frames, column) if frames else df.where(F.lit(False))


def _member(df: DataFrame, values: Sequence, column: str) -> DataFrame:
    if len(values) <= LITERALS:
        return df.where(F.col(column).isin(list(values)))
    ids = df.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` {df.schema[column].dataType.simpleString()}")
    # The list came with the request: MOST_IDS bounds it where frames are named.
    return df.join(F.broadcast(ids) if len(values) <= MOST_IDS else ids, column, "left_semi")


def top_k(df: DataFrame, k: int, score: str, tie: str, least: float | None = None) -> DataFrame:
    """The best ``k``; ``least`` applies before the cut."""
    return (df if least is None else df.where(F.col(score) >= least)).orderBy(F.desc(score), F.asc(tie)).limit(k)


def top_k_per(df: DataFrame, key: str, k: int, score: str, tie: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), F.asc(tie)))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def hydrate(ids: Sequence, table: DataFrame, key: str) -> DataFrame:
    """Rows of the ids in their order, repeated ids repeated, unknown ones passed over; ``pos`` is the place."""
    kind = table.schema[key].dataType.simpleString()
    wanted = table.sparkSession.createDataFrame([(i, v) for i, v in enumerate(ids)], f"pos int, `{key}` {kind}")
    return in_frames(table, list(dict.fromkeys(ids)), key).join(wanted, key).orderBy("pos")


def must_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join; a left row without a partner is an error that names the first five."""
    missing = [r[0] for r in left.join(right.select(key), key, "left_anti").select(key).distinct().orderBy(key).limit(5).collect()]
    if missing:
        raise MissingRowsError(f"no partner for {missing}")
    return left.join(right, key)


def must_meet(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join; a right side that matches nothing is an error."""
    if not right.isEmpty() and left.join(right.select(key), key, "left_semi").isEmpty():
        raise MissingRowsError("the index matches no row")
    return left.join(right, key, "left")


def one_per_key(rows: DataFrame, key: str, order: str | None = None, first: bool = False) -> DataFrame:
    """The last row of each key by ``order``, or the first; without one, and among equals, by what the rows hold."""
    by = F.struct(*([order] if order else []), F.to_json(F.struct(*rows.columns)))
    return rows.groupBy(F.col(key).alias("_key")).agg((F.min_by if first else F.max_by)(F.struct(*rows.columns), by).alias("_row")).select("_row.*")


def enrich(base: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], order: str | None = None) -> DataFrame:
    """Non-null updates overwrite; an empty text or map is a value and does too.  Of a key's updates the last counts."""
    new = one_per_key(updates.select(key, *columns, *([order] if order and order not in columns else [])), key, order)
    new = new.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    both = base.join(new, key, "left")
    return both.select(*((F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c)) for c in base.columns))


def insert_if_absent(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of new keys added; of a key's new rows the first counts."""
    return old.unionByName(one_per_key(new, key, order, first=True).join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Whole rows replaced by key, others added; of a key's new rows the last counts."""
    return old.join(new.select(key), key, "left_anti").unionByName(one_per_key(new, key, order), allowMissingColumns=True)


def refresh(old: DataFrame, new: DataFrame, partition: str) -> DataFrame:
    """Delete, then insert, all rows of the partitions that ``new`` has."""
    return old.join(new.select(partition).distinct(), partition, "left_anti").unionByName(new)


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def resume(order: DataFrame, done: DataFrame, fresh: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Results in the order of ``order``: those done before, else fresh ones."""
    side = lambda df, name: df.select(key, *(F.col(c).alias(f"_{name}_{c}") for c in columns))
    both = order.join(side(done, "done"), key, "left").join(side(fresh, "fresh"), key, "left")
    return both.select(*order.columns, *(F.coalesce(f"_done_{c}", f"_fresh_{c}").alias(c) for c in columns))


def same_sequence(a: DataFrame, b: DataFrame, pos: str, key: str) -> bool:
    """Whether both have the same keys in the same places."""
    left, right = a.select(pos, F.col(key).alias("_a")), b.select(pos, F.col(key).alias("_b"))
    return left.join(right, pos, "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).isEmpty()


def positional_zip(ids: Column, values: Column) -> Column:
    """``array<struct(id, value)>`` by place; arrays of different length are an error."""
    zipped = F.arrays_zip(ids.alias("id"), values.alias("value"))
    return F.when(F.size(ids) == F.size(values), zipped).otherwise(F.raise_error(F.lit("ids and values differ in number")))


def complete_or_raise(done: DataFrame, wanted: DataFrame, key: str, force: bool = False) -> DataFrame:
    """``done`` once every wanted key is in it; else an error, unless forced."""
    n = pending(wanted, done, key).select(key).distinct().count()
    if n and not force:
        raise IncompleteError(f"{n} keys are not done")
    return done


def skip_counters(rows: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """How many rows each reason holds for, a row counting for its first reason only."""
    first = F.coalesce(*(F.when(c, F.lit(n)) for n, c in reasons.items()), F.lit("processed"))
    return rows.select(first.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def histogram(rows: DataFrame, value: str, id: str, name: str) -> DataFrame:
    """``value, n, name``: rows and distinct ids of each value."""
    return rows.groupBy(value).agg(F.count("*").alias("n"), F.count_distinct(id).alias(name))


def nested_counts(parents: DataFrame, children: DataFrame, group: str, key: str, parent_count: str, child_count: str) -> DataFrame:
    """Per group the parents that have children, and these; children are counted before they are joined."""
    n = children.groupBy(key).agg(F.count("*").alias("_n"))
    return parents.join(n, key).groupBy(group).agg(F.count("*").alias(parent_count), F.sum("_n").alias(child_count))


def set_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """``op, n`` of the four set operations."""
    sized = lambda df, op: df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
    return sized(a.union(b).distinct(), "union").union(sized(a.intersect(b), "intersect")).union(sized(a.subtract(b), "except")).union(sized(a.union(b), "union_all"))
