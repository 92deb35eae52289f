"""Shards that all have the corpus's mixture of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, discard, settle

SHARDS, SEED = 24, 17
#: Rows that one sort handles, until there are a million such cells; equal rows that one task writes out.
CELL_ROWS, MOST_CELLS, COPIES = 1_000, 1_000_000, 10_000


def _cells(count: int) -> int:
    return max(1, -(-count // max(CELL_ROWS, -(-count // MOST_CELLS))))


def _cell(h: str, count: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 16), F.lit(_cells(count)))


def _ranked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows(keys, cell, ...)`` with ``before + place``: the rank within ``keys`` by cell and then ``order``, and ``of``, its count.

    Cells are counted, so no task sorts more than a cell.
    """
    by = lambda: Window.partitionBy(*keys).orderBy("cell")
    counts = rows.groupBy(*keys, "cell").agg(F.count("*").alias("n"))
    before = counts.select(*keys, "cell", (F.sum("n").over(by().rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy(*keys)).alias("of"))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys, "cell").orderBy(*order)))
    return placed.join(before, [*keys, "cell"]).withColumn("rank", F.col("before") + F.col("place")).drop("before", "place")


def _phases(rows: DataFrame, seed: int) -> DataFrame:
    """``stratum, of, u`` for each source: its rows, and where in [0, 1) its row pattern begins.

    Sources with equally many rows are spread evenly over the phases, from a random start
    for each such number: small sources then fill all shards alike, as large ones do by themselves.
    """
    sizes = settle(rows.groupBy("stratum").agg(F.count("*").alias("size")).withColumn("h", F.xxhash64(F.lit(seed), "stratum")))
    ranked = _ranked(sizes.withColumn("cell", _cell("h", sizes.count())), ["size"], ["h", "stratum"])
    start = F.pmod(F.xxhash64(F.lit(seed), "size"), F.lit(1 << 20)) / (1 << 20)
    u = (F.col("rank") - F.lit(0.5)) / F.col("of") + start
    return ranked.select("stratum", F.col("size").alias("of"), (u - F.floor(u)).alias("u"))


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Deal ``docs(doc_id, text, source)`` into ``shards`` by proportional stratified interleaving.

    Rows of each source are ranked in a seeded shuffle; row r of n stands at (r - 1 + u) / n,
    where u is the source's phase; all rows in that order are cut into pieces whose row
    counts differ by one at most (law ``rows``), so each piece has the mixture of the whole:
    of a source its share of rows but for rounding, and of all sources with equally few rows
    together their share, but for rounding.

    Ranks are exact without a sort of a whole source: rows fall into cells of about
    CELL_ROWS rows by hash (by fraction in the second pass), cells are counted, and a row's
    rank is the rows of earlier cells plus its place in its own.  Equal rows are counted
    before they are dealt, and written out COPIES at a time.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.  Null text counts
    as no bytes, a null source is a source, null ids are ids, texts may be of any length,
    equal rows get different slots, other columns are not read, and an empty table gives an
    empty one.
    """
    bytes_ = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("stratum"),
        (F.octet_length(bytes_) + 8).cast("bigint").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
    )
    part = F.explode(F.expr(f"sequence(0, (m - 1) div {COPIES})"))
    copy = F.explode(F.expr(f"sequence(part * {COPIES}, least(m, (part + 1) * {COPIES}) - 1)"))
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("m")).select(*rows.columns, "m", part.alias("part"))
    rows = counted.repartition("doc_id", "text_crc32", "part").select(*rows.columns, copy.alias("copy"))
    rows = settle(rows.select("doc_id", "stratum", "size", "text_crc32", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size", "copy").alias("h")))
    total = rows.count()
    cells = _cells(total)
    phases = settle(_phases(rows, seed))
    ranked = _ranked(rows.withColumn("cell", _cell("h", total)), ["stratum"], ["h", "doc_id", "text_crc32", "size"]).drop("of", "cell")
    at = (F.col("rank") - 1 + F.col("u")) / F.col("of")
    ranked = ranked.join(F.broadcast(phases) if phases.count() < BROADCAST_ROWS else phases, "stratum").withColumn("at", at)
    ranked = settle(ranked.select("doc_id", "size", "text_crc32", "stratum", "h", "at", F.floor(F.col("at") * cells).alias("cell")))
    along = ranked.groupBy("cell").agg(F.count("*").alias("n"))
    along = along.select("cell", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("at", "h", "stratum", "doc_id")) - 1
    placed = ranked.withColumn("place", place).join(along, "cell").withColumn("pos", F.col("before") + F.col("place"))
    shard = F.expr(f"pos * {shards} div {max(total, 1)}")
    placed = placed.withColumn("shard", shard.cast("int"))
    start = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    discard(rows, phases)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("pos") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write ``docs`` as one Parquet folder a shard, rows in slot order.  doc_id must be unique here."""
    placed = interleave(docs, shards, seed).select("doc_id", "shard", "slot")
    joined = docs.drop("shard", "slot").join(placed, "doc_id")
    joined.repartitionByRange(shards * 4, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    return interleave(spark.read.parquet(f"{sf_dir}/documents.parquet"))
