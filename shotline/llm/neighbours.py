"""Near-duplicate vectors by NN-descent."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, discard, settle
from .graph import components

log = logging.getLogger(__name__)
#: Neighbours a list starts with; random partitions that seed the lists at least, and at once; rows of a cell; members that one local join takes; rows of an exact block.
K, TABLES, CELL, JOIN, BLOCK = 8, 6, 256, 64, 512
#: Odds at which a pair of the threshold's cosine shares a seed cell, at least; rows of a block where all rows are compared.
ODDS, WIDE_BLOCK = 0.98, 2048
#: Most rounds of descent; gain of the mean similarity of list places below which a round is the last; vectors with links that the
#: audit compares with all rows; recall below which lists are doubled; doublings, after which all rows are compared.
ROUNDS, GAIN, AUDIT, RECALL, DOUBLINGS, SEED = 5, 0.0002, 128, 0.99, 2, 13
#: Share of the vectors above which a component is large; vectors that the audit compares at once; vectors it draws at most.
LARGE, PASS, MOST = 0.01, 4096, 65_536
#: What float32 may be off.
SLACK = 1e-4


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal values in the first ``keys`` columns, of sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        edge = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for e in [*edge, batch.num_rows]:
            part = batch.slice(at, e - at)
            if e == batch.num_rows:
                held.append(part)
            else:
                yield pa.Table.from_batches([*held, part])
                held = []
            at = e
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column, kind=np.float32) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as unit vectors in double precision."""
    for batch in batches:
        ids, out = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not v or i is None or any(x is None for x in v):
                continue
            x = np.array(v, np.float64)
            top = np.abs(x).max()
            if not np.isfinite(x).all() or top == 0:
                continue
            x = x / top
            ids.append(i)
            out.append((x / np.linalg.norm(x)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "v"])


def _cells(bits: int, first: int, tables: int):
    """For each of ``tables`` tables from ``first``, the cell of a vector: its sides of ``bits`` random hyperplanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            raw = batch.column(1).to_pylist()
            dims = np.array([len(x) // 8 for x in raw])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), dim).astype(np.float32)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([SEED, dim, first]).standard_normal((tables, bits, dim)).astype(np.float32)
                small = [r.tobytes() for r in x]
                ids = batch.column(0).take(pa.array(at))
                for t in range(tables):
                    key = ((x @ planes[dim][t].T) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), first + t), pa.int32()), pa.array(np.full(len(x), dim), pa.int32()), pa.array(key, pa.int64()), ids, pa.array(small, pa.binary())], ["t", "dim", "key", "id", "v"])

    return run


def _local_join(keys: int, k: int):
    """For each member of a group, the others that are nearer than its list's last, ``k`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, sims, size = [], [], [], 0
        for group in _grouped(batches, keys):
            n = group.num_rows
            if n < 2:
                continue
            ids, x, last = group.column("id").to_numpy(), _matrix(group.column("v")), group.column("last").to_numpy()
            s = x @ x.T
            s[ids[:, None] == ids[None, :]] = -2
            top = np.argpartition(-s, min(k, n - 1) - 1, axis=1)[:, : min(k, n - 1)]
            got = np.take_along_axis(s, top, axis=1)
            rows, cols = np.nonzero(got > last[:, None])
            left.append(ids[rows])
            right.append(ids[top[rows, cols]])
            sims.append(got[rows, cols])
            size += len(rows)
            if size > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right)), pa.array(np.concatenate(sims).astype(np.float32))], ["id", "nbr", "sim"])
                left, right, sims, size = [], [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right)), pa.array(np.concatenate(sims).astype(np.float32))], ["id", "nbr", "sim"])

    return run


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each id; each task keeps k rows of an id before they are shuffled."""
    one = pairs.groupBy("id", "nbr").agg(F.max("sim").alias("sim"))
    return one.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "nbr"))).where(f"r <= {k}").select("id", "nbr", "sim")


def _split(rows: DataFrame, keys: list[str], most: int, salt: Column) -> DataFrame:
    """Groups of more than ``most`` rows are dealt to several parts by a hash that differs with ``salt``."""
    size = rows.groupBy(*keys).agg(F.ceil(F.count("*") / most).alias("parts"))
    return rows.join(size, keys).withColumn("part", F.pmod(F.xxhash64(salt, "id"), F.col("parts")).cast("int")).drop("parts")


_PAIRS = "id bigint, nbr bigint, sim float"


def _bits(count: int) -> int:
    return max(0, math.ceil(math.log2(max(count, 1) / CELL)))


def _tables(count: int, threshold: float) -> int:
    """Tables in which a pair of cosine ``threshold`` shares a cell at least once with odds of ODDS: the more vectors, the more."""
    one = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** _bits(count)
    return TABLES if one >= 1 else max(TABLES, math.ceil(math.log(1 - ODDS) / math.log1p(-max(one, 1e-9))))


def _seeded(vectors: DataFrame, count: int, k: int, tables: range, lists: DataFrame | None = None) -> DataFrame:
    """``lists`` with the nearest of the cells of ``tables``, TABLES of them at once."""
    for first in tables[::TABLES]:
        cells = settle(vectors.transform(arrow_map, _cells(_bits(count), first, min(TABLES, tables.stop - first)), "t int, dim int, key bigint, id bigint, v binary"))
        rows = _split(cells, ["t", "dim", "key"], 2 * CELL, F.col("t")).select("t", "dim", "key", "part", "id", "v", F.lit(-2.0).cast("float").alias("last"))
        rows = rows.repartition("t", "dim", "key", "part").sortWithinPartitions("t", "dim", "key", "part")
        found = rows.transform(arrow_map, _local_join(4, k), _PAIRS)
        new = settle(_best(found if lists is None else lists.union(found), k))
        discard(cells, *([] if lists is None else [lists]))
        lists = new
    return lists


def _descend(lists: DataFrame, vectors: DataFrame, k: int, number: int) -> DataFrame:
    """One round: every vector introduces its neighbours, and those it is a neighbour of, to each other."""
    last = lists.groupBy("id").agg(F.min("sim").alias("low"), F.count("*").alias("n")).select("id", F.when(F.col("n") >= k, F.col("low")).otherwise(F.lit(-2.0)).cast("float").alias("last"))
    small = vectors.join(last, "id", "left").select("id", "v", "dim", F.coalesce("last", F.lit(-2.0)).cast("float").alias("last"))
    met = lists.select(F.col("id").alias("mid"), F.col("nbr").alias("id")).union(lists.select(F.col("nbr").alias("mid"), "id")).distinct()
    rows = _split(met, ["mid"], JOIN, F.lit(number)).join(small, "id").select("mid", "part", "dim", "id", "v", "last")
    rows = rows.repartition("mid", "part").sortWithinPartitions("mid", "part", "dim")
    return _best(lists.union(rows.transform(arrow_map, _local_join(3, k), _PAIRS)), k)


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.frombuffer(x, np.float64).astype(np.float32) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in raw], pa.binary()), pa.array([len(x) for x in raw], pa.int32())], ["id", "v", "dim"])


def _counts(threshold: float):
    """Within each pair of blocks, how many vectors each vector links with, in double precision; weights are copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 4):
            ids, side, weight, x = group.column("id").to_numpy(), group.column("side").to_numpy(), group.column("w").to_numpy(), _matrix(group.column("v"), np.float64)
            a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
            one, two = (np.flatnonzero(side == a), np.flatnonzero(side == b)) if a != b else (np.arange(len(ids)),) * 2
            if not len(one) or not len(two):
                continue
            hit = (x[one] @ x[two].T) >= threshold
            if a == b:
                np.fill_diagonal(hit, False)
                got = [(ids, hit @ weight)]
            else:
                got = [(ids[one], hit @ weight[two]), (ids[two], hit.T @ weight[one])]
            for who, n in got:
                yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(n, pa.int64())], ["id", "n"])

    return run


def _exact_counts(vectors: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links of every vector inside its component, by comparing blocks of BLOCK vectors: a saturated list is enlarged to
    all that its component holds.  A vector goes to as many tasks as its component has blocks, and only counts come out."""
    size = classes.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = classes.join(size, "component").withColumn("side", F.pmod(F.xxhash64(F.lit(99), "node"), F.col("blocks")).cast("int"))
    rows = rows.join(vectors, F.col("node") == F.col("id")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("component", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "dim", "side", "id", "w", "v")
    rows = rows.repartition("component", "a", "b", "dim").sortWithinPartitions("component", "a", "b", "dim")
    return rows.transform(arrow_map, _counts(threshold), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def _forests(threshold: float):
    """Within each pair of blocks, edges that join what the links join: one at most for each vector, not one for each link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 3):
            ids, side, x = group.column("id").to_numpy(), group.column("side").to_numpy(), _matrix(group.column("v"), np.float64)
            one, two = np.flatnonzero(side == group.column("a")[0].as_py()), np.flatnonzero(side == group.column("b")[0].as_py())
            if not len(one) or not len(two):
                continue
            hit = (x[one] @ x[two].T) >= threshold
            fresh, left, right = hit.any(axis=1), [], []
            for root in range(len(one)):
                if not fresh[root]:
                    continue
                rows, reached = np.array([root]), np.zeros(len(two), bool)
                fresh[root] = False
                while len(rows):
                    cols = np.flatnonzero(hit[rows].any(axis=0) & ~reached)
                    reached[cols] = True
                    rows = np.flatnonzero(hit[:, cols].any(axis=1) & fresh)
                    fresh[rows] = False
                    right.append(ids[one[rows]])
                right.append(ids[two[reached]])
                left.append(np.full(sum(map(len, right)) - sum(map(len, left)), ids[one[root]]))
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                yield pa.RecordBatch.from_arrays([pa.array(a[a != b], pa.int64()), pa.array(b[a != b], pa.int64())], ["a", "b"])

    return run


def _all_edges(wide: DataFrame, count: int, threshold: float) -> DataFrame:
    """Edges with the components of all links, by comparing every vector with every other in blocks of WIDE_BLOCK."""
    blocks = max(1, math.ceil(count / WIDE_BLOCK))
    rows = wide.select("id", "v", "dim", F.pmod(F.xxhash64(F.lit(77), "id"), F.lit(blocks)).cast("int").alias("side")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.select(F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "dim", "side", "id", "v")
    rows = rows.repartition("a", "b", "dim").sortWithinPartitions("a", "b", "dim")
    return rows.transform(arrow_map, _forests(threshold), "a bigint, b bigint")


def _against_all(queries: list[tuple[int, bytes, int]], threshold: float):
    """For each of ``queries(id, v, component)``, its links with the rows, and how many of them are in its component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim: dict[int, list] = {}
        for i, raw, c in queries:
            by_dim.setdefault(len(raw), []).append((i, np.frombuffer(raw, np.float64), c))
        own = {dim: (np.array([q[0] for q in x]), np.array([q[1] for q in x]), np.array([q[2] for q in x])) for dim, x in by_dim.items()}
        found = {dim: np.zeros((2, len(x)), np.int64) for dim, x in by_dim.items()}
        for batch in batches:
            ids, raw, component = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            sizes = np.array([len(x) for x in raw])
            for dim, (who, x, of) in own.items():
                every = np.flatnonzero(sizes == dim)
                for at in np.split(every, range(BLOCK, len(every), BLOCK)):
                    if len(at):
                        hit = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1) @ x.T >= threshold
                        hit &= ids[at][:, None] != who
                        found[dim] += hit.sum(axis=0), (hit & (component[at][:, None] == of)).sum(axis=0)
        for dim, (who, _, _) in own.items():
            yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(found[dim][0]), pa.array(found[dim][1])], ["q", "n", "inside"])

    return run


def _shares(part: DataFrame, placed: DataFrame, threshold: float) -> list[float] | None:
    """Of AUDIT vectors of ``part`` that have links, or of all there are, the share of the links that lie inside components.

    Vectors are drawn by hash until so many had links; None if MOST were too few.
    """
    shares, drawn, rest = [], 0, part
    while len(shares) < AUDIT:
        if drawn >= MOST:
            return None
        queries = rest.orderBy("h", "id").limit(min(max(AUDIT, drawn), PASS)).collect()
        if not queries:
            break
        drawn += len(queries)
        own = [(r["id"], bytes(r["v"]), r["component"]) for r in queries]
        links = placed.select("id", "v", "component").transform(arrow_map, _against_all(own, threshold), "q bigint, n bigint, inside bigint")
        shares += [r["inside"] / r["n"] for r in links.groupBy("q").agg(F.sum("n").alias("n"), F.sum("inside").alias("inside")).where("n > 0").collect()]
        h, i = queries[-1]["h"], queries[-1]["id"]
        rest = part.where((F.col("h") > h) | ((F.col("h") == h) & (F.col("id") > i)))
    return shares


def _recall(vectors: DataFrame, classes: DataFrame, threshold: float) -> float | None:
    """Mean share of a vector's true links that lie inside components: the lower of that of vectors inside large components
    and that of the others, so that what a large group has found does not cover what small ones have lost.  None if too few
    of the others that were drawn had links."""
    placed = vectors.select("id", "v").join(classes.withColumnRenamed("node", "id"), "id", "left")
    placed = settle(placed.select("id", "v", F.coalesce("component", "id").alias("component"), F.xxhash64(F.lit(SEED), "id").alias("h")))
    most = max(1, int(LARGE * placed.count()))
    large = [r[0] for r in placed.groupBy("component").count().where(F.col("count") > most).select("component").collect()]
    inside = F.col("component").isin(large) if large else F.lit(False)
    both = [_shares(placed.where(x), placed, threshold) for x in (inside, ~inside)]
    discard(placed)
    return None if None in both else min(float(np.mean(x)) if x else 1.0 for x in both)


def near_duplicates(table: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept, audited_recall`` for each row of ``table(vec_id, embedding)``.

    Two vectors are linked if their cosine, in double precision, is ``threshold`` or more.

    1. Equal vectors are one vector with a weight.
    2. Lists of K neighbours are seeded in cells of random hyperplanes, then refined: in each
       round every vector's neighbours and reverse neighbours are joined with each other.
       A vector with many reverse neighbours is dealt to several joins, anew in each round.
    3. Edges of the threshold make components.  Where lists are saturated (all of a list's
       places are links) they are enlarged to the whole component, compared in blocks.
    4. An audit compares some vectors with all rows; while it finds too few of their
       links, lists are doubled, seeded in as many new cells, and descend again.  Where that
       does not help after DOUBLINGS, or links are too rare for the audit, all vectors are
       compared with all, in blocks.

    Vectors that are null, empty or zero, or have null or non-finite components, link with
    nothing; neither do vectors of different lengths.  A null vec_id has no component
    and is kept.  Rows of one vec_id are one vector of the first row's kind.  Equally near
    neighbours are listed by id.  An empty table gives an empty one; other columns, whatever
    their names, are not read.  ``audited_recall`` is what the last audit found, the same in
    all rows: RECALL or more, and 1 where all vectors were compared.
    """
    src = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    unit = settle(src.transform(arrow_map, _unit, "id bigint, v binary"))
    copies = unit.groupBy("v").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("w"))
    wide = settle(copies.select(F.col("rep").alias("id"), "v", "w", (F.octet_length("v") / 8).cast("int").alias("dim")).dropDuplicates(["id"]))
    vectors = settle(wide.select("id", "v").transform(arrow_map, _narrow, "id bigint, v binary, dim int"))
    count = wide.count()
    tables = _tables(count, threshold)
    k, lists = K, _seeded(wide.select("id", "v"), count, K, range(tables))
    for doubling in range(DOUBLINGS + 1):
        before = None
        for number in range(ROUNDS):
            new = settle(_descend(lists, vectors, k, doubling * ROUNDS + number + 1))
            state = new.agg(F.sum("sim"), F.count("*")).first()
            discard(lists)
            lists, gain = new, math.inf if before is None else (state[0] or 0) - (before[0] or 0)
            before = state
            if gain <= GAIN * max(state[1], 1):
                break
        near = lists.where(F.col("sim") >= threshold - SLACK).select(F.col("id").alias("a"), F.col("nbr").alias("b"))
        edges = settle(_confirmed(near, wide, threshold))
        classes = settle(components(edges))
        recall = _recall(wide, classes, threshold)
        log.info("lists of %d: recall %s of the audited vectors", k, recall)
        if recall is not None and recall >= RECALL:
            break
        discard(edges, classes)
        if recall is None or doubling == DOUBLINGS:
            log.warning("recall %s with lists of %d: all %d vectors are compared", recall, k, count)
            edges = settle(_all_edges(wide, count, threshold))
            classes = settle(components(edges))
            recall = 1.0  # nothing can be lost
            break
        k *= 2
        lists = _seeded(wide.select("id", "v"), count, k, range((doubling + 1) * tables, (doubling + 2) * tables), lists)
    links = _exact_counts(wide, classes, threshold)
    found = wide.select("id", "v", "w").join(links, "id", "left").join(classes.withColumnRenamed("node", "id"), "id", "left")
    found = found.select("v", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    of_row = unit.dropDuplicates(["id"]).join(found, "v").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    out = src.select("vec_id").join(of_row, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    out = out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    out = settle(out.withColumn("audited_recall", F.lit(float(recall))))
    discard(unit, wide, vectors, lists, edges, classes)
    return out


def _dots(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [float(np.dot(np.frombuffer(x, np.float64), np.frombuffer(y, np.float64))) >= threshold for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, wide: DataFrame, threshold: float) -> DataFrame:
    """Edges whose cosine in double precision reaches the threshold."""
    one = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = one.join(wide.select(F.col("id").alias("a"), F.col("v").alias("x")), "a").join(wide.select(F.col("id").alias("b"), F.col("v").alias("y")), "b")
    return both.select("a", "b", "x", "y").transform(arrow_map, _dots(threshold), "a bigint, b bigint")


def op6_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
