"""Exact k-nearest-neighbour join.

Space is cut into cells, a binary tree of axis-parallel splits at medians of a bounded draw of reference vectors. Each query is searched in its own
cell first; its k-th distance there is a radius that is sure to hold k neighbours, so it is sent only to the other cells that the cube of
that radius meets, and what they find is merged. Large cells are cut into blocks of queries; inside a task a cell is cut into small
cells in the same way. In few dimensions a query meets few cells, and the work grows with the rows. In many dimensions every query meets
every cell; then nothing is copied: packed blocks of both sides are written once and read by the tasks of all block pairs, which pass on the k best of a
query within its radius. Identical vectors are handled once: equal queries share one search, and of equal reference rows only the
k+1 smallest keys can ever be among the first k.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .ordered import match_keys

MAX_CELLS = 8192
DRAWN = 32  # reference vectors a cell that the splits are drawn from
DRAWN_VALUES = 2_000_000  # their components at most: what the driver holds
QUERY_BLOCK = 2048
REFERENCE_BLOCK = 16384
SLACK = 1e-5
DIGITS = 6
CELLS = 1_000_000  # entries of a distance matrix held at once
SENT_ROWS = 4096  # rows of vectors that a task passes on at once
LEAF = 256  # references of a small cell inside a task
MANY = 8  # cells a query meets on average from which on blocks are paired instead
PAIRED_BYTES = 32 << 20  # packed references that a task holds

_FOUND = "array<struct<distance:double,id:bigint>>"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


def _arrow_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def _best(row: np.ndarray, ids: np.ndarray, distance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best pairs of each query row, ties by id, sorted by row."""
    order = np.lexsort((ids, distance, row))
    row, ids, distance = row[order], ids[order], distance[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    place = np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row)))
    return row[place < k], ids[place < k], distance[place < k]


def _nearest_pairs(queries: np.ndarray, refs: np.ndarray, ids: np.ndarray, k: int, radius: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, reference id, distance) of the k best references per query, within its radius if one is given; ties by id."""
    known = ~np.isnan(refs).any(axis=1)
    refs, ids = refs[known], ids[known]
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(refs) or not len(queries):
        return out[0]
    width, own, size = refs.shape[1], (refs * refs).sum(1), (queries * queries).sum(1)
    room = 2 * 10.0**-DIGITS + 1e-6 * np.sqrt(size + own.max())
    limits = np.full(len(queries), np.inf) if radius is None else radius
    reach, blur = (limits + room) ** 2, (width + 8) * 2.0**-22 * (size + own.max())  # blur: beyond the rounding of a product of floats
    single = width > 16 and own.max() < 1e30 and bool((blur < 0.05 * reach).all()) and bool(np.isfinite(reach).all())
    kind = np.float32 if single else np.float64
    # q.r - r.r/2 in one product: a reference is within reach if that is at least (q.q - reach) / 2
    wide = np.concatenate([refs, -own[:, None] / 2], axis=1).astype(kind).T
    step = max(1, CELLS // len(refs))
    for start in range(0, len(queries), step):
        part, cut = queries[start : start + step], slice(start, start + step)
        limit = limits[cut]
        product = np.concatenate([part, np.ones((len(part), 1))], axis=1).astype(kind) @ wide
        near = product >= ((size[cut] - reach[cut] - single * blur[cut]) / 2).astype(kind)[:, None]
        if len(refs) > k and np.count_nonzero(near) > 4 * k * len(part):
            top = np.partition(product, len(refs) - k, axis=1)[:, len(refs) - k].astype(np.float64)
            kth = np.sqrt(np.maximum(size[cut] - 2 * top + single * blur[cut], 0.0))
            near = product >= ((size[cut] - (np.minimum(kth, limit) + room[cut]) ** 2 - single * blur[cut]) / 2).astype(kind)[:, None]
        row, at = np.nonzero(near)
        exact = np.empty(len(row))
        some = max(1, CELLS // width)
        for begin in range(0, len(row), some):
            cut = slice(begin, begin + some)
            exact[cut] = np.round(np.sqrt(((refs[at[cut]] - part[row[cut]]) ** 2).sum(1)), DIGITS)
        inside = exact <= limit[row]
        row, found, exact = _best(row[inside], ids[at[inside]], exact[inside], k)
        out.append((row + start, found, exact))
    return tuple(np.concatenate(x) for x in zip(*out))


class _Cells:
    """A binary tree of splits ``x[axis] <= at`` with about ``wanted`` leaves, which are the cells."""

    def __init__(self, drawn: np.ndarray, wanted: int):
        self.axis, self.at, self.children = [-1], [0.0], [(0, 0)]
        heap, leaves = [(-len(drawn), 0, np.arange(len(drawn)))], 1
        while heap and leaves < wanted:
            _, node, rows = heapq.heappop(heap)
            split = self._split(drawn[rows])
            if split is None:
                continue
            axis, at = split
            left = drawn[rows, axis] <= at
            self.axis[node], self.at[node], self.children[node] = axis, at, (len(self.axis), len(self.axis) + 1)
            for side in (rows[left], rows[~left]):
                heapq.heappush(heap, (-len(side), len(self.axis), side))
                self.axis.append(-1)
                self.at.append(0.0)
                self.children.append((0, 0))
            leaves += 1
        self.axis, self.at, self.children = np.array(self.axis), np.array(self.at), np.array(self.children)
        self.number = np.cumsum(self.axis < 0) - 1
        self.count = leaves

    @staticmethod
    def _split(rows: np.ndarray) -> tuple[int, float] | None:
        """The most central place between two values of the widest axis."""
        if len(rows) < 2:
            return None
        for axis in np.argsort(-rows.std(axis=0), kind="stable"):
            values = np.sort(rows[:, axis])
            steps = np.flatnonzero(values[1:] > values[:-1])
            if len(steps):
                k = steps[np.abs(steps - len(values) // 2 + 1).argmin()]
                middle = values[k] + (values[k + 1] - values[k]) / 2
                return int(axis), float(middle if values[k] <= middle < values[k + 1] else values[k])
        return None

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
        while len(rows):
            rows = rows[self.axis[node[rows]] >= 0]
            at = node[rows]
            node[rows] = self.children[at, (~(vectors[rows, self.axis[at]] <= self.at[at])).astype(np.int64)]
        return self.number[node]

    def reached(self, vectors: np.ndarray, radius: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, cell that the cube of its radius meets), for some rows at a time."""
        reach = radius * (1 + 1e-9) + SLACK
        step = max(1, CELLS // self.count)
        for start in range(0, len(vectors), step):
            part, wide = vectors[start : start + step], reach[start : start + step]
            row, node = np.arange(len(part)), np.zeros(len(part), np.int64)
            done = []
            while len(row):
                leaf = self.axis[node] < 0
                done.append((row[leaf], node[leaf]))
                row, node = row[~leaf], node[~leaf]
                x, at = part[row, self.axis[node]], self.at[node]
                left, right = x - wide[row] <= at, x + wide[row] > at
                row, node = np.concatenate([row[left], row[right]]), np.concatenate([self.children[node[left], 0], self.children[node[right], 1]])
            row, node = (np.concatenate(x) for x in zip(*done))
            yield row + start, self.number[node]


def _search(queries: np.ndarray, refs: np.ndarray, ids: np.ndarray, k: int, radius: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_nearest_pairs``, by small cells where there are many references and few dimensions."""
    if len(refs) <= 2 * LEAF or refs.shape[1] > 16:
        return _nearest_pairs(queries, refs, ids, k, radius)
    known = ~np.isnan(refs).any(axis=1)
    refs, ids = refs[known], ids[known]
    cells = _Cells(refs, len(refs) // LEAF)
    own = cells.assign(refs)
    order = np.argsort(own, kind="stable")
    refs, ids = refs[order], ids[order]
    ends = np.searchsorted(own[order], np.arange(cells.count + 1))

    def visit(row: np.ndarray, cell: np.ndarray, within: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        order = np.argsort(cell, kind="stable")
        row, out = row[order], []
        starts = np.searchsorted(cell[order], np.arange(cells.count + 1))
        for c in np.flatnonzero(np.diff(starts)):
            some, here = row[starts[c] : starts[c + 1]], slice(ends[c], ends[c + 1])
            at, found, distance = _nearest_pairs(queries[some], refs[here], ids[here], k, None if within is None else within[some])
            out.append((some[at], found, distance))
        return out

    found, home = [], np.full(len(queries), -1)
    if radius is None:
        home = cells.assign(queries)
        found = visit(np.arange(len(queries)), home, None)
        radius = _radius(*(np.concatenate([f[i] for f in found]) for i in (0, 2)), len(queries), k)
    for row, cell in cells.reached(queries, radius):
        other = cell != home[row]
        found += visit(row[other], cell[other], radius)
    return _best(*(np.concatenate([f[i] for f in found]) for i in range(3)), k) if found else _nearest_pairs(queries, refs[:0], ids[:0], k)


def _radius(row: np.ndarray, distance: np.ndarray, queries: int, k: int) -> np.ndarray:
    """Per query the k-th of its distances; without so many, all space."""
    out, n = np.full(queries, -np.inf), np.bincount(row, minlength=queries)
    np.maximum.at(out, row, distance)
    return np.where(n >= k, out, np.inf)


def _lists(row: np.ndarray, ids: np.ndarray, distance: np.ndarray, queries: int) -> pa.Array:
    """Pairs sorted by query row as one list of (distance, id) per query."""
    ends = np.searchsorted(row, np.arange(queries + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(distance, pa.float64()), pa.array(ids, pa.int64())], names=["distance", "id"]))


def _placed(df: DataFrame, groups: _Cells) -> DataFrame:
    """Rows (id, vector) with their cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = groups.assign(_arrow_matrix(batch.column("vector")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(cell, pa.int64())], names=["id", "vector", "cell"])

    return df.select("id", "vector").mapInArrow(run, f"id bigint, vector {df.schema['vector'].dataType.simpleString()}, cell bigint")


def _sent(df: DataFrame, groups: _Cells) -> DataFrame:
    """Queries (id, vector, cell, radius), once for each other cell that they reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, radius = batch.column("cell").to_numpy(), batch.column("radius").to_numpy()
            for row, cell in groups.reached(_arrow_matrix(batch.column("vector")), radius):
                row, cell = row[cell != home[row]], cell[cell != home[row]]
                for at in range(0, len(row), SENT_ROWS):
                    own = pa.array(row[at : at + SENT_ROWS])
                    columns = [pa.array(cell[at : at + SENT_ROWS], pa.int64()), *(batch.column(c).take(own) for c in ("id", "vector", "radius"))]
                    yield pa.RecordBatch.from_arrays(columns, names=["cell", "id", "vector", "radius"])

    kind = df.schema["vector"].dataType.simpleString()
    return df.select("id", "vector", "cell", "radius").mapInArrow(run, f"cell bigint, id bigint, vector {kind}, radius double")


def choose_pivots(refs: DataFrame, count: int) -> np.ndarray:
    """About a fixed number of distinct vectors by their hash; the only vectors the driver holds."""
    distinct = refs.filter("_copy = 1")
    n, parts = distinct.count(), 1 << 30
    picked = distinct.filter(F.pmod(F.xxhash64("vector"), F.lit(parts)) <= int(parts * min(1.0, count / max(n, 1)))).select("vector")
    return _arrow_matrix(picked.toArrow().column("vector"))


def _sides(queries: DataFrame, references: DataFrame, key: str, vector: str, wanted: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all queries, references with at most ``wanted`` copies of a vector, one query per vector). Vectors of floats stay floats."""
    narrow = all(df.schema[vector].dataType.simpleString() == "array<float>" for df in (queries, references))
    typed = F.col(vector).cast("array<float>" if narrow else "array<double>").alias("vector")
    copies = Window.partitionBy("vector").orderBy("id")
    refs = (
        references.select(F.col(key).alias("id"), typed)
        .withColumn("_copy", F.row_number().over(copies))
        .filter(F.col("_copy") <= wanted)
    )
    rows = queries.select(F.col(key).alias("id"), typed)
    return rows, staged(refs, "knn-references"), rows.groupBy("vector").agg(F.min("id").alias("id"))


def knn_join(
    queries: DataFrame,
    references: DataFrame,
    k: int,
    key: str = "id",
    vector: str = "vector",
    exclude_self: bool = False,
    pivots: int | None = None,
    query_block: int = QUERY_BLOCK,
    reference_block: int = REFERENCE_BLOCK,
) -> DataFrame:
    """(key, vector, neighbours): the k nearest references by Euclidean distance, ties by key.

    Distances are rounded to six decimals before they are compared. ``pivots`` is the number of cells.
    """
    wanted = k + 1 if exclude_self else k
    rows, refs, searched = _sides(queries, references, key, vector, wanted)
    seen = refs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not seen["n"]:
        return rows.select(F.col("id").alias(key), F.col("vector").cast("array<double>").alias("vector"), F.array().cast(_FOUND).alias("neighbours"))
    count = pivots or min(MAX_CELLS, math.ceil(seen["n"] / query_block))
    drawn = choose_pivots(refs, min(DRAWN * count, max(2, DRAWN_VALUES // seen["width"])))
    groups = _Cells(drawn[~np.isnan(drawn).any(axis=1)], count)

    placed_refs = staged(_placed(refs, groups), "knn-cells")
    placed = staged(_placed(searched, groups), "knn-queries")
    kind = placed.schema["vector"].dataType.simpleString()

    def in_blocks(asked: DataFrame, search, schema: str) -> DataFrame:
        """Blocks of a cell's queries beside its references."""
        # one row per cell
        plan = staged(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * query_block)).cast("int").alias("q")), "knn-plan")
        left = asked.join(F.broadcast(plan), "cell").withColumn("qb", F.pmod(F.xxhash64("id"), F.col("q")).cast("int")).drop("q")
        right = placed_refs.join(F.broadcast(plan), "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb"), "id", "vector")
        return left.groupBy("cell", "qb").cogroup(right.groupBy("cell", "qb")).applyInArrow(search, schema)

    def at_home(q: pa.Table, r: pa.Table) -> pa.Table:
        vectors = _arrow_matrix(q.column("vector"))
        refs = _arrow_matrix(r.column("vector")) if len(r) else np.zeros((0, vectors.shape[1]))
        row, found, distance = _search(vectors, refs, r.column("id").to_numpy(), wanted)
        radius, home = _radius(row, distance, len(q), wanted), q.column("cell").to_numpy()
        others = np.zeros(len(q), np.int64)
        for at, cell in groups.reached(vectors, radius):
            others += np.bincount(at[cell != home[at]], minlength=len(q))
        return pa.table(
            {"id": q.column("id"), "vector": q.column("vector"), "cell": q.column("cell"), "radius": pa.array(radius),
             "others": pa.array(others), "found": _lists(row, found, distance, len(q))}
        )

    own = staged(in_blocks(placed, at_home, f"id bigint, vector {kind}, cell bigint, radius double, others bigint, found {_FOUND}"), "knn-home")
    met = own.agg(F.count(F.lit(1)).alias("n"), F.sum("others").alias("others")).first()
    rest = own.filter("others > 0")
    if (met["others"] or 0) > MANY * met["n"]:
        more = _paired(rest, refs, wanted, seen["n"])
    else:

        def elsewhere(q: pa.Table, r: pa.Table) -> pa.Table:
            vectors = _arrow_matrix(q.column("vector"))
            refs = _arrow_matrix(r.column("vector")) if len(r) else np.zeros((0, vectors.shape[1]))
            row, found, distance = _search(vectors, refs, r.column("id").to_numpy(), wanted, q.column("radius").to_numpy())
            table = pa.table({"id": q.column("id"), "found": _lists(row, found, distance, len(q))})
            return table.filter(pa.array(np.bincount(row, minlength=len(q)) > 0))

        more = in_blocks(_sent(rest, groups), elsewhere, f"id bigint, found {_FOUND}")
        more = more.unionByName(rest.select("id", "found"))
    # vectors that share an id share its list
    merged = _merged(more.unionByName(own.filter("others = 0").select("id", "found")), wanted).withColumnRenamed("id", "_id")
    lists = placed.select("id", "vector").join(merged, F.col("id") == F.col("_id")).select("vector", "neighbours")
    return _attached(rows, lists, k, key, exclude_self)


def _merged(found: DataFrame, wanted: int) -> DataFrame:
    """(id, neighbours): the best of the lists of each query, in which no reference comes twice."""
    return found.groupBy("id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, wanted).alias("neighbours"))


def _paired(asked: DataFrame, refs: DataFrame, wanted: int, n_refs: int) -> DataFrame:
    """(id, found) for queries (id, vector, radius) against all references, without copies of either: both sides are written as packed blocks, and a task
    reads some blocks of each."""
    spark = refs.sparkSession
    kind = "f4" if refs.schema["vector"].dataType.simpleString() == "array<float>" else "f8"

    def pack(rows: int, columns: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    values = {c: _arrow_matrix(part.column(c)).astype(kind) if c == "vector" else part.column(c).to_numpy() for c in columns}
                    yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values.values()], names=[f"{prefix}_{c}" for c in columns])

        prefix = "q" if "radius" in columns else "r"
        return run, ", ".join(f"{prefix}_{c} binary" for c in columns)

    width = refs.agg(F.max(F.size("vector"))).first()[0]
    tasks = max(1, math.ceil(n_refs * width * int(kind[1]) / PAIRED_BYTES))
    left = staged(asked.select("id", "vector", "radius").repartition(max(tasks, spark.sparkContext.defaultParallelism), "id").mapInArrow(*pack(QUERY_BLOCK, ["id", "vector", "radius"])), "knn-query-blocks")
    right = staged(refs.select("id", "vector").repartition(tasks, "id").mapInArrow(*pack(QUERY_BLOCK, ["id", "vector"])), "knn-reference-blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, ids, vectors, radius, held = None, None, None, None, []

        def best() -> pa.RecordBatch:
            row, found, distance = (np.concatenate(x) for x in zip(*held))
            row, found, distance = _best(row, found, distance, wanted)
            some = pa.array(np.bincount(row, minlength=len(ids)) > 0)
            return pa.RecordBatch.from_arrays([pa.array(ids), _lists(row, found, distance, len(ids))], names=["id", "found"]).filter(some)

        for batch in batches:
            for at in range(batch.num_rows):
                block = batch.column("q_id")[at].as_py()
                if block != asked:
                    if held:
                        yield best()
                    asked, ids, held = block, np.frombuffer(block, "<i8"), []
                    vectors = np.frombuffer(batch.column("q_vector")[at].as_py(), kind).reshape(len(ids), -1).astype(np.float64)
                    radius = np.frombuffer(batch.column("q_radius")[at].as_py(), "<f8")
                r_ids = np.frombuffer(batch.column("r_id")[at].as_py(), "<i8")
                refs = np.frombuffer(batch.column("r_vector")[at].as_py(), kind).reshape(len(r_ids), -1).astype(np.float64)
                held.append(_nearest_pairs(vectors, refs, r_ids, wanted, radius))
                if sum(len(h[0]) for h in held) > 2 * wanted * len(ids):
                    held = [_best(*(np.concatenate(x) for x in zip(*held)), wanted)]
                    radius = np.minimum(radius, _radius(held[0][0], held[0][2], len(ids), wanted))
        if held:
            yield best()

    pairs = left.join(right.hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(search, f"id bigint, found {_FOUND}")


def _attached(rows: DataFrame, lists: DataFrame, k: int, key: str, exclude_self: bool) -> DataFrame:
    """The neighbours found for each searched vector, given to every query with that vector."""
    joined = match_keys(rows, lists.filter(F.size("neighbours") > 0), ["vector"])
    neighbours = F.col("neighbours")
    if exclude_self:
        neighbours = F.filter(neighbours, lambda n: n["id"] != F.col("id"))
    return joined.select(F.col("id").alias(key), F.col("vector").cast("array<double>").alias("vector"), F.slice(neighbours, 1, k).alias("neighbours"))


def _hashed(df: DataFrame, directions: list[np.ndarray], probes: int) -> DataFrame:
    """Each vector once per table and probe: its bucket is the direction it points along most, further probes the next ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            step = max(1, 2_000_000 // (len(directions) * len(directions[0])))
            for start in range(0, len(pdf), step):
                part = pdf.iloc[start : start + step]
                vectors = _matrix(part["vector"])
                for table, axes in enumerate(directions):
                    along = vectors @ axes.T
                    best = np.argpartition(-along, probes - 1, axis=1)[:, :probes] if probes < len(axes) else np.tile(np.arange(len(axes)), (len(part), 1))
                    row, bucket = np.repeat(np.arange(len(part)), best.shape[1]), table * len(axes) + best.ravel()
                    for at in range(0, len(row), SENT_ROWS):
                        own = row[at : at + SENT_ROWS]
                        yield pd.DataFrame({"bucket": bucket[at : at + SENT_ROWS], "id": part["id"].to_numpy()[own], "vector": part["vector"].to_numpy()[own]})

    return df.select("id", "vector").mapInPandas(run, f"bucket bigint, id bigint, vector {df.schema['vector'].dataType.simpleString()}")


def approximate_knn_join(
    queries: DataFrame,
    references: DataFrame,
    k: int,
    key: str = "id",
    vector: str = "vector",
    exclude_self: bool = False,
    tables: int = 4,
    probes: int = 6,
    bucket_rows: int = 4096,
    least_buckets: int = 16,
    query_block: int = QUERY_BLOCK,
    reference_block: int = REFERENCE_BLOCK,
    seed: int = 5,
) -> DataFrame:
    """(key, vector, neighbours): nearly the k nearest references, from random-projection hash tables.

    A table draws random directions, about one per ``bucket_rows`` references, and files a vector under the direction it points along most. A reference is
    copied once per table, a query once per table and probe, whatever the number of rows; a query meets at most about tables * probes * bucket_rows references, in
    blocks, and each block pair passes on its k best per query, never its pairs. Distances are exact and rounded to six decimals; ``neighbour_recall``
    measures what is missed. The same call gives the same result: directions come from ``seed``, blocks from hashes of keys.
    """
    wanted = k + 1 if exclude_self else k
    rows, refs, searched = _sides(queries, references, key, vector, wanted)
    searched = staged(searched, "knn-queries")
    seen = refs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not seen["n"]:
        return rows.select(F.col("id").alias(key), F.col("vector").cast("array<double>").alias("vector"), F.array().cast(_FOUND).alias("neighbours"))
    buckets = max(least_buckets, math.ceil(seen["n"] / bucket_rows))
    draw = np.random.default_rng(seed)
    directions = [draw.normal(size=(buckets, seen["width"])) for _ in range(tables)]
    # filed twice, once to count and once to send, so that the copies are never written beside the shuffle
    filed, asked = _hashed(refs, directions, 1), _hashed(searched, directions, min(probes, buckets))
    # one row per bucket: tables * references / bucket_rows of them
    size = filed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / reference_block).cast("int").alias("r"))
    plan = size.join(asked.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / (8 * query_block)).cast("int").alias("q")), "bucket")
    plan = staged(plan, "knn-plan")

    def every(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = asked.join(plan, "bucket").select("bucket", F.pmod(F.xxhash64("id"), F.col("q")).cast("int").alias("qb"), every("r").alias("rb"), "id", "vector")
    right = filed.join(plan, "bucket").select("bucket", every("q").alias("qb"), F.pmod(F.xxhash64("id"), F.col("r")).cast("int").alias("rb"), "id", "vector")

    def search(q: pa.Table, r: pa.Table) -> pa.Table:
        ids = q.column("id").to_numpy()
        row, found, distance = _nearest_pairs(_arrow_matrix(q.column("vector")), _arrow_matrix(r.column("vector")), r.column("id").to_numpy(), wanted) if len(q) and len(r) else 3 * [np.zeros(0)]
        table = pa.table({"id": pa.array(ids, pa.int64()), "found": _lists(row, found, distance, len(ids))})
        return table.filter(pa.array(np.bincount(row.astype(np.int64), minlength=len(ids)) > 0))

    block = ["bucket", "qb", "rb"]
    pairs = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(search, f"id bigint, found {_FOUND}")
    # a reference comes once from each table that finds it, with one distance
    best = pairs.groupBy("id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, tables * wanted).alias("found"))
    lists = best.select(F.col("id").alias("_id"), F.slice(F.array_distinct("found"), 1, wanted).alias("neighbours"))
    return _attached(rows, searched.join(lists, F.col("id") == F.col("_id")).select("vector", "neighbours"), k, key, exclude_self)


def neighbour_recall(found: DataFrame, exact: DataFrame, key: str = "id") -> DataFrame:
    """One row: queries, recall (share of the exact neighbours that were found) and how many distances of found neighbours beat the exact list's own place."""
    both = exact.select(F.col(key).alias("_key"), F.col("neighbours").alias("_exact")).join(found, F.col("_key").eqNullSafe(F.col(key)))
    ids = lambda c: F.transform(c, lambda n: n["id"])
    hits = F.size(F.array_intersect(ids(F.col("_exact")), ids(F.col("neighbours"))))
    better = F.size(F.filter(F.arrays_zip(F.col("_exact").alias("e"), F.col("neighbours").alias("f")), lambda z: z["f"]["distance"] < z["e"]["distance"]))
    return both.agg(F.count(F.lit(1)).alias("queries"), (F.sum(hits) / F.sum(F.size("_exact"))).alias("recall"), F.sum(better).alias("better_than_exact"))


def neighbour_rows(joined: DataFrame, key: str = "id") -> DataFrame:
    """One row per neighbour: (key, place, neighbour, distance)."""
    return joined.select(key, F.posexplode("neighbours").alias("_i", "_n")).select(
        key, (F.col("_i") + 1).alias("place"), F.col("_n.id").alias("neighbour"), F.col("_n.distance").alias("distance")
    )
