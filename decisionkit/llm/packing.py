"""Best-fit packing of tokenised documents by linear grouping.

The number of pieces of each length is all that the packing depends on, and there are at most ``capacity`` lengths. So the scheme runs
on that table, exactly, whatever the number of documents:

1. Lengths above ``large`` of the capacity are sorted and cut into groups of equal cardinality; each is rounded up to its group's
   largest.
2. Configurations of the few rounded sizes are optimised by column generation (each new one from a knapsack over the
   dual prices); the fractional rest is filled one sequence after the other.
3. Actual lengths take the places of rounded ones, largest first, so that each configuration falls into runs of equal sequences.
4. Small lengths, longest first, go where the least room is left, whole runs at a time; new sequences are opened only when none fits.

The outcome is a table of runs ("ranks a to b of length x go to sequences s, s + 1, ... at offset o"), whose size depends on the capacity only.
Each piece finds its run by its rank among the pieces of its length.

Nulls and odd rows: a null or empty text is one piece holding the end id only; a null id is carried along; repeated rows are packed
each for itself; an empty table gives an empty result; a text of any length is tokenised in slices; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import filled, small_batches, staged
from .wordids import word_ids

CAPACITY, GROUPS, LARGE = 2048, 256, 0.4
RANKED = 1 << 16
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _cut(tokenizer: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = word_ids(tokenizer), 4 * capacity
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []

            def add(i: int, at: int, part: bytes) -> None:
                row.append(i)
                piece.append(at // capacity)
                start.append(at)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if keep_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))

            for i, body in enumerate(batch.column("body")):
                at, held = 0, b""
                for part in encode.stream(body.as_py()):
                    held += part
                    while len(held) > width:
                        add(i, at, held[:width])
                        at, held = at + capacity, held[width:]
                held += np.array([end_id], "<u4").tobytes()
                for k in range(0, len(held), width):
                    add(i, at + k // 4, held[k : k + width])
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (piece, start, length, crc)]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []), names=COLUMNS + ["ids"] * keep_ids)

    return run


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise whole texts, append the end id, cut what is longer than the capacity."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.encode(filled(F.col(text_col)), "UTF-8").alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece long, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(_cut(tokenizer, capacity, end_id, keep_ids), schema)


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of greatest price (each size any number of times), built one piece after the other."""
    room = np.arange(capacity + 1)[None] - sizes[:, None]
    fits, room = room >= 0, room.clip(0)
    best, took = np.zeros(capacity + 1), []
    while True:
        gains = np.where(fits, best[room] + prices[:, None], -1.0)
        pick = gains.argmax(axis=0)
        more = gains[pick, np.arange(capacity + 1)]
        if not (more > best + 1e-12).any():
            break
        took.append(np.where(more > best + 1e-12, pick, -1))
        best = np.maximum(best, more)
    config, left = np.zeros(len(sizes), int), capacity
    for layer in reversed(took):
        if layer[left] >= 0:
            config[layer[left]] += 1
            left -= int(sizes[layer[left]])
    return config


def _configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often each is used; together they hold exactly ``demand``."""
    need = np.asarray(demand, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(40 * len(sizes)):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        new = _knapsack(np.asarray(sizes), prices, capacity)
        if prices @ new <= 1 + 1e-9:
            break
        use, step = np.linalg.solve(basis, need), np.linalg.solve(basis, new.astype(float))
        room = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(room.argmin())] = new
    use = np.floor(np.linalg.solve(basis, need) + 1e-6).clip(0).astype(np.int64)
    left = np.asarray(demand, np.int64)
    out = []
    for k in range(len(sizes)):
        column = basis[:, k].round().astype(np.int64)
        times = int(min([use[k], *(left[column > 0] // column[column > 0])]))
        if times:
            out.append((column, times))
            left -= times * column
    while left.any():  # the fractional rest: fewer sequences than there are sizes, times a constant
        room, one = capacity, np.zeros(len(sizes), np.int64)
        for k in range(len(sizes)):  # sizes fall
            one[k] = min(left[k], room // sizes[k])
            room -= int(one[k]) * sizes[k]
        times = int((left[one > 0] // one[one > 0]).min())
        out.append((one, times))
        left -= times * one
    return out


def linear_grouping(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> tuple[list[tuple[int, ...]], int]:
    """Runs (length, first rank, ranks, pieces per sequence, first sequence, offset), and the number of sequences."""
    runs, sequences = [], 0
    if counts.get(capacity):
        runs.append((capacity, 0, counts[capacity], 1, 0, 0))
        sequences = counts[capacity]
    big = [(x, n) for x, n in sorted(counts.items(), reverse=True) if capacity * large < x < capacity and n]
    per_group, queues, filled_to = -(-sum(n for _, n in big) // groups) if big else 1, [], 0
    for x, n in big:  # groups of equal cardinality, longest first
        rank = 0
        while n:
            if not queues or filled_to == per_group:
                queues.append([])
                filled_to = 0
            take = min(n, per_group - filled_to)
            queues[-1].append([x, rank, take])
            rank, n, filled_to = rank + take, n - take, filled_to + take
    merged: dict[int, list] = {}
    for q in queues:
        merged.setdefault(q[0][0], []).extend(q)
    sizes = list(merged)
    queues = [merged[s][::-1] for s in sizes]  # taken from the end
    rooms: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: (first sequence, sequences, used)
    for config, times in _configurations(sizes, [sum(r[2] for r in merged[s]) for s in sizes], capacity) if sizes else []:
        slots = [k for k, n in enumerate(config) for _ in range(n)]
        taken = []
        for k in slots:
            rest, parts = times, []
            while rest:
                run = queues[k][-1]
                n = min(rest, run[2])
                parts.append((run[0], run[1], n))
                run[1], run[2], rest = run[1] + n, run[2] - n, rest - n
                if not run[2]:
                    queues[k].pop()
            taken.append(parts)
        at = [[0, 0] for _ in slots]  # part, and how much of it is used
        done = 0
        while done < times:  # equal sequences, up to where any slot's length changes
            n = min(parts[i][2] - used for parts, (i, used) in zip(taken, at))
            offset = 0
            for parts, place in zip(taken, at):
                x, rank, size = parts[place[0]]
                runs.append((x, rank + place[1], n, 1, sequences, offset))
                offset += x
                place[1] += n
                if place[1] == size:
                    place[:] = [place[0] + 1, 0]
            rooms[capacity - offset].append((sequences, n, offset))
            sequences, done = sequences + n, done + n
    for x, n in sorted(((x, n) for x, n in counts.items() if x <= capacity * large and n), reverse=True):
        rank = 0
        for room in range(x, capacity + 1):
            while n and rooms[room]:
                first, bins, used = rooms[room].pop()
                each = room // x
                full = min(bins, n // each)
                if full:
                    runs.append((x, rank, full * each, each, first, used))
                    rooms[room - each * x].append((first, full, used + each * x))
                    rank, n, first, bins = rank + full * each, n - full * each, first + full, bins - full
                if bins and n:  # fewer than fill one sequence are left
                    runs.append((x, rank, n, each, first, used))
                    rooms[room - n * x].append((first, 1, used + n * x))
                    rank, n, first, bins = rank + n, 0, first + 1, bins - 1
                if bins:
                    rooms[room].append((first, bins, used))
            if not n:
                break
        if n:
            each = capacity // x
            full, rest = divmod(n, each)
            if full:
                runs.append((x, rank, full * each, each, sequences, 0))
                rooms[capacity - each * x].append((sequences, full, each * x))
            if rest:
                runs.append((x, rank + full * each, rest, each, sequences + full, 0))
                rooms[capacity - rest * x].append((sequences + full, 1, rest * x))
            sequences += full + bool(rest)
    return runs, sequences


def _placed(runs: list[tuple[int, ...]]):
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    keys = table[:, 0] << 48 | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            hit = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            past = rank - hit[:, 1]
            columns = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            columns["sequence_id"] = pa.array(hit[:, 4] + past // hit[:, 3])
            columns["offset"] = pa.array(hit[:, 5] + past % hit[:, 3] * length)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def ranked(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0. Pieces are dealt to hash buckets of bounded size, numbered there, and shifted by the buckets before."""
    buckets = max(1, -(-pieces.count() // RANKED))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    sizes = staged(sizes.select("length", "bucket", before.alias("before")), "offsets")
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    pieces = pieces.withColumn("rank", rank.cast("long")).join(sizes, ["length", "bucket"])
    return pieces.withColumn("rank", F.col("rank") + F.col("before")).drop("bucket", "before")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, groups: int = GROUPS, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id and offset."""
    with small_batches(docs.sparkSession):
        pieces = staged(pieces_of(docs, tokenizer, capacity, end_id, keep_ids, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs, _ = linear_grouping(counts, capacity, groups)
    rows = ranked(pieces).select(*pieces.columns, "rank")
    schema = T.StructType(list(pieces.schema)).add("sequence_id", "long").add("offset", "long")
    return rows.mapInArrow(_placed(runs), schema)
