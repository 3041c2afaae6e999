"""Packing token pieces into sequences by a configuration linear program over the length histogram.

Only the histogram (one count per length, so at most ``capacity`` numbers)
leaves the cluster.  The program's variables are configurations: multisets of
lengths that fit into a sequence.  Multiplicative weights price the lengths,
dearer the less of a length's demand is covered, and a knapsack dynamic
program finds the best configurations under those prices.  The columns of all
rounds add up to a fractional solution, which is rounded down to whole
sequences; the pieces that rounding leaves are placed by best fit.  The prices
also bound the number of sequences from below.  The plan maps the k-th piece of a length to its sequence and offset by
arithmetic, so pieces only need a rank within their length.

Edge cases: a null or empty text is one piece of the end token alone; repeated
rows and ids are pieces of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import tokens
from strata.llm.common import fresh, stage

CAPACITY = 1024
END_ID = 2
# Rounds of the program, configurations that a round adds, how fast weights fall, and how far ahead of its goal a length may be.
ROUNDS, SEEDS, RATE, SLACK = 200, 32, 4.0, 0.01
# Shares of the fractional solution that are tried for rounding.
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25, 0.125, 0.0625)


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of every room up to ``capacity`` and the index of the last length taken (-1: leave one token free)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        k = fitting[room]
        best[room] = best[room - 1]
        if k:
            values = best[room - lengths[:k]] + prices[:k]
            j = int(values.argmax())
            if values[j] > best[room]:
                best[room], last[room] = values[j], j
    return best, last


def _filled(seed: int, lengths: np.ndarray, last: np.ndarray, capacity: int) -> dict[int, int]:
    """The best configuration that holds ``seed``."""
    config, room = {seed: 1}, capacity - seed
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            n = int(lengths[last[room]])
            config[n] = config.get(n, 0) + 1
            room -= n
    return config


def solve(demand: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[tuple[tuple[int, int], ...], float], float]:
    """A fractional solution {configuration: sequences}, of full sequences alone, and a lower bound for any solution.

    Multiplicative weights: after t of T rounds every length should be covered
    to t / T of its demand.  Its weight falls exponentially with how far it is
    ahead of that, its price is the room it takes times its weight, and lengths
    that are ahead by more than a little are left out of the round.  A round
    adds the configurations of the highest value that hold the lengths which
    lag most, each by what keeps its lengths within that little.  The columns
    so add up over all rounds, and what they hold stays in proportion to the
    demand.  Prices at which no configuration is worth more than a sequence
    bound the program from below.
    """
    lengths = np.array(sorted(demand))
    d = np.array([demand[n] for n in lengths.tolist()], float)
    at = {n: i for i, n in enumerate(lengths.tolist())}
    total, covered, bound = float((lengths * d).sum()) / capacity, np.zeros(len(lengths)), 0.0
    found: dict[tuple[tuple[int, int], ...], float] = {}
    for t in range(ROUNDS):
        goal = (t + 1) / ROUNDS
        z = np.clip(RATE * (t / ROUNDS - covered / d), -30, 30)
        price = lengths / capacity * np.exp(z - z.mean())
        free = np.flatnonzero(covered / d < goal + SLACK)
        own = lengths[free]
        best, last = _knapsack(own, price[free], capacity)
        if len(free) == len(lengths):
            bound = max(bound, float((d * price).sum()) / best[capacity])
        taken = 0
        for seed in own[np.lexsort((own, z[free]))[::-1]].tolist():
            config = _filled(seed, own, last, capacity)
            if sum(n * a for n, a in config.items()) < capacity:
                continue
            i, a = np.array([at[n] for n in config]), np.array(list(config.values()), float)
            step = min(2 * total / ROUNDS / SEEDS, float(((goal + SLACK - covered[i] / d[i]) * d[i] / a).min()))
            if step <= 0:
                continue
            key = tuple(sorted(config.items()))
            found[key] = found.get(key, 0.0) + step
            covered[i] += a * step
            taken += 1
            if taken == SEEDS:
                break
    return found, bound


def _rounded(found: dict, demand: dict[int, int], share: float) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Whole sequences of a share of the fractional solution, and what they leave."""
    left, out = dict(demand), []
    for config, x in sorted(found.items(), key=lambda e: (-e[1], e[0])):
        k = min([int(share * x), *(left.get(n, 0) // a for n, a in config)])
        if k:
            out.append((dict(config), k))
            for n, a in config:
                left[n] -= a * k
    return out, {n: c for n, c in left.items() if c}


def configurations(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[dict[int, int], int]], int]:
    """(configuration, number of sequences) that hold every piece of the histogram exactly once, and a lower bound for the number of sequences.

    Of the fractional solution the share is rounded down that gives the fewest
    sequences with what best fit makes of the rest, the largest such share.
    """
    left = {n: int(c) for n, c in histogram.items() if c > 0}
    whole = [({capacity: 1}, left.pop(capacity))] if left.get(capacity) else []
    if not left:
        return whole, sum(x for _, x in whole)
    found, bound = solve(left, capacity)
    plans = []
    for share in SHARES:
        taken, rest = _rounded(found, left, share)
        plans.append(taken + best_fit(rest, capacity))
    best = min(plans, key=lambda plan: sum(x for _, x in plan))
    least = max(-(-sum(n * c for n, c in left.items()) // capacity), int(np.ceil(bound - 1e-6)))
    return whole + best, least + sum(x for _, x in whole)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest pieces first, each where the least room is left that holds it; equal sequences are filled together, so time follows the lengths, not the pieces."""
    rooms: list[tuple[int, int]] = []  # (room, number of the group), sorted
    groups: list[tuple[dict[int, int], int]] = []  # sequences of one content, and how many

    def put(room: int, config: dict[int, int], count: int) -> None:
        if count:
            bisect.insort(rooms, (room, len(groups)))
            groups.append((config, count))

    for n in sorted(left, reverse=True):
        k = left[n]
        while k:
            at = bisect.bisect_left(rooms, (n, -1))
            room, (config, count) = (capacity, ({}, k)) if at == len(rooms) else (rooms[at][0], groups[rooms[at][1]])
            if at < len(rooms):
                rooms.pop(at)
            # A sequence stays the one of least room until it holds no further piece of this length.
            each = room // n
            full = min(count, k // each)
            put(room - each * n, config | {n: each}, full)
            k, count = k - full * each, count - full
            if k and count:
                put(room - min(k, each) * n, config | {n: min(k, each)}, 1)
                k, count = k - min(k, each), count - 1
            if config:
                put(room, config, count)
    return [groups[i] for _, i in rooms]


@dataclass
class Plan:
    """Where the k-th piece of each length goes, as runs of ranks sorted by (length, first rank)."""

    key: np.ndarray
    first: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int

    @staticmethod
    def of(found: list[tuple[dict[int, int], int]]) -> Plan:
        seen: dict[int, int] = {}
        runs, base = [], 0
        for config, x in found:
            offset = 0
            for n, a in sorted(config.items(), reverse=True):
                runs.append(((n << 44) + seen.get(n, 0), seen.get(n, 0), a, base, offset))
                seen[n] = seen.get(n, 0) + a * x
                offset += n * a
            base += x
        columns = np.array(sorted(runs), np.int64).reshape(-1, 5).T
        return Plan(*columns, n_sequences=base)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.key, (length << 44) + rank, "right") - 1
        since = rank - self.first[run]
        return self.sequence[run] + since // self.per[run], self.offset[run] + since % self.per[run] * length


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: only the first may be shorter than the capacity."""
    first = n if n <= capacity else (n % capacity or capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(df: DataFrame, text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> tuple[DataFrame, list[str]]:
    """One row per piece, written, with the columns of ``df`` but the text; and the names of the added columns.

    The last two are the writing task and the piece's rank among the task's
    pieces of its length: what a task wrote is fixed, so ranks are too.
    """
    keep = [c for c in df.columns if c != text_col]
    names = fresh(keep, "piece", "start", "length", "ids_crc32", "ids", "part", "rank")
    kinds = [T.IntegerType(), *[T.LongType()] * 3, T.ArrayType(T.LongType()), T.IntegerType(), T.LongType()]
    if not with_ids:
        del names[4], kinds[4]
    schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(n, k) for n, k in zip(names, kinds)]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, ranks, part = tokens.encoder(path), {}, TaskContext.get().partitionId()
        for batch in batches:
            of, rows, ids = [], [], []
            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                own = np.append(ids_of(text or ""), np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(own), capacity)):
                    body = own[start:start + length]
                    rank = ranks.get(length, 0)
                    ranks[length] = rank + 1
                    of.append(i)
                    rows.append((k, start, length, zlib.crc32(body.tobytes()), rank))
                    if with_ids:
                        ids.append(body.astype(np.int64))
            piece, start, length, crc, rank = np.array(rows, np.int64).reshape(-1, 5).T
            new = [pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc),
                   *([pa.array(ids, pa.list_(pa.int64()))] if with_ids else []), pa.array(np.full(len(of), part), pa.int32()), pa.array(rank)]
            yield pa.RecordBatch.from_arrays([*batch.select(keep).take(pa.array(of, pa.int64())).columns, *new], names=[*keep, *names])

    return stage(df.select(*keep, text_col).mapInArrow(encode, schema), "pieces"), names


def _dense(batches: Iterator[pa.RecordBatch], capacity: int, most: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows (writing task, list of (length, number)) with the number of every length from 1 to ``capacity`` in its place."""
    for whole in batches:
        for batch in (whole.slice(i, most) for i in range(0, whole.num_rows, most)):
            entries = batch.column(1)
            own, flat = np.zeros((len(entries), capacity), np.int64), entries.flatten()
            own[np.repeat(np.arange(len(entries)), entries.value_lengths().to_numpy()), flat.field(0).to_numpy() - 1] = flat.field(1).to_numpy()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(entries) + 1) * capacity, pa.int32()), pa.array(own.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=batch.schema.names)


def pack(df: DataFrame, text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Pieces of ``df``'s texts with ``sequence_id`` and ``offset`` (names get leading underscores if they clash).

    Columns: those of ``df`` but the text, then piece, start, length,
    ids_crc32, ids (if asked for), sequence_id and offset.
    """
    cuts, names = pieces(df, text_col, path, capacity, end_id, with_ids)
    length, part, rank = names[2], names[-2], names[-1]
    before, sequence, offset = fresh(cuts.columns, "before", "sequence_id", "offset")
    counts = cuts.groupBy(part, length).agg(F.count("*").alias(before))
    counts = stage(counts, "counts")
    histogram = {r[length]: r["n"] for r in counts.groupBy(length).agg(F.sum(before).alias("n")).collect()}
    shared = df.sparkSession.sparkContext.broadcast(Plan.of(configurations(histogram, capacity)[0]))
    earlier = Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, length, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    listed = offsets.groupBy(part).agg(F.collect_list(F.struct(length, before)).alias(before))
    offsets = stage(listed.mapInArrow(lambda batches: _dense(batches, capacity), listed.select(part, F.array(F.lit(0).cast("bigint")).alias(before)).schema), "offsets")
    ranked = cuts.join(offsets, part).withColumn(rank, F.col(rank) + F.get(F.col(before), (F.col(length) - 1).cast("int"))).select(*cuts.columns)
    keep = [c for c in cuts.columns if c not in (part, rank)]
    schema = T.StructType([*[cuts.schema[c] for c in keep], T.StructField(sequence, T.LongType()), T.StructField(offset, T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            if batch.num_rows:
                at = plan.place(*(batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in (length, rank)))
                yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, *map(pa.array, at)], names=[*keep, sequence, offset])

    return ranked.mapInArrow(place, schema)
