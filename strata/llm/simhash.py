"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into two segments of 23 bits and a rest of 18.
The binary Golay code of length 23 is perfect: every segment value lies within
three bits of exactly one of its 4,096 codewords.  A segment therefore decodes
to one codeword index, and with each of its bits flipped to a few more; the
indices of two values that differ in at most one bit always meet in one of
those keys.  Three differing bits spread over the segments leave some pair of
parts with at most one error each (pigeonhole), so a few combinations of parts,
taken exactly or by codeword, find every pair.  Fingerprints that share a key
are compared bit by bit, and what is within the distance is linked.

Equal fingerprints are one row before any key is made.  Inside a key's bucket
the links are a spanning forest, never all pairs; a bucket that outgrows the
memory bound is dealt out again by further exact parts of its fingerprints.

Edge cases: null, empty and wordless texts have the fingerprint zero and are
linked like any other; repeated rows and ids are rows of their own; a null id
never names a component unless all ids of it are null; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import SPACED_WORD, column_bytes, fresh, joined_words, placed, slices, stage, word_spans
from strata.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
# Fingerprints of one bucket that a task holds and compares; larger buckets are dealt out again.
MOST_HELD = 1 << 16
# Bits of the two Golay segments and of the rest, from the low end.
SEGMENT, REST = 23, 18
# Generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GENERATOR = 0b101011100011


# ---------------------------------------------------------------- fingerprints


def fingerprints_of(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of every text of an Arrow column."""
    body, offsets = column_bytes(column)
    out = np.zeros(len(column), np.uint64)
    for first, last in slices(offsets):
        starts, ends, rows = word_spans(body[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], SPACED_WORD)
        if not len(starts):
            continue
        text, places = joined_words(body[offsets[first]:offsets[last]], starts, ends, rows)
        stops = places + (ends - starts)
        for row in range(last - first):
            a, b = int(rows[row]), int(rows[row + 1])
            if b > a:
                n = max(1, b - a - shingle + 1)
                size = min(shingle, b - a)
                out[first + row] = _fingerprint(text, places[a:a + n], stops[a + size - 1:a + size - 1 + n])
    return out


def _fingerprint(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.uint64:
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), 1 << 14):
        spans = zip(starts[i:i + (1 << 14)].tolist(), ends[i:i + (1 << 14)].tolist())
        hashes = np.array([digest(text[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0]


def with_fingerprint(df: DataFrame, text_col: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``df`` without its text, plus the fingerprint as a (signed) long."""
    keep = [c for c in df.columns if c != text_col]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = fingerprints_of(batch.column(len(keep)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks)], names=[*keep, name])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(name, T.LongType())])
    return df.select(*keep, text_col).mapInArrow(add, schema)


# ---------------------------------------------------------------- keys


@functools.cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 bits and of the high 11 bits of a segment, and the error pattern of every remainder."""

    def remainder(value: int) -> int:
        for bit in range(SEGMENT - 1, 10, -1):
            if value >> bit & 1:
                value ^= GENERATOR << (bit - 11)
        return value

    units = np.array([remainder(1 << i) for i in range(SEGMENT)], np.int64)

    def table(of: np.ndarray) -> np.ndarray:
        values = np.arange(1 << len(of))
        return functools.reduce(np.bitwise_xor, [np.where(values >> i & 1, u, 0) for i, u in enumerate(of)])

    errors = np.zeros(1 << 11, np.int64)
    bits = [(1 << i, int(u)) for i, u in enumerate(units)]
    for i, (e1, s1) in enumerate(bits):
        errors[s1] = e1
        for j, (e2, s2) in enumerate(bits[:i]):
            errors[s1 ^ s2] = e1 | e2
            for e3, s3 in bits[:j]:
                errors[s1 ^ s2 ^ s3] = e1 | e2 | e3
    return table(units[:12]), table(units[12:]), errors


def codeword(segment: np.ndarray) -> np.ndarray:
    """The index (the top 12 bits) of the only codeword within three bits of a segment value."""
    low, high, errors = _golay()
    return (segment ^ errors[low[segment & 0xFFF] ^ high[segment >> 12]]) >> 11


def neighbours(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index): every index that the value decodes to as it is or with one bit flipped, each once."""
    flips = np.concatenate([[0], 1 << np.arange(SEGMENT)])
    near = np.sort(codeword(segment[:, None] ^ flips), axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    return np.nonzero(new)[0], near[new]


def keys_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of fingerprints, such that two within three bits share a key.

    With errors e1, e2 in the segments and e3 in the rest, e1 + e2 + e3 <= 3:
      e1 = 0, e2 = 0            both segments exact
      e1 = 0, e2 = 1            first exact, second by codeword (and the reverse)
      e1 = 0, e2 >= 2, e3 <= 1  first exact, and one half of the rest exact (and the reverse)
      e1 = 2, e2 = 1, e3 = 0    second by codeword, rest exact (and the reverse)
      e1 = e2 = 1, e3 <= 1      both by codeword, and one half of the rest exact
    """
    parts = [(marks >> np.uint64(at) & np.uint64((1 << SEGMENT) - 1)).astype(np.int64) for at in (0, SEGMENT)]
    rest = (marks >> np.uint64(2 * SEGMENT)).astype(np.int64)
    halves = (rest & ((1 << REST // 2) - 1), rest >> REST // 2)
    near = [neighbours(p) for p in parts]
    every = np.arange(len(marks))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(row: np.ndarray, key: np.ndarray) -> None:
        found.append((row, key * 16 + len(found)))

    add(every, parts[0] << SEGMENT | parts[1])
    for exact, other in ((0, 1), (1, 0)):
        row, index = near[other]
        add(row, parts[exact][row] << 12 | index)
        add(row, rest[row] << 12 | index)
        for half in halves:
            add(every, parts[exact] << REST // 2 | half)
    (first, left), (second, right) = near
    count = np.bincount(second, minlength=len(marks))
    times = count[first]
    row = np.repeat(first, times)
    at = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + (np.cumsum(count) - count)[row]
    both = np.repeat(left, times) << 12 | right[at]
    for half in halves:
        add(row, both << REST // 2 | half[row])
    return np.concatenate([r for r, _ in found]), np.concatenate([k for _, k in found])


# ---------------------------------------------------------------- buckets

ENTRY = "key bigint, mark bigint, free bigint"
FOUND = "a bigint, b bigint, key bigint, free bigint"


def _entries(marks: DataFrame) -> DataFrame:
    """Every key of every fingerprint; ``free`` has the bits that a key's bucket may still be dealt out by."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for i in range(0, len(own), 4096):
                part = own[i:i + 4096]
                row, key = keys_of(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row]), pa.array(np.full(len(row), -1))], names=["key", "mark", "free"])

    return marks.mapInArrow(expand, ENTRY)


def _dealt_again(entries: DataFrame) -> DataFrame:
    """Four finer keys per entry: the free bits in four parts, of which fingerprints within three bits share one."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, mark, free = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            for mask in np.unique(free):
                of = free == mask
                bits = [i for i in range(64) if int(mask) >> i & 1]
                for k in range(4):
                    part = np.uint64(sum(1 << i for i in bits[k::4]))
                    new = (key[of] * np.uint64(4) + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) ^ (mark[of] & part) * np.uint64(0xC2B2AE3D27D4EB4F)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(new.view(np.int64)), pa.array(mark[of].view(np.int64)), pa.array(np.full(len(new), mask & ~part).view(np.int64))],
                        names=["key", "mark", "free"])

    return entries.mapInArrow(expand, ENTRY)


def forest(marks: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (positions) that join what is within ``distance``, directly or by others: each value is compared with those not yet joined."""
    links = []
    left = np.arange(len(marks))
    while len(left) > 1:
        waiting, left = [int(left[0])], left[1:]
        while waiting and len(left):
            seed = waiting.pop()
            near = np.bitwise_count(marks[left] ^ marks[seed]) <= distance
            found = left[near].tolist()
            links += [(seed, x) for x in found]
            waiting += found
            left = left[~near]
    return links


def _bucket_links(entries: DataFrame, distance: int, most: int) -> DataFrame:
    """Links (a, b) inside the buckets; the entries of buckets with more than ``most`` rows come back with a null ``b``."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, key, free) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, key, free)], names=["a", "b", "key", "free"])

        keys, marks, free, over = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in _and_end(batches):
            if batch is not None:
                keys, marks, free = (np.concatenate([x, batch.column(i).to_numpy()]) for i, x in enumerate((keys, marks, free)))
            if not len(keys):
                continue
            # Rows of the last key wait for the next batch.
            done = len(keys) if batch is None else int(np.searchsorted(keys, keys[-1]))
            if over is not None:
                more = int(np.searchsorted(keys, over, "right"))
                if more:
                    yield out(marks[:more], [None] * more, keys[:more], free[:more])
                    keys, marks, free, done = keys[more:], marks[more:], free[more:], max(0, done - more)
                if len(keys):
                    over = None
            starts = np.flatnonzero(np.concatenate([[True], keys[1:done] != keys[:done - 1]])) if done else np.zeros(0, np.int64)
            sizes = np.diff(np.append(starts, done))
            pairs = starts[sizes == 2]
            close = pairs[np.bitwise_count((marks[pairs] ^ marks[pairs + 1]).view(np.uint64)) <= distance]
            a, b = marks[close].tolist(), marks[close + 1].tolist()
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if size > most:
                    yield out(marks[start:start + size], [None] * size, keys[start:start + size], free[start:start + size])
                    continue
                own = marks[start:start + size]
                for x, y in forest(own.view(np.uint64), distance):
                    a.append(int(own[x]))
                    b.append(int(own[y]))
            if a:
                yield out(a, b, [None] * len(a), [None] * len(a))
            keys, marks, free = keys[done:], marks[done:], free[done:]
            if len(keys) > most:
                over = int(keys[0])
                yield out(marks, [None] * len(keys), keys, free)
                keys, marks, free = keys[:0], marks[:0], free[:0]

    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(link, FOUND)


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def links_within(marks: DataFrame, distance: int = DISTANCE, most: int = MOST_HELD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (one long column) that join all that is within ``distance`` (three at most)."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the keys find distances of up to {DISTANCE} bits")
    entries, links = _entries(marks), None
    while True:
        found = stage(_bucket_links(entries, distance, most), "buckets")
        own = found.where(F.col("b").isNotNull()).select("a", "b")
        links = own if links is None else links.union(own)
        over = found.where(F.col("b").isNull())
        if over.isEmpty():
            return links
        entries = _dealt_again(over.select("key", F.col("a").alias("mark"), "free"))


# ---------------------------------------------------------------- operator


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``df`` without its text, plus ``fingerprint`` (16 hex digits) and ``component_id`` (underscores are put before names that clash)."""
    keep = [c for c in df.columns if c != text_col]
    mark, name, component = fresh(keep, "mark", "fingerprint", "component_id")
    marked = stage(with_fingerprint(df, text_col, mark, shingle), "fingerprints")
    own = component_table(marked, mark, F.min(id_col), distance)
    return marked.join(own.select(F.col("mark").alias(mark), F.col("first").alias(component)), mark).select(
        *keep, F.lower(F.lpad(F.hex(mark), 16, "0")).alias(name), component)


def component_table(marked: DataFrame, mark: str, first, distance: int) -> DataFrame:
    """(mark, first): for every distinct fingerprint, the least ``first`` (an aggregate) over its component."""
    distinct = stage(marked.groupBy(F.col(mark).alias("mark")).agg(first.alias("first")), "marks")
    roots = components(links_within(distinct.select("mark"), distance))
    rooted = distinct.join(roots, F.col("mark") == F.col("node"), "left").select("mark", "first", F.coalesce("root", "mark").alias("root"))
    return rooted.drop("first").join(rooted.groupBy("root").agg(F.min("first").alias("first")), "root").select("mark", "first")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of every component: that with the least id (of repeated rows, one).

    The rows are told apart by ``placed``: the same numbers for the fingerprints and for the result.
    """
    row, mark, first = fresh(df.columns, "row", "mark", "first")
    numbered = placed(df, row)
    marked = stage(with_fingerprint(numbered.select(id_col, row, text_col), text_col, mark, shingle), "fingerprints")
    least = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row).alias("row")))
    own = component_table(marked, mark, least, distance)
    gone = marked.join(own.select(F.col("mark").alias(mark), F.col("first.row").alias(first)), mark).where(F.col(row) != F.col(first)).select(row)
    return numbered.join(stage(gone, "copies"), row, "left_anti").select(*df.columns)
