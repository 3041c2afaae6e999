"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark items become test strings of ``window`` words.  Each class of test
strings (by length) gets a shift table over blocks of its first ``m`` bytes,
buckets by the hash of the suffix block of those bytes, and the test strings
themselves for direct comparison.  A task lays the lower-cased words of many
documents end to end and moves one search position per lane of text: a block
whose shift is positive skips that many bytes, a zero shift selects a bucket,
and a bucket's strings whose first bytes agree are compared in full.

Edge cases: a null or wordless text has no words and is never contaminated; a
null or wordless item has no test strings; a null item id is an item of its
own, written as the empty string; repeated rows give one result row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import ALNUM_WORD, column_bytes, fresh, joined_words, slices, stage, word_spans

WINDOW = 13
LANE_BYTES = 2048
# Test strings of one search: items beyond it go to further searches over the documents, one after the other.
BLOCK_BYTES = 32 << 20

MATCHES = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"


def item_windows(text: str | None, window: int) -> list[tuple[bytes, int]]:
    """Test strings of one item, each between single spaces, with their word counts."""
    body, offsets = column_bytes(pa.array([text], pa.string()))
    starts, ends, rows = word_spans(body, offsets, ALNUM_WORD)
    if not len(starts):
        return []
    words = joined_words(body, starts, ends, rows)[0].split()
    size = min(window, len(words))
    return [(b" " + b" ".join(words[i:i + size]) + b" ", size) for i in range(len(words) - size + 1)]


class WuManber:
    """Shift table, suffix-hash buckets and test strings of one length class."""

    def __init__(self, patterns: list[bytes], ids: list[int]) -> None:
        self.m = min(map(len, patterns))
        self.block = min(8, self.m)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        per = self.m - self.block + 1
        self.bits = int(np.clip(np.ceil(np.log2(4 * per * len(patterns))), 10, 24))
        head = np.frombuffer(b"".join(p[: self.m] + b"\0" * 8 for p in patterns), np.uint8).reshape(len(patterns), self.m + 8)
        self.shift = np.full(1 << self.bits, per, np.int32)
        for j in range(per):
            codes = self.codes(np.ascontiguousarray(head[:, j:j + 8]).view("<u8")[:, 0])
            np.minimum.at(self.shift, codes, per - 1 - j)
        order = np.argsort(codes, kind="stable")
        self.keys, first, self.count = np.unique(codes[order], return_index=True, return_counts=True)
        self.first = first
        self.head = (np.ascontiguousarray(head[order, :8]).view("<u8")[:, 0]) & self.mask
        self.patterns = [patterns[i] for i in order]
        self.ids = [ids[i] for i in order]

    def codes(self, blocks: np.ndarray) -> np.ndarray:
        """Hash of the blocks that begin the given 8-byte little-endian words."""
        return ((blocks & self.mask) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place, pattern id) of every occurrence."""
        end = len(text) - self.m + 1
        if end <= 0:
            return
        padded = np.frombuffer(text + b"\0" * 8, np.uint8)
        words = np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))
        at = np.arange(0, end, LANE_BYTES)
        stop = np.minimum(at + LANE_BYTES, end)
        hits = []
        back = self.m - self.block
        while len(at):
            skip = self.shift[self.codes(words[at + back])]
            hits.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        found = np.concatenate(hits)
        codes = self.codes(words[found + back])
        bucket = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
        real = self.keys[bucket] == codes
        found, bucket = found[real], bucket[real]
        for start in range(0, len(found), 1 << 16):
            part, of = found[start:start + (1 << 16)], bucket[start:start + (1 << 16)]
            many = self.count[of]
            place = np.repeat(part, many)
            which = np.repeat(self.first[of] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            same = (words[place] & self.mask) == self.head[which]
            for p, k in zip(place[same].tolist(), which[same].tolist()):
                if text.startswith(self.patterns[k], p):
                    yield p, self.ids[k]


class Matcher:
    """All test strings of a block of items, in classes of similar length."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        owners: dict[bytes, set[str]] = {}
        self.sizes: list[int] = []
        for item, text in items:
            for pattern, size in item_windows(text, window):
                if pattern not in owners:
                    owners[pattern] = set()
                    self.sizes.append(size)
                owners[pattern].add(item or "")
        self.owners = [sorted(x) for x in owners.values()]
        classes: dict[int, list[tuple[bytes, int]]] = {}
        for i, pattern in enumerate(owners):
            classes.setdefault(min(len(pattern).bit_length(), 6), []).append((pattern, i))
        self.searches = [WuManber([p for p, _ in c], [i for _, i in c]) for _, c in sorted(classes.items())]

    def scan(self, column: pa.Array) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
        """Per row: its word count, the merged word spans of all occurrences, the items that occur."""
        body, offsets = column_bytes(column)
        n_words: list[int] = []
        spans: list[list[tuple[int, int]]] = []
        found: list[list[str]] = []
        for first, last in slices(offsets):
            part = body[offsets[first]:offsets[last]]
            starts, ends, rows = word_spans(part, offsets[first:last + 1] - offsets[first], ALNUM_WORD)
            n_words += np.diff(rows).tolist()
            own: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[str]] = {}
            if len(starts) and self.searches:
                text, places = joined_words(part, starts, ends, rows)
                for search in self.searches:
                    for place, k in search.search(text):
                        word = int(np.searchsorted(places, place + 1))
                        row = int(np.searchsorted(rows, word, "right")) - 1
                        own.setdefault(row, []).append((word - int(rows[row]), word - int(rows[row]) + self.sizes[k]))
                        items.setdefault(row, set()).update(self.owners[k])
            for row in range(last - first):
                spans.append(merged(own.get(row, [])))
                found.append(sorted(items.get(row, ())))
        return n_words, spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, most: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about ``most`` bytes of test strings; one block at a time is on the driver."""
    own = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size * window // most))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for k in range(parts):
        yield [(r["item"], r["text"]) for r in own.where(part == k).toLocalIterator()]


def find_contamination(documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                       prefix: str = "match_") -> DataFrame:
    """``documents`` plus its word count, the word spans that occur in an item's windows, and the items.

    The columns are ``{prefix}n_words``, ``{prefix}spans`` and ``{prefix}items``
    (underscores are put before a name that clashes).  Nothing is shuffled: the
    test strings go to the tasks in blocks of bounded size, and the documents
    are read once per block (once in all for a benchmark below the bound).
    """
    spark = documents.sparkSession
    names = fresh(documents.columns, f"{prefix}n_words", f"{prefix}spans", f"{prefix}items")
    kinds = [f.dataType for f in T._parse_datatype_string(MATCHES).fields]
    df = documents
    schema = T.StructType(documents.schema.fields + [T.StructField(n, k) for n, k in zip(names, kinds)])
    where = documents.columns.index(text_col)
    width = len(documents.columns)
    for k, items in enumerate(_blocks(benchmark, item_col, item_text_col, window, block_bytes)):
        if k:
            df = stage(df, "contamination")
        shared = spark.sparkContext.broadcast(Matcher(items, window))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, again=k > 0) -> Iterator[pa.RecordBatch]:
            matcher = shared.value
            struct = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            for batch in batches:
                n_words, spans, found = matcher.scan(batch.column(where))
                if again:
                    earlier = [[(s["start"], s["end"]) for s in x] for x in batch.column(width + 1).to_pylist()]
                    spans = [merged(a + b) for a, b in zip(earlier, spans)]
                    found = [sorted({*a, *b}) for a, b in zip(batch.column(width + 2).to_pylist(), found)]
                rows = [[{"start": s, "end": e} for s, e in x] for x in spans]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], pa.array(n_words, pa.int64()), pa.array(rows, pa.list_(struct)), pa.array(found, pa.list_(pa.string()))],
                    names=[*batch.schema.names[:width], *names])

        df = df.mapInArrow(scan, schema)
    return df


def contaminated(n_words: F.Column, n_hit: F.Column) -> F.Column:
    """A twentieth or more of the words lie in benchmark windows."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def hit_words(spans: F.Column) -> F.Column:
    return F.coalesce(F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]), F.lit(0))


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    df = find_contamination(documents, benchmark, **options)
    n_words, spans, _ = df.columns[len(documents.columns):]
    return df.where(~contaminated(F.col(n_words), hit_words(F.col(spans)))).select(*documents.columns)


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
