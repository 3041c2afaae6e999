"""Hard negatives by an STR-packed R-tree over integer vectors.

Index: all vectors are dealt into slices by one coordinate and into tiles by
another (the two of largest variance; range partitions, so equal coordinates
spread by id), and packed inside a tile, by the next two, into leaf pages.  A
written page row holds its vectors and the least and greatest value of every
coordinate.  A task groups the pages it reads, in their order, under inner
boxes.

Search: for an anchor a, a box gives an interval of inner products: each
coordinate adds at most max(a*low, a*high) and at least min(a*low, a*high).
Each anchor pops its box of the greatest upper end; boxes outside the score
window, or with an upper end strictly below the k-th score found so far, are
passed over, so ties of the k-th score are all seen and results are exact.
Anchors are the stated query set; they go against all pages in blocks of a
fixed size, each broadcast, and every task sends on k rows at most for an
anchor.  Before the pages are read, a fixed share of them (by page number)
gives each anchor a score that its k-th cannot fall below, so that most tasks
send nothing.

Edge cases: rows with a null id, a null label, a null vector or a null or
non-finite component take no part; a vector shorter than the longest counts as
ended by zeros; repeated rows are rows of their own; a vector of no components
scores 0; an empty table gives an empty result; scores that need more than 63
bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import scratch_path, stage

EVERY = 50
N_POSITIVES, N_NEGATIVES = 5, 3
# Of a positive's score, in per cent: the window of its negatives' scores.
LEAST_PERCENT, MOST_PERCENT = 50, 95

TILE_ROWS, PAGE_ROWS, FAN_OUT = 4096, 64, 16
# Anchors of a block, anchors and pages that a task compares at once, and the share of pages read first.
BLOCK_ROWS, SLAB_ROWS, CHUNK_PAGES, FIRST_SHARE = 4096, 1024, 512, 32

PAGES = "page bigint, n int, places binary, ids binary, labels binary, vectors binary, low binary, high binary"
NONE = -(1 << 62)


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vector) of the rows that take part; components are floor(256 * x)."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    label = F.col(label_col).cast("bigint")
    return df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(F.forall(vector_col, fine), F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * 256).cast("bigint")).alias("vector"))


# ---------------------------------------------------------------- index


def _axes(vectors: DataFrame) -> list[int]:
    """The coordinates by falling variance; as many rows as coordinates reach the driver."""
    spread = vectors.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.var_pop("x").alias("v"))
    return [r.at for r in spread.orderBy(F.desc("v"), "at").collect()]


def _packed(vectors: np.ndarray, axes: list[int]) -> Iterator[np.ndarray]:
    """The rows of leaf pages: sorted into strips by one coordinate, and inside a strip by the other."""
    order = np.argsort(vectors[:, axes[0]], kind="stable") if axes else np.arange(len(vectors))
    n_pages = -(-len(order) // PAGE_ROWS)
    strip = PAGE_ROWS * max(1, int(np.ceil(np.sqrt(n_pages))))
    for i in range(0, len(order), strip):
        own = order[i:i + strip]
        if len(axes) > 1:
            own = own[np.argsort(vectors[own, axes[1]], kind="stable")]
        for k in range(0, len(own), PAGE_ROWS):
            yield own[k:k + PAGE_ROWS]


def build_index(vectors: DataFrame, tile_rows: int = TILE_ROWS) -> tuple[DataFrame, int]:
    """The leaf pages of the tree as a written table, and the number of coordinates."""
    vectors = stage(vectors, "vectors")
    n, size = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    size, axes = size or 0, _axes(vectors)
    n_tiles = max(1, -(-n // tile_rows))
    n_slices = int(np.ceil(np.sqrt(n_tiles)))
    along = lambda i: F.coalesce(F.get("vector", F.lit(axes[i] if len(axes) > i else 0)), F.lit(0))
    numbered = vectors.withColumn("row", F.monotonically_increasing_id())  # keeps equal rows apart in the ranges, nothing else
    sliced = numbered.repartitionByRange(n_slices, along(0), "id", "row").withColumn("slice", F.spark_partition_id())
    order = [F.col("slice"), along(1), F.col("id"), F.col("row")]
    tiled = sliced.repartitionByRange(n_slices * -(-n_tiles // n_slices), *order).sortWithinPartitions(*order)
    rows = tiled.select(F.spark_partition_id().cast("bigint").alias("tile"), "slice", "id", "label", "vector")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held = 0, []

        def pages(table: pa.Table) -> Iterator[dict]:
            nonlocal done
            slices = table.column("slice").to_numpy()
            matrix = _matrix(table.column("vector").combine_chunks(), size)
            ids, labels, tile = table.column("id").to_numpy(), table.column("label").to_numpy(), table.column("tile")[0].as_py()
            for slice_ in np.unique(slices):
                own = np.flatnonzero(slices == slice_)
                for part in _packed(matrix[own], axes[2:4] or axes[:2]):
                    at = own[part]
                    at = at[np.argsort(ids[at], kind="stable")]
                    places = (tile << 40) + done + np.arange(len(at))
                    yield {"page": (tile << 40) + done, "n": len(at), "places": places.tobytes(), "ids": ids[at].tobytes(), "labels": labels[at].tobytes(),
                           "vectors": matrix[at].tobytes(), "low": matrix[at].min(0).tobytes(), "high": matrix[at].max(0).tobytes()}
                    done += len(at)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * tile_rows:
                yield from _batches(pages(pa.Table.from_batches(held)), PAGES)
                held = []
        if held and sum(b.num_rows for b in held):
            yield from _batches(pages(pa.Table.from_batches(held)), PAGES)

    return stage(rows.mapInArrow(pack, PAGES), "pages"), size


def _matrix(lists: pa.ListArray, size: int) -> np.ndarray:
    n = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    if (n == size).all():
        return flat.reshape(len(n), size)
    out = np.zeros((len(n), size), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _schema(kinds: str) -> pa.Schema:
    of = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, of[kind]) for name, kind in (x.split() for x in kinds.split(","))])


def _batches(rows: Iterator[dict], kinds: str, most: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema=_schema(kinds))
            held = []
    yield pa.RecordBatch.from_pylist(held, schema=_schema(kinds))


class Page(NamedTuple):
    places: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def _pages(batch: pa.RecordBatch, size: int) -> Iterator[tuple[Page, np.ndarray, np.ndarray]]:
    read = lambda name, i: np.frombuffer(batch.column(batch.schema.get_field_index(name))[i].as_buffer(), np.int64)
    for i in range(batch.num_rows):
        ids = read("ids", i)
        yield Page(read("places", i), ids, read("labels", i), read("vectors", i).reshape(len(ids), size)), read("low", i), read("high", i)


# ---------------------------------------------------------------- search


class Search(NamedTuple):
    """Queries of a block: one for each row, with the window of its scores and a score that its k-th cannot fall below."""

    vectors: np.ndarray
    places: np.ndarray
    labels: np.ndarray
    least: np.ndarray
    most: np.ndarray
    floor: np.ndarray
    same: bool
    k: int


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in floating point where every sum stays below 2 ** 53."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2.0 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound >= 2.0 ** 62:
        raise ValueError("a score needs more than 63 bits")
    return a @ b.T


def _interval(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with anything inside each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return _products(up, low) + _products(down, high), _products(up, high) + _products(down, low)


class Best:
    """The k best (score, id) of every query; higher scores come first, then smaller ids."""

    def __init__(self, search: Search) -> None:
        n = len(search.places)
        self.k, self.floor = search.k, search.floor
        self.scores, self.ids = np.full((n, self.k), NONE), np.full((n, self.k), np.iinfo(np.int64).max)

    def kth(self, rows: slice) -> np.ndarray:
        return np.maximum(self.scores[rows, -1], self.floor[rows])

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(query)
        query = np.concatenate([query, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, touched)
        at = first[:, None] + np.arange(self.k)
        self.scores[touched], self.ids[touched] = score[at], ids[at]


def _chunk_search(search: Search, best: Best, pages: list[Page], low: np.ndarray, high: np.ndarray) -> None:
    """Best-first search of all queries in one chunk of pages, in slabs of queries."""
    n = len(pages)
    first = np.arange(0, n, FAN_OUT)
    n_inner = len(first)
    inner_low, inner_high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
    for begin in range(0, len(search.places), SLAB_ROWS):
        rows = slice(begin, min(begin + SLAB_ROWS, len(search.places)))
        a, least, most = search.vectors[rows], search.least[rows, None], search.most[rows, None]

        def ends(box_low: np.ndarray, box_high: np.ndarray) -> np.ndarray:
            """Upper ends, ``NONE`` for boxes outside the window."""
            down, up = _interval(a, box_low, box_high)  # noqa: B023
            return np.where((up < least) | (down > most), NONE, up)  # noqa: B023

        leaf = ends(low, high)
        queue = np.concatenate([ends(inner_low, inner_high), np.full((len(a), n), NONE)], axis=1)
        while True:
            top = queue.argmax(1)
            value = queue[np.arange(len(a)), top]
            live = np.flatnonzero((value > NONE) & (value >= best.kth(rows)))
            if not len(live):
                break
            box = top[live]
            queue[live, box] = NONE
            order = np.argsort(box, kind="stable")
            cuts = np.flatnonzero(np.diff(box[order])) + 1
            found = []
            for own in np.split(live[order], cuts):
                at = int(top[own[0]])
                if at < n_inner:
                    children = slice(at * FAN_OUT, min(n, (at + 1) * FAN_OUT))
                    queue[own, n_inner + children.start:n_inner + children.stop] = leaf[own, children]
                    continue
                page = pages[at - n_inner]
                scores = _products(a[own], page.vectors)
                same = page.labels[None, :] == search.labels[rows][own, None]
                fit = (same if search.same else ~same) & (page.places[None, :] != search.places[rows][own, None])
                fit &= (scores >= np.maximum(least[own], best.kth(rows)[own, None])) & (scores <= most[own])
                q, c = np.nonzero(fit)
                if len(q):
                    found.append((own[q] + begin, scores[q, c], page.ids[c]))
            if found:
                best.add(*(np.concatenate(x) for x in zip(*found)))


def _searched(pages: DataFrame, size: int, shared) -> DataFrame:
    """(query, score, id): what each task found among its pages for the queries of a broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: Search = shared.value
        best, held = Best(search), []

        def chunk() -> None:
            _chunk_search(search, best, [p for p, _, _ in held], np.array([x for _, x, _ in held]), np.array([x for _, _, x in held]))

        for batch in batches:
            for page in _pages(batch, size):
                held.append(page)
                if len(held) == CHUNK_PAGES:
                    chunk()
                    held = []
        if held:
            chunk()
        query, at = np.nonzero(best.scores > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(best.scores[query, at]), pa.array(best.ids[query, at])], names=["query", "score", "id"])

    return pages.mapInArrow(run, "query bigint, score bigint, id bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _best(pages: DataFrame, size: int, search: Search, share: int) -> DataFrame:
    """(query, score, id, rank) of the k best of every query over all pages.

    A share of the pages is read first; the k-th score there is one that the
    k-th over all pages cannot fall below.
    """
    context = pages.sparkSession.sparkContext
    shared = context.broadcast(search)
    some = pages.where(F.pmod(F.xxhash64("page"), F.lit(share)) == 0)
    rows = _top(_searched(some, size, shared), search.k).where(F.col("rank") == search.k).select("query", "score").toArrow()
    shared.unpersist()
    floor = search.floor.copy()
    floor[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return _top(_searched(pages, size, context.broadcast(search._replace(floor=floor))), search.k)


def mine_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = EVERY, tile_rows: int = TILE_ROWS,
                   block_rows: int = BLOCK_ROWS, share: int = FIRST_SHARE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors whose id ``every`` divides."""
    spark = df.sparkSession
    pages, size = build_index(valid_vectors(df, id_col, vector_col, label_col), tile_rows)
    folder = scratch_path(spark, "negatives")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(({"place": int(p.places[i]), "id": int(p.ids[i]), "label": int(p.labels[i]), "vector": p.vectors[i].tobytes()}
                                 for p, _, _ in _pages(batch, size) for i in np.flatnonzero(p.ids % every == 0)), kinds)

    kinds = "place bigint, id bigint, label bigint, vector binary"
    chosen = stage(pages.mapInArrow(anchors, kinds), "anchors")
    n_blocks = max(1, -(-chosen.count() // block_rows))
    block = F.pmod(F.xxhash64("place"), F.lit(n_blocks)).alias("block")
    chosen.select("*", block).write.partitionBy("block").parquet(f"{folder}/anchors")
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    by_block = spark.read.schema(f"{kinds}, block int").parquet(f"{folder}/anchors")
    for number in range(n_blocks):
        rows = by_block.where(F.col("block") == number).drop("block").toArrow()
        _block(spark, pages, size, rows, share).write.mode("append").parquet(f"{folder}/result")
    return spark.read.schema(result).parquet(f"{folder}/result")


def _percent(score: np.ndarray, per: int) -> np.ndarray:
    """``per * score / 100`` rounded down, without a product of more bits than the score has."""
    return score // 100 * per + score % 100 * per // 100


def _block(spark, pages: DataFrame, size: int, rows: pa.Table, share: int) -> DataFrame:
    """The hard negatives of one block of anchors."""
    n = rows.num_rows
    ids, places, labels = (rows.column(c).to_numpy() for c in ("id", "place", "label"))
    vectors = np.array([np.frombuffer(v, np.int64) for v in rows.column("vector").to_pylist()], np.int64).reshape(n, size)
    wide = lambda m, x: np.full(m, x, np.int64)
    search = Search(vectors, places, labels, wide(n, NONE + 1), wide(n, -NONE), wide(n, NONE), True, N_POSITIVES)
    positives = _best(pages, size, search, share).select("query", "score", "id").toArrow()
    of, score, positive = (positives.column(i).to_numpy() for i in range(3))
    least, most = -_percent(-score, LEAST_PERCENT), _percent(score, MOST_PERCENT)
    search = Search(vectors[of], places[of], labels[of], least, most, wide(len(of), NONE), False, N_NEGATIVES)
    table = pa.table({"query": pa.array(np.arange(len(of))), "anchor_id": pa.array(ids[of]), "positive_id": pa.array(positive), "positive_score": pa.array(score)})
    names = spark.createDataFrame(table.to_pandas(), "query bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    return _best(pages, size, search, share).join(names, "query").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
