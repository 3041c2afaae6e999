"""Prefix trie of rebuilt conversations, with subtree totals by time-forward processing.

A rebuilt conversation is the first ``h`` turns of a base conversation and its
own turns after its first ``h``.  A prefix is named by its length and by two
64-bit sums of its turns' hashes (MD5 of role and text), each times a power of
its place, modulo 2 ** 64: equal prefixes have equal names, and different ones
differ but for a collision of 128 bits.  Such sums add up across partitions, so turns are sorted over all tasks
and a conversation of any length is dealt out; texts never leave the first scan.

A node is named by its smallest member and its depth.  Nodes whose members
have at most ``SHARD_ROWS`` turns below them are light; each light subtree lies
in one shard, the shards are sorted by falling depth, and totals go up through
a spilling queue.  The nodes above them, heavy ones, are cut into pieces of
one conversation's path; totals go across the pieces' roots, of which there is
one for ``SHARD_ROWS`` turns or so, in one stream through the same queue, and
then up within each piece.

Edge cases: rows of a null conversation id take no part; a null role or text
is empty; turns of one number come by the MD5 of role and text; a conversation
without turns is a member of the root alone; repeated rows are turns of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stage
from strata.llm.spilling_queue import forward

GROUP, MOD = 5, 9
# Member turns below a node of a light subtree at most, and nodes of a piece of a heavy path.
SHARD_ROWS = 1 << 12
# Ids joined to one row on their way to a digest.
BLOB_IDS = 1 << 13

# Weights are powers of an odd number, which have inverses modulo 2 ** 64.
_BASE, _STEP = 0x9E3779B97F4A7C15, 1 << 16
_LOW = np.cumprod(np.append(np.uint64(1), np.full(_STEP - 1, _BASE, np.uint64)))
_BACK = np.array([pow(_BASE, -i, 1 << 64) for i in range(MOD)], np.uint64)


def _weights(place: np.ndarray) -> np.ndarray:
    high, inverse = np.unique(place // _STEP, return_inverse=True)
    steps = np.array([pow(_BASE, int(x) * _STEP, 1 << 64) for x in high], np.uint64)
    return steps[inverse] * _LOW[place % _STEP]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _u(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(batch, name).view(np.uint64)


def _batch(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


# ---------------------------------------------------------------- turns


def turn_rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, key, n_bytes): the hash of role and text, and the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return df.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), key.alias("key"),
                                                        F.octet_length(text).cast("bigint").alias("n_bytes"))


NUMBERED = "part int, conv bigint, at bigint, before_a bigint, before_b bigint, upto_a bigint, upto_b bigint, n_bytes bigint"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Turns in order, as ``NUMBERED``: the place and the sums of a turn among its conversation's turns in its own partition."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, sums = TaskContext.get().partitionId(), None, 0, [np.uint64(0)] * 2
        for batch in batches:
            conv, n = _column(batch, "conv"), batch.num_rows
            if not n:
                continue
            keys = batch.column(batch.schema.get_field_index("key")).cast(pa.binary(16))
            keys = np.frombuffer(keys.buffers()[1], np.uint64, 2 * n, 16 * keys.offset).reshape(n, 2)
            first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            size = np.diff(np.append(first, n))
            at = np.arange(n) - np.repeat(first, size)
            goes_on = conv[0] == last
            if goes_on:
                at[:size[0]] += count
            weights, columns = _weights(at), []
            for i in range(2):
                terms = keys[:, i] * weights
                run = np.cumsum(terms)
                upto = run - np.repeat(run[first] - terms[first], size)
                if goes_on:
                    upto[:size[0]] += sums[i]
                columns.append((upto - terms, upto))
            last, count, sums = conv[-1], int(at[-1]) + 1, [c[1][-1] for c in columns]
            yield _batch(part=np.full(n, part, np.int32), conv=conv, at=at, before_a=columns[0][0], before_b=columns[1][0], upto_a=columns[0][1], upto_b=columns[1][1],
                         n_bytes=_column(batch, "n_bytes"))

    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("row")]
    apart = turns.withColumn("row", F.monotonically_increasing_id())  # repeated turns may lie in several ranges
    return stage(apart.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "key", "n_bytes").mapInArrow(number, NUMBERED), "turns")


OFFSETS = "conv bigint, part int, offset bigint, sum_a bigint, sum_b bigint, size bigint"


def turn_offsets(numbered: DataFrame) -> DataFrame:
    """For every conversation and partition: the turns before it, their sums, and the conversation's turns in all."""
    ends = F.max_by(F.struct("upto_a", "upto_b"), "at")
    parts = numbered.groupBy("conv", "part").agg((F.max("at") + 1).alias("n"), ends.alias("e")).select("conv", "part", "n", "e.upto_a", "e.upto_b")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def group() -> Iterator[tuple]:
            size, before, sums = sum(x[1] for x in held), 0, (0, 0)
            for part, n, *own in held:
                yield last, part, before, *(x - (1 << 64) if x >> 63 else x for x in sums), size
                weight = pow(_BASE, before, 1 << 64)
                before, sums = before + n, tuple((x + weight * y) % (1 << 64) for x, y in zip(sums, own))

        for batch in batches:
            out = []
            for conv, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if conv != last and held:
                    out += group()
                    held = []
                last = conv
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=_OFFSETS)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*group())], schema=_OFFSETS)

    return stage(parts.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(add, OFFSETS), "offsets")


_OFFSETS = pa.schema([(n, pa.int32() if k == "int" else pa.int64()) for n, k in (x.split() for x in OFFSETS.split(","))])


# ---------------------------------------------------------------- members

HEADS = "conv bigint, place bigint, sum_a bigint, sum_b bigint, n_bytes bigint"


def _heads(numbered: DataFrame, offsets: DataFrame) -> DataFrame:
    """(conv, heads): the sums up to each of a conversation's first turns."""
    first = MOD - 1
    rows = (numbered.where(F.col("at") < first).join(offsets.where(F.col("offset") < first), ["conv", "part"])
            .where(F.col("at") + F.col("offset") < first).select("conv", "offset", "at", "sum_a", "sum_b", "upto_a", "upto_b", "n_bytes"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight = _weights(_column(b, "offset"))
            yield _batch(conv=_column(b, "conv"), place=_column(b, "at") + _column(b, "offset"), sum_a=_u(b, "sum_a") + weight * _u(b, "upto_a"),
                         sum_b=_u(b, "sum_b") + weight * _u(b, "upto_b"), n_bytes=_column(b, "n_bytes"))

    return rows.mapInArrow(place, HEADS).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "sum_a", "sum_b", "n_bytes"))).alias("heads"))


def rebuilding(numbered: DataFrame, offsets: DataFrame) -> DataFrame:
    """(conv, skip, kept, n_turns, head_*, skip_*, heads): how each conversation is rebuilt.

    Of its own turns it leaves out ``skip`` (sums skip_*), before the rest it
    takes ``kept`` turns of its base (sums head_*, the turns themselves in
    ``heads``).
    """
    conv = F.col("conv")
    sizes = offsets.groupBy("conv").agg(F.max("size").alias("size"))
    convs = stage(sizes.join(_heads(numbered, offsets), "conv").select(
        "conv", "size", "heads", (F.crc32(conv.cast("string")) % MOD).cast("bigint").alias("h"), (conv - conv % GROUP).alias("base")), "conversations")
    bases = convs.select(F.col("conv").alias("base"), F.col("size").alias("base_size"), F.col("heads").alias("base_heads"))
    kept = F.least(F.col("h"), F.coalesce(F.col("base_size"), F.lit(0)))
    skip = F.least(F.col("h"), F.col("size"))
    sums = lambda heads, n, x: F.when(n > 0, F.get(heads, (n - 1).cast("int"))[x]).otherwise(F.lit(0).cast("bigint"))
    return convs.join(bases, "base", "left").select(
        "conv", "h", kept.alias("kept"), (kept + F.col("size") - skip).alias("n_turns"),
        *[sums(F.col("base_heads"), kept, f"sum_{x}").alias(f"head_{x}") for x in "ab"], *[sums(F.col("heads"), skip, f"sum_{x}").alias(f"skip_{x}") for x in "ab"],
        F.slice(F.coalesce("base_heads", F.array().cast(convs.schema["heads"].dataType)), F.lit(1), kept.cast("int")).alias("heads"))


MEMBERS = "conv bigint, depth bigint, a bigint, b bigint, up_a bigint, up_b bigint, n_bytes bigint, n_turns bigint"


def member_rows(numbered: DataFrame, offsets: DataFrame, plan: DataFrame) -> DataFrame:
    """Every rebuilt conversation's prefixes, as ``MEMBERS``: length, sums, the sums without the last turn, that turn's bytes."""
    plan = stage(plan, "rebuilding")
    own = numbered.join(offsets.join(plan.drop("heads"), "conv"), ["conv", "part"]).where(F.col("at") + F.col("offset") >= F.col("h"))

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, kept, offset = _column(b, "h"), _column(b, "kept"), _column(b, "offset")
            back = _weights(kept) * _BACK[h]
            weight = _weights(offset) * back
            out = {}
            for x, to, up in (("a", "a", "up_a"), ("b", "b", "up_b")):
                const = _u(b, f"head_{x}") + back * (_u(b, f"sum_{x}") - _u(b, f"skip_{x}"))
                out[to], out[up] = const + weight * _u(b, f"upto_{x}"), const + weight * _u(b, f"before_{x}")
            yield _batch(conv=_column(b, "conv"), depth=_column(b, "at") + offset - h + kept + 1, a=out["a"], b=out["b"], up_a=out["up_a"], up_b=out["up_b"],
                         n_bytes=_column(b, "n_bytes"), n_turns=_column(b, "n_turns"))

    zero = F.lit(0).cast("bigint")
    head = F.posexplode("heads").alias("i", "turn")
    before = lambda x: F.when(F.col("i") > 0, F.get("heads", F.col("i") - 1)[f"sum_{x}"]).otherwise(zero)
    taken = plan.select("conv", "n_turns", "heads", head).select(
        "conv", (F.col("i") + 1).cast("bigint").alias("depth"), F.col("turn.sum_a").alias("a"), F.col("turn.sum_b").alias("b"), before("a").alias("up_a"), before("b").alias("up_b"),
        F.col("turn.n_bytes").alias("n_bytes"), "n_turns")
    root = plan.select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("up_a"), zero.alias("up_b"), zero.alias("n_bytes"), "n_turns")
    return stage(own.mapInArrow(shift, MEMBERS).unionByName(taken).unionByName(root), "members")


# ---------------------------------------------------------------- nodes

PREFIX = ["depth", "a", "b"]


def trie_nodes(members: DataFrame, shard_rows: int) -> DataFrame:
    """(depth, a, b, conv, up_conv, n_convs, own_saved, light): one row per node, written."""
    nodes = stage(members.groupBy(*PREFIX).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b"),
        ((F.count("*") - 1) * F.first("n_bytes")).alias("own_saved"), (F.sum(F.col("n_turns") - F.col("depth")) <= shard_rows).alias("light")), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("up_conv"))
    return stage(nodes.join(above, ["depth", "up_a", "up_b"], "left").drop("up_a", "up_b"), "linked")


def _forward(rows: DataFrame, by: list[str] | None, most: int) -> DataFrame:
    """Time-forward processing of the rows of each shard (all rows in one stream without ``by``)."""
    dealt = rows.repartition(*by) if by else rows.coalesce(1)
    return dealt.sortWithinPartitions(F.desc("level"), "node").mapInArrow(lambda batches: forward(batches, most), rows.schema)


def _fields(level: Column, node: Column, up_level: Column, up_node: Column, top: Column, children: Column, leaves: Column, saved: Column) -> list[Column]:
    """The columns that ``forward`` works on."""
    big = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return [big(level).alias("level"), big(node).alias("node"), big(up_level).alias("up_level"), big(up_node).alias("up_node"), top.alias("top"),
            big(children).alias("children"), big(leaves).alias("leaves"), big(saved).alias("saved")]


KEPT = ["a", "b", "up_conv", "n_convs"]


def _light_totals(members: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """Light nodes with totals; the shard of a node is the light subtree it lies in, found from its conversation's path."""
    heavy = nodes.where(~F.col("light")).select(*PREFIX, F.lit(True).alias("heavy"))
    tops = (members.select("conv", *PREFIX).join(heavy, PREFIX, "left").where(F.col("heavy").isNull())
            .groupBy("conv").agg(F.min(F.struct("depth", "a", "b")).alias("t")).select("conv", F.col("t.depth").alias("top_depth"), F.col("t.a").alias("top_a"), F.col("t.b").alias("top_b")))
    zero = F.lit(0)
    rows = nodes.where("light").join(tops, "conv").select(
        *_fields(F.col("depth"), F.col("conv"), F.col("depth") - 1, F.col("up_conv"), F.col("depth") == F.col("top_depth"), zero, zero, F.col("own_saved")), *KEPT, "top_depth", "top_a", "top_b")
    return stage(_forward(rows, ["top_depth", "top_a", "top_b"], most).drop("top_depth", "top_a", "top_b"), "light")


def _messages(roots: DataFrame) -> DataFrame:
    """(node, level, got_*): what the roots of shards send to the nodes above them, summed by node."""
    return roots.groupBy(F.col("up_node").alias("node"), F.col("up_level").alias("level")).agg(
        F.count("*").alias("got_children"), F.sum("leaves").alias("got_leaves"), F.sum("saved").alias("got_saved"))


def _heavy_totals(nodes: DataFrame, light: DataFrame, piece_rows: int, most: int) -> DataFrame:
    """Heavy nodes with totals: across the roots of their pieces first, then within each piece."""
    band = F.floor(F.col("level") / piece_rows).cast("bigint")
    got = lambda x: F.coalesce(F.col(x), F.lit(0))
    heavy = nodes.where(~F.col("light")).select(*PREFIX[1:], "up_conv", "n_convs", "own_saved", F.col("depth").alias("level"), F.col("conv").alias("node"))
    top = (F.col("level") % piece_rows == 0) | (F.col("node") != F.coalesce("up_conv", F.col("node") - 1))
    heavy = stage(heavy.join(_messages(light.where("top AND level > 0")), ["node", "level"], "left").withColumn("band", band).select(
        *_fields(F.col("level"), F.col("node"), F.col("level") - 1, F.col("up_conv"), top, got("got_children"), got("got_leaves"), F.col("own_saved") + got("got_saved")), *KEPT, "band"), "heavy")
    pieces = heavy.groupBy("node", "band").agg(F.min("level").alias("level"), F.min_by("up_node", "level").alias("up_node"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    pieces = pieces.withColumn("up_band", F.floor((F.col("level") - 1) / piece_rows).cast("bigint"))
    above = pieces.select(F.col("node").alias("up_node"), F.col("band").alias("up_band"), F.col("level").alias("up_level"))
    roots = pieces.join(above, ["up_node", "up_band"], "left").select(
        *_fields(F.col("level"), F.col("node"), F.col("up_level"), F.col("up_node"), F.col("level") == 0, F.lit(1), F.col("leaves"), F.col("saved")))
    solved = _forward(roots, None, most).where("level > 0").select("leaves", "saved", "up_node", (F.col("level") - 1).alias("up_level"))
    rows = heavy.join(_messages(solved), ["node", "level"], "left").select(
        "level", "node", "up_level", "up_node", "top", (F.col("children") + got("got_children")).alias("children"), (F.col("leaves") + got("got_leaves")).alias("leaves"),
        (F.col("saved") + got("got_saved")).alias("saved"), *KEPT, "band")
    return _forward(rows, ["node", "band"], most).drop("band")


DIGESTS = "depth bigint, a bigint, b bigint, ends string"


def end_digests(members: DataFrame, blob_ids: int = BLOB_IDS) -> DataFrame:
    """(depth, a, b, ends): the digest of the ids that end at a node.

    The ids are sorted over all tasks and joined to blobs; one stream for each
    node then only digests its blobs.
    """
    order = [*PREFIX, "conv"]
    ended = members.where(F.col("depth") == F.col("n_turns")).select(*order)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [_column(batch, c) for c in order]
            new = np.append(True, np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) if batch.num_rows else np.zeros(0, bool)
            first = np.flatnonzero(new)
            first = np.unique(np.concatenate([first, *(np.arange(i, j, blob_ids) for i, j in zip(first, np.append(first[1:], batch.num_rows)))])) if len(first) else first
            ids = list(map(str, columns[3].tolist()))
            blobs = [",".join(ids[i:j]) for i, j in zip(first.tolist(), np.append(first[1:], batch.num_rows).tolist())]
            yield _batch(**{c: columns[i][first] for i, c in enumerate(order)}, blob=pa.array(blobs, pa.string()))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *own, blob in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if own == node:
                    state.update(b",")
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                state.update(blob.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*PREFIX, "ends"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, state.hexdigest())], names=[*PREFIX, "ends"])

    blobs = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "depth bigint, a bigint, b bigint, conv bigint, blob string")
    return stage(blobs, "ends").repartition(*PREFIX).sortWithinPartitions(*order).mapInArrow(digest, DIGESTS)


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", shard_rows: int = SHARD_ROWS,
                      most_held: int = 1 << 20, blob_ids: int = BLOB_IDS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    numbered = numbered_turns(turn_rows(df, conv_col, turn_col, role_col, text_col))
    offsets = turn_offsets(numbered)
    members = member_rows(numbered, offsets, rebuilding(numbered, offsets))
    nodes = trie_nodes(members, shard_rows)
    light = _light_totals(members, nodes, most_held)
    heavy = _heavy_totals(nodes, light, shard_rows, most_held)
    totals = light.unionByName(heavy).withColumnRenamed("level", "depth")
    ends = end_digests(members, blob_ids)
    return totals.join(ends, PREFIX, "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
