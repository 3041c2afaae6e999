"""Token counts per document from the counts of distinct pre-tokens.

A byte-level BPE never merges across pre-tokens, so a document's count is the
sum over its pre-tokens.  The corpus vocabulary of pre-tokens is gathered with
its frequencies, each distinct pre-token is tokenised once, and the counts are
joined to the documents' pre-token frequencies.  The most frequent pre-tokens
(a bounded number) are looked up inside the tasks; every other pre-token goes
through a shuffled join, where none can be hot.  No ids are kept.

Edge cases: a null or empty text has no tokens; repeated rows and repeated ids
give one row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import tokens
from strata.llm.common import fresh, stage, with_row_id

# Pre-tokens that are looked up in the tasks: about 4 MB as a broadcast, whatever the corpus.
HEAD_SIZE = 100_000
# Distinct pre-tokens that a task holds before it hands on what it has counted.
MOST_HELD = 200_000
# Longer pre-tokens are counted in place: they would make wide rows for nothing, as they hardly repeat.
LONGEST = 64


def _texts(batch: pa.RecordBatch, where: int) -> list[str]:
    return [t or "" for t in batch.column(where).to_pylist()]


def vocabulary(df: DataFrame, text_col: str, path: str | None = None) -> DataFrame:
    """(pre_token, frequency, n_pieces) of every distinct pre-token of up to ``LONGEST`` characters."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held = tokens.splitter(path), Counter()

        def out() -> pa.RecordBatch:
            kept = {k: n for k, n in held.items() if len(k) <= LONGEST}
            return pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], names=["pre_token", "n"])

        for batch in batches:
            for text in _texts(batch, 0):
                held.update(split(text))
                if len(held) > MOST_HELD:
                    yield out()
                    held.clear()
        yield out()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = tokens.counter(path)
        for batch in batches:
            n = pieces(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=["pre_token", "frequency", "n_pieces"])

    each = df.select(text_col).mapInArrow(gather, "pre_token string, n bigint")
    return (each.groupBy("pre_token").agg(F.sum("n").alias("frequency"))
            .mapInArrow(count, "pre_token string, frequency bigint, n_pieces bigint"))


def _head(words: DataFrame, most: int) -> dict[str, int]:
    """Counts of the most frequent pre-tokens: all above the least step of frequency that at most ``most`` of them reach."""
    step = F.floor(F.log2("frequency") * 8).cast("int")
    held, least = 0, None
    for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        held += r["n"]
        if held > most:
            break
        least = r["step"]
    if least is None:
        return {}
    top = words.where(step >= least).select("pre_token", "n_pieces").toArrow()
    return dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist()))


def count_tokens(df: DataFrame, text_col: str = "text", path: str | None = None, head_size: int = HEAD_SIZE) -> DataFrame:
    """``df`` without its text, plus ``n_bytes`` (UTF-8) and ``n_tokens`` (renamed with underscores if they clash)."""
    spark = df.sparkSession
    keep = [c for c in df.columns if c != text_col]
    row, n_bytes, n_tokens, tail = fresh(keep, "row", "n_bytes", "n_tokens", "tail")
    words = stage(vocabulary(df, text_col, path), "vocabulary")
    shared = spark.sparkContext.broadcast(_head(words, head_size))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(row, T.LongType()), T.StructField(n_bytes, T.LongType()), T.StructField(n_tokens, T.LongType()),
                           T.StructField(tail, T.ArrayType(T.StructType([T.StructField("pre_token", T.StringType()), T.StructField("n", T.IntegerType())])))])
    entry = pa.list_(pa.struct([("pre_token", pa.string()), ("n", pa.int32())]))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces, head = tokens.splitter(path), tokens.counter(path), shared.value
        for batch in batches:
            sizes, sums, tails = [], [], []
            for text in _texts(batch, len(keep) + 1):
                total, rare = 0, []
                for pre_token, n in Counter(split(text)).items():
                    known = head.get(pre_token)
                    if known is not None:
                        total += n * known
                    elif len(pre_token) > LONGEST:
                        total += n * pieces([pre_token])[0]
                    else:
                        rare.append({"pre_token": pre_token, "n": n})
                sizes.append(len(text.encode()))
                sums.append(total)
                tails.append(rare)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(tails, entry)],
                                             names=[*keep, row, n_bytes, n_tokens, tail])

    found = stage(with_row_id(df.select(*keep, text_col), row).select(*keep, row, text_col).mapInArrow(frequencies, schema), "frequencies")
    rare = (found.select(row, F.explode(tail).alias("t")).select(row, F.col("t.pre_token").alias("pre_token"), F.col("t.n").alias("n"))
            .join(words.select("pre_token", "n_pieces"), "pre_token")
            .groupBy(row).agg(F.sum(F.col("n") * F.col("n_pieces")).alias(tail)))
    return found.drop(tail).join(rare, row, "left").select(*keep, n_bytes, (F.col(n_tokens) + F.coalesce(F.col(tail), F.lit(0))).alias(n_tokens))
