"""Quality rules: text statistics and cross-document line frequency, in DataFrame functions only.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed.  For
each host the operator counts the distinct documents that hold a line; equal
texts of a host count once, so copies of a document do not turn its lines into
boilerplate.  A line above the host's limit is removed from the text.  A
document that loses lines and keeps too small a share of its words, or fewer
words than the base rules ask for, is depleted and rejected.

Edge cases: a null text has no words and fails the base rules; a null host is
one host of its own, shared with the empty string; repeated rows get equal
verdicts, one row each; an empty table gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, stage

# Fixed values of the contract: white space that parts words, and symbols.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A line is boilerplate of a host if it is in more than this share of the host's distinct documents, and in this many.
MAX_DOC_SHARE = 0.05
MIN_DOCS = 20
# A document that loses lines is depleted if it keeps less than this share of its words, or fewer than MIN_WORDS.
MIN_KEPT_SHARE = 0.3

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; an empty array if there are none."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that are found twice or more."""

    def counted(ws: Column) -> Column:
        n = F.size(ws)
        hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
        return F.when(n < 4, F.lit(0)).otherwise(_let(hashes, marked))

    def marked(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated))

    def repeated(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, j: F.coalesce(F.get(ordered, j - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(ordered, j + 1)["h"] == x["h"], F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return _let(words, counted)


def _dup_lines(lines: Column) -> Column:
    held = F.filter(lines, lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0)
    return _let(held, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))


def text_statistics(df: DataFrame, text_col: str = "text", names: tuple[str, ...] = STATISTICS) -> DataFrame:
    """Add word, symbol, duplicate-line and repeated-window counts (long) under ``names``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = words_of(text)
    values = (F.size(words), F.length(F.array_join(words, "")), F.regexp_count(text, F.lit(f"[{SYMBOLS}]")),
              _dup_lines(F.split(text, "\n")), _repeat_words(words))
    return df.select("*", *[v.cast("bigint").alias(n) for v, n in zip(values, names)])


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (F.lit(100) * n_repeat_words > F.lit(MAX_REPEAT_PERCENT) * n_words)


def _host(df: DataFrame, host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit(""))


def _text_key(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def normal_line(raw: Column) -> Column:
    """A line with A-Z lower-cased and white space collapsed.

    Most lines have single spaces and many are ASCII: those go without the
    regular expression and the mapping of single characters, which cost most.
    """

    def collapsed(line: Column) -> Column:
        odd = F.contains(line, F.lit("  "))
        for c in SPACE[1:]:
            odd = odd | F.contains(line, F.lit(c))
        return F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line)

    def lowered(line: Column) -> Column:
        return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(
            F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    return _let(F.btrim(raw, F.lit(SPACE)), lambda line: _let(collapsed(line), lowered))


def line_table(df: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """(host, text_key, line): the distinct normalised lines of each distinct text of a host, by hash."""
    return (
        df.select(_host(df, host_col).alias("host"), _text_key(text_col).alias("text_key"), F.explode(F.split(text_col, "\n")).alias("raw"))
        .select("host", "text_key", normal_line(F.col("raw")).alias("line"))
        .where(F.length("line") > 0)
        .select("host", "text_key", F.unhex(F.md5(F.col("line").cast("binary"))).alias("line"))
        .distinct()
    )


def frequent_lines(df: DataFrame, text_col: str = "text", host_col: str = "source", max_doc_share: float = MAX_DOC_SHARE,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """(host, lines): the hashes (hex) of the lines above the host's limit, for hosts that have any.

    Every grouping starts from rows that are combined before their shuffle.  A
    host has at most as many such lines as its texts have on average, divided
    by the share, however many texts it has.
    """
    hosts = (df.select(_host(df, host_col).alias("host"), _text_key(text_col).alias("text_key")).distinct()
             .groupBy("host").agg(F.count("*").alias("n_docs")))
    return (
        line_table(df, text_col, host_col).groupBy("host", "line").agg(F.count("*").alias("n_texts")).where(F.col("n_texts") >= min_docs)
        .join(hosts, "host").where(F.col("n_texts") > F.lit(Decimal(str(max_doc_share))) * F.col("n_docs"))
        .groupBy("host").agg(F.collect_list(F.lower(F.hex("line"))).alias("lines"))
    )


def without_lines(text: Column, frequent: Column) -> Column:
    """(text, n, n_removed): the text without its frequent lines, and the words of its distinct lines, all and removed ones; null if it has none."""

    def keyed(raw: Column) -> Column:
        return _let(normal_line(raw), lambda line: F.struct(
            raw.alias("raw"), F.md5(line.cast("binary")).alias("key"),
            F.when(F.length(line) > 0, F.length(line) - F.length(_without(line, " ")) + 1).otherwise(0).alias("n")))

    def cut(lines: Column, hits: Column) -> Column:
        distinct = F.array_distinct(F.transform(lines, lambda x: F.struct(x["key"].alias("key"), x["n"].alias("n"))))
        total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda sum_, x: sum_ + x["n"])
        left = F.filter(lines, lambda x: ~F.array_contains(hits, x["key"]))
        return F.struct(F.array_join(F.transform(left, lambda x: x["raw"]), "\n").alias("text"), total(distinct).alias("n"),
                        total(F.filter(distinct, lambda x: F.array_contains(hits, x["key"]))).alias("n_removed"))

    def found(lines: Column) -> Column:
        hits = F.array_intersect(F.transform(lines, lambda x: x["key"]), frequent)
        return _let(hits, lambda h: F.when(F.size(h) > 0, cut(lines, h)))

    return F.when(frequent.isNotNull() & text.isNotNull(), _let(F.transform(F.split(text, "\n"), keyed), found))


def quality_rules(df: DataFrame, text_col: str = "text", host_col: str = "source", max_doc_share: float = MAX_DOC_SHARE,
                  min_docs: int = MIN_DOCS, min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """``df``, its texts without the lines above their host's limit, plus the statistics, ``base_failed`` and ``kept``.

    The statistics are those of the whole text.  New columns get leading
    underscores if they clash.  The frequent lines are written first, so their
    measured size decides whether the join sends them to all executors or
    shuffles both sides.
    """
    frequent = stage(frequent_lines(df, text_col, host_col, max_doc_share, min_docs), "frequent")
    names = fresh(df.columns, *STATISTICS, "base_failed", "kept", "host_key", "cut")
    own, (failed, kept, host, cut) = tuple(names[:5]), names[5:]
    out = df.select("*", _host(df, host_col).alias(host)).join(frequent.select(F.col("host").alias(host), F.col("lines").alias(cut)), host, "left")
    out = text_statistics(out, text_col, own).withColumn(cut, without_lines(F.col(text_col), F.col(cut)))
    fails = base_failed(F.col(own[0]), F.col(own[4]))
    n, removed = F.col(cut)["n"], F.col(cut)["n_removed"]
    depleted = F.coalesce((removed > 0) & ((n - removed < F.lit(Decimal(str(min_kept_share))) * n) | (n - removed < MIN_WORDS)), F.lit(False))
    columns = [F.coalesce(F.col(cut)["text"], F.col(c)).alias(c) if c == text_col else F.col(c) for c in df.columns]
    return out.select(*columns, *own, fails.alias(failed), (~fails & ~depleted).alias(kept))


def keep_good(df: DataFrame, text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The documents of ``df`` that pass, with their own columns, less the lines above their host's limit."""
    out = quality_rules(df, text_col, host_col, **limits)
    return out.where(F.col(out.columns[-1])).select(*df.columns)
