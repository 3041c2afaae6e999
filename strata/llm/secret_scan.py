"""Secret scan: rule spans, and corpus-wide ownership of every candidate value, in DataFrame functions only.

Three rules give base spans.  Besides, any long run of credential characters
with a digit and a letter is a candidate, whether a rule's match holds it or
not.  Values are hashed and aggregated over the corpus by distinct
repositories and owners.  A repository is a distinct text, of the first of its
owners: copies of a document, within a source or across sources, are one.  A
value that more than a few owners or many texts hold is a widely copied
example; any other is live-looking.  A candidate that is live-looking adds a
span of kind ``live`` around the value itself; base spans always stay and are
counted as live or copied.

Spans are in code points, end exclusive, of whole matches.  Edge cases: a null
text has no spans; a null owner is one owner of its own; repeated rows give one
result row each and are one repository; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, stage, with_row_id

# Fixed values of the contract, in the order that breaks ties between kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE_LENGTH = 6
KINDS = ("assign", "access", "hex", "live")

# A candidate of the method: a run of credential characters with a digit and a letter.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# A value is live-looking if at most so many owners hold it in at most so many distinct texts: a near copy of a document
# in a second source, or a key used in a few documents, is no spread; beyond either it is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 9


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _running(lengths: Column) -> Column:
    """Inclusive running sums of an array, by doubling steps: n log n additions for n entries."""
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths) + 1)).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.aggregate(steps, lengths, lambda sums, d: F.transform(sums, lambda x, i: x + F.when(i >= d, F.get(sums, i - d)).otherwise(F.lit(0))))


def matches(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost non-overlapping matches as (start, kind, end, value): the text's split gives the gaps before them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(pair: Column) -> Column:
        lengths = F.transform(pair["found"], lambda m, i: F.length(m) + F.length(F.get(pair["gaps"], i)))
        return _let(F.struct(pair["found"].alias("found"), _running(lengths).alias("ends")), spans)

    def spans(pair: Column) -> Column:
        return F.transform(pair["found"], lambda m, i: F.struct(
            (F.get(pair["ends"], i) - F.length(m)).alias("start"), F.lit(kind).alias("kind"), F.get(pair["ends"], i).alias("end"), m.alias("value")))

    none = F.array().cast("array<struct<start: int, kind: int, end: int, value: string>>")
    return F.when(text.rlike(pattern), _let(F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps")), placed)).otherwise(none)


def base_spans(text: Column) -> Column:
    """The rules' spans by start, then kind.  An assignment's value is its second group; short ones are dropped after matching."""
    value = lambda m: F.regexp_extract(m, ASSIGN, 2)
    assigned = F.transform(
        F.filter(matches(text, ASSIGN, 0), lambda s: F.length(value(s["value"])) >= ASSIGN_VALUE_LENGTH),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), value(s["value"]).alias("value")))
    return F.array_sort(F.concat(assigned, matches(text, ACCESS, 1), matches(text, HEX, 2)))


def candidate_spans(text: Column) -> Column:
    """Long runs that may be credentials, whatever stands before them."""
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    return F.filter(matches(text, CANDIDATE, 3), mixed)


def written(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, n_repositories, n_owners) of rows (value_hash, owner, repository).

    Three levels of grouping, each combined before its shuffle, so a value
    that a third of all rows hold is spread until only counts are left.
    """
    return (
        candidates.groupBy("value_hash", "repository").agg(F.min("owner").alias("owner"))
        .groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
        .groupBy("value_hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))
    )


def scan_secrets(df: DataFrame, text_col: str = "text", owner_col: str = "source", repository_col: str | None = None,
                 max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``df`` without its text, plus ``base`` and ``spans`` (arrays of start, kind, end, value, n_repositories, n_owners, live).

    The text is read once: the spans of every row are written first, and the
    rest works on them.  A repository is a distinct text, or a value of
    ``repository_col``.  Columns of ``df`` that clash keep their names; the new
    ones get leading underscores.
    """
    keep = [c for c in df.columns if c != text_col]
    row, owner, repository, base, more, spans = fresh(keep, "row", "owner", "repository", "base", "candidates", "spans")
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    place = named(repository_col) if repository_col else F.md5(text.cast("binary"))
    found = stage(with_row_id(df, row).select(*keep, row, named(owner_col).alias(owner), place.alias(repository),
                                              base_spans(text).alias(base), candidate_spans(text).alias(more)), "secrets")
    entry = F.explode(F.concat(base, more)).alias("s")
    each = found.where(F.size(base) + F.size(more) > 0).select(row, F.col(owner).alias("owner"), F.col(repository).alias("repository"), entry)
    each = each.withColumn("value_hash", F.unhex(F.sha2(F.col("s.value").cast("binary"), 256)))
    owned = ownership(each.select("value_hash", "owner", "repository"))
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    judged = (
        each.join(owned, "value_hash").where((F.col("s.kind") < 3) | live)
        .groupBy(row).agg(F.array_sort(F.collect_list(F.struct(
            "s.start", "s.kind", "s.end", "s.value", "n_repositories", "n_owners", live.alias("live")))).alias(spans))
    )
    return found.join(judged, row, "left").select(*keep, base, F.coalesce(spans, F.array().cast(judged.schema[spans].dataType)).alias(spans))
