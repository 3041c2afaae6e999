"""Licence scan by a positional index of rare words, in DataFrame functions only.

Templates are short licence statements; each has a mandatory key phrase.  The
corpus gives every licence word its document frequency.  A file that holds all
words of some key phrase keeps the positions of its licence words; of each
such template the words of highest inverse document frequency are looked up,
and a position of the file less the word's place in the template proposes
where the template begins.  Proposals of a template's rare words are
intersected by that relative position, and a survivor stands if every word of
the key phrase is found at its place.  The score of a place is the share of
the template's words at their places; a document's score is its best one.

A rare word that occurs twice in its template proposes a place for each, so
no place of a key phrase is missed: whichever words are looked up, all of them
are in the phrase.

Edge cases: a null or empty text has no words and no label, score 0; repeated
rows get a result row each; columns of the input that clash keep their names
and the new ones get leading underscores; an empty table gives an empty
result.  A text of any length costs its own length: no step pairs positions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, stage


class Template(NamedTuple):
    """A licence statement: its label, its words, and the place and length of its key phrase."""

    label: str
    words: tuple[str, ...]
    key_at: int
    key_size: int
    base: bool = False


def _template(label: str, statement: str, key: str, base: bool = False) -> Template:
    words, wanted = tuple(statement.split()), tuple(key.split())
    at = next(i for i in range(len(words)) if words[i:i + len(wanted)] == wanted)
    return Template(label, words, at, len(wanted), base)


# Fixed values of the contract: phrases and labels.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Statements of the method, by label: the statement, and its mandatory key phrase.
STATEMENTS = (
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("apache-2", "http www apache org licenses license 2 0", "apache org licenses license 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", "commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)

TEMPLATES: tuple[Template, ...] = (
    *(_template(label, phrase, phrase, True) for phrase, label in BASE_PHRASES),
    *(_template(*entry) for entry in STATEMENTS),
)

# Words of a key phrase that are looked up, those of highest inverse document frequency.
N_RARE = 2

# A word is a run of anything but ASCII characters other than letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_words(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; the one other letter whose lower case is an ASCII letter (Kelvin) stays a letter of its own."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("K"), F.lit("ĸ"))), SEPARATORS), "")


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def postings(df: DataFrame, text_col: str, row: str, n_words: str, held: str, places: str, templates: Sequence[Template]) -> DataFrame:
    """``df`` without its text, plus a row id, the number of words, the distinct licence words, and their (word, place) where a key phrase may be.

    The one pass over the texts.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    keys = [_strings(sorted(set(t.words[t.key_at:t.key_at + t.key_size]))) for t in templates]
    keep = [c for c in df.columns if c != text_col]

    def of(words: Column) -> Column:
        return _let(F.array_intersect(words, _strings(vocabulary)), lambda found: F.struct(
            F.size(words).cast("bigint").alias("n"), found.alias("held"), F.when(_any([_all_in(k, found) for k in keys]), _placed_words(words, found)).alias("places")))

    scanned = df.select(*keep, F.monotonically_increasing_id().alias(row), _let(lower_words(F.coalesce(F.col(text_col), F.lit(""))), of).alias(held))
    return scanned.select(*keep, row, F.col(held)["n"].alias(n_words), F.col(held)["places"].alias(places), F.col(held)["held"].alias(held))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _all_in(wanted: Column, found: Column) -> Column:
    return F.size(F.array_except(wanted, found)) == 0


def _placed_words(words: Column, found: Column) -> Column:
    entries = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("place")))
    return F.filter(entries, lambda e: F.array_contains(found, e["word"]))


def inverse_frequencies(scanned: DataFrame, held: str) -> dict[str, float]:
    """Every licence word's inverse document frequency over all documents: as many entries as there are licence words."""
    counts = scanned.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    total = scanned.count()
    return {r.word: math.log((total + 1) / r.n) for r in counts}


def template_rows(spark, idf: dict[str, float], templates: Sequence[Template], n_rare: int) -> DataFrame:
    """(template, label, base, size, key_size, word, at, key, rare): one row per template word, the index of the templates."""
    rows = []
    for number, t in enumerate(templates):
        key = range(t.key_at, t.key_at + t.key_size)
        rarest = sorted({t.words[i] for i in key}, key=lambda w: (-idf.get(w, 0.0), w))[:n_rare]
        rows += [(number, t.label, t.base, len(t.words), t.key_at, w, i, i in key, i in key and w in rarest) for i, w in enumerate(t.words)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, size int, key_at int, word string, at int, key boolean, rare boolean")


def find_places(scanned: DataFrame, row: str, places: str, index: DataFrame) -> DataFrame:
    """(row, template, label, base, start, score): every verified place of a key phrase; ``start`` is its first word, from 0.

    The rare words propose (template, begin); proposals that the template's
    rare words agree on are joined with the file's words at the template's
    places.  Each step is keyed by row and place, so a file or a text that a
    third of all rows share spreads over the tasks.
    """
    words = scanned.where(F.col(places).isNotNull()).select(F.col(row).alias("row"), F.explode(places).alias("e")).select("row", "e.word", "e.place")
    rare = index.where("rare")
    wanted = rare.groupBy("template").agg(F.count("*").alias("wanted"))
    proposals = (words.join(F.broadcast(rare), "word").select("row", "template", (F.col("place") - F.col("at")).alias("begin"))
                 .groupBy("row", "template", "begin").agg(F.count("*").alias("n"))
                 .join(F.broadcast(wanted), "template").where(F.col("n") == F.col("wanted")).select("row", "template", "begin"))
    expected = (proposals.join(F.broadcast(index), "template")
                .select("row", "template", "begin", "label", "base", "size", "key_at", "key", "word", (F.col("begin") + F.col("at")).alias("place")))
    matched = expected.join(words.withColumnRenamed("word", "found"), ["row", "place"], "left")
    same = F.coalesce(F.col("word") == F.col("found"), F.lit(False))
    return (matched.groupBy("row", "template", "begin")
            .agg(F.first("label").alias("label"), F.first("base").alias("base"), F.first("size").alias("size"), F.first("key_at").alias("key_at"),
                 F.min(~F.col("key") | same).alias("whole"), F.count(F.when(same, 1)).alias("n"))
            .where("whole").select("row", "template", "label", "base", (F.col("begin") + F.col("key_at")).cast("bigint").alias("start"),
                                   (F.col("n") / F.col("size")).alias("score")))


RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan_licenses(df: DataFrame, text_col: str = "text", templates: Sequence[Template] = TEMPLATES, n_rare: int = N_RARE) -> DataFrame:
    """``df`` without its text, plus n_words, n_base, first_word, last_word, base_labels, labels, score."""
    keep = [c for c in df.columns if c != text_col]
    row, held, places, *names = fresh(keep, "row", "held", "places", *RESULT)
    scanned = stage(postings(df, text_col, row, names[0], held, places, templates), "licence-words")
    index = template_rows(df.sparkSession, inverse_frequencies(scanned, held), templates, n_rare)
    found = find_places(scanned, row, places, index)
    own = F.when(F.col("base"), F.col("start"))
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    # Labels and templates are few, so what is gathered by document is bounded; places are only counted.
    by_row = found.groupBy(F.col("row").alias(row)).agg(
        F.count(own).alias(names[1]), F.min(own).alias(names[2]), F.max(own).alias(names[3]),
        joined(F.collect_set(F.when(F.col("base"), F.col("label")))).alias(names[4]), joined(F.collect_set("label")).alias(names[5]), F.max("score").alias(names[6]))
    filled = {names[1]: F.lit(0).cast("bigint"), names[4]: F.lit(""), names[5]: F.lit(""), names[6]: F.lit(0.0)}
    out = scanned.drop(held, places).join(by_row, row, "left")
    return out.select(*keep, *[F.coalesce(F.col(n), filled[n]).alias(n) if n in filled else F.col(n) for n in names])
