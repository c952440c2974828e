"""License notices by a positional index of rare words, in DataFrame operations only.

Templates are short notices with a label and a key phrase. Document counts over the whole table
give every template word its inverse document frequency. The index holds the rarest words of each
template and all words of its key phrase, with their positions. A file is looked up if it
contains the rarest word of some key phrase; every place of an indexed word then votes for
``(template, place - position)``. A shift at which all words of the key phrase and half of the
indexed words meet is a finding.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm.common import stored


@dataclass(frozen=True)
class Template:
    """``phrase`` stands within ``text``; both are lower-case words with single spaces."""

    label: str
    text: str
    phrase: str
    base: bool = False


#: Fixed phrases and labels of the base.
BASE = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
)

#: Openings of well-known public notices.
NOTICES = (
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by", "a creative commons attribution 4 0 international license", "creative commons attribution"),
    Template("cc0", "creative commons cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)

#: Rarest words of a template that the index holds beside its key phrase.
RARE = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything between words: ASCII but digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; a null text has none."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(plain, _BETWEEN), lambda w: w != "")


def _document_counts(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word stands; as many numbers as words are asked for."""
    asked = F.array(*[F.lit(w) for w in vocabulary])
    found = texts.select(F.explode(F.array_intersect(asked, "words")).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in found.collect()}


def _index(spark: SparkSession, templates: tuple[Template, ...], counts: dict[str, int]) -> tuple[DataFrame, list[str], list[str]]:
    """Postings, all words in them, and the rarest word of each key phrase."""
    rows, words, leads = [], set(), set()
    for k, t in enumerate(templates):
        text, phrase = t.text.split(), t.phrase.split()
        at = next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)
        key = range(at, at + len(phrase))
        # inverse document frequency falls with the count
        rare = sorted(range(len(text)), key=lambda i: (counts.get(text[i], 0), i))[:RARE]
        for i in sorted({*rare, *key}):
            rows.append((text[i], k, i, int(i in key)))
            words.add(text[i])
        leads.add(min(phrase, key=lambda w: (counts.get(w, 0), w)))
    structs = [
        F.struct(F.lit(w).alias("word"), F.lit(k).alias("template"), F.lit(i).alias("position"), F.lit(m).alias("mandatory"))
        for w, k, i, m in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs))), sorted(words), sorted(leads)


def license_notices(docs: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES) -> DataFrame:
    """``(row, n_words, findings)`` for each row of ``docs``.

    ``findings`` holds one ``(template, label, base, place, score)`` for each place where a
    template stands: the template's number, the word from which it begins (from 0, counted at
    its key phrase for notices that lack their first words) and the share of its indexed words.
    Places of base templates are all places where the phrase's words stand consecutively.

    A null or empty text has no word and no finding. Repeated rows and copies of a text are
    looked up once and get the same findings. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), words_of(F.col("text")).alias("words")
    )
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    postings, words, leads = _index(spark, templates, _document_counts(texts, vocabulary))

    lead = F.arrays_overlap(F.col("words"), F.array(*[F.lit(w) for w in leads]))
    indexed = F.array(*[F.lit(w) for w in words])
    spots = F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("place"))),
        lambda s: F.array_contains(indexed, s["word"]),
    )
    looked = stored(
        texts.select("row", F.size("words").cast("long").alias("n_words"), F.when(lead, spots).alias("spots"))
        # what is found depends on nothing but the spots
        .withColumn("key", F.when(F.col("spots").isNotNull(), F.sha2(F.to_json("spots"), 256))),
        "spots",
    )
    sizes = postings.groupBy("template").agg(F.count("*").alias("size"), F.sum("mandatory").alias("needed"))
    labels = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("template"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
                        F.lit(next(i for i in range(len(t.text.split())) if t.text.split()[i:][: len(t.phrase.split())] == t.phrase.split())).alias("at"),
                    )
                    for k, t in enumerate(templates)
                ]
            )
        )
    )
    findings = (
        looked.filter("spots is not null")
        .dropDuplicates(["key"])
        .select("key", F.explode("spots").alias("spot"))
        .select("key", F.col("spot.word").alias("word"), F.col("spot.place").alias("place"))
        # both sides are as large as the templates
        .join(F.broadcast(postings), "word")
        .groupBy("key", "template", (F.col("place") - F.col("position")).alias("shift"))
        .agg(F.count("*").alias("met"), F.sum("mandatory").alias("mandatory"))
        .join(F.broadcast(sizes.join(labels, "template")), "template")
        .filter((F.col("mandatory") == F.col("needed")) & (2 * F.col("met") >= F.col("size")))
        .groupBy("key")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "template",
                        "label",
                        "base",
                        F.greatest("shift", F.lit(0)).cast("long").alias("place"),
                        (F.col("met") / F.col("size")).alias("score"),
                    )
                )
            ).alias("findings")
        )
    )
    some = (
        looked.filter("spots is not null")
        .join(findings, "key", "left")
        .select("row", "n_words", F.coalesce("findings", F.array().cast(findings.schema["findings"].dataType)).alias("findings"))
    )
    none = looked.filter("spots is null").select(
        "row", "n_words", F.array().cast(findings.schema["findings"].dataType).alias("findings")
    )
    return none.unionByName(some)


def digest(found: DataFrame) -> DataFrame:
    """``(row, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of the findings."""
    base = F.filter("findings", lambda f: f["base"])
    joined = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")
    places = F.transform(base, lambda f: f["place"])
    return found.select(
        "row",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("findings")).alias("labels"),
        F.coalesce(F.array_max(F.transform("findings", lambda f: f["score"])), F.lit(0.0)).alias("score"),
    )
