"""License scan by diagonal voting.

All rolling word k-grams of a text are joined, by their hash, to the places of the same
k-grams in short templates. A hit votes for the diagonal "place in the text less place in
the template": a passage that repeats a template puts its votes on one diagonal, a
passage with words put in or left out on neighbouring ones. Votes are summed by diagonal,
neighbouring diagonals merged, and a span is accepted when the hits cover enough of the
template and all of its telling words. A hash only finds its partner; the k-grams
themselves are compared too, so what is covered agrees word by word.

Built-in functions only. Templates are a list of the caller, so the number of their
k-grams is known: up to ``SMALL`` they are broadcast and only hits are shuffled; more
join by shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catloom.functions.binding import bind
from catloom.llm.common import ascii_lower, keep

#: Words of a k-gram, diagonals that merge, and the share of a template that a span covers.
K, NEAR, COVER = 3, 4, 0.8
#: k-grams of templates that may be broadcast, some hundred bytes each.
SMALL = 50_000
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence text in lower-case words, at least ``K``.

    A ``whole`` template must be found word for word; of others a part does that
    holds the ``telling`` words.
    """

    label: str
    text: str
    telling: str = ""
    whole: bool = False


# Sentences by which texts state a licence, and the words that tell which.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "granted copy"),
    Template("mit", "released under the mit license", "mit"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "gnu public"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "gnu public"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative noncommercial"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc nc"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def license_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def template_grams(spark, templates: tuple[Template, ...]) -> DataFrame:
    """template, label, size, telling (places), whole, t (place), gram of every k-gram."""
    rows = []
    for number, t in enumerate(templates):
        words = t.text.split()
        if len(words) < K:
            raise ValueError(f"a template needs {K} words: {t.text!r}")
        telling = [i for i, w in enumerate(words) if w in t.telling.split()]
        rows += [(number, t.label, len(words), telling, t.whole, i, " ".join(words[i : i + K])) for i in range(len(words) - K + 1)]
    return spark.createDataFrame(rows, "template int, label string, size int, telling array<int>, whole boolean, t int, gram string")


def row_key(doc_id: Column, text: Column) -> Column:
    """Key of an id and its text; repeated rows have one key and one result."""
    return F.unhex(F.md5(F.concat_ws("\n", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))))


def hits(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """_doc, p (place of a k-gram in the text) and the columns of ``template_grams``."""
    read = bind(docs.select(row_key(F.col("doc_id"), F.col("text")).alias("_doc"), "text"), words=license_words(F.col("text")))

    def gram(i: Column) -> Column:
        return F.array_join(F.slice("words", i, F.lit(K)), " ")

    places = F.sequence(F.lit(1), F.size("words") - (K - 1))
    grams = read.where(F.size("words") >= K).select("_doc", F.posexplode(F.transform(places, gram)).alias("p", "_gram"))
    hashed = grams.withColumn("_hash", F.xxhash64("_gram"))
    known = template_grams(docs.sparkSession, templates).withColumn("hash", F.xxhash64("gram"))
    if sum(len(t.text.split()) for t in templates) <= SMALL:
        known = F.broadcast(known)
    met = hashed.join(known, (F.col("_hash") == F.col("hash")) & (F.col("_gram") == F.col("gram")))
    return met.drop("_hash", "_gram", "hash", "gram")


def votes(found: DataFrame) -> DataFrame:
    """Hits by text, template and diagonal: ``at`` holds the template places, so it is no longer than the template."""
    per = ("_doc", "template", "label", "size", "telling", "whole")
    return found.groupBy(*per, (F.col("p") - F.col("t")).alias("diagonal")).agg(F.collect_set("t").alias("at"))


def merged(voted: DataFrame) -> DataFrame:
    """For each diagonal, what it and its next ``NEAR`` neighbours cover of the template.

    ``start`` and ``end`` (after the last word) in the text, ``covered`` the share of the
    template's words, ``accepted`` if the span verifies. A whole template stands on one diagonal.
    """
    near = W.partitionBy("_doc", "template").orderBy("diagonal").rangeBetween(0, NEAR)
    votes_here = F.struct("diagonal", "at")
    frame = F.when(F.col("whole"), F.array(votes_here)).otherwise(F.collect_list(votes_here).over(near))
    spans = voted.withColumn("_frame", frame)
    words = F.array_distinct(F.flatten(F.transform("_frame", lambda v: F.flatten(F.transform(v["at"], lambda t: F.sequence(t, t + (K - 1)))))))
    spans = bind(
        spans,
        _words=words,
        start=F.array_min(F.transform("_frame", lambda v: v["diagonal"] + F.array_min(v["at"]))),
        end=F.array_max(F.transform("_frame", lambda v: v["diagonal"] + F.array_max(v["at"]))) + K,
    ).withColumn("covered", F.size("_words") / F.col("size"))
    told = F.size(F.array_except("telling", "_words")) == 0
    verified = F.when(F.col("whole"), F.col("covered") == 1).otherwise((F.col("covered") >= COVER) & told)
    return spans.withColumn("accepted", verified).drop("_frame", "_words", "at")


def license_spans(docs: DataFrame, templates: tuple[Template, ...] = NOTICES) -> DataFrame:
    """doc_id, template, label, start, end, covered of every place where a template stands.

    Places of words from 0, ``end`` excluded. Overlapping spans of one template are one,
    except of whole templates, each of whose places counts. Repeated rows report once.
    Null and empty texts have none.
    """
    spans = merged(votes(hits(docs, templates))).where("accepted")
    ordered = W.partitionBy("_doc", "template").orderBy("start", "diagonal")
    before = F.max("end").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("whole") | before.isNull() | (F.col("start") >= before), 1).otherwise(0)
    places = spans.withColumn("_opens", opens).withColumn("_place", F.sum("_opens").over(ordered))
    joined = places.groupBy("_doc", "template", "label", "_place").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("covered").alias("covered")
    )
    ids = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("_doc")).distinct()
    return joined.join(ids, "_doc").select("doc_id", "template", "label", "start", "end", "covered")


def scan_licenses(docs: DataFrame, phrases: tuple[Template, ...], notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``phrases`` are whole templates: ``n_base`` counts their places, the smallest and
    largest start follow, null if there is none. ``labels`` adds those of accepted
    notices. ``score`` is the greatest share of any template that the text covers. Null
    and empty texts have no words, no labels and score 0; repeated rows each get the row
    of their text; other columns of ``docs`` are not read.
    """
    phrases = tuple(Template(t.label, t.text, whole=True) for t in phrases)
    spans = merged(votes(hits(docs, (*phrases, *notices))))
    base = F.col("whole") & F.col("accepted")

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    found = spans.groupBy("_doc").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("accepted"), F.col("label"))).alias("labels"),
        F.max("covered").alias("score"),
    )
    found = keep(found, "license-texts")
    rows = docs.select(
        "doc_id",
        row_key(F.col("doc_id"), F.col("text")).alias("_doc"),
        F.size(license_words(F.col("text"))).cast("long").alias("n_words"),
    )
    return rows.join(found, "_doc", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
