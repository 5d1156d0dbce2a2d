"""License scans by diagonal voting, in DataFrame operations only.

The hashes of all rolling word k-grams of a document are joined with the positions of
the same k-grams in license templates; positions whose hash no template has are dropped
before the rows leave the document's array.  A match of document word i with template
word j votes for diagonal i - j; votes are summed per document, template and
diagonal.  Neighbouring diagonals (a word more or less in between) are merged,
and the merged span is verified: enough different template k-grams, in a span
of the template's length.

Long templates vote by ``GRAM`` words.  Short ones vote by two, since one word put inside
them would break most of their longer k-grams.  A base phrase is one k-gram:
its votes are exact places.

A task holds the words of a text as an array: some 50 bytes a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfscan.llm.common import LOWER, UPPER, cut, prepare, row_key

GRAM = 3
SHORT_GRAM = 2
SHORT = 10          # statements of at most so many words vote by SHORT_GRAM
COVERAGE = 0.8      # share of a template's k-grams that a span must hold
SHORT_COVERAGE = 0.75
DRIFT = 2           # diagonals this near are merged
STRETCH = 3         # words a span may have beyond its template
# Characters outside words, after A-Z became a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Statements that name a license; labels after SPDX where it has one.
STATEMENTS = {
    "cc-by-4.0": ("licensed under cc by 4 0", "this work is licensed under a creative commons "
                  "attribution 4 0 international license"),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", "this work is licensed under a creative "
                     "commons attribution noncommercial 4 0 international license"),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", "this work is licensed under a creative "
                     "commons attribution sharealike 4 0 international license"),
    "apache-2.0": ("licensed under the apache license version 2 0",),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3",),
    "gpl-2.0": ("this work is licensed under the gnu general public license version 2",),
    "mit": ("released under the mit license", "licensed under the mit license"),
    "bsd-3-clause": ("licensed under the bsd 3 clause license",),
    "mpl-2.0": ("subject to the terms of the mozilla public license version 2 0",),
}
# The notices of public licenses, as their words.
NOTICES = {
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction "
            "including without limitation the rights to use copy modify merge publish distribute "
            "sublicense and or sell copies of the software",),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without "
            "fee is hereby granted provided that the above copyright notice and this permission notice "
            "appear in all copies",),
    "bsd-2-clause": ("redistribution and use in source and binary forms with or without modification are "
                     "permitted provided that the following conditions are met",),
    "apache-2.0": ("you may not use this file except in compliance with the license you may obtain a copy "
                   "of the license at http www apache org licenses license 2 0",),
    "gpl-3.0": ("this program is free software you can redistribute it and or modify it under the terms of "
                "the gnu general public license as published by the free software foundation either "
                "version 3 of the license or at your option any later version",),
    "mpl-2.0": ("if a copy of the mpl was not distributed with this file you can obtain one at http "
                "mozilla org mpl 2 0",),
}


def templates(base: dict[str, str] = BASE, statements: dict[str, tuple] = STATEMENTS,
              notices: dict[str, tuple] = NOTICES) -> list[tuple[str, str, bool, int]]:
    """(words, label, is it a base phrase, words of its k-grams) of every template."""
    out = [(p, label, True, len(p.split())) for p, label in sorted(base.items())]
    for group in (statements, notices):
        out += [(p, label, False, SHORT_GRAM if len(p.split()) <= SHORT else GRAM)
                for label, ps in sorted(group.items()) for p in ps]
    return out


def word_array(text: Column) -> Column:
    """Words of a text (null: none), A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, GAP), "")


def gram_text(words: Column, at: Column, k: int) -> Column:
    """The ``k`` words from position ``at`` on (empty ones past the end)."""
    return F.concat_ws(" ", *[F.coalesce(F.get(words, at + j), F.lit("")) for j in range(k)])


def gram_hash(words: Column, at: Column, k: int) -> Column:
    """Hash of the ``k`` words from position ``at`` on."""
    return F.xxhash64(F.lit(k), *[F.coalesce(F.get(words, at + j), F.lit("")) for j in range(k)])


def template_table(spark: SparkSession, texts: list[tuple[str, str, bool, int]]) -> DataFrame:
    """One row per template position: ``tid, label, is_base, words, k, n_grams, tpos, hash, tgram``."""
    rows = []
    for tid, (phrase, label, is_base, k) in enumerate(texts):
        words = phrase.split()
        if k not in (SHORT_GRAM, GRAM) or len(words) < k:
            raise ValueError(f"a template has {SHORT_GRAM} words or more, a base phrase {GRAM} at most")
        n = len(words) - k + 1
        rows += [(tid, label, is_base, len(words), k, n, i, words[i:i + k]) for i in range(n)]
    t = spark.createDataFrame(rows, "tid int, label string, is_base boolean, words int, k int, "
                                    "n_grams int, tpos int, gram array<string>")
    hashes = [F.when(F.col("k") == k, gram_hash(F.col("gram"), F.lit(0), k)) for k in (SHORT_GRAM, GRAM)]
    return t.select("*", F.coalesce(*hashes).alias("hash"), F.array_join("gram", " ").alias("tgram")).drop("gram")


MAX_POSITIONS = 1_000_000   # of templates: their table is broadcast


def scan(docs: DataFrame, texts: list[tuple[str, str, bool, int]] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: ``doc_id, k1, k2, rows, n_words`` (``rows``: how many rows
    repeat the document).  spans: ``k1, k2, tid, label, is_base, first, last,
    coverage`` for every place of a base phrase and every verified statement,
    in words from 0.  Null and empty texts have no words.

    ``texts`` are the ``templates()``; their positions are a parameter of bounded number, so
    their table is broadcast.  The text is read once and only matches leave the scan.
    """
    spark = prepare(docs.sparkSession)
    t = template_table(spark, templates() if texts is None else texts)
    hashes = {k: [r.hash for r in t.where(F.col("k") == k).select("hash").distinct().collect()]
              for k in (SHORT_GRAM, GRAM)}
    if t.count() > MAX_POSITIONS:
        raise ValueError(f"templates of at most {MAX_POSITIONS} positions are supported")
    did, text = docs[id_col].cast("long"), docs[text_col]
    words = docs.select(did.alias("doc_id"), *row_key(did, text), word_array(text).alias("words"))
    w = F.col("words")
    everywhere = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(
        F.array().cast("array<int>"))

    def places(k: int) -> Column:
        at = F.filter(everywhere, lambda i: gram_hash(w, i, k).isin(hashes[k]))
        return F.transform(at, lambda i: F.struct(i.alias("pos"), F.lit(k).alias("of"),
                                                  gram_hash(w, i, k).alias("hash"),
                                                  gram_text(w, i, k).alias("gram")))

    # position -1 stands for the document itself and carries its word count
    mark = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).alias("of"), F.lit(0).cast("long").alias("hash"),
                            F.size("words").cast("string").alias("gram")))
    found = words.select("doc_id", "k1", "k2", F.explode(F.concat(
        mark, places(SHORT_GRAM), places(GRAM))).alias("x")).select("doc_id", "k1", "k2", "x.*")
    known = F.broadcast(t.withColumnsRenamed({"hash": "_hash"}))
    hits = cut(found.join(known, (F.col("hash") == F.col("_hash")) & (F.col("of") == F.col("k"))
                          & (F.col("gram") == F.col("tgram")), "left")
               .where("pos < 0 or tid is not null")
               .select("doc_id", "k1", "k2", "pos", "tid", "label", "is_base", F.col("words"), "k", "n_grams",
                       "tpos", F.when(F.col("pos") < 0, F.col("gram").cast("long")).alias("n_words")))
    documents = hits.where("pos < 0").groupBy("doc_id", "k1", "k2").agg(
        F.count("*").alias("rows"), F.max("n_words").alias("n_words"))

    # votes per diagonal; a repeated row votes for the same positions again
    votes = hits.where("pos >= 0").groupBy(
        "k1", "k2", "tid", "label", "is_base", "words", "k", "n_grams",
        (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("seen"))
    w = Window.partitionBy("k1", "k2", "tid").orderBy("diagonal")
    gap = F.col("diagonal") - F.coalesce(F.lag("diagonal").over(w), F.lit(-(1 << 30)))
    # a full diagonal is a place of its own; the others join their neighbours
    alone = (F.size("seen") == F.col("n_grams")) | F.col("is_base")
    left_alone = F.coalesce(F.lag(alone).over(w), F.lit(True))
    votes = votes.withColumn("new", (alone | left_alone | (gap > DRIFT)).cast("int"))
    votes = votes.withColumn("merged", F.sum("new").over(w))
    spans = votes.groupBy("k1", "k2", "tid", "label", "is_base", "words", "k", "n_grams", "merged").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("held"),
        F.min(F.col("diagonal") + F.array_min("seen")).cast("long").alias("first"),
        F.max(F.col("diagonal") + F.array_max("seen") + F.col("k") - 1).cast("long").alias("last"))
    spans = spans.withColumn("coverage", F.col("held") / F.col("n_grams"))
    enough = F.when(F.col("k") == GRAM, COVERAGE).otherwise(SHORT_COVERAGE)
    fine = (F.col("coverage") >= enough) & (
        F.col("last") - F.col("first") + 1 <= F.col("words") + STRETCH)
    # of statements that start together, such as two versions of one license,
    # the best covered ones hold
    rivals = Window.partitionBy("k1", "k2", "is_base").orderBy("first").rangeBetween(-STRETCH, STRETCH)
    spans = spans.where(fine).withColumn("best", F.max("coverage").over(rivals))
    return documents, spans.where(F.col("is_base") | (F.col("coverage") == F.col("best"))).select(
        "k1", "k2", "tid", "label", "is_base", "first", "last", "coverage")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row.

    ``score`` is the best coverage of any template (0 if none is found)."""
    documents, spans = scan(docs, id_col=id_col, text_col=text_col)
    names = lambda only: F.array_join(F.array_sort(F.collect_set(only)), ",")
    base = F.when(F.col("is_base"), F.col("label"))
    place = F.when(F.col("is_base"), F.col("first"))
    by_doc = spans.groupBy("k1", "k2").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"),
        F.max(place).alias("last_word"), names(base).alias("base_labels"),
        names(F.col("label")).alias("labels"), F.max("coverage").alias("score"))
    out = documents.join(by_doc, ["k1", "k2"], "left").withColumn(
        "_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
