"""License scan by diagonal voting: word n-grams shared with a template lie on one diagonal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docketrank.llm.common import split_words

# What separates words once A-Z are lower case, phrases and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Passages of public licenses and notices, by label.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software",
        "released under the mit license",
    ),
    "apache": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ),
    "lgpl": ("gnu lesser general public license", "gnu library general public license"),
    "agpl": ("gnu affero general public license",),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at",
    ),
    "epl": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose "
        "are disclaimed",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "zlib": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to "
        "alter it and redistribute it freely subject to the following restrictions",
    ),
    "boost": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license the software to use reproduce display distribute execute "
        "and transmit the software",
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
        "as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
    "cc": (
        "licensed under cc by 4 0",
        "licensed under cc by sa 4 0",
        "licensed under cc by nd 4 0",
        "licensed under cc by nc 4 0",
        "licensed under cc by nc sa 4 0",
        "licensed under cc by nc nd 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
        "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license",
        "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of "
        "his or her rights to the work worldwide under copyright law",
    ),
}

# Words of a gram; diagonals this near are one span (a few words more or less in between); share
# of a template's words that a span has to hold.
GRAM, NEAR, ENOUGH = 4, 3, 0.75
# Score of a document that holds a phrase but no span.
PHRASE_SCORE = 0.9


def words_of(text: Column) -> Column:
    """Words of a text: A-Z in lower case, cut at ASCII characters other than letters and digits."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return split_words(F.translate(F.coalesce(text, F.lit("")), upper, lower), SEPARATORS + "+")


def _grams(words: Column) -> Column:
    """All rolling grams of a list of words with their places."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - GRAM, F.lit(0)))
    return F.transform(
        places,
        lambda i: F.struct(i.alias("place"), F.concat_ws(" ", *(F.get(words, i + k) for k in range(GRAM))).alias("gram")),
    )


def _template_grams(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """Every gram of every template: a few hundred rows, whatever is scanned."""
    rows = [(label, i, text, len(text.split())) for label, texts in templates.items() for i, text in enumerate(texts)]
    listed = spark.createDataFrame(rows, "label string, number int, body string, n_template int")
    grams = listed.select("label", "number", "n_template", F.explode(_grams(F.split("body", " "))).alias("g"))
    return grams.select("label", "number", "n_template", F.col("g.place").alias("at"), F.col("g.gram").alias("t_gram"))


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None) -> DataFrame:
    """Verified spans: ``doc_id``, label, first and last word, covered share of the template.

    The rolling grams of every text are joined to the places of equal grams in the templates (the
    hash join's keys are the grams themselves, so nothing is taken for equal by its hash alone).
    Hits are counted by document, template and diagonal (place less place in the template),
    neighbouring diagonals merge, and a span stays if the grams on it cover enough of the template.
    Equal rows of one id are scanned as one document.
    """
    grams = _template_grams(docs.sparkSession, templates or TEMPLATES)
    found = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words")).where(
        F.size("words") >= GRAM
    )
    rolled = found.select("doc_id", F.explode(_grams(F.col("words"))).alias("g"))
    hits = rolled.join(F.broadcast(grams), F.col("g.gram") == F.col("t_gram")).select(
        "doc_id", "label", "number", "n_template", F.col("g.place").alias("place"), "at"
    )
    template = ["doc_id", "label", "number", "n_template"]
    votes = hits.groupBy(*template, (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.collect_set("at").alias("ats")
    )
    by_diagonal = Window.partitionBy(*template).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > NEAR, F.lit(True))
    merged = (
        votes.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(by_diagonal))
        .groupBy(*template, "span")
        .agg(
            F.min("first").cast("long").alias("first_word"),
            (F.max("last") + GRAM - 1).cast("long").alias("last_word"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("ats"),
        )
    )
    ats = F.col("ats")
    steps = F.zip_with(
        ats, F.slice(ats, 2, F.size(ats)), lambda a, b: F.least(F.coalesce(b - a, F.lit(GRAM)), F.lit(GRAM))
    )
    covered = F.aggregate(steps, F.lit(0), lambda total, step: total + step) / F.col("n_template")
    long_enough = F.col("last_word") - F.col("first_word") < 2 * F.col("n_template")
    return merged.select("doc_id", "label", "first_word", "last_word", covered.alias("share"), long_enough.alias("fits")).where(
        f"fits AND share >= {ENOUGH}"
    ).drop("fits")


def _phrase_places(words: Column, joined: Column) -> Column:
    """Places (start, label) of the phrases; only texts that hold a phrase are gone through."""

    def places(phrase: str, label: str) -> Column:
        parts = phrase.split(" ")

        def here(i: Column) -> Column:
            met = F.get(words, i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                met &= F.coalesce(F.get(words, i + k) == part, F.lit(False))
            return met

        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
        found = F.transform(at, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))
        none = F.array().cast("array<struct<start:int,label:string>>")
        return F.when(F.contains(joined, F.lit(f" {phrase} ")), found).otherwise(none)

    return F.concat(*(places(phrase, label) for phrase, label in PHRASES.items()))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, n_spans.

    The base counts places of the phrases; the method adds the labels of verified spans. ``score``
    is the best covered share of a template, ``PHRASE_SCORE`` at least if a phrase occurs, else 0.
    NULL and empty texts have no words and no labels; a row without id gets its phrases, but no
    spans of the method. Rows that share an id share its spans. Other columns are ignored.
    """
    listed = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    based = listed.select("doc_id", F.size("words").cast("long").alias("n_words"), "words", joined.alias("joined")).select(
        "doc_id", "n_words", _phrase_places(F.col("words"), F.col("joined")).alias("base")
    )
    method = (
        spans(docs.where(F.col(doc_id).isNotNull()), doc_id, text)
        .groupBy(F.col("doc_id").alias("s_doc_id"))
        .agg(F.collect_set("label").alias("found"), F.max("share").alias("share"), F.count("*").alias("n_spans"))
    )
    starts = F.transform("base", lambda b: b["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    both = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    rows = based.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        base_labels.alias("base_labels"),
    ).join(method, F.col("doc_id") == F.col("s_doc_id"), "left")
    phrase_score = F.when(F.col("n_base") > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.greatest(phrase_score, F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
    )
