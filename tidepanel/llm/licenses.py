"""License scan by diagonal voting over word pairs."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.words import TERM, lower_ascii, whole, words

# fixed values: the phrases of the contract, and the label of each
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# fixed values: longer license texts and the labels that this scan adds
MORE = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "all rights reserved": "proprietary",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 2 of the license or at your option any later "
    "version": "gpl-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
    "apache org licenses license 2 0": "apache-2.0",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "mit",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "mit",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
    "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
    "for any damages arising from the use of this software": "zlib",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
    "distributed with this file you can obtain one at": "mpl-2.0",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as "
    "a compiled binary for any purpose commercial or non commercial and by any means": "unlicense",
    "this program and the accompanying materials are made available under the terms of the eclipse public license": "epl",
    "boost software license version 1 0": "bsl-1.0",
}
# fixed values: pairs of words that tell one license from the next; a span must hold those of its template
DECISIVE = {
    "version 2", "version 3", "license 2", "2 0", "mit license", "gnu lesser", "gnu affero", "mozilla public", "eclipse public",
    "boost software", "by sa", "by nc", "commons attribution", "and noninfringement", "are disclaimed", "the authors",
}
GRAM = 2
NEIGHBOURS = 3  # diagonals that many words apart are one: so many words may be added or left out
COVER = 0.75  # share of a longer template's pairs that a span must hold


def template_rows(base: dict[str, str], more: dict[str, str]) -> list[tuple]:
    """(template, whether a base phrase, label, place of the pair, pairs of the template, how many of these are decisive,
    whether this one is, pair) for each word pair."""
    rows = []
    for n, (phrase, label) in enumerate([*base.items(), *more.items()]):
        terms = phrase.split()
        if len(terms) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {phrase!r}")
        grams = [" ".join(terms[at : at + GRAM]) for at in range(len(terms) - GRAM + 1)]
        musts = sum(gram in DECISIVE for gram in grams)
        rows += [(n, n < len(base), label, at, len(grams), musts, gram in DECISIVE, gram) for at, gram in enumerate(grams)]
    return rows


def templates(spark: SparkSession, base: dict[str, str], more: dict[str, str]) -> DataFrame:
    """The word pairs of all templates; as many rows as these have words."""
    table = spark.createDataFrame(
        template_rows(base, more),
        "template int, base boolean, label string, at int, pairs int, musts int, "
        "must boolean, t_gram string"
    )
    return table.withColumn("t_hash", F.xxhash64("t_gram"))


def scan(docs: DataFrame, base: dict[str, str] = BASE, more: dict[str, str] = MORE) -> DataFrame:
    """License spans and labels of each row of ``docs`` (doc_id, text).

    Every rolling pair of words is joined by hash with the templates' pairs. A hit votes for its offset, the
    diagonal (place in the document less place in the template). Diagonals at most NEIGHBOURS apart merge, and a
    span counts if its pairs, compared as words, cover enough of the template: all of them on one diagonal for
    the base phrases, COVER of them for the longer ones, and there all DECISIVE pairs, so that a text
    of version 3 is none of version 2.

    One row per row: doc_id, n_words, n_base (places of base phrases), first_word, last_word (their smallest and
    largest start, from 0), base_labels, labels, score (the best cover of any template), spans.

    Null or empty text: no words and no labels (empty strings, null starts, score 0). Repeated rows: each gives
    its own row. Overlapping spans: all count. Empty table: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", words(lower_ascii(whole()), TERM).alias("_w")
    )
    pairs = F.transform(
        F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 1, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get(F.col("_w"), i + 1)),
    )
    # place 0 stands for the document itself, so that one without hits keeps its row; the words are left behind before
    # the pairs become rows, or each of these would carry all of them
    rows = rows.select(
        "_row", "doc_id", F.size("_w").cast("long").alias("n_words"), F.concat(F.array(F.lit("")), pairs).alias("_grams")
    )
    rows = rows.select("_row", "doc_id", "n_words", F.posexplode("_grams").alias("_place", "_gram"))
    wanted = F.broadcast(templates(spark, base, more))  # as large as the given phrases
    on = (F.xxhash64("_gram") == F.col("t_hash")) & (F.col("_gram") == F.col("t_gram"))
    hits = rows.join(wanted, on, "left").filter((F.col("_place") == 0) | F.col("t_hash").isNotNull())
    hits = hits.withColumn("_start", F.when(F.col("template").isNotNull(), F.col("_place") - 1 - F.col("at")))
    # from here on the hits stay where they are: all steps group by the row
    hits = hits.select(
        "_row", "doc_id", "n_words", "template", "base", "label", "pairs", "musts", "must", "at", "_start"
    ).repartition("_row")

    key = ["_row", "doc_id", "n_words", "template", "base", "label", "pairs", "musts"]
    votes = hits.groupBy(*key, "_start").agg(
        F.collect_set("at").alias("_ats"), F.collect_set(F.when(F.col("must"), F.col("at"))).alias("_must")
    )
    near = Window.partitionBy("_row", "template").orderBy("_start")
    gap = F.col("_start") - F.lag("_start").over(near)
    exact = F.size("_ats") == F.col("pairs")
    # a base phrase counts on one diagonal only, and a diagonal with all pairs needs no other
    votes = votes.withColumn("_exact", exact)
    alone = F.col("base") | F.col("_exact") | F.lag("_exact").over(near)
    new = F.when(alone | gap.isNull() | (gap > NEIGHBOURS), 1).otherwise(0)
    votes = votes.withColumn("_new", new)
    votes = votes.withColumn("_band", F.sum("_new").over(near.rowsBetween(Window.unboundedPreceding, 0)))
    bands = votes.groupBy(*key, "_band").agg(
        F.array_distinct(F.flatten(F.collect_list("_ats"))).alias("_ats"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_must")))).alias("_musts"),
        F.max("_exact").alias("_exact"),
        F.min("_start").alias("_first"),
        F.max("_start").alias("_last"),
    )
    cover = F.when(F.col("template").isNull(), 0.0).otherwise(F.size("_ats") / F.col("pairs"))
    begin = F.greatest(F.col("_first") + F.array_min("_ats"), F.lit(0))
    end = F.col("_last") + F.array_max("_ats") + GRAM
    bands = bands.withColumns({"cover": cover, "begin": begin, "end": end})
    good = F.when(F.col("base"), F.col("_exact")).otherwise((F.col("cover") >= COVER) & (F.col("_musts") == F.col("musts")))
    bands = bands.withColumn("good", F.coalesce(good, F.lit(False)))
    is_base = F.col("good") & F.col("base")

    def joined(labels):
        return F.concat_ws(",", F.sort_array(F.collect_set(labels)))

    return bands.groupBy("_row", "doc_id", "n_words").agg(
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("_first"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("_first"))).cast("long").alias("last_word"),
        joined(F.when(is_base, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("good"), F.col("label"))).alias("labels"),
        F.max("cover").alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("good"), F.struct("begin", "end", "label", "cover")))).alias("spans"),
    ).drop("_row")
