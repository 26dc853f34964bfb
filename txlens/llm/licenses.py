"""License scans by an exact set-similarity join, in DataFrame operations only.

A template (a license's name or notice) is the set of its words. A text block is a
window of ``2 s`` words that starts at a multiple of ``s``, ``s`` being the template's length
rounded up to a power of two, so that any place where the template could stand lies whole
in one block. The join finds every block that holds at least ``share`` of a template's
distinct words:

* words are ordered by their frequency in the whole corpus, rarest first. Words of
  no template can never count, so blocks keep the words of templates alone;
* prefix filter: of a template with n words of which o must be found, one of the
  n - o + 1 rarest must stand in the block. Only such words make candidates;
* length and position filters: a block of m words with a common word at place j of its own
  order and place i of the template's must have m >= o, j <= m - o and
  1 + min(n - 1 - i, m - 1 - j) >= o;
* the words common to the pairs left are counted.

Names count as found only where their words also stand next to each other; these
places are looked up inside the blocks that the join has found. Everything is
computed once per distinct text, known by its SHA-256.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlens.llm.common import fits_broadcast, stage

NOTICE_SHARE = 0.8  # of a notice's words; of a notice with fewer than WHOLE distinct words all must stand in the block
WHOLE = 10
# Fixed values: (label, text). Names must stand word by word.
NAMES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
# Fixed values: (label, text) of published license notices.
NOTICES = [
    ("mit-notice", "Released under the MIT License"),
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
     associated documentation files (the "Software"), to deal in the Software without restriction, including without
     limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
     Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"""),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-text", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.
     Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
     an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"""),
    ("gpl-notice", "licensed under the GNU General Public License, version 3"),
    ("gpl-text", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
     General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
     option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
     without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"""),
    ("bsd-text", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
     that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
     list of conditions and the following disclaimer"""),
    ("isc-text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
     hereby granted, provided that the above copyright notice and this permission notice appear in all copies"""),
    ("cc-by-nc-notice", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-notice", "Licensed under CC BY-SA 4.0"),
    ("mpl-text", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
     was not distributed with this file, You can obtain one at"""),
]
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN = "K"  # the one letter outside ASCII whose lower case is a single ASCII letter


def words(text: Column) -> Column:
    """Words of a text in order, A-Z in lower case; none for null."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit("å")))
    return F.filter(F.split(plain, _APART), lambda w: w != "")


def templates(spark: SparkSession, names: Sequence[tuple[str, str]] = NAMES, notices: Sequence[tuple[str, str]] = NOTICES,
              share: float = NOTICE_SHARE) -> DataFrame:
    """One row per template word: ``template, label, exact, size, need, step, idx, word``.

    ``size`` counts distinct words, ``need`` those that a block must hold (all, of a
    name or short notice), ``step`` is half a block's length, ``idx`` the word's place. The table is
    bounded by the templates given, whatever the corpus.
    """
    given = [(label, text, True, 1.0) for label, text in names] + [(label, text, False, share) for label, text in notices]
    rows = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"), F.lit(exact).alias("exact"),
                              F.lit(float(least)).alias("least")) for k, (label, text, exact, least) in enumerate(given)])
    t = spark.range(1).select(F.inline(rows)).withColumn("w", words(F.col("text")))
    size = F.size(F.array_distinct("w"))
    t = t.select("template", "label", "exact", size.alias("size"), F.when(size < WHOLE, size).otherwise(F.ceil(size * F.col("least") - 1e-9)).cast("int").alias("need"),
                 F.pow(2, F.ceil(F.log2(F.size("w")))).cast("int").alias("step"), F.posexplode("w").alias("idx", "word"))
    return t


def _few(df: DataFrame, row_bytes: int) -> DataFrame:
    """A staged table, to be broadcast if its measured size allows."""
    return F.broadcast(df) if fits_broadcast(df, row_bytes) else df


def find_blocks(docs: DataFrame, text_col: str = "text", rules: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Every (text, template, block) that meets the template's threshold, and the places of names.

    Staged tables ``key, template, label, exact, start, end, overlap, containment`` (words
    ``start`` to ``end`` - 1 of the text hold ``overlap`` of the template's words) and ``key, label,
    start`` (a name begins at word ``start``), each once per distinct text; ``key`` is the
    SHA-256 of the text in UTF-8, null texts being empty.
    """
    spark = docs.sparkSession
    rules = templates(spark) if rules is None else rules
    vocabulary = rules.select("word").distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The key is computed before the words are dealt out: once a text, not once a word.
    tokens = docs.select(F.unhex(F.sha2(text, 256)).alias("key"), words(text).alias("_w")).select("key", F.posexplode_outer("_w").alias("pos", "word"))
    hits = stage(tokens.join(F.broadcast(vocabulary), "word"), "license-words")

    # The global order, over the words of the templates (bounded by them).
    counts = vocabulary.join(F.broadcast(hits.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))), "word", "left").fillna(0, ["freq"])
    order = counts.select("word", F.row_number().over(Window.orderBy("freq", "word")).alias("rank"))
    sets = rules.select("template", "label", "exact", "size", "need", "step", "word").distinct().join(F.broadcast(order), "word")
    sets = stage(sets.withColumn("i", F.row_number().over(Window.partitionBy("template").orderBy("rank")) - 1), "license-sets")
    prefix = F.broadcast(sets.where(F.col("i") <= F.col("size") - F.col("need")).select("template", "size", "need", "step", "word", "i"))

    # Prefix filter: blocks around the rarest words of a template.
    unit = F.floor(F.col("pos") / F.col("step")).cast("int")
    seen = hits.join(prefix.select("step", "word").distinct(), "word").select("key", "step", unit.alias("block")).distinct()
    blocks = seen.select("key", "step", F.explode(F.array("block", F.col("block") - 1)).alias("block")).where("block >= 0").distinct()
    blocks = stage(blocks, "license-blocks")
    keys = stage(blocks.select("key").distinct(), "license-texts")
    hits = hits.join(_few(keys, 48), "key", "left_semi").distinct().withColumn("step", F.explode(F.array_distinct(F.lit(_steps(sets)))))
    hits = stage(hits.withColumn("unit", unit), "license-hits")
    halves = lambda df: df.withColumn("unit", F.explode(F.array("block", F.col("block") + 1)))
    inside = hits.join(_few(stage(halves(blocks), "license-units"), 64), ["key", "step", "unit"])
    held = inside.select("key", "step", "block", "word").distinct().join(F.broadcast(order), "word")
    mine = Window.partitionBy("key", "step", "block")
    held = held.withColumn("m", F.count(F.lit(1)).over(mine)).withColumn("j", F.row_number().over(mine.orderBy("rank")) - 1)
    held = stage(held.select("key", "step", "block", "word", "m", "j"), "license-held")

    # Length and position filters, then the count of common words.
    pairs = held.join(prefix, ["step", "word"]).where(
        (F.col("m") >= F.col("need")) & (F.col("j") <= F.col("m") - F.col("need"))
        & (1 + F.least(F.col("size") - 1 - F.col("i"), F.col("m") - 1 - F.col("j")) >= F.col("need")))
    pairs = stage(pairs.select("key", "step", "block", "template").distinct(), "license-pairs")
    common = held.select("key", "step", "block", "word").join(_few(pairs, 64), ["key", "step", "block"]).join(F.broadcast(sets.drop("step")), ["template", "word"])
    found = common.groupBy("key", "step", "block", "template", "label", "exact", "size", "need").agg(F.count(F.lit(1)).alias("overlap"))
    found = stage(found.where(F.col("overlap") >= F.col("need")), "license-found")

    # Places of names: their words next to each other, inside the blocks found.
    exact = stage(halves(found.where("exact")).select("key", "step", "unit", "template", "label").distinct(), "license-exact")
    spots = hits.join(_few(exact, 64), ["key", "step", "unit"])
    spots = spots.join(F.broadcast(rules.select("template", "word", "idx", F.count(F.lit(1)).over(Window.partitionBy("template")).alias("length"))), ["template", "word"])
    places = spots.groupBy("key", "template", "label", "length", (F.col("pos") - F.col("idx")).alias("start")).agg(F.count_distinct("idx").alias("n"))
    places = stage(places.where("n = length").select("key", "label", "start"), "license-places")
    return found.select("key", "template", "label", "exact", (F.col("block") * F.col("step")).alias("start"),
                        ((F.col("block") + 2) * F.col("step")).alias("end"), "overlap", (F.col("overlap") / F.col("size")).alias("containment")), places


def _steps(sets: DataFrame) -> list[int]:
    """The block lengths in use: at most one per power of two."""
    return sorted(r["step"] for r in sets.select("step").distinct().collect())


def scan(docs: DataFrame, text_col: str = "text", rules: DataFrame | None = None) -> DataFrame:
    """``docs`` with a column ``license``: a struct of what the text holds.

    Fields ``n_words``, ``n_base`` (places of names), ``first_word`` and ``last_word`` (smallest and largest
    start of such a place, else null), ``base_labels`` and ``labels`` (sorted arrays; the latter with
    the notices'), ``score`` (largest containment found, 0 without; a name whose words stand in a block but
    not next to each other does not count). Null texts are empty; equal texts, repeated rows included,
    get equal results; every row is returned with all its columns, an existing column ``license`` is
    replaced; an empty table gives an empty one.
    """
    found, places = find_blocks(docs, text_col, rules)
    names = places.groupBy("key").agg(F.count(F.lit(1)).alias("n_base"), F.min("start").cast("long").alias("first_word"),
                                      F.max("start").cast("long").alias("last_word"), F.collect_set("label").alias("base"))
    notices = found.where("not exact").groupBy("key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    none = F.array().cast("array<string>")
    texts = stage(names.join(notices, "key", "full").select(
        "key", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", F.coalesce("base", none).alias("base"),
        F.coalesce("more", none).alias("more"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score")), "license-results")
    # Columns of the table travel in one struct, so that none clashes with these.
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(row, F.unhex(F.sha2(text, 256)).alias("key"), F.size(words(text)).cast("long").alias("n_words"))
    out = rows.join(_few(texts, 256), "key", "left")
    base, more = F.coalesce("base", none), F.coalesce("more", none)
    return out.select("row.*", F.struct(
        "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", F.array_sort(base).alias("base_labels"),
        F.array_sort(F.array_union(base, more)).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")).alias("_license")) \
        .drop("license").withColumnRenamed("_license", "license")
