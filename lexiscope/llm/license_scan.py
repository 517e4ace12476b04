"""Licence scan: lines and whole texts against licence templates by Dice over word bigrams.

Text is normalised (lower case; anything but letters and digits is a space).  A unit is a
line, or the whole text if it has several lines.  With ``a`` and ``b`` bigrams, Dice is at most
``2 min(a, b) / (a + b)``, so a template can only reach ``threshold`` on units whose bigram count lies in
``[b t / (2 - t), b (2 - t) / t]``; other units are pruned before bigrams are built.  Units
meet templates on a shared bigram (a constant, broadcast table), never in a cross join.

A notice that is wrapped over lines or shares its line with other words is no unit.  ``find_notices``
compares every run of words of the whole text (a *window*) within the same size bounds.  Only windows
that begin and end on a shared bigram are built: cutting any other bigram off an end leaves the shared
ones as they are and raises Dice.  An occurrence of a bigram counts in a window from ``s`` if the
template's number of earlier ones doesn't lie between ``s`` and it, so running ranks give the exact
multiset intersection of all windows from ``s``.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.llm.decontaminate import word_array

THRESHOLD = 0.8

#: Licence notices (fixed values: public texts).
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}

BIGRAMS = ("case when size({0}) < 2 then cast(array() as array<string>) else transform(sequence(1, size({0}) - 1), "
           "i -> concat(element_at({0}, i), ' ', element_at({0}, i + 1))) end")


def template_bigrams(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """``template, bigram, t_count, t_size, lo, hi``: a constant, small table."""
    t = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    t = t.select("template", word_array("text").alias("tw")).select("template", F.expr(BIGRAMS.format("tw")).alias("tb"))
    return t.select("template", F.size("tb").alias("t_size"), F.explode("tb").alias("bigram")).groupBy(
        "template", "t_size", "bigram").agg(F.count(F.lit(1)).alias("t_count")).withColumns({
            "lo": F.ceil(F.col("t_size") * threshold / (2 - threshold) - 1e-9),
            "hi": F.floor(F.col("t_size") * (2 - threshold) / threshold + 1e-9)})


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Best template of every unit that reaches ``threshold``: ``doc_id, line`` (0-based; -1: the whole
    text), ``template, dice``; on a tie the template first by name.

    Null and empty texts have no unit; rows that repeat an id are scanned one by one, each giving
    its own rows; a null id stays null; other columns are ignored; an empty table gives no row.
    """
    t = template_bigrams(docs.sparkSession, templates, threshold)
    sizes = sorted(len(words) for words in templates.values())
    bounds = t.agg(F.min("lo"), F.max("hi")).first() if sizes else (1, 0)
    lo, hi = int(bounds[0] or 1), int(bounds[1] or 0)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.col("text"))
    lines = rows.select("doc_id", "row", "text", F.split(F.coalesce("text", F.lit("")), "\n").alias("ls"))
    units = lines.select("doc_id", "row", F.expr(
        "posexplode(if(size(ls) > 1, concat(ls, array(text)), ls))").alias("line", "unit"), F.size("ls").alias("n_lines"))
    units = units.select("doc_id", "row", F.expr("if(line = n_lines, -1, line)").alias("line"),
                         word_array("unit").alias("w"))
    # Pruned by size inside an outer generator: a filter would be pushed below the projection of the
    # words and build them twice.
    grams = units.select("doc_id", "row", "line", (F.size("w") - 1).alias("u_size"), F.explode_outer(F.expr(
        f"case when size(w) between {lo + 1} and {hi + 1} then {BIGRAMS.format('w')} end")).alias("bigram"))
    shared = (grams.join(F.broadcast(t), "bigram").where("u_size between lo and hi")
              .groupBy("doc_id", "row", "line", "u_size", "template", "t_size", "bigram", "t_count")
              .agg(F.count(F.lit(1)).alias("u_count"))
              .groupBy("doc_id", "row", "line", "u_size", "template", "t_size")
              .agg(F.sum(F.least("u_count", "t_count")).alias("both")))
    scored = shared.withColumn("dice", F.expr("2.0D * both / (u_size + t_size)")).where(F.col("dice") >= threshold)
    return scored.groupBy("doc_id", "row", "line").agg(
        F.min(F.struct((-F.col("dice")).alias("d"), "template")).alias("b")).select(
        "doc_id", "line", F.col("b.template").alias("template"), F.round(-F.col("b.d"), 9).alias("dice"))


def find_notices(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Windows of the whole texts that reach ``threshold``: ``doc_id, template, start_word, n_words, dice``
    (``start_word``: 0-based, over all lines).

    Each template is on its own: of its windows the most similar one is taken (on a tie the first, then
    the shortest), then the next that shares no word with those taken, and so on.  Rows as in ``find_licenses``.

    A window is left out early if a shorter one from the same start is no worse: that one comes first, and whatever
    it meets, the longer one meets too.  Windows taken are kept by their start in buckets as wide as the longest
    window, so a new one is compared with those of three buckets, however many notices a text holds.
    """
    t = template_bigrams(docs.sparkSession, templates, threshold)
    known = sorted({r["bigram"] for r in t.select("bigram").distinct().collect()})  # constant: the templates' own
    firsts = sorted({b.split(" ")[0] for b in known})
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), word_array("text").alias("w"))
    at = F.filter(F.expr("if(size(w) < 2, cast(array() as array<int>), sequence(0, size(w) - 2))"),
                  lambda i: F.get("w", i).isin(firsts) & F.concat(F.get("w", i), F.lit(" "), F.get("w", i + 1)).isin(known))
    places = texts.select("doc_id", "row", "w", at.alias("at")).select(
        "doc_id", "row", F.expr("transform(at, p -> struct(p, concat(w[p], ' ', w[p + 1]) as bigram))").alias("at"))
    # One row for each different bigram of a text, with its places; an outer generator as above.
    grams = places.select("doc_id", "row", "at", F.explode_outer(F.expr("array_distinct(at.bigram)")).alias("bigram")).select(
        "doc_id", "row", "bigram", F.expr("transform(filter(at, x -> x.bigram = bigram), x -> x.p)").alias("ps"))
    hits = (grams.join(F.broadcast(t), "bigram")
            .groupBy("doc_id", "row", "template", "t_size", "lo", "hi")
            .agg(F.sum(F.least(F.size("ps"), "t_count")).alias("both"), F.expr(
                "sort_array(flatten(collect_list(transform(ps, (p, i) -> struct(p, "
                "if(i < t_count, -1, ps[cast(i - t_count as int)]) as before)))))").alias("g"))
            .where("both >= lo"))
    # A window needs ``lo`` shared bigrams to reach the threshold, so its first lo - 1 ends are passed over.
    ends = f"""aggregate(transform(slice(filter(slice(g, i + 1, cast(hi as int)), x -> x.p < y.p + hi and x.before < y.p),
            cast(lo as int), cast(hi as int)),
        (x, r) -> struct(-2.0D * (r + lo) / (x.p - y.p + 1 + t_size) as d, y.p as start_word, x.p - y.p + 2 as n_words)),
        cast(array() as array<struct<d: double, start_word: int, n_words: int>>), (a, x) -> if(
            x.d <= -{threshold}D and x.d < coalesce(get(a, size(a) - 1).d, 0.0D), concat(a, array(x)), a))"""
    spans = hits.select("doc_id", "row", "template", F.expr("cast(hi + 1 as int)").alias("wide"), F.expr(f"""array_sort(
        flatten(transform(g, (y, i) -> if(get(g, cast(i + lo - 1 as int)).p < y.p + hi, {ends}, slice(array(struct(0.0D as d, 0 as start_word, 0 as n_words)), 1, 0)))))""").alias("c"))
    # Element b + 2 holds what starts in bucket b, so the neighbours of any bucket exist.
    taken = spans.select("doc_id", "row", "template", F.expr("""flatten(aggregate(c,
        array_repeat(slice(c, 1, 0), cast(array_max(c.start_word) div wide + 3 as int)), (a, x) -> if(
            exists(flatten(slice(a, cast(x.start_word div wide + 1 as int), 3)), y ->
                x.start_word < y.start_word + y.n_words and y.start_word < x.start_word + x.n_words), a,
            concat(slice(a, 1, cast(x.start_word div wide + 1 as int)), array(concat(get(a, cast(x.start_word div wide + 1 as int)), array(x))),
                   slice(a, cast(x.start_word div wide + 3 as int), size(a))))))""").alias("c"))
    return taken.select("doc_id", "row", "template", F.expr("inline_outer(c)")).where("d is not null").select(
        "doc_id", "template", "start_word", "n_words", F.round(-F.col("d"), 9).alias("dice"))
