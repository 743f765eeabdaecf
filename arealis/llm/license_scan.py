"""Licence labels by a positional index of rare words (native).

Templates are licence notices and grants, given as words with their places. The document frequency of
every template word is counted over all texts. The index holds, for each template, the places of its
words of highest inverse document frequency. Each text looks up all of its words that the index holds;
a hit and a posting agree on where the template would have to begin, and hits that agree to within
``SLACK`` words are counted together. A template that keeps at least half of its index weight at one
place is a candidate; its mandatory key phrases must then stand in the text word for word where the
template has them, again to within ``SLACK``. Its label is added, with the share of the index weight found.

Apart from that, base phrases are found wherever their words stand consecutively.

Texts are cut into words once: what is kept of a text is the places of template words and of phrases, so
it isn't read again. Hits and places become rows only where the index or a template asks for them; they
meet by text, template and bin of the place, so a long text or a frequent word is no single task.

Defined results: a null or empty text has no words and labels; repeated rows and null ids each give a row;
labels are distinct and sorted, so ties don't matter; texts of any length are read whole; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import content, documents, land, lower_ascii
from arealis.llm.quality_rules import let

#: What lies between words, in lower-cased text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose words stand consecutively, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, words of the template, phrases that must all be there. Fixed values.
TEMPLATES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at",
        ("you may not use this file except in compliance with the license",),
    ),
    ("apache", "licensed under the apache license version 2 0", ("apache license version 2",)),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation",
        ("under the terms of the gnu general public license", "free software foundation"),
    ),
    ("gpl", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
        " published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    (
        "agpl",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as"
        " published by the free software foundation",
        ("gnu affero general public license",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met redistributions of source code must retain the above copyright notice"
        " this list of conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "must retain the above copyright notice"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was"
        " not distributed with this file you can obtain one at",
        ("subject to the terms of the mozilla public license",),
    ),
    (
        "zlib",
        "in no event will the authors be held liable for any damages arising from the use of this software permission"
        " is granted to anyone to use this software for any purpose including commercial applications",
        ("permission is granted to anyone to use this software for any purpose",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
        " use compile sell or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
    ("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("epl", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    (
        "cc-by-nc",
        "licensed under the creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
    ),
    ("cc0", "released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
)
#: Words by which a place may differ from the template's.
SLACK = 8
#: Words of a template that the index holds, and the part of the highest weight that they need.
RAREST, LEAST_WEIGHT = 12, 0.5
#: Part of a template's index weight that makes it a candidate.
COVERED = 0.5
#: Score of a text with a base phrase and no better template.
BASE_SCORE = 0.5


def vocabulary() -> list[str]:
    """All words of templates and base phrases."""
    texts = [t for _, t, phrases in TEMPLATES for t in (t, *phrases)] + [p for p, _ in BASE]
    return sorted({w for t in texts for w in t.split()})


def _words(texts: tuple[str, ...] | list[str]) -> Column:
    return F.array(*(F.lit(t) for t in texts))


def all_phrases() -> list[str]:
    """Base phrases and key phrases; places are noted by the number in this list."""
    return list(dict.fromkeys([p for p, _ in BASE] + [p for _, _, phrases in TEMPLATES for p in phrases]))


def _starts(hits: Column, kinds: Column, number: int, phrase: str) -> Column:
    """(number, place) where the phrase begins; all its words are among the hits, ``kinds`` their different words."""
    words = phrase.split()
    size = len(words)

    def start(x: Column, j: Column) -> Column:
        last = F.get(hits, j + (size - 1))
        same = (x["word"] == words[0]) & (last["pos"] == x["pos"] + (size - 1)) & (F.slice(hits["word"], j + 1, size) == _words(words))
        return F.when(same, F.struct(F.lit(number).alias("phrase"), x["pos"].alias("pos")))

    possible = F.array_contains(kinds, max(words, key=len))
    return F.when(possible, F.array_compact(F.transform(hits, start))).otherwise(F.array().cast("array<struct<phrase:int,pos:int>>"))


def _noted(text: Column) -> Column:
    """n_words, hits (template words and their places), their different words, and places of phrases."""
    known = vocabulary()

    def hits(words: Column) -> Column:
        return F.array_compact(
            F.transform(words, lambda w, i: F.when(w.isin(*known), F.struct(w.alias("word"), i.alias("pos"))))
        )

    def phrases(found: Column) -> Column:
        kinds = F.array_distinct(found["word"])
        return let(
            kinds,
            lambda k: F.struct(
                found.alias("hits"), k.alias("kinds"),
                F.concat(*(_starts(found, k, i, p) for i, p in enumerate(all_phrases()))).alias("phrases"),
            ),
        )

    def noted(words: Column) -> Column:
        return let(let(hits(words), phrases), lambda x: F.struct(F.size(words).cast("long").alias("n_words"), x.alias("found")))

    return let(F.array_remove(F.split(text, BETWEEN), ""), noted)


def template_table(spark: SparkSession) -> DataFrame:
    """(template, label, words, phrases); a phrase has its number and its place in the template."""
    rows, numbers = [], all_phrases()
    for number, (label, text, phrases) in enumerate(TEMPLATES):
        words = text.split()
        parts = []
        for phrase in phrases:
            of = phrase.split()
            at = next(i for i in range(len(words)) if words[i : i + len(of)] == of)
            parts.append(F.struct(F.lit(numbers.index(phrase)).alias("phrase"), F.lit(at).alias("at")))
        rows.append(
            F.struct(
                F.lit(number).alias("template"), F.lit(label).alias("label"), _words(words).alias("words"), F.array(*parts).alias("phrases")
            )
        )
    return spark.range(1).select(F.inline(F.array(*rows)))


def rare_word_index(notes: DataFrame, templates: DataFrame) -> DataFrame:
    """(word, template, tpos, weight, share): places of each template's rarest words over all texts.

    ``share`` is the word's part of the template's index weight, once per word.
    """
    seen = notes.select(F.explode("kinds").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = notes.agg(F.count(F.lit(1)).alias("texts"))
    places = templates.select("template", F.posexplode("words").alias("tpos", "word"))
    idf = F.log1p(F.col("texts") / F.greatest(F.coalesce("df", F.lit(0)), F.lit(1)))
    words = (
        places.groupBy("template", "word").agg(F.min("tpos").alias("first"))
        .join(F.broadcast(seen), "word", "left")  # the words of the templates at most
        .join(F.broadcast(total))  # one row
        .select("template", "word", "first", idf.alias("weight"))
    )
    rarest = F.struct(F.max("weight").alias("top"), F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("low"), "first", "word"))).alias("all"))
    kept = (
        words.groupBy("template").agg(rarest.alias("r"))
        .select("template", "r.top", F.explode(F.slice("r.all", 1, RAREST)).alias("w"))
        .where(-F.col("w.low") >= LEAST_WEIGHT * F.col("top"))
        .select("template", "w.word", (-F.col("w.low")).alias("weight"))
    )
    whole = kept.groupBy("template").agg(F.sum("weight").alias("whole"), F.count(F.lit(1)).alias("kinds"))
    return (
        places.join(kept, ["template", "word"])
        .join(whole, "template")
        .select("word", "template", "tpos", F.try_divide("weight", "whole").alias("share"), "kinds")
    )


def _bins(begin: Column) -> Column:
    """Bins of a place: two rows of them, half a bin apart, so that neighbours always share one."""
    return F.array(
        F.struct(F.lit(0).alias("shift"), F.floor(begin / SLACK).alias("bin")),
        F.struct(F.lit(1).alias("shift"), F.floor((begin + SLACK // 2) / SLACK).alias("bin")),
    )


def candidates(notes: DataFrame, index: DataFrame) -> DataFrame:
    """(row, template, shift, bin, low, high, coverage): where a template would begin, by agreeing hits."""
    hits = notes.select("row", F.inline("hits"))
    begin = F.col("pos") - F.col("tpos")
    met = hits.join(F.broadcast(index), "word").select(
        "row", "template", "word", "share", "kinds", begin.alias("begin"), F.inline(_bins(begin))
    )
    words = met.groupBy("row", "template", "shift", "bin", "word").agg(
        F.max("share").alias("share"), F.max("kinds").alias("kinds"), F.min("begin").alias("low"), F.max("begin").alias("high")
    )
    together = words.groupBy("row", "template", "shift", "bin").agg(
        F.sum("share").alias("coverage"), F.count(F.lit(1)).alias("agreeing"), F.max("kinds").alias("kinds"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    enough = (F.col("coverage") >= COVERED) & (F.col("agreeing") >= F.least(F.col("kinds"), F.lit(2)))
    return together.where(enough).select(
        "row", "template", "shift", "bin", "low", "high", F.least("coverage", F.lit(1.0)).alias("coverage")
    )


def verified(found: DataFrame, notes: DataFrame, templates: DataFrame) -> DataFrame:
    """(row, method, coverage) of the rows with a candidate all of whose key phrases are in place."""
    wanted = templates.select("template", F.inline("phrases"))
    begin = F.col("pos") - F.col("at")
    places = notes.select("row", F.inline("phrases")).join(F.broadcast(wanted), "phrase")  # the templates' phrases
    # a bin is as wide as the slack: a place fits candidates of its own bin and of both beside it
    near = places.select("row", "template", "phrase", begin.alias("begin"), F.inline(_bins(begin))).select(
        "row", "template", "phrase", "begin", "shift", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin")
    )
    where = ["row", "template", "shift", "bin"]
    fits = F.col("begin").between(F.col("low") - SLACK, F.col("high") + SLACK)
    met = found.join(near, where).where(fits).groupBy(*where).agg(
        F.max("coverage").alias("coverage"), F.size(F.collect_set("phrase")).alias("seen")
    )
    labels = templates.select("template", "label", F.size("phrases").alias("all"))
    return (
        met.join(F.broadcast(labels), "template")  # one row per template
        .where(F.col("seen") == F.col("all"))
        .groupBy("row")
        .agg(F.collect_set("label").alias("method"), F.max("coverage").alias("coverage"))
    )


def _labelled(phrase: str, label: str) -> Column:
    number = all_phrases().index(phrase)
    some = F.filter("phrases", lambda x: x["phrase"] == number)
    return F.transform(some, lambda x: F.struct(x["pos"].alias("word"), F.lit(label).alias("label")))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, n_words, base (places and labels of base phrases), labels of
    verified templates, all labels, and the score."""
    text = lower_ascii(content(text_column))
    notes = land(
        docs.select(F.col(f"`{id_column}`").alias("id"), F.monotonically_increasing_id().alias("row"), _noted(text).alias("n"))
        .select("id", "row", "n.n_words", "n.found.*"),
        "licence-words",
    )
    templates = template_table(docs.sparkSession)
    index = land(rare_word_index(notes, templates), "licence-index")
    found = verified(land(candidates(notes, index), "candidates"), notes, templates)
    base = F.array_sort(F.concat(*(_labelled(phrase, label) for phrase, label in BASE)))
    nothing = F.array().cast("array<string>")
    out = notes.select("id", "row", "n_words", base.alias("base")).join(found, "row", "left")
    base_labels = F.array_sort(F.array_distinct("base.label"))
    return out.select(
        "id", "n_words", "base", base_labels.alias("base_labels"),
        F.array_sort(F.array_union(base_labels, F.coalesce("method", nothing))).alias("labels"),
        F.greatest(F.coalesce("coverage", F.lit(0.0)), F.when(F.size("base") > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").cast("long").alias("first_word"),
        F.array_max("base.word").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


QUERIES = {"op13_license_scan": op13_license_scan}
ORACLE: dict[str, str] = {}
