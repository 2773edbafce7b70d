"""Licences of files, by DataFrame operations only.

Every line of a file is held against licence templates by the cosine of sparse TF-IDF
vectors, and so are overlapping windows of its words, over the line breaks: for each template
windows of its own length, so a notice in a long line, a header block of many lines and a whole
licence text (``licences`` has them) are each met by a window that is filled by them.  Document frequencies of the
templates' terms are counted over all files; a term that no template has weighs as one
that no file has.  A line can reach the threshold only if it has one of the templates'
heavier terms, and a window only if it has a number of them, so others are passed over before
their vectors are built; no match is lost by it.  A file
most of whose words are in such lines or windows is a licence file: files below its directory
that state no licence inherit from the nearest such ancestor.

Defined results: a null or empty text states nothing; a null path has no ancestors; every row is a file of its
own, whether its key is null or another's; files with the same path share what they inherit; a text that fills most of its file comes before
the greatest cosine, and of equal ones lines, the first place and the first licence by name; in a directory with several licence files the one that fits best, then the first by
name; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
from importlib import resources

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store

#: Cosine from which a line states a licence.
THRESHOLD = 0.6
#: Cosine from which a window is a template of more than ``LONG`` words: long texts have common words in common.
LONG_THRESHOLD = 0.8
LONG = 100
#: Windows that start within the length of a template.
STEPS = 4
#: Share of a file's words in licence lines from which it is a licence file.
FILE_SHARE = 0.5
#: Statements and opening texts of public licences.
TEMPLATES = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Notices that take several lines, and the paragraphs of short licences.
NOTICES = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the whole licences."""
    files = sorted((f for f in resources.files(__package__).joinpath("licences").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return [(f.name[:-4], f.read_text(encoding="utf-8")) for f in files]


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = "[^a-z0-9]+"


def _terms(text: str) -> list[str]:
    return "".join(c.lower() if c in _UPPER or c in _LOWER or c.isdigit() and c.isascii() else " " for c in text).split()


def _words(column) -> F.Column:
    return F.filter(F.split(F.translate(column, _UPPER, _LOWER), _BREAK), lambda w: w != "")


def _known(column, terms: list[str]) -> F.Column:
    """The distinct words of a text that are among ``terms``, whose set is built once and not for each row."""
    return F.array_distinct(F.filter(F.split(F.translate(column, _UPPER, _LOWER), _BREAK), lambda w: w.isin(terms)))


def template_weights(idf: dict[str, float], templates=TEMPLATES) -> list[tuple[int, str, str, float]]:
    """(template, licence, term, weight); the weights of a template have length 1."""
    out = []
    for k, (name, text) in enumerate(templates):
        terms = _terms(text)
        raw = {t: terms.count(t) * idf[t] for t in sorted(set(terms))}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out += [(k, name, t, v / norm) for t, v in raw.items()]
    return out


def telling_terms(weights: list[tuple[int, str, str, float]], idf: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a line must have one: the others of any template stay below the threshold together."""
    out: set[str] = set()
    for k in {w[0] for w in weights}:
        own = sorted(((v, t) for i, _, t, v in weights if i == k), key=lambda x: (idf[x[1]], x[1]))
        rest = 0.0
        for v, t in own:
            rest += v * v
            if math.sqrt(rest) >= threshold - 1e-9:
                out.add(t)
    return sorted(out)


def document_frequencies(files: DataFrame, vocabulary: list[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of files, and of those with each term of the templates."""
    terms = _known(F.col(text), vocabulary)
    found = files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(terms, F.array().cast("array<string>")))).alias("term")).groupBy("term").count().collect()  # a row for each term of the templates
    counts = {r["term"]: r["count"] for r in found}
    return counts.pop("", 0), counts


def inverse_frequencies(files: DataFrame, templates) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each term of the templates, and that of any other term."""
    vocabulary = sorted({t for _, text in templates for t in _terms(text)})
    total, df = document_frequencies(files, vocabulary)
    return {t: math.log((1 + total) / (1 + df.get(t, 0))) + 1 for t in vocabulary}, math.log(1 + total) + 1


def needed_terms(weights: list[tuple[str, float]], idf: dict[str, float], threshold: float) -> tuple[list[str], int]:
    """Heavier terms of a template, and how many of them a text at the threshold has at least.

    Its cosine is at most the length of the template's vector on the terms that both have.
    """
    own = sorted(((v * v, t) for t, v in weights), key=lambda x: (idf[x[1]], x[1]))
    least, light, k = threshold * threshold - 1e-9, 0.0, 0
    while k < len(own) and light + own[k][0] <= least / 2:
        light += own[k][0]
        k += 1
    need, reached = 0, light
    for part in sorted((p for p, _ in own[k:]), reverse=True):
        if reached >= least:
            break
        reached += part
        need += 1
    return [t for _, t in own[k:]], need


def window_rules(idf: dict[str, float], templates, threshold: float = THRESHOLD) -> list[dict]:
    """For each template the length of its windows, their least cosine, and the heavier terms of which they have ``need`` at least."""
    weights = template_weights(idf, templates)
    rules = []
    for k, (_, text) in enumerate(templates):
        least = max(threshold, LONG_THRESHOLD) if len(_terms(text)) > LONG else threshold
        heavy, need = needed_terms([(t, v) for i, _, t, v in weights if i == k], idf, least)
        rules.append({"template": k, "n": len(_terms(text)), "first": _terms(text)[0], "need": need, "heavy": heavy, "least": least})
    return rules


def licence_windows(files: DataFrame, key: str, idf: dict[str, float], unknown: float, templates, threshold: float = THRESHOLD) -> DataFrame:
    """(key, start, words, of, license, cosine) of the windows that state a licence, each against the template of its length; ``of``: words of the text."""
    spark = files.sparkSession
    weights, rules = template_weights(idf, templates), window_rules(idf, templates, threshold)
    least = [r["least"] for r in rules]
    given = F.from_json(F.lit(json.dumps(rules)), "array<struct<template int, n int, first string, need int, heavy array<string>, least double>>")
    heavies = sorted({t for r in rules for t in r["heavy"]})
    texts = files.select(key, _words(F.col("text")).alias("words"), _known(F.col("text"), heavies).alias("heard")).where(F.size("heard") > 0)
    may = F.filter(given, lambda r: F.size(F.array_intersect(r["heavy"], F.col("heard"))) >= r["need"])
    tried = texts.select(key, "words", F.explode(may).alias("r"))
    last = F.greatest(F.size("words") - F.col("r.n"), F.lit(0))
    # Also where the template's first word stands: a whole notice is met exactly, however much other words weigh.
    exact = F.filter(F.sequence(F.lit(0), last), lambda s: F.get("words", s) == F.col("r.first"))
    starts = F.array_union(F.array_union(F.sequence(F.lit(0), last, F.greatest(F.expr(f"r.n div {STEPS}").cast("int"), F.lit(1))), F.array(last)), exact)
    cut = F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(F.col("words"), s + 1, F.col("r.n")).alias("words")))
    windows = tried.select(key, "r", F.size("words").alias("of"), F.explode(F.filter(cut, lambda w: F.size(F.array_intersect(w["words"], F.col("r.heavy"))) >= F.col("r.need"))).alias("w"))
    place = [key, "template", "start", "words", "of"]
    terms = windows.select(key, F.col("r.template").alias("template"), F.col("w.start").alias("start"), F.size("w.words").alias("words"), "of", F.explode("w.words").alias("term"))
    counted = terms.groupBy(*place, "term").agg(F.count("*").alias("tf"))
    # Both tables are made from the templates: their size does not depend on the input.
    idfs = spark.createDataFrame(list(idf.items()), "term string, idf double")
    vectors = spark.createDataFrame([(k, t, v) for k, _, t, v in weights], "template int, term string, weight double")
    names = spark.createDataFrame([(k, name, v) for k, ((name, _), v) in enumerate(zip(templates, least))], "template int, license string, least double")
    valued = counted.join(F.broadcast(idfs), "term", "left").withColumn("value", F.col("tf") * F.coalesce("idf", F.lit(unknown))).join(F.broadcast(vectors), ["template", "term"], "left")
    sums = valued.groupBy(*place).agg(F.sum(F.col("value") * F.col("weight")).alias("dot"), F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    found = sums.withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).join(F.broadcast(names), "template").where(F.col("cosine") >= F.col("least"))
    return found.select(key, "start", "words", "of", "license", "cosine")


def licence_lines(files: DataFrame, key: str, threshold: float = THRESHOLD, templates=TEMPLATES, known: tuple[dict[str, float], float] | None = None) -> DataFrame:
    """(key, line, words, license, cosine) of the lines that state a licence; ``files`` has key and text."""
    spark = files.sparkSession
    idf, unknown = known or inverse_frequencies(files, templates)
    idf = {t: idf[t] for t in sorted({t for _, text in templates for t in _terms(text)})}
    weights = template_weights(idf, templates)
    telling = telling_terms(weights, idf, threshold)
    lines = files.select(key, F.posexplode(F.split("text", "\n")).alias("line", "text"))
    pattern = "(?:^|[^a-z0-9])(?:" + "|".join(telling) + ")(?:[^a-z0-9]|$)"
    lines = lines.where(F.translate("text", _UPPER, _LOWER).rlike(pattern)).select(key, "line", _words(F.col("text")).alias("words"))
    counted = lines.select(key, "line", F.size("words").alias("words"), F.explode("words").alias("term")).groupBy(key, "line", "words", "term").agg(F.count("*").alias("tf"))
    # Both tables are made from the templates: their size does not depend on the input.
    idfs = spark.createDataFrame([(t, i) for t, i in idf.items()], "term string, idf double")
    vectors = spark.createDataFrame([(t, k, n, v) for k, n, t, v in weights], "term string, template int, license string, weight double")
    valued = counted.join(F.broadcast(idfs), "term", "left").withColumn("value", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    matched = valued.select(key, "line", "words", "term", "value", F.explode(F.array(F.lit(False), F.lit(True))).alias("match"))
    norms = matched.where(~F.col("match")).select(key, "line", "words", F.lit(-1).alias("template"), F.lit("").alias("license"), (F.col("value") * F.col("value")).alias("part"))
    dots = matched.where("match").join(F.broadcast(vectors), "term").select(key, "line", "words", "template", "license", (F.col("value") * F.col("weight")).alias("part"))
    sums = norms.unionByName(dots).groupBy(key, "line", "words", "template", "license").agg(F.sum("part").alias("part"))
    best = sums.groupBy(key, "line", "words").agg(
        F.sqrt(F.max(F.when(F.col("template") < 0, F.col("part")))).alias("norm"),
        F.max(F.when(F.col("template") >= 0, F.struct(F.round("part", 9).alias("dot"), (-F.col("template")).alias("order"), "license"))).alias("best"),
    )
    return best.select(key, "line", "words", "best.license", F.round(F.col("best.dot") / F.col("norm"), 6).alias("cosine")).where(F.col("cosine") >= threshold)


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (key long, path, text) -> key, path, own_license, cosine, is_file, license, inherited_from."""
    # Rows are told apart by their place in the stored table, as keys may be null or repeated.
    files = files.select(F.monotonically_increasing_id().alias("row"), "key", "path", "text")
    templates = TEMPLATES + NOTICES + full_texts()
    known = inverse_frequencies(files.select("text"), templates)
    # Texts without any of the terms that a line or a window must have are left out before they are cut.
    lined = {t: known[0][t] for _, text in TEMPLATES for t in _terms(text)}
    must = sorted({*telling_terms(template_weights(lined, TEMPLATES), lined, threshold), *(t for r in window_rules(known[0], templates, threshold) for t in r["heavy"])})
    files = store.materialize(files.withColumn("text", F.when(F.size(_known(F.col("text"), must)) > 0, F.col("text"))), "files")
    texts = files.select("row", "text", F.size(_words(F.col("text"))).alias("of")).where("text IS NOT NULL")
    zero = F.lit(0)
    lines = licence_lines(texts, "row", threshold, known=known).select("row", zero.alias("start"), zero.alias("end"), F.col("words").alias("line_words"), F.struct(F.lit(1).alias("part"), F.negative("cosine").alias("far"), zero.alias("kind"), F.col("line").alias("at"), "license").alias("rank"))
    windows = licence_windows(texts, "row", *known, templates, threshold).select("row", "start", (F.col("start") + F.col("words")).alias("end"), zero.alias("line_words"), F.struct(F.when(F.col("words") >= FILE_SHARE * F.col("of"), 0).otherwise(1).alias("part"), F.negative("cosine").alias("far"), F.lit(1).alias("kind"), F.col("start").alias("at"), "license").alias("rank"))
    # Words in several windows count once: each window has those beyond the ends of the windows before.
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), zero)), zero)
    # A text that fills most of the file comes first, then the greatest cosine, then lines, the first place and the first name.
    stated = lines.unionByName(windows).withColumn("fresh", fresh).groupBy("row").agg(F.min("rank").alias("best"), F.greatest(F.sum("line_words"), F.sum("fresh")).alias("licence_words"))
    judged = files.select("row", "key", "path").join(stated.join(texts.select("row", F.col("of").alias("words")), "row"), "row", "left").select(
        "key", "path", F.col("best.license").alias("own_license"), F.coalesce(F.negative("best.far"), F.lit(0.0)).alias("cosine"),
        F.coalesce(F.col("licence_words") >= FILE_SHARE * F.greatest(F.col("words"), F.lit(1)), F.lit(False)).alias("is_file"),
    )
    judged = store.materialize(judged, "judged")
    parent = F.regexp_replace("path", "/?[^/]*$", "")
    directories = judged.where("is_file AND path IS NOT NULL").groupBy(parent.alias("directory")).agg(F.min_by("own_license", F.struct(F.negative("cosine"), "own_license")).alias("given"))
    # Every directory once, joined with its ancestors; then files take their directory's answer.
    own = judged.where("path IS NOT NULL").select(parent.alias("parent")).distinct()
    above = own.select("parent", F.explode(F.expr("transform(sequence(0, size(split(parent, '/'))), n -> struct(n AS depth, array_join(slice(split(parent, '/'), 1, n), '/') AS directory))")).alias("a")).select("parent", "a.*")
    nearest = above.join(directories, "directory").groupBy("parent").agg(F.max(F.struct("depth", "directory", "given")).alias("near"))
    found = judged.withColumn("parent", parent).join(nearest, "parent", "left")
    inherits = F.col("own_license").isNull() & F.col("near").isNotNull()
    return found.select("key", "path", "own_license", "cosine", "is_file", F.coalesce("own_license", "near.given").alias("license"), F.when(inherits, F.col("near.directory")).alias("inherited_from"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source/lang/thousands/doc_id."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.expr("cast(doc_id div 1000 as string)"), F.col("doc_id").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("key"), F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(document_paths(store.table(spark, sf_dir, "documents"))).withColumnRenamed("key", "doc_id")
