"""Licence notices, found by a trained paragraph classifier and confirmed by templates.

Built from DataFrame and SQL functions and Spark's own logistic regression. Paragraphs
are lines, and for notices that are wrapped also runs of lines, none of
them blank. Their word 1- to 3-grams, lower-cased and with digits as 0, are the features; in a run they
reach over the line ends.

Training. The known families' notices (``TEMPLATES``, with a few ways to open and close
them) and, as the class ``unknown``, about ``SAMPLE`` paragraphs of the corpus, drawn by a
hash, that don't resemble a template. Elastic-net multinomial regression leaves few
n-grams with a weight; those that it leaves without one stay out of the learner (``_regression``). Every fifth paragraph is held back; on these one temperature
is fitted, which calibrates the probabilities, that of ``unknown`` included.

Scanning. A paragraph is a notice if a family's probability is at least ``LEAST`` and the
share of the n-grams of the family's most similar template that it holds is at least
``CONFIRMED``. So only these have to be looked at:

* Texts with one of a few words of each template, chosen such that without all of them the
  share is out of reach. All others are left after one look.
* The n-grams of these texts that have a weight or stand in a template, found by a broadcast join (at
  most one row for each n-gram of the templates and of the sample).
* Runs of lines, of any length, that hold the share of a template. They are found in one pass over the
  n-grams of a text and template: the last place of each n-gram tells, at any line, the shortest run that ends
  there. Longer ones count where their first line adds two words of the template or more.

Weights are summed for these runs alone. Of runs that overlap the one of fewest lines is kept, then the most
similar, then the first; ``paragraph`` is the number of its first line. Comment marks are no words, and
so don't count.

Defined cases. Null and empty texts have no paragraphs that count. Repeated rows are
found each: equal rows are scored as one and listed as often as they occur. Of equal probabilities the family
first by name is taken. An empty table gives an empty result; so does, in effect, a corpus
without ``unknown`` paragraphs to train on. Extra columns are not carried along.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common

# Usual wordings of licence notices, by family.
TEMPLATES = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0",
        "This project is licensed under the terms of the Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC": (
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY 4.0",
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License version 2 or later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL": (
        "Licensed under the Mozilla Public License, version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
}
OPENINGS = ("", "Note: ", "(c) 2020 the authors. ", "This file is ")
CLOSINGS = ("", ".", " (see LICENSE).", ". All rights reserved.")
UNKNOWN = "unknown"
SAMPLE = 4000
LEAST, CONFIRMED = 0.5, 0.6
#: Words of templates that are usual elsewhere too.
USUAL = frozenset("a and any are as by can code file form forms free in is it of or source subject terms the this to under use using with without work you your".split())


_WORD = r"[\p{L}0]+(?:[.+-][\p{L}0]+)*"


def grams(text: Column) -> Column:
    """Word 1- to 3-grams of a paragraph, each once."""
    words = _words(F.regexp_replace(F.lower(text), "[0-9]+", "0"))
    pairs = F.zip_with(words, F.slice(words, 2, 2**30), lambda a, b: F.concat_ws(" ", a, b))
    triples = F.zip_with(pairs, F.slice(words, 3, 2**30), lambda a, b: F.concat_ws(" ", a, b))
    n = F.size(words)
    return F.array_distinct(
        F.concat(
            words,
            F.slice(pairs, F.lit(1), F.greatest(n - 1, F.lit(0))),
            F.slice(triples, F.lit(1), F.greatest(n - 2, F.lit(0))),
        )
    )


def paragraphs(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, paragraph, text)`` of the lines that hold something."""
    numbered = docs.select("doc_id", common.text_or_empty().alias("_text"))
    # Equal rows have equal paragraphs, so it is enough to tell different ones apart.
    row = F.xxhash64("doc_id", "_text").alias("row")
    lines = numbered.select(row, "doc_id", F.posexplode(F.split("_text", "\n")).alias("paragraph", "text"))
    return lines.where("trim(text) <> ''")


def _constant(value: list, kind: str) -> Column:
    """A list as one literal."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _needed(template: list[str], confirmed: float) -> int:
    """How many of a template's n-grams a paragraph must hold."""
    return max(1, -int(-(confirmed * len(template) - 1e-9) // 1))


def _signs(templates: list[list[str]], confirmed: float) -> list[str]:
    """Words of which every text with a notice holds one: without them too few n-grams of any template are left."""
    found: set[str] = set()
    for template in templates:
        words = {w for g in template for w in g.split() if "0" not in w}
        left, signs = list(template), set()
        while len(left) >= _needed(template, confirmed) and words - signs:
            # Those of other templates first, then unusual and long ones, which few texts hold.
            best = max(words - signs, key=lambda w: (w in found, w not in USUAL and len(w) > 1, len(w), w))
            signs.add(best)
            left = [g for g in left if best not in g.split()]
        # A template of numbers alone would be found by any of its words.
        found |= signs if len(left) < _needed(template, confirmed) else {w[: w.find("0")] for g in template for w in g.split()}
    return sorted(found)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def _grams_by_line(docs: DataFrame, signs: list[str]) -> DataFrame:
    """``(row, doc_id, first, last, gram)`` of the texts with a sign: all n-grams, also over line ends.

    A line without words is a gram of its own, empty, and no other reaches over it.
    """
    lowered = F.lower(common.text_or_empty())
    texts = docs.select(F.xxhash64("doc_id", common.text_or_empty()).alias("row"), "doc_id", lowered.alias("_text"))
    lines = F.split(F.regexp_replace("_text", "[0-9]+", "0"), "\n")
    has_sign = reduce(Column.__or__, [F.contains("_text", F.lit(sign)) for sign in signs])
    texts = texts.where(has_sign).select("row", "doc_id", F.transform(lines, _words).alias("_lines"))

    def placed(words: Column, line: Column) -> Column:
        blank = F.array(F.struct(F.lit("").alias("w"), line.alias("l")))
        return F.when(F.size(words) == 0, blank).otherwise(F.transform(words, lambda w: F.struct(w.alias("w"), line.alias("l"))))

    texts = texts.select("row", "doc_id", F.flatten(F.transform("_lines", placed)).alias("_all"))
    following = [F.slice("_all", k, 2**31 - 1 - k) for k in (2, 3)]
    texts = texts.select("row", "doc_id", F.arrays_zip(F.col("_all").alias("a"), following[0].alias("b"), following[1].alias("c")).alias("_all"))
    rows = texts.select("row", "doc_id", F.explode("_all").alias("_at"))
    a, b, c = ((F.col(f"_at.{k}.w"), F.col(f"_at.{k}.l")) for k in "abc")
    two, three = (a[0] != "") & (b[0] != ""), (a[0] != "") & (b[0] != "") & (c[0] != "")
    nothing = F.lit(None).cast("struct<gram:string,first:int,last:int>")

    def gram(there: Column, *parts: tuple[Column, Column]) -> Column:
        made = F.struct(F.concat_ws(" ", *(w for w, _ in parts)).alias("gram"), a[1].alias("first"), parts[-1][1].alias("last"))
        return F.when(there, made).otherwise(nothing)

    each = F.array(gram(F.lit(True), a), gram(two, a, b), gram(three, a, b, c))
    return rows.select("row", "doc_id", F.inline(F.filter(each, lambda g: g.isNotNull()))).select("row", "doc_id", "first", "last", "gram")


def _lines_alone(hits: DataFrame, members: DataFrame, needs: Column) -> DataFrame:
    """``(row, doc_id, first, last)`` of single lines that hold the share of a template."""
    held = hits.where("first = last").join(F.broadcast(members), "id").groupBy("row", "doc_id", "first", "template")
    return held.agg(F.size(F.collect_set("place")).alias("n")).where(F.col("n") >= F.get(needs, F.col("template"))).select(
        "row", "doc_id", "first", F.col("first").alias("last")
    )


def _runs(hits: DataFrame, members: DataFrame, needs: Column, several: Column) -> DataFrame:
    """``(row, doc_id, first, last)`` of runs of several lines that hold the share of a template.

    ``several`` tells which n-grams of each template have more than one word.
    """
    told = hits.join(F.broadcast(members), "id")
    likely = told.groupBy("row", "doc_id", "template").agg(F.size(F.collect_set("place")).alias("n"))
    likely = likely.where(F.col("n") >= F.get(needs, F.col("template"))).drop("n")
    breaks = hits.where("id < 0").select("row", "doc_id", "first", "last")
    breaks = breaks.join(likely, ["row", "doc_id"]).withColumn("place", F.lit(-1))
    columns = ["row", "doc_id", "template", "last", "first", "place"]
    placed = told.join(likely, ["row", "doc_id", "template"], "left_semi").select(*columns).unionByName(breaks.select(*columns))
    listed = placed.groupBy("row", "doc_id", "template").agg(F.array_sort(F.collect_list(F.struct("last", "first", "place"))).alias("all"))
    need, long = F.get(needs, F.col("template")), F.get(several, F.col("template"))
    none = F.array_repeat(F.lit(-1), F.size(long))
    listed = listed.select("row", "doc_id", "all", need.alias("need"), long.alias("long"), none.alias("none"))

    def step(state: Column, hit: Column) -> Column:
        place = hit["place"]
        at = F.when(place < 0, F.col("none")).otherwise(
            F.transform(state["at"], lambda x, i: F.when(i == place, F.greatest(x, hit["first"])).otherwise(x))
        )
        start, before = F.get(F.sort_array(at, False), F.col("need") - 1), F.get(state["at"], place)
        # A run is new where its last line brings in an n-gram that it didn't hold, and so does its first.
        useful = F.transform(at, lambda x, i: F.when((x == start) | ((x < start) & F.get(F.col("long"), i)), x))
        firsts = F.array_distinct(F.filter(useful, lambda x: (x >= 0) & (x < hit["last"]) & (x > before)))
        runs = F.transform(firsts, lambda x: F.struct(x.alias("first"), hit["last"].alias("last")))
        out = F.when((place >= 0) & (start >= 0) & (F.size(runs) > 0), F.concat(state["out"], runs)).otherwise(state["out"])
        return F.struct(at.alias("at"), out.alias("out"))

    begin = F.struct(F.col("none").alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))
    found = listed.select("row", "doc_id", F.inline(F.aggregate("all", begin, step, lambda state: state["out"])))
    return found.select("row", "doc_id", "first", "last").distinct()


def _apart(found: DataFrame) -> DataFrame:
    """Notices that don't overlap: of fewest lines first, then the most similar, then the first."""
    order = F.struct("n_lines", (-F.col("similarity")).alias("far"), "paragraph", "family", "score", "similarity")
    listed = found.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(order)).alias("all"))
    kind = listed.schema["all"].dataType.simpleString()

    def step(kept: Column, one: Column) -> Column:
        end = one["paragraph"] + one["n_lines"]
        met = F.exists(kept, lambda k: (k["paragraph"] < end) & (one["paragraph"] < k["paragraph"] + k["n_lines"]))
        return F.when((one["n_lines"] > 1) & met, kept).otherwise(F.concat(kept, F.array(one)))

    kept = F.aggregate("all", F.array().cast(kind), step)
    return listed.select("row", "doc_id", F.explode(kept).alias("_one")).select("row", "doc_id", "_one.*")


def _templates(spark: SparkSession) -> DataFrame:
    pairs = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    rows = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in pairs))
    return spark.range(1).select(F.inline(rows))


def _training(docs: DataFrame, sample: int) -> DataFrame:
    """``(label, grams, drawn)``: notices, and paragraphs of the corpus that don't resemble one."""
    spark = docs.sparkSession
    notices = _templates(spark).withColumn("opening", F.explode(F.array(*map(F.lit, OPENINGS))))
    notices = notices.withColumn("closing", F.explode(F.array(*map(F.lit, CLOSINGS))))
    known = notices.select(F.col("family").alias("label"), grams(F.concat("opening", "text", "closing")).alias("grams"))
    # Drawn by document first, so that few texts are cut into paragraphs.
    n = docs.count()
    few = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit((1 << 30) * min(1.0, sample / 4 / max(n, 1))))
    lines = paragraphs(few).select("text").distinct()
    drawn = lines.orderBy(F.xxhash64("text"), "text").limit(sample).select(grams(F.col("text")).alias("grams"))
    of_templates = [g for family in _template_grams(spark).values() for g in family]
    lists = _constant(of_templates, "array<array<string>>")
    alike = F.exists(lists, lambda g: F.size(F.array_intersect(F.col("grams"), g)) * 2 >= F.size(g))
    others = drawn.where(~alike).select(F.lit(UNKNOWN).alias("label"), "grams")
    return known.unionByName(others).withColumn("drawn", F.pmod(F.xxhash64("grams"), F.lit(5)))


def _template_grams(spark: SparkSession) -> dict[str, list[list[str]]]:
    """N-grams of each family's templates; as many rows as TEMPLATES has."""
    found: dict[str, list[list[str]]] = {}
    for row in _templates(spark).select("family", grams(F.col("text")).alias("g")).collect():
        found.setdefault(row["family"], []).append(row["g"])
    return found


def _vectors(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Rows with their n-grams as ``features``; in one part, since it is a bounded sample and read dozens of times."""
    return CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", binary=True).transform(rows).coalesce(1)


def _regression(rows: DataFrame, vocabulary: list[str]) -> tuple[list[str], LogisticRegressionModel]:
    """The elastic-net regression over all of ``vocabulary``, and the n-grams it was learnt on.

    Most n-grams end without a weight, but in the learner each costs the driver dozens of numbers a class. So
    it begins with those of the notices, and takes in the others whose gradient exceeds the L1 penalty, until there is none: then
    the weight of every other is zero where the objective over all is least.
    """
    learner = LogisticRegression(
        labelCol="place", featuresCol="features", family="multinomial", regParam=0.0005, elasticNetParam=0.7, maxIter=50, standardization=False
    )
    penalty = learner.getRegParam() * learner.getElasticNetParam() * rows.count()
    of_notices = rows.where(F.col("label") != UNKNOWN).select(F.explode("grams").alias("gram")).distinct()
    first = {r["gram"] for r in of_notices.collect()}  # as many as TEMPLATES has
    used = [g for g in vocabulary if g in first]
    while True:
        model = learner.fit(_vectors(rows, used))
        taken = set(used)
        others = [(g,) for g in vocabulary if g not in taken]
        if not others:
            return used, model
        others = rows.sparkSession.createDataFrame(others, "gram string")
        told = model.transform(_vectors(rows, used)).select("grams", "place", vector_to_array("probability").alias("p"))
        off = [F.get("p", F.lit(k)) - (F.col("place") == k).cast("double") for k in range(model.numClasses)]
        told = told.select(F.explode("grams").alias("gram"), *(c.alias(f"_{k}") for k, c in enumerate(off)))
        slope = F.greatest(*(F.abs(F.sum(f"_{k}")) for k in range(model.numClasses)), F.lit(0.0))
        slopes = told.join(F.broadcast(others), "gram").groupBy("gram").agg(slope.alias("slope"))
        steep = {r["gram"] for r in slopes.where(F.col("slope") > penalty).select("gram").collect()}
        if not steep:
            return used, model
        used = [g for g in vocabulary if g in taken or g in steep]


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[tuple[str, int, float]], list[float], float]:
    """Labels, weights ``(gram, label, weight)``, biases and the temperature."""
    rows = common.written(_training(docs, sample), "notices")
    labels = [r["label"] for r in rows.select("label").distinct().orderBy("label").collect()]  # the families
    place = F.array_position(F.array(*map(F.lit, labels)), F.col("label")).cast("double") - 1
    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=1 << 16, minDF=2, binary=True).fit(rows).vocabulary
    placed = rows.withColumn("place", place)
    used, model = _regression(placed.where("drawn <> 4"), vocabulary)
    matrix = model.coefficientMatrix.toArray()
    weights = [(gram, k, float(matrix[k, i])) for i, gram in enumerate(used) for k in range(matrix.shape[0]) if abs(matrix[k, i]) > 1e-9]
    bias = [float(x) for x in model.interceptVector.toArray()]
    held = model.transform(_vectors(placed.where("drawn = 4"), used)).select(
        F.col("place").cast("int").alias("place"), vector_to_array("rawPrediction").alias("raw")
    )
    grid = [0.05 * 1.15**i for i in range(44)]
    scaled = held.withColumn("t", F.explode(F.array(*map(F.lit, grid))))
    total = F.log(F.aggregate("raw", F.lit(0.0), lambda s, x: s + F.exp((x - F.array_max("raw")) / F.col("t"))))
    # One error beyond those seen is reckoned with, so that few samples don't look certain.
    slip = 1.0 / (held.count() + 2)
    below = F.transform("raw", lambda x: x - F.array_max("raw"))
    own = F.get(below, F.col("place"))
    others = (F.aggregate(below, F.lit(0.0), lambda s, x: s + x) - own) / max(len(labels) - 1, 1)
    loss = total - (own * (1 - slip) + others * slip) / F.col("t")
    best = scaled.groupBy("t").agg(F.avg(loss).alias("loss")).orderBy("loss", "t").first()
    return labels[: matrix.shape[0]], weights, bias, float(best["t"]) if best else 1.0


def notices(docs: DataFrame, sample: int = SAMPLE, least: float = LEAST, confirmed: float = CONFIRMED) -> DataFrame:
    """``(doc_id, paragraph, family, score, similarity)`` of the paragraphs that are licence notices."""
    spark = docs.sparkSession
    labels, weights, bias, temperature = fit(docs, sample)
    by_gram: dict[str, list[float]] = {}
    for gram, k, weight in weights:
        by_gram.setdefault(gram, [0.0] * len(labels))[k] = weight
    all_grams = _template_grams(spark)
    for templates in all_grams.values():
        for gram in (g for template in templates for g in template if " " in g):
            by_gram.setdefault(gram, [0.0] * len(labels))  # needed to compare with templates
    of_templates = {f: [[g for g in t if g in by_gram] for t in texts] for f, texts in all_grams.items()}
    flat = [t for texts in of_templates.values() for t in texts]
    number = {gram: i for i, gram in enumerate(by_gram)}
    rows = [{"gram": g, "id": i, "w": by_gram[g]} for g, i in number.items()]
    # As tables, so that plans don't carry the lists along.
    known = spark.range(1).select(F.inline(_constant(rows, "array<struct<gram:string,id:int,w:array<double>>>")))
    known = common.written(known, "licence-weights")
    # A line without words is told by an id of its own.
    told = known.select("gram", "id").unionByName(spark.range(1).select(F.lit("").alias("gram"), F.lit(-1).alias("id")))
    hits = _grams_by_line(docs, _signs(flat, confirmed)).join(F.broadcast(told), "gram").select("row", "doc_id", "first", "last", "id")
    hits = common.written(hits, "licence-grams")

    places = [{"id": number[g], "template": t, "place": k} for t, of in enumerate(flat) for k, g in enumerate(of)]
    members = spark.range(1).select(F.inline(_constant(places, "array<struct<id:int,template:int,place:int>>")))
    members = common.written(members, "licence-templates")
    needs = _constant([_needed(t, confirmed) for t in flat], "array<int>")
    several = _constant([[" " in g for g in t] for t in flat], "array<array<boolean>>")
    runs = _lines_alone(hits, members, needs).unionByName(_runs(hits, members, needs, several))
    runs = common.written(runs.distinct().withColumnsRenamed({"first": "paragraph", "last": "end"}), "licence-runs")

    inside = runs.join(hits.where("id >= 0"), ["row", "doc_id"]).where("first >= paragraph AND last <= end")
    run = ["row", "doc_id", "paragraph", "end"]
    held = inside.select(*run, "id").distinct().join(F.broadcast(known.select("id", "w")), "id")
    sums = [F.sum(F.get("w", F.lit(k))).alias(f"_{k}") for k in range(len(labels))]
    of_run = held.groupBy(*run).agg(*sums, F.collect_set("id").alias("held"))
    logit = F.array(*((F.col(f"_{k}") + F.lit(bias[k])) / F.lit(temperature) for k in range(len(labels))))
    scored = of_run.withColumn("logit", logit).withColumn("top", F.array_max("logit"))
    norm = F.aggregate("logit", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    best = F.array_position("logit", F.col("top")).cast("int") - 1
    family = F.get(F.array(*map(F.lit, labels)), best).alias("family")
    n_lines = (F.col("end") - F.col("paragraph") + 1).alias("n_lines")
    told = scored.select("row", "doc_id", "paragraph", n_lines, "held", family, (F.lit(1.0) / norm).alias("score"))
    told = told.where((F.col("family") != UNKNOWN) & (F.col("score") >= least))
    # The share of each template of the family, of the n-grams that were counted; the greatest counts.
    families = _constant([f for f, texts in of_templates.items() for _ in texts], "array<string>")
    lengths = _constant([len(t) for t in flat], "array<int>")
    listed = told.select("row", "doc_id", "paragraph", "n_lines", "family", "score", F.explode("held").alias("id"))
    of_template = listed.join(F.broadcast(members), "id").where(F.get(families, F.col("template")) == F.col("family"))
    of_template = of_template.groupBy("row", "doc_id", "paragraph", "n_lines", "family", "score", "template").agg(F.count(F.lit(1)).alias("n"))
    alike = F.max(F.col("n") / F.get(lengths, F.col("template")).cast("double")).alias("similarity")
    similar = of_template.groupBy("row", "doc_id", "paragraph", "n_lines", "family", "score").agg(alike)
    found = common.written(_apart(similar.where(F.col("similarity") >= confirmed)), "licence-notices")
    # Equal rows have equal n-grams, which were counted once.
    rows = docs.select(F.xxhash64("doc_id", common.text_or_empty()).alias("row"))
    copies = rows.join(found.select("row").distinct(), "row", "left_semi").groupBy("row").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    each = found.join(copies, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("doc_id", "paragraph", "family", "score", "similarity")


def op7_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
