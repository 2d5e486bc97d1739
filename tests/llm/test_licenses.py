from __future__ import annotations

import random

import regex as re
from pyspark.ml.classification import LogisticRegression

from authorlink.llm import licenses
from tests.llm.conftest import rows_of
from tests.llm.texts import documents, prose


def test_notices_are_found_and_prose_is_not(spark, folder):
    notices = {
        "MIT": "Released under the MIT License.",
        "GPL": "This work is licensed under the GNU General Public License, version 2.",
        "Apache": "Licensed under the Apache License, Version 2.0.",
        "CC": "LICENSED UNDER CC BY-NC 4.0.",
    }
    docs = [*documents(), *((1000 + i, prose(60, 500 + i)) for i in range(150))]
    docs.append((5000, "the license of the river and its version\nunder the terms of the meadow"))
    for k, (family, text) in enumerate(notices.items()):
        docs.append((6000 + k, f"{prose(30, k).replace(chr(10), ' ')}\n{text}\n{prose(20, 90 + k)}"))
    docs.append((7000, notices["MIT"]))
    docs.append((7000, notices["MIT"]))
    out = rows_of(licenses.op7_license_notices(spark, folder(docs, extra=True)))
    found = {(doc_id, paragraph): family for doc_id, paragraph, family, _, _ in out}
    assert found == {**{(6000 + k, 1): family for k, family in enumerate(notices)}, (7000, 0): "MIT"}
    assert all(0.5 <= score <= 1 and similarity >= 0.6 for *_, score, similarity in out)


def test_equal_rows_are_scored_as_one_and_listed_each(spark, folder):
    docs = [*documents(), *((1000 + i, prose(60, 500 + i)) for i in range(150))]
    text = f"{prose(9, 1)}\nReleased under the MIT License.\nthe license of the river"
    docs += [(7000, text), *[(7001, text)] * 5]
    out = rows_of(licenses.op7_license_notices(spark, folder(docs)))
    single = [r[1:] for r in out if r[0] == 7000]
    copies = [r[1:] for r in out if r[0] == 7001]
    assert len(single) == 1 and len(copies) == 5 and len(out) == 6
    for paragraph, family, score, similarity in copies:
        assert (paragraph, family, similarity) == (*single[0][:2], single[0][3])
        assert abs(score - single[0][2]) < 1e-12


def test_wrapped_headers_are_found_once(spark, folder):
    headers = {
        "GPL": "# This program is free software: you can redistribute it and/or modify\n"
        "# it under the terms of the GNU General Public License as published by\n"
        "# the Free Software Foundation, either version 3 of the License, or",
        "LGPL": " * This library is free software; you can redistribute it and/or\n"
        " * modify it under the terms of the GNU Lesser General Public\n"
        " * License as published by the Free Software Foundation; either",
        "BSD": "// Redistribution and use in source and binary\n// forms, with or without modification, are\n// permitted provided that the following",
        "MIT": "Permission is hereby granted, free of\ncharge, to any person obtaining a copy\nof this software and associated documentation",
    }
    docs = [*documents(), *((1000 + i, prose(60, 500 + i)) for i in range(150))]
    for k, text in enumerate(headers.values()):
        docs.append((6000 + k, f"{prose(9, k)}\n\n{text}\n\n{prose(20, 90 + k)}"))
        # A blank line parts them.
        docs.append((7000 + k, text.replace("\n", "\n\n").replace("it under the terms of the", "it")) if k == 0 else (7000 + k, prose(30, k)))
    out = rows_of(licenses.op7_license_notices(spark, folder(docs)))
    assert sorted((r[0], r[2]) for r in out) == [(6000 + k, family) for k, family in enumerate(headers)]
    assert all(similarity >= 0.6 and score >= 0.5 for *_, score, similarity in out)


_LONG = "Redistribution and use in source and binary forms, with or without modification, are permitted"


def test_notices_of_any_number_of_lines(spark, folder):
    docs = [*documents(), *((1000 + i, prose(60, 500 + i)) for i in range(150))]
    words = _LONG.split()
    docs.append((6000, "first\n\n" + "\n".join(words) + "\n\nlast"))  # a word a line
    docs.append((6001, "first\n\n" + "\n\n".join(words)))  # blank lines part them
    docs.append((6002, "\n".join(f"{_LONG}\nof the river" for _ in range(40))))
    out = rows_of(licenses.op7_license_notices(spark, folder(docs)))
    assert [r[2] for r in out if r[0] == 6000] == ["BSD"]
    assert not [r for r in out if r[0] == 6001]
    assert sorted(r[1] for r in out if r[0] == 6002) == list(range(0, 80, 2))


def _held(lines, template):
    words = [re.findall(licenses._WORD, re.sub("[0-9]+", "0", line.lower())) for line in lines]
    if any(not w for w in words):
        return 0
    flat = [w for line in words for w in line]
    found = {" ".join(flat[i : i + k]) for k in (1, 2, 3) for i in range(len(flat) - k + 1)}
    return len(found & set(template))


def test_shortest_runs_against_brute_force(spark):
    """Every run of lines that holds the share of a template, and no shorter one with the same last line, is a candidate."""
    r = random.Random(6)
    templates = [["a", "b", "c", "a b", "b c", "a b c"], ["c", "d", "c d", "d e", "c d e", "e"]]
    texts = ["\n".join(" ".join(r.choice("abcdex") for _ in range(r.randrange(4))) for _ in range(r.randrange(1, 14))) for _ in range(120)]
    number = {g: i for i, g in enumerate(sorted({g for t in templates for g in t}))}
    needs = [licenses._needed(t, 0.6) for t in templates]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = spark.createDataFrame([*number.items(), ("", -1)], "gram string, id int")
    hits = licenses._grams_by_line(docs, [""]).join(told, "gram").drop("gram")
    members = spark.createDataFrame([(number[g], t, k) for t, of in enumerate(templates) for k, g in enumerate(of)], "id int, template int, place int")
    several = [[" " in g for g in t] for t in templates]
    constants = [licenses._constant(needs, "array<int>"), licenses._constant(several, "array<array<boolean>>")]
    found = {(d, f, e) for _, d, f, e in rows_of(licenses._runs(hits, members, *constants))}
    found |= {(d, f, e) for _, d, f, e in rows_of(licenses._lines_alone(hits, members, constants[0]))}
    shortest, holding = set(), set()
    for d, text in enumerate(texts):
        lines = text.split("\n")
        for end in range(len(lines)):
            for first in range(end, -1, -1):
                for t, template in enumerate(templates):
                    if _held(lines[first : end + 1], template) >= needs[t]:
                        holding.add((d, first, end))
                        # The last line belongs to it, and so does the first.
                        if (first == end or _held(lines[first:end], template) < needs[t]) and (
                            first == end or _held(lines[first + 1 : end + 1], template) < needs[t]
                        ):
                            shortest.add((t, d, first, end))
    least = {x[1:] for x in shortest if not any(x[:2] == y[:2] and x[3] == y[3] and x[2] < y[2] for y in shortest)}
    assert least <= found <= holding and len(least) > 50


def test_signs_are_in_every_text_that_can_hold_a_notice(spark):
    of_family = licenses._template_grams(spark)
    templates = [t for texts in of_family.values() for t in texts]
    signs = licenses._signs(templates, licenses.CONFIRMED)
    r = random.Random(2)
    for template in templates:
        words = [g for g in template if " " not in g]
        for _ in range(200):
            some = " ".join(w for w in words if r.random() < 0.8)
            if _held([some], template) >= licenses._needed(template, licenses.CONFIRMED):
                assert any(sign in some for sign in signs)


def test_ngrams(spark):
    df = spark.createDataFrame([("A B-C 12 a",), ("one",), ("",)], "t string")
    assert [r[0] for r in df.select(licenses.grams(df.t)).collect()] == [
        ["a", "b-c", "0", "a b-c", "b-c 0", "0 a", "a b-c 0", "b-c 0 a"],
        ["one"],
        [],
    ]


def test_empty_table(spark, folder):
    assert licenses.op7_license_notices(spark, folder([])).count() == 0


def test_learner_holds_few_ngrams_and_is_as_good_as_on_all(spark, folder, monkeypatch):
    learnt, fit = [], LogisticRegression.fit

    def recorded(self, rows):
        learnt.append((fit(self, rows), rows, self))
        return learnt[-1][0]

    monkeypatch.setattr(LogisticRegression, "fit", recorded)
    draw = random.Random(7)
    words = ["".join(draw.choices("bcdfghjklmn", k=5)) for _ in range(60)]
    # One word that is in many paragraphs without being one of a template, so that it has to be taken in.
    lines = [" ".join(draw.choices(words, k=12)) + (" of the license quorzel" if i % 3 else "") for i in range(600)]
    path = folder([(i, line) for i, line in enumerate(lines)])
    _, weights, _, _ = licenses.fit(spark.read.parquet(f"{path}/documents.parquet"), sample=4000)
    model, _, learner = learnt[-1]
    assert model.numFeatures <= 1000 and weights
    # The same rows with all n-grams: the objective is not lower.
    rows = licenses._training(spark.read.parquet(f"{path}/documents.parquet"), 4000).where("drawn <> 4")
    labels = sorted({r["label"] for r in rows.select("label").distinct().collect()})
    rows = rows.select("grams", licenses.F.array_position(licenses.F.array(*map(licenses.F.lit, labels)), licenses.F.col("label")).cast("double").alias("place"))
    rows = rows.withColumn("place", licenses.F.col("place") - 1)
    counted = licenses.CountVectorizer(inputCol="grams", outputCol="features", minDF=2, binary=True).fit(rows)
    assert len(counted.vocabulary) > 2 * model.numFeatures
    whole = fit(learner, counted.transform(rows).coalesce(1))
    assert model.summary.objectiveHistory[-1] <= whole.summary.objectiveHistory[-1] * 1.01
