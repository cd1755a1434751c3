"""Licence scans: a paragraph classifier over sparse word n-grams, confirmed against templates.

Paragraphs are compared with the word pairs of licence templates. A multinomial logistic regression
over these pairs names the licence family or "unknown", and a prediction counts as confirmed if
the paragraph also resembles a template of that family. Pairs that no template has carry no
weight, so scoring is a join of a paragraph's pairs with a small table and a sum.

A paragraph is a line, or the lines of a hard-wrapped block of text, comment marks included: a
notice is found whether it stands on one line or is wrapped at any width from 40 code points on.
"""

from __future__ import annotations

import json
import math
import re
import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

UNKNOWN = "unknown"
#: The notices by which public licences ask to be named.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
    ),
    ("bsd", "Licensed under the BSD 3-Clause License."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("isc", "Licensed under the ISC License."),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Pairs of two such words say nothing about licences and are no grams.
STOP_WORDS = (
    "a an and any are as at be but by can do for from has have he in is it may no not of on or other that the this "
    "to was which will with you"
).split()
NOT_WORD = r"[^a-z0-9\u0080-\uffff]+"
#: Lines of so many code points may go on in the next one; shorter and longer ones are not wrapped.
WRAPPED = (40, 200)
#: How a line ends that goes on: in a word, closing marks after it, or an initial, not in a full stop.
GOES_ON = r"""(?:[\p{L}\p{N}][\s,;:)\]"'*/#-]*|(?<![\p{L}\p{N}])\p{L}\.)$"""
HAS_WORD = r"[\p{L}\p{N}]"
#: Comment marks that are words, before the text of a line.
COMMENT = r"^\s*(?:dnl|DNL|rem|REM)\s"


def table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A few rows the driver holds, as a literal in the plan."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")
    return spark.range(1).select(F.inline(parsed))


def paragraphs_of(text: Column) -> Column:
    """The paragraphs of a text: its lines, those of hard-wrapped blocks joined by a blank.

    A line is joined with the one before if that one has a ``WRAPPED`` length and ends as
    ``GOES_ON`` says, and this one has a word: blank lines and lines of marks alone part paragraphs.
    """

    def with_break(line: Column, after: Column) -> Column:
        end = F.rtrim(line)
        wrapped = F.length(line).between(*WRAPPED) & F.substring(end, -16, 16).rlike(GOES_ON) & after.rlike(HAS_WORD)
        return F.concat(F.regexp_replace(line, COMMENT, ""), F.when(wrapped, " ").when(after.isNotNull(), "\n").otherwise(""))

    lines = F.split(text, "\n")
    return F.split(F.array_join(F.zip_with(lines, F.slice(lines, 2, 2**31 - 2), with_break), ""), "\n")


def grams_of(paragraph: Column) -> Column:
    """The distinct word pairs of a paragraph, without those of two stop words."""
    words = F.filter(F.split(F.lower(paragraph), NOT_WORD), lambda w: w != "")

    def pair(a: Column, b: Column) -> Column:
        return F.when(~(a.isin(STOP_WORDS) & b.isin(STOP_WORDS)), F.concat(a, F.lit(" "), b))

    return F.array_distinct(F.array_compact(F.zip_with(words, F.slice(words, 2, 2**31 - 2), pair)))


def grams_of_text(text: str) -> list[str]:
    """The same for a template, on the driver."""
    words = [w for w in re.split(NOT_WORD, text.lower()) if w]
    pairs = zip(words, words[1:], strict=False)
    return list(dict.fromkeys(f"{a} {b}" for a, b in pairs if not (a in STOP_WORDS and b in STOP_WORDS)))


@dataclass
class Licences:
    """Families, template n-grams, and the weights of every n-gram by class (the last is unknown).

    ``calibrated`` says whether the calibrating quarter of the sample had rows of both kinds.
    """

    families: list[str]
    templates: list[tuple[str, list[str]]]
    grams: list[str]
    weights: list[list[float]]
    intercept: list[float]
    calibrated: bool = False


def untrained(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Licences:
    families = sorted({f for f, _ in templates})
    made = [(f, grams_of_text(t)) for f, t in templates]
    grams = sorted({g for _, some in made for g in some})
    return Licences(families, made, grams, [[0.0] * (len(families) + 1)] * len(grams), [0.0] * (len(families) + 1))


def any_gram(grams: list[str]) -> str:
    """A pattern that finds whether a lower-cased paragraph holds any of some word pairs.

    Pairs are grouped by their first letter and word, so that most words are passed over at once.
    """
    seconds: dict[str, list[str]] = {}
    for gram in sorted(grams):
        first, _, second = gram.partition(" ")
        seconds.setdefault(first, []).append(second)
    letters: dict[str, list[str]] = {}
    for first, after in seconds.items():
        letters.setdefault(first[0], []).append(f"{first[1:]}{NOT_WORD}(?:{'|'.join(after)})")
    words = "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in letters.items())
    return f"(?:^|{NOT_WORD[:-1]})(?:{words})(?![{NOT_WORD[2:-2]}])"


def _hits(rows: DataFrame, model: Licences, *extra: Column) -> DataFrame:
    """Per paragraph of ``rows (_row, _id, _text)`` that shares a gram with a template: sums by class and template.

    One pass: paragraphs are exploded into grams, which meet the table of template grams (a
    broadcast whose size the templates fix); sums per paragraph are combined before the shuffle.
    The first paragraph of a row has one gram more, empty, so that every row is in the result.
    """
    of_gram: dict[str, list[int]] = {g: [] for g in model.grams}
    for i, (_, some) in enumerate(model.templates):
        for g in some:
            of_gram[g].append(i)
    classes = range(len(model.families) + 1)
    known = [{"gram": "", "id": -1, "w": [0.0 for _ in classes], "t": []}]
    known += [{"gram": g, "id": i, "w": w, "t": of_gram[g]} for i, (g, w) in enumerate(zip(model.grams, model.weights, strict=True))]
    grams = table(rows.sparkSession, known, "gram:string,id:int,w:array<double>,t:array<int>")
    # Cut and counted before they are exploded: what stands beside a generator is worked out for every row it makes.
    cut = rows.select("_row", "_id", paragraphs_of(F.col("_text")).alias("_cut"))
    counted = cut.select("_row", "_id", F.coalesce(F.size("_cut"), F.lit(0)).alias("_n"), F.coalesce("_cut", F.array(F.lit(""))).alias("_cut"))
    paragraphs = counted.select("_row", "_id", F.greatest("_n", F.lit(0)).alias("_n"), F.posexplode("_cut").alias("_at", "_paragraph"))
    first = F.when(F.col("_at") == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    # Only paragraphs with a gram of some template are cut into grams: the others share none.
    shares = F.lower("_paragraph").rlike(any_gram(model.grams))
    here = F.when(shares, grams_of(F.col("_paragraph"))).otherwise(F.array().cast("array<string>"))
    spread = paragraphs.select("_row", "_id", "_n", "_at", F.explode(F.concat(first, here)).alias("gram"))
    return spread.join(F.broadcast(grams), "gram").groupBy("_row", "_id", "_n", "_at").agg(
        F.max("id").alias("last"),
        *extra,
        *[F.sum(F.element_at("w", k + 1)).alias(f"w{k}") for k in classes],
        *[F.sum(F.array_contains("t", i).cast("int")).alias(f"t{i}") for i in range(len(model.templates))],
    )


def _judged(hits: DataFrame, model: Licences, confirm: float) -> DataFrame:
    """Adds the ``family`` predicted, its probability ``p`` and ``similarity`` to templates, and ``confirmed``.

    Plain columns per class, each level in a projection of its own, so that nothing is worked out twice.
    """
    classes = [*model.families, UNKNOWN]
    ids = range(len(classes))
    scored = hits.withColumns({f"l{k}": F.col(f"w{k}") + F.lit(model.intercept[k]) for k in ids})
    scored = scored.withColumn("top", F.greatest(*[F.col(f"l{k}") for k in ids]))
    total = reduce(Column.__add__, [F.exp(F.col(f"l{k}") - F.col("top")) for k in ids])
    # A paragraph that shares nothing with any template is unknown, and so is a tie with unknown.
    best = F.lit(UNKNOWN)
    for k in reversed(ids[:-1]):
        best = F.when((F.col(f"l{k}") == F.col("top")) & (F.col(f"l{ids[-1]}") < F.col("top")), classes[k]).otherwise(best)
    scored = scored.withColumns({"p": 1 / total, "family": F.when(F.col("last") >= 0, best).otherwise(F.lit(UNKNOWN))})
    similarity = F.lit(0.0)
    for family in model.families:
        own = [F.col(f"t{i}") / len(g) for i, (f, g) in enumerate(model.templates) if f == family]
        similarity = F.when(F.col("family") == family, F.greatest(*own, F.lit(0.0))).otherwise(similarity)
    scored = scored.withColumn("similarity", similarity)
    return scored.withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("similarity") >= confirm))


def template_runs(model: Licences, templates: tuple[tuple[str, str], ...]) -> list[dict]:
    """Beginnings and ends of the templates as examples; every fourth one is held for calibration.

    They are labelled as sampled paragraphs are: by the largest share of a template they hold.
    """
    number = {g: i for i, g in enumerate(model.grams)}
    out = []
    for _, text in templates:
        words = text.split()
        for run in [part for k in range(1, len(words)) for part in (words[:k], words[k:])]:
            here = {g for g in grams_of_text(" ".join(run)) if g in number}
            share, family = max((len(here & set(g)) / len(g), f) for f, g in model.templates)
            if not 0.5 <= share < 0.9:
                label = float(model.families.index(family) if share >= 0.9 else len(model.families))
                out.append({"ids": sorted(number[g] for g in here), "label": label, "held": len(out) % 4 == 0})
    return out


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    sample_docs: int = 4000,
    sample_rows: int = 4000,
) -> Licences:
    """The classifier, trained on variants and parts of the templates and a bounded sample of paragraphs.

    The sample is drawn from the whole texts of at most ``sample_docs`` ids in hash order: at most
    ``sample_rows`` of their paragraphs that share a gram with a template. One that holds nine tenths of a template is an example of its
    family, one that holds less than half of any is unknown; others are left out. A quarter of the
    sample and of the parts calibrates the unknown class: its intercept is moved until the expected number of
    unknown paragraphs is the true one. Where that quarter has one kind only, or no row, there is
    nothing to calibrate by: the intercept stays, a warning says so and ``calibrated`` is false.
    """
    model = untrained(templates)
    spark, families = docs.sparkSession, model.families
    ids = F.array_sort(F.collect_list(F.when(F.col("id") >= 0, F.col("id")))).alias("ids")
    name = docs[id_col].alias("_own")
    drawn = docs.select(name).dropna().orderBy(F.xxhash64("_own"), "_own").limit(sample_docs).distinct()
    drawn_docs = docs.join(F.broadcast(drawn), docs[id_col] == drawn["_own"], "left_semi")
    rows = _numbered(drawn_docs, F.lit(None).cast("string"), text_col)
    hits = _hits(rows, model, ids).where("last >= 0")
    alike = [F.struct((F.col(f"t{i}") / len(g)).alias("s"), F.lit(families.index(f)).alias("f")) for i, (f, g) in enumerate(model.templates)]
    sample = hits.select("ids", F.array_max(F.array(*alike)).alias("best"), F.xxhash64("_row", "_at", F.lit(5)).alias("h"))
    sample = cut_lineage(sample.orderBy("h", "ids").limit(sample_rows))
    label = F.when(F.col("best.s") >= 0.9, F.col("best.f")).when(F.col("best.s") < 0.5, F.lit(len(families)))
    found = sample.select("ids", label.cast("double").alias("label"), (F.pmod("h", F.lit(4)) == 0).alias("held")).dropna()

    number = {g: i for i, g in enumerate(model.grams)}
    made = [{"ids": [], "label": float(len(families)), "held": False}] * 20
    for family, text in templates:
        words = text.split()
        variants = [text, *[" ".join(words[:k] + words[k + 1 :]) for k in range(len(words))]]
        made += [
            {"ids": sorted(number[g] for g in grams_of_text(v) if g in number), "label": float(families.index(family)), "held": False}
            for v in variants
        ]
    made += template_runs(model, templates)
    examples = found.union(table(spark, made, "ids:array<int>,label:double,held:boolean"))
    flags = F.transform(F.sequence(F.lit(0), F.lit(len(model.grams) - 1)), lambda i: F.array_contains("ids", i).cast("double"))
    examples = cut_lineage(examples).withColumn("features", array_to_vector(flags))
    fitted = LogisticRegression(family="multinomial", maxIter=60, regParam=0.001, elasticNetParam=0.5).fit(examples.where("not held"))

    weights = fitted.coefficientMatrix.toArray()
    size = len(families) + 1
    model.weights = [[round(float(weights[k, g]), 6) for k in range(size)] for g in range(len(model.grams))]
    model.intercept = [round(float(x), 6) for x in fitted.interceptVector.toArray()]
    held = [(r.label, r.ids) for r in examples.where("held").select("label", "ids").collect()]
    unknown = sum(label == len(families) for label, _ in held)
    model.calibrated = 0 < unknown < len(held)
    if model.calibrated:
        model.intercept[-1] += _shift(model, held)
    else:
        warnings.warn(f"licences not calibrated: {unknown} of {len(held)} held paragraphs are unknown", stacklevel=2)
    return model


def _shift(model: Licences, held: list) -> float:
    """How far to move the intercept of "unknown" so that as many are expected as there are."""
    unknown = len(model.families)
    true = sum(label == unknown for label, _ in held)
    logits = [[b + sum(model.weights[g][k] for g in ids) for k, b in enumerate(model.intercept)] for _, ids in held]

    def expected(move: float) -> float:
        total = 0.0
        for row in logits:
            rest = sum(math.exp(min(700, x - row[unknown] - move)) for x in row[:unknown])
            total += 1 / (1 + rest)
        return total

    low, high = -5.0, 5.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if expected(middle) < true else (low, middle)
    return low


def scan_licences(
    docs: DataFrame,
    model: Licences,
    id_col: str = "doc_id",
    text_col: str = "text",
    confirm: float = 0.7,
) -> DataFrame:
    """Per row: the id, ``n_paragraphs``, and ``findings`` of whole texts.

    ``findings`` are the paragraphs (``paragraphs_of``) predicted to be of a licence family, in
    order: ``paragraph`` (its number), ``family``, ``p``, ``similarity`` and ``confirmed``. Of
    families with the same score the first in order of names is taken, and a tie with unknown is
    unknown. A null text has no
    paragraphs, an empty one has one that is empty. Repeated rows and null ids each keep their
    row; an empty table gives none; other columns are not looked at.
    """
    judged = _judged(_hits(_numbered(docs, docs[id_col], text_col), model), model, confirm)
    finding = F.struct(F.col("_at").alias("paragraph"), "family", "p", "similarity", "confirmed")
    return judged.groupBy("_row", "_id", "_n").agg(
        F.array_sort(F.collect_list(F.when(F.col("family") != UNKNOWN, finding))).alias("findings")
    ).select(F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_paragraphs"), "findings")


def _numbered(docs: DataFrame, name: Column, text_col: str) -> DataFrame:
    """Rows with a number of their own, so that repeated ids and texts stay apart."""
    return docs.select(
        F.monotonically_increasing_id().alias("_row"), name.alias("_id"), docs[text_col].cast("string").alias("_text")
    )
