import math
import random
import textwrap

import pytest
import regex
from pyspark.sql import functions as F

from tallyloom.llm import license_scan
from tallyloom.llm.license_scan import TEMPLATES, scan_licences

NOTICES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache",
    "Released under the MIT License.": "mit",
}


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def findings(df):
    return {r.doc_id: [(f.paragraph, f.family, f.confirmed) for f in r.findings] for r in df.collect()}


def test_notices_in_documents(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = findings(scan_licences(docs, model))
    for r in docs.collect():
        wanted = [(k, f, True) for k, line in enumerate(r.text.split("\n")) for n, f in NOTICES.items() if n in line]
        assert got[r.doc_id] == wanted


def test_every_template_is_known(frame, model):
    docs = frame("doc_id long, text string", *[(i, f"Some words.\n{t} More words here.") for i, (_, t) in enumerate(TEMPLATES)])
    got = findings(scan_licences(docs, model))
    assert {i: f[0][:2] for i, f in got.items()} == {i: (1, family) for i, (family, _) in enumerate(TEMPLATES)}


def test_unknown_and_unconfirmed(frame, model):
    docs = frame(
        "doc_id long, text string",
        (1, "The driver lost his license after the third accident on the road."),
        (2, "the work is done under the bridge"),
        (3, "Some rights under a license of our own; see the terms."),
    )
    assert not any(c for some in findings(scan_licences(docs, model)).values() for _, _, c in some)


def test_the_pattern_finds_every_gram(frame, model):
    """Paragraphs are passed over only if they share no gram with any template."""
    rnd = random.Random(3)
    words = sorted({w for g in model.grams for w in g.split(" ")}) + ["other", "éa", "licenses", "x1"]
    texts = ["".join(rnd.choice(words) + rnd.choice([" ", ", ", "-", "\t", "é", "_"]) for _ in range(rnd.randint(1, 6))) for _ in range(500)]
    texts += [g.upper() for g in model.grams] + [f"({g})" for g in model.grams]
    df = frame("t string", *[(t,) for t in texts])
    found = F.lower("t").rlike(license_scan.any_gram(model.grams)).alias("found")
    for r in df.select("t", found, license_scan.grams_of(df.t).alias("g")).collect():
        assert r.found == bool(set(r.g) & set(model.grams)), r.t


def test_the_grams_of_both_sides_agree(frame):
    texts = [t for _, t in TEMPLATES] + ["", "one", "Été à l'école", "a a a"]
    df = frame("t string", *[(t,) for t in texts])
    for r in df.select("t", license_scan.grams_of(df.t).alias("g")).collect():
        assert r.g == license_scan.grams_of_text(r.t)


def test_odd_rows(odd, no_documents, model):
    rows = scan_licences(odd, model).collect()
    assert len(rows) == odd.count()
    assert [r.n_paragraphs for r in rows if r.doc_id == 1] == [0]
    assert [r.n_paragraphs for r in rows if r.doc_id == 2] == [1, 1]
    assert scan_licences(no_documents, license_scan.train(no_documents)).count() == 0


#: Notices as their licences print them.
LONG_NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
    "later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at",
}
MARKS = {"plain": ("", "", ""), "hash": ("", "# ", ""), "slashes": ("", "// ", ""), "star": ("/*", " * ", " */"), "dnl": ("", "dnl ", "")}


@pytest.mark.parametrize("width", [60, 72, 79, 100, 160])
def test_wrapped_notices(frame, model, width):
    """Wrapped at any width, behind comment marks, between other paragraphs: found once, confirmed."""
    rows, wanted = [], {}
    for family, notice in LONG_NOTICES.items():
        for head, mark, foot in MARKS.values():
            lines = [mark + line for line in textwrap.wrap(notice, width - len(mark))]
            block = [head, f"{mark}Copyright 2021 the authors", mark.rstrip(), *lines, mark.rstrip(), foot]
            wanted[len(rows)] = family
            rows.append((len(rows), "\n".join(["A first paragraph of some words.", *block, "And a last one."])))
    got = findings(scan_licences(frame("doc_id long, text string", *rows), model))
    assert {i: {f for _, f, confirmed in some if confirmed} for i, some in got.items()} == {i: {f} for i, f in wanted.items()}


def paragraphs_by_loops(text):
    lines, out, open_line = text.split("\n"), [], False
    for line in lines:
        bare = regex.sub(license_scan.COMMENT, "", line)
        if open_line and regex.search(license_scan.HAS_WORD, line):
            out[-1] += " " + bare
        else:
            out.append(bare)
        low, high = license_scan.WRAPPED
        open_line = low <= len(line) <= high and bool(regex.search(license_scan.GOES_ON, line.rstrip(" ")[-16:]))
    return out


def by_loops(text, model, confirm=0.7):
    number = {g: i for i, g in enumerate(model.grams)}
    out = []
    for k, paragraph in enumerate(paragraphs_by_loops(text)):
        here = set(license_scan.grams_of_text(paragraph))
        known = [number[g] for g in here if g in number]
        logits = [b + sum(model.weights[g][c] for g in known) for c, b in enumerate(model.intercept)]
        top = max(logits)
        if not known or logits[-1] == top:
            continue
        best = logits.index(top)
        p = 1 / sum(math.exp(x - top) for x in logits)
        alike = max(len(here & set(g)) / len(g) for f, g in model.templates if f == model.families[best])
        out.append((k, model.families[best], p, alike, alike >= confirm))
    return out


def test_against_loops(frame, table, model):
    """Paragraphs, families, probabilities and similarities as plain loops give them."""
    rnd = random.Random(9)
    words = " ".join([*LONG_NOTICES.values(), *(t for _, t in TEMPLATES)]).split()
    marks = ["", "", "\n", "\n# ", "\n\n", " |\n", ".\n", "\ndnl ", " */\n", "é\n"]
    texts = [r.text for r in table("documents").collect()]
    for _ in range(150):
        texts.append("".join(f"{rnd.choice(words)} " if rnd.random() < 0.85 else rnd.choice(marks) for _ in range(rnd.randint(1, 200))))
    for notice in LONG_NOTICES.values():
        at = rnd.randrange(len(notice) - 40)
        texts += [textwrap.fill(notice[at:], 50), textwrap.fill(notice[: at + 40], 90)]
    rows = scan_licences(frame("doc_id long, text string", *enumerate(texts)), model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_paragraphs == len(paragraphs_by_loops(texts[r.doc_id]))
        wanted = by_loops(texts[r.doc_id], model)
        assert [(f.paragraph, f.family, f.confirmed) for f in r.findings] == [(k, f, c) for k, f, _, _, c in wanted]
        assert [x for f in r.findings for x in (f.p, f.similarity)] == pytest.approx([x for w in wanted for x in w[2:4]])


def test_calibration_that_cannot_be_made_is_said(frame, model):
    assert model.calibrated
    with pytest.warns(UserWarning, match="not calibrated"):
        none = license_scan.train(frame("doc_id long, text string", (1, "no notice here")), templates=(("mini", "Mini License"),))
    assert not none.calibrated


def test_parts_of_templates(frame, model):
    """Both kinds are among the parts held for calibration, and a small part is no licence."""
    parts = license_scan.template_runs(model, TEMPLATES)
    assert {p["label"] == len(model.families) for p in parts if p["held"]} == {True, False}
    docs = frame("doc_id long, text string", (1, "Permission is hereby granted, free of charge"), (2, "This program is free software."))
    assert findings(scan_licences(docs, model)) == {1: [], 2: []}
