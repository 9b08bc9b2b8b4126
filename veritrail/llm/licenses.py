"""Licence scans with DataFrame operations only.

Paragraphs (cut at blank lines) are classified by a multinomial logistic regression over sparse
word uni- and bigrams, trained on the driver from the notices below. It is calibrated on other
wordings that it was not trained on: a temperature scales the scores and a shift moves the unknown
class, both where those are likeliest; a prediction counts only above a probability, and is
confirmed by comparing words with the family's templates. Weights are integers (thousandths), so
every engine adds them up alike.

A family is also confirmed, beside others, where one of its templates stands entire and the family is
likelier than none: a notice can name two licences. What the paragraph says of a sibling licence
(lesser, affero, no derivatives) contradicts a family unless the family is named as well, and a piece
that denies a licence confirms none.

A paragraph is looked at through its lines and through windows of words around anchors, so that
neither line breaks nor the text around a notice hide it. Anchors are words and word pairs of the
templates, as many of each that without them less than the confirming share of it is left: words
without any anchor cannot be confirmed. Words common in prose are anchors only as part of a pair.
Scoring stays inside the row: the scan needs no shuffle.
"""

from __future__ import annotations

import json
import random
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Share of a template's n-grams that a paragraph must hold to confirm its family.
CONFIRM = 0.5
#: Least calibrated probability of a family.
LEAST = 0.6

#: Share of a template that counts as entire: all of it.
ENTIRE = 0.9999
#: The family that stands in notices of others, so an entire template proves nothing.
WEAK = "Proprietary"

#: Words on either side of an anchor that a window takes: close to it, and more than any template has.
NEAR, FAR = 8, 30
# Words common in prose, which are no anchors by themselves.
COMMON = frozenset(
    "a all an and any are as at by either following for form general in into is it kind later may not of on only or person"
    " provided public purpose subject terms that the this to under use version with without work you der unter".split()
)
# Words common in prose of another language.
FOREIGN = frozenset({"mit"})
# The commonest of them; a pair with one is an anchor only where no other is left.
COMMONEST = frozenset("a and by der for in is of or the this to under unter with".split())
_BLANK_LINES = "\\n(?:[ \\t\\r\\x0B\\x0C]*\\n)+"
_SOLID = "[^ \\t\\r\\n\\x0B\\x0C]"

# Notices by family, as their licences suggest them.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under Apache 2.0",
        "Apache License, Version 2.0",
        "Apache-2.0",
        "Lizenziert unter der Apache-Lizenz, Version 2.0",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "MIT": (
        "Released under the MIT License.",
        "MIT license",
        "Publié sous licence MIT",
        "Publicado bajo la licencia MIT",
        "Licensed under the MIT license",
        "SPDX-License-Identifier: MIT",
        "Lizenziert unter der MIT-Lizenz",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License version 3",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "Distributed under the GPLv3",
        "either version 3 of the License, or (at your option) any later version of the GNU General Public License",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU General Public License version 2",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "Distributed under the GPLv2",
        "either version 2 of the License, or (at your option) any later version of the GNU General Public License",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL-3.0": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Licensed under the ISC license",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0.",
        "This work is marked with CC0 1.0 Universal",
        "This is free and unencumbered software released into the public domain",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
    ),
}
_GNU = {"against": ("lesser general", "library general", "affero general", "lgpl", "agpl"), "unless": ("gnu general", "gpl", "gplv2", "gplv3")}
_NO_DERIVATIVES = ("by nd", "nc nd", "noderivatives", "noderivs", "no derivatives", "no derivs")
_NO_COMMERCE = ("by nc", "noncommercial", "non commercial")
_ALIKE = ("by sa", "nc sa", "sharealike", "share alike")
# Words and pairs that contradict a family, unless the paragraph also has one of the others.
SIBLINGS = {
    "GPL-3.0": _GNU,
    "GPL-2.0": _GNU,
    "CC-BY": {"against": _NO_DERIVATIVES + _NO_COMMERCE + _ALIKE, "unless": ("by 4", "by 3", "attribution 4", "attribution 3")},
    "CC-BY-NC": {"against": _NO_DERIVATIVES + _ALIKE, "unless": ("nc 4", "nc 3", "noncommercial 4", "noncommercial 3")},
    "CC-BY-SA": {"against": _NO_DERIVATIVES + _NO_COMMERCE, "unless": ("by sa", "attribution sharealike")},
    "Proprietary": {"against": ("licensed under", "permission is", "redistribution and", "spdx license", "public license"), "unless": ()},
}
# A piece that denies a licence, its words joined by spaces.
DENIED = "(?:^| )(?:not|never|no longer|isn t|nicht|pas|no est[a-z]*) (?:[a-z]+ )?(?:licensed|released|distributed|available|covered|published|lizenziert|publi[a-z]*|under|unter|sous|bajo)(?: |$)"
# Paragraphs with a notice's words that are no notices.
OTHERS = (
    "He lost his driving licence on the way home", "The licence fee rises next year", "she asked for permission to leave the room",
    "The warranty covers two years from the date of purchase", "a search warrant was issued on Monday",
    "The council will license three new restaurants", "copyright law is taught in the second term",
    "He was licensed to practise medicine in two states", "without permission nobody may enter the building",
    "The tax was meant to redistribute wealth", "a gnu is a large antelope", "The paintings are now in the public domain",
    "fishing licences are sold at the harbour", "the version of the story that the general told the public",
    "They work under the same conditions as the others", "this software is free of charge for schools",
    "Licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "Licensed under CC BY-ND 4.0",
    "Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "Licensed under CC BY-NC-ND 4.0",
)
# Other wordings, for calibration alone; "unknown" are no notices.
CHECKS = {
    "Apache-2.0": ("This file is licensed to you under the Apache License, Version 2.0", "Apache 2.0 licensed, see the license file"),
    "MIT": ("The code is available under the MIT License", "MIT licensed, see license"),
    "GPL-3.0": ("This program is free software under the GNU General Public License version 3 or later", "GPLv3 applies to this code"),
    "GPL-2.0": ("You may share it under the GNU General Public License version 2", "GPLv2 applies to this code"),
    "LGPL": ("This library is covered by the GNU Lesser General Public License",),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License version 3",),
    "BSD": ("Use of this source code is governed by a BSD style license", "Distributed under the 2 clause BSD license"),
    "MPL-2.0": ("Licensed under the Mozilla Public License 2.0",),
    "ISC": ("This package is under the ISC license",),
    "CC-BY-NC": ("Available under a Creative Commons Attribution NonCommercial License",),
    "CC-BY-SA": ("Available under the Creative Commons Attribution ShareAlike License",),
    "CC-BY": ("The text is available under a Creative Commons Attribution License",),
    "CC0": ("Released into the public domain under CC0",),
    "Proprietary": ("Copyright 2019 Example Corporation, all rights reserved",),
    "unknown": (
        "The council released the general report on this source of income", "She kept the right to use the file without conditions",
        "Das Kind geht mit der Mutter in die Schule", "public and private schools are free for any person", "a universal copy of the form",
        "the festival was held in March under the new permit", "distributed over three states", "he obtained permission to copy the keys",
        "the terms of the peace were harsh", "an associated member of the club",
    ),
}


def _words(text: str) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    out, word = [], ""
    for c in low + " ":
        if "a" <= c <= "z" or "0" <= c <= "9":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def _grams(text: str) -> list[str]:
    w = _words(text)
    return sorted({*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))})


def _variations(text: str, rng: random.Random, n: int) -> list[str]:
    """The text as it is, with words lost, doubled or put around it."""
    filler = ("project", "code", "file", "2021", "by", "the", "authors", "see", "for", "details", "data", "text")
    out = [text]
    while len(out) < n:
        w = text.split()
        if len(w) > 6 and rng.random() < 0.6:
            del w[rng.randrange(len(w))]
        w = [rng.choice(filler) for _ in range(rng.randrange(4))] + w + [rng.choice(filler) for _ in range(rng.randrange(4))]
        out.append(" ".join(w))
    return out


@cache
def model() -> dict:
    """Classes, integer weights by n-gram, biases, temperature and template n-grams."""
    rng = random.Random(7)
    names = [*TEMPLATES, "unknown"]
    train = [(_grams(x), k) for k, name in enumerate(names) for text in TEMPLATES.get(name, OTHERS) for x in _variations(text, rng, 12)]
    check = [(_grams(x), k) for k, name in enumerate(names) for x in CHECKS[name]]
    counts: dict[str, int] = {}
    for g, _ in train:
        for x in g:
            counts[x] = counts.get(x, 0) + 1
    vocab = sorted(x for x, n in counts.items() if n >= 4)
    at = {x: k for k, x in enumerate(vocab)}

    def matrix(rows):
        m = np.zeros((len(rows), len(vocab)))
        for r, (g, _) in enumerate(rows):
            m[r, [at[x] for x in g if x in at]] = 1
        return m, np.array([k for _, k in rows])

    x, y = matrix(train)
    share = 1.0 / np.bincount(y)[y]
    w, b = np.zeros((len(vocab), len(names))), np.zeros(len(names))
    target = np.eye(len(names))[y]
    for _ in range(400):
        p = x @ w + b
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - target) * share[:, None]
        w -= 0.5 * (x.T @ g / len(names) + 2e-4 * w)
        b -= 0.5 * g.sum(axis=0) / len(names)
        w = np.sign(w) * np.maximum(np.abs(w) - 2e-4, 0)  # sparse
    weights = np.round(1000 * w).astype(int)
    bias = np.round(1000 * b).astype(int)
    xv, yv = matrix(check)
    raw = (xv @ weights + bias) / 1000

    def loss(t, shift):
        z = raw / t
        z[:, -1] += shift / 1000 / t
        z -= z.max(axis=1, keepdims=True)
        return float(np.mean((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(yv)), yv])))

    temperature, shift = min(((round(0.1 * 1.1**k, 4), 50 * j) for k in range(40) for j in range(-60, 61)), key=lambda x: loss(*x))
    bias[-1] += shift
    kept = {x: [int(v) for v in weights[k]] for x, k in at.items() if weights[k].any()}
    return {
        "names": names,
        "bias": [int(v) for v in bias],
        "weights": kept,
        "temperature": temperature,
        "templates": [[_grams(t) for t in TEMPLATES[n]] for n in TEMPLATES],
    }


@cache
def anchors() -> tuple[str, ...]:
    """Words and word pairs of which every text that confirms a template holds one.

    Of each template the longest words that are not common in prose are taken, then the longest
    pairs, until the grams without them are less than the confirming share.
    """
    shapes = [t for family in model()["templates"] for t in family]
    out: set[str] = set()
    for t in shapes:
        choice = sorted((g for g in t if g not in COMMON | FOREIGN), key=lambda g: (" " in g, sum((x in COMMON) + (x in COMMONEST) for x in g.split()), -len(g), g))
        left = lambda: [g for g in t if g not in out and out.isdisjoint(g.split())]  # noqa: B023, E731
        while len(left()) >= CONFIRM * len(t):
            out.add(next(x for x in choice if x in left()))
    return tuple(sorted(out))


def _branches(texts) -> str:
    """A pattern of all texts that shares their beginnings, so few branches are tried at a place."""
    first: dict[str, list[str]] = {}
    for x in texts:
        first.setdefault(x[:1], []).append(x[1:])
    rest = [c + (_branches(tails) if tails != [""] else "") for c, tails in sorted(first.items()) if c]
    return f"(?:{'|'.join(rest)})" + ("?" if "" in first else "") if rest else ""


def _fixed(value, kind: str) -> Column:
    """A constant of any shape as one literal, which plans carry lightly."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _row_words(col: Column) -> Column:
    return F.array_remove(F.split(col, "[^a-z0-9]+"), "")


def _row_grams(words: Column) -> Column:
    """Distinct uni- and bigrams of a paragraph's words."""
    less = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), less), F.slice(words, F.lit(2), less), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_paragraphs, n_cues, findings, families, n_confirmed, n_unknown.

    A paragraph is a run of lines that hold more than white space. n_cues: paragraphs with an
    anchor; no other can be confirmed. findings: a struct for each different line with an anchor
    and window around one (no: the paragraph, family, score, overlap). families: the confirmed
    ones, in order. n_confirmed and n_unknown: paragraphs with an anchor, with and without a
    confirmed family. Null and empty texts have no paragraphs; repeated rows give repeated results.
    """
    m = model()
    low = ascii_lower(F.col(text_col).cast("string"))
    any_anchor = F.lit(f"(?:^|[^a-z0-9]){_branches(anchors()).replace(' ', '[^a-z0-9]+')}(?![a-z0-9])")
    known_word, known_pair = (_fixed([x for x in anchors() if (" " in x) is pair], "array<string>") for pair in (False, True))
    rows = docs.select(F.col(id_col).alias("id"), low.alias("low"))
    paras = F.filter(F.split("low", _BLANK_LINES), lambda p: F.rlike(p, F.lit(_SOLID)))
    rows = rows.select("id", F.coalesce(paras, F.array().cast("array<string>")).alias("paras"))
    held = lambda texts: F.filter(texts, lambda p: F.rlike(p, any_anchor))
    rows = rows.select("id", F.size("paras").cast("long").alias("n_paragraphs"), held(F.col("paras")).alias("cues"))
    rows = rows.withColumn(
        "words", F.transform("cues", lambda p, no: F.struct(no.alias("no"), _row_words(p).alias("w"), F.transform(held(F.split(p, "\n")), _row_words).alias("lines")))
    )
    siblings = _fixed([{"f": f, **x} for f, x in SIBLINGS.items()], "array<struct<f:string,against:array<string>,unless:array<string>>>")
    against = lambda g: F.transform(F.filter(siblings, lambda x: F.arrays_overlap(g, x["against"]) & ~F.arrays_overlap(g, x["unless"])), lambda x: x["f"])
    # the grams are bound before they are compared, else each comparison would cut them anew
    rows = rows.withColumn("against", F.transform(F.transform("words", lambda p: _row_grams(p["w"])), against))
    at_anchor = lambda w, x, i: F.array_contains(known_word, x) | F.array_contains(known_pair, F.concat_ws(" ", x, F.get(w, i + 1)))
    spots = lambda w: F.array_compact(F.transform(w, lambda x, i: F.when(at_anchor(w, x, i), i + 1)))
    cut = lambda w, at, r: F.slice(w, F.greatest(at - r, F.lit(1)), at + r + 1 - F.greatest(at - r, F.lit(1)))
    around = lambda w: F.flatten(F.transform(spots(w), lambda at: F.array(cut(w, at, NEAR), cut(w, at, FAR))))
    pieces = lambda p: F.transform(F.array_distinct(F.concat(p["lines"], around(p["w"]))), lambda w: F.struct(p["no"].alias("no"), w.alias("w")))
    rows = rows.withColumn("pieces", F.flatten(F.transform("words", pieces)))
    rows = rows.withColumn("grams", F.transform("pieces", lambda p: _row_grams(p["w"])))
    keys = _fixed(list(m["weights"]), "array<string>")
    known = _fixed([{"g": x, "w": w} for x, w in m["weights"].items()], "array<struct<g:string,w:array<int>>>")
    rows = rows.withColumn("known", F.transform("grams", lambda g: F.array_intersect(g, keys)))
    rows = rows.withColumn("hits", F.transform("known", lambda g: F.filter(known, lambda k: F.array_contains(g, k["g"]))))
    start = _fixed(m["bias"], "array<int>")
    add = lambda acc, k: F.zip_with(acc, k["w"], lambda x, y: x + y)
    rows = rows.withColumn("scores", F.transform("hits", lambda h: F.aggregate(h, start, add)))
    # the class: highest score, the first of equal ones
    pick = lambda s: F.array_position(s, F.array_max(s)).cast("int")
    mass = lambda s: F.aggregate(s, F.lit(0.0), lambda acc, v: acc + F.exp((v - F.array_max(s)) / (1000 * m["temperature"])))
    rows = rows.withColumn("best", F.transform("scores", lambda s: F.struct(pick(s).alias("k"), F.round(1 / mass(s), 4).alias("p"))))
    shapes = _fixed(m["templates"], "array<array<array<string>>>")
    # for each family the largest share of one of its templates
    share = lambda g: F.transform(
        shapes, lambda family: F.array_max(F.transform(family, lambda t: F.round(F.size(F.array_intersect(g, t)) / F.size(t), 4)))
    )
    names = _fixed(m["names"], "array<string>")
    seen = F.zip_with("pieces", "grams", lambda p, g: F.struct(p["no"].alias("no"), share(g).alias("shares")))
    rows = rows.withColumn("seen", seen)
    own = lambda p, b: F.coalesce(F.get(p["shares"], b["k"] - 1), F.lit(0.0))
    rows = rows.withColumn(
        "found",
        F.zip_with("seen", "best", lambda p, b: F.struct(p["no"].alias("no"), F.element_at(names, b["k"]).alias("family"), b["p"].alias("score"),
                                                         own(p, b).alias("overlap"),
                                                         F.size(F.filter(p["shares"], lambda x: x >= own(p, b))).alias("fits"))),
    )
    # the family's template must fit, and better than any other family's
    best = lambda f: (f["family"] != "unknown") & (f["score"] >= LEAST) & (f["overlap"] >= CONFIRM) & (f["fits"] == 1)
    # or stand entire, with a family that is likelier than none
    none = len(m["names"]) - 1
    likely = lambda s, k: F.round(1 / (1 + F.exp((F.get(s, F.lit(none)) - F.get(s, k)) / (1000 * m["temperature"]))), 4) >= LEAST
    entire = lambda p, s: F.filter(F.sequence(F.lit(0), F.lit(none - 1)), lambda k: (F.get(p["shares"], k) >= ENTIRE) & (F.element_at(names, k + 1) != WEAK) & likely(s, k))
    rows = rows.withColumn("entire", F.zip_with("seen", "scores", lambda p, s: F.transform(entire(p, s), lambda k: F.element_at(names, k + 1))))
    none_of = F.array().cast("array<string>")
    said = lambda f, e: F.array_union(F.when(best(f), F.array(f["family"])).otherwise(none_of), e)
    rows = rows.withColumn("said", F.zip_with("found", "entire", lambda f, e: F.struct(f["no"].alias("no"), said(f, e).alias("families"))))
    denied = lambda p: F.rlike(F.concat_ws(" ", p["w"]), F.lit(DENIED))
    rows = rows.withColumn(
        "sure",
        F.zip_with(
            "said", "pieces",
            lambda f, p: F.struct(f["no"].alias("no"), F.when(denied(p), none_of).otherwise(F.array_except(f["families"], F.get(F.col("against"), f["no"]))).alias("families")),
        ),
    )
    rows = rows.withColumn("sure", F.filter("sure", lambda f: F.size(f["families"]) > 0))
    confirmed = F.size(F.array_distinct(F.transform("sure", lambda f: f["no"])))
    return rows.select(
        F.col("id").alias(id_col),
        "n_paragraphs",
        F.size("cues").cast("long").alias("n_cues"),
        F.col("found").alias("findings"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform("sure", lambda f: f["families"])))), ",").alias("families"),
        confirmed.cast("long").alias("n_confirmed"),
        (F.size("cues") - confirmed).cast("long").alias("n_unknown"),
    )


def license_sql() -> str:
    """The digest of :func:`license_scan` in DuckDB, with the trained weights as tables."""
    m = model()
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    weights = ", ".join(f"({quote(g)}, {k}, {v})" for g, w in m["weights"].items() for k, v in enumerate(w) if v)
    bias = ", ".join(f"({k}, {quote(n)}, {b})" for k, (n, b) in enumerate(zip(m["names"], m["bias"], strict=True)))
    shapes = ", ".join(f"({k}, {t}, {quote(x)})" for k, f in enumerate(m["templates"]) for t, g in enumerate(f) for x in g)
    held, pairs = (", ".join(quote(x) for x in anchors() if (" " in x) is pair) for pair in (False, True))
    listed = lambda xs: "[" + ", ".join(quote(x) for x in xs) + "]"
    siblings = ", ".join(f"({quote(f)}, {listed(x['against'])}, {listed(x['unless'])})" for f, x in SIBLINGS.items())
    at_anchor = f"list_contains([{held}], w[i]) OR list_contains([{pairs}], w[i] || ' ' || w[i + 1])"
    return rf"""
WITH weights(g, k, v) AS (VALUES {weights}), classes(k, name, b) AS (VALUES {bias}),
shapes(k, t, g) AS (VALUES {shapes}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
paras AS (SELECT rid, unnest(ps) AS p, unnest(range(len(ps))) AS no FROM (
  SELECT rid, list_filter(regexp_split_to_array(low, '{_BLANK_LINES}'), lambda p: regexp_matches(p, '{_SOLID}')) AS ps FROM docs WHERE low IS NOT NULL)),
ws AS (SELECT rid, no, p, list_filter(regexp_split_to_array(p, '[^a-z0-9]+'), lambda x: x <> '') AS w FROM paras),
spots AS (SELECT rid, no, w, i FROM (SELECT rid, no, w, unnest(range(1, len(w) + 1)) AS i FROM ws) WHERE coalesce({at_anchor}, false)),
pieces AS (
  SELECT rid AS doc, no AS para, w[greatest(i - {NEAR}, 1):i + {NEAR}] AS w FROM spots
  UNION SELECT rid, no, w[greatest(i - {FAR}, 1):i + {FAR}] FROM spots
  UNION SELECT rid, no, w FROM (SELECT rid, no, list_filter(regexp_split_to_array(unnest(string_split(p, chr(10))), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM ws)
        WHERE len(list_filter(range(1, len(w) + 1), lambda i: coalesce({at_anchor}, false))) > 0
), cues AS (SELECT doc AS rid, row_number() OVER () AS no, para, w FROM pieces),
grams AS (
  SELECT DISTINCT rid, no, g FROM (
    SELECT rid, no, unnest(w) AS g FROM cues
    UNION ALL SELECT rid, no, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM cues WHERE len(w) > 1)
), sums AS (
  SELECT c.rid, c.no, k.k, k.name, k.b + coalesce(s.v, 0) AS s FROM cues c CROSS JOIN classes k
  LEFT JOIN (SELECT rid, no, k, sum(v) AS v FROM grams JOIN weights USING (g) GROUP BY ALL) s
    ON s.rid = c.rid AND s.no = c.no AND s.k = k.k
), best AS (
  SELECT rid, no, arg_min(k, (-s, k)) AS k, arg_min(name, (-s, k)) AS name,
         round(1 / sum(exp((s - top) / (1000 * {m["temperature"]}))), 4) AS p
  FROM (SELECT *, max(s) OVER (PARTITION BY rid, no) AS top FROM sums) GROUP BY rid, no
), overlap AS (
  SELECT rid, no, k, round(max(n), 4) AS o FROM (
    SELECT c.rid, c.no, s.k, s.t, count(g.g) / count(*) AS n FROM cues c CROSS JOIN shapes s
    LEFT JOIN grams g ON g.rid = c.rid AND g.no = c.no AND g.g = s.g GROUP BY c.rid, c.no, s.k, s.t) GROUP BY ALL
), rival AS (SELECT b.rid, b.no, max(o.o) AS o FROM best b JOIN overlap o ON o.rid = b.rid AND o.no = b.no AND o.k <> b.k GROUP BY ALL
), siblings(name, against, unless) AS (VALUES {siblings}),
whole AS (SELECT rid, no AS para, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM ws),
bad AS (SELECT rid, para, name FROM whole JOIN siblings ON list_has_any(g, against) AND NOT list_has_any(g, unless)),
said AS (
  SELECT b.rid, b.no, b.name, b.name <> 'unknown' AND b.p >= {LEAST} AND o.o >= {CONFIRM} AND o.o > r.o AS sure
  FROM best b LEFT JOIN overlap o ON o.rid = b.rid AND o.no = b.no AND o.k = b.k LEFT JOIN rival r ON r.rid = b.rid AND r.no = b.no
  UNION ALL
  SELECT o.rid, o.no, f.name, round(1 / (1 + exp((n.s - f.s) / (1000 * {m["temperature"]}))), 4) >= {LEAST}
  FROM overlap o JOIN sums f ON f.rid = o.rid AND f.no = o.no AND f.k = o.k JOIN sums n ON n.rid = o.rid AND n.no = o.no AND n.name = 'unknown'
  WHERE o.o >= {ENTIRE} AND f.name <> '{WEAK}'
), found AS (
  SELECT s.rid, c.para, s.name, coalesce(s.sure, false) AND NOT regexp_matches(array_to_string(c.w, ' '), '{DENIED}')
         AND NOT EXISTS (SELECT 1 FROM bad x WHERE x.rid = s.rid AND x.para = c.para AND x.name = s.name) AS sure
  FROM said s JOIN cues c ON c.rid = s.rid AND c.no = s.no
), per AS (
  SELECT rid, count(DISTINCT para) AS n_cues, array_to_string(list_sort(list(DISTINCT name) FILTER (sure)), ',') AS families,
         count(DISTINCT para) FILTER (coalesce(sure, false)) AS n_confirmed, count(DISTINCT para) - count(DISTINCT para) FILTER (coalesce(sure, false)) AS n_unknown
  FROM found GROUP BY rid
), filled AS (SELECT rid, count(*) AS n FROM paras GROUP BY rid)
SELECT doc_id, CAST(coalesce(f.n, 0) AS BIGINT) AS n_paragraphs, CAST(coalesce(n_cues, 0) AS BIGINT) AS n_cues,
       coalesce(families, '') AS families, CAST(coalesce(n_confirmed, 0) AS BIGINT) AS n_confirmed,
       CAST(coalesce(n_unknown, 0) AS BIGINT) AS n_unknown
FROM docs LEFT JOIN per USING (rid) LEFT JOIN filled f USING (rid)
"""
