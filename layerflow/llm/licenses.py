"""Licence scan: paragraphs classified by a trained n-gram model and confirmed by templates.

DataFrame functions and the JVM's models only; no Python runs on the executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.text import let
from layerflow.llm.training import stored

# Notices as their licences' stewards word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this "
        "library; if not, see <https://www.gnu.org/licenses/>.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. "
        "If not, see <https://www.gnu.org/licenses/>.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "CDDL": [
        "Licensed under the Common Development and Distribution License, version 1.0.",
        "The contents of this file are subject to the terms of the Common Development and "
        "Distribution License (the License). You may not use this file except in compliance with the "
        "License.",
        "SPDX-License-Identifier: CDDL-1.0",
    ],
    "Unlicense": [
        "Released into the public domain under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "CC0": [
        "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License.",
    ],
    "CC-BY-NC-ND": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
        "International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
        "License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ],
}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]  # a family's place is its label
SIMILARITY = 0.8
_LEVELS = 1 << 16  # steps of the threshold
# Groups of families whose notices are nearly the same, and the word pairs that tell them apart.
SIBLINGS = (
    {
        "GPL": ("gnu general", "identifier gpl"),
        "AGPL": ("gnu affero", "identifier agpl"),
        "LGPL": ("gnu lesser", "identifier lgpl"),
    },
    {
        "BSD": ("bsd 3",),
        "BSD-2-Clause": ("bsd 2",),
    },
    {
        "CC-BY": ("by 4", "attribution 4"),
        "CC-BY-SA": ("by sa", "attribution sharealike"),
        "CC-BY-ND": ("by nd", "attribution noderivatives"),
        "CC-BY-NC": ("nc 4", "noncommercial 4"),
        "CC-BY-NC-SA": ("nc sa", "noncommercial sharealike"),
        "CC-BY-NC-ND": ("nc nd", "noncommercial noderivatives"),
    },
)
# What turns a notice into its contrary: one of the first words right before one of the others.
DENIALS = "not never neither nor longer cannot".split()
DENIED = "licensed released distributed available under granted permitted covered subject".split()
# Words around a notice in training rows, as notices stand in sentences and mark-up.
FRAMES = ("", "this file is", "all contents here are", "copyright 2020 the authors", "see license")
# What sounds like a licence and is none of the families.
OTHERS = (
    "licensed under the terms of our customer agreement",
    "this software is released under a proprietary license",
    "all rights reserved no part of this work may be copied without permission",
    "a driving license is required under the general rules version 2",
    "the public was permitted to see the work in version 3",
    "released under the name of the band",
    "the license of the bar was not renewed",
    "terms of use and conditions of sale apply to any copy",
    "this work is not licensed under the gnu general public license version 3",
    "this file is not released under the mit license",
    "the code was never licensed under the apache license version 2 0",
)


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(
        F.split(F.lower(text), r"[^a-z0-9\p{L}\p{N}]+"), lambda w: F.length(w) > 0
    )


def _split(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _pairs(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


@dataclass(frozen=True)
class LicenseModel:
    """N-gram counts and the regression, both in the JVM.

    ``cues`` are words of which every n-gram with a weight holds at least one, so a paragraph
    without them scores as an empty one does: unknown. ``threshold`` is the calibrated least
    probability of a known family.
    """

    pipeline: PipelineModel
    cues: list[str]
    threshold: float


def _vocabulary() -> list[str]:
    """The words, pairs and triples of the notices."""
    return sorted(
        {
            " ".join(words[i : i + n])
            for notices in TEMPLATES.values()
            for words in map(_split, notices)
            for n in (1, 2, 3)
            for i in range(len(words) - n + 1)
        }
    )


def _grams(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``words``) and those of their words, pairs and triples that notices have, as ``grams``.

    The counter knows no others, so these are not put together.
    """
    sizes: dict[int, list[str]] = {1: [], 2: [], 3: []}
    for gram in _vocabulary():
        sizes[gram.count(" ") + 1].append(gram)
    ones, twos, threes = sizes.values()

    def of(known):
        # null where a word is none of the notices'
        both = F.filter(
            F.sequence(F.lit(0), F.size(known) - 2),
            lambda i: F.get(known, i).isNotNull() & F.get(known, i + 1).isNotNull(),
        )
        joined = F.transform(
            both,
            lambda i: F.struct(
                i.alias("i"), F.concat_ws(" ", F.get(known, i), F.get(known, i + 1)).alias("gram")
            ),
        )

        def longer(pairs):
            # concat gives null where the third word is none of theirs
            triples = F.transform(
                pairs, lambda pair: F.concat(pair["gram"], F.lit(" "), F.get(known, pair["i"] + 2))
            )
            return F.concat(pairs["gram"], F.filter(triples, lambda gram: gram.isin(threes)))

        pairs = F.filter(joined, lambda pair: pair["gram"].isin(twos))
        return F.concat(F.filter(known, lambda w: w.isNotNull()), let(pairs, longer))

    known = F.transform("words", lambda w: F.when(w.isin(ones), w))
    return rows.withColumn("grams", let(known, of))


def template_rows() -> list[tuple[list[str], int]]:
    """Training rows made from the notices: framed, cut off, and with a word left out."""
    rows = []
    for label, family in enumerate(FAMILIES):
        for template in TEMPLATES.get(family, ()):
            words = _split(template)
            for frame in FRAMES:
                rows.append((_split(frame) + words, label))
                rows.append((words + _split(frame), label))
            for i in range(1, min(len(words) - 1, 40), 2):
                if len(words) > 6:
                    rows.append((words[:i] + words[i + 1 :], label))
            if len(words) > 20:
                rows.extend((words[i : i + 16], label) for i in range(0, len(words) - 15, 8))
    for other in OTHERS:
        words = _split(other)
        rows.extend((_split(frame) + words, 0) for frame in FRAMES)
    return rows


def word_pairs(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""

    def pairs(words):
        at = F.sequence(F.lit(0), F.greatest(F.size(words) - 2, F.lit(0)))
        return F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))

    return F.array_distinct(let(words, pairs))


def template_match(words: Column) -> Column:
    """``similarity, label`` of the notice of which the words hold the largest share of word pairs."""
    notices = [
        F.struct(
            F.lit(label).alias("label"), F.array(*map(F.lit, _pairs(_split(template)))).alias("pairs")
        )
        for label, family in enumerate(FAMILIES)
        for template in TEMPLATES.get(family, ())
    ]

    def share(own, notice):
        common = F.size(F.array_intersect(own, notice["pairs"])) / F.size(notice["pairs"])
        return F.struct(common.alias("similarity"), notice["label"].alias("label"))

    return let(
        word_pairs(words),
        lambda own: F.array_max(F.transform(F.array(*notices), lambda notice: share(own, notice))),
    )


def _notices(family: str) -> list[tuple[list[str], list[str], list[str]]]:
    """Of each notice its pairs, those that name its family, and those that speak against it.

    The latter name a sibling, or deny what the notice does not.
    """
    own, foreign = set(), set()
    for group in SIBLINGS:
        if family in group:
            own = set(group[family])
            foreign = set().union(*(pairs for f, pairs in group.items() if f != family))
    sets = [set(_pairs(_split(t))) for t in TEMPLATES.get(family, ())]
    denials = {f"{a} {b}" for a in DENIALS for b in DENIED}
    return [
        (sorted(pairs), sorted(pairs & own), sorted(foreign | denials - pairs)) for pairs in sets
    ]


def family_match(words: Column, label: Column) -> Column:
    """``similarity, tells`` of the notice of a family that the words hold the largest share of.

    ``tells``: they hold the pairs of the notice by which it differs from those of its siblings, no
    pair by which these differ from it, and no denial that is not its own.
    """

    def texts(values: list[str]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<string>")

    families = F.array(
        *(
            F.array(
                *(
                    F.struct(texts(own).alias("own"), texts(tell).alias("tell"), texts(no).alias("no"))
                    for own, tell, no in _notices(family) or [([], [], [])]
                )
            )
            for family in FAMILIES
        )
    )
    def match(held, notice):
        share = F.size(F.array_intersect(held, notice["own"])) / F.greatest(
            F.size(notice["own"]), F.lit(1)
        )
        tells = (
            (F.size(F.array_except(notice["tell"], held)) == 0)
            & ~F.arrays_overlap(held, notice["no"])
        )
        return F.struct(share.alias("similarity"), tells.alias("tells"))

    return let(
        word_pairs(words),
        lambda held: F.array_max(
            F.transform(F.get(families, label), lambda notice: match(held, notice))
        ),
    )


def paragraphs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, and ``paragraph`` (from 0), ``body`` and ``words`` of each line.

    Lines without words are left out, so null, empty and blank texts give no rows.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    lines = docs.select(*rest, F.explode(_lines(text_col)).alias("__lf_line"))
    return lines.select(*rest, "__lf_line.*")


def _lines(text_col: str) -> Column:
    """``paragraph, body, words`` of each line with words; within the row, so that no filter above
    splits the lines a second time."""
    of_text = F.transform(
        F.split(text_col, "\n"),
        lambda body, i: F.struct(i.alias("paragraph"), body.alias("body"), words_of(body).alias("words")),
    )
    return F.filter(of_text, lambda line: F.size(line["words"]) > 0)


def _telling_words() -> list[str]:
    """Words of which a text must hold one to hold four fifths of any notice's word pairs."""
    chosen: set[str] = set()
    for notice in (_split(t) for notices in TEMPLATES.values() for t in notices):
        pairs = _pairs(notice)
        for word in sorted(set(notice), key=lambda w: (w not in chosen, w == "under", -len(w), w)):
            if word not in chosen and len(word) < 5 and word != "cc":
                continue
            left = [p for p in pairs if not chosen & set(p.split())]
            if len(left) < SIMILARITY * len(pairs):
                break
            chosen.add(word)
    return sorted(chosen)


def wrapped_paragraphs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``paragraphs``, where a line at which a wrapped notice begins has the notice's words.

    A notice of n words is looked for in a line's last n words and the n words after that line;
    comment marks are no words. It begins at the last line from which most of its word pairs are
    held, four fifths at least; copies right after one another begin at the last one. A line that
    holds a whole notice itself keeps its own words.
    """
    notices = [_split(t) for family in TEMPLATES.values() for t in family]
    sizes = sorted({len(notice) for notice in notices})
    telling = _telling_words()

    def window(lines, j, n):
        own = F.get(lines, j)["words"]
        rest = F.transform(F.slice(lines, j + 2, n), lambda line: F.slice(line["words"], 1, n))
        return F.concat(
            F.slice(own, F.greatest(F.size(own) - n, F.lit(0)) + 1, n),
            F.slice(F.flatten(rest), 1, n),
        )

    def shares(lines, j):
        """Of each notice, the share of its word pairs in its window at a line."""
        def of(n, own):
            sets = [_pairs(notice) for notice in notices if len(notice) == n]
            return F.array(
                *(
                    F.size(F.array_intersect(own, F.array(*map(F.lit, pairs)))) / len(pairs)
                    for pairs in sets
                )
            )

        def at(n):
            return let(word_pairs(window(lines, j, n)), lambda own: of(n, own))

        each = [at(n) for n in sizes]
        near = F.arrays_overlap(window(lines, j, sizes[-1]), F.array(*map(F.lit, telling)))
        return F.when(near, F.concat(*each)).otherwise(F.array_repeat(F.lit(0.0), len(notices)))

    lengths = F.array(*(F.lit(n) for n in sizes for notice in notices if len(notice) == n))

    def begins(held, j):
        """Length of the longest notice that begins at a line, or 0."""
        at = F.transform(
            lengths,
            lambda n, t: F.when(
                (F.get(F.get(held, j), t) >= SIMILARITY)
                & (F.get(F.get(held, j), t) >= F.coalesce(F.get(F.get(held, j - 1), t), F.lit(0.0)))
                & (F.get(F.get(held, j), t) > F.coalesce(F.get(F.get(held, j + 1), t), F.lit(0.0))),
                n,
            ).otherwise(0),
        )
        return F.array_max(at)

    def chosen(lines):
        at = F.sequence(F.lit(0), F.size(lines) - 1)

        def line(held, j):
            own = F.get(lines, j)
            n = begins(held, j)
            # a line that holds all of the notice that its window does
            whole = template_match(own["words"])["similarity"] >= F.array_max(F.get(held, j))
            words = let(
                n,
                lambda n: F.when(n == 0, own["words"])
                .when(whole, own["words"])
                .otherwise(window(lines, j, n)),
            )
            return F.struct(
                own["paragraph"].alias("paragraph"), own["body"].alias("body"), words.alias("words")
            )

        return let(
            F.transform(at, lambda j: shares(lines, j)),
            lambda held: F.transform(at, lambda j: line(held, j)),
        )

    given = let(
        _lines(text_col),
        lambda lines: F.when(
            F.exists(lines, lambda line: F.exists(line["words"], lambda w: w.isin(telling))),
            chosen(lines),
        ).otherwise(lines),
    )
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(*rest, F.explode(given).alias("line")).select(*rest, "line.*")


def train(
    docs: DataFrame, *, corpus_weight: float = 4000, false_rate: float = 0.001
) -> LicenseModel:
    """Fit on rows made from the notices and all distinct paragraphs of the corpus.

    Paragraphs that hold four fifths of a notice are rows of its family; the others are unknown.
    Together they weigh as much as ``corpus_weight`` of the made rows at most, so that these count
    in a corpus of any size. A third, by a hash of the words, is kept from the fit: the threshold is
    the least value, from 0.5 and in steps of 1 / ``_LEVELS``, that no more than ``false_rate`` of
    these unknown paragraphs exceed by a step or more.

    Paragraphs with the same n-grams of the notices are one row with their number.
    """
    spark: SparkSession = docs.sparkSession
    vocabulary = _vocabulary()
    counter = CountVectorizerModel.from_vocabulary(
        vocabulary, inputCol="grams", outputCol="features"
    ).setBinary(True)
    match = let(
        template_match(F.col("words")),
        lambda m: F.when(m["similarity"] >= SIMILARITY, m["label"]).otherwise(0),
    )
    telling = F.array(*map(F.lit, _telling_words()))
    lines = paragraphs(docs.select("text")).select(
        "words",
        F.when(F.arrays_overlap("words", telling), match).otherwise(0).cast("double").alias("label"),
        F.xxhash64("words").alias("key"),
        F.pmod(F.xxhash64("words", F.lit(1)), F.lit(3)).alias("fold"),
    )
    once = counter.transform(_grams(lines)).select("key", "fold", "label", "features").distinct()
    counted = once.groupBy("fold", "label", "features").agg(F.count("*").alias("n"))
    corpus = stored(counted, "licence-rows")
    unknown = F.when(F.expr("fold = 2 AND label = 0"), F.col("n"))
    total, n_unknown = corpus.agg(F.sum("n"), F.sum(unknown)).first()
    weight = F.col("n") * min(1.0, corpus_weight / max(1, total or 0))
    made = spark.createDataFrame(template_rows(), "words array<string>, label int")
    made = counter.transform(_grams(made)).select(
        F.col("label").cast("double"), "features", F.lit(1.0).alias("weight")
    )
    rows = made.union(corpus.where("fold < 2").select("label", "features", weight))
    regression = LogisticRegression(
        family="multinomial",
        regParam=0.0005,
        elasticNetParam=1.0,
        maxIter=80,
        standardization=False,
        weightCol="weight",
    )
    fitted = regression.fit(rows)
    held = fitted.transform(corpus.where("fold = 2 AND label = 0"))
    top = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES)))
    # _LEVELS / 2 + 1 rows at most
    levels = (
        held.groupBy(F.floor(top * _LEVELS).alias("level"))
        .agg(F.sum("n").alias("n"))
        .where(F.col("level") >= _LEVELS // 2)
        .collect()
    )
    threshold, above = 0.5, 0
    for level, n in sorted(levels, reverse=True):
        above += n
        if above > int((n_unknown - 1) * false_rate):
            threshold = level / _LEVELS
            break
    weights = fitted.coefficientMatrix.toArray()
    weighted = [vocabulary[i] for i in weights.any(axis=0).nonzero()[0]]
    return LicenseModel(PipelineModel([counter, fitted]), _cues(weighted), threshold)


def _cues(grams: list[str]) -> list[str]:
    """A small set of words that meets every n-gram: the word that meets most goes first."""
    left, chosen = [set(g.split()) for g in grams], []
    while left:
        counts: dict[str, int] = {}
        for words in left:
            for word in words:
                counts[word] = counts.get(word, 0) + 1
        word = max(sorted(counts), key=lambda w: counts[w])
        chosen.append(word)
        left = [words for words in left if word not in words]
    return sorted(chosen)


def scan(docs: DataFrame, model: LicenseModel, *, text_col: str = "text") -> DataFrame:
    """A row for every paragraph that the model takes for a licence notice.

    The columns of ``docs`` but the text, and ``paragraph, family, probability, similarity,
    confirmed``. Paragraphs are lines, and wrapped notices, numbered by their first line (see
    ``wrapped_paragraphs``). The family is the likeliest known one, if its probability
    reaches the calibrated threshold, else unknown and not returned. It is confirmed when the
    paragraph holds at least four fifths of the word pairs of one of the family's notices, among them
    those that set it apart from the notices of sibling families, none by which these differ, and no
    denial, such as "not licensed".
    Nothing is shuffled. Null and empty texts give no rows; repeated rows give theirs each time.
    """
    added = ["paragraph", "family", "probability", "similarity", "confirmed"]
    kept = [c for c in docs.columns if c != text_col]
    if clash := set(added) & set(kept):
        raise ValueError(f"columns {sorted(clash)} are there already")
    packed = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("kept") if kept else F.lit(None).alias("kept")
    rows = wrapped_paragraphs(docs.select(packed, F.col(text_col).alias("text")))
    cues = F.array(*map(F.lit, model.cues))
    some = _grams(rows.where(F.arrays_overlap("words", cues)).drop("body"))
    scored = model.pipeline.transform(some).select(
        "kept", "paragraph", "words", vector_to_array("probability").alias("p")
    )
    known = F.slice("p", 2, len(FAMILIES) - 1)
    likely = F.array_max(known)
    label = (F.array_position(known, likely)).cast("int")
    scored = scored.select(
        "kept", "paragraph", "words", likely.alias("probability"), label.alias("label")
    ).where(F.col("probability") >= model.threshold)
    scored = scored.withColumn("match", family_match(F.col("words"), F.col("label")))
    return scored.select(
        *(F.col("kept").getField(c).alias(c) for c in kept),
        "paragraph",
        F.array(*map(F.lit, FAMILIES))[F.col("label")].alias("family"),
        "probability",
        F.col("match.similarity").alias("similarity"),
        ((F.col("match.similarity") >= SIMILARITY) & F.col("match.tells")).alias("confirmed"),
    )
