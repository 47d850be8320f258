"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

Only built-in expressions and Spark's own logistic regression. Notices of each licence family,
with words left out, and a bounded sample of other paragraphs train a sparse multinomial model
over word n-grams. Scoring looks only at the n-grams that have a weight; a paragraph with none
is unknown. A predicted family is confirmed if one of its notices is mostly there, and with it
the words that tell the family from others: its version, NC, SA, ND and the like.

A notice is looked for in each line, and in each run of lines that are mostly made of notices'
word pairs, as hard-wrapped ones are; a blank line ends a run.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.llm.scratch import stored

# Notices of public licences.
_CC = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
_CC_KINDS = [("by", "4.0"), ("by-sa", "4.0"), ("by-nd", "4.0"), ("by-nc", "4.0")]
_CC_KINDS += [("by-nc-sa", "4.0"), ("by-nc-nd", "4.0"), ("by", "3.0"), ("by-sa", "3.0")]


def _creative_commons(kind: str, version: str) -> list[str]:
    name, area = "-".join(_CC[k] for k in kind.split("-")), "International"
    return [
        f"Licensed under CC {kind.upper()} {version}.",
        f"This work is licensed under the Creative Commons {name} {version} "
        f"{area if version == '4.0' else 'Unported'} License.",
    ]


def _gnu(name: str, version: str, thing: str = "program") -> list[str]:
    return [
        f"This work is licensed under the GNU {name} License, version {version}.",
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms "
        f"of the GNU {name} License as published by the Free Software Foundation, either version "
        f"{version} of the License, or (at your option) any later version.",
    ]


NOTICES: dict[str, list[str]] = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an AS IS BASIS",
    ],
    "gpl-2.0": _gnu("General Public", "2"),
    "gpl-3.0": _gnu("General Public", "3"),
    "gpl": [
        "Licensed under the GNU General Public License.",
        "You should have received a copy of the GNU General Public License along with this "
        "program.",
    ],
    "agpl-3.0": _gnu("Affero General Public", "3"),
    "lgpl-2.1": _gnu("Lesser General Public", "2.1", "library"),
    "lgpl-3.0": _gnu("Lesser General Public", "3", "library"),
    "lgpl": [
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License",
    ],
    "bsd-2-clause": ["Licensed under the BSD 2-Clause License."],
    "bsd-3-clause": [
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Redistributions in binary form must reproduce the above copyright notice",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, Version 2.0.",
    ],
    **{f"cc-{kind}-{version}": _creative_commons(kind, version) for kind, version in _CC_KINDS},
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
    "reserved": ["All rights reserved.", "Copyright. All rights reserved by the author."],
}


def _versions(name: str, version: str) -> list[list[str]]:
    """Phrases of a GNU licence of one version, beside its name or further on."""
    beside = [[f"{name} version {version}"], [f"{name} v{version}"]]
    return [*beside, [name, f"version {version} of the license"]]


#: For each family the phrases without which it is not confirmed: all of one of the lists.
MARKS: dict[str, list[list[str]]] = {
    "mit": [
        ["mit license"],
        ["this software and associated documentation"],
        ["this permission notice shall be included"],
    ],
    "apache-2.0": [["apache license version 2 0"], ["apache org licenses license 2 0"]],
    "gpl-2.0": _versions("gnu general public license", "2"),
    "gpl-3.0": _versions("gnu general public license", "3"),
    "gpl": [["gnu general public license"]],
    "agpl-3.0": _versions("gnu affero general public license", "3"),
    "lgpl-2.1": _versions("gnu lesser general public license", "2 1"),
    "lgpl-3.0": _versions("gnu lesser general public license", "3"),
    "lgpl": [["gnu lesser general public license"]],
    "bsd-2-clause": [["bsd 2 clause"]],
    "bsd-3-clause": [["bsd 3 clause"], ["neither the name", "contributors may be used to endorse"]],
    "bsd": [["redistribution and use in source and binary"], ["redistributions in binary form"]],
    "isc": [["isc license"], ["for any purpose with or without fee"]],
    "mpl-2.0": [["mozilla public license v 2 0"], ["mozilla public license version 2 0"]],
    "epl-2.0": [[f"eclipse public license {v}2 0"] for v in ("", "v ", "version ")],
    **{
        f"cc-{kind}-{version}": [
            [f"{start} {name} {version.replace('.', ' ')}"]
            for start, name in (
                ("cc", kind.replace("-", " ")),
                ("creative commons", " ".join(_CC[k].lower() for k in kind.split("-"))),
            )
        ]
        for kind, version in _CC_KINDS
    },
    "public-domain": [["into the public domain"], ["waived all copyright"]],
    "reserved": [["all rights reserved"]],
}
UNKNOWN = "unknown"
FAMILIES = (*NOTICES, UNKNOWN)
#: Versions of each notice with words left out, every fourth for calibration only.
VERSIONS = 16
#: Most other paragraphs that the model is fitted and calibrated on.
OTHERS = 4_000
#: Least probability of a family, and least share of a notice's word pairs that confirms it.
LEAST, CONFIRMED = 0.5, 0.6
#: Least share of notices' word pairs in the lines of a run.
WRAPPED = 0.3

_WORDS = "filter(split(lower(line), '[^a-z0-9]+'), w -> w <> '')"


def _grams(words: str, n: int, first: str | None = None) -> str:
    """The runs of ``n`` words in order; only those that begin with one of ``first``, if given."""
    parts = ", ".join(f"get({words}, i + {k})" for k in range(n))
    starts = f"sequence(0, greatest(size({words}) - {n}, 0))"
    if first is not None:
        starts = f"filter({starts}, i -> get({words}, i) IN ({first}))"
    return f"if(size({words}) < {n}, array(), transform({starts}, i -> concat_ws(' ', {parts})))"


ALL_GRAMS = f"array_union(words, array_union({_grams('words', 2)}, {_grams('words', 3)}))"


def _grams_among(grams: list[str]) -> str:
    """Those of ``ALL_GRAMS`` that are listed; no others are made than ones with a listed beginning."""
    firsts = _literals(sorted({g.split()[0] for g in grams})) or "NULL"
    runs = f"array_union({_grams('words', 2, firsts)}, {_grams('words', 3, firsts)})"
    own = f"filter(words, w -> w IN ({firsts}))"
    return f"filter(array_union({own}, {runs}), g -> g IN ({_literals(grams) or 'NULL'}))"


@dataclass(frozen=True)
class Model:
    """Weights of n-grams, one for each family, with their intercepts and a temperature."""

    weights: dict[str, list[float]]
    intercepts: list[float]
    temperature: float


def notices(spark: SparkSession) -> DataFrame:
    """(family, words, pairs) of every notice."""
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    return (
        spark.createDataFrame(rows, "family string, line string")
        .selectExpr("family", "line", f"{_WORDS} AS words")
        .selectExpr("family", "line", "words", f"array_distinct({_grams('words', 2)}) AS pairs")
    )


def _marked(words: str) -> str:
    """The families whose marks are among the words."""

    def has(phrases: list[str]) -> str:
        return " AND ".join(f"contains(s, ' {p} ')" for p in phrases)

    each = ", ".join(
        f"if({' OR '.join(f'({has(one)})' for one in marks)}, '{family}', NULL)"
        for family, marks in MARKS.items()
    )
    joined = f"array(concat(' ', array_join({words}, ' '), ' '))"
    return f"get(transform({joined}, s -> filter(array({each}), f -> f IS NOT NULL)), 0)"


def _lines(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select("at", F.posexplode(F.split(F.col(text_col), "\n")).alias("place", "line"))


def train(docs: DataFrame, text_col: str = "text", others: int = OTHERS) -> Model:
    """A model from the notices and at most ``others`` paragraphs of the documents.

    The paragraphs are drawn by hash of their text, from all documents; those that hold most of
    a notice are left out, as they are no examples of the unknown.
    """
    spark = docs.sparkSession
    known = notices(spark)
    number = F.lit(FAMILIES.index(UNKNOWN))
    for k, family in enumerate(FAMILIES):
        number = F.when(F.col("family") == family, k).otherwise(number)
    # each version leaves out words chosen by hash, and one keeps all
    versions = known.select(
        number.cast("double").alias("label"),
        F.explode(F.sequence(F.lit(0), F.lit(VERSIONS - 1))).alias("version"),
        "words",
    ).selectExpr(
        "label",
        "version",
        "filter(words, (w, i) -> version = 0 OR pmod(xxhash64(w, i, version), 6) <> 0) AS words",
    )
    lines = docs.select(F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("line"))
    lines = lines.where("trim(line) <> ''").withColumn("draw", F.expr("xxhash64(line, 1)"))
    n = lines.count()
    share = min(1.0, 4 * others / max(1, n))
    drawn = (
        lines.where(f"pmod(draw, 1000000) < {1e6 * share}")
        .dropDuplicates(["line"])
        .orderBy("draw")
        .limit(others)
        .selectExpr("draw", f"{_WORDS} AS words")
    )
    every = [r.pairs for r in known.select("pairs").collect()]
    pairs = f"array({_literals(sorted({p for x in every for p in x}))})"
    # written first: a filter pushed below the words would split each line once for every word
    drawn = stored(drawn, "paragraphs")
    other = drawn.where(f"size(array_intersect({_grams('words', 2)}, {pairs})) < 2").selectExpr(
        f"double({FAMILIES.index(UNKNOWN)}) AS label",
        f"cast(pmod(draw, {VERSIONS}) AS int) AS version",
        "words",
    )
    whole = versions.where("version = 0").selectExpr(f"{ALL_GRAMS} AS g").collect()
    vocabulary = sorted({g for r in whole for g in r.g})
    # whole paragraphs, of which only the notices' n-grams are kept
    held = f"filter({ALL_GRAMS}, g -> g IN ({_literals(vocabulary)}))"
    rows = versions.unionByName(other).where("size(words) > 0")
    rows = rows.selectExpr("label", "version", f"{held} AS grams")
    rows = stored(rows.coalesce(1), "licences")
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True)
    fitted = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=30
    ).fit(vectors.transform(rows.where("version % 4 <> 3")))
    matrix = fitted.coefficientMatrix.toArray()
    kinds = matrix.shape[0]
    weights = {
        g: [float(x) for x in matrix[:, k]]
        for k, g in enumerate(vocabulary)
        if abs(matrix[:, k]).max() > 1e-6
    }
    intercepts = [float(x) for x in fitted.interceptVector.toArray()]
    if kinds < len(FAMILIES):  # no other paragraph at all
        weights = {g: [*w, 0.0] for g, w in weights.items()}
        intercepts.append(0.0)
    model = Model(weights, intercepts, 1.0)
    held = rows.where("version % 4 = 3").select("label", "grams").collect()
    margins = [(int(r.label), _margin(model, r.grams)) for r in held]
    best = min((_loss(margins, t), t) for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0))
    return Model(weights, intercepts, best[1])


def _margin(model: Model, grams: list[str]) -> list[float]:
    found = [model.weights[g] for g in set(grams) if g in model.weights]
    return [b + sum(w[k] for w in found) for k, b in enumerate(model.intercepts)]


def _loss(margins: list[tuple[int, list[float]]], temperature: float) -> float:
    total = 0.0
    for label, m in margins:
        top = max(m)
        total += math.log(sum(math.exp((x - top) / temperature) for x in m))
        total -= (m[label] - top) / temperature
    return total


def _literals(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _let(name: str, value: str, then: str) -> str:
    """``then`` with ``name`` for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _judged(spans: DataFrame, model: Model, weights: DataFrame, known: bool) -> DataFrame:
    """(at, place, q): the probability of each family for spans (at, place, words).

    With ``known`` only spans that some family is likelier for than unknown.
    """
    kinds = len(FAMILIES)
    grams = sorted(model.weights)
    margins = [f"(w{k} + {b!r}D)" for k, b in enumerate(model.intercepts)]
    scaled = f"array({', '.join(f'{m} / {model.temperature!r}D' for m in margins)})"
    total = "aggregate(e, 0D, (a, y) -> a + y)"
    share = _let("e", "transform(m, x -> exp(x - t))", _let("z", total, "transform(e, x -> x / z)"))
    # outer, so that no test of the n-grams is pushed below the words
    summed = (
        spans.selectExpr("at", "place", f"explode_outer({_grams_among(grams)}) AS gram")
        .where("gram IS NOT NULL")
        .join(F.broadcast(weights), "gram")  # no larger than the notices' n-grams
        .groupBy("at", "place")
        .agg(*[F.sum(f"w{k}").alias(f"w{k}") for k in range(kinds)])
    )
    if known:
        summed = summed.where(f"greatest({', '.join(margins[:-1])}) >= {margins[-1]}")
    return summed.selectExpr("at", "place", f"{_let('m', scaled, _let('t', 'array_max(m)', share))} AS q")


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, family, probability, similarity, confirmed, n_notices, families.

    Paragraphs are the lines of a text and its runs of wrapped lines. ``family`` is that of the
    likeliest notice, a confirmed one first, or unknown with probability 0. ``similarity`` is the
    share of a notice's word pairs that are there (0 if fewer than two, or without the family's
    marks); ``families`` lists all confirmed ones, ``n_notices`` counts likely lines, those of a
    confirmed run as one notice of each family.
    Null and empty texts are unknown. Rows of equal id are told apart by their texts; equal rows
    count as one document and give a row each. No rows give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.struct(
            F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
            F.xxhash64(F.col(text_col).cast("string")).alias("salt"),
        ).alias("at"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    kinds = len(FAMILIES)
    grams = sorted(model.weights)
    single = sorted({w for g in grams for w in g.split()})
    fields = T.StructType([T.StructField("gram", T.StringType())])
    for k in range(kinds):
        fields = fields.add(f"w{k}", "double")
    weights = spark.createDataFrame([(g, *model.weights[g]) for g in grams], fields)
    lines = (
        _lines(rows, "text")
        .selectExpr("at", "place", f"{_WORDS} AS words")
        .where(f"exists(words, w -> w IN ({_literals(single) or 'NULL'}))")
    )
    templates = notices(spark).select("family", F.col("pairs").alias("notice"))
    pairs = sorted({p for r in templates.collect() for p in r.notice})
    words = sorted({w for p in pairs for w in p.split()})
    begun = _grams("words", 2, _literals(sorted({p.split()[0] for p in pairs})))
    known_pairs = f"array_distinct(filter({begun}, p -> p IN ({_literals(pairs)})))"
    # as an array of one element, so that no test is pushed below the words; only lines with two
    # word pairs of notices can confirm one, and only the words of wrapped lines are kept
    short = f"size(words) <= 3 AND forall(words, w -> w IN ({_literals(words)}))"
    near = stored(
        lines.selectExpr("at", "place", "words", f"explode_outer(array({known_pairs})) AS pairs")
        .selectExpr("*", f"({short}) OR size(pairs) >= {WRAPPED} * size(words) AS wrapped")
        .where("size(pairs) >= 2 OR wrapped")
        .selectExpr(
            "at",
            "place",
            "pairs",
            f"if(size(pairs) >= 2, {_marked('words')}, array()) AS marked",
            "if(wrapped, words, NULL) AS words",
        ),
        "near",
    )
    order = "row_number() OVER (PARTITION BY at ORDER BY place)"
    runs = (
        near.where("words IS NOT NULL")
        .selectExpr("at", "place", "words", f"place - {order} AS run")
        .groupBy("at", "run")
        .agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("own"))
        .where("size(own) > 1")
        .selectExpr(
            "at", "own[0].place AS place", "flatten(own.words) AS words", "own.place AS covers"
        )
    )
    runs = stored(
        runs.selectExpr("*", f"explode_outer(array({known_pairs})) AS pairs")
        .where("size(pairs) >= 2")
        .selectExpr("*", f"{_marked('words')} AS marked"),
        "runs",
    )
    judged = _judged(lines, model, weights, True)
    of = f"array({_literals(list(FAMILIES))})"
    notice = f"slice(q, 1, {kinds - 1})"
    sure = stored(
        judged.selectExpr(
            "at",
            "place",
            f"array_max({notice}) AS p",
            f"get({of}, cast(array_position(q, array_max({notice})) AS int) - 1) AS family",
        )
        .where(f"p >= {LEAST}"),
        "likely",
    )
    share = "size(array_intersect(notice, pairs)) / size(notice)"
    like = f"if(array_contains(marked, family), {share}, 0D)"
    likeness = (
        near.where("size(pairs) >= 2")
        .join(sure, ["at", "place"])
        .join(F.broadcast(templates), "family")
        .groupBy("at", "place")
        .agg(F.max(F.expr(like)).alias("like"))
    )
    single = sure.join(likeness, ["at", "place"], "left").fillna(0.0, ["like"])
    no_version = "NOT exists(c, y -> startswith(y.family, concat(x.family, '-')))"
    # a run may hold several notices, so each family marked in it is compared
    wrapped = (
        runs.join(_judged(runs, model, weights, False), ["at", "place"])
        .selectExpr("at", "place", "covers", "pairs", "marked", "q", "explode(marked) AS family")
        .join(F.broadcast(templates), "family")
        .groupBy("at", "place", "family")
        .agg(
            F.max(F.expr(like)).alias("like"),
            F.first("covers").alias("covers"),
            F.first(F.expr(f"get(q, cast(array_position({of}, family) AS int) - 1)")).alias("p"),
        )
        .where(f"like >= {CONFIRMED}")
        .groupBy("at", "place")
        .agg(F.collect_list(F.struct("family", "like", "covers", "p")).alias("c"))
        # a family of no version adds nothing to one of its versions in the same run
        .selectExpr("at", "place", f"inline(filter(c, x -> {no_version}))")
    )
    found = single.withColumn("covers", F.expr("cast(NULL AS array<int>)")).unionByName(wrapped)
    is_sure = F.expr(f"like >= {CONFIRMED}").alias("sure")
    sure_first = F.max(F.struct(is_sure, "p", "like", "family"))
    # a line of a confirmed run is no notice of its own
    alone = "collect_set(if(covers IS NULL, place, NULL))"
    covered = "array_distinct(flatten(collect_list(covers)))"
    in_runs = "count(DISTINCT if(covers IS NULL, NULL, struct(place, family)))"
    known = stored(
        found.groupBy("at").agg(
            sure_first.alias("best"),
            F.expr(f"size(array_except({alone}, {covered})) + {in_runs}").alias("n"),
            F.expr(f"sort_array(collect_set(if(like >= {CONFIRMED}, family, NULL)))").alias("all"),
        ),
        "notices",
    )
    out = rows.select("id", "at").join(known, "at", "left")
    return out.selectExpr(
        f"id AS `{id_col}`",
        f"coalesce(best.family, '{UNKNOWN}') AS family",
        "coalesce(best.p, 0D) AS probability",
        "coalesce(best.like, 0D) AS similarity",
        f"coalesce(best.like >= {CONFIRMED}, false) AS confirmed",
        "cast(coalesce(n, 0) AS long) AS n_notices",
        "coalesce(array_join(all, ','), '') AS families",
    )
