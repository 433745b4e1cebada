"""Licence scans (DataFrame functions only on the main path).

Paragraphs are classified by a sparse multinomial logistic regression over word n-grams.  Its classes are the licence families
and ``unknown``, which is learned like the others, from sentences that grant nothing; a temperature, fitted on rows the weights
did not see, calibrates the probabilities.  A prediction counts as confirmed if enough of a template of its family stands in the
paragraph.  The regression is fitted once on the driver from notices and neutral sentences; its weights are a small table of
fixed size.  Only n-grams around anchor words are features, so a paragraph without an anchor word is unknown by the intercepts
alone, and is left out.  A paragraph ends at an empty line, or at a line that ends a sentence: wrapped lines are read as one.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Durable, bind, table
from .labelled import sparse_softmax

GRAMS, CONFIRM, UNKNOWN = (1, 2, 3), 0.5, "unknown"

#: Notices of each family, as their licensors publish them.
NOTICES = {
    "agpl": ["licensed under the gnu affero general public license version 3", "this program is free software you can redistribute it under the terms of the gnu affero general public license as published by the free software foundation", "spdx-license-identifier agpl-3.0"],
    "apache": ["licensed under the apache license version 2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www.apache.org licenses license-2.0", "spdx-license-identifier apache-2.0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "licensed under the bsd 3-clause license", "use of this source code is governed by a bsd-style license", "spdx-license-identifier bsd-3-clause", "released under the bsd license"],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license", "spdx-license-identifier cc-by-4.0"],
    "cc-by-nc": ["licensed under cc by-nc 4.0", "this work is licensed under a creative commons attribution-noncommercial 4.0 international license", "licensed under cc by-nc-sa 4.0"],
    "cc-by-sa": ["licensed under cc by-sa 4.0", "this work is licensed under a creative commons attribution-sharealike 4.0 international license", "text is available under the creative commons attribution-sharealike license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights to this work cc0", "licensed under cc0 1.0 universal", "dedicated to the public domain under cc0"],
    "gpl": ["licensed under the gnu general public license version 3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "licensed under gpl-3.0", "released under the gplv3", "distributed under the gplv2 license", "spdx-license-identifier gpl-2.0"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "licensed under the isc license"],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1", "this library is free software you can redistribute it under the terms of the gnu lesser general public license", "licensed under lgpl-3.0"],
    "mit": ["licensed under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", "released under the mit license", "spdx-license-identifier mit"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2.0", "licensed under the mozilla public license version 2.0", "spdx-license-identifier mpl-2.0"],
    "proprietary": ["all rights reserved", "confidential and proprietary unauthorized copying of this file is strictly prohibited", "copyright all rights reserved no part of this publication may be reproduced without permission"],
}
#: Sentences with the same words that grant nothing.
NEUTRAL = (
    "she renewed her driver license at the public office", "the restaurant lost its license to sell wine", "licensed doctors work in general practice",
    "copyright law is taught in the second year", "the general public was free to visit the software museum", "a new version of the story was published",
    "he asked for permission to leave the room", "the terms of the contract were met without modification", "the commons were open to the public",
    "this work is of high quality and may be reproduced", "fishing license fees rose again this year", "the foundation of the house was free of cracks",
    "students at mit and other schools met", "the apache helicopter landed", "source and binary stars are observed by astronomers",
    "rights of way are reserved for walkers", "the program is broadcast in version 2 form", "the public domain of science grows", "terms and conditions apply to this offer",
    "a license plate was found in the river", "the artist is known under the name of cc", "copies of the documentation are available at the desk",
    "the software is provided as is without warranty of any kind express or implied", "the authors accept no liability for any damages",
    "the warranty of the car ran out", "liability insurance is required for drivers", "the merchantability of the goods was in doubt",
    "their licence to broadcast was granted by the public council", "the license of the shop hung on the wall",
)
#: Words one of which every weighted n-gram holds.
ANCHORS = tuple(
    "license licensed licenses copyright permission redistribution redistribute rights gnu gpl-2.0 gpl-3.0 lgpl-3.0 agpl-3.0 apache apache-2.0 bsd bsd-style bsd-3-clause cc cc0 by-nc by-sa by-nc-sa mozilla mpl-2.0 isc affero creative spdx-license-identifier cc-by-4.0 proprietary governed public gpl gplv2 gplv3 lgpl agpl warranty warranties merchantability liability".split()
)
_GATE = r"(?i)(?<![A-Za-z0-9.-])(" + "|".join(re.escape(a).replace("licens", "licen[sc]") for a in ANCHORS) + ")(?![A-Za-z0-9])"
#: The end of a paragraph.
_BREAK = r"(?<=[.!?:;])[ \t\r]*\n|\n[ \t\r]*\n"
_TOKEN = r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?"


def words(text: str) -> list[str]:
    return re.findall(_TOKEN, text.translate(_ASCII_LOWER).replace("licenc", "licens"))


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def grams(w: list[str]) -> set[str]:
    out = {" ".join(w[i : i + n]) for n in GRAMS for i in range(len(w) - n + 1)}
    return {g for g in out if any(x in ANCHORS for x in g.split(" "))}


class Model:
    """``weights[gram]`` holds one number per class, ``bias`` the intercepts; both are divided by the temperature."""

    def __init__(self, families, weights, bias, templates):
        self.families, self.weights, self.bias, self.templates = families, weights, bias, templates


def labelled_rows(seed: int = 5, rounds: int = 12) -> list[tuple[str, list[str]]]:
    """(class, words) of notices and neutral sentences, shortened and put among other words."""
    r = random.Random(seed)
    filler = "the a and of to in it was there many people after some long time river house garden old new year walked found seen".split()

    def vary(text: str, cut: bool = True) -> list[str]:
        w = text.split()
        if cut and len(w) > 6 and r.random() < 0.4:
            a = r.randint(0, len(w) // 4)
            w = w[a : len(w) - r.randint(0, len(w) // 4)]
        before, after = (r.choices(filler, k=r.randint(0, 12)) for _ in "12")
        return before + w + after

    rows = []
    for _ in range(rounds):
        for f, notices in NOTICES.items():
            rows += [(f, words(" ".join(vary(n)))) for n in notices]
        rows += [(UNKNOWN, words(" ".join(vary(n, cut=False)))) for n in NEUTRAL for _ in "12"]
    return rows


@functools.lru_cache(maxsize=1)
def train(seed: int = 5) -> Model:
    """The same model every time; every fourth row fits the temperature only."""
    rows = labelled_rows(seed)
    names: dict[str, int] = {}
    x = [np.array(sorted(names.setdefault(g, len(names)) for g in grams(w)), np.int64) for _, w in rows]
    families = [*sorted(NOTICES), UNKNOWN]
    y = np.array([families.index(f) for f, _ in rows])
    held = np.arange(len(rows)) % 4 == 0
    w = sparse_softmax([a for a, h in zip(x, held) if not h], y[~held], len(names), len(families), l2=0.02)
    z = np.array([w[a].sum(0) + w[-1] for a, h in zip(x, held) if h])

    def loss(t):
        s = z / t
        return float((np.logaddexp.reduce(s, axis=1) - s[np.arange(len(s)), y[held]]).mean())

    heat = min(np.exp(np.linspace(-2, 2, 81)), key=loss)
    weights = {g: [round(float(v), 6) for v in w[i] / heat] for g, i in names.items() if np.abs(w[i]).max() > 1e-3}
    templates = [(f, i, sorted({" ".join(t[j : j + 2]) for j in range(len(t) - 1)})) for f, ns in NOTICES.items() for i, t in enumerate(map(str.split, ns))]
    return Model(families, weights, [round(float(b), 6) for b in w[-1] / heat], templates)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, paragraph, family, score, confirmed) of every paragraph that holds an anchor word.

    Paragraphs are counted from 0 with empty ones.  ``score`` is the probability of the family that is named, which may be
    ``unknown``; of equal probabilities the first in the order of names, unknown last, wins.  Null and empty texts have no such
    paragraph, an empty table gives an empty result, and a very long paragraph is read whole.  Rows of one id are told apart by a
    number of their own, so repeated rows give repeated results; other columns are not read.
    """
    spark, m = docs.sparkSession, train()
    parts = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .where(F.col("text").rlike(_GATE))
        .withColumn("row", F.monotonically_increasing_id())
        .select("id", "row", F.posexplode(F.split("text", _BREAK, -1)).alias("paragraph", "line"))
        .where(F.col("line").rlike(_GATE))
    )
    low = F.replace(F.translate("line", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("licenc"), F.lit("licens"))
    heads = F.array(*map(F.lit, sorted({g.split(" ")[0] for _, _, gs in m.templates for g in gs})))
    anchors = F.array(*map(F.lit, ANCHORS))

    def near(w):
        """The n-grams around anchor words, and the pairs that may stand in a template."""

        def of(n, x):
            starts = F.sequence(F.lit(0), F.size(w) - n)
            hit = lambda i: F.exists(F.slice(x["anchor"], i + 1, F.lit(n)), lambda a: a)
            keep = (lambda i: hit(i) | F.get(x["head"], i)) if n == 2 else hit
            return F.when(F.size(w) >= n, F.transform(F.filter(starts, keep), lambda i: F.array_join(F.slice(w, i + 1, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))

        flags = F.struct(F.transform(w, lambda x: F.array_contains(anchors, x)).alias("anchor"), F.transform(w, lambda x: F.array_contains(heads, x)).alias("head"))
        return bind(flags, lambda x: F.array_distinct(F.concat(*[of(n, x) for n in GRAMS])))

    every = bind(F.regexp_extract_all(low, F.lit(_TOKEN), F.lit(0)), near)
    weights = spark.createDataFrame([(g, *v) for g, v in m.weights.items()], "gram string, " + ", ".join(f"`{f}` double" for f in m.families))
    pairs = spark.createDataFrame([(g, f, i, len(gs)) for f, i, gs in m.templates for g in gs], "gram string, f string, t int, size int")
    pairs = pairs.groupBy("gram").agg(F.collect_list(F.struct("f", "t", "size")).alias("of"))
    # both tables are made of the notices above, so their size is fixed
    both = weights.join(F.broadcast(pairs), "gram", "full")
    key = ["id", "row", "paragraph"]
    seen = parts.select(*key, F.explode_outer(every).alias("gram")).join(F.broadcast(both), "gram", "left")
    sums = [F.coalesce(F.sum(f), F.lit(0.0)).alias(f) for f in m.families]
    found = seen.groupBy(*key).agg(*sums, F.flatten(F.collect_list("of")).alias("of"))
    z = F.array(*[(F.col(f) + b).alias(f) for f, b in zip(m.families, m.bias)])
    options = F.array(*[F.struct((F.col(f) + m.bias[k]).alias("z"), F.lit(-k).alias("k"), F.lit(f).alias("f")) for k, f in enumerate(m.families)])
    hits = lambda t: F.size(F.filter("of", lambda x: (x["f"] == t["f"]) & (x["t"] == t["t"])))
    matched = F.exists("of", lambda t: (t["f"] == F.col("best.f")) & (hits(t) >= t["size"] * CONFIRM))
    total = F.aggregate(z, F.lit(0.0), lambda s, x: s + F.exp(x - F.col("best.z")))
    return found.withColumn("best", F.array_max(options)).select(
        F.col("id").alias(id_col), "paragraph", F.col("best.f").alias("family"), (1 / total).alias("score"), matched.alias("confirmed")
    )


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: id, paragraphs with a licence, of unknown and of confirmed ones, families by name, the surest one's probability.

    Rows are numbered where they are read, and what is found of one is joined to its number, so repeated rows give equal results.
    """
    known = F.col("family") != UNKNOWN
    rows = Durable(docs.sparkSession, "licenses").write(
        docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.when(F.col(text_col).rlike(_GATE), F.col(text_col)).alias("text")))
    found = classify(rows, "row").groupBy("row").agg(
        F.count_if(known).alias("n_licensed"), F.count_if(~known).alias("n_unknown"), F.count_if("confirmed").alias("n_confirmed"),
        F.array_join(F.sort_array(F.collect_set(F.when(known, F.col("family")))), ",").alias("families"),
        F.round(F.coalesce(F.max(F.when(known, F.col("score"))), F.lit(0.0)), 6).alias("score"))
    none = {"n_licensed": 0, "n_unknown": 0, "n_confirmed": 0, "families": "", "score": 0.0}
    return rows.select(F.col("id").alias(id_col), "row").join(found, "row", "left").drop("row").fillna(none)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents"))


def best_of(w: list[str]) -> tuple[str, float]:
    """Class and probability of a paragraph's words, in plain Python, for tests."""
    m = train()
    g = grams(w)
    z = [sum(m.weights[x][k] for x in g if x in m.weights) + m.bias[k] for k in range(len(m.families))]
    k = max(range(len(z)), key=lambda k: (z[k], -k))
    return m.families[k], 1 / sum(np.exp(v - z[k]) for v in z)


def brute(text: str | None) -> list[tuple[int, str, float, bool]]:
    """The same for one text in plain Python, for tests."""
    m, out = train(), []
    for i, line in enumerate(re.split(_BREAK, text or "")):
        if not re.search(_GATE, line):
            continue
        w = words(line)
        family, p = best_of(w)
        g = {" ".join(w[j : j + 2]) for j in range(len(w) - 1)}
        ok = any(f == family and sum(x in g for x in t) >= len(t) * CONFIRM for f, _, t in m.templates)
        out.append((i, family, float(p), bool(ok)))
    return out
