"""License scan by diagonal voting.

The hash of every run of ``k`` consecutive words of every text is joined, in
Spark, to the places where the license templates have the same run.  A match of
text place p and template place t votes for the diagonal p - t.  Votes are
counted per document, template and diagonal before anything is grouped by
document; neighbouring diagonals (a word put in or left out) are merged into
one candidate span, and the span is verified against the template by its share
of the template's words that occur there in order.

Notices of some licenses differ in a word or two.  A template that holds the name
of its license (``NAMES``) is kept only where the text has a name of that license
in the same place, the longest name that stands there.  Of spans with different
labels that then still cover one place, the one with the best share both ways
(of the template's words and of the span's) is kept.

The template table is the only broadcast side; its size is fixed by the
templates given (a few thousand rows), checked before the hint.  A word run that
half of all documents share meets at most its places in the templates, so votes
grow with the text, not with its square.

Base labels, of phrases found word for word, are counted in a pass of their own
and always stay.

Defined results: a null or empty text has no words, no labels and score 0;
repeated rows give repeated results, and rows of one id with other texts their
own (``row`` is a hash of id and text); extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import NO_ALNUM, Words, columns, rolling, slices

# The base phrases and their labels, and notices that public
# licenses ask to be put into files (one label, one or more texts).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    "apache": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        'required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Licensed under the Apache License, Version 2.0.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "Released under the MIT License.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer.",
        "Released under the BSD License.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
}

# Names that tell a license from those with like notices; "" are
# licenses without a template.  Where one name begins another, the longer counts.
_NC, _SA = ("noncommercial", "non commercial"), ("sharealike", "share alike")
_ND = ("noderivatives", "no derivatives", "noderivs", "no derivs")
NAMES = {
    "gnu general public": "gpl",
    "gnu lesser general public": "lgpl",
    "gnu library general public": "lgpl",
    "gnu affero general public": "agpl",
    "creative commons attribution": "cc-by",
    "cc by": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    **{f"cc by {x}": "" for x in ("nd", "nc sa", "nc nd")},
    **{f"creative commons attribution {x}": "cc-by-nc" for x in _NC},
    **{f"creative commons attribution {x}": "cc-by-sa" for x in _SA},
    **{f"creative commons attribution {x}": "" for x in _ND},
    **{f"creative commons attribution {x} {y}": "" for x in _NC for y in (*_SA, *_ND)},
}

#: Words in a run; how far diagonals of one span may lie apart; the share of a
#: template's words that a span must hold in order.
K, NEIGHBOUR, SHARE = 3, 3, 0.75
#: Bytes the template table may have to be broadcast.
BROADCAST_LIMIT = 8 << 20


def template_words(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, np.ndarray]]:
    return [(label, Words(pa.array([t]), NO_ALNUM).hash) for label, texts in templates.items() for t in texts]


def template_table(spark, templates: dict[str, tuple[str, ...]], k: int = K) -> DataFrame:
    """``hash, template, place`` of each run of ``k`` words of each template."""
    rows = [(int(h), i, p) for i, (_, words) in enumerate(template_words(templates))
            for p, h in enumerate(rolling(words, k).view(np.int64))]
    return spark.createDataFrame(rows, "hash long, template int, place int")


def word_runs(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, row, p, hash`` of every run of ``k`` words of every text (p: its
    first word).  ``row`` tells texts of one id apart."""

    def run(batches):
        for b in (s for b in batches for s in slices(b, 8 << 20)):
            w = Words(b.column(1), NO_ALNUM)
            runs = rolling(w.hash, k)
            n = np.maximum(np.diff(w.starts) - k + 1, 0)
            first = np.repeat(w.starts[:-1], n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(n)), n)))
            row = b.column(2).take(pa.array(np.repeat(np.arange(len(n)), n)))
            for x in range(0, len(at), 1 << 20):
                y = slice(x, x + (1 << 20))
                yield pa.RecordBatch.from_arrays(
                    [ids[y], row[y], pa.array((at - first)[y].astype(np.int32)), pa.array(runs[at[y]].view(np.int64))],
                    names=["doc_id", "row", "p", "hash"])

    return docs.mapInArrow(run, "doc_id long, row long, p int, hash long")


def name_words(names: dict[str, str]) -> list[tuple[str, np.ndarray]]:
    """Label and words of each name, short ones first."""
    return sorted(((label, Words(pa.array([n]), NO_ALNUM).hash) for n, label in names.items()), key=lambda x: len(x[1]))


def named(w: Words, wanted: list[tuple[str, np.ndarray]]) -> dict[int, str]:
    """Label of the longest name that begins at a word, by the word's number."""
    first = {h: np.flatnonzero(w.hash == h) for h in {words[0] for _, words in wanted}}
    out: dict[int, str] = {}
    for label, words in wanted:
        at = first[words[0]]
        at = at[at + len(words) <= len(w.hash)]
        for i, h in enumerate(words):
            at = at[w.hash[at + i] == h]
        at = at[at + len(words) <= w.starts[np.searchsorted(w.starts, at, side="right")]]
        out.update(dict.fromkeys(at.tolist(), label))
    return out


def base_labels(docs: DataFrame, phrases: dict[str, str] = PHRASES, licenses: dict[str, str] = NAMES) -> DataFrame:
    """``doc_id, row, n_words, n_base, first_word, last_word, base`` (the labels, an
    array) and ``names`` (first word and label of every name of a license)."""
    wanted = [(label, Words(pa.array([p]), NO_ALNUM).hash) for p, label in phrases.items()]
    names = sorted({label for label, _ in wanted})
    known = name_words(licenses)

    def run(batches):
        for b in (s for b in batches for s in slices(b, 8 << 20)):
            w = Words(b.column(1), NO_ALNUM)
            n = len(w.starts) - 1
            doc_of_end = np.searchsorted(w.starts, np.arange(len(w.hash)), side="right") - 1
            count, has = np.zeros(n, np.int64), np.zeros((n, len(names)), bool)
            low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            for label, words in wanted:
                m = len(words)
                at = np.arange(max(0, len(w.hash) - m + 1))
                for i, h in enumerate(words):
                    at = at[w.hash[at + i] == h]
                d = doc_of_end[at]
                inside = at + m <= w.starts[d + 1]
                d, p = d[inside], (at - w.starts[d])[inside]
                np.add.at(count, d, 1)
                np.minimum.at(low, d, p)
                np.maximum.at(high, d, p)
                has[d, names.index(label)] = True
            none = count == 0
            called: list[list[tuple[int, str]]] = [[] for _ in range(n)]
            for at, label in sorted(named(w, known).items()):
                called[doc_of_end[at]].append((int(at - w.starts[doc_of_end[at]]), label))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.diff(w.starts)), pa.array(count), pa.array(low, mask=none),
                 pa.array(high, mask=none), pa.array([[x for x, y in zip(names, r) if y] for r in has], pa.list_(pa.string())),
                 pa.array([[{"p": p, "label": x} for p, x in r] for r in called], pa.list_(pa.struct([("p", pa.int32()), ("label", pa.string())])))],
                names=["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base", "names"])

    return docs.mapInArrow(run, "doc_id long, row long, n_words long, n_base long, first_word long, last_word long, base array<string>, "
                                "names array<struct<p: int, label: string>>")


def diagonals(runs: DataFrame, table: DataFrame) -> DataFrame:
    """Votes: ``doc_id, row, template, diagonal, votes, low, high`` and ``places``,
    the set of template places that voted (never more than the template has)."""
    return (runs.join(table, "hash")
            .withColumn("diagonal", F.col("p") - F.col("place"))
            .groupBy("doc_id", "row", "template", "diagonal")
            .agg(F.count("*").alias("votes"), F.min("p").alias("low"), F.max("p").alias("high"),
                 F.collect_set("place").alias("places")))


def verified(votes: DataFrame, sizes: list[tuple[str, int]], k: int = K, near: int = NEIGHBOUR, share: float = SHARE) -> DataFrame:
    """``doc_id, row, template, label, share, back, low, high, least, most``: merged
    spans that hold at least ``share`` of their template's words; ``back`` is the
    share of the span's words, ``least`` and ``most`` are its diagonals.  Diagonals of one document and template
    are a chain sorted by value; a step of more than ``near`` starts a new span.
    No span is dropped for its width: of a chain wider than twice its template the
    best stretches are taken."""
    w = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    labels = F.array(*[F.lit(label) for label, _ in sizes])
    key = ["doc_id", "row", "template", "span"]

    def covered(places: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + F.lit(k - 1)))))

    def measured(spans: DataFrame) -> DataFrame:
        size = F.col("high") - F.col("low")
        return (spans.withColumn("share", F.least(F.size("covered"), size) / F.col("words"))       # no more words than the span has
                .where(F.col("share") >= share).withColumn("back", F.least(F.size("covered") / size, F.lit(1.0))))

    chain = Window.partitionBy(*key)
    rows = (votes
            .withColumn("_new", (F.col("diagonal") - F.lag("diagonal").over(w) > near).cast("int"))
            .withColumn("span", F.sum(F.coalesce("_new", F.lit(0))).over(w)).drop("_new")
            .withColumn("words", F.element_at(F.array(*[F.lit(n) for _, n in sizes]), F.col("template") + 1))
            .withColumn("width", F.max("high").over(chain) + k - F.min("low").over(chain)))
    whole = measured(rows.where(F.col("width") <= 2 * F.col("words")).groupBy(*key, "words").agg(
        covered(F.flatten(F.collect_list("places"))).alias("covered"), F.min("low").alias("low"), (F.max("high") + k).alias("high"),
        F.min("diagonal").alias("least"), F.max("diagonal").alias("most")))
    # A chain wider than twice its template holds several spans, or names repeated behind one: its stretches
    # of one diagonal, and of as many as the template has words, compete; the best of a neighbourhood stays.
    wide = rows.where(F.col("width") > 2 * F.col("words")).withColumn("x", F.floor(F.col("diagonal") * 4096 / F.col("words")))   # 4096: a template
    order = Window.partitionBy(*key).orderBy("x")
    to_right, around = order.rangeBetween(0, 4096), order.rangeBetween(-4096, 4096)
    fixed = [*key, "words", "x", F.col("diagonal").alias("least")]
    stretches = wide.select(*fixed, covered(F.col("places")).alias("covered"), "low", (F.col("high") + k).alias("high"), F.col("diagonal").alias("most")).unionByName(
        wide.select(*fixed, covered(F.flatten(F.collect_list("places").over(to_right))).alias("covered"), F.min("low").over(to_right).alias("low"),
                    (F.max("high").over(to_right) + k).alias("high"), F.max("diagonal").over(to_right).alias("most")))
    worth = F.struct(F.col("share") * F.col("back"), "share", -F.col("least"), -F.col("most"))
    best = measured(stretches).withColumn("worth", worth).withColumn("most_worth", F.max("worth").over(around))
    best = best.where(F.col("worth") == F.col("most_worth")).select(*whole.columns).dropDuplicates([*key, "least", "most"])
    return whole.unionByName(best).select("doc_id", "row", "template", F.element_at(labels, F.col("template") + 1).alias("label"),
                                          "share", "back", "low", "high", "least", "most")


def decided(spans: list[dict], names: list[dict], places: list[list[int]], near: int = NEIGHBOUR) -> list[dict]:
    """The spans of one text that stay.  ``places``: where each template has names
    of its own license."""
    def fits(s: dict) -> bool:
        return not places[s["template"]] or any(
            s["least"] - near <= n["p"] - t <= s["most"] + near for n in by_label.get(s["label"], ())
            if s["low"] <= n["p"] < s["high"] for t in places[s["template"]])

    by_label: dict[str, list[dict]] = {}
    for n in names:
        by_label.setdefault(n["label"], []).append(n)
    kept: list[dict] = []
    beside: dict[int, list[dict]] = {}          # kept spans by the parts of 256 words that they touch
    for s in sorted(filter(fits, spans), key=lambda s: (-s["share"] * s["back"], s["low"] - s["high"], s["low"], s["template"])):
        parts = range(s["low"] // 256, (s["high"] - 1) // 256 + 1)
        if not any(t["label"] != s["label"] and 2 * (min(s["high"], t["high"]) - max(s["low"], t["low"])) >
                   min(s["high"] - s["low"], t["high"] - t["low"]) for i in parts for t in beside.get(i, ())):
            kept.append(s)
            for i in parts:
                beside.setdefault(i, []).append(s)
    return sorted(kept, key=lambda s: (s["low"], s["high"], s["label"], s["share"]))


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         k: int = K, near: int = NEIGHBOUR, share: float = SHARE, names: dict[str, str] = NAMES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans``."""
    spark = docs.sparkSession
    rows = columns(docs).withColumn("row", F.xxhash64("doc_id", "text"))
    sizes = [(label, len(words)) for label, words in template_words(templates)]
    known = name_words(names)
    places = [[p for p, x in named(Words(pa.array([t]), NO_ALNUM), known).items() if x == label]
              for label, texts in templates.items() for t in texts]
    table = template_table(spark, templates, k)
    if 16 * sum(n for _, n in sizes) <= BROADCAST_LIMIT:
        table = F.broadcast(table)
    found = (verified(diagonals(word_runs(rows, k), table), sizes, k, near, share)
             .groupBy("doc_id", "row")
             .agg(F.collect_list(F.struct("low", "high", "label", "share", "back", "template", "least", "most")).alias("spans")))
    base, found = base_labels(rows, phrases, names).alias("b"), found.alias("f")
    same = (F.col("b.row") == F.col("f.row")) & F.col("b.doc_id").eqNullSafe(F.col("f.doc_id"))
    span = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32()), ("label", pa.string()), ("share", pa.float64())]))

    def decide(batches):
        for b in batches:
            spans = [s and decided(s, n, places, near) for s, n in zip(b.column("spans").to_pylist(), b.column("names").to_pylist())]
            spans = [[{x: s[x] for x in ("low", "high", "label", "share")} for s in r] if r else None for r in spans]
            keep = [c for c in b.schema.names if c not in ("spans", "names")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(spans, span)], names=[*keep, "spans"])

    none = F.array().cast("array<string>")
    label = F.coalesce(F.transform("spans", lambda s: s["label"]), none)
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return (base.join(found, same, "left")
            .select("b.doc_id", "n_words", "n_base", "first_word", "last_word", "base", "names", "spans")
            .mapInArrow(decide, "doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, "
                                "spans array<struct<low: int, high: int, label: string, share: double>>")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union("base", label)), ",").alias("labels"),
                    F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(best, F.lit(1.0))).alias("score"),
                    "spans"))
