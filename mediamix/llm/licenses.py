"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a text, and every text as a whole, is compared with licence templates as a
sparse TF-IDF vector. Document frequencies of the templates' terms are counted over the
whole corpus. A document declares the licence of its best line. Licence files name the
licence of their directory; documents that declare none inherit from the nearest ancestor
directory that has one, by joins on paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.llm.common import map_batches, type_of, whole_text
from mediamix.session import cut_lineage

#: Statements and notices of common licences, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ARR", "All rights reserved."),
]
TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: Names of licence files, whatever they hold.
FILE_NAME = re.compile(r"(?:licen[cs]e|copying|unlicense|notice)(?:[.-][^/]*)?", re.IGNORECASE)
LEAST_COSINE = 0.6


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


VOCABULARY = frozenset(t for _, text in TEMPLATES for t in terms(text))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each template term.

    Tasks count what they read; at most one row per term reaches the driver.
    """

    def make():
        def run(columns: dict) -> dict:
            counts: Counter = Counter({"": len(columns["text"])})
            for t in columns["text"]:
                counts.update(VOCABULARY.intersection(terms(t)))
            return {"term": list(counts), "n": list(counts.values())}

        return run

    found = map_batches(docs.select(whole_text(text).alias("text")), make, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r.term: r.n for r in found.collect()}
    return counts.pop("", 0), counts


class Matcher:
    """Cosines to the templates under given document frequencies."""

    def __init__(self, documents: int, frequencies: dict[str, int], least: float = LEAST_COSINE):
        self.least = least
        self.idf = {t: math.log((1 + documents) / (1 + frequencies.get(t, 0))) + 1 for t in VOCABULARY}
        self.other = math.log(1 + documents) + 1  # a term that no template has, whatever its frequency
        #: term -> (template, weight in its unit vector)
        self.holders: dict[str, list[tuple[int, float]]] = {}
        for n, (_, text) in enumerate(TEMPLATES):
            weights = {t: c * self.idf[t] for t, c in Counter(terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                self.holders.setdefault(t, []).append((n, w / norm))

    def best(self, found: list[str]) -> tuple[float, str | None]:
        """Highest cosine, if it is enough, and its licence; ties go to the earlier template."""
        if VOCABULARY.isdisjoint(found):
            return 0.0, None
        inside = outside = 0.0
        weights = {}
        for t, c in Counter(found).items():
            if t in self.idf:
                weights[t] = w = c * self.idf[t]
                inside += w * w
            else:
                outside += (c * self.other) ** 2
        whole = inside + outside
        if inside < self.least**2 * whole:  # no cosine can be more than that share
            return 0.0, None
        dots = [0.0] * len(TEMPLATES)
        for t, w in weights.items():
            for n, share in self.holders[t]:
                dots[n] += w * share
        n = max(range(len(dots)), key=lambda i: (dots[i], -i))
        score = dots[n] / math.sqrt(whole)
        return (score, TEMPLATES[n][0]) if score >= self.least else (0.0, None)


def _declared(docs: DataFrame, key: str, text: str, path: str, matcher: Matcher) -> DataFrame:
    """(key, path, dir, declared, score, line, is_file) per document."""

    def make():
        def run(columns: dict) -> dict:
            out: dict = {n: [] for n in ("key", "path", "dir", "declared", "score", "line", "is_file")}
            for number, place, t in zip(columns["key"], columns["path"], columns["text"]):
                best, at, licensed, total = (0.0, None), None, 0, 0
                for n, line in enumerate(t.split("\n")):
                    found = terms(line)
                    total += len(found)
                    score, name = matcher.best(found)
                    if name:
                        licensed += len(found)
                        if score > best[0]:
                            best, at = (score, name), n
                whole = matcher.best(terms(t)) if "\n" in t else best
                if whole[0] > best[0]:
                    best, at = whole, None
                named = place is not None and FILE_NAME.fullmatch(place.rpartition("/")[2]) is not None
                row = (number, place, None if place is None else place.rpartition("/")[0], best[1], best[0], at, best[1] is not None and (named or 2 * licensed > total or whole[1] is not None))
                for name, value in zip(out, row):
                    out[name].append(value)
            return out

        return run

    plain = docs.select(F.col(key).alias("key"), F.col(path).cast("string").alias("path"), whole_text(text).alias("text"))
    return map_batches(plain, make, f"key {type_of(docs, key)}, path string, dir string, declared string, score double, line int, is_file boolean")


def scan(docs: DataFrame, path: str = "path", key: str = "doc_id", text: str = "text", least: float = LEAST_COSINE) -> DataFrame:
    """Licences of all documents, declared or inherited; one row for each row of ``docs``.

    Returns ``key``, ``path``, ``declared`` and ``score`` (best template with a cosine of
    ``least`` or more; null and 0 if there is none), ``line`` (from 0; null if it is the
    text as a whole), ``is_file`` (it is a licence file: by its name, or more than half of
    its terms are in licence lines, or it matches as a whole), ``inherited`` and
    ``inherited_from`` (licence and path of the nearest ancestor directory with a licence
    file; of several files there, the best score, then the first name), ``license``
    (declared, else inherited). A document inherits from its own directory first and from
    the root, '', last. Null and empty texts declare nothing; a null path has no directory
    and inherits nothing; repeated rows give repeated rows; other columns are not read.
    """
    matcher = Matcher(*document_frequencies(docs, text), least)
    found = cut_lineage(_declared(docs, key, text, path, matcher))
    own = found.where("is_file AND dir IS NOT NULL").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("score"), "declared")).alias("best"))
    own = own.select(F.col("dir").alias("ancestor"), F.col("best.declared").alias("inherited"))
    # on distinct directories: a directory with very many documents is joined once
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    dirs = found.where("dir IS NOT NULL").select("dir").distinct()
    near = dirs.select("dir", F.posexplode(F.array_distinct(ancestors)).alias("depth", "ancestor")).join(own, "ancestor")
    nearest = near.groupBy("dir").agg(F.max(F.struct("depth", "ancestor", "inherited")).alias("n"))
    nearest = nearest.select("dir", F.col("n.inherited").alias("inherited"), F.col("n.ancestor").alias("inherited_from"))
    out = found.join(nearest, "dir", "left")
    return out.select(F.col("key").alias(key), "path", "declared", "score", "line", "is_file", "inherited", "inherited_from", F.coalesce("declared", "inherited").alias("license"))
