"""Licence scans: cosines, licence files, inheritance."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mediamix.llm import licenses


def at(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, path string, text string")


def test_declared_and_nearest_ancestor(spark):
    apache, mit, gpl = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    prose = "of the inner tionhe and er ande with reth"
    rows = [
        (1, "LICENSE", f"{mit}\n{prose} {prose}"),
        (2, "a/b/COPYING.txt", gpl),
        (3, "a/b/c/code", prose),
        (4, "a/b/other", f"{apache}\n{prose}"),
        (5, "a/x", prose),
        (6, "top", prose),
        (7, None, prose),
        (8, "a/b/c/d/e/deep", ""),
        (9, "ab/c", None),
        (10, "z/statement", apache),
        (11, "z/y/file", "the licensed version of a public story"),
    ]
    got = {r.doc_id: (r.declared, r.is_file, r.inherited, r.inherited_from, r.license) for r in licenses.scan(at(spark, rows)).collect()}
    assert got == {
        1: ("MIT", True, "MIT", "", "MIT"),
        2: ("GPL-3.0", True, "GPL-3.0", "a/b", "GPL-3.0"),
        3: (None, False, "GPL-3.0", "a/b", "GPL-3.0"),
        4: ("Apache-2.0", False, "GPL-3.0", "a/b", "Apache-2.0"),
        5: (None, False, "MIT", "", "MIT"),
        6: (None, False, "MIT", "", "MIT"),
        7: (None, False, None, None, None),
        8: (None, False, "GPL-3.0", "a/b", "GPL-3.0"),
        9: (None, False, "MIT", "", "MIT"),
        10: ("Apache-2.0", True, "Apache-2.0", "z", "Apache-2.0"),
        11: (None, False, "Apache-2.0", "z", "Apache-2.0"),
    }


def test_every_template_finds_itself():
    matcher = licenses.Matcher(1000, {})
    for name, text in licenses.TEMPLATES:
        score, found = matcher.best(licenses.terms(text))
        assert found == name and score == pytest.approx(1)


def test_small_table_against_plain_cosines(spark, docs, texts):
    n = len(texts)
    frequency = Counter(t for _, text in texts for t in licenses.VOCABULARY & set(licenses.terms(text or "")))
    assert licenses.document_frequencies(docs(texts)) == (n, dict(frequency))

    def vector(found):
        weights = {t: c * (math.log((1 + n) / (1 + (frequency[t] if t in licenses.VOCABULARY else 0))) + 1) for t, c in Counter(found).items()}
        norm = math.sqrt(sum(w * w for w in weights.values())) or 1
        return {t: w / norm for t, w in weights.items()}

    templates = [(name, vector(licenses.terms(text))) for name, text in licenses.TEMPLATES]
    expected = {}
    for key, text in texts:
        units = [*(text or "").split("\n"), text or ""]
        scores = [(sum(w * t.get(x, 0) for x, w in vector(licenses.terms(u)).items()), name) for u in units for name, t in templates]
        best = max(s for s, _ in scores)
        expected[key] = ({name for s, name in scores if s > best - 1e-9}, best) if best >= 0.6 else ({None}, 0)
    got = licenses.scan(docs(texts).withColumn("path", F.lit("x"))).collect()
    assert len(got) == n and sum(r.declared is not None for r in got) > 3
    for r in got:
        names, best = expected[r.doc_id]
        assert r.declared in names and r.score == pytest.approx(best)


def test_edges(spark):
    assert licenses.scan(at(spark, [])).count() == 0
    rows = [(1, "a//b", "Released under the MIT License."), (1, "a//b", "Released under the MIT License."), (None, "a/c", "x" * 1_000_000)]
    more = at(spark, rows).withColumn("dir", F.lit(1)).withColumn("declared", F.lit("x"))
    assert sorted((r.doc_id or 0, r.license) for r in licenses.scan(more).collect()) == [(0, None), (1, "MIT"), (1, "MIT")]
