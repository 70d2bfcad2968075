"""The scan against a plain Python version of the same rules."""

import re

from helpers import plan
from weirstone.llm.license_rules import CONFIDENCE, build_rules
from weirstone.llm.license_scan import BASE, scan

TEXTS = [
    None,
    "",
    "No terms here.",
    "Licensed under the Apache License, Version 2.0. See the license file.",
    "CC BY cc-by; CC\nBY\tcc by CCBY xcc by cc byx écc by",
    "GNU General   Public\nLicense, version 3. All rights reserved.",
    "SPDX-License-Identifier: MIT\nMIT License https://opensource.org/licenses/MIT",
    "all rights reserved " * 300,
    "Distributed under the terms of the GNU Lesser General Public License v2.1, 3-clause BSD license, Mozilla Public License 2.0",
    "Creative Commons Attribution 4.0 International creativecommons https://creativecommons.org/licenses/by/4.0/",
    "PERMISSION IS HEREBY GRANTED, FREE OF CHARGE, to any person \U0001f600 Copyright (c) 2020 cc by",
    "İ K cc by",
]


def brute(text):
    low = (text or "").lower()
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
    found = []
    for n, rule in enumerate(build_rules()):
        if rule.keyword in low:
            found += [(m.start(), m.end(), rule.tier, n, rule.label) for m in re.finditer(rule.pattern, low, re.ASCII)]

    def hides(e, d):
        if (e[0], e[1]) == (d[0], d[1]):
            return (e[2], e[3]) < (d[2], d[3])
        return e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2]

    kept = sorted(d for d in found if not any(hides(e, d) for e in found if e != d))
    base = sorted({label for _, label in places})
    score = max([0.0, *(CONFIDENCE[d[2]] for d in kept), *([CONFIDENCE[1]] if places else [])])
    spots = [i for i, _ in places]
    return (len(ws), len(places), min(spots, default=None), max(spots, default=None), ",".join(base), ",".join(sorted({*base, *(d[4] for d in kept)})), score), kept


def test_scan_equals_brute_force(spark):
    assert len(build_rules()) > 200
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 low", "2 k", "3 found", "4 labels")
    got = {r.doc_id: r for r in scan(docs).collect()}
    for i, text in enumerate(texts):
        wanted, kept = brute(text)
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == wanted, text
        assert sorted((d.start, d.stop, d.tier, d.rule, d.label) for d in r.detections) == kept, text
    assert any(r.labels for r in got.values())
    text = plan(scan(docs))
    assert "Exchange" not in text and "Python" not in text
    assert scan(docs.limit(0)).count() == 0


def test_keywords_do_not_hide_detections(spark):
    """One text per alternative that holds nothing else."""
    texts = [(f"It {verb} not be {act}.", "no-redistribution") for verb in ("may", "must", "shall") for act in ("copied", "reproduced", "redistributed")]
    texts += [("Redistribution is strictly prohibited", "no-redistribution"), ("Provided as\nis", "warranty"), ('provided "as  is"', "warranty"), ("provided as is", "warranty")]
    texts += [("Zero-clause BSD", "0bsd"), ("zero clause bsd", "0bsd"), ("Released under the Zero-Clause BSD", "0bsd"), ("SPDX-License-Identifier: 0BSD", "0bsd")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in scan(docs).collect()} == {i: label for i, (_, label) in enumerate(texts)}
