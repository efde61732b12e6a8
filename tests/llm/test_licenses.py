import re

import pytest
from pyspark.sql import functions as F

from stackweave.llm import common, licenses, queries
from tests.llm import helpers


@pytest.fixture(scope="module")
def scanner(spark):
    return licenses.train(common.documents(spark, "/root/testdata/sf0.01"))


def plain_similarity(body, texts):
    words = lambda t: [w for w in re.split(r"[^a-zé]+", t.lower()) if w]
    cut = lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    own = cut(words(body))
    return max(len(own & cut(words(t))) / min(len(own), len(cut(words(t)))) for t in texts)


def test_query_finds_all_licence_lines_and_little_else(spark):
    folder = "/root/testdata/sf0.01"
    want = set()
    marks = {"Apache License": "Apache-2.0", "MIT License": "MIT", "GNU General": "GPL", "CC BY-NC": "CC-BY-NC", "All rights": "Proprietary"}
    for r in common.documents(spark, folder).collect():
        for k, line in enumerate((r.text or "").split("\n")):
            want |= {(r.doc_id, k, family) for mark, family in marks.items() if mark in line}
    found = queries.op9_licenses(spark, folder).collect()
    sure = {(r.doc_id, r.paragraph, r.family) for r in found if r.family != licenses.UNKNOWN}
    assert want and sure == want
    assert len(found) - len(sure) < 0.2 * len(want)


def test_known_changed_and_unknown_licences(spark, scanner):
    texts = {
        1: "Released under the MIT License.",
        2: "Copyright (c) 2019 Some Body. Licensed under the Apache License, Version 2.0",
        3: "Licensed under the Wonderful Unheard Public License, version 9, permission is hereby granted to any person.",
        4: "A plain line about rivers and stones that nobody would take for a licence.",
        5: None,
        6: "",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs, scanner).collect()}
    assert found[1].family == "MIT" and found[2].family == "Apache-2.0"
    assert 3 not in found or found[3].family == licenses.UNKNOWN
    assert not {4, 5, 6} & set(found)
    assert found[2].similarity == pytest.approx(plain_similarity(texts[2], licenses.TEMPLATES["Apache-2.0"]))


def test_awkward_rows(spark, scanner):
    docs = helpers.awkward(spark).unionByName(spark.createDataFrame([(50, "x\nAll rights reserved.\n\n", "en", "a")] * 2, helpers.SCHEMA)).withColumn("family", F.lit("mine"))
    assert helpers.rows(licenses.scan(docs, scanner).where("doc_id = 50"), "doc_id", "paragraph", "family") == [(50, 1, "Proprietary")] * 2
    assert licenses.scan(helpers.empty(spark), scanner).count() == 0
    # Without a corpus there is nothing ordinary to learn; licence lines are found all the same.
    alone = licenses.scan(docs, licenses.train(helpers.empty(spark)))
    assert helpers.rows(alone.where("doc_id = 50 and paragraph = 1"), "family") == [("Proprietary",)] * 2


def test_short_notices_are_found_inside_longer_ones(spark, scanner):
    texts = {
        1: "Copyright 2023 Acme Inc. All rights reserved.", 2: "Text: Licensed under CC BY 4.0", 3: "Licensed under CC BY-SA 4.0.",
        4: "Licensed under CC BY-NC 4.0.", 5: "File header. SPDX-License-Identifier: MIT",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.family for r in licenses.scan(docs, scanner).collect()}
    assert found == {1: "Proprietary", 2: "CC-BY", 3: "CC-BY-SA", 4: "CC-BY-NC", 5: "MIT"}
