import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import license_scan as L
from tidemark.llm.queries import QUERIES
from tidemark.llm.text import text_bytes

import pyarrow as pa

ORDINARY = ["the quick brown fox jumps over the lazy dog", "we released the record under a new name last year", "a license to drive is needed here", "rivers run down to the sea", "x = y + 1"]


@pytest.fixture(scope="module")
def models():
    return L.train(ORDINARY * 20)


def scan(models, *texts):
    return L.scan_texts(models, *text_bytes(pa.array(texts)))


def test_unseen_variations_are_named(models):
    rng, right, n = np.random.default_rng(99), 0, 0
    for family, templates in L.TEMPLATES.items():
        for template in templates:
            for text in L.variations(rng, template, 6)[1:]:
                found = scan(models, text)[0][1]
                n += 1
                right += bool(found) and found[0]["family"] == family
    assert right / n > 0.9


def test_ordinary_text_is_left_alone(models):
    assert not any(found for _, found in scan(models, *ORDINARY, "Permission was asked and given.", "version 2.0 of the plan"))


def test_unknown_licence(models):
    assert [x["family"] for x in scan(models, "Licensed under the Zebra Public License, version 7.")[0][1]] in (["unknown"], [])
    assert [x["family"] for x in scan(models, "All rights reserved.")[0][1]] == ["unknown"]


def test_places_long_paragraphs_and_whole_texts(models):
    notice = "Licensed under the Apache License, Version 2.0."
    text = "é " * 5 + "\n" + notice + "\nmore"
    (n, found), = scan(models, text)
    assert n == 3 and len(found) == 1
    assert text.encode()[found[0]["first"]:found[0]["end"]] == notice[:-1].encode()
    long = "word other thing " * 20_000 + "\n" + notice
    assert [x["family"] for x in scan(models, long)[0][1]] == ["Apache"]


def test_given_documents(spark, given):
    got = {r.doc_id: set(r.families) for r in QUERIES["op10_license_scan"](spark, "/root/testdata/sf0.001").collect()}
    docs = given("documents", "doc_id", "text")
    assert len(got) == len(docs)
    for doc_id, text in docs:
        want = {f for f, sign in (("MIT", "MIT License"), ("Apache", "Apache License"), ("GPL", "GNU General Public"), ("CC-BY-NC", "CC BY-NC")) if sign in text}
        assert got[doc_id] - {"unknown"} == want


def test_odd_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "\n\n"), (4, "Released under the MIT License."), (4, "Released under the MIT License."), (None, "a")]).withColumn("found", F.lit(1))
    rows = L.scan_licenses(docs, "found_").select("doc_id", "found_.*", "found").collect()
    assert sorted((r.doc_id or 0, r.n_paragraphs, tuple(r.families)) for r in rows) == [(0, 1, ()), (1, 0, ()), (2, 0, ()), (3, 0, ()), (4, 1, ("MIT",)), (4, 1, ("MIT",))]
    assert L.scan_licenses(docs.limit(0), "x").count() == 0


#: Notices of licences that no template and no training text is of.
HELD_OUT = [
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "Distributed under the Boost Software License.", "Licensed CC BY-ND 4.0", "Available under EUPL v1.2", "Licensed under the Zebra Public License, version 7.",
    "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document",
]


def test_licences_without_a_template_are_unknown(models):
    found = [[x["family"] for x in scan(models, text)[0][1]] for text in HELD_OUT]
    assert all(f in ([], ["unknown"]) for f in found)
    assert sum(map(bool, found)) / len(found) >= 0.7


def test_words_that_only_share_buckets_are_no_notice(models):
    rng = np.random.default_rng(3)
    texts = [" ".join(["".join(rng.choice(list("abcdefgh"), 7))] * int(rng.integers(1, 70))) for _ in range(400)]
    assert not any(found for _, found in scan(models, *texts))


def test_notice_wrapped_over_lines(models):
    notice = "Licensed under\nthe Apache\nLicense,\nVersion 2.0."
    text = "ordinary words here and there\n\n" + notice + "\n\nmore ordinary words"
    (n, found), = scan(models, text)
    assert n == 6 and [x["family"] for x in found] == ["Apache"]
    assert text[found[0]["first"]:found[0]["end"]] == notice[:-1]
