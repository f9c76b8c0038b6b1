"""Licence families on planted declarations, unknown licences and plain text."""

import pytest
from llm_tables import SMALL, awkward, documents  # noqa: F401

from tidemark.llm import licences as li

PLANTED = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "All rights reserved.": "proprietary",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
}


@pytest.fixture(scope="module")
def model(spark):
    return li.fit(li.sample_paragraphs(spark.read.parquet(f"{SMALL}/documents.parquet")))


def test_families_in_the_corpus(spark, model):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in li.scanned(docs, model).collect():
        assert r.families == sorted({f for line, f in PLANTED.items() if line in texts[r.doc_id]})


def test_variants_unknown_and_plain(model):
    kind = lambda text: model.paragraph(li.words_of(text))[0]
    assert kind("released under the  MIT license, see below") == "mit"
    assert kind("Copies are licensed under the GNU Lesser General Public License version 3") == "lgpl"
    assert kind("licensed under the Frobnicate License, version 7") == li.UNKNOWN
    assert kind("reserved seats are all on the left") == li.NONE
    assert kind("") == li.NONE


def test_probabilities_are_a_distribution(model):
    for text in (*PLANTED, "plain words", ""):
        p = model.probabilities(li.words_of(text))
        assert abs(p.sum() - 1) < 1e-9 and len(p) == len(li.TEMPLATES) + 2


def test_every_template_has_a_cue_and_confirms_only_its_family():
    for family, sentences in li.TEMPLATES.items():
        for sentence in sentences:
            plain = sentence.replace("{", "").replace("}", "")
            assert li.has_cue(plain.encode())
            assert li.confirmation(plain.split(), family) == 1.0
            assert all(li.confirmation(plain.split(), f) < 1.0 for f in li.TEMPLATES if f != family)


GPL = (
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
    "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
)
MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\n'
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice,\n   this list of conditions and the following disclaimer."
)
NOTICES = [
    (GPL, "gpl"),
    (GPL.replace("\n", " "), "gpl"),
    (GPL.replace("software:", "software;").replace("version 3", "version 2"), "gpl"),
    (GPL.replace("General", "Lesser General").replace("program", "library"), "lgpl"),
    (GPL.replace("General", "Affero General"), "agpl"),
    (MIT, "mit"),
    (MIT.replace("\n", " "), "mit"),
    ("// SPDX-License-Identifier: MIT", "mit"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later", "gpl"),
    (BSD, "bsd"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "gpl"),
    ('Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.', "apache-2.0"),
]


@pytest.mark.parametrize(("notice", "family"), NOTICES)
def test_notices_with_and_without_wrapped_lines(model, notice, family):
    for text in (notice, f"Some words stand before.\n\n{notice}\n\nAnd some stand after."):
        assert model.text(text.encode())[0] == [family]


def test_no_licence_from_a_date_and_unknown_ones_beside_known(model):
    assert model.text(b"Version 3, 29 June 2007")[:2] == ([], 0)
    assert model.text(b"Released under the MIT License.\nReleased under the Zorble Grant License\nAll rights reserved.")[0] == ["mit", "proprietary", "unknown"]


def test_a_corpus_about_licenses_changes_no_result(spark, model):
    plain = li.sample_paragraphs(spark.read.parquet(f"{SMALL}/documents.parquet"))
    other = li.fit(plain + [f"Drivers show a license at gate {i} before they drive" for i in range(40)])
    for text, kinds in [*((t, [f]) for t, f in NOTICES), ("Zorble Grant License", ["unknown"]), ("A driver license is needed.", [])]:
        assert model.text(text.encode())[0] == kinds and other.text(text.encode())[0] == kinds


def test_paragraphs_without_a_cue_share_one_result(model):
    for words in ([], ["plain"], "version 3 of the mit bsd software".split()):
        assert model.paragraph(words) == model.plain == model.paragraph(["other"])
    assert model.plain[0] == li.NONE and model.text(b"a\nb") == ([], 0, model.plain[1]) and model.text(b" \n ") == ([], 0, 0.0)


def test_awkward_rows(awkward, documents, model):  # noqa: F811
    rows = li.scanned(awkward, model).collect()
    assert len(rows) == awkward.count() and all(r.families == [] for r in rows)
    assert li.scanned(documents([]), model).count() == 0
    (row,) = li.scanned(documents(["All rights reserved.\nx\nReleased under the MIT License.\nAll rights reserved."]), model).collect()
    assert row.families == ["mit", "proprietary"] and row.n_paragraphs == 3
    assert li.fit([]).paragraph(["mit", "license"])[0] in (*li.TEMPLATES, li.UNKNOWN, li.NONE)
