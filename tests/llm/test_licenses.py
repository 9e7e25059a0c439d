from leadloom.llm.licenses import TEMPLATES, alignment, scan_licenses, wording

from .data import no_docs, odd_docs, prose


def test_every_template_is_found_in_prose(spark):
    rows = [(k, f"{prose(k, 50)}\n{text}\n{prose(k + 99, 40)}") for k, (_, text, _) in enumerate(TEMPLATES)]
    found = {}
    for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r["doc_id"], set()).add((r["license"], r["line"], r["exact"]))
    for k, (license, _, _) in enumerate(TEMPLATES):
        assert (license, 1, True) in found[k], TEMPLATES[k]


def test_wordings_differ(spark):
    mit = TEMPLATES[3][1].split()
    wrapped = "\n".join(" ".join(mit[i : i + 9]) for i in range(0, len(mit), 9))
    texts = [
        "released under the mit license", "Released under the MIT licence.", "This work is licensed under the GNU General Public License, version 2.",
        "He has a driving licence.", "Licensed under CC BY-SA 4.0.", "The copyright of this poem is disputed.", "a\n\n" + wrapped, "\n".join([prose(1, 9000), "All rights reserved."]),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["license"], r["exact"]) for r in scan_licenses(docs).collect()}
    assert got == {(0, "MIT", True), (1, "MIT", False), (2, "GPL-2.0", True), (4, "CC-BY-SA-4.0", True), (6, "MIT", True), (7, "proprietary", True)}


def test_odd_rows_and_empty_tables(spark):
    assert scan_licenses(odd_docs(spark)).count() == 0 and scan_licenses(no_docs(spark)).count() == 0
    twice = spark.createDataFrame([(None, "All rights reserved.", 1)] * 2, "doc_id long, text string, license int")
    assert [r["license"] for r in scan_licenses(twice).collect()] == ["proprietary"] * 2


def test_alignment_counts_what_is_missing_and_between():
    assert alignment(wording("a b c d"), wording("x a q c d y")) == (["b"], ["q"])
    assert alignment(["a"], ["b"]) == (["a"], [])


def test_wordings_run_over_lines_before_and_after_the_mention(spark):
    isc = next(t for n, t, _ in TEMPLATES if n == "ISC").split()
    mpl = next(t for n, t, _ in TEMPLATES if n == "MPL-2.0").split()
    mit = TEMPLATES[3][1].split()
    wrap = lambda words, n: "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))
    texts = [wrap(isc, 12), wrap([*mpl, "If", "a", "copy"], 11), wrap(mit, 3), f"{prose(3, 30)}\n{wrap(isc, 5)}\n{prose(4, 30)}", prose(5, 200) + " " + " ".join(mit)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["license"], r["line"], r["exact"]) for r in scan_licenses(docs).collect()}
    assert got == {(0, "ISC", 0, True), (1, "MPL-2.0", 0, True), (2, "MIT", 0, True), (3, "ISC", 1, True), (4, "MIT", 0, True)}


def test_licenses_of_one_family_keep_their_names(spark):
    gnu = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    bsd = {n: t for n, t, _ in TEMPLATES if n.startswith("BSD-")}
    texts = {
        gnu.format("program", "General", "3"): "GPL-3.0", gnu.format("program", "Lesser General", "3"): "LGPL-3.0", gnu.format("program", "Affero General", "3"): "AGPL-3.0",
        gnu.format("library", "Lesser General", "2.1"): "LGPL-2.1", gnu.format("library", "Library General", "2"): "LGPL-2.0", gnu.format("program", "General", "2"): "GPL-2.0",
        **{t.replace(" 2. ", "\n2. ").replace(" 3. ", "\n3. "): n for n, t in bsd.items()},
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
    }
    assert len(texts) == 13
    rows = [(k, f"{prose(k, 20)}\n\n{t}\n\n{prose(k + 50, 20)}") for k, t in enumerate(texts)]
    got = {(r["doc_id"], r["license"]) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(enumerate(texts.values()))
