from importlib.resources import files

from ratewright.llm import licenses, queries


def test_variants(spark):
    texts = {
        1: "Released under the MIT License.",
        2: "  RELEASED under\tthe   mit licence ",
        3: "Copyright (c) 2020 Some One\nReleased under the MIT License!\n(c) 1999-2001 Other",
        4: "Released under the MIT License. And more.",
        5: None,
        6: "",
        7: "... !!",
        8: "Prose.\nLicensed under CC BY-NC 4.0.\nmore\nlicensed under CC BY NC 4.0",
        9: "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
        10: "The copyright of this text is not dropped",
    }
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(1, texts[1], "y")], "doc_id long, text string, digest string")
    known = licenses.known_table(spark)
    rows = licenses.scan(docs, known).collect()
    assert len(rows) == 11
    found = {r.doc_id: r.licence_id for r in rows}
    assert found == {1: "MIT", 2: "MIT", 3: "MIT", 4: None, 5: None, 6: None, 7: None, 8: None, 9: "MPL-2.0", 10: None}
    assert len({r.digest for r in rows if r.doc_id in (5, 6, 7)}) == 1
    lines = {(r.doc_id, r.licence_id): r.lines for r in licenses.scan_lines(docs, known).collect()}
    assert lines == {(1, "MIT"): 2, (2, "MIT"): 1, (3, "MIT"): 1, (8, "CC-BY-NC-4.0"): 2, (9, "MPL-2.0"): 1}
    assert licenses.scan(docs.limit(0), known).count() == 0
    assert licenses.scan(docs, known.limit(0)).where("licence_id is not null").count() == 0


def test_no_python_in_plan(spark, small):
    plan = queries.op7_scan_licences(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_texts(spark):
    held = {licence: (files("ratewright.llm") / "licence_texts" / f"{name}.txt").read_text("utf-8") for licence, name, _, _ in licenses.TEXTS}
    rows = [(licence, "  " + text.replace("http:", "https:").upper().replace("\n", " \n")) for licence, text in held.items()]
    rows += [("MIT", "The MIT License (MIT)\n\nCopyright (c) 2021 Some One\n\n" + held["MIT"]), ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n" + held["BSD-3-Clause"])]
    rows += [("Apache-2.0", held["Apache-2.0"].split("END OF TERMS")[0]), (None, held["MIT"] + "And more."), (None, held["GPL-3.0"][:9000])]
    docs = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.licence_id for r in licenses.scan(docs, licenses.known_table(spark)).collect()}
    assert found == {k: licence for k, (licence, _) in enumerate(rows)}
