"""Whole licences as they are met: full texts, with and without title, appendix and line breaks."""

from pathlib import Path

from capturebase.llm import licenses

FOLDER = Path(licenses.__file__).parent / "license_texts"
ISC = """ISC License

Copyright (c) 2020, Me

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

"""


def test_full_texts_and_forms(spark):
    short = dict(licenses.LICENSES)
    whole = {p.stem: p.read_text(encoding="utf-8") for p in FOLDER.glob("*.txt")}
    apache, gpl = whole["Apache-2.0"], whole["GPL-3.0"]
    want = [(x, name) for name, x in whole.items()]
    want += [(" ".join(x.split()), None) for x in ("a text about the Apache License", gpl[:5000])]
    want += [(apache[: apache.index("APPENDIX")], "Apache-2.0"), (apache[: apache.index("END OF TERMS")], "Apache-2.0"), (apache[apache.index("TERMS AND CONDITIONS FOR") :], "Apache-2.0")]
    want += [("Copyright (c) 2020 Me\n\n" + short["MIT"].removeprefix("MIT License\n"), "MIT"), ("The MIT License (MIT)\n\n" + short["MIT"].removeprefix("MIT License\n"), "MIT")]
    want += [("BSD 3-Clause License\n\n" + short["BSD-3-Clause"], "BSD-3-Clause"), ("BSD 2-Clause License\n\n" + short["BSD-2-Clause"], "BSD-2-Clause"), (ISC + short["ISC"].split("\n")[1], "ISC")]
    want += [("\n\n".join(" ".join(x.split()) for x in gpl.split("\n\n")), "GPL-3.0"), (apache + " and more", None)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    assert [r.license_id for r in licenses.scan_licenses(docs).orderBy("doc_id").collect()] == [name for _, name in want]


def test_wrapping_spelling_and_copyright_lines(spark):
    """Any width gives one form; lines that state a copyright go, those that only begin with the word stay. Spark, Python and DuckDB agree."""
    import textwrap

    import duckdb
    from pyspark.sql import functions as F

    short = dict(licenses.LICENSES)
    want = []
    for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD"):
        body = short[name].removeprefix("MIT License\n")
        for width in (17, 31, 40, 59, 72, 200):
            want.append(("\n".join(textwrap.wrap(" ".join(body.split()), width)), name))
        for line in ("Copyright (c) 2020 Jane Doe", "copyright 2019-2024 the authors", "(C) me", "\xa9 2020 X", "Copyright Jane Q. Doe", "# Copyright [yyyy] [name of owner]", "Copyright by Free Software Foundation, Inc.\nAll rights reserved."):
            want.append((f"{line}\r\n{body}", name))
    want.append((short["BSD-2-Clause"].replace("COPYRIGHT HOLDER", "COPYRIGHT\nOWNER").replace("COPYRIGHT HOLDERS", "copyright owners"), "BSD-2-Clause"))
    want += [("The above\ncopyright notice and", None), ("Copyright Holder\n" + short["MIT"], None), (short["MIT"].replace("sublicense", "sub-\nlicense"), "MIT"), ("", None), ("\u2028x\x85y", None), ("Licence Recognised\nper\ncent", None)]
    want += [(t + " tail", None) for t, _ in want[:5]]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    got = licenses.scan_licenses(docs).orderBy("doc_id").collect()
    assert [r.license_id for r in got] == [n for _, n in want]
    spark_form = [r.c for r in docs.select("doc_id", licenses.canonical(F.col("text")).alias("c")).orderBy("doc_id").collect()]
    assert spark_form == [licenses.canonical_text(t) for t, _ in want]
    c = duckdb.connect()
    c.execute("create table documents(doc_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", [(i, t) for i, (t, _) in enumerate(want)])
    assert [r[0] for r in c.execute(f"select {licenses.canonical_sql('text')} from documents order by doc_id").fetchall()] == spark_form
    assert licenses.canonical_text("Licence\nRecognised per\ncent") == "license recognized percent"


def test_sql_finds_the_same_licences(spark):
    import duckdb

    from capturebase.llm import queries

    texts = [p.read_text(encoding="utf-8") for p in sorted(FOLDER.glob("*.txt"))] + [t for _, t in licenses.LICENSES] + ["no licence", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    c = duckdb.connect()
    c.execute("create table documents(doc_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    got = sorted(tuple(r) for r in licenses.scan_licenses(docs).select("doc_id", "canonical_sha256", "license_id").collect())
    assert got == sorted(c.execute(queries.ORACLE_SQL["op9_licenses"]).fetchall())
    assert sum(x[2] is not None for x in got) == len(texts) - 2
