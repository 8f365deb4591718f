from tunelake.llm import licences

MIT = licences.KNOWN["MIT"][2]


def test_equal_forms(make, rows):
    other = MIT.replace("MIT License", "THE MIT LICENCE").replace("THE MIT", "mit").replace(
        "Copyright (c) the holders", "  Copyright (c) 1999, 2004 Somebody Else & Sons\n(c) 2020 others")
    given = [
        (1, "Some prose.\nLicensed under the Apache Licence, Version 2.0.\nMore."),
        (2, "licensed under the apache license - v2"),
        (3, "Licensed under the Apache License, Version 2.0 or so."),
        (4, other.replace(",", "").replace("\n", "\r\n")),
        (5, MIT + "\nand more"),
        (6, None), (7, ""), (8, "\n\n"), (9, "...\n!"),
        (10, "Released under the MIT license\n\nreleased under the MIT License!"),
        (10, "RELEASED UNDER THE MIT LICENSE"),
        (None, "Licensed under CC BY-NC 4.0."),
        (11, "x" * 300_000), (12, "Copyright (c) 2020 me\nReleased under the MIT License."),
    ]
    got = rows(licences.scan(make([(*g, "y") for g in given], "doc_id long, text string, licence string")))
    assert got == sorted([
        (1, 1, "Apache-2.0"), (2, 0, "Apache-2.0"), (4, None, "MIT"), (10, 0, "MIT"), (10, 0, "MIT"),
        (10, 2, "MIT"), (None, 0, "CC-BY-NC-4.0"), (12, 1, "MIT"), (12, None, "MIT"),
    ], key=repr)


def test_own_texts(make, rows):
    df = make([(1, "Do as you like"), (2, "do as you LIKE.\nplease")], "doc_id long, text string")
    known = {"own": ["do as you like!"], "twin": ["Do as you like"]}
    assert rows(licences.scan(df, known=known)) == [(1, 0, "own"), (2, 0, "own")]


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_workers(make):
    plan = licences.scan(make([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_full_texts_and_titles(make, rows):
    given = [(1, MIT.split("\n", 1)[1]), (2, "ISC License\n" + licences.KNOWN["ISC"][0])]
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]
    given += [(10 + i, licences.KNOWN[name][-1].upper()) for i, name in enumerate(names)]
    given += [(30, "Prose.\nLicensed under CC BY-SA 4.0.")]
    got = rows(licences.scan(make(given, "doc_id long, text string")))
    whole = [(1, None, "MIT"), (2, None, "ISC"), *((10 + i, None, name) for i, name in enumerate(names))]
    assert sorted((r for r in got if r[1] is None), key=repr) == sorted(whole, key=repr)
    assert (30, 1, "CC-BY-SA-4.0") in got
