"""Licence scans: equal forms match, other texts do not, odd rows."""
import re
import textwrap

import pytest

from rankwise.llm import licenses as li

DDL = "doc_id long, text string"
MIT = next(t for n, t in li.KNOWN if n == "MIT" and len(t) > 500)


@pytest.fixture(scope="module")
def rows():
    shouted = "Copyright (c) 2020, Some One. All rights reserved.\n\n" \
        + MIT.upper().replace("SUBLICENSE", "sub-licence").replace("\n", " \t\n")
    return [(1, shouted), (2, "(C) 1999 A\n© 2001 B\n" + MIT.replace('"', "“").replace("Software", "software")),
            (3, MIT + " And one more word."), (4, "words\nLicenced under the apache licence,  version 2.0\nmore"),
            (5, "Released under the MIT License.\n\nAll rights reserved.\nreleased under the mit licence"),
            (6, None), (7, ""), (8, "Copyright 2020 X"), (9, " !! \n ... "), (None, MIT),
            (5, MIT), (1, shouted), (10, MIT + "x " * 100_000)]


@pytest.mark.parametrize("limit", [1 << 25, -1])
def test_scan(spark, rows, limit):
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], DDL + ", digest string, n string")
    got = sorted(map(tuple, li.scan(df, limit=limit).drop("digest").collect()), key=repr)
    want = [(1, "MIT", 0, ""), (1, "MIT", 0, ""), (2, "MIT", 0, ""), (3, None, 0, ""),
            (4, None, 1, "Apache-2.0"), (5, None, 3, "MIT,all-rights-reserved"), (5, "MIT", 0, ""),
            (6, None, 0, ""), (7, None, 0, ""), (8, None, 0, ""), (9, None, 0, ""),
            (None, "MIT", 0, ""), (10, None, 0, "")]
    assert got == sorted(want, key=repr)


def test_digests(spark, rows):
    got = {r.doc_id: r.digest for r in li.scan(spark.createDataFrame(rows, DDL)).collect()
           if r.doc_id not in (None, 5)}
    assert got[1] == got[2] != got[3]
    assert [got[i] for i in (6, 7, 8, 9)] == [None] * 4


def test_every_equivalent_word_is_spelled_one_way(spark):
    left = [(i, f"a {w.replace('  ', '-')}, {w.replace('  ', ' ')} b") for i, w in enumerate(li.EQUIVALENT)]
    right = [(i, f"A {o} {o} b.") for i, o in enumerate(li.EQUIVALENT.values())]
    forms = [[r.form for r in li.with_canonical(spark.createDataFrame(x, DDL), "text", "form")
              .orderBy("doc_id").collect()] for x in (left, right)]
    assert forms[0] == forms[1]


def test_every_known_text_has_a_needle():
    pattern = li.needles(li.KNOWN)
    assert all(re.search(pattern, text.lower()) for _, text in li.KNOWN)
    assert "" not in pattern.split("|") and not re.search(pattern, "the of and to license")
    assert li.needles([("x", "licence owner")]) == ""


def test_known_digests_are_unique_and_an_empty_table(spark):
    known = li.known_digests(spark)
    assert known.count() == known.select("digest").distinct().count() == len(li.KNOWN)
    assert li.scan(spark.createDataFrame([], DDL)).count() == 0
    none = spark.createDataFrame([], "digest string, license string")
    assert li.scan(spark.createDataFrame([(1, MIT)], DDL), none).first().license is None


def test_whole_files_with_title_and_notice_at_any_width(spark):
    titles = {"MIT": "MIT License", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License",
              "BSD-3-Clause": "BSD 3-Clause License", "0BSD": "Zero-Clause BSD", "MIT-0": "MIT No Attribution"}
    short = {n: next(t for k, t in li.KNOWN if k == n and len(t) > 500) for n in titles}
    notices = ["Copyright (c) 2020, Some One", "Copyright 1999-2004 by A. Person <a@b.example>",
               "Copyright Some Company and others", "(c) Jane Doe", "© 2001 X\n(C) 2002 Y"]
    rows, want = [], {}
    for width in (30, 41, 72, 79, 100, 10_000):
        for i, (name, text) in enumerate(short.items()):
            body = "\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in text.split("\n\n"))
            rows.append((len(rows), f"{titles[name]}\n\n{notices[(i + width) % 5]}\n\n{body}\n"))
            want[len(rows) - 1] = name
        for name, (_, start, ends) in li._LONG.items():
            text = next(t for k, t in li.KNOWN if k == name and t.count(start) and len(t) > 5000)
            a = text.index(start)
            b = text.index(ends[-1]) if ends else len(text)
            body = "\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in text[a:b].split("\n\n"))
            rows.append((len(rows), text[:a] + body))
            want[len(rows) - 1] = name
    assert {"GPL-3.0", "LGPL-3.0", "MPL-2.0", "Apache-2.0", "CC0-1.0"} <= set(want.values())
    got = {r.doc_id: r.license for r in li.scan(spark.createDataFrame(rows, DDL)).collect()}
    assert got == want


def test_only_notices_go(spark):
    rows = [(0, "copyright notice and this permission notice appear in all copies."),
            (1, "(c) You must retain all"), (2, "copyright holders and contributors"),
            (3, "Copyright"), (4, "Copyright Notary Public"), (5, "  * Copyright [yyyy] [name]"),
            (6, "copyright hol"), (7, "© X"), (8, "(c) 2020"), (9, "it is wilful"), (10, "it is willful")]
    out = {r.doc_id: r.digest for r in li.scan(spark.createDataFrame(rows, DDL)).collect()}
    assert [i for i in range(9) if out[i] is None] == [4, 5, 6, 7, 8]
    assert out[9] == out[10]
