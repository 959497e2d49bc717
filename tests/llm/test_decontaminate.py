"""Decontamination against a plain search, both join paths, odd rows."""
import hashlib
import random
import re

import pytest

from rankwise.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(low)


def plain(docs, items):
    found = []
    for i, text in items:
        w = words(text)
        if w:
            n = min(10, len(w))
            found += [("" if i is None else str(i), w[k:k + n]) for k in range(len(w) - n + 1)]
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for i, win in found:
            for k in range(len(w) - len(win) + 1):
                if w[k:k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    ids.add(i)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    def prose(n):
        return " ".join(rng.choice(["the", "of", "É", "zü", "ab", "x1", "qq", "la"])
                        + ("" if rng.random() < .7 else str(rng.randint(0, 30)))
                        for _ in range(n))
    items = [(i, prose(rng.choice([3, 9, 10, 11, 25]))) for i in range(30)]
    items += [(30, None), (31, " .. "), (None, prose(14)), (5, items[5][1]), (32, items[6][1]),
              (33, "Ü")]
    docs = []
    for i in range(120):
        parts = [prose(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(items)[1] or ""
            parts += [text.upper() if rng.random() < .3 and text.isascii() else text,
                      prose(rng.randint(0, 9))]
        docs.append((i, ", ".join(parts)))
    docs += [(200, None), (201, ""), (202, "..."), (203, items[0][1]),
             (7, docs[7][1]), (7, docs[8][1]), (None, docs[9][1]),
             (204, (items[1][1] + " " + prose(5) + " ") * 900)]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 25, -1])
def test_equals_a_plain_search(spark, tables, limit):
    docs, items = tables
    got = d.report(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"), limit=limit)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, items)


@pytest.mark.parametrize("limit", [1 << 25, -1])
def test_clean_keeps_whole_rows(spark, tables, limit):
    docs, items = tables
    df = spark.createDataFrame([(i, t, "a", 1.5) for i, t in docs],
                               "doc_id long, text string, phrase string, n_hit double")
    got = d.clean(df, spark.createDataFrame(items, "item_id long, text string"), limit=limit)
    assert got.columns == df.columns
    bad = {(r[0], t) for r, (_, t) in zip(
        [plain([x], items)[0] for x in docs], docs, strict=True) if r[5]}
    assert sorted(((r[0], r[1]) for r in got.collect()), key=repr) == \
        sorted((x for x in docs if x not in bad), key=repr)


def test_empty_tables(spark, tables):
    docs, items = tables
    no_docs = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame(docs, "doc_id long, text string")
    assert d.report(no_docs, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert d.report(full, no_items).filter("contaminated or n_items > 0").count() == 0
    assert d.clean(full, no_items).count() == len(docs)
