"""Line templates: planted boilerplate goes, prose stays, odd rows are defined."""
import random
import re
from collections import Counter

import pytest

from rankwise.llm import line_templates as t
from rankwise.llm.line_templates import clean, deduplicate

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
                    for _ in range(n))


def plain(rows):
    """Texts of (doc_id, text, ...) rows with distinct ids after the dedup."""
    forms, seen = {}, Counter()
    for r in rows:
        for k, line in enumerate((r[1] or "").split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", w) else w
                           for w in re.findall(r"[^\x09-\x0D\x20]+", line))
            if tokens:
                forms[r[0], k] = tokens
                seen[tokens] += 1
    leaves, support = {}, Counter()
    for f in seen:
        leaves.setdefault((len(f), f[:t.DEPTH]), []).append(f)
    general, bound = {}, Counter()
    for k, fs in leaves.items():
        if k[0] < t.MIN_FIXED or len(fs) < 2 or sum(seen[f] for f in fs) < t.MIN_DOCS:
            continue
        for f in fs:
            for i, w in enumerate(f):
                support[k, i, w] += seen[f] if w != "<*>" else 0
        for f in fs:
            best = sorted((support[k, i, w] for i, w in enumerate(f) if w != "<*>"), reverse=True)
            half = (len(f) + 1) // 2
            if len(best) < half:
                continue
            stays = tuple((i, w) for i, w in enumerate(f) if w != "<*>"
                          and support[k, i, w] >= t.KEPT_SHARE * best[half - 1])
            if t.MIN_FIXED <= len(stays) < len(f):
                general[f] = k, stays
                bound[k, stays] += seen[f]
    template = {}
    for f in seen:
        if f in general:
            k, stays = general[f]
            rarest = min(support[k, i, w] for i, w in stays if i >= t.DEPTH)
            if t.MIN_DOCS <= bound[k, stays] >= t.BOUND_SHARE * rarest:
                template[f] = general[f]
        if f not in template and sum(w != "<*>" for w in f) >= t.FIXED_SHARE * len(f):
            template[f] = f
    docs = {}
    for (d, _), f in forms.items():
        docs.setdefault(template.get(f), set()).add(d)
    out = {}
    for r in rows:
        lines = (r[1] or "").split("\n")
        gone = {k for k in range(len(lines)) if (f := template.get(forms.get((r[0], k))))
                and len(docs[f]) >= (2 if len(forms[r[0], k]) == len(f) >= t.LONG else t.MIN_DOCS)
                and min(docs[f]) != r[0]}
        kept = [x for k, x in enumerate(lines) if k not in gone]
        left = any((r[0], k) in forms and k not in gone for k in range(len(lines)))
        out[r[0]] = None if r[1] is None else "\n".join(kept), bool(gone) and not left
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(40):
        body = [prose(rng, rng.randint(4, 30)) for _ in range(5)]
        body.insert(2, f"Page {i} of 40, printed on 2021-03-{i % 28 + 1:02d}")
        if i % 2:
            body.append(f"Posted by {prose(rng, 1)} in the section of open letters")
        if i % 10 == 0:
            body.append("Seen in two places only " + "x" * (i // 20))
        out.append((i, "\n".join(body), "en", "s", 0))
    return out


@pytest.mark.parametrize(("limit", "small"), [(1 << 25, t.SMALL), (-1, t.SMALL), (1 << 25, 60), (-1, 0)])
def test_templates_go_but_for_the_first_document(spark, rows, limit, small):
    out = deduplicate(spark.createDataFrame(rows, DDL), limit=limit, small=small)
    got = {r.doc_id: r for r in out.collect()}
    for i, text, *_ in rows:
        lines = text.split("\n")
        page, posted = i == 0, i == 1
        want = [x for x in lines if not (x.startswith("Page") and not page)
                and not (x.startswith("Posted") and not posted)]
        assert got[i].text == "\n".join(want)
        assert (got[i].n_lines, got[i].n_dropped) == (len(lines), len(lines) - len(want))


def test_equals_the_definition(spark):
    rng = random.Random(21)
    few = ["a", "b", "c", "of", "the", "x1"]
    rows = [(i, "\n".join(" ".join(rng.choice(few) for _ in range(rng.randint(1, 9)))
                          for _ in range(rng.randint(0, 6)))) for i in range(200)]
    got = deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    want = plain(rows)
    assert {r.doc_id: r.text for r in got.collect()} == {i: x for i, (x, _) in want.items()}
    kept = clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in kept} == {i for i, (_, gone) in want.items() if not gone}


def test_copies_leave_their_first_document_whole(spark):
    rng = random.Random(2)
    text = "\n".join(prose(rng, 12) for _ in range(4))
    copies = [(i, text + "\n", "en", "s", len(text) + 1) for i in (9, 4, 6)]
    pair = [(20, prose(rng, 8) + "\n" + (p := prose(rng, 9)), "en", "s", 1),
            (21, prose(rng, 8) + "\n" + p, "en", "s", 1)]
    out = clean(spark.createDataFrame(copies + pair, DDL), n_chars="n_chars")
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {4: text + "\n", 20: pair[0][1], 21: pair[1][1]}


@pytest.mark.parametrize("n", [50, 1000, 5000])
def test_a_footer_with_two_fields_goes_at_every_size(spark, n):
    """Values recur in more and more documents; prose around it stays."""
    rng = random.Random(n)
    names, cities = [prose(rng, 1) for _ in range(200)], [prose(rng, 1) for _ in range(200)]
    rows = []
    for i in range(n):
        footer = f"Posted by {rng.choice(names)} in the {rng.choice(cities)} office for readers"
        rows.append((i, f"Posted by {prose(rng, 7)}\n{prose(rng, 12)}\n{footer}"))
    out = deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.n_dropped for r in out) == n - 1
    assert all(r.text == "\n".join(rows[r.doc_id][1].split("\n")[:2 if r.doc_id else 3]) for r in out)


def test_words_that_prose_has_in_common_are_no_template(spark):
    """Lines that share a frame with many others but go on differently all stay."""
    rng = random.Random(8)
    few = [prose(rng, 1) for _ in range(12)]
    rows = [(i, "it is " + " ".join(rng.choice(few) for _ in range(6))) for i in range(1500)]
    out = deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    seen = Counter(x for _, x in rows)
    assert sum(r.n_dropped for r in out) <= sum(n - 1 for n in seen.values() if n >= t.MIN_DOCS) + 15


def test_long_lines_recur_from_two_documents(spark):
    rng = random.Random(4)
    long, short = prose(rng, t.LONG), prose(rng, t.LONG - 1)
    rows = [(i, f"{prose(rng, 9)}\n{long}\n{short}") for i in (3, 7)]
    got = {r.doc_id: r for r in deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[3].text == rows[0][1] and got[3].n_dropped == 0
    assert got[7].text.split("\n") == [rows[1][1].split("\n")[0], short] and got[7].n_dropped == 1
    once = [(1, f"{long}\n{long}")]
    assert deduplicate(spark.createDataFrame(once, "doc_id long, text string")).first().n_dropped == 0


def test_a_column_name_with_a_dot(spark):
    df = spark.createDataFrame([(1, "x", 7)], "doc_id long, text string, `a.b` int")
    assert clean(df).columns == df.columns and deduplicate(df).select("`a.b`").first()[0] == 7


def test_odd_rows(spark):
    line = "the same footer line stands here"
    rows = [(1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "\n \n\t\n", "en", "s", 4),
            (None, line, "en", "s", 9), (4, line + "\n\n", "en", "s", 9),
            (5, "own words here\n" + line, "en", "s", 9), (5, "own words here\n" + line, "en", "s", 9),
            (5, line + "\nother text of this id", "en", "s", 9),
            (6, "a\n" * 30_000 + line, "en", "s", 9), (7, "1 2 3\n4 5 6", "en", "s", 9),
            (8, "7 8 9", "en", "s", 9), (9, "1 1 1", "en", "s", 9)]
    got = deduplicate(spark.createDataFrame(rows, DDL)).collect()
    texts = sorted(((r.doc_id, r.text) for r in got), key=repr)
    want = [(1, None), (2, ""), (3, "\n \n\t\n"), (None, line), (4, "\n"), (5, "own words here"),
            (5, "own words here"), (5, "other text of this id"), (6, "a\n" * 29_999 + "a"),
            (7, "1 2 3\n4 5 6"), (8, "7 8 9"), (9, "1 1 1")]
    assert texts == sorted(want, key=repr)
    kept = clean(spark.createDataFrame(rows, DDL), n_chars="n_chars").collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 3, 5, 5, 5, 6, 7, 8, 9]
    assert {r.n_chars for r in kept if r.doc_id == 5} == {14, 21}


def test_clashing_names_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "x", 7, "l")], "doc_id long, text string, n_lines long, drop string")
    out = deduplicate(df)
    assert out.columns == [*df.columns, "_n_lines", "n_dropped"]
    assert tuple(out.first()) == (1, "x", 7, "l", 1, 0)
    assert clean(df).columns == df.columns
    assert deduplicate(spark.createDataFrame([], DDL)).count() == 0


def test_wildcards(spark):
    df = spark.createDataFrame([(" a1  b\tc-2-d 3e, x ",)], "s string")
    assert df.select(t._form(df.s)).first()[0] == "<*> b <*> <*> x"
