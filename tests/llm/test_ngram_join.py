"""The n-gram join against all pairs, blocks, odd rows, components."""
import random

import pytest

from rankwise.llm import ngram_join as j
from rankwise.llm.components import connected

DDL = "doc_id long, text string"


def sets(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def plain(rows):
    """(doc_id, class_id, n_links, n_copies) by comparing every pair."""
    found = [sets(t) for _, t in rows]
    texts = sorted({frozenset(s) for s in found if s}, key=repr)
    near = {t: [o for o in texts if o != t and 5 * len(t & o) >= 4 * len(t | o)] for t in texts}
    root = {t: t for t in texts}
    def top(t):
        while root[t] != t:
            t = root[t]
        return t
    for t, others in near.items():
        for o in others:
            root[top(o)] = top(t)
    low = lambda i: (i is not None, i or 0)
    first = {}
    for (i, _), s in zip(rows, found, strict=True):
        if s:
            r = top(frozenset(s))
            first[r] = min(first.get(r, i), i, key=low)
    copies = {t: sum(frozenset(s) == t for s in found) - 1 for t in texts}
    out = []
    for (i, _), s in zip(rows, found, strict=True):
        t = frozenset(s)
        out.append((i, first[top(t)], len(near[t]), copies[t]) if s else (i, i, 0, 0))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    def prose(n):
        return [f"w{rng.randint(0, 400)}" for _ in range(n)]
    out, k = [], 0
    def add(words):
        nonlocal k
        out.append((k, " ".join(words)))
        k += 1
    for _ in range(80):
        base = prose(rng.choice([3, 7, 30, 60, 200]))
        add(base)
        for _ in range(rng.choice([0, 0, 1, 2])):
            words = list(base)
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = "new"
            add([w.upper() for w in words] if rng.random() < .2 else words)
    crowd = prose(120)
    for i in range(60):
        words = list(crowd)
        words[i] = f"own{i}"
        add(words)
    chain = prose(100)
    for i in range(8):
        add(chain[5 * i:5 * i + 60])
    out += [(900, None), (901, " \n\t"), (902, ""), (3, out[3][1]), (3, out[9][1]),
            (None, out[12][1]), (903, " ".join(prose(30_000)))]
    return out


@pytest.mark.parametrize("options", [{}, {"block_texts": 7}, {"block_shingles": 900, "limit": -1}])
def test_equals_all_pairs(spark, rows, options):
    got = j.classes(spark.createDataFrame(rows, DDL), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_keep_first_keeps_one_row_of_each_class(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows + rows[:1]],
                               "doc_id long, text string, node string, key int")
    got = j.keep_first(df)
    assert got.columns == df.columns
    want = plain(rows)
    out = got.collect()
    assert {r.doc_id for r in out} == {r[1] for r in want}
    wordless = 3
    linked_ids = [r.doc_id for r in out if (r.text or "").strip()]
    assert len(out) == len(linked_ids) + wordless
    assert len(linked_ids) == len(set(linked_ids)) + sum(
        1 for x in {r[1] for r in want} if sum(y[0] == y[1] == x for y in want) > 1
        and len({frozenset(sets(t)) for i, t in rows if i == x}) > 1
        and all(y[0] == y[1] for y in want if y[0] == x))


def test_empty_table(spark):
    empty = spark.createDataFrame([], DDL)
    assert j.classes(empty).count() == 0 and j.keep_first(empty).count() == 0


def test_prefixes_shorten_until_the_recall_is_met():
    length = j.prefix_length(0.8, 20, 0.999)
    assert 1 - (1 - .8 ** length) ** 20 >= 0.999 > 1 - (1 - .8 ** (length + 1)) ** 20
    assert j.prefix_length(0.1, 2, 0.99) == 1


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(40)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(70)]
    root = {}
    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        a, b = top(u), top(v)
        if u != v:
            root[max(a, b)] = min(a, b)
    want = sorted((x, top(x)) for x in {y for u, v in edges if u != v for y in (u, v)})
    got = connected(spark.createDataFrame(edges, "u long, v long"), "test")
    assert sorted(map(tuple, got.collect())) == want


def test_few_long_near_copies_leave_blocks_empty(spark):
    rng, rows = random.Random(12), []
    for i in range(24):
        words = [f"w{rng.randint(0, 10_000)}" for _ in range(400)]
        for k in range(2 + i % 2):
            rows.append((len(rows), " ".join([*words[:20 * k], f"own{k}", *words[20 * k:]])))
    got = j.classes(spark.createDataFrame(rows, DDL), block_shingles=150)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
