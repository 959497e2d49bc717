"""LM scores against a plain bigram model; folds, odd rows, block sizes."""
import math
import random
import re
import zlib
from collections import Counter

import pytest

from rankwise.llm import lm_automaton as lm

DDL = "doc_id long, text string"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def fold(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7


def plain(rows, prior=lm.PRIOR):
    one, two = Counter(), Counter()
    for i, t in rows:
        if fold(i) != 2:
            w = words(t)
            one.update(w)
            two.update(zip(["\t", *w], w))
    starts = sum(fold(i) != 2 for i, _ in rows)
    n, v = sum(one.values()), len(one)
    out = []
    for i, t in rows:
        w, base, score = words(t), 0.0, 0.0
        for h, x in zip(["\t", *w], w):
            p = (one[x] + 1) / (n + v + 1)
            c = starts if h == "\t" else one[h]
            base += math.log10(p)
            score += math.log10((two[h, x] + prior * p) / (c + prior))
        out.append((i, fold(i) == 2, len(w), sum(one[x] > 0 for x in w), n, base, score))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(50)] + ["É", "ünd", " x", "İ", "K"]
    out = [(i, rng.choice([" ", "\x0b", "\n"]).join(
        rng.choice(vocabulary[: 5 + i % 50]).upper() if rng.random() < .2
        else rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    out += [(200, None), (201, ""), (202, " \t"), (None, "w1 w2"), (3, out[3][1]), (3, "other"),
            (203, "a\x1cb c d"), (204, "w1 w2 w3 " * 20_000), (205, "never seen again")]
    return out


@pytest.mark.parametrize("options", [{}, {"block_tokens": 100, "shard_keys": 500}])
def test_equals_a_plain_model(spark, rows, options):
    got = sorted(map(tuple, lm.score(spark.createDataFrame(rows, DDL).repartition(5),
                                     **options).collect()), key=repr)
    want = plain(rows)
    assert [(r[0], *r[1:5]) for r in sorted(got, key=lambda r: repr(r[:5]))] == \
        [(r[0], *r[1:5]) for r in sorted(want, key=lambda r: repr(r[:5]))]
    def key(r):
        return repr(r[:5]), r[5]
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_weights_of_a_state_sum_to_one(spark):
    train = [i for i in range(99) if fold(i) != 2][:4]
    held = [i for i in range(999) if fold(i) == 2][:6]
    rows = list(zip(train, ["a b a c", "b a", "c c b", "a a b"], strict=True))
    vocabulary = ["a", "b", "c", "unseen"]
    # Texts "a x" differ from "a" by the weight of x and of the end after x.
    rows += [(i, f"a {x}") for i, x in zip(held, vocabulary, strict=False)]
    rows += list(zip(held[4:], ["a", "b"], strict=True))
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, DDL)).collect()}
    want = {r[0]: r[6] for r in plain(rows)}
    assert got == pytest.approx(want)
    one = Counter(w for i, t in rows[:4] for w in words(t))
    two = Counter(p for i, t in rows[:4] for p in zip(["\t", *words(t)], words(t)))
    n, v = sum(one.values()), len(one)
    for h in "abc":
        assert sum((two[h, x] + lm.PRIOR * (one[x] + 1) / (n + v + 1)) / (one[h] + lm.PRIOR)
                   for x in [*one, "unseen"]) == pytest.approx(1)


def test_held_out_texts_alone_and_an_empty_table(spark):
    held = [i for i in range(200) if fold(i) == 2][:3]
    got = lm.score(spark.createDataFrame([(i, "a b") for i in held], DDL)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
    assert lm.score(spark.createDataFrame([], DDL)).count() == 0


def test_bigrams_beat_the_base_on_held_out_prose(spark):
    rng = random.Random(6)
    follow = {w: rng.sample(range(300), 3) for w in range(300)}
    def walk():
        w, out = rng.randrange(300), []
        for _ in range(80):
            out.append(f"t{w}")
            w = rng.choice(follow[w])
        return " ".join(out)
    got = lm.score(spark.createDataFrame([(i, walk()) for i in range(400)], DDL))
    held = got.filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held.s > 0.7 * held.b
