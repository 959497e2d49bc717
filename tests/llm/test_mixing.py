"""Pfair mixing: windows met, lag under one block, every row placed once."""
import math

import pytest

from rankwise.llm import mixing as m

DDL = "doc_id long, source string, text string"


def mixed(spark, rows, **options):
    return m.mix(spark.createDataFrame(rows, DDL), **options)


def test_lag_stays_under_one_block(spark):
    sizes = {"a": 300, "b": 170, "c": 61, "d": 9, None: 20}
    rows = [(i * 10 + j, s, "t") for j, (s, n) in enumerate(sizes.items()) for i in range(n)]
    weights = {"a": .5, "b": .3, "c": .15, "d": .03, None: .02}
    got = mixed(spark, rows, weights=weights, block_docs=1, period=100).collect()
    assert len(got) == len(rows) and len({r.mix_position for r in got}) == len(rows)
    slots = {r.mix_slot: r.source for r in got}
    end = min(max(r.mix_slot for r in got if r.source == s) for s in sizes)
    had = dict.fromkeys(sizes, 0)
    for t in range(end + 1):
        had[slots[t]] += 1
        assert all(abs(had[s] - weights[s] * (t + 1)) < 1 for s in sizes)
    for r in got:
        a, p, k = r.mix_units, r.mix_period, r.mix_block
        assert (r.mix_release, r.mix_deadline) == (k * p // a, math.ceil((k + 1) * p / a))
        assert r.mix_release <= r.mix_slot < r.mix_deadline


def test_two_levels_number_a_large_source_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(m, "GROUP_ROWS", 7)
    rows = [(i, "a" if i % 3 else "b", "t") for i in range(400)]
    got = mixed(spark, rows, block_docs=4).collect()
    for s in "ab":
        blocks = sorted(r.mix_block for r in got if r.source == s)
        assert blocks == [i // 4 for i in range(len(blocks))]


def test_odd_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (None, "a", None), (2, None, ""),
            (3, "unlisted", "z" * 50_000)]
    got = mixed(spark, rows, weights={"a": 1.0}, block_docs=2)
    assert got.columns[:3] == ["doc_id", "source", "text"]
    out = got.collect()
    assert sorted(((r.doc_id, r.source, r.text) for r in out), key=repr) == sorted(rows, key=repr)
    assert len({r.mix_position for r in out}) == len(rows)
    least = m.PERIOD // m.LEAST_SHARE
    assert {r.source: r.mix_units for r in out} == {"a": m.PERIOD, None: least, "unlisted": least}


def test_the_rule_does_not_depend_on_the_number_of_documents(spark):
    """Ten and a thousand times the documents: the same units and the same first slots."""
    firsts = []
    for times in (1, 10, 1000):
        rows = spark.createDataFrame([("a", "a", 37 * times), ("b", "b", 11 * times)],
                                     "key string, source string, n long")
        got = m.units(m.given_weights(rows, {"a": math.pi, "b": math.e}), m.PERIOD)
        plan = m.schedule(got, 1).filter("slot < 40").orderBy("slot").collect()
        firsts.append([(r.slot, r.key, r.units) for r in plan])
    assert firsts[0] == firsts[1] == firsts[2] and len(firsts[0]) == 40


def test_names_that_clash_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a", 5)], "doc_id long, source string, mix_slot long")
    got = m.mix(df)
    dotted = m.mix(df.withColumnRenamed("mix_slot", "a.b"))
    assert "a.b" in dotted.columns and dotted.select("`a.b`").first()[0] == 5
    assert got.first().mix_slot == 5 and "_mix_slot" in got.columns
    assert m.mix(spark.createDataFrame([], DDL)).count() == 0


@pytest.mark.parametrize("units", [{"a": 1}, {"a": 7, "b": 7, "c": 7}, {"a": 90, "b": 9, "c": 1}])
def test_one_period_gives_each_source_its_units(spark, units):
    df = spark.createDataFrame(list(units.items()), "key string, units long")
    plan = m.schedule(df).collect()
    assert sorted(r.slot for r in plan) == list(range(sum(units.values())))
    assert all(sum(r.key == s for r in plan) == n for s, n in units.items())
    assert all(r.release <= r.slot < r.deadline for r in plan)


@pytest.mark.parametrize("weights", [None, {"s0": .5} | {f"s{i}": .0025 for i in range(1, 201)}])
def test_lag_against_the_weights_themselves(spark, weights):
    counts = {"s0": 9_000} | ({f"s{i}": 700 for i in range(1, 20)} if weights is None
                              else {f"s{i}": 12 for i in range(1, 201)})
    rows = [(i, s, "t") for s, n in counts.items() for i in range(n)]
    shares = weights or {s: math.sqrt(n) for s, n in counts.items()}
    shares = {s: w / sum(shares.values()) for s, w in shares.items()}
    got = mixed(spark, rows, weights=weights, block_docs=1).collect()
    assert len(got) == len(rows) and len({r.mix_position for r in got}) == len(rows)
    slots = {r.mix_slot: r.source for r in got}
    last = {s: max(r.mix_slot for r in got if r.source == s) for s in counts}
    had = dict.fromkeys(counts, 0)
    for t in range(min(last.values()) + 1):
        had[slots[t]] += 1
        assert all(abs(had[s] - shares[s] * (t + 1)) < 1 + 1e-5 for s in counts)
