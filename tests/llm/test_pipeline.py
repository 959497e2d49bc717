"""The pipeline against a brute-force version of its five stages, and its contract."""
import hashlib
import math

import pytest
import test_decontaminate
import test_line_templates
import test_ngram_join
import test_quality_rules

import corpus_pipeline
from conftest import SF_SMALL
from rankwise.llm import mixing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def mixed(rows):
    """doc_id to slot and position: blocks of each source, earliest deadline first."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r[0])
    weight = {s: round(math.sqrt(len(ids)) * 1_000_000) for s, ids in by_source.items()}
    total = sum(weight.values())
    units = {s: max(mixing.PERIOD // mixing.LEAST_SHARE, round(w / total * mixing.PERIOD))
             for s, w in weight.items()}
    period, had, at, slot = sum(units.values()), dict.fromkeys(units, 0), {}, -1
    # A source that has run out goes on taking its slots, until every block has one.
    while any(had[s] * mixing.BLOCK_DOCS < len(ids) for s, ids in by_source.items()):
        slot += 1
        _, s = min((-(-(had[s] + 1) * period // a), s) for s, a in units.items()
                   if had[s] < a and had[s] * period // a <= slot)
        at[s, had[s]] = slot
        had[s] += 1
    out = {}
    for s, ids in by_source.items():
        ids.sort(key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest())
        for place, i in enumerate(ids):
            turn, k = divmod(place // mixing.BLOCK_DOCS, units[s])
            slot = turn * period + at[s, k]
            out[i] = slot, slot * mixing.BLOCK_DOCS + place % mixing.BLOCK_DOCS
    return out


def stages(rows, items):
    """Rows after each of the first four stages."""
    rows = [r for r, kept in zip(rows, test_quality_rules.keeps(rows), strict=True) if kept]
    yield rows
    cut = test_line_templates.plain(rows)
    rows = [(r[0], cut[r[0]][0], r[2], r[3], len(cut[r[0]][0]) if cut[r[0]][0] != r[1] else r[4])
            for r in rows if not cut[r[0]][1]]
    yield rows
    first = {r[0]: r[1] for r in test_ngram_join.plain([x[:2] for x in rows])}
    rows = [r for r in rows if first[r[0]] == r[0]]
    yield rows
    bad = {r[0] for r in test_decontaminate.plain([x[:2] for x in rows], items) if r[5]}
    yield [r for r in rows if r[0] not in bad]


def test_run_equals_brute_force_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted(map(tuple, docs.select(COLUMNS).collect()))
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = list(stages(rows, items))
    assert len(rows) > len(want[0]) > len(want[2]) > len(want[3]) > 0
    now = docs
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want, strict=False):
        now = stage(spark, now, SF_SMALL)
        assert now.columns == COLUMNS, name
        got = sorted(map(tuple, now.collect()))
        assert [r[:4] for r in got] == [r[:4] for r in expected], name
        now = spark.createDataFrame(got, docs.schema)
    final = corpus_pipeline.run(spark, SF_SMALL).collect()
    place = mixed(want[3])
    assert sorted((r.doc_id, r.text, r.mix_slot, r.mix_position) for r in final) == \
        sorted((r[0], r[1], *place[r[0]]) for r in want[3])


def test_stages_of_the_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "line_dedup", "near_duplicates", "decontamination", "mixture"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0),
            (None, "some words", "en", None, 10)]
    out = stage(spark, spark.createDataFrame(rows, ddl), SF_SMALL)
    assert out.columns[:5] == COLUMNS and out.count() <= len(rows)
    assert stage(spark, spark.createDataFrame([], ddl), SF_SMALL).count() == 0
