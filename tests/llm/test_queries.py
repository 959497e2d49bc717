"""Registered queries: names, SQL side by side on the smallest tables, contracts."""
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from rankwise.llm.queries import ORACLE, QUERIES

TABLES = ["documents", "benchmark", "pages", "conversations"]
FIRST_COLUMNS = {
    "op1_lm_automaton": [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"),
                         ("n_known", "bigint"), ("train_tokens", "bigint"),
                         ("base_score", "double"), ("score", "double")],
    "op3_quality_rules": [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"),
                          ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
                          ("n_repeat_words", "bigint"), ("base_failed", "boolean"),
                          ("kept", "boolean")],
    "op6_html_blocks": [("page_id", "bigint"), ("url", "string"), ("text", "string"),
                        ("n_chars", "bigint")],
    "op7_decontaminate": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"),
                          ("n_items", "bigint"), ("items_sha256", "string"),
                          ("contaminated", "boolean")],
    "op12_byte_gru": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"),
                      ("score", "double")],
}


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_module.queries())
    assert set(ORACLE) <= set(QUERIES) & set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=repr)
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", list(FIRST_COLUMNS))
def test_contract_columns(spark, name):
    assert QUERIES[name](spark, SF_SMALL).dtypes[:len(FIRST_COLUMNS[name])] == FIRST_COLUMNS[name]
