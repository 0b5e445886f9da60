"""Each query that SQL can express equals its SQL, and all queries return the contract's columns."""

import os
from collections import Counter

import duckdb
import pytest

from wardbook.llm.oracles import ORACLES
from wardbook.llm.queries import QUERIES

CONTRACT = {
    2: "doc_id held_out n_tokens n_known train_tokens base_score score", 3: "doc_id n_tokens ids_sha256 decoded_sha256",
    4: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    5: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    6: "vec_id n_links component_id kept", 7: "doc_id n_assign n_access n_hex base_sha256 spans",
    8: "doc_id n_lines n_dropped kept_sha256", 9: "doc_id size source_size target taken",
    10: "doc_id n_shingles component_id", 11: "lang source part item value rank",
    12: "doc_id keep_id group_size kept text_sha256", 13: "doc_id n_features weight score rank",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in os.listdir(sf_dir):
        duck.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM '{sf_dir}/{table}'")
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(want)
    assert want


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, sf_dir, name):
    number = int(name[2:].split("_")[0])
    if number in CONTRACT:
        wanted = CONTRACT[number].split()
        assert QUERIES[name](spark, sf_dir).columns[: len(wanted)] == wanted
