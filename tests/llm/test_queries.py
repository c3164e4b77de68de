"""The registered queries against their SQL, and their columns and rows."""

import os

import duckdb
import pytest

from millrace.llm import queries
from tests.compare import of_duckdb, of_frame

DATA = "/root/testdata/sf0.001"
#: Columns that a query must have, beside others.
COLUMNS = {
    "op1_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op2_perplexity": {"doc_id", "perplexity", "kept"},
    "op3_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op4_sequences": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op5_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op6_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op7_jaccard_join": {"doc_id", "class_id", "n_links"},
    "op8_secrets": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op9_line_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op10_decontaminate": {"doc_id", "contaminated", "items"},
}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, tables, name):
    assert of_frame(queries.QUERIES[name](spark, DATA)) == of_duckdb(tables, queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_whole_table(spark, name):
    found = queries.QUERIES[name](spark, DATA)
    assert COLUMNS[name] <= set(found.columns)
    table, key = ("pages", "page_id") if name == "op1_warc" else ("documents", "doc_id")
    ids = [r[0] for r in found.select(key).collect()]
    assert sorted(ids) == sorted(r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect())
