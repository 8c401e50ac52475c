"""The registered text queries against DuckDB, and their contracts' columns."""

import pytest

import __spark_entry__ as registry
from eventlake.llm import oracle, queries
from tests.compare import duck, duck_rows, spark_rows
from tests.llm.frames import SMALL

COLUMNS = {
    "op1_": "doc_id held_out score predicted",
    "op2_": "doc_id held_out lang_pred score",
    "op3_": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op4_": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5_": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op6_": "doc_id held_out score predicted",
    "op7_": "doc_id start stop n_chunks first_doc_id removed",
    "op8_": "doc_id n_shingles component_id",
    "op9_": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op10_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11_": "doc_id n_lines n_dropped kept_sha256",
    "op12_": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
}


def test_one_query_per_operator_and_the_pipeline():
    registered = registry.queries()
    for prefix in COLUMNS:
        assert len([name for name in registered if name.startswith(prefix)]) == 1
    assert "pipeline" in registered


@pytest.mark.parametrize("name", sorted(queries.all_queries()))
def test_columns(spark, name):
    prefix = name.split("_")[0] + "_"
    df = queries.all_queries()[name](spark, SMALL)
    assert df.columns == COLUMNS[prefix].split()
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle.all_sql()))
def test_query_equals_statement(spark, name):
    assert spark_rows(queries.all_queries()[name](spark, SMALL)) == duck_rows(duck(SMALL), oracle.all_sql()[name])
