import pytest

import __spark_entry__ as entry
from shelf.llm import registry
from tests.oracle import SF, check


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    check(spark, registry.queries()[name], registry.oracle_sql()[name])


def test_all_are_registered():
    numbers = [int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(numbers) == list(range(1, 11)) and "pipeline" in entry.queries()


COLUMNS = {
    "op1": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op2": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op3": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op4": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op5": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op6": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint", "shard_runs": "string"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op9": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string", "n_joins": "int"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_columns_and_rows(spark, name):
    frame = registry.queries()[name](spark, SF)
    assert dict(frame.dtypes) == COLUMNS[name.split("_")[0]]
    source = {"op3": "pages", "op5": "embeddings"}.get(name.split("_")[0], "documents")
    assert frame.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()
