import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from shelf.plans import catalogue, fields, ingestion
from tests.oracle import SF, check

ROOT = Path(__file__).resolve().parents[1]


MODULES = (catalogue, fields, ingestion)  # all register their queries in one table


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_queries_match_their_sql(spark, name):
    check(spark, catalogue.QUERIES[name], catalogue.ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.queries()["export_rows"](spark, SF).limit(1).count() == 1


@pytest.mark.parametrize("pipeline", [False, True])
def test_the_library_does_without_its_corpus_operators(tmp_path, pipeline):
    """With both llm folders gone, and the pipeline's file gone or still there."""
    shutil.copytree(ROOT / "shelf", tmp_path / "shelf", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(ROOT / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", *(["corpus_pipeline.py"] if pipeline else [])):
        shutil.copy(ROOT / name, tmp_path)
    code = """
import __spark_entry__ as e
assert {'export_rows', 'zip_entries', 'relations'} <= set(e.queries()) and not any(q == 'pipeline' or q.startswith('op') and q[2].isdigit() for q in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
import bench, tests.oracle
print('fine')"""
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("fine"), done.stderr[-500:]


def test_nothing_else_imports_the_corpus_operators():
    for path in [*ROOT.glob("shelf/**/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "import corpus_pipeline" not in (text := path.read_text()) or path.name == "test_plans.py"
            assert "shelf.llm" not in text or path.name == "test_plans.py"


def test_new_ranges_keeps_long_ids_whole(spark, tmp_path):
    import duckdb

    folder = str(tmp_path / "sf")
    spark.createDataFrame([(1, 7), (1190, 20), (999_999, 0), (1_000_000, 49), (8_999_999, 3)], "o_orderkey long, o_custkey long").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW orders AS SELECT * FROM '{folder}/orders.parquet/*.parquet'")
    want = sorted(connection.execute(catalogue.ORACLES["new_ranges"]).fetchall())
    assert sorted(tuple(r) for r in catalogue.QUERIES["new_ranges"](spark, folder).collect()) == want
    assert ("fb2-1000000-1000049.zip", 1_000_000, 1_000_049) in want
