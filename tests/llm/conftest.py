import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with every awkward case: nulls, empty and long texts, repeats, ties, and clashing extra columns."""
    rows = [(i, f"the quick brown fox number {i % 7} jumps over the lazy dog again and again {i}", "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, i) for i in range(40)]
    rows += [(100, None, "de", "s1", 0), (101, "", None, None, 0), (102, " \t\n", "de", "s1", 0), (103, "x" * 30_000, "de", "s2", 1), (104, "word " * 9_000, "en", "s2", 1)]
    rows += [(105, "same text here for all of them", "en", "s0", 3)] * 3 + [(106 + i, "same text here for all of them", "en", "s0", 3) for i in range(4)] + [(None, "no id", "en", "s0", 5), (None, None, None, None, None)]
    wide = [r + (7, 8, "shard", 9) for r in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, slot long, size long, kept string, fp long")


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("false")
