from shelf.plans import catalogue

FIRST = ["wandering albatross crossed", "northern oceans silently"]
SECOND = ["crimson lanterns illuminated", "forgotten staircases yesterday"]


def test_whole_bodies_of_several_lines_are_found(spark, tmp_path):
    """A body of two lines is a section of another document, which no opening line shows."""
    docs = [(1, "\n".join(FIRST)), (2, "\n".join(SECOND)), (3, "\n".join([" ".join(FIRST), " ".join(SECOND)])), (4, "unrelated paragraph entirely")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalogue.QUERIES["body_compilations"](spark, str(tmp_path)).collect()
    assert sorted((r.book, r.part, r.match, r.covered) for r in got) == [(3, 0, 1, True), (3, 1, 2, True)]
    openings = catalogue.QUERIES["compilations"](spark, str(tmp_path)).collect()
    assert {1, 2}.isdisjoint(r.match for r in openings)
