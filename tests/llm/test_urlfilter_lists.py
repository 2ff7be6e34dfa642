import pytest
from pyspark.sql import functions as F

from shelf.llm import urlfilter as u

LISTED, PAGES = 120_000, 60_000


@pytest.mark.parametrize("most", [u.MAX_BROADCAST_BLOCKS, 100])
def test_a_large_list_is_exact_under_the_rules(spark, monkeypatch, most):
    """Every second page is listed; both ways to reach the filter's blocks, and rules before the list."""
    monkeypatch.setattr(u, "MAX_BROADCAST_BLOCKS", most)
    assert LISTED // u.KEYS_PER_BLOCK > 100
    listed = spark.range(LISTED).select(F.format_string("HTTP://Site%d.org:80/p%d?utm_medium=z#top", F.col("id") % 5000, F.col("id")).alias("url"))
    page = F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + LISTED)
    pages = spark.range(PAGES).select(F.col("id").alias("page_id"), F.format_string("https://site%d.org/p%d", page % 5000, page).alias("url"))
    rules = (u.Rule("allow", "site0.org", "/"), u.Rule("block", "site1.org", "/"))
    got = u.judge_urls(pages, rules, listed).join(spark.range(PAGES).select(F.col("id").alias("page_id"), (page % 5000).alias("site")), "page_id")
    want = F.when(F.col("site") == 0, "allow").when(F.col("site") == 1, "block").when(F.col("page_id") % 2 == 0, "block").otherwise("allow")
    assert got.count() == PAGES
    assert got.where(F.col("verdict") != want).count() == 0
    assert got.where("verdict = 'block' and rule is null").count() > 20_000
