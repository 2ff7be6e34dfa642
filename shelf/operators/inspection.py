"""Inspection of a dataset: point lookups and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelf.operators.fingerprints import decode_fingerprint


def lookup_mode(**options) -> str:
    """The one lookup that options ask for; several are an error, and archive and index belong together."""
    given = {k for k, v in options.items() if v is not None and v is not False}
    if ("index" in given) != ("archive" in given):
        raise ValueError("archive and index go together")
    modes = (given - {"index"}) & {"book_id", "archive", "file"}
    if len(modes) > 1:
        raise ValueError(f"one lookup at a time, not {sorted(modes)}")
    return next(iter(modes), "summary")


def has_book(book_id: int) -> Column:
    """A row whose locator, any catalogue identity, or any observation is of the book."""
    return (F.coalesce(F.col("locator.book_id") == book_id, F.lit(False)) | F.exists("observations", lambda o: F.coalesce(o["book_id"] == book_id, F.lit(False)))
            | F.exists("identities", lambda i: (i["scheme"] == "catalog.book") & (i["value"] == str(book_id))))


def at_entry(archive: str, index: int) -> Column:
    return (F.col("locator.source") == archive) & (F.col("locator.index") == index)


def has_file(name: str) -> Column:
    """A row whose file or any of its occurrences has the name, in any case."""
    wanted = name.lower()
    return F.coalesce(F.lower("artifact.name") == wanted, F.lit(False)) | F.exists("artifact.occurrences", lambda o: F.lower(o["entry"]) == wanted)


def first_match(rows: DataFrame, condition: Column, order: list[str]) -> DataFrame:
    """The first row that fits, by a top-1 over partial results; at most one."""
    return rows.where(condition).orderBy(*order).limit(1)


def dataset_summary(rows: DataFrame, archives: DataFrame | None = None) -> DataFrame:
    """Counts of records, of records by source, and of issues; with archives, their entries too."""
    status = lambda o: F.exists("observations", lambda x: (x["id"] == o) & (x["status"] == "present"))
    counts = rows.agg(F.count("*").alias("records"), F.count_if(status("db")).alias("db_records"), F.count_if(status("fb2")).alias("fb2_records"), F.sum(F.size("issues")).alias("issues"))
    if archives is None:
        return counts
    return counts.crossJoin(archives.agg(F.count("*").alias("archives"), F.sum("entries").alias("entries"), F.sum("fb2_entries").alias("fb2_entries")))  # one row each


def coverage(available: Column, total: Column) -> Column:
    """absent, partial or complete."""
    return F.when(available == 0, "absent").when(available < total, "partial").otherwise("complete")


def decoded_fingerprints(rows: DataFrame, column: str = "fingerprint", key: str = "book") -> DataFrame:
    """(key, pos, depth, key_hex, leaf) of encoded fingerprints; a text that does not decode gives no rows."""
    import base64

    kind = dict(rows.dtypes)[key]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for k, text in zip(pdf[key], pdf[column], strict=True):
                try:
                    sections = decode_fingerprint(text or "")
                except ValueError:
                    continue
                out += [(k, i, d, base64.urlsafe_b64decode(x + "==").hex(), leaf) for i, (d, x, leaf) in enumerate(sections)]
            yield pd.DataFrame(out, columns=[key, "pos", "depth", "key_hex", "leaf"])

    return rows.select(key, column).mapInPandas(run, f"{key} {kind}, pos int, depth int, key_hex string, leaf boolean")
