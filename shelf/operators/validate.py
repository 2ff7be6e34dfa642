"""Validation: each check returns its violations as rows, so a dataset is valid where none are left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelf.operators.ranges import order_violations

DATASET_SCHEMA, RECORD_SCHEMA = "shelf/dataset/1", "shelf/record/1"
#: What records are ordered by, for each mode.
ORDERING_KEYS = {"archive_entry": {"archive_key": "ordinal", "entry_key": "index"}, "database_book": {"source": "database", "entry_key": "book_id"}}


def dangling(rows: DataFrame, dimension: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key the dimension lacks."""
    return rows.join(dimension.select(*on).distinct(), on, "left_anti")


def undeclared_observations(rows: DataFrame) -> DataFrame:
    """(locator, place, observation): every claim, identity, size, occurrence or relation that names an observation its row does not declare."""
    def named(place: str, column: Column) -> Column:
        return F.transform(column, lambda x: F.struct(F.lit(place).alias("place"), x["observation"].alias("observation")))

    parts = [named(c, F.col(c)) for c in rows.columns if c.startswith("claim_")]
    parts += [named("identity", F.col("identities")), named("size", F.col("artifact.sizes")), named("occurrence", F.col("artifact.occurrences")), named("checksum", F.col("artifact.checksums")), named("relation", F.col("relations"))]
    declared = F.transform("observations", lambda o: o["id"])
    flat = rows.select("locator", declared.alias("_ids"), F.explode(F.flatten(F.array(*parts))).alias("r"))
    return flat.where(~F.array_contains("_ids", F.col("r.observation"))).select("locator", "r.place", "r.observation")


def undeclared_sources(rows: DataFrame, archives: DataFrame) -> DataFrame:
    """Observations whose source is neither the database nor a declared archive (column id); absent ones may be."""
    seen = rows.select("locator", F.explode("observations").alias("o")).where("o.status <> 'absent' and o.source <> 'database'").select("locator", F.col("o.source").alias("id"))
    return dangling(seen, archives, ["id"])


def bad_archive_indexes(rows: DataFrame, archives: DataFrame) -> DataFrame:
    """Locators whose index their archive (id, entries) does not have."""
    located = rows.where("locator.kind = 'archive_entry'").select(F.col("locator.source").alias("id"), F.col("locator.index").alias("index"))
    return located.join(archives.select("id", "entries"), "id").where("index < 0 or index >= entries")


def order_errors(rows: DataFrame, archives: DataFrame) -> DataFrame:
    """Rows (with file position pos) that stand before one of a lesser (archive ordinal, index) in their archive, and archives out of turn.

    In order means: within each archive indexes do not fall, and each archive's positions come after all
    of the archives before it. Both are checked per archive, so no task sees the whole file.
    """
    placed = rows.join(archives.select(F.col("id").alias("_id"), "ordinal"), F.col("locator.source") == F.col("_id"), "left")
    placed = placed.withColumns({"_ordinal": F.coalesce("ordinal", F.lit(0)), "_index": F.coalesce("locator.index", "locator.book_id")})
    inside = order_violations(placed, ["_ordinal"], ["pos"], ["_index"])
    spans = placed.groupBy("_ordinal").agg(F.min("pos").alias("_first"), F.max("pos").alias("_last"))
    reached = Window.orderBy("_ordinal").rowsBetween(Window.unboundedPreceding, -1)  # a row per archive
    early = spans.withColumn("_before", F.max("_last").over(reached)).where("_first <= _before").select("_ordinal", "_before")
    out_of_turn = placed.join(early, "_ordinal").where("pos <= _before").select(placed.columns)
    return inside.unionByName(out_of_turn).dropDuplicates(["pos"]).drop("_id", "_ordinal", "_index")


def header_errors(header: dict) -> list[str]:
    """What is wrong with a dataset's header."""
    errors = []
    for key, known in (("schema", DATASET_SCHEMA), ("record_schema", RECORD_SCHEMA)):
        if key in header and header[key] != known:
            errors.append(f"{key} is {header[key]!r}, not {known!r}")
    if header.get("records", -1) < 0:
        errors.append("records must not be negative")
    archives = header.get("archives") or []
    if len({a["id"] for a in archives}) != len(archives):
        errors.append("archive ids must be unique")
    errors += [f"archive {a['id']} has ordinal {a['ordinal']} at position {i}" for i, a in enumerate(archives) if a["ordinal"] != i]
    ordering = header.get("ordering") or {}
    if ordering.get("mode") not in ("archive_entry", "database_book"):
        errors.append("unknown ordering mode")
    elif (ordering["mode"] == "archive_entry") != bool(archives):
        errors.append("ordering mode and archives disagree")
    elif ordering.get("direction", "ascending") != "ascending" or any(ordering.get(k, v) != v for k, v in ORDERING_KEYS[ordering["mode"]].items()):
        errors.append("ordering keys and mode disagree")
    return errors


def count_error(declared: int, rows: DataFrame) -> DataFrame:
    """One row where the declared number of records is not the actual one."""
    return rows.agg(F.count("*").alias("actual")).withColumn("declared", F.lit(declared).cast("long")).where("actual <> declared")


def same_sources(manifest: DataFrame, current: DataFrame, keys: list[str], facts: list[str]) -> DataFrame:
    """One row: whether two lists agree pairwise on all facts (null equals null); light checks pass fewer facts."""
    left = manifest.select(*keys, F.struct(*facts).alias("_a"))
    right = current.select(*keys, F.struct(*facts).alias("_b"))
    equal: Column = F.coalesce(F.col("_a").eqNullSafe(F.col("_b")), F.lit(False))
    return left.join(right, keys, "full").agg(F.coalesce(F.bool_and(equal), F.lit(True)).alias("matches"))


def manifest_decisions(sources: DataFrame, cache: DataFrame, key: str, facts: list[str], rebuild: bool = False) -> DataFrame:
    """Per source: valid, fresh, missing, reason and decision (use, create or none).

    sources and cache have key, the facts and (cache) built, (sources) modified. A cache entry is valid if
    its facts agree, fresh if built after the source's last change. What is neither missing nor usable is
    made anew only with rebuild.
    """
    held = cache.select(F.col(key).alias("_key"), F.struct(*facts).alias("_held"), "built")
    joined = sources.join(held, F.col(key) == F.col("_key"), "left")
    missing, valid = F.col("_key").isNull(), F.struct(*facts).eqNullSafe(F.col("_held"))
    fresh = F.coalesce(F.col("built") > F.col("modified"), F.lit(False))
    valid = F.when(missing, False).otherwise(valid)
    decision = F.when(missing, "create").when(valid & fresh, "use").otherwise("create" if rebuild else "none")
    reason = F.when(missing, "missing").when(~valid, "mismatch").when(~fresh, "stale").otherwise("")
    return joined.select(*sources.columns, valid.alias("valid"), fresh.alias("fresh"), missing.alias("missing"), reason.alias("reason"), decision.alias("decision"))


def manifest_summary(decisions: DataFrame) -> DataFrame:
    """Counts of ready, valid, fresh and missing sources; ready is valid and fresh."""
    return decisions.agg(F.count_if(F.col("valid") & F.col("fresh")).alias("ready"), F.count_if("valid").alias("valid"), F.count_if("fresh").alias("fresh"), F.count_if("missing").alias("missing"))
