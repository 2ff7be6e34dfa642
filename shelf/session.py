"""Session factory used by tests, the benchmark and ad-hoc scripts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(app: str = "shelf", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings every module assumes (UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder; the folder may be any path that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share.

    Only where that is unset and the master is local, as in tests, a temporary folder is made.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="shelf-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{shared_folder(spark)}/shelf-{kind}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """A frame that several parts of a plan read, computed once into the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
