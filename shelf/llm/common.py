"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python worker holds as objects at a time.
SLICE = 512
#: The separator of words in every contract of this subpackage.
SPACES = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which driver and executors share.

    It is the one that spark.checkpoint.dir names. Only where that is unset and the master is local,
    as in tests, a temporary folder is made; on a cluster, where nobody else could read it, that is an error.
    """
    context = spark.sparkContext
    found = context._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="shelf-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder, so later reads survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path for a written table in the shared folder."""
    return f"{shared_dir(spark)}/shelf-{kind}-{uuid.uuid4().hex}"


def words(text: Column) -> Column:
    """The words of a text: maximal runs without ASCII white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row even where body is a lambda over an array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of batches, which gives memory back at its end: Spark keeps a task's Python worker for later ones, with all that it holds."""

    def lean_run(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return lean_run


def map_rows(df: DataFrame, kept: list[str], added: dict[str, str], make: Callable[[], Callable], rows: int = 0, given: list[str] | None = None) -> DataFrame:
    """Columns `kept` as they are, and `added` (name -> SQL type), computed from the columns `given`: by default those not kept.

    make() is called once per task and returns a function of a row's given values that makes a
    tuple of the added ones; with `rows`, a function of lists of up to that many values that gives a
    list of tuples. Kept values never pass through Python objects, so ids keep their type.
    """
    place = {c: i for i, c in enumerate(df.columns)}
    kinds = [t for _, t in df.dtypes]
    at_kept = [place[c] for c in kept]
    at_given = [place[c] for c in given] if given else [i for c, i in place.items() if c not in kept]
    names = [f"c{i}" for i in range(len(kept) + len(added))]  # columns go by place, so that they may have any name
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, [*[kinds[i] for i in at_kept], *added.values()], strict=True))
    arrow = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
             "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, len(b), SLICE)):
            values = [batch.column(i).to_pylist() for i in at_given]
            if rows:
                made = [r for at in range(0, len(batch), rows) for r in one(*[v[at:at + rows] for v in values])]
            else:
                made = [one(*v) for v in zip(*values, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in at_kept] + [pa.array([r[i] for r in made], arrow[t]) for i, t in enumerate(added.values())], names=names)

    return df.toDF(*[f"c{i}" for i in range(len(kinds))]).mapInArrow(lean(run), schema).toDF(*kept, *added)


def filter_rows(df: DataFrame, given: str, make: Callable[[], Callable]) -> DataFrame:
    """The rows, with all their columns whatever their names, whose value of the column `given` passes.

    make() is called once per task and returns a function from a value to whether its row stays.
    """

    at_given = df.columns.index(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = make()
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, len(b), SLICE)):
            yield batch.filter(pa.array([passes(v) for v in batch.column(at_given).to_pylist()], pa.bool_()))

    placed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # columns go by place, so that they may have any name
    return placed.mapInArrow(lean(run), placed.schema).toDF(*df.columns)
