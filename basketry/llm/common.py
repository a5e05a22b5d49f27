"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import io
import os
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketry.session import materialize, scratch_path  # noqa: F401  (the operators take materialize from here)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


ROWS = 1024  # rows that a Python worker holds as objects at once

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers once per application.

    A zip in the shared folder is given to Spark's own file distribution
    (``addPyFile``), so the workers import the operators wherever the package is
    installed or not.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = scratch_path(spark, f"code-{uuid.uuid4().hex}/basketry_code.zip")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (so any store Spark can open works)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, columns: list[str], schema: str,
                work: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]]) -> DataFrame:
    """Run ``work`` over column batches ``{name: list}`` of the named columns only.

    Selecting the columns first keeps clashing or extra columns out of the Python
    workers; ``work`` is a generator over the batches of one partition, so its
    memory is one batch plus whatever state it keeps.
    """
    ship_package(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        def lists():
            for whole in batches:
                for start in range(0, whole.num_rows, ROWS):
                    b = whole.slice(start, ROWS)
                    yield {name: b.column(i).to_pylist() for i, name in enumerate(columns)}
        for out in work(lists()):
            arrays = [pa.array(out[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


TURNS = 6    # tasks of a place in one round of give_back_memory
ROUNDS = 8   # rounds at most
_kept: list[dict] = []
_tidied: list[str] = [""]   # the last call of give_back_memory that reached this worker


def kept_in_worker(store: dict) -> dict:
    """A table that a module keeps in a Python worker from task to task, until :func:`give_back_memory`."""
    _kept.append(store)
    return store


def empty_worker() -> None:
    """Empty the tables of :func:`kept_in_worker` and hand memory that is no longer used back to the system."""
    for store in _kept:
        store.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):   # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def give_back_memory(spark: SparkSession) -> None:
    """Let the idle Python workers hand memory that they no longer use back to the system.

    Workers are reused from one step to the next, and what their allocators keep
    for themselves counts against the executor while the next step allocates anew.
    Tables of :func:`kept_in_worker` are emptied too; who needs them fills them again.
    A place where a task runs keeps several workers (one for each Python step that its tasks
    chained) and uses them in turn, so it gets rounds of ``TURNS`` short tasks until a round
    meets only workers that this call has reached before; nothing depends on it.
    """
    ship_package(spark)
    call = uuid.uuid4().hex

    def tidy(batches):
        for _ in batches:
            pass
        from basketry.llm import common  # the worker's own module, not a copy sent along
        new = common._tidied[0] != call
        if new:
            common._tidied[0] = call
            common.empty_worker()
        time.sleep(0.1)   # long enough for every place to get a task
        yield pa.RecordBatch.from_arrays([pa.array([int(new)], pa.int64())], ["reached"])

    places = max(2, TURNS * spark.sparkContext.defaultParallelism)
    for _ in range(ROUNDS):
        if not spark.range(0, places, 1, places).mapInArrow(tidy, "reached long").agg(F.sum("reached")).first()[0]:
            break


BROADCAST_IDS = 1 << 21  # ids (16 MB) up to which a written list of them is sent to the scans


def few_enough(written: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """A written table of ids, marked for broadcast if a count shows that it is small; joined by shuffle beyond."""
    return F.broadcast(written) if written.count() <= rows else written


def content_digest(*columns: str) -> Column:
    """128 bits of some text columns, which tell rows of one doc_id apart by what they hold (NULL is no empty text)."""
    told = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), *told)), 16, "0") for seed in (1, 2)]  # hashed in place, without copies
    return F.unhex(F.concat(*halves))


def without(docs: DataFrame, gone: DataFrame, digest: Column) -> DataFrame:
    """The rows of ``docs`` but those whose doc_id and digest are listed in the written table ``gone``."""
    listed = gone.select(F.col("doc_id").alias("__gone"), F.col("digest").alias("__digest"))
    return docs.join(few_enough(listed, BROADCAST_IDS // 4),
                     F.col("doc_id").eqNullSafe(F.col("__gone")) & (digest == F.col("__digest")), "left_anti")


def hash_bucket(column: str, modulus: int):
    """crc32 of the column written as text, modulo ``modulus`` (the folds of the contracts)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)
