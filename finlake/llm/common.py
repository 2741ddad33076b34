"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word: a maximal run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
#: What one Arrow batch holds at most, for all operators alike; a single longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever their working folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once per row, also where a lambda in `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words_of(text: Column) -> Column:
    """How many words a text has, without an array of them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def named(column: str) -> Column:
    return F.col(f"`{column}`")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master may go without it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("finlake.shared.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        found = f"file://{tempfile.mkdtemp(prefix='finlake-')}"
        spark.conf.set("finlake.shared.dir", found)
    return found.rstrip("/")


_written: set[str] = set()


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back: a short lineage that outlives any executor. The folder goes with
    `forget`, or when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/finlake-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_forget_all)
    _written.add(path)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def forget(*frames: DataFrame | None) -> None:
    """Deletes what `cut` wrote for frames that nothing will read again."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path in _written:
            _written.discard(path)
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _forget_all() -> None:
    with contextlib.suppress(Exception):  # the session may be gone, and its folder with it
        spark = SparkSession.getActiveSession()
        for path in list(_written) if spark else []:
            _delete(spark, path)


def _plain_read(df: DataFrame) -> bool:
    """Whether `df` is nothing but columns and rows picked from Parquet files."""
    todo = [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind not in ("Project", "Filter", "SubqueryAlias", "LogicalRelation") or not node.deterministic():
            return False
        if kind == "LogicalRelation" and "parquet" not in node.relation().toString().lower():
            return False
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return True


def settled(df: DataFrame) -> DataFrame:
    """`df` if it is a plain read of Parquet files, else written and read back."""
    return df if _plain_read(df) else cut(df)


def placed(df: DataFrame, *columns: Column) -> DataFrame:
    """`columns` of `df` with file (a hash of its path) and row (its index in the file). These two name the same row in
    every pass, however files are split and whichever executors come and go. What isn't a plain read of Parquet
    files is written first."""
    df = settled(df)
    place = df.metadataColumn("_metadata")
    return df.select(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row"), *columns)


def whole(df: DataFrame) -> Column:
    """A row's columns as one, so that no name meets an operator's own; `select("whole.*")` gives them back."""
    return F.struct(*[named(c) for c in df.columns]).alias("whole")


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by rows and bytes. All operators set the same bounds, so plans not yet run keep theirs."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def released() -> None:
    """Gives a worker's free memory back to the machine: workers outlive their tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def per_batch(df: DataFrame, body: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`df.mapInArrow` in bounded batches, after which the worker gives its memory back. No column passes through
    pandas, where a null among ids would turn them all into floating point numbers."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from body(batches)
        finally:
            released()

    return df.mapInArrow(run, schema)


def added(df: DataFrame, source: Column, make: Callable[[], Callable[[list], dict[str, list]]], schema: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """`df` without `drop` and with the columns of `schema`, which replace columns of the same names (compared without
    case). make() runs once a task and returns a function from a batch's values of `source` to the new columns; all other
    columns pass as they are."""
    new = StructType.fromDDL(schema)
    rest = no_clash(df, *new.names, *drop)
    kinds = to_arrow_schema(new)
    out = StructType(rest.schema.fields + new.fields)
    names = out.names
    frame = df.select(*[named(c) for c in rest.columns], source.alias(free_name(rest, "body")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        for batch in batches:
            got = made(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(got[f.name], f.type) for f in kinds)], names=names)

    return per_batch(frame, run, out)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def arrow(schema: str, **columns) -> pa.RecordBatch:
    """A batch of `schema` (plain types only) from lists or arrays by name, for workers."""
    fields = [f.split(" ") for f in schema.split(", ")]
    made = [x if isinstance(x := columns[name], pa.Array) else pa.array(x, _KINDS[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(made, names=[name for name, _ in fields])


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def no_clash(df: DataFrame, *names: str) -> DataFrame:
    """`df` without columns that an operator adds under the same names (compared without case)."""
    taken = {n.lower() for n in names}
    return df.select(*[named(c) for c in df.columns if c.lower() not in taken])
