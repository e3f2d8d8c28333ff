"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import delete_path, scratch_path, scratch_table

# Fixed value: the white space that separates words (tab, newline, vertical tab, form feed,
# carriage return, blank).  Every other character belongs to a word.
WORD_BREAK_PATTERN = r"[\x20\x09-\x0D]+"

def word_bytes(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of ``text`` as UTF-8; with ``lower``, A-Z lower-cased.

    Unlike those of ``str``, ``split`` and ``lower`` of ``bytes`` know only the six ASCII blanks
    and only A-Z, in native code for texts of any language."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def words_of(text: str | None) -> list[str]:
    """The words of ``text``: runs of characters other than the six ASCII white-space ones."""
    if not text:
        return []
    return [w.decode("utf-8", "surrogatepass") for w in word_bytes(text)]


def ascii_lower(text: str) -> str:
    """``text`` with A-Z lower-cased and every other character unchanged."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def ascii_lower_column(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_column(c: Column) -> Column:
    """The words of a text column as an array; NULL and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), WORD_BREAK_PATTERN), "")


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def saved(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the lineage on
    storage every executor can read, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}")
    df.write.parquet(path, compression=compression)
    back = spark.read.schema(df.schema).parquet(path)
    back.saved_at = path
    return back


def saved_by(key: str, parts: list[DataFrame], tag: str, compression: str = "snappy") -> DataFrame:
    """``parts``, tables of the same columns, written one after the other as one table whose files lie by
    ``key``: joins on it with another such table shuffle nothing.  The shuffles behind a part leave the
    disk before the next begins.  ``tag`` holds no hyphen."""
    spark = parts[0].sparkSession
    name, buckets = scratch_table(spark, f"llm_{tag}"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    for i, part in enumerate(parts):
        if i:
            drop_shuffles(spark)
        (part.write.format("parquet").option("compression", compression).bucketBy(buckets, key)
         .mode("append").saveAsTable(name))
    return spark.table(name)


def release(*tables: DataFrame) -> None:
    """Delete tables written by :func:`saved` that no later step reads, and the shuffles behind
    them.  Only for tables whose every reader has itself been written."""
    for t in tables:
        delete_path(t.sparkSession, t.saved_at)
    if tables:
        drop_shuffles(tables[0].sparkSession)


PY4J_SLEEP = 1.5  # seconds; Py4J passes on dropped references from a thread that wakes every second


def drop_shuffles(spark: SparkSession) -> None:
    """Let the driver drop its references to finished shuffles, so that executors delete their
    files now and not at the next periodic collection.  Shuffles still in use are kept."""
    gc.collect()
    time.sleep(PY4J_SLEEP)  # else the references dropped just now would outlive the JVM's collection
    for _ in range(2):  # some are held by objects that the first collection finalises
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def give_back() -> None:
    """Return freed memory to the system.  Spark keeps worker processes for later stages, and with them
    what their allocators hold, so an executor would pay for the largest batches of every stage so far."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, followed by :func:`give_back` when its task has no more batches."""
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return task


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo ``divisor`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def label_sample(labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids ``(doc_id, label)``, chosen by the hash of the id, so
    the choice neither follows the order of the ids nor changes between runs.  Rows with a NULL
    id or a label other than 0 and 1 are left out; of an id labelled twice the larger counts."""
    return (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                          F.col(label_col).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))


SLICE = 512  # rows turned into Python objects at a time; bounds a task's memory


def map_rows(df: DataFrame, inputs: list[str], outputs: T.StructType,
             setup: Callable[[], Callable[..., list]], keep: bool = True,
             slice_rows: int = SLICE) -> DataFrame:
    """Compute ``outputs`` from the columns ``inputs``, row for row, in Arrow batches.

    ``setup()`` runs once per task and returns ``fn(*lists) -> list of output lists``.  With
    ``keep`` the input's other columns stay; one that has the name of an output is replaced.
    """
    clash = {f.name.lower() for f in outputs}
    inner = [f"__in{i}" for i in range(len(inputs))]
    kept = [c for c in df.columns if c.lower() not in clash] if keep else []
    src = df.select(*[F.col(f"`{c}`") for c in kept],
                    *[F.col(f"`{c}`").alias(n) for c, n in zip(inputs, inner)])
    schema = T.StructType([df.schema[c] for c in kept] + list(outputs.fields))
    types = [_arrow(f.dataType) for f in outputs.fields]
    names = schema.names
    n_kept = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = setup()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                cols = [part.column(n_kept + i).to_pylist() for i in range(len(inner))]
                out = fn(*cols)
                arrays = [part.column(i) for i in range(n_kept)]
                arrays += [o if isinstance(o, pa.Array) else pa.array(o, type=t)
                           for o, t in zip(out, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return src.mapInArrow(giving_back(run), schema)


def _arrow(t: T.DataType) -> pa.DataType:
    simple = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
              T.StringType: pa.string(), T.BinaryType: pa.binary(), T.BooleanType: pa.bool_(),
              T.FloatType: pa.float32()}
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in t.fields])
    return simple[type(t)]


def fields(ddl: str) -> T.StructType:
    """A struct from ``"name type, ..."`` without asking the JVM."""
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
             "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(),
             "longs": T.ArrayType(T.LongType()), "doubles": T.ArrayType(T.DoubleType()),
             "ints": T.ArrayType(T.IntegerType()), "strings": T.ArrayType(T.StringType())}
    out = []
    for part in ddl.split(","):
        name, kind = part.split()
        out.append(T.StructField(name, kinds[kind]))
    return T.StructType(out)
