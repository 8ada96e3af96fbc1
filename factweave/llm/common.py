"""Helpers shared by the operators: table paths, stored intermediates, Arrow batches, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHUNK_BYTES = 4 << 20   # text handled at once inside a Python task
TOKEN_BYTES = 12 << 20  # ... where texts are tokenized: more text shares its distinct words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a scratch folder of its own (tests); on a cluster
    that is an error, because a machine-local folder is not visible to the other machines.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="factweave-llm-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing), lets a frame be
    used several times at the cost of one computation, and gives the planner the true size, so
    that joins broadcast it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/factweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that tasks can import it wherever it is installed."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    if spark.conf.get(ARROW_ROWS) == "10000":  # Spark's default: texts of 100 KB would make batches of 1 GB
        spark.conf.set(ARROW_ROWS, "1000")
    root = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='factweave-')}/factweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext.applicationId)


def null_safe_text(col: str = "text") -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def byte_chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows regrouped into batches holding about ``limit`` bytes of text each (one row at least), with their texts as UTF-8 bytes."""
    held, values, size = [], [], 0

    def chunk():
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        raw, start = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()), 0
        for i in range(batch.num_rows):
            values.append(raw[i].as_py() or b"")
            size += len(values[-1])
            if size >= limit:
                held.append(batch.slice(start, i + 1 - start))
                yield chunk(), values
                held, values, size, start = [], [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if values:
        yield chunk(), values


def map_text(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` of ``fn(batches)``; ``fn`` yields dicts of columns (lists or arrays) in the order of ``schema``."""
    spark = df.sparkSession
    ship(spark)
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    names, types = arrow.names, arrow.types

    def run(batches):
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return df.mapInArrow(run, schema)


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component_id): for every vertex the smallest id reachable over the undirected ``edges`` (a, b).

    Alternating large-star and small-star steps; each is one aggregation (minimum of a vertex's
    neighbours, partial before the shuffle) and one join, and adaptive execution splits the join
    where a hub is hot. Every step is stored in the shared folder; the loop ends when a round
    leaves the edges unchanged (compared by count and an order-free checksum, two scalars).
    Vertices without edges are their own component. ``vertices`` (id) must be distinct.
    """
    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    def star(both: DataFrame) -> DataFrame:
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        return stored(low.select("a", F.least("a", "m").alias("m")))

    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .filter(F.col("a") != F.col("b")).distinct())
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = star(both)
        # large star: every larger neighbour of a vertex is tied to the smallest one of that vertex
        large = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large)
        # small star: a vertex and its smaller neighbours are tied to the smallest of them
        low = star(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.select("a", F.col("m").alias("b")))
        e = stored(small.filter(F.col("a") != F.col("b")).distinct())
        after = state(e)
        if after == before:
            break
        before = after
    return vertices.join(e.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "id"), "id", "left") \
        .select("id", F.coalesce("m", "id").alias("component_id"))
