"""Shared parts of the operators: table reading, intermediate tables in the
shared folder, and connected components."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitwise.session import ensure_checkpoint_dir

TASK_EDGES = 200_000  # edges that one task contracts

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def quoted(names: list[str]) -> list:
    """Columns by their exact names, dots included."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names (own=input name),
    so that extra input columns can never clash with working columns."""
    return df.select(*[F.col(f"`{src}`").alias(own) for own, src in columns.items()])


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join whose hot keys adaptive execution can split although one
    side comes grouped by the same keys: the join has a hash of the keys as one
    more key, so both sides get a shuffle of their own."""
    own = F.xxhash64(*keys).alias("hash_of_keys")
    return left.select("*", own).join(right.select("*", own), [*keys, "hash_of_keys"], how).drop("hash_of_keys")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is made of one at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared checkpoint folder, removed at the end of
    the program or by :func:`remove_spilled`."""
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    _written.append((spark, path))
    return path


def spill(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: lineage ends there, so a lost executor re-reads files instead of
    recomputing, and several consumers share one computation."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def remove_spilled() -> None:
    """Remove what :func:`spill` and :func:`shared_folder` wrote so far: for
    long sessions, once results are written elsewhere; frames still reading
    these tables end with it. Runs by itself at the end of the program."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p.getParent(), True)
        except Exception:  # the session has ended already: the folder is its owner's
            return


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow on (u, v): every node of the task's edges with the smallest
    node that these edges connect it to."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for u, v in zip(*(c.to_pylist() for c in batch.columns)):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
    nodes = list(root)
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(map(find, nodes), pa.int64())], names=["u", "v"])


def connected_components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node reachable.

    Tasks of at most about ``task_edges`` edges contract theirs to stars. While
    that takes several tasks, a large-star and a small-star step follow and all
    is done again, until nothing changes. A step is a map-side combined minimum
    per node and a join, whose hot nodes adaptive execution splits; no node's
    whole neighbourhood must meet in one task. Edges are written to the shared
    folder between steps. Pairs with a null end and self pairs add nothing; a
    node of no other pair may be absent from the result.
    """
    cur = spill(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")), "edges")
    before = None
    while True:
        tasks = max(1, -(-cur.count() // task_edges))
        stars = cur.coalesce(tasks).mapInArrow(_contracted, "u long, v long")
        if tasks == 1:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        stars = spill(stars.where("u <> v").distinct(), "stars")
        sym = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour moves to the smallest of the node's circle
        large = (sym.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: the same among smaller neighbours, the node included
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        cur = spill(small.distinct(), "edges")
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            nodes = cur.groupBy("u").agg(F.min("v").alias("v")).unionByName(
                cur.select(F.col("v").alias("u"), "v").distinct())
            return nodes.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
