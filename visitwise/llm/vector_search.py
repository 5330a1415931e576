"""Exact top-k by inner product with a KD-tree per shard.

A sample's median splits cut space into cells; every vector is dealt to its
cell, and a cell of more than ``shard_rows`` vectors into several shards by a
hash of the id. In a shard, median splits along the widest side give leaves of a
few hundred points, and every node keeps its tight bounding box. For a box
[lo, hi] no point in it can score above ``sum(max(q * lo, q * hi))``, so a query
visits nodes best bound first and stops when the best bound is below its k-th
score so far.

The same bound chooses shards. Every cell's tight box, taken over all its
vectors, stands in a small table (``BOX_NUMBERS`` numbers at most, so it travels
with the tasks). A query first goes to its home, a shard of the cell with the
best bound. The k-th score that it reaches there is a lower bound of the final
one: it goes along, and only to shards of cells whose bound reaches it. How many
that are depends on the vectors: with clusters few, with directions spread evenly
over many dimensions almost all, as no box excludes them.

A query travels once to every shard that it visits. A shard's vectors travel
once, and once more for every ``query_block`` queries it is asked, so a shard
that very many queries visit is searched by several tasks. Shards that nobody
asks are not shuffled.

Equal vectors score alike, so of each different vector only the k + 1 smallest
ids can be in any answer (one may be the query itself): the rest are left out
before the shards are dealt, by a map-side combined aggregate. Queries with equal
vectors are searched once, for the k + 1 best; each then leaves itself out. Both
are exact and keep a vector that a third of all rows repeat from filling one
shard or one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import only, spill, split_join

SHARD_ROWS = 8_000
QUERY_BLOCK = 20_000
LEAF = 256
SAMPLE_NUMBERS = 2 ** 21  # components in the sample that sets the cells
BOX_NUMBERS = 2 ** 18  # components in the boxes of all cells
NO_SCORE = -2 ** 63


def _upper(queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(queries x boxes): the highest score a point of the box can have."""
    return np.maximum(queries, 0) @ hi.T + np.minimum(queries, 0) @ lo.T


class KdTree:
    """Points (n x d, whole numbers as float64 or int64) with ids, split at medians."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids = points, ids
        order = np.arange(len(points))
        self.members: list[np.ndarray | None] = []
        self.children: list[tuple[int, int] | None] = []
        lows, highs = [], []
        todo = [(order, -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node = len(self.members)
            if parent >= 0:
                self.children[parent][side] = node
            part = points[rows]
            lo, hi = part.min(axis=0), part.max(axis=0)
            lows.append(lo)
            highs.append(hi)
            axis = int(np.argmax(hi - lo))
            if len(rows) <= leaf or hi[axis] == lo[axis]:
                self.members.append(rows)
                self.children.append(None)
                continue
            half = len(rows) // 2
            cut = np.argpartition(part[:, axis], half)
            self.members.append(None)
            self.children.append([-1, -1])
            todo += [(rows[cut[half:]], node, 1), (rows[cut[:half]], node, 0)]
        self.lo, self.hi = np.array(lows), np.array(highs)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries x nodes): the highest score a point of the node can have."""
        return _upper(queries, self.lo, self.hi)

    def search(self, query: np.ndarray, bound: np.ndarray, k: int, least: int) -> list[tuple]:
        """The k best (score, id), higher score first, ties to the smaller id, an
        id once with its best score; nothing below ``least`` is needed."""
        best: list[tuple] = []  # a heap with the worst answer on top: (score, -id)
        held: dict[int, float] = {}  # the ids in it
        open_nodes = [(-bound[0], 0)]
        while open_nodes:
            most, node = heapq.heappop(open_nodes)
            if -most < least or len(best) == k and -most < best[0][0]:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(open_nodes, (-bound[child], child))
                continue
            rows = self.members[node]
            scores = self.points[rows] @ query
            floor = max(least, best[0][0]) if len(best) == k else least
            for i in np.nonzero(scores >= floor)[0]:
                score, point = scores[i], int(self.ids[rows[i]])
                if point in held:
                    if held[point] >= score:
                        continue
                    best.remove((held.pop(point), -point))
                    heapq.heapify(best)
                if len(best) < k:
                    heapq.heappush(best, (score, -point))
                elif (score, -point) > best[0]:
                    held.pop(-heapq.heapreplace(best, (score, -point))[1])
                else:
                    continue
                held[point] = score
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


class Cells:
    """``2 ** levels`` cells from median splits of a sample along its widest sides."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels = levels
        self.axis = np.zeros(2 ** levels - 1, np.int64)
        self.cut = np.zeros(2 ** levels - 1, np.int64)
        parts = [sample]
        for node in range(2 ** levels - 1):  # children of node n: 2n + 1, 2n + 2
            part = parts[node]
            if len(part):
                self.axis[node] = np.argmax(part.max(axis=0) - part.min(axis=0))
                side = part[:, self.axis[node]]
                self.cut[node] = np.partition(side, (len(side) - 1) // 2)[(len(side) - 1) // 2]
            low = part[:, self.axis[node]] <= self.cut[node]
            parts += [part[low], part[~low]]
            parts[node] = None

    def of(self, points: np.ndarray) -> np.ndarray:
        node, row = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range(self.levels):
            node = 2 * node + 1 + (points[row, self.axis[node]] > self.cut[node])
        return node - len(self.axis)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _deal(cells: Cells, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(cell=cells.of(_matrix(batch["v"], width)))
    return run


def _task_boxes(width: int):
    """Each cell's box over the task's vectors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        boxes: dict[int, tuple] = {}
        for batch in batches:
            points, cell = _matrix(batch["v"], width), batch["cell"].to_numpy()
            for c in np.unique(cell):
                part = points[cell == c]
                n, lo, hi = boxes.get(c, (0, part[0], part[0]))
                boxes[c] = n + len(part), np.minimum(lo, part.min(axis=0)), np.maximum(hi, part.max(axis=0))
        yield pd.DataFrame([(c, *b) for c, b in boxes.items()], columns=["cell", "n", "lo", "hi"])
    return run


def _cell_box(key: tuple, boxes: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"cell": [key[0]], "n": [boxes["n"].sum()], "lo": [np.min(np.stack(boxes["lo"]), axis=0)],
                         "hi": [np.max(np.stack(boxes["hi"]), axis=0)]})


def _route(numbers: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: bool):
    """mapInPandas on (rep, v, least): the cells to ask, of ``first`` the best only.

    The bound is taken in float64 with room for its rounding, so a cell is left
    out only if no vector in it can reach ``least``."""
    low, high, size = lo.astype(float), hi.astype(float), np.maximum(np.abs(lo), np.abs(hi)).astype(float)
    room = 2.0 ** -50 * max(1, lo.shape[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = _matrix(batch["v"], lo.shape[1]).astype(float)
            most = _upper(q, low, high) + room * (np.abs(q) @ size.T)
            if first:
                asked = [[c] for c in numbers[most.argmax(axis=1)]] if len(batch) else []
            else:
                least = batch["least"].to_numpy().astype(float)
                reach = most >= (least - np.abs(least) * 2.0 ** -50)[:, None]
                asked = [numbers[r] for r in reach]
            yield batch.assign(cells=pd.Series(asked, index=batch.index, dtype=object))
    return run


def _search(k: int):
    def run(key: tuple, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(points) and len(queries):
            width = max(points["v"].map(len).max(), queries["v"].map(len).max())
            p, q = _matrix(points["v"], width), _matrix(queries["v"], width)
            # float64 products are exact below 2^53 and much faster
            if float(np.abs(p).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1) < 2.0 ** 53:
                p, q = p.astype(np.float64), q.astype(np.float64)
            tree = KdTree(p, points["id"].to_numpy())
            for at in range(0, len(q), 1024):
                bound = tree.bounds(q[at:at + 1024])
                for row, rep, least, b in zip(q[at:], queries["rep"][at:], queries["least"][at:], bound):
                    found += [(rep, r, i, int(s)) for r, (s, i) in enumerate(tree.search(row, b, k, least), 1)]
        return pd.DataFrame(found, columns=["rep", "place", "id", "score"]).astype("int64")
    return run


def top_k_inner_product(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
                        vector_col: str = "vector", shard_rows: int = SHARD_ROWS,
                        query_block: int = QUERY_BLOCK) -> DataFrame:
    """For each row of ``queries`` the ``k`` rows of ``vectors`` (arrays of
    whole numbers, type long) with the highest inner products: ``query_id``,
    ``rank`` (from 1), ``id``, ``score``.

    A query's own id is no candidate. Ties go to the smaller id. Null vectors,
    vectors with a null component and rows without an id take no part; of two
    vectors of different lengths the shorter counts as filled with zeros. Rows
    that repeat an id and a vector count once; an id with several vectors
    answers with its best one. Empty tables give no rows. Scores must fit into
    64 bits. The cells are set on a sample of ``SAMPLE_NUMBERS`` components;
    their boxes and all searches cover every vector.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return (only(df, id=id_col, v=vector_col)
                .where("id is not null and v is not null and not exists(v, x -> x is null)"))

    # queries of equal vectors are one, named by the smallest id
    wanted = spill(clean(queries).distinct(), "queries")
    asked = spill(wanted.groupBy("v").agg(F.min("id").alias("rep")), "asked")
    askers = split_join(wanted, asked, ["v"]).select(F.col("id").alias("query_id"), "rep")
    # the k + 1 smallest ids of every different vector
    place = Window.partitionBy("v", "part").orderBy("id")
    again = Window.partitionBy("v").orderBy("id")
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    kept = (clean(vectors).distinct().withColumn("part", part)
            .withColumn("r", F.row_number().over(place)).where(F.col("r") <= k + 1)
            .withColumn("r", F.row_number().over(again)).where(F.col("r") <= k + 1).select("id", "v"))
    points = spill(kept, "points")
    count, width = points.agg(F.count("*"), F.max(F.size("v"))).first()
    asked_width = asked.agg(F.max(F.size("v"))).first()[0]
    if not count or asked_width is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    width = max(width, asked_width, 1)

    rows = max(1, min(count, SAMPLE_NUMBERS // width))
    most = max(1, min(-(-count // shard_rows), BOX_NUMBERS // (2 * width), rows // 8))
    levels = (most - 1).bit_length()
    sample = points.orderBy(F.xxhash64("id"), "id").limit(rows).toPandas()["v"] if levels else pd.Series([], dtype=object)
    cells = Cells(_matrix(sample, width), levels)
    celled = spill(points.mapInPandas(_deal(cells, width), "id long, v array<long>, cell long"), "celled")
    boxes = sorted(celled.mapInPandas(_task_boxes(width), "cell long, n long, lo array<long>, hi array<long>")
                   .groupBy("cell").applyInPandas(_cell_box, "cell long, n long, lo array<long>, hi array<long>").collect())
    numbers = np.array([b["cell"] for b in boxes])
    lo, hi = np.array([b["lo"] for b in boxes]), np.array([b["hi"] for b in boxes])
    # a row a cell, as many as there are boxes
    pieces = F.broadcast(spark.createDataFrame([(b["cell"], -(-b["n"] // shard_rows)) for b in boxes],
                                               "cell long, pieces long"))
    dealt = celled.join(pieces, "cell").select("id", "v", "cell", F.pmod(F.xxhash64("id"), "pieces").alias("piece"))

    def routed(q: DataFrame, first: bool) -> DataFrame:
        """q: rep, v, least -> a row for every shard to ask; of ``first`` one of the best cell."""
        sent = (q.mapInPandas(_route(numbers, lo, hi, first), "rep long, v array<long>, least long, cells array<long>")
                .withColumn("cell", F.explode("cells")).drop("cells").join(pieces, "cell"))
        home = F.pmod(F.xxhash64("rep"), "pieces")
        if first:
            return sent.withColumn("piece", home).drop("pieces")
        return (sent.withColumn("home_piece", home)
                .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).drop("pieces"))

    def search(q: DataFrame) -> DataFrame:
        """Answers of the asked shards; the vectors of a shard once for each block of its queries."""
        blocks = (q.groupBy("cell", "piece").count()
                  .select("cell", "piece", F.ceil(F.col("count") / query_block).alias("blocks")))
        of_block = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
        searched = dealt.join(blocks, ["cell", "piece"]).withColumn("block", F.explode(of_block))
        asking = q.join(blocks, ["cell", "piece"]).withColumn("block", F.pmod(F.xxhash64(F.lit(7), "rep"), "blocks"))
        key = ["cell", "piece", "block"]
        return (searched.select("id", "v", *key).groupBy(*key)
                .cogroup(asking.select("rep", "v", "least", *key).groupBy(*key))
                .applyInPandas(_search(k + 1), "rep long, place long, id long, score long"))

    none = asked.select("rep", "v", F.lit(NO_SCORE).alias("least"))
    first = spill(routed(none, True), "first")
    home = spill(search(first), "home")
    reached = home.where(F.col("place") == k + 1).select("rep", F.col("score").alias("least"))
    next_to = (asked.join(reached, "rep", "left")
               .select("rep", "v", F.coalesce("least", F.lit(NO_SCORE)).alias("least")))
    been = first.select("rep", F.col("cell").alias("home_cell"))
    rest = spill(routed(next_to, False).join(been, "rep")
                 .where("not (cell = home_cell and piece = home_piece)").drop("home_cell", "home_piece"), "rest")
    found = home.unionByName(search(rest)).groupBy("rep", "id").agg(F.max("score").alias("score"))

    def best(df: DataFrame, of: str, rows: int) -> DataFrame:
        w = Window.partitionBy(of).orderBy(F.desc("score"), "id")
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= rows)

    answers = split_join(best(found, "rep", k + 1).drop("rank"), askers, ["rep"]).where("id <> query_id")
    once = answers.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return best(once, "query_id", k).select("query_id", "rank", "id", "score")


def quantised(vectors: DataFrame, vector_col: str, scale: int = 64) -> DataFrame:
    """``vector_col`` as whole numbers floor(scale * x), x as double; null where
    the vector is null or holds a null or non-finite component."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vectors.withColumn(vector_col, F.when(sound, F.transform(
        x, lambda v: F.floor(v * F.lit(float(scale))))))
