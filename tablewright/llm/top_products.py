"""The rows of greatest inner product for each of a set of query rows, exactly, by norm-sorted search.

Components are scaled and floored to whole numbers, and scores are their exact inner products. Vectors are sorted by
falling length over the cluster and cut into groups of about ``GROUP``; a query visits only groups whose longest vector
could reach its bound, |q| |x| >= bound (Cauchy-Schwarz). In a group, vectors come in tiles by falling length, and a
query leaves at the first tile that is too short for it. Inside a tile, vectors and queries are rotated to the principal
axes of the whole table (eigenvectors of its second moments, that is the right singular vectors of the table), so that
the first components carry most of a product: a pair goes on only if the partial sum plus the product of the two
residual lengths reaches the bound. Pairs that are left get the whole product, in whole numbers.

A query's bound is at first its k-th best score among the longest vectors, which every query meets, and rises as better
ones are found. Bounds are compared with a margin above the rounding of doubles, so no pair is lost to it.

Tasks hold one group and a batch of queries. Queries travel to the groups they visit, in rows; vectors travel once. The
rotation has a row for each pair of components, whatever the number of vectors.

Vectors that are null, hold null or non-finite components, or whose scaled length is 2 ** 31 or more (their products
would not fit) take no part; an empty one scores 0. Vectors of different sizes are not compared. A query's own id is no
candidate, whatever rows bear it; other repeated rows are candidates each, in any order among themselves. Query rows that
repeat id and vector count once; those that repeat the id alone are ranked apart. Null ids are no queries, and as candidates
come last among ties. Ties go to the smaller id. With fewer candidates than asked for, all are given; an empty table gives
no rows. Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tablewright.llm.shared import workers_find_package, written

# Production parameters: scale of components, rows wanted, one in how many ids is a query; vectors of a group and a tile,
# queries worked on at a time, and the share of components in the partial sums.
SCALE, K, EVERY, GROUP, TILE, QUERIES, LEADING = 256, 5, 50, 8192, 1024, 512, 0.5
LONGEST = float(1 << 31)
EXACT = float(1 << 53)  # whole numbers below this are exact as doubles
NO_BOUND, LAST_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max
MARGIN = 1e-9


def whole_vectors(df: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """Vectors that take part, as (id, dim, v array<bigint>, length)."""
    x = F.col(f"`{vector}`").cast("array<double>")
    limit = F.lit(LONGEST / scale)
    # Also false for NaN, which is greater than every number, and null.
    sound = F.coalesce(F.forall(x, lambda c: F.coalesce((c < limit) & (c > -limit), F.lit(False))), F.lit(False))
    rows = df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), x.alias("x")).filter(sound)
    rows = rows.select("id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return rows.select("id", F.size("v").alias("dim"), "v", F.sqrt(squares).alias("length")).filter(
        F.col("length") < LONGEST
    )


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 0), dtype=np.int64)


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """By size of vectors, the principal axes of all of that size, the one of the greatest share first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column(1), part.num_rows).astype(np.float64)
                sums[dim] = sums.get(dim, 0.0) + x.T @ x
        for dim, m in sums.items():
            cells = np.arange(dim * dim)
            yield pa.RecordBatch.from_pydict({"dim": np.full(len(cells), dim, dtype=np.int32), "cell": cells, "moment": m.ravel()})

    workers_find_package(vectors)
    partial = vectors.filter("dim > 0").select("dim", "v").mapInArrow(moments, "dim int, cell bigint, moment double")
    matrices: dict[int, np.ndarray] = {}
    for r in partial.groupBy("dim", "cell").agg(F.sum("moment").alias("moment")).collect():  # a row per pair of components
        matrices.setdefault(r["dim"], np.zeros((r["dim"], r["dim"]))).flat[r["cell"]] = r["moment"]
    return {dim: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy() for dim, m in matrices.items()}


class Side:
    """Vectors or queries of one size: ids, whole numbers, lengths, and their place along the principal axes."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, length: np.ndarray, axes: np.ndarray | None):
        self.ids, self.v, self.length = ids, v, length
        rotated = v.astype(np.float64) @ axes if axes is not None else np.zeros((len(ids), 0))
        lead = int(np.ceil(rotated.shape[1] * LEADING))
        self.leading = rotated[:, :lead].copy()
        self.rest = np.sqrt((rotated[:, lead:] ** 2).sum(axis=1))

    def __getitem__(self, at: slice | np.ndarray) -> Side:
        out = object.__new__(Side)
        for name in ("ids", "v", "length", "leading", "rest"):
            setattr(out, name, getattr(self, name)[at])
        return out


def products(a: np.ndarray, b: np.ndarray, greatest: float) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b``, exactly; ``greatest`` bounds them."""
    kind = np.float64 if greatest < EXACT else object
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64) if a.shape[1] else np.zeros((len(a), len(b)), dtype=np.int64)


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` first by falling score, then id."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[place < k]


def search(vectors: Side, queries: Side, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, vector's id, score) of each query's ``k`` best of ``vectors`` (by falling length) that reach its
    bound; others may be among them only if they are as good."""
    bounds = bounds.copy()
    found = [np.zeros(0, dtype=np.int64) for _ in range(3)]
    for at in range(0, len(vectors.ids), TILE):
        tile = vectors[at : at + TILE]
        reach = queries.length * tile.length[0]
        active = np.flatnonzero(reach * (1 + MARGIN) + MARGIN >= bounds)
        if not len(active):
            break
        asking = queries[active]
        slack = MARGIN * reach[active] + MARGIN
        most = asking.leading @ tile.leading.T + asking.rest[:, None] * tile.rest[None, :]
        q, x = np.nonzero(most + slack[:, None] >= bounds[active][:, None])
        other = asking.ids[q] != tile.ids[x]
        q, x = q[other], x[other]
        # Whole products of the queries and vectors that are left in any pair.
        some_q, q_at = np.unique(q, return_inverse=True)
        some_x, x_at = np.unique(x, return_inverse=True)
        score = products(asking.v[some_q], tile.v[some_x], float(reach.max()))[q_at, x_at]
        good = score >= bounds[active][q]
        new = [active[q[good]], tile.ids[x[good]], score[good]]
        found = [np.concatenate([a, b]) for a, b in zip(found, new, strict=True)]
        keep = _best(found[0], found[2], found[1], k)
        found = [f[keep] for f in found]
        # The k-th best of queries that have as many.
        counts = np.bincount(found[0], minlength=len(bounds))
        lasts = np.cumsum(counts) - 1
        full = np.flatnonzero(counts >= k)
        bounds[full] = np.maximum(bounds[full], found[2][lasts[full]])
    return found[0], found[1], found[2]


def _met(vectors: DataFrame, queries: DataFrame, axes: dict[int, np.ndarray], k: int) -> DataFrame:
    """What queries find among the vectors of their key: (query_id, query_hash, vec_id, score), ``k`` at most for each.

    Both have (key, id, dim, v, length), queries also (query_hash, bound).
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, vectors_here = None, [], None
        for whole in batches:
            codes = np.stack([whole.column(0).to_numpy(), whole.column(1).to_numpy(), whole.column(2).to_numpy()])
            cuts = np.flatnonzero(np.any(codes[:, 1:] != codes[:, :-1], axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows], strict=True):
                if a == b:
                    continue
                if key != (codes[0, a], codes[1, a]):
                    key, held, vectors_here = (codes[0, a], codes[1, a]), [], None
                part = whole.slice(a, b - a)
                if codes[2, a] == 0:
                    held.append(part)
                    continue
                dim, turn = int(codes[1, a]), axes.get(int(codes[1, a]))
                if vectors_here is None:
                    if not held:
                        continue
                    table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    vectors_here, held = _side(table, dim, turn), []
                    order = np.argsort(-vectors_here.length, kind="stable")
                    vectors_here = vectors_here[order]
                for at in range(0, part.num_rows, QUERIES):
                    some = part.slice(at, QUERIES)
                    asking, bounds = _side(some, dim, turn), some.column(7).to_numpy()
                    q, ids, score = search(vectors_here, asking, bounds, k)
                    hashes = some.column(6).to_numpy()
                    yield pa.RecordBatch.from_pydict(
                        {"query_id": asking.ids[q], "query_hash": hashes[q], "vec_id": ids, "score": score}
                    )

    columns = ["key", "dim", "side", F.coalesce("id", F.lit(LAST_ID)).alias("id"), "v", "length", "query_hash", "bound"]
    left = vectors.withColumns({"side": F.lit(0), "query_hash": F.lit(0).cast("bigint"), "bound": F.lit(NO_BOUND)})
    both = left.select(*columns).unionAll(queries.withColumn("side", F.lit(1)).select(*columns))
    both = both.repartition("key", "dim").sortWithinPartitions("key", "dim", "side")
    workers_find_package(both)
    return both.mapInArrow(meet, "query_id bigint, query_hash bigint, vec_id bigint, score bigint")


def _side(batch: pa.RecordBatch, dim: int, axes: np.ndarray | None) -> Side:
    v = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
    return Side(batch.column(3).to_numpy(), v, batch.column(5).to_numpy(), axes)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; Spark keeps no more than these of each task before they move."""
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    every: int = EVERY,
    k: int = K,
    scale: int = SCALE,
    group: int = GROUP,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` rows of greatest product for each row whose id
    is divisible by ``every``."""
    vectors = written(whole_vectors(df, id_column, vector, scale), "product-vectors")
    rows = vectors.count()
    axes = rotations(vectors)
    # Groups by falling length; a hash parts vectors of equal length.
    order = ["dim", F.desc("length"), F.xxhash64("id", "v")]
    grouped = vectors.repartitionByRange(max(1, -(-rows // group)), *order).withColumn("key", F.spark_partition_id())
    grouped = written(grouped, "product-groups")
    ends = grouped.groupBy("dim", "key").agg(F.max("length").alias("longest"))
    groups = ends.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("key", "longest"))).alias("groups"))

    queries = vectors.filter(F.col("id") % every == 0).dropDuplicates(["id", "v"])
    queries = written(queries.withColumn("query_hash", F.xxhash64("v")), "product-queries")
    # First every query meets the longest vectors of its size, copied to as many tasks as the queries fill.
    tasks = max(1, -(-queries.count() // group))
    head = groups.select("dim", F.col("groups")[0]["key"].alias("key"))
    longest = grouped.join(F.broadcast(head), ["dim", "key"])  # one row per size of vectors
    longest = longest.withColumn("key", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    asking = queries.withColumn("key", F.pmod(F.xxhash64("id", "v"), F.lit(tasks)).cast("int"))
    first = _ranked(_met(longest, asking.withColumn("bound", F.lit(NO_BOUND)), axes, k), k)
    bounds = first.filter(F.col("rank") == k).select(
        F.col("query_id").alias("id"), "query_hash", F.col("score").alias("bound")
    )
    queries = queries.join(bounds, ["id", "query_hash"], "left")
    queries = queries.withColumn("bound", F.coalesce("bound", F.lit(NO_BOUND)))
    # One number per group and size of vectors.
    reach = F.filter("groups", lambda g: F.col("length") * g["longest"] * (1 + MARGIN) + MARGIN >= F.col("bound"))
    visits = queries.join(F.broadcast(groups), "dim").withColumn("visited", F.explode(reach))
    visits = visits.withColumn("key", F.col("visited")["key"]).drop("visited", "groups")
    best = _ranked(_met(grouped, visits, axes, k), k)
    vec_id = F.when(F.col("vec_id") != LAST_ID, F.col("vec_id")).alias("vec_id")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), vec_id, "score")
