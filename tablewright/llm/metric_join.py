"""Near-duplicate vectors: exact metric range join within labels.

On unit vectors, cosine >= c is a Euclidean distance of at most r = sqrt(2 - 2c), a metric. Within a label:

- Equal vectors are one (a class with a count), so copies are never joined with each other.
- Pivots partition the vectors of every label: of a sample by hash (about ``SAMPLE``) the one after the other that is
  farthest from those before it. Each vector has its home in the cell of its nearest pivot. If a vector's
  nearest pivot is at distance d, every vector within r of it has its home in a cell whose pivot is at most d + 2r
  away (triangle inequality), so it is also sent, as a guest, to these cells and no others. A vector thus meets all its
  neighbours in its home cell, and cells are joined independently: links are counted for residents only.
- Cells of more work than one block get pivots of their own, level after level, as long as that saves a quarter of the
  comparisons; this is counted before vectors are written. Where vectors are so spread that guests eat up the gain
  (random directions in many dimensions), a cell stays as it is. Cells are compared in blocks of at most ``BLOCK``
  residents by ``BLOCK`` members, so no task holds a cell.
- A block gives sums and a spanning forest of its links, not its pairs.

Rows whose vector is null, empty or zero, holds a null or a value that is not finite, or whose label is null, link with
nothing. Vectors of different lengths are not compared. Repeated rows are vectors of their own. A null id loses against
others. Long vectors are compared whole. An empty table gives no rows. Only id, vector and label are read, so names of other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.components import components
from tablewright.llm.shared import in_pandas, workers_find_package, written

# Pivots for a cut, vectors that they are chosen from, residents and members of a block, and the part of the comparisons that
# may be left after a further cut.
PIVOTS, SAMPLE, BLOCK, LEFT = 8, 64, 2048, 0.75


def radius(cosine: float) -> float:
    """Greatest distance of unit vectors with at least this cosine, with room for rounding: the join decides by
    cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9


def _unit(vectors: list) -> np.ndarray:
    x = np.asarray([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small numbers stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _homes(vectors: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each vector, and the pivots of all cells that may hold a neighbour's home."""
    distance = np.sqrt(np.maximum(0.0, 2 - 2 * vectors @ pivots.T))
    home = distance.argmin(axis=1)
    near = distance[np.arange(len(home)), home]
    return home, distance <= near[:, None] + 2 * reach + 1e-9


def _farthest_first(vectors: np.ndarray) -> list[int]:
    """Places of up to ``PIVOTS`` different vectors, each the farthest from those before it."""
    chosen = [0]
    nearest = 1 - vectors @ vectors[0]
    while len(chosen) < PIVOTS and nearest.max() > 1e-9:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, 1 - vectors @ vectors[chosen[-1]])
    return chosen


def _pivots(cells: DataFrame, cut: DataFrame) -> DataFrame:
    """(cell, pivots) of the cells of ``cut`` (cell, residents) that have two different vectors at least."""
    drawn = cells.join(cut.select("cell", "residents"), "cell").filter("resident")
    drawn = drawn.filter(F.pmod(F.xxhash64("node", "cell"), "residents") < SAMPLE).select("cell", "node", "vector")

    def choose(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("node")
        places = _farthest_first(_unit(list(sample["vector"])))
        return pd.DataFrame({"cell": [sample["cell"].iloc[0]], "pivots": [[sample["vector"].iloc[p].tolist() for p in places]]})

    workers_find_package(cells)
    kind = cells.schema["vector"].dataType.simpleString()
    return drawn.groupBy("cell").applyInPandas(choose, f"cell string, pivots array<{kind}>").filter(F.size("pivots") > 1)


def _dealt(batch: pd.DataFrame, reach: float) -> Iterator[tuple[str, pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """By cell its rows, and for each membership below it: the row's place, the pivot, and whether it is at home."""
    for cell, rows in batch.groupby("cell", sort=False):
        home, member = _homes(_unit(list(rows["vector"])), _unit(list(rows["pivots"].iloc[0])), reach)
        at, pivot = np.nonzero(member)
        yield cell, rows, at, pivot, rows["resident"].to_numpy()[at] & (home[at] == pivot)


def _split(cells: DataFrame, pivots: DataFrame, reach: float) -> DataFrame:
    """Each vector once for each cell below its own that it belongs to. Guests stay guests everywhere."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cell, rows, at, pivot, resident in _dealt(batch, reach):
                yield rows.iloc[at].drop(columns="pivots").assign(cell=[f"{cell}.{p}" for p in pivot], resident=resident)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema.fields)
    return in_pandas(cells.join(pivots, "cell").select(*cells.columns, "pivots"), deal, schema)


def _work_after(cells: DataFrame, pivots: DataFrame, reach: float) -> DataFrame:
    """(cell, after): the comparisons that would be left of a cell; only counts leave the tasks."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cell, _, _, pivot, resident in _dealt(batch, reach):
                members = np.bincount(pivot, minlength=PIVOTS)
                at_home = np.bincount(pivot, resident, minlength=PIVOTS).astype(np.int64)
                yield pd.DataFrame({"cell": cell, "pivot": np.arange(PIVOTS), "residents": at_home, "members": members})

    rows = cells.join(pivots, "cell").select("cell", "vector", "resident", "pivots")
    counts = in_pandas(rows, count, "cell string, pivot int, residents bigint, members bigint")
    below = counts.groupBy("cell", "pivot").agg(F.sum("residents").alias("r"), F.sum("members").alias("m"))
    return below.groupBy("cell").agg(F.sum(F.col("r").cast("double") * F.col("m")).alias("after"))


def _work(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell").agg(F.count_if("resident").alias("residents"), F.count(F.lit(1)).alias("members"))


def _partitioned(classes: DataFrame, reach: float) -> DataFrame:
    """(node, vector, copies, cell, resident): all cells, none with a useful cut left."""
    cells = classes.select(
        "node", "vector", "copies", F.concat_ws("/", "label", F.size("vector")).alias("cell"), F.lit(True).alias("resident")
    )
    done: list[DataFrame] = []
    while True:
        work = written(_work(cells), "metric-work")
        size = F.col("residents").cast("double") * F.col("members")
        # Every label is cut once, which makes no more comparisons; further cuts have to save some.
        pivots = written(_pivots(cells, work.filter(size > F.lit(float(BLOCK**2))) if done else work), "metric-pivots")
        if done:
            saving = work.join(_work_after(cells, pivots, reach), "cell").filter(F.col("after") < F.lit(LEFT) * size)
            pivots = written(pivots.join(saving.select("cell"), "cell", "left_semi"), "metric-gain")
        if pivots.isEmpty():
            break
        done.append(cells.join(pivots.select("cell"), "cell", "left_anti"))
        cells = written(_split(cells, pivots, reach), "metric-cells")
    for rest in done:
        cells = cells.unionByName(rest)
    return cells


def _forest(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Edges that connect what the links connect: each row of the matrix with the least node of its tree."""
    nodes, where = np.unique(np.concatenate([rows, columns]), return_inverse=True)
    at_row, at_column = where[: len(rows)], where[len(rows) :]
    label = np.arange(len(nodes))
    far = len(nodes)
    while True:
        before = label.copy()
        np.minimum.at(label, at_row, np.where(linked, label[at_column][None, :], far).min(axis=1, initial=far))
        np.minimum.at(label, at_column, np.where(linked, label[at_row][:, None], far).min(axis=0, initial=far))
        label = np.minimum(label, label[label])
        if (label == before).all():
            break
    edge = label != np.arange(len(nodes))
    return np.stack([nodes[edge], nodes[label[edge]]], axis=1)


def _links(cells: DataFrame, cosine: float) -> DataFrame:
    """Rows (node, links, null) and (node, null, other): sums by resident, and forest edges."""
    sizes = _work(cells).select(
        "cell",
        F.ceil(F.col("residents") / BLOCK).cast("bigint").alias("down"),
        F.ceil(F.col("members") / BLOCK).cast("bigint").alias("across"),
    )
    cut = cells.join(written(sizes, "metric-sizes").filter("down > 0"), "cell")
    kept = ["node", "vector", "copies", "cell"]
    one = cut.filter("resident").select(
        *kept, F.lit(0).alias("side"), F.pmod(F.xxhash64("node"), "down").alias("d"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("across") - 1)).alias("a"),
    )
    two = cut.select(
        *kept, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("down") - 1)).alias("d"),
        F.pmod(F.xxhash64(F.lit(1), "node"), "across").alias("a"),
    )

    def join(block: pd.DataFrame) -> pd.DataFrame:
        x, y = block[block["side"] == 0], block[block["side"] == 1]
        if not len(x) or not len(y):
            return pd.DataFrame({"node": [], "links": [], "other": []})
        a, b = x["node"].to_numpy(), y["node"].to_numpy()
        linked = _unit(list(x["vector"])) @ _unit(list(y["vector"])).T >= cosine
        linked &= a[:, None] != b[None, :]
        sums = linked @ y["copies"].to_numpy(dtype=np.int64)
        edges = _forest(linked, a, b)
        found = pd.DataFrame({"node": a, "links": sums, "other": None})[sums > 0]
        return pd.concat([found, pd.DataFrame({"node": edges[:, 0], "links": None, "other": edges[:, 1]})])

    workers_find_package(cells)
    return one.unionByName(two).groupBy("cell", "d", "a").applyInPandas(join, "node bigint, links bigint, other bigint")


def vector_groups(
    df: DataFrame, cosine: float = 0.93, id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id`` (smallest id reachable by links, itself
    included) and ``kept`` (it is that id)."""
    reach = radius(cosine)
    rows = df.select(F.col(id_column).alias("id"), F.col(vector).alias("vector"), F.col(label).cast("string").alias("label"))
    # Nulls, infinities and NaN drop out of the exists; so do null and empty arrays.
    sound = F.col("label").isNotNull() & (F.size("vector") > 0)
    sound &= ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound &= F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    same = rows.filter("sound").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = written(same.withColumn("node", F.monotonically_increasing_id()), "metric-classes")
    found = written(_links(_partitioned(classes, reach), cosine), "metric-links")
    links = found.filter("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    trees = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = classes.join(trees, "node").select("node", "component", "least")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("node", "component_id")
    facts = classes.join(links, "node", "left").join(known, "node", "left").select(
        F.col("label").alias("l"),
        F.col("vector").alias("v"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    facts = written(facts, "metric-facts")
    joined = rows.join(facts, F.col("sound") & (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
