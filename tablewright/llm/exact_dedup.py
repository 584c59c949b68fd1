"""Exact duplicates: rows grouped by a 128-bit hash of the whole text, checked byte by byte.

Hashes move, texts do not, until a hash occurs twice; of the texts of such a group the least and the greatest are then
found, each task passing on its own two, and a group is one of equal texts if they are the same. Groups are counts, minima
and maxima with map-side combining, and every join with rows of a group has one row for each group on its other side, so a
group of any size can be split between tasks.

A null text counts as empty. Rows that repeat both id and text are one document: each is reported, and
``exact_distinct`` returns one of them. A null id loses against any other and is kept only if its whole group has none.
Ids decide ties, so that there are no others. Long texts are compared whole. An empty table gives no rows. Only id and text
are read by ``exact_groups``, and ``exact_distinct`` packs rows, so that names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.shared import packed, same, text_or_empty, written


def content_hash(text: Column) -> Column:
    """128 bits of the text's bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    keep: str = "smallest",
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``keep``: ``smallest`` or ``largest`` id of equal texts. ``digest`` may be any hash: texts that collide are told
    apart by their bytes.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    rows = df.select(F.col(id_column).alias("id"), text_or_empty(text).alias("body"))
    rows = rows.withColumn("digest", digest(F.col("body")))
    slim = written(rows.select("id", "digest", F.sha2("body", 256).alias("sha")), "exact")
    grouped = F.count(F.lit(1)).alias("n"), best("id").alias("keep")
    groups = written(slim.groupBy("digest").agg(*grouped).filter("n > 1"), "exact-groups")
    # Texts whose hash occurs again are compared: all are equal if the least is the greatest. A task passes on two of them.
    ends = rows.join(groups.select("digest"), "digest").groupBy("digest").agg(F.min("body").alias("a"), F.max("body").alias("b"))
    collided = written(ends.filter("a <> b").select("digest"), "exact-collided")
    found = slim.join(groups, "digest", "left")
    if not collided.isEmpty():
        split = rows.join(collided, "digest", "left_semi")
        parts = split.groupBy("digest", "body").agg(*grouped)
        apart = split.join(parts, ["digest", "body"]).select("id", F.sha2("body", 256).alias("sha"), "n", "keep")
        whole = slim.join(collided, "digest", "left_anti").join(groups, "digest", "left")
        found = whole.select("id", "sha", "n", "keep").unionByName(apart)
    alone = F.col("n").isNull()
    keep_id = F.when(alone, F.col("id")).otherwise(F.col("keep"))
    return found.select(
        F.col("id").alias(id_column),
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def exact_distinct(df: DataFrame, id_column: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    groups = written(exact_groups(df, id_column, text, keep), "exact-rows")
    rows = packed(df, id=F.col(id_column), sha=F.sha2(text_or_empty(text), 256))
    here, there = [F.col("id"), F.col("sha")], [F.col("other_id"), F.col("other_sha")]
    groups = groups.select(F.col(id_column).alias("other_id"), F.col("text_sha256").alias("other_sha"), "kept")
    gone = groups.filter("not kept").drop("kept").distinct()
    stays = rows.join(gone, same(here, there), "left_anti")
    twice = groups.filter("kept").groupBy("other_id", "other_sha").count().filter("count > 1").drop("count")
    twice = written(twice, "exact-twice")
    once = stays.join(twice, same(here, there), "left_anti")
    one_of = stays.join(twice, same(here, there), "left_semi").dropDuplicates(["id", "sha"])
    return once.unionByName(one_of).select("row.*")
