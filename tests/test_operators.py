"""Joins, changes, grouped filters, reshaping and sources on small fixtures."""

import random
import uuid
from collections import Counter
from pathlib import Path

import pytest
from compare import rows
from pyspark.sql import functions as F, types as T

from tablewright.operators import aggregates, changes, columns, grouped, joins, reshape
from tablewright.session import scratch_path, shared_dir
from tablewright.sources import delimited, keyed, records, snapshots


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(1, "a", 10), (None, "b", 20), (3, "c", None)], "k int, n string, v int")


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([(1, 11), (1, 12), (None, 21), (9, 91)], "k int, v int")


def test_null_safe_joins(left, right):
    joined = [(1, "a", 10, 11), (1, "a", 10, 12), (None, "b", 20, 21)]
    assert rows(joins.inner_join(left, right, ["k"])) == sorted(joined, key=repr)
    with_left = joined + [(3, "c", None, None)]
    assert rows(joins.left_join(left, right, ["k"])) == sorted(with_left, key=repr)
    full = with_left + [(9, None, None, 91)]
    out = joins.full_join(left, right, ["k"])
    assert out.columns == ["k", "n", "v.x", "v.y"]
    assert rows(out) == sorted(full, key=repr)
    assert rows(joins.semi_join(left, right, ["k"]).select("n")) == [("a",), ("b",)]
    assert rows(joins.anti_join(left, right, ["k"]).select("n")) == [("c",)]


def test_plain_and_composed_joins_agree(left, right):
    for join in (joins.left_join, joins.full_join, joins.coalesce_join):
        assert rows(join(left, right, ["k"])) == rows(join(left, right, ["k"], hot_right=True))


def test_keys_with_earlier(spark):
    x = spark.createDataFrame([(1, 5), (1, 2), (2, 9), (None, 1)], "k int, y int")
    y = spark.createDataFrame([(1, 3), (1, 8), (None, 1)], "k int, z int")
    assert rows(joins.keys_with_earlier(x, y, ["k"], "y", "z")) == sorted([(1, 5), (None, 1)], key=repr)


def test_coalesce_join(left, right):
    out = joins.coalesce_join(left, right.filter("v <> 12").withColumn("w", F.lit("w")), ["k"])
    assert out.columns == ["k", "n", "v", "w"]
    assert rows(out) == sorted(
        [(1, "a", 10, "w"), (None, "b", 20, "w"), (3, "c", None, None), (9, None, 91, "w")], key=repr
    )


def test_coalesce_join_reads_differing_types_as_text(spark, left):
    other = spark.createDataFrame([(3, "NE")], "k int, v string")
    out = joins.coalesce_join(left, other, ["k"], how="left")
    assert rows(out.select("v")) == [("10",), ("20",), ("NE",)]


def test_self_join_is_not_ambiguous(left):
    out = joins.left_join(left, left.filter("k = 1"), ["k"])
    assert rows(out.select("`n.y`")) == sorted([("a",), (None,), (None,)], key=repr)


def test_names_with_dots(spark):
    x = spark.createDataFrame([(1, None), (2, 5.0)], "`id.x` int, `X1.1_iucn_scope` double")
    y = spark.createDataFrame([(1, 3.0)], "`id.x` int, `X1.1_iucn_scope` double")
    assert rows(joins.coalesce_join(x, y, ["id.x"])) == [(1, 3.0), (2, 5.0)]
    assert rows(changes.rows_patch(x, y, ["id.x"])) == [(1, 3.0), (2, 5.0)]


def test_rows_update_and_patch(spark, left):
    batch = spark.createDataFrame([(1, None), (None, 99)], "k int, v int")
    assert rows(changes.rows_update(left, batch, ["k"])) == sorted(
        [(1, "a", None), (None, "b", 99), (3, "c", None)], key=repr
    )
    batch = spark.createDataFrame([(1, 5), (3, 6)], "k int, v int")
    assert rows(changes.rows_patch(left, batch, ["k"])) == sorted([(1, "a", 10), (None, "b", 20), (3, "c", 6)], key=repr)


def test_change_checks(spark, left):
    twice = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    with pytest.raises(Exception, match="not unique, e.g. 1"):
        changes.rows_update(left, twice, ["k"]).collect()
    unknown = spark.createDataFrame([(77, 1)], "k int, v int")
    with pytest.raises(Exception, match="not in the table, e.g. 77"):
        changes.rows_patch(left, unknown, ["k"]).collect()
    with pytest.raises(Exception, match="not in the table, e.g. 77"):
        changes.rows_delete(left, unknown, ["k"]).collect()
    with pytest.raises(Exception, match="not unique"):
        changes.rows_insert(left, spark.createDataFrame([(8, 1), (8, 2)], "k int, v int"), ["k"]).collect()
    assert changes.rows_update(left, unknown, ["k"], unmatched="ignore").count() == 3
    with pytest.raises(ValueError, match="the table lacks"):
        changes.rows_update(left, unknown.withColumn("z", F.lit(1)), ["k"])
    with pytest.raises(Exception, match="already in the table, e.g. null"):
        changes.rows_insert(left, spark.createDataFrame([(None, 1)], "k int, v int"), ["k"]).collect()
    assert changes.rows_insert(left, twice, ["k"], conflict="ignore").count() == 3


def test_insert_and_delete(spark, left):
    assert rows(changes.rows_insert(left, spark.createDataFrame([(7, 1)], "k int, v int"), ["k"])) == sorted(
        [(1, "a", 10), (None, "b", 20), (3, "c", None), (7, None, 1)], key=repr
    )
    gone = spark.createDataFrame([(None, "x")], "k int, other string")
    assert rows(changes.rows_delete(left, gone, ["k"]).select("n")) == [("a",), ("c",)]


def test_route_changes(spark):
    table = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", None), (3, "c", "z"), (4, "d", "w"), (5, "e", None)], "k int, n string, endemic_NA string"
    )
    batch = spark.createDataFrame(
        [
            (1, "yes", None, "q", ""),
            (2, "no", "B", "", "endemic_NA, Level 1 threats"),
            (3, "to remove", None, None, ""),
            (3, "yes", "never", None, ""),
            (4, "", "D", "D", "n"),
            (5, "new data already extracted", None, "r", ""),
        ],
        "k int, change_made string, n string, endemic_NA string, miss_all string",
    )
    out = changes.route_changes(table, batch, ["k"])
    assert rows(out) == sorted(
        [(1, None, "q"), (2, "B", "NE"), (4, "d", "w"), (5, None, "r")], key=repr
    )
    again = batch.filter("k = 1").unionByName(batch.filter("k = 1"))
    with pytest.raises(Exception, match="not unique"):
        changes.route_changes(table, again, ["k"]).collect()
    with pytest.raises(Exception, match="not in the table, e.g. 9"):
        changes.route_changes(table, batch.filter("k = 1").withColumn("k", F.lit(9)), ["k"]).collect()


def test_building_changes_runs_no_job(spark, left):
    batch = spark.createDataFrame([(1, 5)], "k int, v int")
    spark.sparkContext.setJobGroup("building", "plans only")
    changes.rows_update(left, batch, ["k"])
    changes.rows_patch(left, batch, ["k"])
    changes.rows_insert(left, batch, ["k"])
    changes.rows_delete(left, batch, ["k"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext._jsc.clearJobGroup()


def test_latest_in_group(spark):
    df = spark.createDataFrame(
        [("a", 2001), ("a", 2003), ("a", 2003), ("b", 2001), ("b", None), (None, 5)], "g string, y int"
    )
    assert rows(grouped.latest_in_group(df, ["g"], "y")) == sorted([("a", 2003), ("a", 2003), (None, 5)], key=repr)
    assert grouped.latest_in_group(df, ["g"], "y", strict=False).count() == 4


def test_group_filters(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", None), ("b", "x"), ("b", "p"), ("c", "x"), (None, "x"), ("d", "NA"), ("d", "NR")],
        "g string, v string",
    )
    without = grouped.group_without(df, ["g"], F.col("v") == "p")
    assert rows(without.select("g").distinct()) == sorted([("c",), ("d",), (None,)], key=repr)
    not_all = grouped.group_not_all(df, ["g"], "v", ["NA", "NR"])
    assert rows(not_all.select("g").distinct()) == sorted([("a",), ("b",), ("c",), (None,)], key=repr)


def test_superseded_filter(spark):
    df = spark.createDataFrame(
        [(1, "a", True), (2, "a", False), (3, "b", True), (4, "c", None), (5, "c", False), (6, "d", None), (7, None, True), (8, None, False)],
        "id int, g string, old boolean",
    )
    assert rows(grouped.superseded_filter(df, ["g"], F.col("old")).select("id")) == [(2,), (3,), (5,), (6,), (8,)]


def test_sequence_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"))
    out = grouped.sequence_ids(df, ["k"], "row_id", 500)
    assert [tuple(r) for r in out.orderBy("k").select("k", "row_id").collect()] == [(i, 500 + i) for i in range(1000)]
    within = grouped.sequence_ids(df, ["k"], "row_id", 1, within=["g"], rows_per_range=100)
    per_group = within.groupBy("g").agg(F.min("row_id"), F.max("row_id"), F.countDistinct("row_id"), F.count("*"))
    assert all(r[1] == 1 and r[2] == r[3] == r[4] for r in per_group.collect())
    assert grouped.next_id(df, "k") == 1000
    hot = df.withColumn("k", F.when(F.col("k") % 3 == 0, 1).otherwise(F.col("k")))
    with pytest.raises(ValueError, match="does not identify a row: one value is held by 335 rows"):
        grouped.sequence_ids(hot, ["k"], "row_id")


def test_distinct_keep_first(spark):
    df = spark.createDataFrame([(1, 5, "e"), (1, 4, "d"), (2, 1, None), (None, 3, "n"), (None, 2, "m")], "k int, o int, v string")
    assert rows(grouped.distinct_keep_first(df, ["k"], ["o"])) == sorted([(1, 4, "d"), (2, 1, None), (None, 2, "m")], key=repr)
    assert rows(grouped.distinct_keep_first(df, ["k"], ["o"], last=True)) == sorted(
        [(1, 5, "e"), (2, 1, None), (None, 3, "n")], key=repr
    )


def test_aggregates(spark):
    df = spark.createDataFrame([(1, "a, b"), (1, None), (None, "b")], "k int, v string")
    assert rows(aggregates.duplicate_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(Exception, match="the table are not unique, e.g. 1"):
        aggregates.unique_or_error(df, ["k"]).collect()
    assert rows(aggregates.unique_or_error(df, ["k", "v"])) == rows(df)
    assert aggregates.n_distinct(df, ["k"]).first()[0] == 2
    assert rows(aggregates.distinct_values(df, "v", ", ")) == sorted([("a",), ("b",), (None,)], key=repr)
    assert rows(aggregates.null_counts(df, ["k", "v"], F.col("k") == 1)) == [("v", 1)]


def test_string_agg(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (1, "b", 3), (None, "c", 1), (2, None, 1)], "k int, v string, o int")
    kept = aggregates.string_agg(df, ["k"], "v", order_by=["o"])
    assert rows(kept) == sorted([(1, "x, x, b"), (None, "c"), (2, "NA")], key=repr)
    once = aggregates.string_agg(df, ["k"], "v", "' ", distinct=True, null_text=None)
    assert rows(once) == sorted([(1, "b' x"), (None, "c"), (2, "")], key=repr)


def test_pivot_keeps_nulls_and_fills_absent_cells(spark):
    df = spark.createDataFrame(
        [("x", "1", None, "c"), ("x", "1.1", 2.0, None), ("y", "1", 1.0, "d"), ("z", None, 1.0, "e")],
        "id string, num string, flag double, note string",
    )
    out = reshape.pivot_wider(
        df, ["id"], "num", ["1", "1.1"], {"flag": F.max("flag"), "note": F.max("note")}, {"flag": 0.0}
    )
    assert out.columns == ["id", "1_flag", "1.1_flag", "1_note", "1.1_note"]
    assert rows(out) == [
        ("x", None, 2.0, "c", None),
        ("y", 1.0, 0.0, "d", None),
        ("z", 0.0, 0.0, None, None),
    ]
    more = df.unionByName(df.withColumn("num", F.lit("77")))
    with pytest.raises(Exception, match="not in the vocabulary: 77"):
        reshape.pivot_wider(more, ["id"], "num", ["1", "1.1"], {"flag": F.max("flag")}).collect()
    assert rows(reshape.unknown_names(more, "num", ["1", "1.1"])) == [("77", 4)]


def test_lists_and_rows(spark):
    df = spark.createDataFrame([(1, "a, b"), (2, None)], "k int, v string")
    assert rows(reshape.separate_rows(df, "v")) == sorted([(1, "a"), (1, "b"), (2, None)], key=repr)
    pairs = spark.createDataFrame([("a: b: c",), ("d",), (None,)], "v string")
    assert rows(reshape.separate(pairs, "v", ["code", "definition"])) == sorted(
        [("a", "b"), ("d", None), (None, None)], key=repr
    )
    assert rows(reshape.unite(df, "u", ["k", "v"])) == [("1, a, b",), ("2, NA",)]


def test_nest_splits_large_groups_without_loss(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, "hot").otherwise("cold").alias("g"),
        F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("v"),
    )
    out = reshape.nest(df, ["g"], ["v"], rows_per_list=50).collect()
    assert max(len(r["data"]) for r in out) == 50
    held = Counter((r["g"], item["v"]) for r in out for item in r["data"])
    assert held == Counter((r["g"], r["v"]) for r in df.collect())
    assert sorted((r["g"], r["list_no"]) for r in out) == [("cold", i) for i in range(2)] + [("hot", i) for i in range(18)]
    assert [len(r["data"]) for r in reshape.nest(df, ["g"], ["v"]).collect() if r["g"] == "hot"] == [900]


def test_source_diff(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (None, "y", None)], "k int, s string, d double")
    b = spark.createDataFrame([(1, "x", 2.0), (None, "z", 3.0)], "k int, s string, d double")
    assert rows(reshape.source_diff(a, b, ["k"])) == sorted([(1, "d", "1.0", "2.0"), (None, "s", "y", "z")], key=repr)


def test_families(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, 1.0, 2.0)], "id int, `X1.1_a` double, X2_a double")
    assert rows(columns.keep_if_any(df, "^X").select("id")) == [(2,), (3,)]
    assert rows(columns.keep_if_all(df, "^X").select("id")) == [(3,)]


def test_hot_keys(spark):
    """A third of all rows on one key, and a third on the null key; joins forced to shuffle and split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 60000
        key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 100)
        x = spark.range(0, n, 1, 6).select(key.alias("k"), "id", (F.col("id") % 11).alias("y"))
        local = [(None if i % 3 == 2 else 7 if i % 3 == 0 else i % 100, i, i % 11) for i in range(n)]
        small = spark.createDataFrame([(k, k or -1) for k in [*range(50), None]], "k int, v int")
        in_small = {k for k in [*range(50), None]}
        assert joins.left_join(x, small, ["k"]).agg(F.count("*"), F.count("v")).first()[:] == (
            n, sum(k in in_small for k, _, _ in local)
        )
        assert joins.full_join(small, x, ["k"], hot_right=True).filter("id is not null").count() == n
        hot = joins.left_join(small, x, ["k"], hot_right=True)
        assert hot.filter("id is not null").count() == sum(k in in_small for k, _, _ in local)
        best: dict = {}
        for k, _, y in local:
            best[k] = max(best.get(k, 0), y)
        assert grouped.latest_in_group(x, ["k"], "y").count() == sum(y == best[k] for k, _, y in local)
        updated = changes.rows_update(x, small.withColumnRenamed("v", "y"), ["k"], unmatched="ignore")
        assert updated.agg(F.sum("y")).first()[0] == sum((k or -1) if k in in_small else y for k, _, y in local)
        assert grouped.distinct_keep_first(x, ["k"], ["id"]).count() == len(best)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_csv_round_trip(spark):
    path = scratch_path(spark, "round-trip")
    values = [(1, 'two\nlines, "quoted"', " padded "), (2, None, "é"), (3, "", "a\\b")]
    df = spark.createDataFrame(values, "rowID int, t string, u string")
    delimited.write_csv(df, path)
    schema = T.StructType([T.StructField("rowID", T.IntegerType()), T.StructField("t", T.StringType()), T.StructField("u", T.StringType())])
    assert rows(delimited.read_csv(spark, path, schema, multi_line=True)) == sorted(values, key=repr)
    inferred = delimited.read_csv(spark, path, multi_line=True)
    assert dict(inferred.dtypes) == {"rowID": "double", "t": "string", "u": "string"}
    with pytest.raises(Exception, match="already exists"):
        delimited.write_csv(df, path)


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_records_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(3)
    pieces = ["a", "é", " ", "\n", "\r\n", ",", '""', "\n\n", "NA", "x" * 90, "\n" * 70]
    folder = tmp_path / "many"
    folder.mkdir()
    for name in ("one", "two"):
        lines = ['id,"a ""name""\nin two lines"']
        for i in range(300):
            body = "".join(rng.choices(pieces, weights=[9, 9, 9, 3, 2, 4, 3, 1, 1, 1, 0.3], k=rng.randint(0, 12)))
            lines.append(rng.choice([f'{name}{i},"{body}"', f"{name}{i},plain", f"{name}{i},", ""]))
        (folder / f"{name}.csv").write_bytes("\n".join(lines).encode())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "body")])
    whole = spark.read.options(header=True, quote='"', escape='"', nullValue="NA", multiLine=True).schema(schema).csv(str(folder))
    out = delimited.read_csv(spark, str(folder), schema, multi_line=True)
    assert rows(out) == rows(whole) and out.count() > 400
    assert records.csv_records(spark, str(folder)).filter("not is_first").select(F.spark_partition_id()).distinct().count() > 4
    assert delimited.read_csv(spark, str(folder), multi_line=True).columns == ["id", 'a "name"\nin two lines']


@pytest.mark.parametrize("text, expected", [
    ("k,v\n", []), ("k,v\n1,2", [("1", "2")]), ("k,v\r\n1,\"a\r\nb\"\r\n", [("1", "a\r\nb")]),
    ('k,v\n1,"' + "long " * 100 + '\n"\n2,3\n', [("1", "long " * 100 + "\n"), ("2", "3")]), ("k,v\n\n\n1,2\n\n", [("1", "2")]),
])
def test_records_at_the_edges(spark, tmp_path, small_splits, text, expected):
    (tmp_path / "edge.csv").write_bytes(text.encode())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "kv"])
    assert rows(delimited.read_csv(spark, str(tmp_path / "edge.csv"), schema, multi_line=True)) == expected


def test_files_of_two_encodings(spark, tmp_path, small_splits):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "old.csv").write_bytes("namé,v\nrené,1\n".encode("latin-1") + b"plain,2\n" * 40)
    (folder / "new.csv").write_bytes(b"nam\xc3\xa9,v\n" + b"plain,3\n" * 40 + "zoé,4\n".encode())
    out = delimited.read_csv(spark, str(folder), fallback="ISO-8859-1")
    assert out.columns == ["namé", "v"] and out.count() == 82
    assert {r[0] for r in out.collect()} == {"rené", "plain", "zoé"}
    target = scratch_path(spark, "recoded")
    delimited.recode_csv(spark, str(folder), target)
    assert rows(delimited.read_csv(spark, target)) == rows(out)


def test_read_csv_nulls_values_that_do_not_fit(spark):
    path = scratch_path(spark, "typed")
    delimited.write_csv(spark.createDataFrame([("NE", "2020-01-02"), ("2018", "x")], "year string, web_date string"), path)
    out = delimited.read_csv(spark, path).select("year", F.col("web_date").cast("string"))
    assert rows(out) == sorted([(None, "2020-01-02"), (2018.0, None)], key=repr)


def test_read_range(spark, tmp_path):
    lines = ["Banner", '"x"', "id,name,extra,more"] + [f'{i},"n, {i}",-,z' for i in range(20000)]
    (tmp_path / "sheet.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50KB")  # several splits of one file
    try:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "name", "extra")])
        out = delimited.read_range(spark, str(tmp_path), 2, schema, n_rows=15000, na_tokens=["-"])
        ids = sorted(int(r["id"]) for r in out.collect())
        assert ids == list(range(15000))
        assert out.filter("extra is not null or name <> concat('n, ', id)").count() == 0
        assert delimited.read_range(spark, str(tmp_path), 2).count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_snapshots(spark):
    path = scratch_path(spark, "snap")
    df = spark.range(3).toDF("id")
    snapshots.write_snapshot(df, path, "2024-01-01")
    with pytest.raises(Exception, match="already exists"):
        snapshots.write_snapshot(df, path, "2024-01-01")
    assert snapshots.read_snapshot(spark, path, "2024-01-01").count() == 3


def test_split_off_null(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "s string")
    kept, rejected = snapshots.split_off(df, F.col("s") == "x")
    assert (rows(kept), rows(rejected)) == ([("y",)], [("x",)])
    assert snapshots.split_off(df, F.col("s") == "x", keep_null=True)[0].count() == 2


def test_inline_table(spark):
    df = delimited.inline_table(spark, [(1, "a"), (2, None)], ["code", "name"])
    assert rows(df) == sorted([(1, "a"), (2, None)], key=repr)


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured


def files_of(spark, path):
    """Files of a table and when they were written, by partition."""
    out = {}
    for file in Path(path).rglob("*.parquet"):
        out.setdefault(int(file.parent.name.split("=")[1]), set()).add((file.name, file.stat().st_mtime_ns))
    return out


@pytest.fixture
def kept(spark):
    name, path = f"kept_{uuid.uuid4().hex}", scratch_path(spark, "kept")
    df = spark.range(2000).selectExpr("id AS k", "concat('n', id) AS n", "id * 2 AS v")
    keyed.create_keyed(df, name, ["k"], parts=50, buckets=3, path=path)
    yield name, path
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_keyed_rounds_rewrite_only_what_they_touch(spark, kept):
    name, path = kept
    expected = {i: (f"n{i}", i * 2) for i in range(2000)}
    batch = spark.createDataFrame([(3, 30), (77, None)], "k bigint, v bigint")
    before = files_of(spark, path)
    touched = keyed.change_keyed(spark, name, batch, changes.rows_update)
    after = files_of(spark, path)
    expected[3], expected[77] = ("n3", 30), ("n77", None)
    assert len(before) == 50 and 1 <= len(touched) <= 2
    assert {p for p in before if before[p] != after[p]} == set(touched)
    keyed.change_keyed(spark, name, spark.createDataFrame([(77, 5)], "k bigint, v bigint"), changes.rows_patch)
    keyed.change_keyed(spark, name, spark.createDataFrame([(5000, "new")], "k bigint, n string"), changes.rows_insert)
    expected[77], expected[5000] = ("n77", 5), ("new", None)
    assert {r["k"]: (r["n"], r["v"]) for r in keyed.keyed_table(spark, name).collect()} == expected
    # A partition that loses all its rows.
    gone = keyed.keyed_table(spark, name).filter(F.pmod(F.xxhash64("k"), F.lit(50)) == touched[0]).select("k")
    lost = {r["k"] for r in gone.collect()}
    keyed.change_keyed(spark, name, gone, changes.rows_delete)
    assert {r["k"] for r in keyed.keyed_table(spark, name).collect()} == set(expected) - lost
    assert spark.sql(f"SHOW PARTITIONS {name}").filter(f"partition = 'key_part={touched[0]}'").count() == 0
    with pytest.raises(Exception, match="not in the table"):
        keyed.change_keyed(spark, name, spark.createDataFrame([(999999, 1)], "k bigint, v bigint"), changes.rows_update)
    assert keyed.change_keyed(spark, name, spark.createDataFrame([], "k bigint, v bigint"), changes.rows_update) == []


def test_keyed_table_is_not_shuffled(spark, kept):
    name, _ = kept
    batch = spark.range(500).selectExpr("id AS k", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for change in (changes.rows_update, changes.rows_patch, changes.rows_delete):
            rows_after, _ = keyed.next_rows(spark, name, batch, change)
            plan = rows_after._jdf.queryExecution().executedPlan().toString()
            lines = plan.split("\n")
            scan = next(i for i, line in enumerate(lines) if name in line and "Scan parquet" in line)
            join = max(i for i, line in enumerate(lines[:scan]) if "SortMergeJoin" in line)
            assert not any("Exchange" in line for line in lines[join:scan]), plan
            assert "Bucketed: true" in lines[scan]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keyed_table_refuses_null_and_repeated_keys(spark):
    for values, message in (([(1, 2), (None, 3)], "null in the key"), ([(1, 2), (1, 3)], "not unique")):
        df = spark.createDataFrame(values, "k int, v int")
        with pytest.raises(Exception, match=message):
            keyed.create_keyed(df, f"bad_{uuid.uuid4().hex}", ["k"], path=scratch_path(spark, "bad"))


def test_snapshot_diff_reads_differing_buckets_only(spark):
    path = scratch_path(spark, "digested")
    old = spark.range(3000).selectExpr("id AS k", "CASE WHEN id % 3 <> 0 THEN 'v' END AS a", "CASE WHEN id % 2 = 0 THEN 'v' END AS b", "id * 1.5D AS c")
    # Row 7 swaps a value and a null between two columns, row 8 gets a null; 9 goes, 5000 comes.
    new = old.filter("k <> 9").selectExpr(
        "k", "CASE WHEN k = 7 THEN NULL ELSE a END AS a", "CASE WHEN k = 7 THEN 'v' ELSE b END AS b", "CASE WHEN k <> 8 THEN c END AS c"
    ).union(spark.sql("SELECT 5000L, NULL, 'n', 0D"))
    snapshots.write_digested(old, path, "1", ["k"], buckets=40)
    snapshots.write_digested(new.repartition(5), path, "2", ["k"], buckets=40)
    snapshots.write_digested(old.orderBy(F.desc("k")), path, "3", ["k"], buckets=40)
    assert snapshots.differing_buckets(spark, path, "1", "3") == []
    assert snapshots.snapshot_diff(spark, path, "1", "3", ["k"]).count() == 0
    differing = snapshots.differing_buckets(spark, path, "1", "2")
    assert 1 <= len(differing) <= 4
    out = snapshots.snapshot_diff(spark, path, "1", "2", ["k"])
    assert rows(out) == sorted(
        [
            (7, "changed", "a", "v", None), (7, "changed", "b", None, "v"), (8, "changed", "c", "12.0", None),
            (9, "removed", None, None, None), (5000, "added", None, None, None),
        ],
        key=repr,
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert all("key_bucket" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
    # Repeated rows are told apart by their number.
    twice = spark.createDataFrame([(1, "x"), (1, "x")], "k int, a string")
    snapshots.write_digested(twice, path, "4", ["k"], buckets=2)
    snapshots.write_digested(twice.distinct(), path, "5", ["k"], buckets=2)
    assert len(snapshots.differing_buckets(spark, path, "4", "5")) == 1


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_of_a_hot_key(spark, strict):
    rng = random.Random(4)
    left = [(i, rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([*range(200), None])) for i in range(600)]
    right = [(i, rng.choice(["hot"] * 8 + ["a", "c", None]), rng.choice([*range(0, 200, 3), None])) for i in range(150)]
    # Long stretches without a right row, so that values are carried over several ranges.
    right = [r for r in right if r[2] is None or r[2] < 20 or r[2] > 150]
    expected = []
    for i, k, at in left:
        before = [(t, j) for j, q, t in right if q == k and t is not None and at is not None and (t < at if strict else t <= at)]
        expected.append((i, k, at, max(before)[1] if before else None))
    x, y = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "j int, k string, at bigint")
    assert rows(joins.asof_join(x, y, ["k"], "t", "at", ["j"], ["j"], strict, rows_per_range=20)) == sorted(expected, key=repr)
    assert joins.asof_join(x, y.limit(0), ["k"], "t", "at", ["j"]).filter("j is not null").count() == 0
    assert joins.asof_join(x.limit(0), y, ["k"], "t", "at", ["j"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        joins.asof_join(x, y.withColumn("i", F.lit(1)), ["k"], "t", "at", ["i"])


def test_string_agg_of_large_groups(spark):
    values = [("hot" if i % 5 else f"k{i % 3}", None if i % 11 == 0 else f"v{i}", (i * 7919) % 1009) for i in range(1000)] + [(None, "x", 1), ("nulls", None, 1)]
    df = spark.createDataFrame(values, "k string, v string, o int")
    for null_text in ("NA", None):
        plain = aggregates.string_agg(df, ["k"], "v", order_by=["o"], null_text=null_text)
        large = aggregates.string_agg(df, ["k"], "v", order_by=["o"], null_text=null_text, large_groups=True)
        assert rows(large) == rows(plain)
    once = [aggregates.string_agg(df, ["k"], "v", distinct=True, large_groups=g) for g in (False, True)]
    assert rows(once[0]) == rows(once[1])
