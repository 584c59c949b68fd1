"""Composed operators on small fixtures."""

import random

import pytest
from compare import rows
from pyspark.sql import functions as F

from tablewright.functions import levels
from tablewright.operators import grouped
from tablewright.plans import build, completeness, maintain, profile, reconcile, taxonomy, validate
from tablewright.plans.completeness import Scope
from tablewright.plans.validate import ContractRow
from tablewright.session import written

RECORD = "uID int, threat_num string, impact string, scope string, severity string, timing string, comments string, impact_code string"


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        [
            (1, "1,1", None, "Large", None, "High", "c1", "A"),
            (1, "1", "Not a threat", "-- Uncertainty Ranges --", "Slight", None, None, "B"),
            (1, "8.4", "Very High - Very High", "Small", "Extreme - Moderate (11-100%)", "Low", "c2", "C"),
            (2, "1.1", "Hig", "Large", "Serious", "High", None, "D"),
        ],
        RECORD,
    )


def test_taxonomy_pivot(records):
    wide = taxonomy.taxonomy_pivot(records)
    assert len(wide.columns) == 1 + 55 * 6
    first, second = wide.orderBy("uID").collect()
    assert first["X1.1_threat_identified"] == 1.0 and first["X1.1_iucn_impact"] == -1.0
    assert first["X1_threat_identified"] == 0.0 and first["X1_iucn_scope"] is None
    assert first["X8.4_iucn_impact"] == 4.5 and first["X8.4_iucn_severity"] == 4.0
    assert first["X8.4_iucn_comments"] == "c2" and first["X11.5_threat_identified"] == 0.0
    assert second["X1.1_iucn_impact"] == 99.0 and second["X1_threat_identified"] == 0.0
    assert second["X1_iucn_impact"] is None


def test_taxonomy_pivot_completes_flags_of_a_short_vocabulary(records):
    wide = taxonomy.taxonomy_pivot(records, ["uID"], vocabulary=["1", "1.1"])
    assert sum("identified" in c for c in wide.columns) == 55
    assert sum("iucn" in c for c in wide.columns) == 2 * 5


def test_check_levels_and_report(records):
    checked = taxonomy.check_levels(records, ["uID"])
    assert [(r["uID"], r["wch"], r["all_failing"]) for r in checked.collect()] == [(2, "impact", "impact")]
    assert rows(taxonomy.recode_report(records)) == sorted(
        [("impact", "Hig", 99.0, 1), ("scope", "-- Uncertainty Ranges --", 99.0, 1)], key=repr
    )
    assert taxonomy.check_levels(taxonomy.fix_level_columns(records), ["uID"]).count() == 0


def test_rollup_parents(records):
    rolled = taxonomy.rollup_parents(taxonomy.taxonomy_pivot(records)).orderBy("uID").collect()
    assert [(r["X1_threat_identified"], r["X8_threat_identified"], r["X2_threat_identified"]) for r in rolled] == [
        (1.0, 1.0, 0.0),
        (1.0, 0.0, 0.0),
    ]


def test_read_taxonomy(spark):
    table = spark.createDataFrame([(3, "b", "z"), (1, "b", "x"), (2, "a", "y")], "place int, kind string, subtype string")
    assert taxonomy.read_taxonomy(table, "kind", "subtype", ["place"]) == {"b": ["x", "z"], "a": ["y"]}


def test_duplicate_records(spark, records):
    other = spark.createDataFrame(
        [(1, "1.1", "Low", "Small", "Slight", "Low", "b", "D"), (3, "12.1", "Low", "Small", "Slight", "Low", "b", "E")], RECORD
    )
    both = records.unionByName(other.filter("uID = 1"))
    assert rows(taxonomy.duplicate_records(both, ["uID"])) == [(1, "1.1", 2)]
    with pytest.raises(Exception, match="are not unique, e.g. 1, 1.1"):
        taxonomy.taxonomy_pivot(both, ["uID"]).collect()
    first = taxonomy.taxonomy_pivot(both, ["uID"], order_by=["impact_code"]).filter("uID = 1").first()
    # The whole first record, its null severity included.
    assert (first["X1.1_iucn_scope"], first["X1.1_iucn_severity"], first["X1.1_iucn_comments"]) == (4.0, None, "c1")
    with pytest.raises(Exception, match="not in the vocabulary: 12.1"):
        taxonomy.taxonomy_pivot(records.unionByName(other.filter("uID = 3")), ["uID"]).collect()


def test_completeness_report(spark):
    df = spark.createDataFrame([(1, "s", None, 2.0), (2, "t", None, None), (3, "t", "x", 1.0)], "id int, kind string, a string, b double")
    scopes = [Scope("all", ("b",)), Scope("s", ("a", "b"), F.col("kind") == "s"), Scope("fam", ("a", "b"), None, "Family")]
    report = completeness.completeness_report(df, scopes).select("id", "miss_all", "miss_s", "miss_fam")
    assert rows(report) == [(1, "", "a", "Family"), (2, "b", "", "Family")]


def test_document_scopes_match_the_vocabulary():
    assert len(completeness.PARENT_FLAGS) == 11 and len(completeness.CHILD_FLAGS) == 40


def test_registry_headers_and_names(spark):
    assert reconcile.registry_headers(["COS_ID", "SCIENTIFIC NAME (E)", "DATE {E}"]) == {
        "COS_ID": "cos_id",
        "SCIENTIFIC NAME (E)": "scientific_name_registry",
        "DATE {E}": "date_registry",
    }
    df = spark.createDataFrame([("Common Five-lined Skink", "Carolinian populations"), ("Badger", None)], "n string, p string")
    assert rows(df.select(reconcile.registry_name(F.col("n"), F.col("p")))) == [
        ("badger",),
        ("five-lined skink carolinian population",),
    ]


def test_reconcile_registry_needs_a_unique_registry(spark):
    table = spark.createDataFrame([("a - b", 1)], "name string, y int")
    registry = spark.createDataFrame([("A-B", "Birds", 1, "r1"), ("C", "Mosses", 2, "r2")], "rname string, grp string, y2 int, v string")
    out = reconcile.reconcile_registry(table, registry, "name", "rname", "grp", ["v"], F.col("y") == F.col("y2"))
    assert [(r["name"], r["grp"], r["large_group"], r["v"]) for r in out.collect()] == [("a-b", "Birds", "Birds", "r1")]
    twice = registry.unionByName(registry)
    with pytest.raises(Exception, match="registry are not unique"):
        reconcile.reconcile_registry(table, twice, "name", "rname", "grp", ["v"], F.lit(True)).collect()


def test_add_missing_from_registry(spark):
    table = spark.createDataFrame(
        [(10, 1, "ant", "S", "u"), (11, 2, "bee populations", "R", "u"), (12, 2, "bee populations", "R", None), (13, 3, "cat", None, "u")],
        "row int, ent int, name string, kind string, url string",
    )
    registry = spark.createDataFrame(
        [("ant", 5, "x"), ("bee population", 6, "x"), ("cat", 7, "x"), ("dog", 8, "x"), ("elk", 9, "Extirpated"), ("fox", 9, None)],
        "rname string, rid int, status string",
    )
    out = reconcile.add_missing_from_registry(
        table, registry, "name", "rname", "ent", "row", "kind", "S", F.col("rid").isNotNull(),
        F.col("status") != "Extirpated", values={}, nulls=["url"], typed=["row", "ent"],
    )
    new = [tuple(r) for r in out.filter("row > 13").orderBy("row").collect()]
    # The entity whose only document has an unknown kind is left alone, as is an entry of unknown status.
    assert new == [(14, 2, "bee population", "S", None), (15, 4, "dog", "S", None)]


def test_source_priority_merge_with_null_dates(spark):
    first = spark.createDataFrame([(1, "1", None, "hand")], "u int, n string, d string, src string")
    second = spark.createDataFrame([(1, "1", None, "m"), (1, "1", "2020", "m")], "u int, n string, d string, src string")
    assert rows(reconcile.source_priority_merge(first, second, ["u", "n", "d"]).select("src", "d")) == sorted(
        [("hand", None), ("m", "2020")], key=repr
    )


def test_split_by_kind_nulls_and_ids(spark):
    df = spark.createDataFrame([(2, 1, None), (1, None, 7)], "u int, s int, r int")
    u = {"u": F.col("u")}
    out = reconcile.split_by_kind(
        df,
        {"S": (F.col("s") == 1, u | {"a": F.col("s")}), "R": (F.col("r").isNotNull(), u | {"b": F.col("r")})},
        ["u", "a", "b"], "kind", ["u"], "id", {"S": 500, "R": 1500},
    )
    assert rows(out) == sorted([("S", 2, 1, None, 500), ("R", 1, None, 7, 1500)], key=repr)


@pytest.fixture(scope="module")
def document(spark):
    return spark.createDataFrame(
        [
            (1, "A, B", "1999-01-01", 1999, 1.0, 1.0, "education, Feeding,"),
            (2, "A, C", "soon", 1980, None, 2.0, None),
            (2, None, "1975-05-05", None, 3.0, 0.25, "x"),
        ],
        "id int, kinds string, day string, y int, X1_threat_identified double, X1_iucn_scope double, action_subtype string",
    )


def test_domains(document):
    assert rows(validate.domain_offenders(document, {"kinds": ["A", "B", "NA"]})) == [("domain", "kinds", "C", 1)]
    loose = validate.domain_offenders(document, {"action_subtype": ["education", "feeding"]}, loose=True)
    assert rows(loose) == sorted([("domain_loose", "action_subtype", v, 1) for v in ("NA", "x")], key=repr)
    assert rows(validate.family_offenders(document)) == sorted(
        [("family_domain", "X1_threat_identified", "3", 1), ("family_domain", "X1_iucn_scope", "0.25", 1)], key=repr
    )


def test_family_of_text_columns(spark):
    df = spark.createDataFrame([("NE", "1.5"), ("5", "99"), (None, "x")], "X1_threat_identified string, X1_iucn_scope string")
    assert rows(validate.family_offenders(df)) == sorted(
        [("family_domain", "X1_threat_identified", "5", 1), ("family_domain", "X1_iucn_scope", "99", 1), ("family_domain", "X1_iucn_scope", "x", 1)],
        key=repr,
    )


def test_counted_rules(document):
    counts = (
        validate.date_counts(document, ["day"])
        | validate.year_counts(["y"])
        | validate.required_counts(["y", "id"])
        | validate.type_counts(document, {"day": "is.character", "id": "is.character"})
    )
    assert rows(validate.rule_counts(document, counts)) == sorted(
        [("plausible_date", "day", 2), ("plausible_year", "y", 1), ("required", "y", 1), ("is.character", "id", 3)], key=repr
    )
    assert rows(validate.unique_offenders(document, ["id", "day"])) == [("unique", "id", 1)]


def test_report_raises(document):
    contract = [
        ContractRow("id", (), "unique, is.numeric", False),
        ContractRow("kinds", ("A", "B", "C", "NA"), "vals", True),
        ContractRow("day", (), "is.character, plausible_date", True),
    ]
    report = validate.validation_report(document, contract, family="^X")
    assert sorted(r["rule"] for r in report.collect()) == ["family_domain", "family_domain", "plausible_date", "unique"]
    with pytest.raises(ValueError, match="plausible_date day: 2 rows"):
        validate.require_valid(report)
    validate.require_valid(validate.validation_report(document.filter("id = 1"), contract))


def test_read_contract(spark, tmp_path):
    text = 'colnms,vals,expectation,na_allowed\nfinal,"1, 0, NA",vals,0\nnotes,"a b, c",is.character,1\nsingle,NA,vals,1\n'
    (tmp_path / "contract.csv").write_text(text)
    assert validate.read_contract(spark, str(tmp_path / "contract.csv")) == [
        ContractRow("final", ("1", "0", "NA"), "vals", False),
        ContractRow("notes", ("a b", "c"), "is.character", True),
        ContractRow("single", ("NA",), "vals", True),
    ]


def test_row_rules(spark):
    df = spark.createDataFrame([(1, 1, 1, 0, 0), (2, 0, 1, 0, None), (3, 0, 0, 1, 2), (4, None, None, None, 3)], "id int, nm int, th int, un int, ri int")
    rules = validate.contradictions(*[F.col(c) for c in ("nm", "th", "un", "ri")])
    assert rows(validate.contradicting_rows(df, "id", rules)) == sorted(
        [("not_mentioned_but_threat", 1), ("threat_without_impact", 1), ("threat_without_impact", 2), ("impact_without_threat", 3)],
        key=repr,
    )


def test_unflagged_rows(spark):
    columns = "id int, X1_threat_identified double, X1_iucn_scope double, X1_iucn_severity double, X1_iucn_timing double"
    df = spark.createDataFrame(
        [(1, 0.0, 2.0, 2.0, 3.0), (2, 0.0, None, 2.0, 3.0), (3, 1.0, 2.0, 2.0, 3.0), (4, 0.0, 2.0, 2.0, 2.0)], columns
    )
    assert rows(validate.unflagged_rows(df, ["id"])) == [(1, "1")]


def test_flags_of_two_do_not_count(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 0.0)], "doc_type string, X1_threat_identified double")
    assert rows(profile.docs_by_threat(df)) == [("a", "1", 1)]


def test_latest_documents(spark):
    df = spark.createDataFrame(
        [(1, "COSEWIC Status Reports", 2001, "BIRDS (sea)"), (1, "COSEWIC Status Reports", 2005, "BIRDS (sea)"), (1, "Other", 2009, None)],
        "speciesID int, doc_type string, year_published int, taxonomic_group string",
    )
    out = profile.latest_documents(df).select("doc_type", "doc_type2", "year_published", "taxonomic_group")
    assert rows(out) == sorted([("Status reports", "Status", 2005, "Birds (sea)"), (None, None, 2009, None)], key=repr)


def test_dictionary_facts(spark):
    df = spark.createDataFrame(
        [("c1", "1: one", None), ("c2", None, "x"), ("c3", "NA", "NR: not reported")], "a string, v1 string, v2 string"
    )
    facts = profile.dictionary_facts(df, "a", ["v1", "v2"])
    assert rows(facts) == [("c1", "1", "one"), ("c3", "NA", "NA"), ("c3", "NR", "not reported")]
    assert rows(profile.value_dictionary(facts)) == [("c1", "1", "one")]
    assert profile.missing_facts(facts).count() == 2


def test_maintenance_rounds(spark):
    table = spark.createDataFrame(
        [(1, None, "Threatened", "1999-01-01", None), (2, "b-é", "x", None, "u"), (3, "c", "x", "NE", None)],
        "rowID int, common_name string, sara_status string, listing_date string, url string",
    )
    first = spark.createDataFrame(
        [(1, "a/b", "yes", "common_name"), (3, "zzz", "", "")], "rowID int, common_name string, change_made string, miss_all string"
    )
    patched = maintain.patch_round(table, first, ["rowID"], "u=")
    assert rows(patched.select("rowID", "common_name", "url")) == sorted(
        [(1, "a/b", "u=a%20%2F%20b"), (2, "b-é", "u"), (3, "c", None)], key=repr
    )
    second = spark.createDataFrame(
        [(1, "yes", " special concern", "(1-02-2020)"), (2, "remove", None, None)],
        "rowID int, change_made string, sara_status string, listing_date string",
    )
    changed = maintain.change_round(patched, second, ["rowID"])
    assert rows(changed.select("rowID", "sara_status", "listing_date")) == sorted(
        [(1, "Special Concern", "2020-02-01"), (3, "X", None)], key=repr
    )
    words = spark.createDataFrame([("Nr",), ("NR",), (None,)], "v string")
    assert rows(maintain.relabel_unreported(words, ["v"])) == sorted([("NR",), ("NR",), (None,)], key=repr)


def test_current_documents(spark):
    rows_in = [
        (1, 1, "S", 2000, None, 1), (2, 1, "S", 2000, "d", 0), (3, 1, "S", 2001, None, 0), (4, 1, "S", 2002, None, 1),
        (5, 2, "S", 2000, None, 0), (6, 3, "R", 2000, None, None), (7, 3, "R", 2001, None, 1), (8, None, None, None, None, 0),
        (9, 4, "S", 2000, None, 1), (10, 4, "S", 2000, None, 1),
    ]
    df = spark.createDataFrame(rows_in, "docID int, uID int, doc_type string, year_published int, web_pub_date string, final int")
    kept = build.current_documents(df).select("docID")
    # As the two group filters one after the other.
    unpublished = F.col("web_pub_date").isNull()
    first = grouped.superseded_filter(df, ["uID", "year_published", "doc_type"], unpublished)
    second = grouped.superseded_filter(first, ["uID", "doc_type"], (F.col("final") == 0) & unpublished)
    assert rows(kept) == rows(second.select("docID")) == sorted([(2,), (4,), (5,), (7,), (8,)], key=repr)


def test_prepared_batch(spark):
    table = spark.createDataFrame([(1, "Birds"), (2, "Mosses")], "rowID int, taxonomic_group string")
    batch = spark.createDataFrame([(1, "a b", "promoo, x"), (3, None, None)], "rowID int, common_name string, action_subtype string")
    out = maintain.prepared_batch(
        batch, table, ["rowID"], "u=", {"action_subtype": "action_type"}, {"Out": ["promo"]}, {"action_subtype": [("promoo", "promo")]}
    ).select("rowID", "action_subtype", "action_type", "url", "taxonomic_group")
    assert rows(out) == [(1, "promo, x", "Out", "u=a%20b", "Birds"), (3, None, None, None, None)]


def test_build_checks(spark):
    docs = spark.createDataFrame([(1,), (1,), (2,)], "docID int")
    wide = spark.createDataFrame([(1, None), (1, None), (1, 2)], "uID int, docID int")
    assert rows(build.build_checks(docs, wide)) == sorted([("documents", "1", 2), ("categories", "1", 2)], key=repr)


@pytest.mark.parametrize("most", [1, 2])
def test_proposals_against_every_pair(spark, most):
    rng = random.Random(most)
    known = sorted({"".join(rng.choice("abé ") for _ in range(rng.randint(0, 7))) for _ in range(60)})
    wrong = ["".join(rng.choice("abé ") for _ in range(rng.randint(0, 7))) for _ in range(80)] + [None, "", "a", "far away from all"]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    expected = []
    for name in {w for w in wrong if w is not None and w not in known}:
        near = sorted((edits(name, k), k) for k in known if edits(name, k) <= most)
        expected += [(name, k, d, i + 1, sum(x == near[0][0] for x, _ in near)) for i, (d, k) in enumerate(near)]
    out = reconcile.propose_names(
        spark.createDataFrame([(w,) for w in wrong], "v string"), spark.createDataFrame([(k,) for k in known] + [(None,)], "k string"), "v", "k", most
    )
    assert rows(out) == sorted(expected, key=repr)


def test_categories_stay_lists_through_the_joins(spark, records):
    # Hundreds of columns are made once, after the last exchange, and are the same as when they are made first.
    def widest(df):
        plan = df._jdf.queryExecution().optimizedPlan()
        joins = [n for n in _nodes(plan) if n.nodeName() == "Join"]
        return max(side.output().size() for j in joins for side in (j.left(), j.right()))

    first = records.filter("impact_code <> 'A'").select("*", F.lit(5).alias("docID"))
    documents = spark.createDataFrame(
        [(1, 5, 1, None), (2, 5, 0, None), (3, None, 1, 2.0)], "uID int, category_document int, threat_calculator int, TC_version double"
    )
    wide, listed = (
        build.category_table(first, first.limit(0), ["uID", "threat_num", "docID"], ["uID", "docID"], order_by=["impact_code"], spread=s)
        for s in (True, False)
    )
    before, after = build.with_categories(documents, wide), build.with_categories(documents, listed)
    assert after.columns == before.columns and rows(after) == rows(before)
    assert widest(after) < 20 < widest(before)
    # What is written for several readings are the lists as well.
    stored = build.with_categories(documents, listed, stored="built")
    scans = [n for n in _nodes(stored._jdf.queryExecution().optimizedPlan()) if "Relation" in n.nodeName()]
    assert [n.output().size() < 20 for n in scans] == [True]
    assert stored.columns == before.columns and rows(stored) == rows(before)
    kept = documents.withColumn("X1_iucn_scope", F.lit(9.0))
    assert rows(build.with_categories(kept, listed)) == rows(build.with_categories(kept, wide))


@pytest.mark.parametrize("missing", ["name", "name, X1_iucn_scope"])
def test_change_round_takes_categories_as_lists(spark, records, missing):
    texts = records.filter("impact_code <> 'A'").drop("impact_code")
    ids = spark.createDataFrame([(1, "one", "Threatened"), (2, None, None), (3, "three", "Threatened")], "uID int, name string, sara_status string")
    batch = spark.createDataFrame(
        [(1, "no", missing, None), (2, "remove", "", "two"), (3, "yes", "name", "drei")], "uID int, change_made string, missing string, name string"
    )

    def round_of(spread):
        table = ids.join(taxonomy.taxonomy_pivot(texts, ["uID"], spread=spread), "uID", "left")
        changed = texts.filter("uID = 1 and threat_num <> '1'").drop("uID").withColumn("docID", F.lit(3))
        return maintain.change_round(table, batch, ["uID"], maintain.batch_categories(changed, {"docID": "uID"}, spread=spread), date_pattern="_date$")

    before, after = round_of(True), round_of(False)
    assert after.dtypes == before.dtypes and rows(after) == rows(before)
    held = {r["uID"]: r for r in after.collect()}
    assert set(held) == {1, 3} and held[1]["name"] == "NE" and held[3]["X8.4_iucn_impact"] == 4.5
    assert held[1]["X8.4_iucn_impact"] is None and held[1]["X1_iucn_scope"] == (None if missing == "name" else "NE")


def _nodes(plan):
    children = plan.children()
    return [plan, *[n for i in range(children.size()) for n in _nodes(children.apply(i))]]


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_proposals_of_runs_marks_and_short_names(spark, most):
    # The letter that marks a place may be in names, characters come in runs, and all of a name may be edited.
    rng = random.Random(most)
    letters = "a" * 3 + "b" + reconcile.MARK
    known = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(40)} | {"😀aa", "aa😀"})
    wrong = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(60)} | {"a😀a", "😀"})
    expected = {(w, k, _edits(w, k)) for w in wrong if w not in known for k in known if _edits(w, k) <= most}
    out = reconcile.propose_names(spark.createDataFrame([(w,) for w in wrong * 2], "v string"), spark.createDataFrame([(k,) for k in known * 2], "k string"), "v", "k", most)
    found = [(r["v"], r["proposal"], r["edits"]) for r in out.collect()]
    assert len(found) == len(expected) and set(found) == expected


def _joined(plan, key):
    """Rows that the joins by a column gave, in a plan that ran."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _joined(plan.executedPlan(), key)
    if "QueryStage" in name:
        return _joined(plan.plan(), key)
    own = plan.metrics().apply("numOutputRows").value() if "Join" in name and f"[{key}#" in plan.simpleString(99) else 0
    children = plan.children()
    return own + sum(_joined(children.apply(i), key) for i in range(children.size()))


def test_only_names_that_are_close_meet(spark):
    # Numbered names share most letters with hundreds of others that are three or four edits away.
    known = spark.createDataFrame([(f"Customer#{i:09d}",) for i in range(0, 3000, 3)], "k string")
    wrong = spark.createDataFrame([(x,) for i in range(0, 3000, 30) for x in (f"Csutomer#{i:09d}", f"Customer#{i:09d}s")], "v string")
    out = reconcile.propose_names(wrong, known, "v", "k", 2)
    found = out.collect()
    met = _joined(out._jdf.queryExecution().executedPlan(), "rest")
    # A pair of one edit meets by each further place that may be marked, others seldom by more than one rest.
    assert len(found) <= met <= 3 * len(found)


def test_rests_of_names_do_not_pass_through_the_driver(spark):
    # A name of 18 characters has 171 rests, and Spark takes them for as large as the name.
    wrong = written(spark.createDataFrame([(f"Customer#{i:08d}",) for i in range(30)], "name string"))
    known = written(spark.createDataFrame([(f"Customer#{i:09d}",) for i in range(30)], "known string"))
    out = reconcile.propose_names(wrong, known, "name", "known", most=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [rest#" in line]
    assert joins and not any("Broadcast" in line for line in joins)
    assert out.filter("edits = 1 and int(right(name, 8)) = int(right(proposal, 9))").count() == 30


def test_write_checked_reads_a_clean_table_once(spark, document, monkeypatch):
    from tablewright.session import scratch_path

    contract = [
        ContractRow("id", (), "unique, is.numeric", False),
        ContractRow("kinds", ("A", "B", "C", "NA"), "vals", True),
        ContractRow("day", (), "is.character, plausible_date", True),
    ]
    path = scratch_path(spark, "checked")
    plain = validate.validation_report(document, contract, family="^X")
    assert rows(validate.write_checked(document, path, "1", contract, family="^X")) == rows(plain)
    assert rows(spark.read.parquet(f"{path}/snapshot=1")) == rows(document)

    def never(*_, **__):
        raise AssertionError("read again")

    monkeypatch.setattr(validate, "validation_report", never)
    clean = document.filter("id = 1").limit(1)
    assert validate.write_checked(clean, path, "2", contract).count() == 0
    assert validate.write_checked(clean.select("id"), path, "3", contract[:1]).count() == 0
    assert validate.write_checked(clean.limit(0), path, "4", contract[1:]).count() == 0


def test_profiles_in_one_pass(spark):
    values = [(i, i % 7, f"g{i % 3}" if i % 5 else None, f"k{i % 2}", f"c{i % 2}", 2000 + i % 4 if i % 6 else None) for i in range(200)]
    latest = spark.createDataFrame(values, "rowID int, speciesID int, taxonomic_group string, doc_type string, doc_type2 string, year_published int")
    out = profile.documents_profile(latest, ["rowID"])
    parts = {
        "docs_by_group": (profile.docs_by_group(latest), ["taxonomic_group", "doc_type"]),
        "entities_by_group": (profile.entities_by_group(latest, ["rowID"]), ["taxonomic_group", "doc_type", "doc_type2"]),
        "docs_by_year": (profile.docs_by_year(latest), ["year_published", "doc_type", "doc_type2"]),
    }
    for name, (plain, columns) in parts.items():
        assert rows(out.filter(F.col("profile") == name).select(*columns, "n")) == rows(plain.select(*columns, "n"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


def test_index_finds_what_expressions_find(spark):
    rng = random.Random(11)
    parts = ["manage", "habitat", "ab", "species", "Monitor", "re-plant", "a.c", "x+", "é", "ring"]
    subtypes = sorted({" ".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(120)}) + ["", "q"]
    kinds = {f"K{i}": subtypes[i::7] for i in range(7)}
    kinds["K3"].remove("") if "" in kinds["K3"] else None
    for k in kinds:
        kinds[k] = [x for x in kinds[k] if x]
    types = spark.createDataFrame([(k, x, i) for i, (k, x) in enumerate((k, x) for k, v in kinds.items() for x in v)], "kind string, subtype string, place int")
    texts = [None, "", "ab", "earring aac xx"] + [rng.choice([", ", " "]).join(rng.choices([*parts, "zzz", "HABITAT"], k=rng.randint(0, 6))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:20])], "text int, v string")
    expected = df.withColumn("out", levels.classify_list(F.col("v"), kinds))
    assert rows(taxonomy.classify_by_index(df, "v", types, "out")) == rows(expected)


def test_plan_of_a_large_taxonomy_is_as_small(spark):
    def plan_of(n):
        types = spark.range(n).selectExpr("concat('K', id % 9) AS kind", "concat('sub-type ', id) AS subtype", "id AS place")
        df = spark.createDataFrame([(1, "x sub-type 7, sub-type 999")], "id int, v string")
        out = taxonomy.classify_by_index(df, "v", types, "out")
        return len(out._jdf.queryExecution().optimizedPlan().toString()), out.first()["out"]

    small, large = plan_of(10), plan_of(10_000)
    assert abs(small[0] - large[0]) < 60 and large[1] == "K0, K7"
