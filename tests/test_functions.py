"""Edge cases of the expressions, from the rules of the data."""

import datetime

import pytest
from compare import rows
from pyspark.sql import functions as F, types as T

from tablewright.functions import dates, levels, names, text


def evaluate(spark, value, expression, dtype="string"):
    schema = f"v {dtype}"
    return spark.createDataFrame([(value,)], schema).select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "measure, value, code",
    [
        ("severity", "Extreme - Moderate (11-100%)", 4.0),
        ("impact", "Very High", 5.0),
        ("impact", "Very High - High", 4.5),
        ("impact", "Very High - Very High", 4.5),
        ("impact", "High - Medium - Low", 100.0),
        ("impact", "Hig", 99.0),
        ("impact", "", 99.0),
        ("impact", "-- Uncertainty Ranges --", 99.0),
        ("scope", "Not calculated", -2.0),
        ("timing", "Not scored", -2.0),
        ("timing", "Insignificant/Negligible", 1.0),
        ("impact", None, None),
        ("timing", "Very High", 99.0),
        ("severity", "Neutral or Potential Benefit", 0.0),
    ],
)
def test_recode_levels(spark, measure, value, code):
    assert evaluate(spark, value, lambda c: levels.recode_levels(c, levels.LEVEL_CODES[measure])) == code


@pytest.mark.parametrize(
    "measure, value, fails",
    [
        ("impact", "Hig", True),
        ("impact", "", True),
        ("impact", None, False),
        ("impact", "-- uncertainty RANGES --", False),
        ("timing", "Very High", True),
        ("timing", "high", False),
        ("impact", "very high", False),
    ],
)
def test_fails_levels(spark, measure, value, fails):
    assert evaluate(spark, value, lambda c: levels.fails_levels(c, levels.LEVEL_CODES[measure])) is fails


@pytest.mark.parametrize(
    "impact, scope, severity, expected, flag",
    [
        (None, 3.0, None, -1.0, 1.0),
        (None, None, 3.0, -1.0, 1.0),
        (None, 3.0, 4.0, None, 0.0),
        (None, 0.0, 1.0, 1.0, 1.0),
        (None, 0.0, -1.0, 0.0, 0.0),
        (None, -2.0, -1.0, -1.0, 1.0),
        (None, -2.0, None, -2.0, 1.0),
        (None, None, None, None, 0.0),
        (2.5, 0.0, 0.0, 2.5, 1.0),
        (-1.0, None, None, -1.0, 1.0),
        (0.0, 5.0, 5.0, 0.0, 0.0),
    ],
)
def test_derive_impact_and_flag(spark, impact, scope, severity, expected, flag):
    df = spark.createDataFrame([(impact, scope, severity)], "i double, s double, v double")
    derived = levels.derive_impact(F.col("i"), F.col("s"), F.col("v"))
    assert tuple(df.select(derived, levels.flag_identified(derived)).first()) == (expected, flag)


def test_vocabulary():
    assert len(levels.CATEGORIES) == 55
    assert levels.CATEGORIES[:5] == ("1", "1.1", "1.2", "1.3", "2")
    assert set(levels.NEWER_CHILDREN) < set(levels.CATEGORIES)


TAXONOMY = {"Outreach": ["education"], "Research": ["monitoring", "res.arch"]}


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, None),
        ("nothing of the kind", None),
        ("Education, monitoring", "Outreach, Research"),
        ("RESEARCH", "Research"),
    ],
)
def test_classify_list(spark, value, expected):
    assert evaluate(spark, value, lambda c: levels.classify_list(c, TAXONOMY)) == expected


def test_repair_subtypes_changes_first_match_only(spark):
    value = "Manage Human Threats,, x,, manage human threats"
    with_commas = evaluate(spark, value, lambda c: levels.repair_subtypes(c, commas=True))
    assert with_commas == "regulate human activities, x,, manage human threats"
    assert evaluate(spark, value, levels.repair_subtypes) == "regulate human activities,, x,, manage human threats"


def test_repair_subtypes_finds_letters_beyond_ascii(spark):
    for value in ("MANAGE HUMAN THREATS", "manage human threat\u017f", "manage predat\u0130on", "\u00e9, manage predation,, x", "plain, \u00e9"):
        plain = text.replace_first(F.col("v"), "manage human threats", "regulate human activities", ignore_case=True)
        plain = text.replace_first(plain, "manage predation", levels.SUBTYPE_SYNONYMS[1][1], ignore_case=True)
        expected = evaluate(spark, value, lambda c: text.replace_first(plain, ",,|, ,", ","))
        assert evaluate(spark, value, lambda c: levels.repair_subtypes(c, commas=True)) == expected
    assert evaluate(spark, "a.b, abb", lambda c: levels.repair_subtypes(c, synonyms=[("a.b", "x")])) == "x, abb"


def test_plain_terms_are_not_looked_for_as_patterns(spark):
    # A pattern is tried at every place of every text, which was most of the time of recoding.
    df = spark.createDataFrame([("Education, monitoring",), (None,)], "v string")
    known = {"Outreach": ["education", "outreach"], "Research": ["monitoring"]}
    out = df.select(levels.classify_list(F.col("v"), known).alias("kind"))
    assert rows(out) == rows(spark.createDataFrame([("Outreach, Research",), (None,)], "kind string"))
    assert "RLIKE" not in out._jdf.queryExecution().analyzed().toString().upper()
    for pattern in ("Hig$", "Ongoing", "a.c", "b$c", "$", ""):
        for value in ("Hig", "High", "Hig\n", "High Hig", "Ongoing", "abc", "b$c", "", None):
            expected = evaluate(spark, value, lambda c: c.rlike(pattern))
            assert evaluate(spark, value, lambda c: text.found(c, pattern)) == expected


def test_fix_levels(spark):
    assert evaluate(spark, "Hig", levels.fix_levels) == "High"
    assert evaluate(spark, "Hig - Low", levels.fix_levels) == "Hig - Low"
    assert evaluate(spark, "Ongoing - Ongoing", levels.fix_levels) == "High - Ongoing"
    assert evaluate(spark, None, levels.fix_levels) is None


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2014.0", "2014-01-01"),
        ("2014", "2014-01-01"),
        ("42779", "2017-02-13"),
        ("42779.0", "2017-02-13"),
        ("2017-13-02", "2017-02-13"),
        ("2017-02-13", None),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_mixed_date(spark, value, expected):
    assert evaluate(spark, value, lambda c: dates.date_text(dates.parse_mixed_date(c, 6))) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("(13-02-2017)", "2017-02-13"),
        ("2017-02-13", "2017-02-13"),
        (" 13/2/2017 ", "2017-02-13"),
        ("13 February 2017", "2017-02-13"),
        ("02-13-2017", None),
        ("NE", None),
    ],
)
def test_fix_date(spark, value, expected):
    assert evaluate(spark, value, lambda c: dates.date_text(dates.fix_date(c))) == expected


def test_impute_version(spark):
    df = spark.createDataFrame(
        [(1, None, 0), (1, None, None), (1, 1.1, 0), (0, None, 0), (None, None, 0)], "u int, v double, n int"
    )
    out = df.select(levels.impute_version(F.col("u"), F.col("v"), F.col("n"))).collect()
    assert [r[0] for r in out] == [2.3, 1.1, 1.1, None, None]


@pytest.mark.parametrize(
    "parent, children, expected",
    [(0.0, (1.0, None), 1.0), (0.0, (None, 0.0), 0.0), (None, (1.0, 1.0), None), (2.0, (1.0, 1.0), 2.0), (1.0, (0.0, 0.0), 1.0)],
)
def test_rollup_flag(spark, parent, children, expected):
    df = spark.createDataFrame([(parent, *children)], "p double, a double, b double")
    assert df.select(levels.rollup_flag(F.col("p"), [F.col("a"), F.col("b")])).first()[0] == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Grey - Fox  (Northern  Pop)", "grey-fox northern pop"),
        ("a - - b", "a--b"),
        ("Bear’s / Den", "bear's/den"),
        ("saw – whet", "saw-whet"),
        (None, None),
    ],
)
def test_canonical_name(spark, value, expected):
    assert evaluate(spark, value, text.canonical_name) == expected


def test_canonical_name_corrections(spark):
    out = evaluate(spark, "Grey Fox grey fox", lambda c: text.canonical_name(c, corrections=[("grey fox", "gray fox")]))
    assert out == "gray fox grey fox"
    assert evaluate(spark, "A", lambda c: text.canonical_name(c, exact={"a": "b"})) == "b"


def test_text_helpers(spark):
    assert evaluate(spark, "a.b.c", lambda c: text.replace_first(c, r"\.", "$1")) == "a$1b.c"
    assert evaluate(spark, "line\nAA AA", lambda c: text.replace_first(c, "aa", "x", ignore_case=True)) == "line\nx AA"
    assert evaluate(spark, "x1y2", lambda c: text.replace_all(c, r"\d", "")) == "xy"
    assert evaluate(spark, " a  b ", text.squish) == "a b"
    assert evaluate(spark, "special CONCERN ", text.status_normalise) == "Special Concern"
    assert evaluate(spark, "X11.5_iucn", lambda c: text.extract(c, r"\d\d?\.?\d?")) == "11.5"
    assert evaluate(spark, "none", lambda c: text.extract(c, r"\d")) is None
    assert evaluate(spark, "Œuvre été/l'an-x", lambda c: text.derive_url(c, "u=")) == "u=OEuvre%20ete%20%2F%20l%27an%20-%20x"
    assert evaluate(spark, "Čašłą Đuřiō", text.to_ascii) == "Casla Durio"


def test_map_values(spark):
    assert evaluate(spark, "b", lambda c: text.map_values(c, {"a": "x"})) is None
    assert evaluate(spark, "b", lambda c: text.map_values(c, {"a": "x"}, unmapped="keep")) == "b"
    assert evaluate(spark, None, lambda c: text.map_values(c, {"a": "x"}, unmapped="error")) is None
    with pytest.raises(Exception, match="no label for value b"):
        evaluate(spark, "b", lambda c: text.map_values(c, {"a": "x"}, unmapped="error"))


def test_names():
    assert names.matching(["X1", "X1.1", "y"], r"^X\d$") == ["X1"]
    assert names.union(["a", "b"], ["b", "c"]) == ["a", "b", "c"]
    assert names.intersect(["c", "a"], ["a", "c"]) == ["c", "a"]
    assert names.difference(["a", "b"], ["a"]) == ["b"]
    assert names.number_in("X10.2_threat_identified") == 10.2
    columns = ["X10_flag", "X2_scope", "X2_flag", "id", "X2.1_flag"]
    assert names.vocabulary_order(columns, [["id"]]) == ["id", "X2_flag", "X2_scope", "X2.1_flag", "X10_flag"]
    schema = names.schema_from_names(["docID", "web_date", "year_published", "TC_date", "x"], override={"TC_date": T.StringType()})
    assert [f.dataType for f in schema] == [T.DoubleType(), T.DateType(), T.DoubleType(), T.StringType(), T.StringType()]
    with pytest.raises(ValueError):
        names.renaming(["a", "b"], explicit={"a": "b"})
    with pytest.raises(ValueError):
        names.renaming(["a"], explicit={"z": "b"})


def test_dates_are_dates(spark):
    df = spark.createDataFrame([("42779.0",)], "v string")
    assert rows(df.select(dates.parse_mixed_date(F.col("v")))) == [(datetime.date(2017, 2, 13),)]
