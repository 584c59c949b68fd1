"""A table of documents on entities, derived from orders and customers.

The columns are expressions that Spark and DuckDB both read, so the table is the same for a query and
for its SQL twin; what is tested are the operators applied to it.
"""

from __future__ import annotations

from tablewright.functions import levels
from tablewright.operators.joins import left_join
from tablewright.plans.taxonomy import flag_name, wide_name

KINDS = {"F": "COSEWIC Status Reports", "O": "Recovery Strategies", "P": "Management Plans"}
STATUS = {
    "1-URGENT": "Endangered",
    "2-HIGH": "Threatened",
    "3-MEDIUM": "Special Concern",
    "5-LOW": "Not listed",
}
ACTIONS = [
    "Research and monitoring, Habitat management",
    "Outreach and stewardship",
    "Population management, Research and monitoring, Guesswork",
    "NE",
]
SUBTYPES = ["education, monitoring", " Education,, feeding", "translocation, monitring", ""]
CODED_NUMBERS = levels.CATEGORIES

# Text columns that hold the entity's name, and are null where the row id leaves no rest.
_NAMED = {"EOO": 8, "IAO": 9, "ranges": 12, "cosewic_status": 11}
_FLAGGED = {"endemic_NA": 6, "endemic_canada": 7, "continuous_USA": 10}


def _case(column, mapping):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _unless(rest, value):
    return f"CASE WHEN o_orderkey % {rest} <> 0 THEN {value} END"


def _pick(values):
    return _case(f"CAST(o_orderkey % {len(values)} AS STRING)", dict(enumerate(values)))


def _number(expression):
    return f"CAST({expression} AS DOUBLE)"


def _columns() -> dict[str, str]:
    date = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
    columns = {
        "rowID": "o_orderkey",
        "speciesID": "o_custkey",
        "common_name": "c_name",
        "doc_type": _case("o_orderstatus", KINDS),
        "sara_status": _case("o_orderpriority", STATUS),
        "url": _unless(5, "c_name"),
        "web_pub_date": f"CASE WHEN o_orderkey % 101 = 0 THEN 'soon' ELSE {_unless(4, date)} END",
        "year_published": _unless(97, "CAST(year(o_orderdate) AS INTEGER)"),
        "final": _unless(19, _number("o_orderkey % 2")),
        "taxonomic_group": "c_mktsegment",
        "report_writers": _unless(6, "c_name"),
        **{c: _unless(rest, "c_name") for c, rest in _NAMED.items()},
        **{c: _unless(rest, _number("o_orderkey % 3")) for c, rest in _FLAGGED.items()},
        "cosewic_examined_date": _unless(13, date),
        "Critical_habitat": _unless(14, _pick(["P", "Y", "N", "NE", "maybe"])),
        "action_subtype": _unless(15, _pick(SUBTYPES)),
        "CC_action": _unless(16, _number("o_orderkey % 2")),
        "CC_action_subtype": _unless(17, _pick(SUBTYPES)),
        "action_type": _unless(18, _pick(ACTIONS)),
        "CC_action_type": _unless(20, _pick(ACTIONS)),
        "CC_not_mentioned": _unless(21, _number("o_orderkey % 3 % 2")),
        "CC_unknown": _unless(22, _number("o_orderkey % 5 % 2")),
        "CC_threat": _unless(23, _number("o_orderkey % 7 % 2")),
        "CC_relative_impact": _unless(24, _number("o_orderkey % 4")),
        "threat_calculator": _unless(25, _number("o_orderkey % 2")),
        "TC_version": _unless(27, _number("1.1")),
    }
    for i, n in enumerate(levels.CATEGORIES):
        columns[flag_name(n)] = _number(
            f"CASE WHEN (o_orderkey + {i}) % 397 = 0 THEN NULL WHEN o_orderkey * {i + 1} % 9 = 0 THEN 1"
            f" WHEN (o_orderkey + {i}) % 1001 = 0 THEN 2 ELSE 0 END"
        )
        if n in CODED_NUMBERS:
            for m, measure in enumerate(("scope", "severity", "timing")):
                columns[wide_name(n, measure)] = (
                    f"CASE WHEN (o_orderkey + {i} + {m}) % 499 = 0 THEN {_number('99')}"
                    f" WHEN (o_orderkey + {m}) % 8 <> 0 THEN {_number(f'(o_orderkey * {i + 2} + {m}) % 15 - 4')} / 2 END"
                )
    return columns


_COLUMNS = _columns()


def documents_view(t):
    # Dealt out while the rows are narrow: the test tables are one row group, and so one task, each.
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    named = left_join(t.orders, t.customer, {"o_custkey": "c_custkey"}).repartition(tasks)
    return named.selectExpr(*[f"{value} AS `{name}`" for name, value in _COLUMNS.items()])


DOCUMENTS = (
    "SELECT "
    + ", ".join(f'{value} AS "{name}"' for name, value in _COLUMNS.items())
    + " FROM orders LEFT JOIN customer ON o_custkey = c_custkey"
)
