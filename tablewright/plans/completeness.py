"""Which required values are missing, row by row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions import levels
from tablewright.functions.logic import any_of
from tablewright.functions.names import literals, matching, quoted, ref, refs
from tablewright.plans.taxonomy import flag_name

# Document kinds, and the columns that each must have filled in.
STATUS_REPORT = "COSEWIC Status Reports"
STRATEGY = "Recovery Strategies"
PLAN = "Management Plans"
STATUS_REPORT_COLUMNS = (
    "EOO",
    "IAO",
    "endemic_NA",
    "endemic_canada",
    "continuous_USA",
    "cosewic_status",
    "ranges",
    "cosewic_examined_date",
)
STRATEGY_COLUMNS = ("Critical_habitat", "action_subtype", "CC_action", "action_type")
PLAN_COLUMNS = ("action_subtype", "CC_action", "action_type")
ACTION_COLUMNS = ("CC_action_subtype", "CC_action_type")
VERSION_COLUMN = "TC_version"

PARENT_FLAGS = tuple(flag_name(n) for n in levels.PARENTS)
CHILD_FLAGS = tuple(
    flag_name(n) for n in levels.CATEGORIES if "." in n and n not in levels.NEWER_CHILDREN
)


@dataclass(frozen=True)
class Scope:
    """Columns required in the rows that meet a condition; a label stands for a whole family."""

    name: str
    required: tuple[str, ...]
    condition: Column | None = None
    label: str | None = None

    def rows(self) -> Column:
        return F.lit(True) if self.condition is None else F.coalesce(self.condition, F.lit(False))

    def missing(self) -> Column:
        """The missing columns' names, or the label, or an empty text."""
        if not self.required:
            return F.lit("")
        nulls = f"array({', '.join(f'{quoted(c)} IS NULL' for c in self.required)})"
        if self.label is not None:
            found = F.when(F.expr(f"array_contains({nulls}, true)"), F.lit(self.label)).otherwise(F.lit(""))
        else:
            names = f"array({', '.join(literals(self.required))})"
            found = F.expr(f"concat_ws(', ', filter({names}, (c, i) -> {nulls}[i]))")
        return F.when(self.rows(), found).otherwise(F.lit(""))


def document_scopes(always: Sequence[str], author: str = "author") -> list[Scope]:
    """The eight scopes of the curated table; ``always`` are the contract's required columns."""
    kind = ref("doc_type")
    recovery = kind.isin(STRATEGY, PLAN) & (ref("CC_action") == 1)
    return [
        Scope("all", tuple(matching(always, "url|rowID", negate=True))),
        Scope("sr", (author, *STATUS_REPORT_COLUMNS), kind == STATUS_REPORT),
        Scope("rs", STRATEGY_COLUMNS, kind == STRATEGY),
        Scope("mp", PLAN_COLUMNS, kind == PLAN),
        Scope("rsmp_cc", ACTION_COLUMNS, recovery),
        Scope("tcv", (VERSION_COLUMN,), ref("threat_calculator") == 1),
        Scope("th1", PARENT_FLAGS, None, "Level 1 threats"),
        Scope("th2", CHILD_FLAGS, None, "Level 2 threats"),
    ]


def completeness_report(df: DataFrame, scopes: Sequence[Scope], prefix: str = "miss_") -> DataFrame:
    """Rows that lack a required value, with one listing per scope in front.

    All scopes are one projection of the table: no joins and no shuffle.
    """
    listings = [s.missing().alias(prefix + s.name) for s in scopes]
    named = [ref(prefix + s.name) for s in scopes]
    return df.select(*listings, *refs(df.columns)).filter(any_of(n != "" for n in named))
