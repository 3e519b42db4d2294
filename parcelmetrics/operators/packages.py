"""Which kinds of child packages a parent holds, and the case that follows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmetrics.operators.purchases import ASN, BUY_TYPES

# Package types and the forwarding order type.
SINGLE, INNER = "SINGLE", "INNER"
PARENT_TYPES = ["CONSOLE", "REPACK"]
FORWARDING = "WE_SHIP"


def children_of(package: DataFrame) -> DataFrame:
    return package.filter(F.col("package_type") == INNER)


#: Attributes of a parent that the cases use, the ones that a DISTINCT over parents compares.
PARENT_COLUMNS = [
    "package_id", "package_type", "trans_at_utc", "ship_at_kst", "package_merchant", "order_type", "customer_id", "country_code",
    "carrier", "carrier_service", "package_count", "package_weight", "dimension_weight", "reference_type", "track_number",
]

_BUY = f"COALESCE(reference_type IN ({', '.join(map(repr, BUY_TYPES))}), FALSE)"
_ASN = f"COALESCE(reference_type = '{ASN}', FALSE)"
#: Tests of one child; a parent has a flag where some child passes.
_TESTS = {
    "has_buy": _BUY,
    "has_asn": _ASN,
    "has_non_buy": f"NOT {_BUY}",
    "has_other": f"NOT {_BUY} AND NOT {_ASN}",
    "has_non_asn": f"reference_type IS NOT NULL AND NOT {_ASN}",
}


def child_mix(children: DataFrame) -> DataFrame:
    """One row of flags per parent: five existence tests on the children in one aggregate.

    Flags are combined on the map side, so a parent with very many children sends one row
    per map task. A missing type does not count against an all-ASN parent.
    """
    return children.groupBy("package_id").agg(
        F.expr("COUNT(*) AS n_children"), *[F.expr(f"BOOL_OR({test}) AS {name}") for name, test in _TESTS.items()]
    )


def families(package: DataFrame, start: Column) -> DataFrame:
    """Per package id the flags of its children and its parent rows from ``start`` on, in one aggregate of one scan.

    A parent id has one row, or a few where the source repeats it; they are the only rows that are collected. A parent
    without id has no children.
    """
    is_child = f"(package_type = '{INNER}' AND package_id IS NOT NULL)"
    is_parent = F.col("package_type").isin(PARENT_TYPES) & (F.col("trans_at_utc") >= start)
    rows = package.filter((F.col("package_type") == INNER) | is_parent)
    parent = F.when(F.col("package_type") != INNER, F.struct(*PARENT_COLUMNS))
    flags = [F.expr(f"COALESCE(BOOL_OR({is_child} AND {test}), FALSE) AS {name}") for name, test in _TESTS.items()]
    grouped = rows.groupBy("package_id").agg(F.expr(f"COUNT_IF({is_child}) AS n_children"), *flags, F.collect_list(parent).alias("parents"))
    return grouped.filter(F.size("parents") > 0)


#: Membership of a parent ``p`` in a case, given its flags; a childless parent passes 3 and 4.
_RULES = {
    "3": "NOT has_non_asn",
    "4": f"NOT has_non_buy AND NOT contains(p.order_type, '{FORWARDING}')",
    "5": "has_buy AND has_asn AND NOT has_other",
}


def parents_of(families: DataFrame, cases: Iterable[str], require_children: bool = False) -> DataFrame:
    """The parents of the given cases, a row for each case that a parent belongs to, named in ``_case``.

    Case 3 takes distinct parents.
    """
    childless = " AND n_children > 0" if require_children else ""

    def tagged(case: str) -> str:
        parents = "array_distinct(parents)" if case == "3" else "parents"
        return f"transform(filter({parents}, p -> {_RULES[case]}{childless}), p -> named_struct('_case', '{case}', 'p', p))"

    lists = ", ".join(tagged(case) for case in sorted(cases))
    return families.selectExpr(f"inline(concat({lists}))").select("_case", "p.*")
