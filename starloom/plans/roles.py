"""Role-playing views over the person dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import filtered_columns

# Output names of key, full name and preferred name in each role.
# The flags keep their own names.
ROLE_NAMES = {
    "contact": (
        "contact_person_key",
        "contact_full_name",
        "contact_preferred_name",
    ),
    "picked_by": (
        "picked_by_person_key",
        "picked_by_person_full_name",
        "picked_by_picked_by_preferred_name",
    ),
    "salesperson": (
        "salesperson_person_key",
        "salesperson_full_name",
        "salesperson_preferred_name",
    ),
}
NAME_COLUMNS = ("person_key", "person_full_name", "person_preferred_name")
FLAG_COLUMNS = ("is_system_user", "is_employee", "is_salesperson")


def person_role(dim_person: DataFrame, role: str, include_rest: bool = False) -> DataFrame:
    """The person dimension under one role's names.

    ``include_rest`` adds the remaining person columns, prefixed with the role.
    """
    names = [F.col(c).alias(new) for c, new in zip(NAME_COLUMNS, ROLE_NAMES[role], strict=True)]
    rest = []
    if include_rest:
        others = filtered_columns(dim_person, [*NAME_COLUMNS, *FLAG_COLUMNS])
        rest = [F.col(name).alias(f"{role}_{name}") for name in others]
    return dim_person.select(*names, *rest, *FLAG_COLUMNS)


def dim_contact_person(dim_person: DataFrame, include_rest: bool = False) -> DataFrame:
    return person_role(dim_person, "contact", include_rest)


def dim_picked_by_person(dim_person: DataFrame, include_rest: bool = False) -> DataFrame:
    return person_role(dim_person, "picked_by", include_rest)


def dim_salesperson_person(dim_person: DataFrame, include_rest: bool = False) -> DataFrame:
    """Salespeople only; a NULL flag counts as no."""
    return person_role(dim_person.filter("is_salesperson"), "salesperson", include_rest)
