"""The dimension contract: what a dimension holds, how it is read from a source and what a change does.

A dimension names the columns that are overwritten and those whose changes make a version, each as
one list of names and types, and expressions for the columns that are not simply read by name.  The batch
writer, the streaming writer, inferred members and validation all work from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns every row of a dimension has besides its keys and attributes.
VERSION_COLUMNS = {"_version": "bigint", "is_inferred": "int"}
PERIOD_COLUMNS = {"start_date": "timestamp_ntz", "end_date": "timestamp_ntz"}


@dataclass(frozen=True)
class Dimension:
    """overwritten and versioned are lists of columns as in a CREATE TABLE; read maps a column to the SQL expression it is read by."""

    table: str
    surrogate: str
    alternate: str
    overwritten: str
    versioned: str = ""
    read: dict[str, str] = field(default_factory=dict)

    @cached_property
    def schema(self) -> T.StructType:
        """Attributes and their types; needs a running session."""
        return T.StructType.fromDDL(", ".join(x for x in (self.overwritten, self.versioned) if x))

    @cached_property
    def type1(self) -> list[str]:
        return T.StructType.fromDDL(self.overwritten).names if self.overwritten else []

    @cached_property
    def type2(self) -> list[str]:
        return T.StructType.fromDDL(self.versioned).names if self.versioned else []

    @property
    def has_history(self) -> bool:
        return bool(self.versioned)

    def differences(self, stored: T.StructType) -> list[str]:
        """What a stored table lacks, has besides, or holds in another type; is_inferred may be absent."""
        bookkeeping = {*VERSION_COLUMNS, *(PERIOD_COLUMNS if self.has_history else {})}
        have = {f.name: f.dataType for f in stored}
        needed = [self.surrogate, self.alternate, *self.schema.names, *(c for c in bookkeeping if c != "is_inferred")]
        lacks = [f"missing in table: {c}" for c in sorted(set(needed) - have.keys(), key=needed.index)]
        besides = [f"not in contract: {c}" for c in have if c not in {*needed, *VERSION_COLUMNS, *PERIOD_COLUMNS}]
        other = [f"type of {f.name}: {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in self.schema if f.name in have and have[f.name] != f.dataType]
        return lacks + besides + other

    def _column(self, f: T.StructField, source: set[str]) -> Column:
        if f.name in self.read:
            return F.expr(self.read[f.name]).try_cast(f.dataType).alias(f.name)
        return (F.col(f.name).try_cast(f.dataType) if f.name in source else F.lit(None).cast(f.dataType)).alias(f.name)

    def rows(self, source: DataFrame, *carried: str) -> DataFrame:
        """Alternate key and attributes of source rows, in their types; what can't be read is null.  carried: columns kept as they are."""
        have = set(source.columns)
        return source.select(F.expr(self.read.get(self.alternate, self.alternate)).alias(self.alternate), *(self._column(f, have) for f in self.schema), *carried)


_PERSON = "contact_name string, geography_key int"
DIMENSIONS = {
    d.table: d
    for d in (
        Dimension("dim_customer", "customer_key", "customer_alternate_key", "company_name string, contact_title string, phone string, fax string", _PERSON, {"customer_alternate_key": "rtrim(customer_id)"}),
        Dimension(
            "dim_products", "product_key", "product_alternate_key", "product_name string, quantity_per_unit string, units_in_stock smallint, units_on_order smallint, reorder_level smallint",
            "unit_price decimal(19,4), discontinued int, category_name string, supplier_key int", {"product_alternate_key": "product_id"},
        ),
        Dimension(
            "dim_employees", "employee_key", "employee_alternate_key",
            "first_name string, last_name string, home_phone string, extension string, title_of_courtesy string, photo_path string, birth_date date, hire_date date, full_name string",
            "title string, notes string, reports_to int, geography_key int, parent_employee_key int",
            {"employee_alternate_key": "employee_id", "full_name": "trim(concat_ws(' ', first_name, last_name))"},
        ),
        Dimension("dim_suppliers", "supplier_key", "supplier_alternate_key", "company_name string, phone string, fax string, home_page string", f"{_PERSON}, contact_title string", {"supplier_alternate_key": "supplier_id"}),
        Dimension("dim_territories", "territory_key", "territory_alternate_key", "territory_description string", "region_description string", {"territory_alternate_key": "territory_id"}),
        Dimension("dim_shippers", "shipper_key", "shipper_alternate_key", "company_name string, phone string", read={"shipper_alternate_key": "shipper_id"}),
    )
}
