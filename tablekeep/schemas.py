"""Declared schemas: the loan transactions, the bronze table over them, and the people files."""

from __future__ import annotations

from pyspark.sql.types import DataType, FloatType, LongType, StringType, StructField, StructType, TimestampType

# The 23 columns of the transaction table, in table order (`imit_amount` is spelled so in the data).
TRANSACTION_COLUMNS = """
acc_fv_change_before_taxes float
accounting_treatment_id float
accrued_interest float
arrears_balance float
balance float
base_rate string
behavioral_curve_id float
cost_center_code string
count float
country_code string
dte string
encumbrance_type string
end_date string
first_payment_date string
guarantee_scheme string
id float
imit_amount float
last_payment_date string
minimum_balance_eur float
next_payment_date string
purpose string
status string
type string
"""

_TYPES: dict[str, DataType] = {"float": FloatType(), "string": StringType(), "long": LongType()}


def from_lines(text: str) -> StructType:
    """One nullable field per ``name type`` line."""
    pairs = (line.split() for line in text.strip().splitlines())
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


def all_strings(names: str) -> StructType:
    """An all-string schema from space-separated names."""
    return StructType([StructField(name, StringType(), True) for name in names.split()])


def with_provenance(schema: StructType) -> StructType:
    return StructType(
        [
            *schema.fields,
            StructField("source_file", StringType(), True),
            StructField("processing_time", TimestampType(), True),
        ]
    )


def columns_ddl(schema: StructType) -> str:
    """The schema as the column list of a CREATE TABLE, comments included."""

    def column(f: StructField) -> str:
        comment = (f.metadata or {}).get("comment")
        told = " COMMENT '" + comment.replace("\\", "\\\\").replace("'", "\\'") + "'" if comment else ""
        return f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}{told}"

    return ", ".join(map(column, schema.fields))


TRANSACTIONS = from_lines(TRANSACTION_COLUMNS)
BRONZE_TRANSACTIONS = with_provenance(TRANSACTIONS)
PEOPLE = from_lines("name string\nage long")
