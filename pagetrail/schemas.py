"""Schemas of the page-view log, the workforce tables and the keyed tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The page-view log layout (column order matters for the
# header-less tab-separated file).
PAGEVIEW_SCHEMA = T.StructType(
    [
        T.StructField("timeCreate", T.TimestampType(), True),
        T.StructField("cookieCreate", T.TimestampType(), True),
        T.StructField("browserCode", T.IntegerType(), True),
        T.StructField("browserVer", T.StringType(), True),
        T.StructField("osCode", T.IntegerType(), True),
        T.StructField("osVer", T.StringType(), True),
        T.StructField("ip", T.LongType(), True),
        T.StructField("locId", T.IntegerType(), True),
        T.StructField("domain", T.StringType(), True),
        T.StructField("siteId", T.IntegerType(), True),
        T.StructField("cId", T.IntegerType(), True),
        T.StructField("path", T.StringType(), True),
        T.StructField("referer", T.StringType(), True),
        T.StructField("guid", T.LongType(), True),
        T.StructField("flashVersion", T.StringType(), True),
        T.StructField("jre", T.StringType(), True),
        T.StructField("sr", T.StringType(), True),
        T.StructField("sc", T.StringType(), True),
        T.StructField("geographic", T.IntegerType(), True),
        T.StructField("category", T.IntegerType(), True),
    ]
)

PAGEVIEW_COLUMNS = [f.name for f in PAGEVIEW_SCHEMA.fields]
PAGEVIEW_TIME_COLUMNS = ["timeCreate", "cookieCreate"]

# Workforce tables (dates typed as dates, ids as bigint).
EMPLOYEES_SCHEMA = T.StructType(
    [
        T.StructField("emp_no", T.LongType(), True),
        T.StructField("birth_date", T.DateType(), True),
        T.StructField("first_name", T.StringType(), True),
        T.StructField("last_name", T.StringType(), True),
        T.StructField("gender", T.StringType(), True),
        T.StructField("hire_date", T.DateType(), True),
    ]
)
DEPARTMENTS_SCHEMA = T.StructType(
    [T.StructField("dept_no", T.StringType(), True), T.StructField("dept_name", T.StringType(), True)]
)
DEPT_EMP_SCHEMA = T.StructType(
    [
        T.StructField("emp_no", T.LongType(), True),
        T.StructField("dept_no", T.StringType(), True),
        T.StructField("from_date", T.DateType(), True),
        T.StructField("to_date", T.DateType(), True),
    ]
)
DEPT_MANAGER_SCHEMA = T.StructType(
    [
        T.StructField("dept_no", T.StringType(), True),
        T.StructField("emp_no", T.LongType(), True),
        T.StructField("from_date", T.DateType(), True),
        T.StructField("to_date", T.DateType(), True),
    ]
)
SALARIES_SCHEMA = T.StructType(
    [
        T.StructField("emp_no", T.LongType(), True),
        T.StructField("salary", T.LongType(), True),
        T.StructField("from_date", T.DateType(), True),
        T.StructField("to_date", T.DateType(), True),
    ]
)
TITLES_SCHEMA = T.StructType(
    [
        T.StructField("emp_no", T.LongType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("from_date", T.DateType(), True),
        T.StructField("to_date", T.DateType(), True),
    ]
)

# Keyed (wide-column) tables: row key -> family -> cells. A keyed table is a
# DataFrame with one ``row_key`` column and one flat column per cell; the
# family map documents which cells belong together and lets callers ask for
# ``family:cell`` names.
ROW_KEY = "row_key"

PAGEVIEW_FAMILIES = {"cf": list(PAGEVIEW_COLUMNS)}

DEPT_EMP_FAMILIES = {
    "cf_info": ["de_from_date", "de_to_date"],
    "cf_employee": ["emp_no", "birth_date", "first_name", "last_name", "gender", "hire_date"],
    "cf_department": ["dept_no", "dept_name"],
    "cf_manager": ["dm_from_date", "dm_to_date"],
}

SALARIES_FAMILIES = {"cf_info": ["from_date", "to_date", "salary", "emp_no"]}
TITLES_FAMILIES = {"cf_info": ["from_date", "to_date", "title", "emp_no"]}


def family_cells(families: dict[str, list[str]]) -> list[str]:
    """Flat cell list of a family map, in declaration order."""
    return [c for cells in families.values() for c in cells]


def resolve_cell(families: dict[str, list[str]], name: str) -> str:
    """Map ``family:cell`` (or a bare cell name) to its flat column name."""
    if ":" not in name:
        return name
    family, cell = name.split(":", 1)
    if cell not in families.get(family, []):
        raise KeyError(f"no cell {cell!r} in family {family!r}")
    return cell
