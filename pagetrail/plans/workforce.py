"""Workforce data: flatten relational tables into keyed tables and query them.

Keyed tables:

* dept_emp — key ``dept_no_emp_no``; families cf_info (de_from_date,
  de_to_date), cf_employee (emp_no, birth_date, first_name, last_name,
  gender, hire_date), cf_department (dept_no, dept_name), cf_manager
  (dm_from_date, dm_to_date; absent for non-managers).
* salaries — key ``emp_no_from_date``; cells from_date, to_date, salary, emp_no.
* titles — key ``emp_no_from_date``; cells from_date, to_date, title, emp_no.

Joins run in Spark on the executors; the planner broadcasts small sides
(departments, managers, key lists) by their size in bytes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.keys import join_key
from pagetrail.operators.keyed import keyed_upsert, multi_get, prefix_scan
from pagetrail.schemas import DEPT_EMP_FAMILIES, ROW_KEY, family_cells

DEPT_EMP_CELLS = family_cells(DEPT_EMP_FAMILIES)
PERSON_COLUMNS = ["emp_no", "birth_date", "first_name", "last_name", "gender", "hire_date"]


def flatten_dept_emp(
    dept_emp: DataFrame, employees: DataFrame, departments: DataFrame, dept_manager: DataFrame
) -> DataFrame:
    """``dept_emp`` left-joined with employees, departments and managers.

    Columns: dept_emp (the ``dept_no_emp_no`` key), de_from_date, de_to_date,
    emp_no, birth_date, first_name, last_name, gender, hire_date, dept_no,
    dept_name, dm_from_date, dm_to_date. Person and department columns come
    from the joined tables (null when the match is missing).
    """
    de = dept_emp.selectExpr(
        "emp_no AS de_emp_no", "dept_no AS de_dept_no", "from_date AS de_from_date", "to_date AS de_to_date"
    )
    e = employees.select(*PERSON_COLUMNS)
    d = departments.select("dept_no", "dept_name")
    m = dept_manager.selectExpr(
        "dept_no AS dm_dept_no", "emp_no AS dm_emp_no", "from_date AS dm_from_date", "to_date AS dm_to_date"
    )
    j = de.join(e, F.expr("de_emp_no = emp_no"), "left")
    j = j.join(d, F.expr("de_dept_no = dept_no"), "left")
    j = j.join(m, F.expr("de_dept_no = dm_dept_no AND de_emp_no = dm_emp_no"), "left")
    return j.selectExpr(
        "concat(CAST(de_dept_no AS STRING), '_', CAST(de_emp_no AS STRING)) AS dept_emp",
        "de_from_date",
        "de_to_date",
        *PERSON_COLUMNS,
        "dept_no",
        "dept_name",
        "dm_from_date",
        "dm_to_date",
    )


def load_dept_emp(flat: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Keyed dept_emp table from the flattened rows.

    Absent manager dates are not written, so a re-put of a row without
    manager dates keeps the dates already stored; ``flat`` may also leave out
    cells altogether. Of several puts of a key the one with the greatest
    cells, in the order of the families, wins.
    """
    puts = flat.withColumnRenamed("dept_emp", ROW_KEY)
    return keyed_upsert(puts, DEPT_EMP_CELLS, [c for c in DEPT_EMP_CELLS if c in puts.columns], target=target)


def flat_count(flat: DataFrame) -> DataFrame:
    """Number of flattened rows (one column ``row_count``)."""
    return flat.agg(F.count(F.lit(1)).alias("row_count"))


def _dated_puts(table: DataFrame, value: str) -> DataFrame:
    return table.select(
        join_key("emp_no", "from_date").alias(ROW_KEY), "from_date", "to_date", value, "emp_no"
    )


def _load_dated(table: DataFrame, value: str, target: DataFrame | None) -> DataFrame:
    """Keyed table of ``emp_no_from_date``; of equal keys the later to_date wins, then the greater value.

    Without a target the puts are merged by the typed columns, by which they
    often lie together already, and the text key is made last.
    """
    cells = ["from_date", "to_date", value, "emp_no"]
    if target is not None:
        return keyed_upsert(_dated_puts(table, value), cells, ["to_date", value], target=target)
    puts = table.select("emp_no", "from_date", "to_date", value)
    merged = keyed_upsert(puts, ["to_date", value], ["to_date", value], key=["emp_no", "from_date"])
    return merged.select(join_key("emp_no", "from_date").alias(ROW_KEY), *cells)


def load_salaries(salaries: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Keyed salaries: ``emp_no_from_date`` -> from_date, to_date, salary, emp_no."""
    return _load_dated(salaries, "salary", target)


def load_titles(titles: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Keyed titles: ``emp_no_from_date`` -> from_date, to_date, title, emp_no."""
    return _load_dated(titles, "title", target)


def _department_keys(dept_emp: DataFrame, dept_no: str) -> DataFrame:
    return dept_emp.where(F.col("dept_no") == F.lit(dept_no)).select(
        join_key("dept_no", "emp_no").alias(ROW_KEY)
    )


def department_members(keyed_dept_emp: DataFrame, dept_emp: DataFrame, dept_no: str) -> DataFrame:
    """Employees of a department (emp_no, birth_date, first_name, last_name, gender, hire_date).

    Keys come from ``dept_emp``; keys whose employee cells are absent are
    skipped. Every key of the department starts with ``dept_no_``, so the
    keyed table is first narrowed to that key range (pushed below its load
    aggregation), then joined with the key list.
    """
    keys = _department_keys(dept_emp, dept_no)
    table = prefix_scan(keyed_dept_emp, f"{dept_no}_")
    got = multi_get(table, keys, PERSON_COLUMNS)
    return got.where(F.col("emp_no").isNotNull()).select(*PERSON_COLUMNS)


def department_managers(keyed_dept_emp: DataFrame, dept_emp: DataFrame, dept_no: str) -> DataFrame:
    """Managers of a department: members whose manager cells exist."""
    keys = _department_keys(dept_emp, dept_no)
    table = prefix_scan(keyed_dept_emp, f"{dept_no}_")
    got = multi_get(table, keys, [*PERSON_COLUMNS, "dm_from_date"])
    return got.where(F.col("dm_from_date").isNotNull()).select(*PERSON_COLUMNS)


def department_from_tables(
    dept_emp: DataFrame,
    employees: DataFrame,
    departments: DataFrame,
    dept_manager: DataFrame,
    dept_no: str,
    managers: bool = False,
) -> DataFrame:
    """Members (or managers) of a department, with the keyed dept_emp table
    loaded from these same tables.

    A key ``dept_no_emp_no`` of the department comes only from dept_emp rows
    of that department (employee numbers are numeric), so only those rows are
    flattened and loaded; ``dept_no = d`` reaches the dept_emp scan.
    """
    mine = dept_emp.where(F.col("dept_no") == F.lit(dept_no))
    keyed = load_dept_emp(flatten_dept_emp(mine, employees, departments, dept_manager))
    fn = department_managers if managers else department_members
    return fn(keyed, dept_emp, dept_no)


def _as_date(d: str | dt.date) -> F.Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def payroll_on(
    salaries: DataFrame, on: str | dt.date, keyed_salaries: DataFrame | None = None
) -> DataFrame:
    """Sum of the salaries in force on a date (one row ``total_salary``).

    In force means ``from_date < on < to_date`` (both strict). Every salary
    row in force names a key; the salary stored under that key is added
    once per such row, an absent salary cell counts 0, and no row at all
    gives 0.

    With ``keyed_salaries=None`` the keyed table is the one loaded from these
    same rows, and the look-up folds into the load: one aggregation per key
    yields the stored salary and the number of in-force rows naming the key,
    so no join is needed. With a stored keyed table the in-force keys are
    left-joined to it (shuffled on the key; AQE splits skewed partitions).
    """
    d = _as_date(on)
    in_force = (F.col("from_date") < d) & (F.col("to_date") > d)
    if keyed_salaries is None:
        puts = salaries.select("emp_no", "from_date", "to_date", "salary", in_force.alias("__in_force"))
        per_key = keyed_upsert(
            puts, ["salary"], ["to_date", "salary"], key=["emp_no", "from_date"],
            count_as="n_in_force", count_where=F.col("__in_force"),
        )
        amount = F.coalesce(F.col("salary"), F.lit(0)) * F.col("n_in_force")
        got = per_key.where(F.col("n_in_force") > 0).select(amount.alias("amount"))
    else:
        keys = salaries.where(in_force).select(join_key("emp_no", "from_date").alias(ROW_KEY))
        got = multi_get(keyed_salaries, keys, ["salary"], keep_missing=True)
        got = got.select(F.coalesce(F.col("salary"), F.lit(0)).alias("amount"))
    return got.agg(F.coalesce(F.sum("amount"), F.lit(0)).cast("long").alias("total_salary"))


def title_dates(titles: DataFrame) -> DataFrame:
    """Distinct start dates of titles (``from_date``)."""
    return titles.select("from_date").distinct()


def titles_of(keyed_titles: DataFrame, titles: DataFrame, emp_no: int) -> DataFrame:
    """Every title an employee has held (``title``), order not significant.

    Keys are ``emp_no`` joined with every distinct title start date; keys
    without a title cell are skipped. The date list is bounded by the
    calendar, and the table is first narrowed to the ``emp_no_`` key range.
    """
    keys = title_dates(titles).select(join_key(F.lit(emp_no), "from_date").alias(ROW_KEY))
    table = prefix_scan(keyed_titles, f"{emp_no}_")
    got = multi_get(table, keys, ["title"])
    return got.where(F.col("title").isNotNull()).select("title")


def titles_of_from_table(titles: DataFrame, emp_no: int) -> DataFrame:
    """``titles_of`` on the keyed titles loaded from ``titles``.

    Keys ``emp_no_...`` come exactly from that employee's title rows (the
    key is the number, "_", then a date), so the rows are narrowed to the
    employee before the load; the predicate reaches the scan.
    """
    mine = titles.where(F.col("emp_no") == F.lit(emp_no))
    return titles_of(load_titles(mine), titles, emp_no)
