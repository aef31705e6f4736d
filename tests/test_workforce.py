import datetime as dt

from pagetrail.plans import workforce as W

D = dt.date


def _tables(spark):
    employees = spark.createDataFrame(
        [(1, D(1960, 1, 1), "Ann", "A", "F", D(1990, 1, 1)), (2, D(1961, 1, 1), "Bob", "B", "M", D(1991, 1, 1)),
         (3, D(1962, 1, 1), "Cy", "C", "M", D(1992, 1, 1))],
        "emp_no long, birth_date date, first_name string, last_name string, gender string, hire_date date",
    )
    departments = spark.createDataFrame([("d001", "Sales"), ("d002", "Ops")], "dept_no string, dept_name string")
    dept_emp = spark.createDataFrame(
        [(1, "d001", D(1995, 1, 1), D(9999, 1, 1)), (2, "d001", D(1995, 1, 1), D(9999, 1, 1)),
         (3, "d002", D(1995, 1, 1), D(9999, 1, 1)), (4, "d001", D(1995, 1, 1), D(9999, 1, 1))],
        "emp_no long, dept_no string, from_date date, to_date date",
    )
    dept_manager = spark.createDataFrame(
        [("d001", 2, D(1996, 1, 1), D(9999, 1, 1))], "dept_no string, emp_no long, from_date date, to_date date"
    )
    return employees, departments, dept_emp, dept_manager


def test_flatten_and_department_queries(spark):
    employees, departments, dept_emp, dept_manager = _tables(spark)
    flat = W.flatten_dept_emp(dept_emp, employees, departments, dept_manager)
    rows = {r.dept_emp: r for r in flat.collect()}
    assert set(rows) == {"d001_1", "d001_2", "d002_3", "d001_4"}
    assert rows["d001_2"].dm_from_date == D(1996, 1, 1) and rows["d001_1"].dm_from_date is None
    assert rows["d001_4"].emp_no is None  # no employee row: left join keeps the key
    assert W.flat_count(flat).collect()[0].row_count == 4
    keyed = W.load_dept_emp(flat)
    members = sorted(r.emp_no for r in W.department_members(keyed, dept_emp, "d001").collect())
    assert members == [1, 2]  # employee cells of d001_4 are absent -> skipped
    managers = [r.first_name for r in W.department_managers(keyed, dept_emp, "d001").collect()]
    assert managers == ["Bob"]
    tables = (dept_emp, employees, departments, dept_manager)
    assert sorted(r.emp_no for r in W.department_from_tables(*tables, "d001").collect()) == [1, 2]
    assert [r.first_name for r in W.department_from_tables(*tables, "d001", managers=True).collect()] == ["Bob"]


def test_manager_dates_survive_reput_without_them(spark):
    employees, departments, dept_emp, dept_manager = _tables(spark)
    flat = W.flatten_dept_emp(dept_emp, employees, departments, dept_manager)
    keyed = W.load_dept_emp(flat)
    no_mgr = W.flatten_dept_emp(dept_emp, employees, departments, dept_manager.limit(0))
    again = W.load_dept_emp(no_mgr, target=keyed)
    row = again.where("row_key = 'd001_2'").collect()[0]
    assert row.dm_from_date == D(1996, 1, 1)


def test_payroll_strict_bounds_and_empty(spark):
    sal = spark.createDataFrame(
        [(1, 100, D(1999, 1, 1), D(2000, 1, 1)),   # starts on the date -> out
         (2, 200, D(1998, 1, 1), D(1999, 1, 1)),   # ends on the date -> out
         (3, 300, D(1998, 6, 1), D(1999, 6, 1)),   # in force
         (4, 400, D(1998, 1, 1), D(9999, 1, 1))],  # in force
        "emp_no long, salary long, from_date date, to_date date",
    )
    keyed = W.load_salaries(sal)
    for k in (None, keyed):
        assert W.payroll_on(sal, "1999-01-01", k).collect()[0].total_salary == 700
        assert W.payroll_on(sal, "1900-01-01", k).collect()[0].total_salary == 0
    # a key whose salary cell is absent counts 0
    partial = keyed.where("row_key <> '4_1998-01-01'")
    assert W.payroll_on(sal, "1999-01-01", partial).collect()[0].total_salary == 300
    # a duplicated in-force row names its key twice
    dup = sal.union(sal.where("emp_no = 3"))
    assert W.payroll_on(dup, "1999-01-01").collect()[0].total_salary == 1000
    assert W.payroll_on(dup, "1999-01-01", W.load_salaries(dup)).collect()[0].total_salary == 1000


def test_titles_of_employee(spark):
    titles = spark.createDataFrame(
        [(82, "Engineer", D(1995, 1, 1), D(1999, 1, 1)), (82, "Senior", D(1999, 1, 1), D(9999, 1, 1)),
         (820, "Other", D(1995, 1, 1), D(9999, 1, 1)), (7, "Staff", D(1997, 1, 1), D(9999, 1, 1))],
        "emp_no long, title string, from_date date, to_date date",
    )
    keyed = W.load_titles(titles)
    assert sorted(r.title for r in W.titles_of(keyed, titles, 82).collect()) == ["Engineer", "Senior"]
    assert sorted(r.title for r in W.titles_of_from_table(titles, 82).collect()) == ["Engineer", "Senior"]
    assert sorted(r.from_date for r in W.title_dates(titles).collect()) == [D(1995, 1, 1), D(1997, 1, 1), D(1999, 1, 1)]
