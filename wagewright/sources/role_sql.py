"""The role views of ``roles.py`` written as SQL for the result checks."""

GRADE_SQL = """SELECT * FROM (VALUES
  (1,'G1',CAST(-1e12 AS DECIMAL(18,2)),CAST(25000 AS DECIMAL(18,2)),CAST(10 AS DECIMAL(5,2)),CAST(10 AS DECIMAL(5,2)),CAST(500 AS DECIMAL(18,2))),
  (2,'G2',25000,40000,20,15,800),(3,'G3',40000,60000,30,17,1200),(4,'G4',60000,85000,35,18,1500),
  (5,'G5',85000,120000,38,20,2000),(6,'G6',120000,160000,40,22,2500),(7,'G7',160000,200000,42,23,3000),
  (8,'G8',200000,250000,44,24,3500),(9,'G9',250000,1000000000000,45,25,4000)
) AS g(grade_id, grade_code, basic_min, basic_max, hra_pct, da_pct, ta_flat)"""

ROLE_SQL = {
    "r_emp": """SELECT c_custkey AS emp_id, printf('EMP%03d', c_custkey) AS emp_code, c_name AS name,
      lower(replace(c_name,'#','.')) || '@company.example' AS email,
      CAST(c_nationkey AS BIGINT) AS dept_id, n_name AS dept_name, r_name AS location, c_mktsegment AS gender,
      CAST(c_acctbal AS DECIMAL(18,2)) AS basic, CAST(c_acctbal AS DECIMAL(18,2))*25 AS pay_basic,
      CASE WHEN c_acctbal<0 THEN 'Inactive' ELSE 'Active' END AS status
      FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "r_grade": GRADE_SQL,
    "r_dept": """SELECT CAST(n_nationkey AS BIGINT) AS dept_id, n_name AS dept_name, r_name AS location, manager_id, budget
      FROM nation JOIN region ON n_regionkey=r_regionkey
      LEFT JOIN (SELECT c_nationkey, min(c_custkey) AS manager_id FROM customer GROUP BY 1) m ON c_nationkey=n_nationkey
      LEFT JOIN (SELECT s_nationkey, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS budget FROM supplier GROUP BY 1) b ON s_nationkey=n_nationkey""",
    "r_ord": """SELECT o_orderkey AS payroll_id, o_custkey AS emp_id, year(o_orderdate) AS pay_year, month(o_orderdate) AS pay_month,
      strftime(o_orderdate,'%Y-%m') AS period, o_orderdate AS pay_date, o_orderpriority AS priority,
      CAST(o_totalprice AS DECIMAL(18,2)) AS gross,
      CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'P' THEN 'Approved' ELSE 'Draft' END AS status FROM orders""",
    "r_pay": """SELECT o.*, coalesce(net,0) AS net, coalesce(tds,0) AS tds, coalesce(n_lines,0) AS days_present, 7 AS working_days,
      round(least(gross, CAST(15000 AS DECIMAL(18,2)))*CAST(0.12 AS DECIMAL(4,2)),2) AS pf,
      CASE WHEN gross<=21000 THEN round(gross*CAST(0.0325 AS DECIMAL(6,4)),2) ELSE CAST(0 AS DECIMAL(18,2)) END AS esi_er,
      round(least(gross, CAST(15000 AS DECIMAL(18,2)))*CAST(0.12 AS DECIMAL(4,2)),2)+coalesce(tds,0) AS deductions
      FROM r_ord o LEFT JOIN (SELECT l_orderkey,
        round(sum(CAST(l_extendedprice AS DECIMAL(18,2))*(1-CAST(l_discount AS DECIMAL(4,2)))),2) AS net,
        round(sum(CAST(l_extendedprice AS DECIMAL(18,2))*CAST(l_tax AS DECIMAL(4,2))),2) AS tds,
        count(*) AS n_lines FROM lineitem GROUP BY 1) l ON l_orderkey=payroll_id""",
    "r_wide": """SELECT p.*, emp_code, name, dept_id, dept_name, location, gender, basic, pay_basic, e.status AS emp_status
      FROM r_pay p JOIN r_emp e ON p.emp_id=e.emp_id""",
    "r_att": """SELECT event_id AS att_id, user_id AS emp_id, CAST(ts AS DATE) AS att_date, ts, CAST(value AS DECIMAL(18,2)) AS hours,
      CASE event_type WHEN 'view' THEN 'Present' WHEN 'error' THEN 'Absent' WHEN 'click' THEN 'Half-Day'
        WHEN 'signup' THEN 'On-Leave' ELSE 'Holiday' END AS status FROM events""",
    "r_loan": """SELECT l_orderkey AS loan_key, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS part_key, l_suppkey AS supp_key, o_custkey AS emp_id,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
      round(CAST(l_extendedprice AS DECIMAL(18,2))*(1-CAST(l_discount AS DECIMAL(4,2))),2) AS outstanding,
      CAST(l_quantity AS BIGINT) AS total_emis, CAST(floor(l_quantity*l_discount) AS BIGINT) AS emis_paid,
      round(CAST(l_extendedprice/l_quantity AS DECIMAL(28,8)),2) AS emi,
      CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Pending' END AS status,
      l_shipdate AS loan_date, l_returnflag AS purpose FROM lineitem JOIN orders ON l_orderkey=o_orderkey""",
    "r_leave": """SELECT o_orderkey AS leave_id, o_custkey AS emp_id, CAST(o_orderdate AS DATE) AS from_date, to_date,
      o_orderpriority AS leave_type, CASE o_orderstatus WHEN 'O' THEN 'Pending' WHEN 'F' THEN 'Approved' ELSE 'Rejected' END AS status
      FROM orders JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS to_date FROM lineitem GROUP BY 1) l ON l_orderkey=o_orderkey""",
    "r_rev": """SELECT * FROM (SELECT o_orderkey AS revision_id, o_custkey AS emp_id, o_orderdate AS effective,
      lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS old_basic, CAST(o_totalprice AS DECIMAL(18,2)) AS new_basic,
      o_orderpriority AS reason FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE old_basic IS NOT NULL""",
    "r_dirty_emp": """SELECT c_custkey AS emp_id, CASE WHEN c_custkey%11=0 THEN '' ELSE printf('EMP%03d', c_custkey) END AS emp_code,
      split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name, n_name AS dept,
      CASE WHEN c_custkey%7=0 THEN '' WHEN c_custkey%17=0 THEN 'n/a' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS basic_salary,
      CASE WHEN c_custkey%13=0 THEN '' WHEN c_acctbal<0 THEN 'Inactive' ELSE 'Active' END AS status,
      CASE WHEN c_custkey%19=0 THEN '' ELSE '1985-06-15' END AS dob,
      CASE WHEN c_custkey%5=0 THEN '' ELSE lower(replace(c_name,'#','.')) || '@company.example' END AS email, c_mktsegment AS gender
      FROM customer JOIN nation ON c_nationkey=n_nationkey""",
    "r_dirty_pay": """SELECT payroll_id, CAST(emp_id AS VARCHAR) AS emp_id, period, '7' AS working_days,
      CASE WHEN payroll_id%23=0 THEN '' ELSE CAST(days_present AS VARCHAR) END AS days_present,
      CASE WHEN payroll_id%17=0 THEN 'n/a' ELSE CAST(CAST(round(gross*CAST(0.5 AS DECIMAL(4,2)),2) AS DECIMAL(18,2)) AS VARCHAR) END AS basic,
      CASE WHEN payroll_id%7=0 THEN '' ELSE CAST(gross AS VARCHAR) END AS gross,
      CAST(CAST(pf AS DECIMAL(18,2)) AS VARCHAR) AS pf,
      CASE WHEN payroll_id%29=0 THEN '' ELSE CAST(CAST(tds AS DECIMAL(18,2)) AS VARCHAR) END AS tds,
      CASE WHEN payroll_id%31=0 THEN '' ELSE CAST(CAST(net AS DECIMAL(18,2)) AS VARCHAR) END AS net, status FROM r_pay""",
    "r_bad_pay": """SELECT payroll_id, emp_id, CASE WHEN payroll_id%11=0 THEN '' ELSE printf('EMP%03d', emp_id) END AS emp_code, period, pay_year, pay_month,
      CASE WHEN payroll_id%97=0 THEN -net WHEN payroll_id%101=0 THEN gross+1 ELSE least(net,gross) END AS net,
      CASE WHEN payroll_id%103=0 THEN CAST(0 AS DECIMAL(18,2)) ELSE gross END AS gross,
      CASE WHEN payroll_id%7=0 THEN NULL ELSE round(gross*CAST(0.6 AS DECIMAL(4,2)),2) END AS basic,
      CASE WHEN payroll_id%13=0 THEN '' ELSE status END AS status, tds, pf, deductions, days_present, working_days FROM r_pay""",
}


def r(expr: str, digits: int = 2) -> str:
    """The SQL twin of ``numeric.rounded``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,{8 if digits < 6 else 12})),{digits}) AS DOUBLE)"


def d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def avg(expr: str) -> str:
    return f"(CAST(sum({expr}) AS DOUBLE)/count({expr}))"


def pct(a: str, b: str, scale: float = 100.0) -> str:
    return f"coalesce(CAST({a} AS DOUBLE)/nullif(CAST({b} AS DOUBLE),0)*{scale},0)"


def std(x: str, sample: bool = False) -> str:
    s, s2, n = f"CAST(sum({x}) AS DOUBLE)", f"CAST(sum({x}*{x}) AS DOUBLE)", f"CAST(count({x}) AS DOUBLE)"
    if sample:
        return f"coalesce(sqrt(greatest({s2}-{s}*{s}/{n},0)/nullif({n}-1,0)),0)"
    return f"sqrt(greatest({s2}-{s}*{s}/{n},0)/{n})"
