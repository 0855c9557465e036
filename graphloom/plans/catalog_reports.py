"""Whole reports over the driver's tables, value by value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators.ordering import written
from graphloom.plans import reports, team_reports
from graphloom.plans.catalog import query, t

#: Suppliers as employees: two names of few kinds, a supervisor text, a profile.
FIRST = "CASE s_suppkey % 6 WHEN 0 THEN 'Ann' WHEN 1 THEN 'Bo' WHEN 2 THEN 'Cy' WHEN 3 THEN 'Dee' WHEN 4 THEN 'Ed' ELSE NULL END"
LAST = "concat('Name', CAST(s_suppkey % 35 AS VARCHAR(20)))"
EMPLOYEES = {
    "emp_id": "s_suppkey",
    "first_name": FIRST,
    "last_name": LAST,
    "emp_name": f"concat({LAST}, ', ', coalesce({FIRST}, 'Zed'))",
    "supervisors": "CASE WHEN s_suppkey % 9 <> 4 THEN concat('Head ', CAST(s_suppkey % 5 AS VARCHAR(20)), ', Lead ', CAST(s_suppkey % 4 AS VARCHAR(20))) END",
    "profile_code": "CASE WHEN s_suppkey % 7 = 3 THEN 'office' ELSE 'clinic' END",
}
TEAMS = [("Head 1", "north"), ("Lead 2", "south"), ("Head 3", "west")]
TEAM_SQL = "CASE WHEN emp_id = 8 THEN 'by hand' WHEN contains(supervisors, 'Head 1') THEN 'north' WHEN contains(supervisors, 'Lead 2') THEN 'south' WHEN contains(supervisors, 'Head 3') THEN 'west' ELSE 'rest' END"
STAFF = "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN concat('A Name', CAST(c_custkey % 40 AS VARCHAR(20)), ' (CSW), B Name', CAST(c_custkey % 37 AS VARCHAR(20))) ELSE concat('C Name', CAST(c_custkey % 50 AS VARCHAR(20)), ' (x)') END"
TEAMS_SQL = f"""
    employees AS (SELECT {', '.join(f'{e} AS {c}' for c, e in EMPLOYEES.items())} FROM supplier),
    teams AS (SELECT *, {TEAM_SQL} AS team FROM employees WHERE supervisors IS NOT NULL AND profile_code = 'clinic')"""


def employees(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "supplier").selectExpr(*(f"{e} AS {c}" for c, e in EMPLOYEES.items()))


def teams(spark: SparkSession, d: str) -> DataFrame:
    return reports.clinical_teams(employees(spark, d), "clinic", {"8": "by hand"}, TEAMS, "rest")


@query(f"WITH {TEAMS_SQL} SELECT team, emp_id, emp_name, profile_code FROM teams")
def clinical_team_rows(spark: SparkSession, d: str) -> DataFrame:
    """Employees of the profile with supervisors, by hand, by the first head named, or the rest."""
    return teams(spark, d).select("team", "emp_id", "emp_name", "profile_code")


@query(f"""
    WITH {TEAMS_SQL},
    people AS (SELECT *, coalesce(substr(first_name, 1, 1), 'Z') || ' ' || last_name AS staff_name FROM teams),
    lookup AS (SELECT staff_name, max(emp_id) AS emp_id FROM people GROUP BY 1),
    named AS (SELECT c_custkey AS client_id, unnest(string_split(staff, ', ')) AS name FROM (SELECT c_custkey, {STAFF} AS staff FROM customer)),
    placed AS (SELECT DISTINCT client_id, team, emp_name AS csw_name, emp_id FROM named JOIN lookup ON staff_name = trim(regexp_replace(name, '\\([^)]*\\)', '', 'g')) JOIN people USING (emp_id))
    SELECT client_id, team, csw_name, emp_id FROM placed UNION ALL SELECT c_custkey, 'unassigned', NULL, NULL FROM customer WHERE c_custkey NOT IN (SELECT client_id FROM placed)
""")
def clinical_caseloads(spark: SparkSession, d: str) -> DataFrame:
    """Clients by the names of their primary staff, the others unassigned; a client that is in neither would be an error."""
    clients = t(spark, d, "customer").select(F.col("c_custkey").alias("client_id"), F.expr(STAFF).alias("primary_staff"))
    placed, unplaced = reports.caseloads(clients, teams(spark, d))
    none = unplaced.select("client_id", F.lit("unassigned").alias("team"), F.lit(None).cast("string").alias("csw_name"), F.lit(None).cast("bigint").alias("emp_id"))
    lost = reports.incomplete(clients, placed, unplaced)
    if not lost.isEmpty():
        raise RuntimeError("clients are neither placed nor unassigned")
    return placed.unionByName(none)


SERVICES = {
    "service_id": "l_orderkey * 10 + l_linenumber",
    "emp_id": "l_suppkey",
    "client_id": "o_custkey",
    "service_type": "o_orderpriority",
    "hours": "CAST((l_orderkey * 7 + l_linenumber * 13) % 75 AS BIGINT)",
    "units": "l_quantity",
    "approved": "l_returnflag <> 'R'",
    "approved_by": "CASE WHEN l_returnflag <> 'R' THEN concat('boss ', CAST(l_suppkey % 3 AS VARCHAR(20))) END",
    "recovery": "l_linestatus = 'F'",
}
SERVICES_SQL = f"services AS (SELECT {', '.join(f'{e} AS {c}' for c, e in SERVICES.items())} FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
RATE = "CASE WHEN s_suppkey % 4 <> 0 THEN concat('$', CAST(20 + s_suppkey % 10 AS VARCHAR(20)), '.50') END"


@query(f"""
    WITH {TEAMS_SQL}, {SERVICES_SQL},
    average AS (SELECT emp_id, sum(floor(units) / 4) / 900 AS per_day FROM services WHERE approved AND NOT recovery GROUP BY 1),
    met AS (
        SELECT s.*, team, emp_name, CASE WHEN NOT approved THEN 0 WHEN coalesce(per_day, 0) > 3.3 AND NOT recovery THEN 25.0 WHEN s.emp_id % 4 <> 0 THEN 20.5 + s.emp_id % 10 ELSE 0 END::DOUBLE AS base
        FROM services s JOIN teams ON teams.emp_id = s.emp_id LEFT JOIN average a ON a.emp_id = s.emp_id WHERE approved OR NOT recovery),
    paid AS (SELECT *, CASE WHEN hours <= 24 AND base > 0 THEN base + 2 ELSE base END AS rate FROM met)
    SELECT CASE WHEN recovery THEN 'recovery' WHEN approved THEN 'payable' ELSE 'unapproved' END AS report, team AS team_name, emp_name AS csw_name, client_id, service_id, service_type, CAST(floor(units) AS BIGINT) AS units, approved, approved_by,
           hours AS delay, CASE WHEN hours <= 24 THEN 'Early' WHEN hours <= 48 THEN 'On Time' ELSE 'Late' END AS timing, rate, floor(rate) * floor(units) / 4 AS rate_payable
    FROM paid
""")
def payroll_tables(spark: SparkSession, d: str) -> DataFrame:
    """Payable, unapproved and recovery services per team, line by line."""
    lines = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(*(f"{e} AS {c}" for c, e in SERVICES.items()))
    start = F.lit("2000-01-01").cast("timestamp")
    services = lines.select("*", start.alias("service_date"), (start + F.make_interval(hours=F.col("hours").cast("int"))).alias("transfer_date"), F.lit(None).cast("timestamp").alias("approved_date"))
    parts = [services.where(on).drop("recovery", "hours") for on in ("not recovery", "recovery")]
    rates = t(spark, d, "supplier").select(F.col("s_suppkey").alias("emp_id"), F.expr(RATE).alias("rate"))
    found = team_reports.payroll_tables(teams(spark, d).select("team", "emp_id", "emp_name"), *parts, rates, 900)
    return found.select("report", "team_name", "csw_name", "client_id", "service_id", "service_type", "units", "approved", "approved_by", "delay", "timing", "rate", "rate_payable")


CASELOAD = {
    "medicaid": "CAST(p_partkey % 1700 + 1000 AS VARCHAR(20))",
    "client_name": "CASE WHEN p_partkey % 31 = 0 THEN '' WHEN p_partkey % 2 = 0 THEN concat('Last', CAST(p_partkey % 90 AS VARCHAR(20)), ', First', CAST(p_partkey % 17 AS VARCHAR(20))) ELSE concat('first', CAST(p_partkey % 17 AS VARCHAR(20)), ' last', CAST(p_partkey % 90 AS VARCHAR(20))) END",
    "csw_name": "concat('name', CAST(p_partkey % 38 AS VARCHAR(20)), ', ', CASE p_partkey % 4 WHEN 0 THEN 'ann' WHEN 1 THEN 'BO' WHEN 2 THEN 'cy' ELSE 'Dee' END)",
    "supervisor_name": "CASE WHEN p_partkey % 29 <> 0 THEN concat(CASE p_partkey % 3 WHEN 0 THEN 'Ed' WHEN 1 THEN 'Ann' ELSE 'Bo' END, ' Name', CAST(p_partkey % 36 AS VARCHAR(20))) END",
    "seq": "p_partkey",
}
PATIENTS = {
    "client_id": "c_custkey",
    "medicaid": "CASE WHEN c_custkey % 11 <> 0 THEN concat('9', CAST(c_custkey % 1700 + 1000 AS VARCHAR(20)), CAST(c_custkey % 3 AS VARCHAR(20))) END",
    "first_name": "concat('First', CAST(c_custkey % 17 AS VARCHAR(20)))",
    "last_name": "CASE WHEN c_custkey % 41 <> 0 THEN concat('Last', CAST(c_custkey % 90 AS VARCHAR(20))) END",
}
MATCH_SQL = f"""
    WITH {TEAMS_SQL},
    given AS (SELECT {', '.join(f'{e} AS {c}' for c, e in CASELOAD.items())} FROM part),
    entries AS (SELECT medicaid, arg_max(client_name, seq) AS client_name, arg_max(csw_name, seq) AS csw_name, arg_max(supervisor_name, seq) AS supervisor_name FROM given WHERE client_name <> '' AND csw_name <> '' AND supervisor_name <> '' GROUP BY 1),
    patients AS (SELECT {', '.join(f'{e} AS {c}' for c, e in PATIENTS.items())} FROM customer),
    split AS (
        SELECT *, lower(CASE WHEN contains(client_name, ', ') THEN split_part(client_name, ', ', 2) ELSE split_part(client_name, ' ', 1) END) AS f, lower(CASE WHEN contains(client_name, ', ') THEN split_part(client_name, ', ', 1) ELSE split_part(client_name, ' ', 2) END) AS l FROM entries),
    found AS (
        SELECT s.medicaid, count(DISTINCT client_id) AS n, min(client_id) AS patient_id FROM split s LEFT JOIN patients p
            ON (p.medicaid IS NOT NULL AND contains(p.medicaid, s.medicaid) AND (lower(p.last_name) = l OR lower(p.first_name) = f)) OR (p.medicaid IS NULL AND lower(p.last_name) = l AND lower(p.first_name) = f)
        GROUP BY 1),
    people AS (SELECT lower(first_name) AS f, lower(last_name) AS l, count(DISTINCT emp_id) AS n, min(emp_id) AS id FROM employees WHERE first_name IS NOT NULL GROUP BY 1, 2),
    met AS (
        SELECT e.*, p.n AS patients, p.patient_id, coalesce(a.n, 0) AS providers, a.id AS provider_id, coalesce(b.n, 0) AS supervisors, b.id AS supervisor_id
        FROM entries e JOIN found p USING (medicaid)
        LEFT JOIN people a ON a.l = lower(split_part(csw_name, ', ', 1)) AND a.f = lower(split_part(csw_name, ', ', 2))
        LEFT JOIN people b ON b.f = lower(split_part(supervisor_name, ' ', 1)) AND b.l = lower(split_part(supervisor_name, ' ', 2))),
    judged AS (SELECT *, CASE WHEN patients <> 1 THEN 'clients' WHEN providers <> 1 OR supervisors <> 1 THEN 'providers' END AS kind, CASE WHEN patients <> 1 THEN patients WHEN providers <> 1 THEN providers ELSE supervisors END AS n FROM met)"""
SEEN_SQL = "(SELECT o_custkey AS patient_id, count(DISTINCT o_orderkey % 400) AS encounters, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 90 END) AS assessments FROM orders GROUP BY 1)"


def matched_caseload(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    given = t(spark, d, "part").selectExpr(*(f"{e} AS {c}" for c, e in CASELOAD.items()))
    patients = t(spark, d, "customer").selectExpr(*(f"{e} AS {c}" for c, e in PATIENTS.items()))
    services = t(spark, d, "orders").select(F.col("o_custkey").alias("patient_id"), (F.col("o_orderkey") % 400).alias("service_id"), F.col("o_orderkey").alias("seq"), "o_orderstatus")
    assessed = services.where("o_orderstatus = 'F'").withColumn("service_id", F.col("seq") % 90)
    return team_reports.caseload_report(given, patients, employees(spark, d), services, assessed)


@query(f"""
    {MATCH_SQL}
    SELECT CASE WHEN kind IS NULL THEN 'matched' WHEN n = 0 THEN 'missing' ELSE 'duplicate' END AS outcome, kind AS matched_type, CASE WHEN kind IS NULL THEN supervisor_id END AS supervisor_id, CASE WHEN kind IS NULL THEN provider_id END AS provider_id,
           csw_name, client_name, CASE WHEN kind IS NULL THEN j.patient_id END AS patient_id, CASE WHEN kind IS NULL THEN coalesce(encounters, 0) END AS encounters, CASE WHEN kind IS NULL THEN coalesce(assessments, 0) END AS assessments
    FROM judged j LEFT JOIN {SEEN_SQL} s ON s.patient_id = j.patient_id
""")
def caseload_match_report(spark: SparkSession, d: str) -> DataFrame:
    """A payer's caseload matched with clients, providers and supervisors, or where and how that failed."""
    found = matched_caseload(spark, d)
    null = lambda kind: F.lit(None).cast(kind)
    failed = lambda rows, outcome: rows.select(F.lit(outcome).alias("outcome"), "matched_type", null("bigint").alias("supervisor_id"), null("bigint").alias("provider_id"), "csw_name", "client_name", *(null("bigint").alias(c) for c in ("patient_id", "encounters", "assessments")))
    matched = found["caseloads"].select(F.lit("matched").alias("outcome"), null("string").alias("matched_type"), "supervisor_id", "provider_id", F.col("provider_name").alias("csw_name"), F.col("patient_name").alias("client_name"), "patient_id", "encounters", "assessments")
    return matched.unionByName(failed(found["missing"], "missing")).unionByName(failed(found["duplicates"], "duplicate"))


@query(f"""
    {MATCH_SQL}
    SELECT supervisor_id, provider_id, csw_name AS provider_name, string_agg(j.patient_id || ':' || coalesce(encounters, 0) || ':' || coalesce(assessments, 0), ',' ORDER BY j.patient_id, client_name) AS patients
    FROM judged j LEFT JOIN {SEEN_SQL} s ON s.patient_id = j.patient_id WHERE kind IS NULL GROUP BY 1, 2, 3
""")
def nested_match_report(spark: SparkSession, d: str) -> DataFrame:
    """The matched caseload of each supervisor and provider."""
    shown = F.transform("patients", lambda p: F.concat_ws(":", p["patient_id"], p["encounters"], p["assessments"]))
    return matched_caseload(spark, d)["nested"].select("supervisor_id", "provider_id", "provider_name", F.array_join(shown, ",").alias("patients"))


@query(f"""
    WITH {TEAMS_SQL}, {SERVICES_SQL}
    SELECT team AS team_name, CASE WHEN recovery THEN 'recovery' WHEN approved THEN 'payable' ELSE 'unapproved' END AS report, count(*) AS services, sum(CAST(floor(units) AS BIGINT)) AS units, min(service_id) AS first_service
    FROM services s JOIN teams ON teams.emp_id = s.emp_id WHERE approved OR NOT recovery GROUP BY 1, 2
""")
def payroll_sheets(spark: SparkSession, d: str) -> DataFrame:
    """The workbook's sheets, one for each team and report, summed up."""
    lines = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(*(f"{e} AS {c}" for c, e in SERVICES.items()))
    nothing = F.lit("2000-01-01").cast("timestamp")
    services = lines.withColumns({c: nothing for c in ("service_date", "transfer_date", "approved_date")})
    parts = [services.where(on).drop("recovery", "hours") for on in ("not recovery", "recovery")]
    people = teams(spark, d).select("team", "emp_id", "emp_name")
    tables = written(team_reports.payroll_tables(people, *parts, people.select("emp_id", F.lit("$20").alias("rate"))), "payroll")
    whole = None
    for name, sheet in team_reports.sheets(tables, ["north", "south", "west", "by hand", "rest"]).items():
        summed = sheet.groupBy("team_name").agg(F.lit(name.split("_")[0]).alias("report"), F.count("*").alias("services"), F.sum("units").alias("units"), F.min("service_id").alias("first_service"))
        whole = summed if whole is None else whole.unionByName(summed)
    return whole
