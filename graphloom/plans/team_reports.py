"""Whole reports of the clinic: payroll tables per team, and the match of a payer's caseload with the clinic's own people. Tables in, tables out; sheets are filters of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions import text
from graphloom.operators.matching import patient_match
from graphloom.plans.reports import hours_between, rate, timing

#: The heading of payroll sheets, in order.
PAYROLL = ("team_name", "csw_name", "service_date", "client_id", "service_id", "service_type", "units", "transfer_date", "approved", "approved_by", "approved_date", "delay", "timing", "rate", "rate_payable")


def payroll_tables(teams: DataFrame, sampled: DataFrame, recovery: DataFrame, rates: DataFrame, sampled_days: int = 16) -> DataFrame:
    """(report, the columns of PAYROLL): `payable` and `unapproved` services of the sampled period and approved `recovery` services, for employees of teams.

    teams: (team, emp_id, emp_name). sampled, recovery: (service_id, emp_id, client_id, service_type, service_date, transfer_date, units, approved, approved_by, approved_date). rates: (emp_id, rate as text
    such as `$21.50`); employees without one have 0, of several the smallest counts. An employee whose approved sampled units come to more than 3.3 hours a day earns the raised rate, but not for
    recovery. What isn't approved pays nothing; early work earns two more if it pays at all; pay is the whole rate times whole units / 4. Employees of no team are left out.

    Averages are aggregated first, so that each service meets one row of its employee.
    """
    average = sampled.where("approved").groupBy("emp_id").agg((F.sum(F.floor("units") / 4) / F.lit(sampled_days)).alias("_per_day"))
    base = rates.groupBy("emp_id").agg(F.min(text.money(F.col("rate"))).cast("double").alias("_base"))
    people = teams.select("team", "emp_id", "emp_name").join(average, "emp_id", "left").join(base, "emp_id", "left")
    rows = sampled.withColumn("_recovery", F.lit(False)).unionByName(recovery.withColumn("_recovery", F.lit(True)))
    met = rows.join(people, "emp_id").withColumn("approved", F.coalesce("approved", F.lit(False))).where("approved or not _recovery")
    delay = hours_between(F.col("transfer_date"), F.col("service_date")).cast("bigint")
    paid = rate(F.coalesce("_per_day", F.lit(0.0)), F.coalesce("_base", F.lit(0.0)), F.col("_recovery"), F.col("approved"))
    final = F.when((timing(delay) == "Early") & (paid > 0), paid + 2).otherwise(paid)
    report = F.when(F.col("_recovery"), "recovery").when(F.col("approved"), "payable").otherwise("unapproved")
    units = F.floor("units").cast("bigint")
    return met.select(report.alias("report"), F.col("team").alias("team_name"), F.col("emp_name").alias("csw_name"), "service_date", "client_id", "service_id", "service_type", units.alias("units"), "transfer_date", "approved", "approved_by", "approved_date", delay.alias("delay"), timing(delay).alias("timing"), final.alias("rate"), (F.floor(final) * units / 4).alias("rate_payable"))


def sheets(tables: DataFrame, teams: list[str]) -> dict[str, DataFrame]:
    """A table for each sheet of the workbook: `<report>_<team>`, with the columns of PAYROLL."""
    return {f"{report}_{team}": tables.where((F.col("report") == report) & (F.col("team_name") == team)).select(*PAYROLL) for team in teams for report in ("payable", "unapproved", "recovery")}


def people_by_name(asked: DataFrame, name: Column, people: DataFrame, key: str, tag: str) -> DataFrame:
    """asked with `<tag>_id` and `<tag>_outcome`: the one distinct id of people (key, first_name, last_name) with both names, without case. People are grouped by names first, so a frequent name is one row."""
    named = people.where("first_name is not null and last_name is not null").groupBy(F.lower("first_name").alias("_first"), F.lower("last_name").alias("_last")).agg(F.count_distinct(key).alias("_n"), F.min(key).alias("_one"))
    split = text.split_name(name)
    rows = asked.withColumn("_first", F.lower(split["first_name"])).withColumn("_last", F.lower(split["last_name"])).join(named, ["_first", "_last"], "left")
    outcome = F.when(F.col("_n") == 1, "unique").when(F.col("_n") > 1, "duplicate").otherwise("missing")
    return rows.withColumn(f"{tag}_outcome", outcome).withColumn(f"{tag}_id", F.when(F.col("_n") == 1, F.col("_one"))).drop("_first", "_last", "_n", "_one")


def services_of(patients: DataFrame, services: DataFrame, order: str = "seq") -> DataFrame:
    """services (patient_id, service_id, seq, others) of the patients, each service of a patient once: the row that comes last."""
    rest = [c for c in services.columns if c not in ("patient_id", "service_id")]
    last = services.groupBy("patient_id", "service_id").agg(F.max_by(F.struct(*rest), order).alias("_r")).select("patient_id", "service_id", "_r.*")
    return last.join(patients.select("patient_id").distinct(), "patient_id", "left_semi")


def caseload_report(caseload: DataFrame, clients: DataFrame, employees: DataFrame, encounters: DataFrame, assessments: DataFrame) -> dict[str, DataFrame]:
    """A payer's caseload (medicaid, client_name, csw_name, supervisor_name, seq) matched with clients (client_id, medicaid, first_name, last_name) and employees (emp_id, first_name, last_name).

    Entries lacking one of the three names are left out; of a medicaid number the last entry counts. Client, provider and supervisor must each be found exactly once, in this order; the first that
    isn't decides where the entry goes. A client without a medicaid number is found by both names.

    caseloads: (supervisor_id, provider_id, provider_name, patient_id, patient_name, encounters, assessments), the last two being numbers of services; missing and duplicates: (matched_type, medicaid, client_name, csw_name, supervisor_name);
    encounters, assessments: the matched patients' services, each once; nested: a row for each supervisor and provider with its patients, who are one person's caseload.
    """
    entries = caseload.where("client_name <> '' and csw_name <> '' and supervisor_name <> ''")
    one = entries.groupBy("medicaid").agg(F.max_by(F.struct("client_name", "csw_name", "supervisor_name"), "seq").alias("_e")).select("medicaid", "_e.*").withColumn("_row", F.coalesce("medicaid", F.lit("")))
    asked = one.select(F.col("_row").alias("record_id"), "medicaid", text.split_name(F.col("client_name"))["first_name"].alias("first_name"), text.split_name(F.col("client_name"))["last_name"].alias("last_name"))
    found = patient_match(asked, clients, unnumbered=True).select(F.col("record_id").alias("_row"), F.col("client_id").alias("patient_id"), F.col("outcome").alias("patient_outcome"))
    staffed = people_by_name(people_by_name(one.join(found, "_row"), F.col("csw_name"), employees, "emp_id", "provider"), F.col("supervisor_name"), employees, "emp_id", "supervisor")
    first = lambda state: F.when(F.col("patient_outcome") == state, "clients").when(F.col("patient_outcome") != "unique", F.lit(None)).when(F.col("provider_outcome") == state, "providers").when(F.col("provider_outcome") != "unique", F.lit(None)).when(F.col("supervisor_outcome") == state, "providers")
    failed = lambda state: staffed.withColumn("matched_type", first(state)).where("matched_type is not null").select("matched_type", "medicaid", "client_name", "csw_name", "supervisor_name")
    good = staffed.where("patient_outcome = 'unique' and provider_outcome = 'unique' and supervisor_outcome = 'unique'").select("supervisor_id", "provider_id", F.col("csw_name").alias("provider_name"), "patient_id", F.col("client_name").alias("patient_name"))
    seen, assessed = services_of(good, encounters), services_of(good, assessments)
    count = lambda rows, name: rows.groupBy("patient_id").agg(F.count("*").alias(name))
    listed = good.join(count(seen, "encounters"), "patient_id", "left").join(count(assessed, "assessments"), "patient_id", "left").fillna(0, ["encounters", "assessments"])
    nested = listed.groupBy("supervisor_id", "provider_id", "provider_name").agg(F.sort_array(F.collect_list(F.struct("patient_id", "patient_name", "encounters", "assessments"))).alias("patients"))
    return {"caseloads": listed.select("supervisor_id", "provider_id", "provider_name", "patient_id", "patient_name", "encounters", "assessments"), "missing": failed("missing"), "duplicates": failed("duplicate"), "encounters": seen, "assessments": assessed, "nested": nested}
