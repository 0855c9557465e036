"""Reports: productivity, expirations, contact recency, unassigned clients, payroll, caseloads. as_of is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import person_name, staff_names
from graphloom.operators.matching import both_ways, by_names, team_of
from graphloom.registry import merged, report_filters


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def hours_between(later: Column, earlier: Column) -> Column:
    """Whole hours, rounded down, also before zero."""
    return F.floor((F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))) / 3600)


@report_filters("team_productivity")
def team_productivity(employees: DataFrame, encounters: DataFrame, unapproved: DataFrame, as_of: str) -> DataFrame:
    """Per employee (emp_id, emp_name): units of the past 24 hours, of the six days before, unapproved ones and those with a red note; zero without encounters."""
    age = hours_between(moment(as_of), F.col("transfer_date"))
    done = encounters.groupBy("emp_id").agg(F.sum(F.when((age >= 0) & (age < 24), F.col("base_rate"))).alias("past_day"), F.sum(F.when((age >= 24) & (age < 168), F.col("base_rate"))).alias("next_six_days"))
    waiting = unapproved.groupBy("emp_id").agg(F.sum("base_rate").alias("unapproved"), F.sum(F.when(F.coalesce(F.length("red_x"), F.lit(0)) > 0, F.col("base_rate"))).alias("red_x"))
    joined = employees.join(done, "emp_id", "left").join(waiting, "emp_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return joined.select(F.col("emp_id").alias("csw_id"), F.col("emp_name").alias("csw_name"), *map(zero, ("past_day", "next_six_days", "unapproved", "red_x")))


@report_filters("expiration")
def expiration(caseload: DataFrame, assessments: DataFrame, as_of: str, days: int = 180) -> DataFrame:
    """Per client the latest assessment, its end after `days`, and the days that remain (0 once expired); clients of nobody are unassigned."""
    latest = assessments.groupBy("client_id").agg(F.max("assessment_date").alias("start_date"))
    rows = caseload.join(latest, "client_id", "full")
    end = F.col("start_date") + F.expr(f"interval {days} days")
    left = F.floor((F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(moment(as_of))) / 86400)
    expired = F.coalesce(end.cast("timestamp") < moment(as_of), F.lit(True))
    return rows.select(F.coalesce("team", F.lit("unassigned")).alias("team"), F.coalesce("csw_name", F.lit("unassigned")).alias("csw_name"), "client_id", "start_date", end.alias("end_date"), expired.alias("expired"), F.when(expired, F.lit(0)).otherwise(left).cast("bigint").alias("days_remaining"))


def recency(last: Column, as_of: str) -> Column:
    """30, 60 or 90 by whole days since; never is 90."""
    days = F.floor((F.unix_seconds(moment(as_of)) - F.unix_seconds(last.cast("timestamp"))) / 86400)
    return F.when(days <= 30, "30").when(days <= 60, "60").otherwise("90")


@report_filters("not_seen")
def not_seen(caseload: DataFrame, encounters: DataFrame, as_of: str) -> DataFrame:
    """Per client the last billable service at all and by the assigned worker: one join, one aggregation."""
    billable = encounters.where(~F.coalesce(F.col("non_billable"), F.lit(False))).select("client_id", "service_date", F.col("emp_id").alias("_by"))
    rows = caseload.join(billable, "client_id", "left").groupBy("team", "csw_name", "client_id").agg(F.max(F.when(F.col("_by") == F.col("emp_id"), F.col("service_date"))).alias("last_service_by_csw"), F.max("service_date").alias("last_billable_service"))
    return rows.withColumn("csw_bucket", recency(F.col("last_service_by_csw"), as_of)).withColumn("billable_bucket", recency(F.col("last_billable_service"), as_of))


@report_filters("unassigned")
def unassigned(clients: DataFrame, caseload: DataFrame) -> DataFrame:
    """Clients in nobody's caseload, each value under its own heading (a deliberate choice)."""
    return clients.join(caseload.select("client_id"), "client_id", "left_anti")


def clinical_teams(employees: DataFrame, profile: str, manual: dict[str, str], first_level: list[tuple[str, str]], default: str) -> DataFrame:
    """Employees (emp_id, emp_name, supervisors, profile_code) of a profile with their team."""
    kept = employees.where(F.col("supervisors").isNotNull() & (F.col("profile_code") == profile))
    return kept.withColumn("team", team_of(F.col("emp_id").cast("string"), F.col("supervisors"), manual, first_level, default))


def caseloads(clients: DataFrame, teams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(client, team, csw, emp_id) for each name among a client's primary staff, and clients that nobody has. Names are compared as 'F Last', with case; of several employees the largest id counts."""
    named = clients.withColumn("staff", staff_names(F.col("primary_staff")))
    people = teams.select("emp_id", "team", "emp_name", F.coalesce(person_name(F.col("emp_name")), "emp_name").alias("staff_name"))
    found, _ = by_names(named.select("client_id", F.col("staff").alias("names")), "names", people.select("staff_name", "emp_id"), "staff_name", "emp_id")
    placed = found.join(people.select("emp_id", "team", F.col("emp_name").alias("csw_name")), "emp_id").select("client_id", "team", "csw_name", "emp_id").distinct()
    return placed, clients.join(placed.select("client_id"), "client_id", "left_anti")


def incomplete(clients: DataFrame, placed: DataFrame, unplaced: DataFrame) -> DataFrame:
    """Clients on one side only; empty when every client is placed or known to be unplaced. Both directions are tested (a deliberate choice)."""
    return both_ways(clients, placed.select("client_id").unionByName(unplaced.select("client_id")), "client_id")


def rate(per_day: Column, base: Column, recovery: Column, approved: Column, limit: float = 3.3, raised: float = 25.0) -> Column:
    """Above the daily limit, outside recovery, the raised rate; 0 if not approved."""
    return F.when(~approved, F.lit(0.0)).when((per_day > limit) & ~recovery, F.lit(raised)).otherwise(base)


def timing(delay_hours: Column) -> Column:
    return F.when(delay_hours <= 24, "Early").when(delay_hours <= 48, "On Time").otherwise("Late")


@report_filters("payroll")
def payroll(encounters: DataFrame, rates: DataFrame, sampled_days: int = 16) -> DataFrame:
    """Payable encounters (service_id, emp_id, time_out, submitted_at, units, approved, recovery) with delay, timing, rate and pay. Early work earns two more, if there is a rate; pay is the whole rate times units / 4."""
    average = encounters.groupBy("emp_id").agg((F.sum(F.when(F.col("approved"), F.floor("units") / 4)) / F.lit(sampled_days)).alias("per_day"))
    rows = encounters.join(average, "emp_id").join(rates, "emp_id", "left")
    delay = hours_between(F.col("submitted_at"), F.col("time_out"))
    base = rate(F.coalesce("per_day", F.lit(0.0)), F.coalesce("rate", F.lit(0.0)), F.col("recovery"), F.col("approved"))
    final = F.when((timing(delay) == "Early") & (base > 0), base + 2).otherwise(base)
    return rows.select("service_id", "emp_id", delay.cast("bigint").alias("delay_hours"), timing(delay).alias("timing"), F.coalesce("per_day", F.lit(0.0)).alias("per_day"), final.alias("rate"), (F.floor(final) * F.floor("units") / 4).alias("pay"))


def previous_period(check_dates: DataFrame, check: str = "check_date") -> DataFrame:
    """Each pay period with the one before it. A calendar: tens of rows a year."""
    order = Window.partitionBy("id_source").orderBy(check)
    return check_dates.withColumn("previous_check", F.lag(check).over(order)).withColumn("period", F.row_number().over(order))


def nested_caseload(placed: DataFrame) -> DataFrame:
    """team -> worker -> clients: one row per team; a worker's clients are a caseload, tens of ids."""
    worker = placed.groupBy("team", "csw_name").agg(F.sort_array(F.collect_set("client_id")).alias("clients"))
    return worker.groupBy("team").agg(F.sort_array(F.collect_list(F.struct("csw_name", "clients"))).alias("workers"))


def daily(teams: DataFrame, encounters: DataFrame, unapproved: DataFrame, caseload: DataFrame, clients: DataFrame, plans: DataFrame, diagnostics: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The daily bundle, a table per page."""
    return {"productivity": team_productivity(teams, encounters, unapproved, as_of), "tx_plans": expiration(caseload, plans, as_of), "diagnostics": expiration(caseload, diagnostics, as_of), "unassigned": unassigned(clients, caseload), "30, 60, 90": not_seen(caseload, encounters, as_of)}


def populate(schema: dict, profile: str) -> dict:
    """A report schema for a profile: the default profile with the named one merged into it."""
    return merged(schema.get("default", {}), schema.get(profile, {}))


def stage_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("stage").count()
