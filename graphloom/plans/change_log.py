"""Change-log growth as one plan: reconcile ids, propagate them over categories, read their changes, enrich and link them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators import changes, links
from graphloom.sources.readers import search


@dataclass(frozen=True)
class Growth:
    outcomes: DataFrame
    entries: DataFrame
    propagated: DataFrame
    changes: DataFrame
    targets: DataFrame


def grow(remote: DataFrame, known: DataFrame, categories: DataFrame, log: DataFrame, by_emp: DataFrame, detail_ids: DataFrame, details: DataFrame, change_types: DataFrame, mapping: Mapping, as_of: str, driving_id: str = "id_value") -> Growth:
    """remote (id_value), known (id_value, is_linked), log (id_value, raw columns of the mapping).

    New and linked ids are propagated over the categories; only their changes are read (a semi join before anything else),
    then renamed by the mapping, given a category, enriched and split into targets, which keep the id that drove them as driving_id_value.
    """
    outcomes = links.reconcile(remote, known)
    working = outcomes.where("outcome <> 'unlink'").select("id_value")
    propagated = links.propagate(working, categories)
    raw = log.join(working, "id_value", "left_semi")
    mapped = changes.mapped(raw, {**mapping, "id_value": {"name": "id_value"}})
    kept = changes.with_category(mapped, change_types).join(propagated.select("id_value", F.col("category").alias("category")).distinct(), ["id_value", "category"], "left_semi")
    full = changes.enrich(kept, by_emp, detail_ids, details, driving_id)
    return Growth(outcomes, links.link_entries(outcomes, as_of), propagated, full, changes.changed_targets(full.withColumnRenamed("id_value", "driving_id_value")))


def query_sets(sources: Mapping[str, DataFrame], searches: Mapping[str, dict]) -> dict[str, DataFrame]:
    """Named searches of a report profile over named sources: {"encounters": {"source": .., "fields": .., "conditions": .., "date": .., "start": .., "end": ..}}."""
    return {name: search(sources[s["source"]], s["fields"], s.get("conditions", []), s.get("date"), s.get("start"), s.get("end")) for name, s in searches.items()}
