"""Whole flows: lazy compositions of operators, and jobs that run them over files."""

from linkloom.plans.aggregation import Aggregation, aggregate, merged_links
from linkloom.plans.enrichment import Enrichment, enrich
from linkloom.plans.harvest import current_records, ingest, ingest_changes
from linkloom.plans.profiles import update_profiles

__all__ = ["Aggregation", "Enrichment", "aggregate", "current_records", "enrich", "ingest", "ingest_changes", "merged_links", "update_profiles"]
