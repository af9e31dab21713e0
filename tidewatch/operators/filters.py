"""Field-exists predicates on the enrichment object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schema import ENRICHMENT_FIELD


def enrichment(path: str) -> Column:
    return F.col(f"{ENRICHMENT_FIELD}.{path}")


def has_enrichment() -> Column:
    return F.col(ENRICHMENT_FIELD).isNotNull()


def has_ioc() -> Column:
    return enrichment("ioc_matches").isNotNull()


def has_anomaly() -> Column:
    return enrichment("behavioral_anomalies").isNotNull()


def has_rule() -> Column:
    return enrichment("threat_hunting.correlation_rules").isNotNull()


def enriched_only(events: DataFrame) -> DataFrame:
    return events.where(has_enrichment())
