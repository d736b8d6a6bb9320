"""The enrichment as one run: find what lacks an entry, look it up, put the hits into the stored table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedweave.operators import catalogue, diff
from feedweave.plans.targets import CATALOGUE_FIELDS
from feedweave.session import scratch_dir
from feedweave.sources.versioned import VersionedTable


@dataclass(frozen=True)
class EnrichReport:
    found: int
    looked_up: int

    @property
    def percent(self) -> float | None:
        return 100.0 * self.found / self.looked_up if self.looked_up else None


def run_enrichment(
    spark: SparkSession,
    products: DataFrame,
    manufacturers: DataFrame,
    table: VersionedTable,
    entries: DataFrame,
    fields: Sequence[str] = CATALOGUE_FIELDS[1:],
    first: Sequence[str] | None = None,
    key_policy: str = "exact",
) -> EnrichReport:
    """Look up every product without a stored entry and store the hits.

    ``entries`` is the catalogue: ``ean``, ``prod_id``, ``vendor``, ``code`` and ``fields``, or
    documents in a column ``xml`` in place of the fields they hold. The look-up is written
    once; report and stored table are read from it, and the commit follows the version that
    was read. Without a hit nothing is committed.
    """
    if "xml" in entries.columns:
        entries = catalogue.from_document(entries)
    fields = [name for name in fields if name in entries.columns]
    schema = products.select("id", *[F.lit(None).cast("string").alias(name) for name in fields]).schema
    base = table.version()
    stored = table.read(schema, base)
    candidates = catalogue.missing_entries(products, manufacturers, stored, key_policy)
    looked_up = VersionedTable(spark, scratch_dir(spark, "enrich"))
    looked_up.overwrite(catalogue.first_hit(candidates, entries, fields, first or fields, key_policy))
    try:
        found = looked_up.read()
        counts = found.agg(F.count("found_by"), F.count(F.lit(1))).first()
        report = EnrichReport(*counts)
        if report.found:
            hits = found.filter("found_by IS NOT NULL").select("id", *fields)
            table.commit(table.stage(diff.replace_into(stored, hits, "id", key_policy), base))
            table.expire()
        return report
    finally:
        looked_up.drop()
