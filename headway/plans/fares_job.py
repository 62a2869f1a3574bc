"""The whole fares job: staged documents to metadata, catalogue, violations and revision rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import resolve as res
from headway.operators import rollup
from headway.rules.fares import fares_violations
from headway.session import staged
from headway.sources import fares as src


class FaresJob(Mapping[str, DataFrame]):
    """Output tables by name, worked out when asked for.

    ``documents`` are staged ones with ``file_id`` and ``revision_id``. A file with
    a structure element that lacks id or version fails as a whole; a zone that
    lacks id, version or name is rejected alone.
    """

    def __init__(self, documents: DataFrame, stops: DataFrame | None = None):
        self.documents, self.stops = documents, stops
        self.failed = src.failed_files(documents)
        self._tables = {
            "failed_files": lambda: self.failed,
            "rejected_rows": lambda: src.rejected_zones(self.live),
            "metadata": lambda: self.metadata,
            "catalogue": lambda: self.catalogue,
            "violations": lambda: fares_violations(self.live),
            "violation_report": self._report,
            "revisions": self._revisions,
        }
        if stops is not None:
            self._tables["stop_ids"] = lambda: res.fares_stop_ids(src.zone_stop_refs(self.live), stops)
            self._tables["stop_shortfall"] = lambda: res.fares_stop_shortfall(src.zone_stop_refs(self.live), self["stop_ids"])

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    @cached_property
    def live(self) -> DataFrame:
        return self.documents.join(self.failed.select("file_id"), "file_id", "left_anti")

    @cached_property
    def details(self) -> dict[str, DataFrame]:
        return src.details(self.live)

    @cached_property
    def metadata(self) -> DataFrame:
        return staged(rollup.fares_file_metadata(self.details))

    @cached_property
    def catalogue(self) -> DataFrame:
        return staged(rollup.fares_catalogue(self.details))

    def _revisions(self) -> DataFrame:
        """One row per upload: sums over its files, types counted once."""
        none = F.array().cast("array<string>")
        types = self.catalogue.select(
            "file_id",
            F.coalesce("user_type", none).alias("user_types"),
            F.coalesce("product_type", none).alias("product_types"),
        )
        files = self.documents.select("file_id", "revision_id").join(self.metadata, "file_id").join(types, "file_id")
        return rollup.fares_revision(files)

    def _report(self) -> DataFrame:
        found = self["violations"].join(self.documents.select("file_id", "revision_id"), "file_id")
        return rollup.fares_violation_report(found.withColumnRenamed("file_id", "file"))


def process_fares(documents: DataFrame, stops: DataFrame | None = None) -> FaresJob:
    return FaresJob(documents, stops)
