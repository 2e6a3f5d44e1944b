"""Review decisions of many writers on a shared file system: rows in folders, and a log that says which of them count.

A commit puts its rows aside, and then creates the next version's entry in the log, which only one writer can: whoever comes
second is judged again against what has been committed meanwhile. Nothing is ever rewritten, so readers need no lock, and
rows that a lost writer has left behind are in no version.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reviews import decision_problems, recorded
from .shared import create_once, names_in, read_text

SCHEMA = "fact_id string, document_id string, revision long, decision string, field string, value string, value_status string, notes string, is_added boolean, source_sha string, draft_sha string, approved_for_reference boolean, evidence_validation string"


class DecisionStore:
    """Decisions about the facts of one draft. `drafts`: fact_id, document_id, field, proposed_value, value_status;
    `documents`: document_id, source_sha, format."""

    def __init__(self, spark: SparkSession, path: str, draft_sha: str, drafts: DataFrame, documents: DataFrame):
        self.spark, self.path, self.draft_sha, self.drafts, self.documents = spark, path.rstrip("/"), draft_sha, drafts, documents
        self.log = f"{self.path}/log"

    def versions(self) -> list[str]:
        """Folders of rows that count, in order of their versions: version n is what the nth entry names."""
        names = sorted(n for n in names_in(self.spark, self.log) if re.fullmatch(r"\d{10}", n))
        return [read_text(self.spark, f"{self.log}/{n}") for n in names]

    def decisions(self, versions: list[str] | None = None) -> DataFrame:
        """All revisions of all facts."""
        found = self.versions() if versions is None else versions
        if not found:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/rows/{v}" for v in found])

    def judged(self, incoming: DataFrame, versions: list[str] | None = None) -> DataFrame:
        """`incoming` with problem: why a decision is not taken, or null."""
        return decision_problems(incoming, self.decisions(versions), self.drafts, self.documents, self.draft_sha)

    def commit(self, incoming: DataFrame) -> DataFrame:
        """Takes the decisions that are right and expect the present revision of their fact; returns `incoming` with problem.

        Tried again, with a new look at what is there, as often as another writer has been faster.
        """
        while True:
            versions = self.versions()
            folder = f"{len(versions) + 1:010d}-{uuid.uuid4().hex}"
            judged = self.judged(incoming, versions)
            recorded(judged.where("problem IS NULL"), self.drafts, self.documents).write.parquet(f"{self.path}/rows/{folder}")
            if self.spark.read.parquet(f"{self.path}/rows/{folder}").isEmpty() or create_once(self.spark, f"{self.log}/{len(versions) + 1:010d}", folder):
                return judged
