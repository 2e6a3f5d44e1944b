"""Results that are kept from run to run, under a hash of what they were made with, and looked at again before they are used.

    runs = Reused(spark, path, profile(model="m", prompt=text))
    rows, made = runs.rows(inputs, compute)
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of a profile: inputs go to one by the first byte of their hash.
BUCKETS = 256


def profile(**settings) -> str:
    """The hash of everything but the inputs that a result depends on."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _bucket(sha: Column) -> Column:
    return F.pmod(F.crc32(sha.cast("binary")), F.lit(BUCKETS)).cast("int")


class Reused:
    """A table of results, and one of seals: for each input its number of rows and a sum over their hashes.

    A kept result counts if its rows still are what the seal says and `valid` holds for each of them; files that cannot be
    read count as no rows. What does not count is computed again, with the new inputs. Only buckets with something new are
    written, by dynamic partition overwrite, and the seals after the rows: a run that dies between has rows that no seal is for,
    which are made again.
    """

    def __init__(self, spark: SparkSession, path: str, profile: str, valid: Column | None = None):
        self.spark, self.path, self.profile = spark, path.rstrip("/"), profile
        self.valid = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))

    def _kept(self, name: str) -> DataFrame | None:
        try:
            found = self.spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(f"{self.path}/{name}")
        except AnalysisException:
            return None  # no run has written here
        return found.where(F.col("profile") == self.profile) if {"profile", "bucket", "sha"} <= set(found.columns) else None

    def _seals(self, rows: DataFrame) -> DataFrame:
        """sha, n and digest of every input's rows; the order of rows does not matter, how often one is there does."""
        own = sorted(c for c in rows.columns if c not in ("profile", "bucket"))
        parts = [F.sum(F.shiftright(F.xxhash64(F.to_json(F.struct(*own)), F.lit(k)), 24)) for k in range(2)]
        return rows.groupBy("sha").agg(F.count("*").alias("n"), F.concat_ws("-", *parts).alias("digest"), F.min(self.valid).alias("all_valid"))

    def usable(self) -> DataFrame | None:
        """sha of inputs whose kept rows count."""
        rows, seals = self._kept("rows"), self._kept("seals")
        if rows is None or seals is None:
            return None
        seen = self._seals(rows)
        whole = seals.select("sha", "n", "digest").join(seen, "sha", "left")
        same = (seals["n"] == 0) | (seals["n"] == seen["n"]) & (seals["digest"] == seen["digest"]) & seen["all_valid"]
        return whole.where(F.coalesce(same, F.lit(False))).select("sha").distinct()

    def rows(self, inputs: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """Rows of all `inputs` (sha and more), and the inputs that were computed now. `compute(inputs)` gives any number of
        rows, each with the sha of its input."""
        usable = self.usable()
        new = inputs if usable is None else inputs.join(usable, "sha", "left_anti")
        aside = f"{self.path}/made/{uuid.uuid4().hex}"
        new.write.parquet(f"{aside}/inputs")  # fixed, as what is usable changes below
        new = self.spark.read.parquet(f"{aside}/inputs")
        made = compute(new).withColumns({"profile": F.lit(self.profile), "bucket": _bucket(F.col("sha"))})
        made.write.parquet(f"{aside}/rows")
        made = self.spark.read.schema(made.schema).parquet(f"{aside}/rows")
        every = new.select("sha").distinct()
        counted = every.join(self._seals(made), "sha", "left").select("sha", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("digest", F.lit("")).alias("digest"), F.lit(self.profile).alias("profile"), _bucket(F.col("sha")).alias("bucket"))
        for name, fresh in (("rows", made), ("seals", counted)):
            self._put(name, fresh, every)
        kept = self._kept("rows")
        kept = made.where("false") if kept is None else kept
        return kept.join(inputs.select("sha").distinct(), "sha", "left_semi").drop("profile", "bucket"), new

    def _put(self, name: str, fresh: DataFrame, replaced: DataFrame) -> None:
        """Writes the buckets of `replaced` anew: with what they have of other inputs, and `fresh`."""
        old = self._kept(name)
        if old is not None:
            touched = replaced.select(_bucket(F.col("sha")).alias("bucket")).distinct()
            stay = old.join(F.broadcast(touched), "bucket", "left_semi").join(replaced, "sha", "left_anti")  # at most BUCKETS rows
            fresh = fresh.unionByName(stay, allowMissingColumns=True)
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("profile", "bucket").parquet(f"{self.path}/{name}")
