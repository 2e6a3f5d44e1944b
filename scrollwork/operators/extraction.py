"""All rules of an extracted set of terms, table by table: parties, relations, facilities, commitments, interest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact, total_rate
from ..functions.text import casefolded, normal_role
from .terms import CORPORATE_ROLES, cyclic_parties

#: States of a total, and those that go with no number.
TOTAL_STATES = ("supported", "missing", "uncertain", "not_applicable", "missing_inputs")
WITHOUT_NUMBER = ("missing", "not_applicable", "missing_inputs")
#: Which kind of calculation goes with which type of rate.
RATE_TYPES = {"fixed": "fixed", "benchmark_plus_margin": "floating"}


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _rule(frame: DataFrame, name: str, key: Column) -> DataFrame:
    return frame.select(F.lit(name).alias("rule"), "doc_id", key.cast("string").alias("key"))


def citation_violations(records: DataFrame, allowed: DataFrame) -> DataFrame:
    """rule, doc_id, key of records (doc_id, key, evidence, required) without a citation they need, or that cite an item twice
    or one that was not supplied. `allowed`: doc_id, item_id."""
    cited = records.select("doc_id", "key", F.explode("evidence").alias("item_id"))
    return _union(
        [
            _rule(records.where(F.col("required") & (F.coalesce(F.size("evidence"), F.lit(0)) <= 0)), "no_citation", F.col("key")),
            _rule(records.where(F.size("evidence") != F.size(F.array_distinct("evidence"))), "repeated_citation", F.col("key")),
            _rule(cited.join(allowed.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_anti").select("doc_id", "key").distinct(), "unknown_citation", F.col("key")),
        ]
    )


def total_violations(totals: DataFrame) -> DataFrame:
    """rule, key of stated totals (key, value, status, missing_inputs): a supported one has a number and misses nothing, one
    that is not available has none, and what is missing has a name."""
    value, status, missing = F.col("value"), F.col("status"), F.coalesce(F.size("missing_inputs"), F.lit(0)) > 0
    rules = [
        ("unknown_status", ~F.coalesce(status.isin(*TOTAL_STATES), F.lit(False))),
        ("supported_without_total", (status == "supported") & (value.isNull() | missing)),
        ("unavailable_with_total", status.isin(*WITHOUT_NUMBER) & value.isNotNull()),
        ("missing_without_name", (status == "missing_inputs") & ~missing),
    ]
    return totals.select(F.explode(F.array_compact(F.array(*[F.when(c, name) for name, c in rules]))).alias("rule"), "key")


def party_violations(parties: DataFrame) -> DataFrame:
    """rule, doc_id, key of parties (doc_id, party_id, name, roles): ids and names (trimmed, in any case) that several have,
    roles that are repeated once normalised, or that name a kind of company."""
    named = parties.select("doc_id", "party_id", casefolded(F.regexp_replace("name", r"(?U)^\s+|\s+$", "")).alias("folded"))
    roles = parties.select("doc_id", "party_id", F.transform("roles", normal_role).alias("roles"))
    several = lambda column, name: _rule(named.groupBy("doc_id", column).agg(F.count("*").alias("n")).where("n > 1"), name, F.col(column))
    return _union(
        [
            several("party_id", "repeated_party"),
            several("folded", "repeated_name"),
            _rule(roles.where(F.size("roles") != F.size(F.array_distinct("roles"))), "repeated_role", F.col("party_id")),
            _rule(roles.where(F.exists("roles", lambda r: r.isin(*CORPORATE_ROLES))), "corporate_role", F.col("party_id")),
        ]
    )


def relation_violations(relations: DataFrame, parties: DataFrame) -> DataFrame:
    """rule, doc_id, key of relations (doc_id, parent, child): with who is no party, with oneself, stated twice, in a circle."""
    known = parties.select("doc_id", F.col("party_id").alias("party")).distinct()
    ends = relations.select("doc_id", F.explode(F.array("parent", "child")).alias("party"))
    pair = F.concat_ws(">", "parent", "child")
    return _union(
        [
            _rule(ends.join(known, ["doc_id", "party"], "left_anti").distinct(), "unknown_party", F.col("party")),
            _rule(relations.where("parent = child").distinct(), "self_relation", pair),
            _rule(relations.groupBy("doc_id", "parent", "child").agg(F.count("*").alias("n")).where("n > 1"), "repeated_relation", pair),
            _rule(cyclic_parties(relations), "circle", F.col("party")),
        ]
    )


def facility_violations(facilities: DataFrame, commitments: DataFrame, parties: DataFrame) -> DataFrame:
    """rule, doc_id, key: facilities (doc_id, facility_id, evidence, amount_evidence) that several have or nothing supports, and
    commitments (doc_id, facility_id, lender) of who is no party in the role of a lender."""
    lenders = parties.where(F.exists("roles", lambda r: normal_role(r) == "lender")).select("doc_id", F.col("party_id").alias("lender")).distinct()
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    bare = facilities.where(size("evidence") + size("amount_evidence") == 0).join(commitments.select("doc_id", "facility_id"), ["doc_id", "facility_id"], "left_anti")
    return _union(
        [
            _rule(facilities.groupBy("doc_id", "facility_id").agg(F.count("*").alias("n")).where("n > 1"), "repeated_facility", F.col("facility_id")),
            _rule(bare, "facility_without_evidence", F.col("facility_id")),
            _rule(commitments.join(lenders, ["doc_id", "lender"], "left_anti").distinct(), "no_lender", F.concat_ws("/", "facility_id", "lender")),
        ]
    )


def interest_violations(interest: DataFrame, facilities: DataFrame) -> DataFrame:
    """rule, doc_id, key of interest terms: of unknown facilities; whose calculation is of another kind than the rate, has other
    inputs than the terms, or does not give the stated total, exactly; and totals that nothing calculates.

    `interest`: doc_id, key, facility_id, rate_type, margin_rate, floor_rate, total, calculation (struct kind, fixed_rate,
    benchmark_rate, margin_rate, floor_rate; or null).
    """
    c = F.col("calculation")
    part = lambda name: c[name]
    computed = total_rate(F.when(part("kind") == "fixed", "fixed").otherwise("floating"), part("fixed_rate"), part("benchmark_rate"), part("margin_rate"), part("floor_rate"))
    kinds = F.element_at(F.create_map(*[F.lit(x) for pair in RATE_TYPES.items() for x in pair]), part("kind"))
    other = lambda name: ~part(name).eqNullSafe(F.col(name))
    rules = [
        ("kind_differs", c.isNotNull() & (kinds != F.col("rate_type"))),
        ("inputs_differ", c.isNotNull() & (other("margin_rate") | other("floor_rate"))),
        ("total_mismatch", c.isNotNull() & F.col("total").isNotNull() & (computed.isNull() | (exact(F.col("total")) != computed))),
        ("total_without_calculation", c.isNull() & F.col("total").isNotNull()),
    ]
    own = interest.select(F.explode(F.array_compact(F.array(*[F.when(F.coalesce(w, F.lit(False)), n) for n, w in rules]))).alias("rule"), "doc_id", F.col("key").cast("string").alias("key"))
    lost = interest.join(facilities.select("doc_id", "facility_id"), ["doc_id", "facility_id"], "left_anti")
    return own.unionByName(_rule(lost, "unknown_facility", F.col("key")))


def extraction_violations(tables: dict[str, DataFrame], allowed: DataFrame) -> DataFrame:
    """All breaches of one or many extractions: rule, doc_id, key. `tables`: parties, relations, facilities, commitments and
    interest as above, each with evidence; facilities with amount_status, interest and calculation with theirs.

    Every rule is a row's own look, a count by key, or a join on a key; circles are found document by document.
    """
    p, r, f, c, i = (tables[n] for n in ("parties", "relations", "facilities", "commitments", "interest"))
    cited = lambda frame, kind, key, evidence="evidence", required=F.lit(True): frame.select("doc_id", F.concat_ws(":", F.lit(kind), key).alias("key"), F.col(evidence).alias("evidence"), required.alias("required"))
    records = _union(
        [
            cited(p, "party", F.col("party_id")),
            cited(r, "relation", F.concat_ws(">", "parent", "child")),
            cited(f, "facility", F.col("facility_id"), required=F.lit(False)),
            cited(f, "amount", F.col("facility_id"), "amount_evidence", ~F.col("amount_status").eqNullSafe("missing")),
            cited(c, "commitment", F.concat_ws("/", "facility_id", "lender")),
            cited(i, "interest", F.col("key").cast("string")),
            cited(i.where("calculation IS NOT NULL"), "calculation", F.col("key").cast("string"), "calculation.evidence"),
        ]
    )
    totals = i.select(F.struct("doc_id", "key").alias("key"), F.col("total").alias("value"), F.col("total_status").alias("status"), "missing_inputs")
    states = total_violations(totals).select("rule", F.col("key.doc_id").alias("doc_id"), F.col("key.key").cast("string").alias("key"))
    return _union([citation_violations(records, allowed), party_violations(p), relation_violations(r, p), facility_violations(f, c, p), interest_violations(i, f), states])
