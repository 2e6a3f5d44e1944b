"""Checks of structured financial terms. Each returns the breaches as rows: rule and key."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact
from ..functions.text import normal_role
from .folds import dealt

#: Roles that name a kind of company, not a part in a contract.
CORPORATE_ROLES = ("borrower_parent", "lender_parent", "parent", "child", "subsidiary", "holding_company")


def amount_violations(amounts: DataFrame) -> DataFrame:
    """key, status, value: supported and uncertain need a value, missing and not_applicable must have none."""
    needs = F.col("status").isin("supported", "uncertain")
    return amounts.where((needs & F.col("value").isNull()) | (~needs & F.col("value").isNotNull())).select(F.when(needs, "value_missing").otherwise("value_unexpected").alias("rule"), "key")


def number_violations(numbers: DataFrame) -> DataFrame:
    """key, value: numbers are finite and not negative."""
    bad = F.isnan("value") | (F.col("value") == float("inf")) | (F.col("value") < 0)
    return numbers.where(bad).select(F.lit("bad_number").alias("rule"), "key")


def calculation_violations(rates: DataFrame) -> DataFrame:
    """key, kind, fixed_rate, benchmark_rate, margin_rate, floor_rate: a fixed rate stands alone; a floating one needs
    benchmark and margin and has no fixed rate."""
    others = F.coalesce("benchmark_rate", "margin_rate", "floor_rate")
    rules = [
        ("fixed_without_rate", (F.col("kind") == "fixed") & F.col("fixed_rate").isNull()),
        ("fixed_with_parts", (F.col("kind") == "fixed") & others.isNotNull()),
        ("floating_with_fixed", (F.col("kind") == "floating") & F.col("fixed_rate").isNotNull()),
        ("floating_without_parts", (F.col("kind") == "floating") & (F.col("benchmark_rate").isNull() | F.col("margin_rate").isNull())),
        ("unknown_kind", ~F.col("kind").isin("fixed", "floating")),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))
    return rates.select(F.explode(found).alias("rule"), "key")


def total_mismatches(rates: DataFrame) -> DataFrame:
    """key, stated, computed (a decimal): totals that are stated and not what the parts give, exactly."""
    return rates.where(F.col("stated").isNotNull() & F.col("computed").isNotNull() & (exact(F.col("stated")) != F.col("computed"))).select(F.lit("total_mismatch").alias("rule"), "key")


def missing_references(rows: DataFrame, column: str, keys: DataFrame, key: str, rule: str) -> DataFrame:
    """Rows (key, column) that refer to nothing."""
    return rows.where(F.col(column).isNotNull()).join(keys.select(F.col(key).alias(column)), column, "left_anti").select(F.lit(rule).alias("rule"), "key")


def repeated(rows: DataFrame, column, rule: str) -> DataFrame:
    return rows.groupBy(column.alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(rule).alias("rule"), "key")


def role_violations(roles: DataFrame) -> DataFrame:
    """party_id, role: roles that are repeated once normalised, or name a kind of company."""
    named = roles.select("party_id", normal_role(F.col("role")).alias("role"))
    twice = named.groupBy("party_id", "role").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated_role").alias("rule"), "party_id", "role")
    return twice.unionByName(named.where(F.col("role").isin(*CORPORATE_ROLES)).select(F.lit("corporate_role").alias("rule"), "party_id", "role").distinct())


def _on_cycles(children: dict) -> list:
    """Nodes that reach themselves: those of strongly connected parts with more than one node, by Tarjan's walk."""
    found, number, low, stack, on = [], {}, {}, [], set()
    for root in children:
        if root in number:
            continue
        work = [(root, iter(children[root]))]
        number[root] = low[root] = len(number)
        stack.append(root)
        on.add(root)
        while work:
            node, rest = work[-1]
            for child in rest:
                if child not in number:
                    number[child] = low[child] = len(number)
                    stack.append(child)
                    on.add(child)
                    work.append((child, iter(children.get(child, ()))))
                    break
                if child in on:
                    low[node] = min(low[node], number[child])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == number[node]:
                    part = []
                    while not part or part[-1] != node:
                        part.append(stack.pop())
                        on.discard(part[-1])
                    found += part if len(part) > 1 else []
    return found


def cyclic_parties(edges: DataFrame) -> DataFrame:
    """doc_id, party: parties that are their own ancestors. `edges`: doc_id, parent, child; self-references are a rule of
    their own. Relations are those of one document, so documents are gone through one by one, in one shuffle; a task
    holds one document's relations. Any depth, and time in proportion to the relations."""
    kind = edges.schema["parent"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, children = None, {}

        def settled() -> pa.RecordBatch:
            found = _on_cycles(children)
            return pa.RecordBatch.from_arrays([pa.array([doc] * len(found), schema[0].type), pa.array(found, schema[1].type)], names=["doc_id", "party"])

        schema = None
        for batch in batches:
            schema = batch.schema
            for d, p, c in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "parent", "child")), strict=True):
                if d != doc:
                    if children:
                        yield settled()
                    doc, children = d, {}
                children.setdefault(p, []).append(c)
        if children:
            yield settled()

    own = edges.where("parent <> child").select("doc_id", "parent", F.col("child").cast(kind).alias("child")).distinct()
    return dealt(own, "doc_id").sortWithinPartitions("doc_id").mapInArrow(run, f"doc_id {edges.schema['doc_id'].dataType.simpleString()}, party {kind}")


def relationship_violations(edges: DataFrame) -> DataFrame:
    """rule, parent, child: parties related to themselves, and relations stated twice."""
    own = edges.where("parent = child").select(F.lit("self").alias("rule"), "parent", "child").distinct()
    twice = edges.groupBy("parent", "child").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated").alias("rule"), "parent", "child")
    return own.unionByName(twice)
