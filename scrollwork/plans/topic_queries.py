"""Queries over topics, evidence and terms, and the SQL that says the same.

Here a chunk is eight lines, and a fixed rule stands in for the classifier: the length of an item's text names its topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions import text as T
from ..operators import review_joins, structure, terms, topics
from .adapters import ITEMS, items, table

#: Topics asked for, and the remainder of a text's length that stands for each topic.
ASKED = ["covenants", "interest_and_fees", "interest_and_fees.pik_toggle"]
MODULUS = 17
RULES = [("covenants", "the"), ("interest_and_fees.pik_toggle", "que"), ("default_and_remedies", "der"), ("parties_and_roles", "los")]


def chunks(spark: SparkSession, d: str) -> DataFrame:
    own = items(spark, d).withColumn("chunk_no", F.floor(F.col("pos") / 8).cast("int"))
    return own.groupBy("doc_id", "chunk_no").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


def classified(spark: SparkSession, d: str) -> DataFrame:
    """Groups (doc_id, chunk_no, topic, evidence, context); the context is the item before the chunk, in every other."""
    own = items(spark, d).withColumn("chunk_no", F.floor(F.col("pos") / 8).cast("int")).withColumn("k", F.length("text") % MODULUS)
    named = own.where(F.col("k") < len(topics.TOPICS)).withColumn("topic", F.get(F.array(*map(F.lit, topics.TOPICS)), F.col("k")))
    groups = named.groupBy("doc_id", "chunk_no", "topic").agg(F.array_sort(F.collect_list("pos")).alias("evidence"))
    before = F.col("chunk_no") * 8 - 1
    return groups.withColumn("context", F.when((F.col("chunk_no") > 0) & (F.col("chunk_no") % 2 == 0), F.array(before)).otherwise(F.array().cast("array<int>")))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return topics.identified(topics.with_parents(classified(spark, d)))


def passage_groups(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d).select("doc_id", "topic", "group_id", "chunk_no", F.array_join("evidence", ",").alias("evidence"), F.array_join("context", ",").alias("context"))


def topic_map(spark: SparkSession, d: str) -> DataFrame:
    return topics.topic_map(_groups(spark, d)).select("doc_id", "topic", "group_id", "group_ord")


def topic_unclassified(spark: SparkSession, d: str) -> DataFrame:
    return topics.unclassified(chunks(spark, d).select("doc_id", "chunk_no"), classified(spark, d))


def topic_facets(spark: SparkSession, d: str) -> DataFrame:
    return topics.facet_counts(_groups(spark, d))


def topic_retrieval(spark: SparkSession, d: str) -> DataFrame:
    return topics.retrieve(topics.topic_map(_groups(spark, d)), ASKED).select("doc_id", "topic", "ord", "group_ord", "group_id")


def empty_topics(spark: SparkSession, d: str) -> DataFrame:
    return topics.empty_topics(_groups(spark, d), ASKED).select("doc_id", "topic", "ord")


def evidence_packet(spark: SparkSession, d: str) -> DataFrame:
    found = topics.retrieve(topics.topic_map(_groups(spark, d)), ASKED)
    return topics.evidence(found, items(spark, d)).select("doc_id", "topic", "group_id", "role", "pos", "text", "page", "is_blank")


def cited_items(spark: SparkSession, d: str) -> DataFrame:
    """Items that any group cites, with how often."""
    return topics.evidence(_groups(spark, d), items(spark, d)).groupBy("doc_id", "pos").agg(F.count("*").alias("n"))


def passage_violations(spark: SparkSession, d: str) -> DataFrame:
    """Each rule broken on purpose in some of the groups."""
    g = classified(spark, d)
    key = F.col("doc_id") % 50
    bad = g.withColumn("topic", F.when(key == 1, "weather").otherwise(F.col("topic")))
    bad = bad.withColumn("evidence", F.when(key == 2, F.array().cast("array<int>")).when(key == 3, F.concat("evidence", "evidence")).when(key == 4, F.array(F.lit(100_000))).when(key == 5, F.array(F.col("chunk_no") * 8 + 8)).otherwise(F.col("evidence")))
    bad = bad.withColumn("context", F.when(key == 6, F.col("evidence")).otherwise(F.col("context")))
    bad = bad.withColumn("chunk_no", F.when(key == 7, F.col("chunk_no") + 1000).otherwise(F.col("chunk_no")))
    return topics.violations(bad, items(spark, d), chunks(spark, d)).where("rule <> 'repeated_topic'").groupBy("rule").agg(F.countDistinct("doc_id", "chunk_no", "topic").alias("n"))


def _scope(spark: SparkSession, d: str) -> DataFrame:
    own = items(spark, d)
    return topics.packet_scope(own, structure.unit_spans(own), chunks(spark, d), structure.heading_paths(own))


def citation_scope(spark: SparkSession, d: str) -> DataFrame:
    """How many items the answer for each chunk may cite, and their places added up."""
    return _scope(spark, d).groupBy("doc_id", "chunk_no").agg(F.count("*").alias("n"), F.sum("pos").alias("places"))


def citation_breaches(spark: SparkSession, d: str) -> DataFrame:
    """Citations out of scope and chunks without an answer, with contexts far away and answers left out on purpose."""
    key = F.col("doc_id") % 5
    g = classified(spark, d).withColumn("context", F.when(key == 1, F.array(F.col("chunk_no") * 8 + 30)).when(key == 2, F.array(F.greatest(F.col("chunk_no") * 8 - 20, F.lit(0)))).otherwise(F.col("context")))
    every = chunks(spark, d)
    answered = every.where((F.col("doc_id") + F.col("chunk_no")) % 7 != 0).select("doc_id", "chunk_no")
    found = topics.violations(g, items(spark, d), every, _scope(spark, d), answered)
    return found.where("rule IN ('out_of_scope', 'unanswered')").select("rule", "doc_id", "chunk_no", "topic")


def _mapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Groups of a topic map and those of the answers; some that the map has changed, and some that cite what is not there."""
    key = F.col("doc_id") % 25
    answers = topics.with_parents(classified(spark, d)).withColumn("context", F.when(key == 2, F.array(F.lit(100_000))).otherwise(F.col("context")))
    answers = topics.identified(answers)
    return answers.withColumn("evidence", F.when(key == 1, F.concat("evidence", F.array(F.lit(0)))).otherwise(F.col("evidence"))), answers


def passage_targets(spark: SparkSession, d: str) -> DataFrame:
    """Chunks whose answers hold each group of the map; every fifth document's answers also stand in the chunk after."""
    mapped, answers = _mapped(spark, d)
    again = answers.where("doc_id % 5 = 0").withColumn("chunk_no", F.col("chunk_no") + 1)
    found = review_joins.passage_targets(mapped, answers.unionByName(again))
    return found.select("doc_id", "topic", "group_id", F.array_join("target_chunks", ",").alias("target_chunks"))


def review_breaches(spark: SparkSession, d: str) -> DataFrame:
    return review_joins.review_breaches(*_mapped(spark, d), items(spark, d), "pos")


def chunk_reviews(spark: SparkSession, d: str) -> DataFrame:
    own = items(spark, d)
    above = structure.heading_paths(own).select("doc_id", "pos", F.col("heading_positions").alias("heading_ids"))
    held = own.join(above, ["doc_id", "pos"]).select("doc_id", F.floor(F.col("pos") / 8).cast("int").alias("chunk_no"), "item_id", "page", "heading_ids")
    found = review_joins.chunk_reviews(chunks(spark, d), held, classified(spark, d))
    return found.select("doc_id", "chunk_no", "n_items", F.array_join("pages", ",").alias("pages"), "n_headings", F.array_join("final_topics", ",").alias("final_topics"), "is_unclassified")


def cited_texts(spark: SparkSession, d: str) -> DataFrame:
    """Orders stand for documents with a table and a note each; some are cited that are not there or say nothing."""
    o, key = table(spark, d, "orders"), F.col("o_orderkey")
    both = o.select(key.alias("doc_id"), F.explode(F.array(F.lit("#/tables/0"), F.lit("#/texts/0"))).alias("item_id"), "o_orderstatus", "o_orderpriority")
    cited = both.select("doc_id", "item_id")
    original = F.when(F.col("doc_id") % 3 == 0, F.col("o_orderstatus")).when(F.col("doc_id") % 3 == 1, "")
    own = both.where("doc_id % 11 <> 0").select("doc_id", "item_id", original.alias("original_text"), F.when(F.col("doc_id") % 7 == 0, " ").otherwise(F.col("o_orderpriority")).alias("text"))
    cells = table(spark, d, "lineitem").where("l_orderkey % 13 <> 0").select(F.col("l_orderkey").alias("doc_id"), F.lit("#/tables/0").alias("item_id"), F.floor((F.col("l_linenumber") - 1) / 2).alias("row_start"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"), F.col("l_partkey").cast("string").alias("text"))
    return review_joins.cited_texts(cited, own, cells)


def topic_signals(spark: SparkSession, d: str) -> DataFrame:
    return topics.signals(items(spark, d), RULES)


def threshold_topics(spark: SparkSession, d: str) -> DataFrame:
    scores = table(spark, d, "documents").select("doc_id", F.get(F.array(*map(F.lit, topics.TOPICS)), (F.col("doc_id") % 11).cast("int")).alias("topic"), ((F.col("n_chars") % 100) / 100).alias("p"))
    return topics.above_threshold(scores)


_RATES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax"]


def _rates(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        *_RATES,
        F.when(n % 3 == 0, "fixed").otherwise("floating").alias("kind"),
        F.when(n % 3 == 0, F.col("l_tax")).alias("fixed_rate"),
        F.when((n % 3 != 0) & (n % 5 != 0), F.col("l_discount")).alias("benchmark_rate"),
        F.when(n % 3 != 0, F.col("l_tax")).alias("margin_rate"),
        F.when((n % 3 != 0) & (n % 2 == 0), F.lit(0.02)).alias("floor_rate"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"),
    )


def _computed(rates: DataFrame) -> DataFrame:
    return rates.withColumn("computed", M.total_rate(*[F.col(c) for c in ("kind", "fixed_rate", "benchmark_rate", "margin_rate", "floor_rate")]))


def rate_totals(spark: SparkSession, d: str) -> DataFrame:
    return _computed(_rates(spark, d)).select("key", "kind", (F.col("computed") * 1_000_000).cast("long").alias("millionths"))


def rate_fills(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_linenumber")
    own = _computed(_rates(spark, d)).withColumn("status", F.when(n % 2 == 0, "missing").otherwise("supported")).withColumn("stated", F.when(n % 2 == 1, F.col("l_tax")))
    total = M.filled_total(F.col("stated"), F.col("status"), F.col("computed"), F.when(n == 4, 1).otherwise(0))
    return own.select("key", (total * 1_000_000).cast("long").alias("millionths"))


def rate_violations(spark: SparkSession, d: str) -> DataFrame:
    rates = _rates(spark, d)
    wrong = _computed(rates).withColumn("stated", F.when(F.col("l_linenumber") % 2 == 0, M.exact(F.col("l_tax")) + M.exact(F.col("l_discount"))))
    return terms.calculation_violations(rates).unionByName(terms.total_mismatches(wrong)).groupBy("rule").agg(F.count("*").alias("n"))


def amount_violations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    amounts = table(spark, d, "orders").select(k.alias("key"), F.when(k % 10 == 0, "missing").when(k % 10 == 1, "not_applicable").when(k % 10 == 2, "uncertain").otherwise("supported").alias("status"), F.when(k % 7 != 0, F.col("o_totalprice")).alias("value"))
    lowered = amounts.where("value IS NOT NULL").select("key", (F.col("value") - 1000).alias("value"))
    return terms.amount_violations(amounts).unionByName(terms.number_violations(lowered))


def party_graph_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers in tens as the parties of a document, of which each has one of them above it or two."""
    s = F.col("s_suppkey")
    doc, party = F.floor(s / 10).alias("doc_id"), (s % 10).alias("child")
    own = table(spark, d, "supplier")
    edges = own.select(doc, ((s * s + 1) % 10).alias("parent"), party).unionByName(own.where(s % 3 == 0).select(doc, (F.floor(s / 7) % 10).alias("parent"), party))
    return terms.cyclic_parties(edges)


def relationship_violations(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "orders").select((F.col("o_custkey") % 40).alias("parent"), (F.col("o_orderkey") % 37).alias("child"))
    return terms.relationship_violations(edges)


def term_reference_checks(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_custkey") + F.when(F.col("o_orderkey") % 100 == 0, 10_000_000).otherwise(0)).alias("customer"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_suppkey") * F.when(F.col("l_partkey") % 50 == 0, -1).otherwise(1)).alias("supplier"))
    customers, suppliers = table(spark, d, "customer").select(F.col("c_custkey").alias("customer")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("supplier"))
    names = terms.repeated(table(spark, d, "part"), F.lower(F.trim("p_name")), "repeated_name").groupBy("rule").agg(F.count("*").alias("n"))
    missing = terms.missing_references(orders, "customer", customers, "customer", "unknown_customer").unionByName(terms.missing_references(lines, "supplier", suppliers, "supplier", "unknown_supplier"))
    return missing.groupBy("rule").agg(F.count("*").alias("n")).unionByName(names)


def role_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", T.normal_role(F.concat(F.lit("  "), "c_mktsegment", F.lit(" \t of  "), F.lit("Nation "), F.col("c_nationkey").cast("string"), F.lit(" "))).alias("role"))


def role_violations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    roles = table(spark, d, "customer").select(k.alias("party_id"), F.explode(F.array(F.lit("Lender"), F.when(k % 5 == 0, " lender ").otherwise("Borrower"), F.when(k % 7 == 0, "Holding  Company").otherwise("Agent"))).alias("role"))
    return terms.role_violations(roles)


_PLAIN = f"""
labelled AS (
  SELECT doc_id, pos // 8 AS chunk_no, pos, [{", ".join(f"'{t}'" for t in topics.TOPICS)}][length(text) % {MODULUS} + 1] AS topic
  FROM items WHERE length(text) % {MODULUS} < 11
),
classified AS (
  SELECT doc_id, chunk_no, topic, list(pos ORDER BY pos) AS evidence, CASE WHEN chunk_no > 0 AND chunk_no % 2 = 0 THEN [chunk_no * 8 - 1] ELSE [] END AS context
  FROM labelled GROUP BY doc_id, chunk_no, topic
)"""
_GROUPS = f"""WITH {ITEMS}, {_PLAIN},
lifted AS (SELECT * FROM classified UNION ALL SELECT doc_id, chunk_no, split_part(topic, '.', 1), evidence, context FROM classified WHERE topic LIKE '%.%'),
groups AS (
  SELECT doc_id, topic, chunk_no, evidence, context, 'passage-' || sha256('["' || doc_id || '", "{topics.TAXONOMY}", "' || topic || '", ["'
    || array_to_string(list_transform(evidence, lambda p: '#/texts/' || p), '", "') || '"], '
    || CASE WHEN len(context) = 0 THEN '[]' ELSE '["' || array_to_string(list_transform(context, lambda p: '#/texts/' || p), '", "') || '"]' END || ']') AS group_id
  FROM lifted
),
mapped AS (SELECT *, row_number() OVER (PARTITION BY doc_id, topic ORDER BY evidence, context) - 1 AS group_ord FROM groups)"""
#: Groups as the answers hold them, some of which cite what is not there.
_TOLD = _GROUPS.replace("lifted AS (SELECT * FROM classified UNION ALL SELECT doc_id, chunk_no, split_part(topic, '.', 1), evidence, context FROM classified", "answered AS (SELECT * REPLACE (CASE WHEN doc_id % 25 = 2 THEN [100000] ELSE context END AS context) FROM classified),\nlifted AS (SELECT * FROM answered UNION ALL SELECT doc_id, chunk_no, split_part(topic, '.', 1), evidence, context FROM answered") + ", told AS (SELECT doc_id, topic, group_id, min(chunk_no) AS chunk_no FROM groups GROUP BY ALL)"
#: Units as lists run, across chunks too; headings above each item; what the answer for each chunk may cite.
_SCOPE = """
began AS (SELECT *, coalesce(coalesce(list_key, '#' || pos) <> lag(coalesce(list_key, '#' || pos)) OVER (PARTITION BY doc_id ORDER BY pos), true) AS new FROM items),
numbered AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS unit_no FROM began),
ends AS (SELECT doc_id, pos // 8 AS chunk_no, min(pos) AS a, max(pos) AS z, sum(CASE WHEN new THEN 1 ELSE 0 END) AS n_new FROM numbered GROUP BY ALL),
edges AS (SELECT *, sum(n_new) OVER (PARTITION BY doc_id ORDER BY chunk_no ROWS UNBOUNDED PRECEDING) AS upto FROM ends),
direct AS (
  SELECT e.doc_id, e.chunk_no, n.pos FROM edges e JOIN numbered n ON n.doc_id = e.doc_id AND (n.pos BETWEEN e.a AND e.z OR n.unit_no = e.upto - e.n_new - 1 OR n.unit_no = e.upto)),
above AS (
  SELECT d.doc_id, d.chunk_no, h.pos FROM direct d JOIN items h ON h.doc_id = d.doc_id AND h.level IS NOT NULL AND h.pos <= d.pos
  WHERE NOT EXISTS (SELECT 1 FROM items o WHERE o.doc_id = h.doc_id AND o.level <= h.level AND o.pos > h.pos AND o.pos <= d.pos)),
scope AS (SELECT * FROM direct UNION SELECT * FROM above)"""
_ASKED = ", ".join(f"('{t}', {topics.TOPICS.index(t)})" for t in ASKED)
_RATE_SQL = """WITH r AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS key, l_linenumber AS n,
    CAST(CAST(l_discount AS VARCHAR) AS DECIMAL(30, 12)) AS disc, CAST(CAST(l_tax AS VARCHAR) AS DECIMAL(30, 12)) AS tax FROM lineitem),
  c AS (SELECT *, CASE WHEN n % 3 = 0 THEN tax WHEN n % 5 <> 0 THEN greatest(disc, CASE WHEN n % 2 = 0 THEN CAST(0.02 AS DECIMAL(30, 12)) END) + tax END AS computed FROM r)"""

QUERIES = {f.__name__: f for f in (passage_groups, topic_map, topic_unclassified, topic_facets, topic_retrieval, empty_topics, evidence_packet, cited_items, passage_violations, citation_scope, citation_breaches, passage_targets, review_breaches, chunk_reviews, cited_texts, topic_signals, threshold_topics, rate_totals, rate_fills, rate_violations, amount_violations, party_graph_cycles, relationship_violations, term_reference_checks, role_normalize, role_violations)}

ORACLES = {
    "passage_groups": f"{_GROUPS} SELECT doc_id, topic, group_id, chunk_no, array_to_string(evidence, ',') AS evidence, array_to_string(context, ',') AS context FROM groups",
    "topic_map": f"{_GROUPS} SELECT doc_id, topic, group_id, group_ord FROM mapped",
    "topic_unclassified": f"WITH {ITEMS} SELECT doc_id, pos // 8 AS chunk_no FROM items GROUP BY ALL HAVING min(length(text) % {MODULUS}) >= 11",
    "topic_facets": f"{_GROUPS} SELECT topic, count(*) AS n_groups, count(DISTINCT doc_id) AS n_docs FROM groups GROUP BY topic",
    "topic_retrieval": f"{_GROUPS} SELECT doc_id, topic, ord, group_ord, group_id FROM mapped JOIN (VALUES {_ASKED}) a(topic, ord) USING (topic)",
    "empty_topics": f"{_GROUPS} SELECT d.doc_id, a.topic, a.ord FROM (SELECT DISTINCT doc_id FROM groups) d, (VALUES {_ASKED}) a(topic, ord) WHERE NOT EXISTS (SELECT 1 FROM groups g WHERE g.doc_id = d.doc_id AND g.topic = a.topic)",
    "evidence_packet": f"""{_GROUPS}, cited AS (SELECT doc_id, topic, group_id, 'evidence' AS role, unnest(evidence) AS pos FROM groups UNION ALL SELECT doc_id, topic, group_id, 'context', unnest(context) FROM groups)
        SELECT c.*, i.text, i.page, NOT regexp_matches(i.text, '\\S') AS is_blank FROM cited c JOIN (VALUES {_ASKED}) a(topic, ord) USING (topic) LEFT JOIN items i ON i.doc_id = c.doc_id AND i.pos = c.pos""".replace("SELECT c.*,", "SELECT c.doc_id, c.topic, c.group_id, c.role, c.pos,"),
    "cited_items": f"{_GROUPS} SELECT doc_id, pos, count(*) AS n FROM (SELECT doc_id, unnest(evidence) AS pos FROM groups UNION ALL SELECT doc_id, unnest(context) FROM groups) GROUP BY ALL",
    "passage_violations": f"""WITH {ITEMS}, {_PLAIN}, bad AS (
          SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN chunk_no + 1000 ELSE chunk_no END AS chunk_no, CASE WHEN doc_id % 50 = 1 THEN 'weather' ELSE topic END AS topic,
            CASE doc_id % 50 WHEN 2 THEN [] WHEN 3 THEN list_concat(evidence, evidence) WHEN 4 THEN [100000] WHEN 5 THEN [chunk_no * 8 + 8] ELSE evidence END AS evidence,
            CASE WHEN doc_id % 50 = 6 THEN evidence ELSE context END AS context FROM classified),
        cited AS (SELECT doc_id, chunk_no, topic, unnest(list_concat(evidence, context)) AS pos FROM bad),
        broken AS (
          SELECT 'unknown_topic' AS rule, doc_id, chunk_no, topic FROM bad WHERE topic = 'weather'
          UNION ALL SELECT 'no_evidence', doc_id, chunk_no, topic FROM bad WHERE len(evidence) = 0
          UNION ALL SELECT 'repeated_citation', doc_id, chunk_no, topic FROM bad WHERE len(evidence) <> len(list_distinct(evidence)) OR len(context) <> len(list_distinct(context))
          UNION ALL SELECT 'overlap', doc_id, chunk_no, topic FROM bad WHERE list_has_any(evidence, context)
          UNION ALL SELECT 'unknown_item', c.doc_id, c.chunk_no, c.topic FROM cited c WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.doc_id = c.doc_id AND i.pos = c.pos)
          UNION ALL SELECT 'evidence_outside', b.doc_id, b.chunk_no, b.topic FROM bad b JOIN (SELECT doc_id, pos // 8 AS chunk_no, min(pos) AS a, max(pos) AS z FROM items GROUP BY ALL) c ON c.doc_id = b.doc_id AND c.chunk_no = b.chunk_no
            WHERE len(evidence) > 0 AND len(list_filter(evidence, lambda p: p BETWEEN c.a AND c.z)) = 0
          UNION ALL SELECT 'unknown_chunk', doc_id, chunk_no, topic FROM bad WHERE chunk_no >= 1000)
        SELECT rule, count(DISTINCT (doc_id, chunk_no, topic)) AS n FROM broken GROUP BY rule""",
    "citation_scope": f"WITH {ITEMS}, {_SCOPE} SELECT doc_id, chunk_no, count(*) AS n, CAST(sum(pos) AS BIGINT) AS places FROM scope GROUP BY ALL",
    "citation_breaches": f"""WITH {ITEMS}, {_PLAIN}, {_SCOPE}, bad AS (SELECT doc_id, chunk_no, topic, unnest(list_concat(evidence, CASE doc_id % 5 WHEN 1 THEN [chunk_no * 8 + 30] WHEN 2 THEN [greatest(chunk_no * 8 - 20, 0)] ELSE context END)) AS pos FROM classified)
        SELECT DISTINCT 'out_of_scope' AS rule, doc_id, chunk_no, topic FROM bad b WHERE NOT EXISTS (SELECT 1 FROM scope s WHERE s.doc_id = b.doc_id AND s.chunk_no = b.chunk_no AND s.pos = b.pos)
        UNION ALL SELECT 'unanswered', doc_id, chunk_no, NULL FROM ends WHERE (doc_id + chunk_no) % 7 = 0""",
    "passage_targets": f"""{_TOLD}, again AS (SELECT * FROM told UNION ALL SELECT * REPLACE (chunk_no + 1 AS chunk_no) FROM told WHERE doc_id % 5 = 0)
        SELECT m.doc_id, m.topic, m.group_id, coalesce(string_agg(DISTINCT CAST(a.chunk_no AS VARCHAR), ',' ORDER BY CAST(a.chunk_no AS VARCHAR)), '') AS target_chunks
        FROM told m LEFT JOIN again a ON m.doc_id % 25 <> 1 AND a.doc_id = m.doc_id AND a.topic = m.topic AND a.group_id = m.group_id GROUP BY ALL""".replace("DISTINCT CAST(a.chunk_no AS VARCHAR), ',' ORDER BY CAST(a.chunk_no AS VARCHAR)", "CAST(a.chunk_no AS VARCHAR), ',' ORDER BY a.chunk_no"),
    "review_breaches": f"""{_TOLD} SELECT 'no_target' AS rule, doc_id, topic, group_id FROM told WHERE doc_id % 25 = 1 UNION ALL SELECT 'missing_citation', doc_id, topic, group_id FROM told WHERE doc_id % 25 = 2""",
    "chunk_reviews": f"""WITH {ITEMS}, {_PLAIN}, heads AS (SELECT doc_id, pos, level FROM items WHERE level IS NOT NULL),
        above AS (SELECT i.doc_id, i.pos // 8 AS chunk_no, count(DISTINCT h.pos) AS n FROM items i JOIN heads h ON h.doc_id = i.doc_id AND h.pos <= i.pos
          WHERE NOT EXISTS (SELECT 1 FROM heads l WHERE l.doc_id = i.doc_id AND l.pos > h.pos AND l.pos <= i.pos AND l.level <= h.level) GROUP BY ALL),
        c AS (SELECT doc_id, pos // 8 AS chunk_no, count(*) AS n_items, coalesce(array_to_string(list_sort(list(DISTINCT page) FILTER (WHERE page IS NOT NULL)), ','), '') AS pages FROM items GROUP BY ALL),
        t AS (SELECT doc_id, chunk_no, array_to_string(list_sort(list(DISTINCT topic)), ',') AS topics FROM classified GROUP BY ALL)
        SELECT c.doc_id, c.chunk_no, c.n_items, c.pages, coalesce(a.n, 0) AS n_headings, coalesce(t.topics, '') AS final_topics, t.topics IS NULL AS is_unclassified
        FROM c LEFT JOIN above a USING (doc_id, chunk_no) LEFT JOIN t USING (doc_id, chunk_no)""",
    "cited_texts": """WITH r AS (SELECT l_orderkey AS doc_id, (l_linenumber - 1) // 2 AS row_no, string_agg(CAST(l_partkey AS VARCHAR), chr(9) ORDER BY l_linenumber, l_partkey, l_suppkey) AS line FROM lineitem WHERE l_orderkey % 13 <> 0 GROUP BY ALL),
        g AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY row_no) AS grid FROM r GROUP BY doc_id),
        o AS (SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus WHEN o_orderkey % 7 = 0 THEN ' ' ELSE o_orderpriority END AS own FROM orders)
        SELECT o.doc_id, '#/tables/0' AS item_id, CASE WHEN o.doc_id % 11 <> 0 THEN grid END AS text, CASE WHEN o.doc_id % 11 = 0 THEN 'missing_citation' WHEN grid IS NULL THEN 'table_without_cells' END AS problem FROM o LEFT JOIN g USING (doc_id)
        UNION ALL SELECT doc_id, '#/texts/0', CASE WHEN doc_id % 11 <> 0 AND own <> ' ' THEN own END, CASE WHEN doc_id % 11 = 0 THEN 'missing_citation' WHEN own = ' ' THEN 'unreadable' END FROM o""",
    "topic_signals": "WITH " + ITEMS + ", hits AS (" + " UNION ALL ".join(f"SELECT doc_id, pos, '{t}' AS topic FROM items WHERE regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_]){p}($|[^\\p{{L}}\\p{{N}}_])')" for t, p in RULES) + "), every AS (SELECT * FROM hits UNION SELECT doc_id, pos, split_part(topic, '.', 1) FROM hits WHERE topic LIKE '%.%') SELECT i.doc_id, i.pos, e.topic FROM items i LEFT JOIN every e ON e.doc_id = i.doc_id AND e.pos = i.pos",
    "threshold_topics": f"WITH s AS (SELECT doc_id, [{', '.join(f"'{t}'" for t in topics.TOPICS)}][doc_id % 11 + 1] AS topic FROM documents WHERE n_chars % 100 >= 50) SELECT * FROM s UNION SELECT doc_id, split_part(topic, '.', 1) FROM s WHERE topic LIKE '%.%'",
    "rate_totals": f"{_RATE_SQL} SELECT key, CASE WHEN n % 3 = 0 THEN 'fixed' ELSE 'floating' END AS kind, CAST(computed * 1000000 AS BIGINT) AS millionths FROM c",
    "rate_fills": f"{_RATE_SQL} SELECT key, CAST(CASE WHEN n % 2 = 0 THEN CASE WHEN n <> 4 THEN computed END ELSE tax END * 1000000 AS BIGINT) AS millionths FROM c",
    "rate_violations": f"{_RATE_SQL}, t AS (SELECT *, CASE WHEN n % 2 = 0 THEN tax + disc END AS stated FROM c) SELECT * FROM (SELECT 'floating_without_parts' AS rule, count(*) AS n FROM c WHERE n % 3 <> 0 AND n % 5 = 0 UNION ALL SELECT 'total_mismatch', count(*) FROM t WHERE stated <> computed) WHERE n > 0",
    "amount_violations": """WITH a AS (SELECT o_orderkey AS key, o_orderkey % 10 IN (0, 1) AS none, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS value FROM orders)
        SELECT 'value_missing' AS rule, key FROM a WHERE NOT none AND value IS NULL UNION ALL SELECT 'value_unexpected', key FROM a WHERE none AND value IS NOT NULL
        UNION ALL SELECT 'bad_number', key FROM a WHERE value - 1000 < 0""",
    "party_graph_cycles": """WITH RECURSIVE e AS (SELECT s_suppkey // 10 AS doc_id, (s_suppkey * s_suppkey + 1) % 10 AS parent, s_suppkey % 10 AS child FROM supplier
          UNION SELECT s_suppkey // 10, (s_suppkey // 7) % 10, s_suppkey % 10 FROM supplier WHERE s_suppkey % 3 = 0),
        reach AS (SELECT doc_id, parent AS start, child AS party FROM e WHERE parent <> child UNION SELECT r.doc_id, r.start, e.child FROM reach r JOIN e ON e.doc_id = r.doc_id AND e.parent = r.party AND e.parent <> e.child)
        SELECT doc_id, start AS party FROM reach WHERE start = party""",
    "relationship_violations": "WITH e AS (SELECT o_custkey % 40 AS parent, o_orderkey % 37 AS child FROM orders) SELECT DISTINCT 'self' AS rule, parent, child FROM e WHERE parent = child UNION ALL SELECT 'repeated', parent, child FROM e GROUP BY parent, child HAVING count(*) > 1",
    "term_reference_checks": """SELECT rule, count(*) AS n FROM (
          SELECT 'unknown_customer' AS rule FROM orders WHERE o_custkey + CASE WHEN o_orderkey % 100 = 0 THEN 10000000 ELSE 0 END NOT IN (SELECT c_custkey FROM customer)
          UNION ALL SELECT 'unknown_supplier' FROM lineitem WHERE l_suppkey * CASE WHEN l_partkey % 50 = 0 THEN -1 ELSE 1 END NOT IN (SELECT s_suppkey FROM supplier)
          UNION ALL SELECT 'repeated_name' FROM part GROUP BY lower(trim(p_name)) HAVING count(*) > 1) GROUP BY rule""",
    "role_normalize": "SELECT c_custkey, lower(replace(c_mktsegment, ' ', '_')) || '_of_nation_' || c_nationkey AS role FROM customer",
    "role_violations": "SELECT 'repeated_role' AS rule, c_custkey AS party_id, 'lender' AS role FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT 'corporate_role', c_custkey, 'holding_company' FROM customer WHERE c_custkey % 7 = 0",
}
