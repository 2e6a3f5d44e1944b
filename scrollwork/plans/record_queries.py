"""Queries over catalogs, identities, routes and raw inputs, with faults put in on purpose, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, extraction, identity, inputs, reviews, routes, topics
from .adapters import ITEMS, LOG, items, log, table
from .topic_queries import _GROUPS, _PLAIN, ASKED, _groups, _scope, chunks, classified


def _pick(values: list, at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at.cast("int"))


def annotation_passages(spark: SparkSession, d: str) -> DataFrame:
    """Lines as passages: some have another original wording, some only white space."""
    own, pos = items(spark, d), F.col("pos")
    made = own.select(
        "doc_id", pos.alias("ord"), "item_id", F.when(pos % 5 == 1, " \t").when(pos % 5 == 2, "").when(pos % 5 == 3, F.concat(F.lit("> "), "text")).alias("orig"), "text",
        F.when(pos % 7 != 0, F.col("label")).alias("label"), F.array_compact(F.array("page")).alias("pages"), F.array().cast("array<string>").alias("heading_ids"), F.array().cast("array<string>").alias("containers"),
    )
    return catalog.passages(made).select("doc_id", "ord", "item_id", "text", "label")


def catalog_changes(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose catalog differs between two conversions: in a third of them one line was changed, in some two were
    swapped."""
    own = items(spark, d).select("doc_id", F.col("pos").alias("ord"), "item_id", F.lit(None).cast("string").alias("orig"), "text", "label", F.array_compact(F.array("page")).alias("pages"), F.array().cast("array<string>").alias("heading_ids"), F.array().cast("array<string>").alias("containers"))
    k, at = F.col("doc_id"), F.col("ord")
    later = own.withColumn("text", F.when((k % 3 == 0) & (at == 0), F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    later = later.withColumn("ord", F.when((k % 7 == 1) & (at < 2), 1 - at).otherwise(at))
    a, b = (catalog.catalogs(catalog.passages(x)) for x in (own, later))
    return a.join(b.select("doc_id", F.col("catalog_sha").alias("later")), "doc_id").where("catalog_sha <> later").select("doc_id", "n_passages")


def topic_map_problems(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 20
    documents = table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("source_sha"))
    packets = identity.packet_hashes(_scope(spark, d))
    taxonomy = F.array(*map(F.lit, topics.TOPICS))
    made = documents.join(packets, "doc_id", "left").select(
        F.when(k == 1, -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"),
        F.when(k == 2, "running").otherwise("completed").alias("status"),
        F.when(k == 3, 3).when(k.isin(4, 5), 1).otherwise(2).alias("schema_version"),
        F.when(k == 6, None).otherwise("final").alias("classification_status"),
        F.when(k == 7, F.lit("")).otherwise(F.col("source_sha")).alias("source_sha"),
        F.when(k == 8, "v0").otherwise(topics.TAXONOMY).alias("taxonomy_version"),
        F.when(k == 9, F.reverse(taxonomy)).otherwise(taxonomy).alias("taxonomy"),
        F.when(k.isin(4, 10, 11), None).when(k == 12, "other").otherwise(identity.LAYOUT).alias("layout"),
        F.when(k == 11, True).alias("has_proposals"),
        F.when(k == 13, 1).otherwise(2).alias("profile_version"),
        F.when(k.isin(5, 14), F.lit("x")).otherwise(F.col("packets_sha")).alias("packets_sha"),
    )
    return identity.topic_map_problems(made, documents, packets)


def selection_differences(spark: SparkSession, d: str) -> DataFrame:
    mapped = topics.topic_map(_groups(spark, d))
    saved = topics.retrieve(mapped, ASKED).select("doc_id", "topic", "ord", "group_ord", "group_id")
    saved = saved.where("doc_id % 20 <> 1").withColumn("group_ord", F.when(F.col("doc_id") % 20 == 2, F.col("group_ord") + 1).otherwise(F.col("group_ord")))
    return identity.selection_differences(saved, mapped, ASKED).select("side", "doc_id", "topic", "group_ord", "group_id")


def evidence_problems(spark: SparkSession, d: str) -> DataFrame:
    k, sha = F.col("doc_id") % 20, F.sha2(F.col("text").cast("binary"), 256)
    docs = table(spark, d, "documents")
    other = lambda when: F.when(k == when, "other").otherwise(sha)
    maps = docs.select("doc_id", other(1).alias("source_sha"))
    made = docs.where(k != 2).select("doc_id", other(3).alias("artifact_source"), other(4).alias("document_source"), F.when(k == 5, None).otherwise(sha).alias("canonical_sha"))
    converted = docs.where(k % 2 == 1).select("doc_id", other(7).alias("source_sha"), other(9).alias("canonical_sha"))
    return identity.evidence_problems(maps, made, converted)


def priced_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls by their model's route and price."""
    k = F.col("k")
    models = [*routes.ROUTES, "unheard-of"]
    calls = log(spark, d).where("event = 'llm_attempt'").select("event_id", _pick(models, k % len(models)).alias("model"), F.when(k % 4 == 0, "asked").alias("style"), (k * 4000).cast("long").alias("input_tokens"), (k * 10).cast("long").alias("cached_tokens"), (k * 7).cast("long").alias("written_tokens"), F.when(k % 6 != 0, k.cast("long")).alias("output_tokens"))
    found = routes.priced(routes.routed(calls, routes.routes(spark)), routes.prices(spark))
    return found.select("event_id", "model", "style", (F.col("estimate") * 1_000_000_000).cast("long").alias("billionths"), "currency")


#: Settings of a run with their problem; {} is the document's id.
SETTINGS = (
    ('{"document_id": "{}"}', None),
    ('{"document_id": "{}", "debug": true, "model": "gpt-6-luna", "reasoning_effort": "xhigh"}', None),
    ('{"document_id": "{}", "model": "qwen3.8-flash", "reasoning_effort": "none"}', None),
    ('["{}"]', "not_an_object"),
    ('{"document_id": "{}", "colour": 1}', "unknown_setting"),
    ('{"document_id": "x{}"}', "unknown_document"),
    ('{"document_id": 5}', "unknown_document"),
    ('{"document_id": "{}", "use_hierarchy": 1}', "not_a_flag"),
    ('{"document_id": "{}", "model": "a b"}', "bad_model"),
    ('{"document_id": "{}", "classification_model": null}', "bad_model"),
    ('{"document_id": "{}", "model": "gpt-2"}', "unrouted_model"),
    ('{"document_id": "{}", "reasoning_effort": "most"}', "unknown_effort"),
    ('{"document_id": "{}", "classification_reasoning_effort": 3}', "unknown_effort"),
    ('{"document_id": "{}", "classification_model": "qwen3.8-flash", "classification_reasoning_effort": "low"}', "effort_not_in_style"),
)


def settings_problems(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("run_id"), F.col("doc_id").cast("string").alias("document_id"))
    raw = F.replace(_pick([s for s, _ in SETTINGS], F.col("run_id") % len(SETTINGS)), F.lit("{}"), F.col("document_id"))
    made = docs.select("run_id", F.parse_json(raw).alias("value"))
    return routes.settings_problems(made, routes.routes(spark), docs.select("document_id")).select("run_id", "problem")


def run_sources(spark: SparkSession, d: str) -> DataFrame:
    """Users stand for runs, their events for what they captured: paths and hashes of documents, right ones and others."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("document_id"), F.concat(F.lit("/in/"), "doc_id").alias("path"), F.sha2(F.concat(F.lit("d"), "doc_id").cast("binary"), 256).alias("sha"))
    e, at = table(spark, d, "events"), F.col("event_id")
    captures = e.select(F.col("user_id").alias("run_id"), at.alias("seq"), F.when((at % 4 == 0) & (F.col("user_id") % 3 == 0), F.concat(F.lit("/in/"), at % 3000)).alias("path"), F.when(at % 5 == 0, F.sha2(F.concat(F.lit("d"), at % 5000).cast("binary"), 256)).when(at % 5 == 1, "d").alias("sha"))
    return routes.run_sources(e.select(F.col("user_id").alias("run_id")).distinct(), captures, docs)


#: Containers with the rule they break.
CONTAINERS = (
    ("{}", None),
    ('{"children": []}', None),
    ('{"children": [{"$ref": "#/texts/0"}, {"$ref": "#/texts/1", "x": 1}]}', None),
    ('{"children": "#/texts/0"}', "no_list"),
    ('{"children": null}', "no_list"),
    ('{"children": {"$ref": "#/texts/0"}}', "no_list"),
    ('{"children": ["#/texts/0"]}', "no_reference"),
    ('{"children": [{"$ref": "#/texts/0"}, {"ref": "x"}]}', "no_reference"),
    ('{"children": [{"$ref": 5}]}', "no_reference"),
    ('{"children": [null]}', "no_reference"),
)


def reference_problems(spark: SparkSession, d: str) -> DataFrame:
    raw = _pick([c for c, _ in CONTAINERS], F.col("doc_id") % len(CONTAINERS))
    return inputs.reference_problems(table(spark, d, "documents").select("doc_id", F.lit("#/groups/0").alias("item_id"), F.parse_json(raw).alias("value")))


def position_problems(spark: SparkSession, d: str) -> DataFrame:
    k, pos = F.col("doc_id") % 20, F.col("pos")
    ref = F.when((k == 1) & (pos == 2), F.lit("#/texts/02")).when((k == 2) & (pos == 1), None).when((k == 3) & (pos < 2), F.concat(F.lit("#/texts/"), 1 - pos)).otherwise(F.col("item_id"))
    return inputs.position_problems(items(spark, d).select("doc_id", F.lit("texts").alias("collection"), pos.alias("position"), ref.alias("self_ref")))


def manifest_mode_problems(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 16
    made = table(spark, d, "documents").select(
        "doc_id", (k < 8).alias("use_hierarchy"), F.when(k.isin(1, 9), True).when((k == 2) | (k >= 10), False).alias("enabled"), F.when(k != 11, "disabled").alias("status"),
        (k != 12).alias("names_artifact"), F.when(k == 3, "other.json").when((k == 4) | ((k >= 8) & (k != 13)), None).otherwise("h.json").alias("artifact"), F.when(k != 5, "h.json").alias("expected"),
    )
    return inputs.manifest_mode_problems(made)


def _legacy(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Answers, their labels with faults, and what each may cite."""
    ids = lambda c: F.transform(c, lambda p: F.concat(F.lit("#/texts/"), p))
    k = F.col("doc_id") % 20
    every = chunks(spark, d).select("doc_id", "chunk_no", (F.col("doc_id") * 1000 + F.col("chunk_no")).alias("row_no"))
    rows = every.where((k != 1) | (F.col("chunk_no") > 0))
    rows = rows.unionByName(rows.where((k == 2) & (F.col("chunk_no") == 0))).withColumn("chunk_no", F.when(k == 3, F.col("chunk_no") + 1000).otherwise(F.col("chunk_no")))
    labels = classified(spark, d).select("doc_id", "chunk_no", F.when(k == 4, "weather").otherwise(F.col("topic")).alias("topic"), ids(F.when(k == 5, F.concat("evidence", "evidence")).when(k == 6, F.array(F.lit(100_000))).otherwise(F.col("evidence"))).alias("cited"))
    labels = labels.unionByName(labels.where(k == 7))
    scope = items(spark, d).select("doc_id", F.floor(F.col("pos") / 8).cast("int").alias("chunk_no"), "item_id", F.col("pos").alias("ord"))
    return rows, labels, scope


def legacy_violations(spark: SparkSession, d: str) -> DataFrame:
    rows, labels, scope = _legacy(spark, d)
    return inputs.legacy_violations(rows, labels, scope, chunks(spark, d)).where("rule <> 'repeated_topic' OR doc_id % 20 = 7")


def legacy_labels(spark: SparkSession, d: str) -> DataFrame:
    _, labels, scope = _legacy(spark, d)
    right = labels.where("NOT doc_id % 20 IN (4, 6)")
    return inputs.legacy_normalized(right, scope).select("doc_id", "chunk_no", "topic", "topic_ord", F.array_join("cited", ",").alias("cited"))


def extracted(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Terms of documents of twenty customers: customers are parties, suppliers relate those of their number, orders are
    facilities, lines their interest. Faults by number."""
    c, s, o, li = (table(spark, d, n) for n in ("customer", "supplier", "orders", "lineitem"))
    k, text = F.col("c_custkey"), lambda n: F.concat(F.lit("#/texts/"), n.cast("string") if isinstance(n, Column) else F.lit(str(n)))
    doc = lambda key: F.floor(key / 20)
    none = F.array().cast("array<string>")
    party = lambda key: F.concat(F.lit("p"), key.cast("string"))
    cited = F.when(k % 53 == 0, none).when(k % 59 == 0, F.array(text(99))).when(k % 47 == 0, F.array(text(1), text(1))).otherwise(F.array(text(k % 5)))
    roles = F.when(k % 61 == 0, F.array(F.lit("Lender"), F.lit(" lender "))).when(k % 67 == 0, F.array(F.lit("Holding  Company"))).when(k % 2 == 0, F.array(F.lit("LENDER"))).otherwise(F.array(F.lit("Borrower"), F.lit("Agent")))
    parties = c.select(doc(k).alias("doc_id"), party(F.when(k % 97 == 0, k - 1).otherwise(k)).alias("party_id"), F.when(k % 89 == 0, F.concat(F.lit("  CUSTOMER "), (k - 1).cast("string"))).otherwise(F.concat(F.lit("Customer "), k.cast("string"))).alias("name"), roles.alias("roles"), cited.alias("evidence"))
    n = F.col("s_suppkey")
    relations = s.select(doc(n).alias("doc_id"), party(n).alias("parent"), F.when(n % 31 == 0, party(n)).when(n % 37 == 0, F.lit("q")).when(n % 20 == 19, party(n - 19)).otherwise(party(n + 1)).alias("child"), F.array(text(0)).alias("evidence"))
    relations = relations.unionByName(relations.where("parent LIKE '%3'"))
    q, cust = F.col("o_orderkey"), F.col("o_custkey")
    bare = lambda m: F.when(q % m == 0, none).otherwise(F.array(text(2)))
    facilities = o.select(doc(cust).alias("doc_id"), F.concat(F.lit("f"), F.when(q % 400 == 1, q - 1).otherwise(q).cast("string")).alias("facility_id"), bare(7).alias("evidence"), bare(14).alias("amount_evidence"), F.when(q % 3 == 0, "missing").otherwise("supported").alias("amount_status"))
    commitments = o.where(q % 5 == 0).select(doc(cust).alias("doc_id"), F.concat(F.lit("f"), q.cast("string")).alias("facility_id"), party(cust).alias("lender"), F.array(text(3)).alias("evidence"))
    lk, number = F.col("l_orderkey"), F.col("l_partkey") % 12
    lines = li.join(o.select(q.alias("l_orderkey"), doc(cust).alias("doc_id")), "l_orderkey")
    fixed = F.struct(F.lit("fixed").alias("kind"), F.lit(5.0).alias("fixed_rate"), F.lit(None).cast("double").alias("benchmark_rate"), F.lit(None).cast("double").alias("margin_rate"), F.lit(None).cast("double").alias("floor_rate"), F.array(text(4)).alias("evidence"))
    floating = F.struct(F.lit("benchmark_plus_margin").alias("kind"), F.lit(None).cast("double").alias("fixed_rate"), F.lit(0.1).alias("benchmark_rate"), F.lit(0.2).alias("margin_rate"), F.when(number == 7, 0.5).alias("floor_rate"), F.array(text(4)).alias("evidence"))
    interest = lines.select(
        "doc_id", F.concat_ws("-", lk, "l_linenumber", "l_partkey", "l_suppkey").alias("key"), F.concat(F.lit("f"), F.when(number == 1, -lk).otherwise(lk).cast("string")).alias("facility_id"), F.array(text(4)).alias("evidence"),
        F.when((number == 2) | (number >= 6), "floating").otherwise("fixed").alias("rate_type"), F.when((number >= 6) & (number != 8), 0.2).alias("margin_rate"), F.when(number == 7, 0.5).alias("floor_rate"),
        F.when(number == 3, None).when(number >= 6, floating).otherwise(fixed).alias("calculation"),
        F.when(number == 4, 5.5).when(number == 5, None).when(number == 7, 0.7).when(number >= 6, 0.3).otherwise(5.0).alias("total"),
        F.when(number == 5, "missing_inputs").when(number == 9, "missing").when(number == 10, "guessed").otherwise("supported").alias("total_status"), F.when(number == 11, F.array(F.lit("margin"))).otherwise(none).alias("missing_inputs"),
    )
    allowed = c.select(doc(k).alias("doc_id")).distinct().select("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(4)), text)).alias("item_id"))
    return {"parties": parties, "relations": relations, "facilities": facilities, "commitments": commitments, "interest": interest}, allowed


def extraction_breaches(spark: SparkSession, d: str) -> DataFrame:
    return extraction.extraction_violations(*extracted(spark, d)).groupBy("rule").agg(F.count("*").alias("n"))


def annotation_problems(spark: SparkSession, d: str) -> DataFrame:
    """Every line of every fifth document is annotated; wrong in many ways."""
    own, k, pos = items(spark, d).where("doc_id % 5 = 0"), F.col("doc_id") / 5, F.col("pos")
    two = F.array(F.lit("covenants"), F.lit("parties_and_roles"))
    incoming = own.select("doc_id", F.when((k % 9 == 1) & (pos == 0), "#/texts/x").otherwise(F.col("item_id")).alias("item_id"), F.when(k % 9 == 2, F.array(F.lit("covenants"), F.lit("covenants"))).when(k % 9 == 3, F.array(F.lit("weather"))).otherwise(two).alias("topics"), F.when(k % 9 == 4, F.repeat(F.lit("x"), 4001)).otherwise("").alias("notes"), F.when(k % 9 == 5, -1).when(k % 9 == 6, pos).otherwise(pos % 3).alias("expected"))
    incoming = incoming.unionByName(incoming.where((k % 9 == 7) & (pos == 0)))
    current = own.where("pos % 3 > 0").select("doc_id", "item_id", (pos % 3).alias("revision"))
    return reviews.annotation_problems(incoming, current, own, topics.TOPICS).select("doc_id", "item_id", "problem")


def group_provenance(spark: SparkSession, d: str) -> DataFrame:
    held = items(spark, d).select("doc_id", "pos", F.floor(F.col("pos") / 8).cast("int").alias("chunk_no"), "page")
    found = topics.enriched(_groups(spark, d), held)
    return found.select("doc_id", "topic", "group_id", *[F.array_join(c, ",").alias(c) for c in ("source_chunks", "evidence_pages", "context_pages")])


def map_violations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 20
    mapped = topics.topic_map(_groups(spark, d)).select("doc_id", "topic", "group_id", "group_ord", "evidence", "context")
    mapped = mapped.withColumn("group_ord", F.when(k == 1, -F.col("group_ord")).otherwise(F.col("group_ord"))).withColumn("group_id", F.when(k == 2, F.concat("group_id", F.lit("0"))).otherwise(F.col("group_id")))
    return topics.map_violations(mapped.unionByName(mapped.where(k == 3)))


def cache_problems(spark: SparkSession, d: str) -> DataFrame:
    k, sha = F.col("doc_id") % 10, F.concat(F.lit("s"), "doc_id")
    docs, names = table(spark, d, "documents"), F.array(F.lit("a.json"), F.lit("b.md"))
    wanted = docs.select(sha.alias("sha"), F.lit("p").alias("profile"), F.lit(2).alias("version"))
    manifests = docs.where(k != 1).select(sha.alias("sha"), F.when(k == 3, "x").otherwise(sha).alias("source_sha"), F.when(k == 2, "running").otherwise("completed").alias("status"), F.when(k == 4, "q").otherwise("p").alias("profile"), F.when(k != 5, 2).alias("version"), F.when(k == 6, F.array(F.lit("a.json"))).when(k == 0, F.reverse(names)).otherwise(names).alias("names"), names.alias("expected_names"))
    files = docs.select(sha.alias("sha"), F.explode(names).alias("name"), k.alias("k")).where("NOT (k = 7 AND name = 'b.md')").select("sha", "name", F.when((F.col("k") == 8) & (F.col("name") == "a.json"), 0).otherwise(5).alias("length"))
    return inputs.cache_problems(wanted, manifests, files).select("sha", "problem")


_CASES = lambda pairs, column: f"{[p or '' for _, p in pairs]}[{column} % {len(pairs)} + 1]"
_MODELS = [*routes.ROUTES, "unheard-of"]

QUERIES = {f.__name__: f for f in (annotation_passages, catalog_changes, topic_map_problems, selection_differences, evidence_problems, priced_calls, settings_problems, run_sources, reference_problems, position_problems, manifest_mode_problems, legacy_violations, legacy_labels, extraction_breaches, annotation_problems, group_provenance, map_violations, cache_problems)}

ORACLES = {
    "annotation_passages": f"""WITH {ITEMS}, p AS (SELECT doc_id, pos AS ord, item_id, CASE pos % 5 WHEN 1 THEN ' ' WHEN 3 THEN '> ' || text ELSE text END AS text, CASE WHEN pos % 7 <> 0 THEN label ELSE 'text' END AS label FROM items)
        SELECT * FROM p WHERE regexp_matches(text, '\\S')""",
    "catalog_changes": f"""WITH {ITEMS}, n AS (SELECT doc_id, count(*) FILTER (WHERE regexp_matches(text, '\\S')) AS n, count(*) AS z, bool_or(pos = 0 AND NOT regexp_matches(text, '\\S')) AS blank0, bool_or(pos = 1 AND NOT regexp_matches(text, '\\S')) AS blank1 FROM items GROUP BY doc_id)
        SELECT doc_id, n AS n_passages FROM n WHERE n > 0 AND (doc_id % 3 = 0 OR doc_id % 7 = 1 AND z > 1 AND NOT blank0 AND NOT blank1)""",
    "topic_map_problems": f"""WITH {ITEMS}, p AS (SELECT DISTINCT doc_id FROM items)
        SELECT CASE WHEN doc_id % 20 = 1 THEN -1 - doc_id ELSE doc_id END AS doc_id, CASE WHEN doc_id % 20 = 1 THEN 'no_document' WHEN doc_id % 20 IN (2, 3, 6) THEN 'not_final' WHEN doc_id % 20 = 7 OR text IS NULL THEN 'other_source'
            WHEN doc_id % 20 IN (8, 9) THEN 'other_taxonomy' WHEN doc_id % 20 IN (10, 12) THEN 'unknown_layout' ELSE 'other_packets' END AS problem
        FROM documents LEFT JOIN (SELECT doc_id AS asked FROM p) ON asked = doc_id WHERE doc_id % 20 IN (1, 2, 3, 6, 7, 8, 9, 10, 12, 13, 14) OR asked IS NULL AND doc_id % 20 NOT IN (4, 5)""",
    "selection_differences": f"""{_GROUPS}, r AS (SELECT m.* FROM mapped m WHERE topic IN ({", ".join(f"'{t}'" for t in ASKED)}) AND doc_id % 20 IN (1, 2))
        SELECT 'recomputed' AS side, doc_id, topic, group_ord, group_id FROM r UNION ALL SELECT 'saved', doc_id, topic, group_ord + 1, group_id FROM r WHERE doc_id % 20 = 2""",
    "evidence_problems": """SELECT doc_id, CASE WHEN doc_id % 20 IN (1, 2, 3, 4) THEN 'sources_differ' ELSE 'conversion_differs' END AS problem FROM documents WHERE doc_id % 20 IN (1, 2, 3, 4, 5, 7, 9)""",
    "priced_calls": f"""WITH {LOG}, c AS (SELECT event_id, k, {_MODELS}[k % {len(_MODELS)} + 1] AS model FROM log WHERE event = 'llm_attempt'), r AS (SELECT unnest({_MODELS[:-1]}) AS model, unnest({list(routes.ROUTES.values())}) AS own)
        SELECT event_id, c.model, CASE WHEN k % 4 = 0 THEN 'asked' ELSE own END AS style,
          CASE WHEN c.model = 'gpt-5.6-luna' AND k % 6 <> 0 AND k * 4000 <= 272000 THEN CAST((k * 3983 * 200 + k * 10 * 20 + k * 7 * 250 + k * 1200) AS BIGINT) END AS billionths,
          CASE WHEN c.model = 'gpt-5.6-luna' AND k % 6 <> 0 AND k * 4000 <= 272000 THEN 'USD' END AS currency FROM c LEFT JOIN r ON r.model = c.model""",
    "settings_problems": f"SELECT doc_id AS run_id, nullif({_CASES(SETTINGS, 'doc_id')}, '') AS problem FROM documents",
    "run_sources": """WITH d AS (SELECT doc_id, 'd' || doc_id AS content FROM documents),
        p AS (SELECT user_id, arg_min(doc_id, event_id) AS doc FROM events JOIN d ON doc_id = event_id % 3000 WHERE event_id % 4 = 0 AND user_id % 3 = 0 GROUP BY user_id),
        h AS (SELECT user_id, arg_min(doc_id, event_id) AS doc FROM events JOIN d ON doc_id = event_id % 5000 WHERE event_id % 5 = 0 GROUP BY user_id)
        SELECT DISTINCT e.user_id AS run_id, coalesce(p.doc, h.doc) AS document_id FROM events e LEFT JOIN p USING (user_id) LEFT JOIN h USING (user_id)""",
    "reference_problems": f"SELECT rule, doc_id, '#/groups/0' AS item_id FROM (SELECT doc_id, {_CASES(CONTAINERS, 'doc_id')} AS rule FROM documents) WHERE rule <> ''",
    "position_problems": f"""WITH {ITEMS} SELECT doc_id, 'texts' AS collection, pos AS position, CASE doc_id % 20 WHEN 1 THEN '#/texts/02' WHEN 3 THEN '#/texts/' || (1 - pos) END AS self_ref FROM items
        WHERE doc_id % 20 = 1 AND pos = 2 OR doc_id % 20 = 2 AND pos = 1 OR doc_id % 20 = 3 AND pos < 2""",
    "manifest_mode_problems": """SELECT doc_id, CASE WHEN doc_id % 16 < 8 THEN 'conflicting' ELSE 'not_disabled' END AS problem FROM documents WHERE doc_id % 16 IN (2, 3, 4, 5, 8, 9, 11, 12, 13)""",
    "legacy_violations": f"""WITH {ITEMS}, {_PLAIN}, c AS (SELECT DISTINCT doc_id, pos // 8 AS chunk_no FROM items)
        SELECT 'unknown_chunk' AS rule, doc_id, chunk_no + 1000 AS chunk_no, NULL AS topic FROM c WHERE doc_id % 20 = 3 UNION ALL SELECT 'repeated_chunk', doc_id, 0, NULL FROM c WHERE doc_id % 20 = 2 AND chunk_no = 0
        UNION ALL SELECT 'unanswered', doc_id, chunk_no, NULL FROM c WHERE doc_id % 20 = 3 OR doc_id % 20 = 1 AND chunk_no = 0 UNION ALL SELECT 'unknown_topic', doc_id, chunk_no, 'weather' FROM classified WHERE doc_id % 20 = 4
        UNION ALL SELECT 'repeated_topic', doc_id, chunk_no, topic FROM classified WHERE doc_id % 20 = 7 UNION ALL SELECT 'repeated_citation', doc_id, chunk_no, topic FROM classified WHERE doc_id % 20 = 5
        UNION ALL SELECT 'out_of_scope', doc_id, chunk_no, topic FROM classified WHERE doc_id % 20 = 6""",
    "legacy_labels": f"""WITH {ITEMS}, {_PLAIN}, l AS (SELECT doc_id, chunk_no, topic, unnest(evidence) AS pos FROM classified WHERE doc_id % 20 NOT IN (4, 6)),
        e AS (SELECT * FROM l UNION SELECT doc_id, chunk_no, split_part(topic, '.', 1), pos FROM l WHERE topic LIKE '%.%')
        SELECT doc_id, chunk_no, topic, list_position({list(topics.TOPICS)}, topic) - 1 AS topic_ord, string_agg('#/texts/' || pos, ',' ORDER BY pos) AS cited FROM e GROUP BY ALL""",
    "extraction_breaches": """WITH RECURSIVE p AS (SELECT c_custkey // 20 AS doc, c_custkey AS k, CASE WHEN c_custkey % 97 = 0 THEN c_custkey - 1 ELSE c_custkey END AS id, CASE WHEN c_custkey % 89 = 0 THEN c_custkey - 1 ELSE c_custkey END AS name,
            CASE WHEN c_custkey % 61 = 0 THEN 'twice' WHEN c_custkey % 67 = 0 THEN 'company' WHEN c_custkey % 2 = 0 THEN 'lender' ELSE 'other' END AS role FROM customer),
        lenders AS (SELECT DISTINCT doc, id FROM p WHERE role IN ('lender', 'twice')),
        s1 AS (SELECT s_suppkey // 20 AS doc, s_suppkey AS parent, CASE WHEN s_suppkey % 31 = 0 THEN s_suppkey WHEN s_suppkey % 37 = 0 THEN -1 WHEN s_suppkey % 20 = 19 THEN s_suppkey - 19 ELSE s_suppkey + 1 END AS child FROM supplier),
        e AS (SELECT DISTINCT doc, parent, child FROM s1 WHERE parent <> child),
        reach AS (SELECT doc, parent AS start, child AS node FROM e UNION SELECT r.doc, r.start, e.child FROM reach r JOIN e ON e.doc = r.doc AND e.parent = r.node),
        o AS (SELECT o_orderkey AS q, o_custkey AS c, o_custkey // 20 AS doc, CASE WHEN o_orderkey % 400 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS f FROM orders),
        i AS (SELECT l_partkey % 12 AS n, l_orderkey AS q, o.doc FROM lineitem JOIN o ON o.q = l_orderkey),
        found AS (
          SELECT 'no_citation' AS rule, count(*) AS n FROM p WHERE k % 53 = 0 UNION ALL SELECT 'no_citation', count(*) FROM o WHERE q % 14 = 0 AND q % 3 <> 0
          UNION ALL SELECT 'unknown_citation', count(DISTINCT (doc, id)) FROM p WHERE k % 59 = 0 AND k % 53 <> 0 UNION ALL SELECT 'unknown_citation', count(*) FROM (SELECT DISTINCT doc, parent, child FROM s1) WHERE doc NOT IN (SELECT doc FROM p)
          UNION ALL SELECT 'repeated_citation', count(*) FROM p WHERE k % 47 = 0 AND k % 53 <> 0 AND k % 59 <> 0
          UNION ALL SELECT 'repeated_party', count(*) FROM (SELECT 1 FROM p GROUP BY doc, id HAVING count(*) > 1) UNION ALL SELECT 'repeated_name', count(*) FROM (SELECT 1 FROM p GROUP BY doc, name HAVING count(*) > 1)
          UNION ALL SELECT 'repeated_role', count(*) FROM p WHERE role = 'twice' UNION ALL SELECT 'corporate_role', count(*) FROM p WHERE role = 'company'
          UNION ALL SELECT 'unknown_party', count(DISTINCT (doc, node)) FROM (SELECT doc, parent AS node FROM s1 UNION ALL SELECT doc, child FROM s1) x WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.doc = x.doc AND p.id = x.node)
          UNION ALL SELECT 'self_relation', count(*) FROM s1 WHERE parent = child UNION ALL SELECT 'repeated_relation', count(*) FROM s1 WHERE parent % 10 = 3
          UNION ALL SELECT 'circle', count(*) FROM reach WHERE start = node
          UNION ALL SELECT 'repeated_facility', count(*) FROM (SELECT 1 FROM o GROUP BY doc, f HAVING count(*) > 1)
          UNION ALL SELECT 'facility_without_evidence', count(*) FROM o WHERE q % 14 = 0 AND NOT EXISTS (SELECT 1 FROM o x WHERE x.q % 5 = 0 AND x.doc = o.doc AND x.q = o.f)
          UNION ALL SELECT 'no_lender', count(*) FROM o WHERE q % 5 = 0 AND NOT EXISTS (SELECT 1 FROM lenders l WHERE l.doc = o.doc AND l.id = o.c)
          UNION ALL SELECT 'kind_differs', count(*) FROM i WHERE n = 2 UNION ALL SELECT 'inputs_differ', count(*) FROM i WHERE n = 8 UNION ALL SELECT 'total_mismatch', count(*) FROM i WHERE n = 4
          UNION ALL SELECT 'total_without_calculation', count(*) FROM i WHERE n = 3
          UNION ALL SELECT 'unknown_facility', count(*) FROM i WHERE n = 1 OR NOT EXISTS (SELECT 1 FROM o WHERE o.doc = i.doc AND o.f = i.q)
          UNION ALL SELECT 'unknown_status', count(*) FROM i WHERE n = 10 UNION ALL SELECT 'supported_without_total', count(*) FROM i WHERE n = 11
          UNION ALL SELECT 'unavailable_with_total', count(*) FROM i WHERE n = 9 UNION ALL SELECT 'missing_without_name', count(*) FROM i WHERE n = 5)
        SELECT rule, CAST(sum(n) AS BIGINT) AS n FROM found GROUP BY rule HAVING sum(n) > 0""",
    "annotation_problems": f"""WITH {ITEMS}, a AS (SELECT doc_id, doc_id // 5 % 9 AS k, pos, CASE WHEN doc_id // 5 % 9 = 1 AND pos = 0 THEN '#/texts/x' ELSE item_id END AS item_id FROM items WHERE doc_id % 5 = 0),
        b AS (SELECT * FROM a UNION ALL SELECT * FROM a WHERE k = 7 AND pos = 0)
        SELECT doc_id, item_id, CASE WHEN k = 1 AND pos = 0 THEN 'unknown_passage' WHEN k IN (2, 3) THEN 'bad_topics' WHEN k = 5 THEN 'bad_revision' WHEN k = 4 THEN 'long_notes' WHEN k = 7 AND pos = 0 OR k = 6 AND pos <> pos % 3 THEN 'conflict' END AS problem FROM b""",
    "group_provenance": f"""{_GROUPS}, c AS (SELECT doc_id, topic, group_id, 'e' AS role, unnest(evidence) AS pos FROM groups UNION ALL SELECT doc_id, topic, group_id, 'c', unnest(context) FROM groups)
        SELECT doc_id, topic, group_id, array_to_string(list_sort(list(DISTINCT c.pos // 8)), ',') AS source_chunks, coalesce(array_to_string(list_sort(list(DISTINCT page) FILTER (WHERE role = 'e' AND page IS NOT NULL)), ','), '') AS evidence_pages,
          coalesce(array_to_string(list_sort(list(DISTINCT page) FILTER (WHERE role = 'c' AND page IS NOT NULL)), ','), '') AS context_pages FROM c JOIN items i USING (doc_id, pos) GROUP BY doc_id, topic, group_id""",
    "map_violations": f"""{_GROUPS} SELECT 'out_of_order' AS rule, doc_id, topic, group_id FROM (SELECT *, max(group_ord) OVER (PARTITION BY doc_id, topic) AS z FROM mapped) WHERE doc_id % 20 = 1 AND group_ord < z
        UNION ALL SELECT 'other_identity', doc_id, topic, group_id || '0' FROM mapped WHERE doc_id % 20 = 2 UNION ALL SELECT 'repeated_group', doc_id, topic, group_id FROM mapped WHERE doc_id % 20 = 3""",
    "cache_problems": "SELECT 's' || doc_id AS sha, CASE doc_id % 10 WHEN 1 THEN 'no_manifest' WHEN 2 THEN 'not_completed' WHEN 3 THEN 'other_source' WHEN 4 THEN 'other_profile' WHEN 5 THEN 'other_version' WHEN 6 THEN 'other_names' WHEN 7 THEN 'missing_file' WHEN 8 THEN 'missing_file' END AS problem FROM documents",
}
