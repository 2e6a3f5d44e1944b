"""Queries over document structure, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import structure as S
from .adapters import ITEMS, items, table

TARGET = 2000


def item_index(spark: SparkSession, d: str) -> DataFrame:
    return S.item_index(items(spark, d))


def tree_edges(spark: SparkSession, d: str) -> DataFrame:
    """A document for each region: body -> region -> nations -> customers and suppliers. Some regions and nations are lists."""
    name = lambda kind, key: F.concat(F.lit(kind), F.col(key).cast("string"))
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    edge = lambda doc, parent, child, pos, is_list: [F.col(doc).alias("doc_id"), parent.alias("parent_id"), child.alias("child_id"), pos.cast("long").alias("child_pos"), is_list.alias("is_list")]
    r = table(spark, d, "region").select(*edge("r_regionkey", F.lit("#/body"), name("#/groups/r", "r_regionkey"), F.col("r_regionkey"), F.col("r_regionkey") % 2 == 1))
    n = nation.select(*edge("n_regionkey", name("#/groups/r", "n_regionkey"), name("#/groups/n", "n_nationkey"), F.col("n_nationkey"), F.col("n_nationkey") % 3 == 0))
    c = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    s = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    c = c.select(*edge("n_regionkey", name("#/groups/n", "c_nationkey"), name("#/texts/c", "c_custkey"), F.col("c_custkey").cast("long") * 2, F.lit(False)))
    s = s.select(*edge("n_regionkey", name("#/groups/n", "s_nationkey"), name("#/texts/s", "s_suppkey"), F.col("s_suppkey").cast("long") * 2 + 1, F.lit(False)))
    return r.union(n).union(c).union(s)


EDGES = """
edges AS (
  SELECT r_regionkey AS doc_id, '#/body' AS parent_id, '#/groups/r' || r_regionkey AS child_id, CAST(r_regionkey AS BIGINT) AS child_pos, r_regionkey % 2 = 1 AS is_list FROM region
  UNION ALL SELECT n_regionkey, '#/groups/r' || n_regionkey, '#/groups/n' || n_nationkey, n_nationkey, n_nationkey % 3 = 0 FROM nation
  UNION ALL SELECT n_regionkey, '#/groups/n' || c_nationkey, '#/texts/c' || c_custkey, c_custkey * 2, false FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION ALL SELECT n_regionkey, '#/groups/n' || s_nationkey, '#/texts/s' || s_suppkey, s_suppkey * 2 + 1, false FROM supplier JOIN nation ON n_nationkey = s_nationkey
)"""
TREE = """
tree AS (
  SELECT doc_id, child_id AS item_id, parent_id, [parent_id] AS path, [child_pos] AS sort_key, CASE WHEN is_list THEN child_id END AS list_key FROM edges WHERE parent_id = '#/body'
  UNION ALL
  SELECT e.doc_id, e.child_id, e.parent_id, list_append(t.path, e.parent_id), list_append(t.sort_key, e.child_pos), coalesce(t.list_key, CASE WHEN e.is_list THEN e.child_id END)
  FROM tree t JOIN edges e ON e.doc_id = t.doc_id AND e.parent_id = t.item_id WHERE t.item_id LIKE '#/groups/%'
)"""


def tree_walk(spark: SparkSession, d: str) -> DataFrame:
    return S.walk(tree_edges(spark, d)).select("doc_id", "item_id", "parent_id", F.array_join("path", ">").alias("path"), F.size("path").alias("depth"), "list_key")


def tree_reading_order(spark: SparkSession, d: str) -> DataFrame:
    return S.reading_order(S.walk(tree_edges(spark, d))).select("doc_id", "item_id", "reading_order")


def _bad_edges(spark: SparkSession, d: str) -> DataFrame:
    """With some nations that hold their region or what is not there, and some customers whom their region holds too."""
    edges = tree_edges(spark, d)
    key = F.regexp_extract("child_id", r"\d+$", 0).cast("long")
    region = F.concat(F.lit("#/groups/r"), F.col("doc_id").cast("string"))
    bad = lambda kind, part, left, parent, child: edges.where(F.col("child_id").startswith(kind) & (key % part == left)).select("doc_id", parent.alias("parent_id"), child.alias("child_id"), "child_pos", "is_list")
    nation = F.col("child_id")
    return edges.union(bad("#/groups/n", 7, 1, nation, region)).union(bad("#/groups/n", 5, 2, nation, F.lit("#/texts/none"))).union(bad("#/texts/c", 50, 0, region, nation))


def tree_violations(spark: SparkSession, d: str) -> DataFrame:
    nodes = tree_edges(spark, d).select("doc_id", F.col("child_id").alias("item_id"))
    return S.tree_violations(_bad_edges(spark, d), nodes)


def heading_paths(spark: SparkSession, d: str) -> DataFrame:
    return S.heading_paths(items(spark, d)).select("doc_id", "pos", F.array_join("heading_positions", ">").alias("heading_path"))


def heading_warnings(spark: SparkSession, d: str) -> DataFrame:
    return S.heading_warnings(items(spark, d))


def render_items(spark: SparkSession, d: str) -> DataFrame:
    own = items(spark, d).select("doc_id", "pos", F.when(F.col("pos") % 4 == 1, F.lit("  ")).when(F.col("pos") % 4 == 2, None).otherwise(F.concat(F.lit("> "), "text")).alias("orig"), "text")
    return own.select("doc_id", "pos", T.rendered(F.col("orig"), F.col("text")).alias("content"))


def render_tables(spark: SparkSession, d: str) -> DataFrame:
    cells = F.array(F.col("l_partkey").cast("string"), F.concat(F.lit(" "), "l_returnflag", F.lit("\t"), "l_linestatus"), F.when(F.col("l_linenumber") % 2 == 0, F.lit("  ")).otherwise(F.col("l_suppkey").cast("string")))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", cells.alias("cells")))).alias("rows"))
    return rows.select("l_orderkey", T.render_grid(F.transform("rows", lambda r: r["cells"])).alias("content"))


def table_rows(spark: SparkSession, d: str) -> DataFrame:
    """Tables rebuilt from single cells, rows by their start, cells in the order met."""
    cells = table(spark, d, "lineitem").select("l_orderkey", F.floor((F.col("l_linenumber") - 1) / 3).alias("row_no"), "l_linenumber", F.col("l_partkey").cast("string").alias("cell"))
    return cells.groupBy("l_orderkey", "row_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "cell"))), lambda s: s["cell"]), "|").alias("cells"))


def item_pages(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list((F.col("l_linenumber") % 5 - 1).cast("int")).alias("p"))
    return lines.select("l_orderkey", F.array_join(T.pages_of(F.col("p")), ",").alias("pages"))


def atomic_units(spark: SparkSession, d: str) -> DataFrame:
    return S.atomic_units(items(spark, d)).drop("pages")


def document_tree(spark: SparkSession, d: str) -> DataFrame:
    """The documents' lines as trees: the body holds lines and lists, a list its lines."""
    own = items(spark, d)
    group = F.concat(F.lit("#/groups/"), "list_key")
    leaves = own.select("doc_id", F.coalesce(group, F.lit("#/body")).alias("parent_id"), F.col("item_id").alias("child_id"), F.col("pos").cast("long").alias("child_pos"), F.lit(False).alias("is_list"))
    lists = own.where("list_key IS NOT NULL").groupBy("doc_id", group.alias("child_id")).agg(F.min("pos").cast("long").alias("child_pos"))
    return leaves.unionByName(lists.select("doc_id", F.lit("#/body").alias("parent_id"), "child_id", "child_pos", F.lit(True).alias("is_list")))


def walked_units(spark: SparkSession, d: str) -> DataFrame:
    """Units whose order and lists come from the walk."""
    return S.atomic_units(S.placed(items(spark, d), S.walk(document_tree(spark, d), paths=False))).drop("pages")


def list_violations(spark: SparkSession, d: str) -> DataFrame:
    own = items(spark, d).withColumn("list_key", F.regexp_extract("list_key", r"^\d+", 0)).withColumn("list_key", F.nullif("list_key", F.lit("")))
    return S.list_violations(S.atomic_units(own))


def _paged(spark: SparkSession, d: str) -> DataFrame:
    return S.paged_assignment(S.atomic_units(items(spark, d)), TARGET)


def _pageless(spark: SparkSession, d: str) -> DataFrame:
    return S.pageless_assignment(S.atomic_units(items(spark, d)), TARGET)


_CHUNK = ["doc_id", "chunk_no", "first_pos", "last_pos", "n_items", "n_units", "character_count", "first_page", "last_page", "oversized_reason"]


def chunks_paged(spark: SparkSession, d: str) -> DataFrame:
    return S.chunk_records(_paged(spark, d), TARGET).select(*_CHUNK)


def chunks_pageless(spark: SparkSession, d: str) -> DataFrame:
    return S.chunk_records(_pageless(spark, d), TARGET).select(*_CHUNK)


def chunk_links(spark: SparkSession, d: str) -> DataFrame:
    return S.chunk_records(_paged(spark, d), TARGET).select("doc_id", "chunk_id", "previous_chunk_id", "next_chunk_id")


def chunk_groups(spark: SparkSession, d: str) -> DataFrame:
    """Pages and lists of each chunk, with pages or without."""
    both = S.chunk_records(_paged(spark, d), TARGET).unionByName(S.chunk_records(_pageless(spark, d), TARGET))
    return both.select("doc_id", "chunk_no", F.array_join("pages", ",").alias("pages"), F.array_join("group_ids", ",").alias("group_ids"))


def chunk_coverage(spark: SparkSession, d: str) -> DataFrame:
    both = S.chunk_records(_paged(spark, d), TARGET).unionByName(S.chunk_records(_pageless(spark, d), TARGET))
    return S.coverage_violations(items(spark, d), both)


def batch_pack(spark: SparkSession, d: str) -> DataFrame:
    return S.packed_batches(S.chunk_records(_paged(spark, d), TARGET), 3, 4000)


def passage_packets(spark: SparkSession, d: str) -> DataFrame:
    return S.neighbour_frames(_paged(spark, d), 2)


def context_frames(spark: SparkSession, d: str) -> DataFrame:
    return S.context_frame(items(spark, d))


UNITS = """
keyed AS (SELECT *, coalesce(list_key, '#' || pos) AS k FROM items),
marked AS (SELECT *, CASE WHEN lag(k) OVER (PARTITION BY doc_id ORDER BY pos) = k THEN 0 ELSE 1 END AS new FROM keyed),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS unit_no FROM marked),
units AS (
  SELECT doc_id, CAST(unit_no AS BIGINT) AS unit_no, min(pos) AS pos, max(pos) AS last_pos, count(*) AS n_items,
    CAST(sum(length(text)) + greatest(sum(CASE WHEN length(text) > 0 THEN 1 ELSE 0 END) - 1, 0) AS BIGINT) AS length,
    min(page) AS first_page, max(page) AS last_page, arg_min(level IS NOT NULL, pos) AS starts_heading, max(list_key) AS list_key
  FROM numbered GROUP BY doc_id, unit_no
)"""
PAGED = f"""
paged AS (SELECT * FROM units WHERE doc_id IN (SELECT doc_id FROM units WHERE first_page IS NOT NULL)),
folded AS (
  SELECT doc_id, unit_no, first_page AS anchor, length AS n, 0 AS chunk_no FROM paged WHERE unit_no = 0
  UNION ALL
  SELECT u.doc_id, u.unit_no, coalesce(u.first_page, f.anchor),
    CASE WHEN s.split THEN u.length ELSE s.joined END, f.chunk_no + CASE WHEN s.split THEN 1 ELSE 0 END
  FROM folded f JOIN paged u ON u.doc_id = f.doc_id AND u.unit_no = f.unit_no + 1,
  LATERAL (SELECT f.n + u.length + CASE WHEN f.n > 0 AND u.length > 0 THEN 1 ELSE 0 END AS joined,
    coalesce(u.first_page IS NOT NULL AND f.anchor IS NOT NULL AND (u.first_page <> f.anchor OR f.n + u.length + CASE WHEN f.n > 0 AND u.length > 0 THEN 1 ELSE 0 END > {TARGET}), false) AS split) s
),
assigned AS (SELECT p.*, f.chunk_no FROM paged p JOIN folded f USING (doc_id, unit_no))"""
PAGELESS = f"""
blocked AS (
  SELECT *, sum(CASE WHEN starts_heading THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY unit_no ROWS UNBOUNDED PRECEDING) AS block_no
  FROM units WHERE doc_id NOT IN (SELECT doc_id FROM units WHERE first_page IS NOT NULL)
),
pageless AS (
  SELECT *, sum(length) OVER w + greatest(sum(CASE WHEN length > 0 THEN 1 ELSE 0 END) OVER w - 1, 0) AS block,
    unit_no = min(unit_no) OVER w AS starts, unit_no = max(unit_no) OVER w AS ends
  FROM blocked WINDOW w AS (PARTITION BY doc_id, block_no)
),
folded AS (
  SELECT doc_id, unit_no, length AS n, 0 AS chunk_no, CASE WHEN block > {TARGET} THEN NOT (length > {TARGET} OR ends) ELSE true END AS is_open
  FROM pageless WHERE unit_no = 0
  UNION ALL
  SELECT u.doc_id, u.unit_no, CASE WHEN s.apart THEN u.length ELSE s.joined END, f.chunk_no + CASE WHEN s.apart THEN 1 ELSE 0 END,
    CASE WHEN u.block > {TARGET} THEN NOT (u.length > {TARGET} OR u.ends) ELSE true END
  FROM folded f JOIN pageless u ON u.doc_id = f.doc_id AND u.unit_no = f.unit_no + 1,
  LATERAL (SELECT f.n + u.length + CASE WHEN f.n > 0 AND u.length > 0 THEN 1 ELSE 0 END AS joined,
    CASE WHEN u.block > {TARGET} THEN u.starts OR NOT f.is_open OR f.n + u.length + CASE WHEN f.n > 0 AND u.length > 0 THEN 1 ELSE 0 END > {TARGET}
         ELSE NOT f.is_open OR (u.starts AND f.n + u.block + CASE WHEN f.n > 0 AND u.block > 0 THEN 1 ELSE 0 END > {TARGET}) END AS apart) s
),
assigned AS (SELECT p.doc_id, p.unit_no, p.pos, p.last_pos, p.n_items, p.length, p.first_page, p.last_page, p.list_key, f.chunk_no FROM pageless p JOIN folded f USING (doc_id, unit_no))"""
CHUNKS = f"""
chunks AS (
  SELECT doc_id, chunk_no, min(pos) AS first_pos, max(last_pos) AS last_pos, CAST(sum(n_items) AS BIGINT) AS n_items, count(*) AS n_units,
    CAST(sum(length) + greatest(sum(CASE WHEN length > 0 THEN 1 ELSE 0 END) - 1, 0) AS BIGINT) AS character_count,
    min(first_page) AS first_page, max(last_page) AS last_page,
    CASE WHEN sum(length) + greatest(sum(CASE WHEN length > 0 THEN 1 ELSE 0 END) - 1, 0) > {TARGET}
         THEN CASE WHEN count(list_key) > 0 THEN 'atomic_list' ELSE 'atomic_item' END END AS oversized_reason
  FROM assigned GROUP BY doc_id, chunk_no
)"""
_WITH = f"WITH RECURSIVE {ITEMS}, {UNITS}"
_PAGED_CHUNKS = f"{_WITH}, {PAGED}, {CHUNKS}"
_COLUMNS = ", ".join(_CHUNK)

QUERIES = {f.__name__: f for f in (item_index, tree_walk, tree_reading_order, tree_violations, heading_paths, heading_warnings, render_items, render_tables, table_rows, item_pages, atomic_units, walked_units, list_violations, chunks_paged, chunks_pageless, chunk_links, chunk_groups, chunk_coverage, batch_pack, passage_packets, context_frames)}

ORACLES = {
    "item_index": f"WITH {ITEMS} SELECT doc_id, item_id, 'texts' AS collection, pos AS position, label AS item_type FROM items",
    "tree_walk": f"WITH RECURSIVE {EDGES}, {TREE} SELECT doc_id, item_id, parent_id, array_to_string(path, '>') AS path, len(path) AS depth, list_key FROM tree",
    "tree_reading_order": f"WITH RECURSIVE {EDGES}, {TREE} SELECT doc_id, item_id, row_number() OVER (PARTITION BY doc_id ORDER BY sort_key, item_id) - 1 AS reading_order FROM tree WHERE item_id NOT LIKE '#/groups/%'",
    "tree_violations": f"""WITH RECURSIVE {EDGES}, bad AS (SELECT doc_id, parent_id, child_id FROM edges
          UNION ALL SELECT n_regionkey, '#/groups/n' || n_nationkey, '#/groups/r' || n_regionkey FROM nation WHERE n_nationkey % 7 = 1
          UNION ALL SELECT n_regionkey, '#/groups/n' || n_nationkey, '#/texts/none' FROM nation WHERE n_nationkey % 5 = 2
          UNION ALL SELECT n_regionkey, '#/groups/r' || n_regionkey, '#/texts/c' || c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 50 = 0),
        g AS (SELECT doc_id, parent_id, child_id FROM bad WHERE parent_id LIKE '#/groups/%' AND child_id LIKE '#/groups/%'),
        reach AS (SELECT doc_id, parent_id AS start, child_id AS item_id FROM g UNION SELECT r.doc_id, r.start, g.child_id FROM reach r JOIN g ON g.doc_id = r.doc_id AND g.parent_id = r.item_id)
        SELECT DISTINCT 'unresolved' AS rule, doc_id, child_id AS item_id FROM bad b WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.doc_id = b.doc_id AND e.child_id = b.child_id)
        UNION ALL SELECT DISTINCT 'cycle', doc_id, start FROM reach WHERE start = item_id
        UNION ALL SELECT 'repeated', doc_id, child_id FROM bad GROUP BY doc_id, child_id HAVING count(*) > 1""",
    "heading_paths": f"""WITH {ITEMS}, heads AS (SELECT doc_id, pos, level FROM items WHERE level IS NOT NULL),
        above AS (SELECT i.doc_id, i.pos, h.pos AS head FROM items i JOIN heads h ON h.doc_id = i.doc_id AND h.pos <= i.pos
          WHERE NOT EXISTS (SELECT 1 FROM heads l WHERE l.doc_id = i.doc_id AND l.pos > h.pos AND l.pos <= i.pos AND l.level <= h.level))
        SELECT i.doc_id, i.pos, coalesce(string_agg(CAST(a.head AS VARCHAR), '>' ORDER BY a.head), '') AS heading_path
        FROM items i LEFT JOIN above a ON a.doc_id = i.doc_id AND a.pos = i.pos GROUP BY i.doc_id, i.pos""",
    "heading_warnings": f"""WITH {ITEMS}, heads AS (SELECT *, lag(level) OVER w AS before, lag(page) OVER w AS page_before FROM items WHERE level IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
        SELECT doc_id, 'skipped_levels' AS code, count(*) AS n, min(pos) AS first_pos FROM heads WHERE (before IS NULL AND level > 1) OR level > before + 1 GROUP BY doc_id
        UNION ALL SELECT doc_id, 'non_monotonic_pages', count(*), min(pos) FROM heads WHERE page < page_before GROUP BY doc_id
        UNION ALL SELECT doc_id, 'flat_levels', count(*), min(pos) FROM heads GROUP BY doc_id HAVING count(*) > 1 AND min(level) = max(level)
        UNION ALL SELECT doc_id, 'no_headings', 0, NULL FROM items GROUP BY doc_id HAVING count(level) = 0""",
    "render_items": f"WITH {ITEMS} SELECT doc_id, pos, CASE WHEN pos % 4 IN (1, 2) THEN text ELSE '> ' || text END AS content FROM items",
    "render_tables": """WITH r AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part, rtrim(l_partkey || chr(9) || l_returnflag || ' ' || l_linestatus || chr(9) || CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END, chr(9)) AS line FROM lineitem)
        SELECT l_orderkey, string_agg(line, chr(10) ORDER BY l_linenumber, part, line) AS content FROM r GROUP BY l_orderkey""",
    "table_rows": "SELECT l_orderkey, (l_linenumber - 1) // 3 AS row_no, string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS cells FROM lineitem GROUP BY ALL",
    "item_pages": "SELECT l_orderkey, coalesce(string_agg(DISTINCT CAST(l_linenumber % 5 - 1 AS VARCHAR), ',' ORDER BY CAST(l_linenumber % 5 - 1 AS VARCHAR)) FILTER (WHERE l_linenumber % 5 - 1 > 0), '') AS pages FROM lineitem GROUP BY l_orderkey",
    "atomic_units": f"WITH {ITEMS}, {UNITS} SELECT * FROM units",
    "walked_units": f"WITH {ITEMS}, {UNITS} SELECT * REPLACE ('#/groups/' || list_key AS list_key) FROM units",
    "list_violations": f"""WITH {ITEMS}, keyed AS (SELECT doc_id, pos, CASE WHEN list_key IS NULL THEN NULL ELSE CAST(pos // 3 AS VARCHAR) END AS list_key FROM items),
        marked AS (SELECT *, CASE WHEN lag(coalesce(list_key, '#' || pos)) OVER (PARTITION BY doc_id ORDER BY pos) = coalesce(list_key, '#' || pos) THEN 0 ELSE 1 END AS new FROM keyed)
        SELECT doc_id, list_key, CAST(sum(new) AS BIGINT) AS n FROM marked WHERE list_key IS NOT NULL GROUP BY doc_id, list_key HAVING sum(new) > 1""",
    "chunks_paged": f"{_PAGED_CHUNKS} SELECT {_COLUMNS} FROM chunks",
    "chunks_pageless": f"{_WITH}, {PAGELESS}, {CHUNKS} SELECT {_COLUMNS} FROM chunks",
    "chunk_links": f"""{_PAGED_CHUNKS} SELECT doc_id, printf('chunk-%06d', chunk_no + 1) AS chunk_id, lag(printf('chunk-%06d', chunk_no + 1)) OVER w AS previous_chunk_id,
        lead(printf('chunk-%06d', chunk_no + 1)) OVER w AS next_chunk_id FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_no)""",
    "chunk_groups": " UNION ALL ".join(
        f"""SELECT * FROM ({_WITH}, {part}, own AS (SELECT a.doc_id, a.chunk_no, a.unit_no, a.list_key, i.page FROM assigned a JOIN items i ON i.doc_id = a.doc_id AND i.pos BETWEEN a.pos AND a.last_pos)
        SELECT doc_id, chunk_no, coalesce(array_to_string(list_sort(list(DISTINCT page) FILTER (WHERE page IS NOT NULL)), ','), '') AS pages,
          coalesce((SELECT string_agg(list_key, ',' ORDER BY first_unit) FROM (SELECT list_key, min(unit_no) AS first_unit FROM own o WHERE o.doc_id = own.doc_id AND o.chunk_no = own.chunk_no AND list_key IS NOT NULL GROUP BY list_key)), '') AS group_ids FROM own GROUP BY doc_id, chunk_no)"""
        for part in (PAGED, PAGELESS)
    ),
    "chunk_coverage": f"{_PAGED_CHUNKS}, held AS (SELECT doc_id, sum(n_items) AS n FROM chunks GROUP BY doc_id) SELECT i.doc_id, count(*) AS n_items, CAST(max(h.n) AS BIGINT) AS n_covered FROM items i JOIN held h USING (doc_id) GROUP BY i.doc_id HAVING count(*) <> max(h.n)",
    "batch_pack": f"""{_PAGED_CHUNKS}, packed AS (
          SELECT doc_id, chunk_no, character_count, 0 AS batch_no, 1 AS cnt, character_count AS size FROM chunks WHERE chunk_no = 0
          UNION ALL
          SELECT c.doc_id, c.chunk_no, c.character_count, p.batch_no + CASE WHEN s.flush THEN 1 ELSE 0 END, CASE WHEN s.flush THEN 1 ELSE p.cnt + 1 END, CASE WHEN s.flush THEN c.character_count ELSE p.size + c.character_count END
          FROM packed p JOIN chunks c ON c.doc_id = p.doc_id AND c.chunk_no = p.chunk_no + 1, LATERAL (SELECT p.cnt >= 3 OR p.size + c.character_count > 4000 AS flush) s)
        SELECT doc_id, chunk_no, character_count, batch_no, character_count > 4000 AS is_oversized FROM packed""",
    "passage_packets": f"""{_WITH}, {PAGED}, ends AS (SELECT doc_id, chunk_no, min(unit_no) AS a, max(unit_no) AS b FROM assigned GROUP BY doc_id, chunk_no)
        SELECT e.doc_id, e.chunk_no, CASE WHEN u.unit_no < e.a THEN 'before' ELSE 'after' END AS side, u.unit_no, u.pos, u.last_pos
        FROM ends e JOIN assigned u ON u.doc_id = e.doc_id AND (u.unit_no BETWEEN e.a - 2 AND e.a - 1 OR u.unit_no BETWEEN e.b + 1 AND e.b + 2)""",
    "context_frames": f"""WITH {ITEMS} SELECT doc_id, pos, CAST(CASE WHEN page IS NOT NULL THEN sum(length(text)) OVER (PARTITION BY doc_id, page)
        ELSE sum(length(text)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS BIGINT) AS context_length FROM items""",
}
