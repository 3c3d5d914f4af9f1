"""Query over trees of digests: the dataset manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import merkle
from tallyloom.llm.registry import query, table

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

# crc32 (reflected, polynomial 0xEDB88320) of a short ASCII text, bit by bit
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x // 2, (x % 2) * 3988292384)))
  , 4294967295::BIGINT)"""
_PART = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_PART.format(c if c != "text" else text) for c in COLUMNS) + ")"


def _climb_sql(name: str, start: str) -> str:
    """Nodes of all levels of all trees: ``g, l, i, h`` and the number of nodes of the level."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT g, l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(c) + 2) // 3 FROM {name} WHERE c > 1 GROUP BY g, l, i // 3)"""


_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, source AS g, {_leaf_sql('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {_CRC.format('(doc_id::VARCHAR)')} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")}
   ELSE {_leaf_sql('text')} END AS forged FROM documents),
 p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS c FROM d),
 {_climb_sql("low", "SELECT g, 0 AS l, i, leaf AS h, c FROM p")},
 s AS MATERIALIZED (SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS k, l AS height FROM low WHERE c = 1),
 {_climb_sql("high", "SELECT 0 AS g, 0 AS l, k AS i, subroot AS h, (SELECT count(*) FROM s) AS c FROM s")},
 walk AS (SELECT p.doc_id, p.leaf, p.forged, s.subroot, p.g, p.i, s.k, s.height FROM p JOIN s ON p.g IS NOT DISTINCT FROM s.g),
 steps AS (
  SELECT w.g, w.i, n.l AS l, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < w.i // pow(3, n.l)::BIGINT), '') AS before,
   coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > w.i // pow(3, n.l)::BIGINT), '') AS after
  FROM walk w JOIN low n ON n.g IS NOT DISTINCT FROM w.g AND n.l < w.height AND n.i // 3 = w.i // pow(3, n.l + 1)::BIGINT GROUP BY w.g, w.i, n.l
  UNION ALL
  SELECT w.g, w.i, w.height + n.l, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < w.k // pow(3, n.l)::BIGINT), ''),
   coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > w.k // pow(3, n.l)::BIGINT), '')
  FROM walk w JOIN high n ON n.c > 1 AND n.i // 3 = w.k // pow(3, n.l + 1)::BIGINT GROUP BY w.g, w.i, w.height, n.l),
 proofs AS (SELECT g, i, list({{'b': before, 'a': after}} ORDER BY l) AS steps FROM steps GROUP BY g, i),
 out AS (SELECT w.doc_id, w.leaf, w.subroot, (SELECT h FROM high WHERE c = 1) AS root,
   sha256(coalesce(list_aggregate(list_transform(steps, lambda x: x.b || x.a), 'string_agg', ''), '')) AS proof_sha256,
   CASE WHEN steps IS NULL THEN forged ELSE list_reduce([forged] || list_transform(steps, lambda x: x.b || '|' || x.a),
    lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) END AS folded_root
  FROM walk w LEFT JOIN proofs q ON q.g IS NOT DISTINCT FROM w.g AND q.i = w.i)
 SELECT *, folded_root = root AS verified FROM out"""


@query(sql=_SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of ``documents`` by source, and every document checked again with newlines deleted in about half of them.

    Rows without an id are not tampered with.
    """
    docs = table(spark, folder, "documents")
    cut = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else c for c in COLUMNS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    now = F.when(hit, merkle.leaf_digest(cut)).otherwise(merkle.leaf_digest(COLUMNS)).alias("now")
    found = merkle.manifest(docs, COLUMNS, "source", "doc_id", carry=[now])
    checked = found.withColumn("folded_root", merkle.folded(F.col("now"), F.col("proof")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
