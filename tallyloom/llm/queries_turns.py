"""Query over conversations: repair of their structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import turns
from tallyloom.llm.queries_trees import _CRC
from tallyloom.llm.registry import query, table

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# state after an insert, and what a kept initial leads to (-1: not allowed)
_AFTER = "CASE {0} WHEN 2 THEN 3 ELSE 2 END"
_KEPT = "CASE WHEN ini = 's' AND s = 0 THEN 1 WHEN ini = 'u' AND s <> 2 THEN 2 WHEN ini = 'a' AND s = 2 THEN 3 ELSE -1 END"
_NAME = "CASE s WHEN 2 THEN 'assistant' ELSE 'user' END"

_SQL = f"""WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
   {_CRC.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
 d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
   unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE kind <> 0),
 o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
   sha256(strlen(role)::VARCHAR || ':' || role || text), copy) - 1 AS i FROM d),
 f AS MATERIALIZED (SELECT *, rtrim(text, {_WHITE}) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
   left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS was FROM o),
 r AS MATERIALIZED (SELECT conv_id, turn, i, role, text, ini, was,
   CASE WHEN body = '' THEN 'b' WHEN seen THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM f),
 n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
   count(*) FILTER (was IS NOT NULL AND was || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
 ins AS (SELECT s AS q, k, CASE k WHEN 0 THEN s WHEN 1 THEN {_AFTER.format('s')} ELSE {_AFTER.format(_AFTER.format('s'))} END AS s,
   CASE k WHEN 0 THEN '' WHEN 1 THEN {_NAME} || ':' || chr(10) ELSE CASE s WHEN 2 THEN 'assistant:' || chr(10) || 'user:'
    ELSE 'user:' || chr(10) || 'assistant:' END || chr(10) END AS lines FROM range(4) a(s), range(3) b(k)),
 it AS (SELECT conv_id, 0::BIGINT AS i, 0::BIGINT AS q, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM n
  UNION ALL
  SELECT conv_id, i + 1, to_q, min(cost), arg_min(audit, printf('%09d', cost) || audit), arg_min(lines, printf('%09d', cost) || audit)
  FROM (SELECT *, base + m.c AS cost, head || m.e AS audit, before || m.l AS lines, m.q AS to_q FROM (SELECT *, unnest([{{'q': s, 'c': 3, 'e': 'D', 'l': ''}}, {{'q': kept, 'c': t, 'e': 'K', 'l': role || ':' || text || chr(10)}},
     {{'q': {_AFTER.format('s')}, 'c': 2 + t, 'e': 'R', 'l': {_NAME} || ':' || text || chr(10)}}]) AS m
    FROM (SELECT it.conv_id, it.i, r.role, r.text, r.fault, ins.s, {_KEPT} AS kept, (r.fault = 't')::BIGINT AS t, it.cost + 2 * ins.k AS base,
      it.audit || repeat('I', ins.k) AS head, it.lines || ins.lines AS before
     FROM it JOIN r ON r.conv_id IS NOT DISTINCT FROM it.conv_id AND r.i = it.i JOIN ins ON ins.q = it.q)))
  WHERE to_q >= 0 AND (m.e = 'D' OR fault NOT IN ('b', 'd')) GROUP BY conv_id, i, to_q),
 ends AS (SELECT it.conv_id, it.cost + 2 * ins.k AS cost, it.audit || repeat('I', ins.k) AS audit, it.lines || ins.lines AS lines
  FROM it JOIN n ON n.conv_id IS NOT DISTINCT FROM it.conv_id AND it.i = n.n JOIN ins ON ins.q = it.q WHERE ins.s IN (0, 3)),
 best AS (SELECT conv_id, min(cost) AS cost, arg_min(audit, printf('%09d', cost) || audit) AS audit,
   arg_min(lines, printf('%09d', cost) || audit) AS lines FROM ends GROUP BY conv_id),
 ids AS (SELECT DISTINCT conv_id FROM conversations)
 SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(left(lines, length(lines) - 1), '')) AS repaired_sha256
 FROM ids LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id"""


@query(sql=_SQL)
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation of ``conversations``, damaged and repaired: faults, cheapest edits and the digest of the result."""
    found = turns.audits_of(table(spark, folder, "conversations"), damage=turns.damaged)
    return found.withColumnsRenamed({"conv": "conv_id", "digest": "repaired_sha256"})
