"""Search predicates, lookups, days and landed pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.functions.dates import day_bounds, in_previous_day, iso_time
from tallyloom.operators import lookup, stats
from tallyloom.sources import pages as pg


@query(r"""SELECT doc_id, lang FROM documents
 WHERE regexp_matches(text, '(?i)(^|[^\w])(the|and)([^\w]|$)') AND NOT source = 'forum' AND lang = 'en'""")
def search_predicate(spark, folder):
    docs = table(spark, folder, "documents")
    found = lookup.search("text", ["the", "and"], F.col("source") == "forum", "lang", "en")
    return docs.where(found).select("doc_id", "lang")


@query("""SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def lookup_ids(spark, folder):
    wanted = table(spark, folder, "labels").where("toxic = 1").select("doc_id")
    return lookup.by_ids(table(spark, folder, "documents"), wanted, "doc_id", ["doc_id", "lang", "n_chars"])


@query("""SELECT event_id, user_id, value FROM events
 WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 50)""")
def lookup_users(spark, folder):
    events = table(spark, folder, "events")
    wanted = events.where("event_type = 'error' AND value > 50").select("user_id")
    return lookup.by_ids(events, wanted, "user_id", ["event_id", "user_id", "value"])


@query("""SELECT event_id, '2024-01-14T00:00:00Z' AS day_start, '2024-01-14T23:59:59Z' AS day_end FROM events
 WHERE ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-15'""")
def previous_day(spark, folder):
    as_of = F.lit("2024-01-15").cast("date")
    start, end = day_bounds(as_of)
    return table(spark, folder, "events").where(in_previous_day("ts", as_of)).select(
        "event_id", start.alias("day_start"), end.alias("day_end"))


@query("""SELECT event_id, CASE WHEN event_id % 70 < 60 AND event_id % 32 BETWEEN 1 AND 31 THEN
 printf('2024-01-%02dT%02d:%02d:00Z', event_id % 32, event_id % 24, event_id % 70) END AS iso FROM events""")
def iso_times(spark, folder):
    n = F.col("event_id").cast("int")
    return table(spark, folder, "events").select(
        "event_id", iso_time(F.lit(2024), F.lit(1), n % 32, n % 24, n % 70).alias("iso"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def daily_counts(spark, folder):
    return stats.daily_counts(table(spark, folder, "events"), "ts").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 1 OFFSET 1""")
def last_complete_day(spark, folder):
    counts = stats.daily_counts(table(spark, folder, "events"), "ts")
    return stats.last_complete_day(counts).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


# -- pages: events packed 100 to a page, the last page without a next token -------------------

def landed_pages(spark, folder):
    events = table(spark, folder, "events")
    last = events.agg(F.floor(F.max("event_id") / 100)).scalar()
    record = F.struct(
        F.col("event_id").alias("id"), F.concat_ws(" ", "event_type", "props").alias("text"), F.col("user_id").alias("author_id"))
    packed = events.groupBy(F.floor(F.col("event_id") / 100).alias("page_no")).agg(
        F.array_sort(F.collect_list(record)).alias("data"))
    return packed.withColumn("next_token", F.when(F.col("page_no") < last, F.concat(F.lit("t"), F.col("page_no") + 1)))


_PAGES_SQL = """WITH p AS (SELECT event_id // 100 AS page_no, event_id, event_type || ' ' || props AS text FROM events),
 n AS (SELECT page_no, count(*) AS size FROM p GROUP BY page_no),
 r AS (SELECT page_no, sum(size) OVER (ORDER BY page_no) - size AS before, max(page_no) OVER () AS last FROM n)"""


@query(_PAGES_SQL + " SELECT event_id AS id, text FROM p JOIN r USING (page_no) WHERE before < 3050")
def collect_pages(spark, folder):
    kept = pg.collect_pages(landed_pages(spark, folder), cap=3050)
    return pg.records(kept).select("id", "text")


@query(_PAGES_SQL + " SELECT text FROM p JOIN r USING (page_no) WHERE page_no < last")
def collect_pages_without_last(spark, folder):
    return pg.collect_texts(landed_pages(spark, folder), keep_last=False)


@query("SELECT event_id // 100 AS page_no, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS ids FROM events GROUP BY 1")
def page_fields(spark, folder):
    ids = lookup.field_of("data", "id").cast("array<string>")
    return landed_pages(spark, folder).select("page_no", F.array_join(ids, ",").alias("ids"))


# -- pages whose order is in their tokens only ------------------------------------------------

def chained_pages(spark, folder):
    """The landed pages with tokens that lead through them in another order than that of their numbers."""
    pages = landed_pages(spark, folder).drop("next_token")
    count = pages.agg(F.max("page_no") + 1).scalar()
    token = lambda n: F.when(n > 0, F.md5(F.concat(F.lit("page"), n.cast("string"))))
    after = (F.col("page_no") * 7 + 3) % F.lit(count)
    return pages.withColumns({"page_token": token(F.col("page_no")), "next_token": token(after)})


_CHAIN_SQL = """WITH RECURSIVE p AS (SELECT event_id // 100 AS page_no, event_id, event_type || ' ' || props AS text FROM events),
 n AS (SELECT page_no, count(*) AS size, (page_no * 7 + 3) % (SELECT max(page_no) + 1 FROM p) AS after FROM p GROUP BY page_no),
 c AS (SELECT page_no, size, after, 0 AS place, [page_no] AS met FROM n WHERE page_no = 0
  UNION ALL SELECT n.page_no, n.size, n.after, place + 1, list_append(met, n.page_no) FROM c JOIN n ON n.page_no = c.after
  WHERE c.after > 0 AND NOT list_contains(met, n.page_no)),
 r AS (SELECT *, sum(size) OVER (ORDER BY place) - size AS before FROM c)"""


@query(_CHAIN_SQL + " SELECT r.page_no, place, event_id AS id, text FROM r JOIN p USING (page_no) WHERE before < 3050")
def collect_pages_by_token(spark, folder):
    kept = pg.collect_pages_by_token(chained_pages(spark, folder), cap=3050)
    return pg.records(kept, "page_no", "place").select("page_no", "place", "id", "text")


@query(_CHAIN_SQL + " SELECT page_no, place, size FROM r")
def page_places(spark, folder):
    pages = chained_pages(spark, folder)
    placed = pg.page_places(pages)
    match = placed["page_token"].eqNullSafe(pages["page_token"])
    return placed.join(pages, match).select("page_no", "place", F.size("data").cast("bigint").alias("size"))
