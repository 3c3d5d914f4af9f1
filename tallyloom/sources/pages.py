"""Landed result pages: ``{"data": [...], "meta": {"next_token": ...}}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyloom.operators.ordered import running_total
from tallyloom.session import settled

PAGE_SCHEMA = (
    "data array<struct<id:string, text:string, author_id:string, created_at:string>>, "
    "meta struct<next_token:string>"
)


def read_pages(spark: SparkSession, path: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    """One row per page file; ``page_no`` is the number in the file name and ``page_token`` the token it was asked for with.

    The token is what follows the number in the file name (``page-0007-TOKEN.json``), null if nothing does.
    """
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).try_cast("bigint")
    asked = F.nullif(F.regexp_extract(F.col("_metadata.file_name"), r"\d+-([^.]+)\.", 1), F.lit(""))
    return spark.read.schema(schema).json(path, multiLine=True).withColumns({"page_no": number, "page_token": asked})


def records(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per record of the pages."""
    return pages.select(*keep, F.inline("data"))


def page_places(pages: DataFrame, token: str = "page_token", following: str = "next_token", group: Sequence[str] = ()) -> DataFrame:
    """``group, page_token, place``: the pages that following the tokens from the first page meets, in order (from 0).

    The first page is the one asked for without a token.  List ranking by pointer doubling: in round r every page
    knows the page 2^r further on, and the pages found so far bring in as many again, so n pages take log2 n rounds.
    Defined where the tokens are no plain list: of pages with one token the one with the least next token counts
    (none comes last); a page met again (a loop) keeps its first place, and nothing follows it twice; a token
    without a page ends the list.  No first page, no places.
    """
    group = list(group)
    named = pages.select(*group, F.coalesce(F.concat(F.lit("t"), token), F.lit("")).alias("_at"),
                         F.concat(F.lit("t"), following).alias("_to"))
    # min skips nulls, so a page that ends the list counts only if none of its name goes on
    links = settled(named.groupBy(*group, "_at").agg(F.min("_to").alias("_to")))
    jump = links.join(links.select(*group, F.col("_at").alias("_to")), [*group, "_to"], "left_semi")
    found = settled(links.where("_at = ''").select(*group, "_at", F.lit(0).cast("bigint").alias("place")))
    count, step = found.count(), 1
    while True:
        further = found.join(jump, [*group, "_at"]).select(*group, F.col("_to").alias("_at"), (F.col("place") + step).alias("place"))
        found = settled(found.unionByName(further).groupBy(*group, "_at").agg(F.min("place").alias("place")))
        before, count = count, found.count()
        if count == before:
            break
        far = jump.select(*group, F.col("_at").alias("_to"), F.col("_to").alias("_far"))
        jump = settled(jump.join(far, [*group, "_to"]).select(*group, "_at", F.col("_far").alias("_to")))
        step *= 2
    return found.select(*group, F.when(F.col("_at") != "", F.substring("_at", 2, 1 << 30)).alias(token), "place")


def collect_pages_by_token(pages: DataFrame, cap: int | None = None, keep_last: bool = True, data: str = "data",
                           token: str = "page_token", following: str = "next_token", group: Sequence[str] = ()) -> DataFrame:
    """Pages in the order of their tokens up to the stop, with their ``place``; see ``page_places`` and ``collect_pages``.

    Of several pages with one token the one that counts is taken (the least by its records if they also share
    the next token).
    """
    group = list(group)
    places = page_places(pages, token, following, group)
    rank = Window.partitionBy(*group, token).orderBy(F.col(following).asc_nulls_last(), F.col(data).cast("string"))
    one = pages.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")
    other = places.withColumnsRenamed({c: f"_p_{c}" for c in [*group, token]})
    match = F.lit(True)
    for c in [*group, token]:
        match = match & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    placed = one.join(other, match).drop(*[f"_p_{c}" for c in [*group, token]])
    return collect_pages(placed, cap, keep_last, data, following, "place", group)


def collect_pages(pages: DataFrame, cap: int | None = None, keep_last: bool = True,
                  data: str = "data", token: str = "next_token", page: str = "page_no",
                  group: Sequence[str] = ()) -> DataFrame:
    """Pages up to the stop: the cap is tested before a page is taken, so it may be passed by one page.

    ``keep_last=False`` also stops *before* the page that has no next token.
    Only page numbers and sizes are put in order; the pages themselves stay
    where they are and are filtered by the last page number taken.
    """
    sizes = pages.select(
        *group, page, F.size(data).cast("bigint").alias("_n"), F.col(token).isNull().cast("bigint").alias("_end")
    )
    run = running_total(sizes, [page], ["_n", "_end"], ["_total", "_ends"], group)
    ends_before = F.col("_ends") - F.col("_end") if keep_last else F.col("_ends")
    taken = run.where(ends_before == 0)
    if cap is not None:
        taken = taken.where(F.col("_total") - F.col("_n") < cap)
    last = taken.groupBy(*group).agg(F.max(page).alias("_last"))
    if not group:
        return pages.where(F.col(page) <= last.scalar())
    return pages.join(last, list(group)).where(F.col(page) <= F.col("_last")).drop("_last")


def collect_texts(pages: DataFrame, cap: int | None = None, keep_last: bool = True, **names) -> DataFrame:
    """``text`` of every record on the collected pages."""
    kept = collect_pages(pages, cap, keep_last, **names)
    return kept.select(F.explode(names.get("data", "data")).alias("_r")).select(F.col("_r.text").alias("text"))
