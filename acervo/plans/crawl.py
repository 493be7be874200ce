"""Bounded breadth-first expansion over an already fetched link table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from acervo.operators.index import with_dense_ids
from acervo.operators.links import attempt_outcomes
from acervo.session import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, cut_lineage, measured

MAX_WEBS = 300
MAX_ATTEMPTS = 5
LEVELS_PER_TABLE = 16  # levels after which the visited URLs become one table again


def expand_frontier(links: DataFrame, seed: DataFrame, max_webs: int = MAX_WEBS) -> DataFrame:
    """``visited(url, depth)``: level by level from ``seed(url)`` until no new
    URL or ``max_webs`` URLs are visited; inside a level by rising URL.

    Each level is written to the shared checkpoint folder, and every
    ``LEVELS_PER_TABLE`` levels all visited URLs are, so plans stay short and a
    lost executor costs no earlier level. ``links`` is read at every level and
    should be a stored table. The frontier and the visited URLs are measured;
    they are broadcast while they are small, and above that joined by hash,
    where adaptive execution splits pages of very many links.
    """
    frontier = _first_urls(seed.select("url").distinct(), max_webs, 0)
    visited = frontier
    size = seen = measured(frontier)
    depth = 0
    while size[0] and seen[0] < max_webs:
        depth += 1
        sources = _few(frontier.select(F.col("url").alias("src")), size)
        known = _few(visited.select("url"), seen)
        found = (
            links.join(sources, "src", "left_semi")
            .select(F.col("dst").alias("url"))
            .distinct()
            .join(known, "url", "left_anti")
        )
        frontier = _first_urls(found, max_webs - seen[0], depth)
        size = measured(frontier)
        seen = (seen[0] + size[0], seen[1] + size[1])
        visited = visited.unionByName(frontier)
        if depth % LEVELS_PER_TABLE == 0:
            visited = cut_lineage(visited)
    return visited


def expand_fetched(
    links: DataFrame, fetch_log: DataFrame, seed: DataFrame, max_webs: int = MAX_WEBS, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """``visited(url, depth, attempts, status_code, fetched)``: expansion over what a fetch log tells of each URL.

    A URL is found at the level ``depth`` and fetched there; after a failure it returns to
    the frontier of the next level, ``max_attempts`` fetches in all. Its links count from
    the level at which it was fetched with success, and from none if it never was. A
    URL that the log does not have was not tried: no attempts, no status, no links.
    ``max_webs`` bounds the URLs found, inside a level by rising URL.

    The log is reduced to one row per URL first. A level reads the URLs found in the
    last ``max_attempts`` levels, each a stored table, so its plan does not grow.
    """
    outcomes = cut_lineage(attempt_outcomes(fetch_log, max_attempts))

    def judged(urls: DataFrame) -> DataFrame:
        told = urls.join(outcomes, "url", "left").fillna({"attempts": 0, "fetched": False})
        return cut_lineage(told.select("url", "depth", F.col("attempts").cast("int").alias("attempts"), "status_code", "fetched"))

    fresh = judged(_first_urls(seed.select("url").distinct(), max_webs, 0))
    visited, recent = fresh, [(0, fresh)]
    seen = measured(fresh)
    level = 0
    while True:
        open_ = reduce(DataFrame.unionByName, (table for _, table in recent)).filter("fetched").withColumn("open", F.col("depth") + F.col("attempts") - 1)
        due = open_.agg(F.count(F.when(F.col("open") == level, 1)).alias("now"), F.count(F.when(F.col("open") > level, 1)).alias("later")).first()
        if seen[0] >= max_webs or not (due["now"] or due["later"]):
            return visited
        level += 1
        if due["now"]:
            sources = cut_lineage(open_.filter(F.col("open") == level - 1).select(F.col("url").alias("src")))
            known = _few(visited.select("url"), seen)
            found = (
                links.join(_few(sources, measured(sources)), "src", "left_semi")
                .select(F.col("dst").alias("url"))
                .distinct()
                .join(known, "url", "left_anti")
            )
            fresh = judged(_first_urls(found, max_webs - seen[0], level))
            size = measured(fresh)
            seen = (seen[0] + size[0], seen[1] + size[1])
            visited = visited.unionByName(fresh)
            recent.append((level, fresh))
        # URLs of older levels have no fetch left to wait for.
        recent = [(depth, table) for depth, table in recent if depth + max_attempts > level]
        if level % LEVELS_PER_TABLE == 0:
            visited = cut_lineage(visited)


def _few(urls: DataFrame, size: tuple[int, int]) -> DataFrame:
    rows, width = size
    return F.broadcast(urls) if rows <= MAX_BROADCAST_ROWS and width <= MAX_BROADCAST_BYTES else urls


def _first_urls(urls: DataFrame, n: int, depth: int) -> DataFrame:
    """The ``n`` smallest of distinct ``urls``, stored."""
    if n <= MAX_BROADCAST_ROWS:
        first = urls.orderBy("url").limit(n)
    else:
        # Too many for the one task that ends a limit: number them in order.
        first = with_dense_ids(urls, "url", name="place").filter(F.col("place") < n)
    return cut_lineage(first.select("url", F.lit(depth).alias("depth")))


def seed_urls(links: DataFrame, *urls: str) -> DataFrame:
    schema = T.StructType([T.StructField("url", T.StringType())])
    return links.sparkSession.createDataFrame([(u,) for u in urls], schema)
