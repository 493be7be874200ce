"""Link and fetch-log operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from acervo.functions.references import decoded
from acervo.functions.urls import document_type, storage_key

# What is cut away before tags are looked for, an anchor's start
# tag, and the three ways its href may be quoted.
# A comment, script or style that is never closed reaches to the page's end, so the
# lazy scan never fails and a page is read once, however many are opened.
NOT_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*+>|\z)|<style\b.*?(?:</style\s*+>|\z)"
# All repeats of the tag are possessive, so that they run as loops: a tag of any
# length, closed or not, neither recurses nor is tried twice. A bare "<" ends it, so
# tags that are never closed are not read again from each of them.
ANCHOR_TAG = r"""(?i)<a(?:\s++[^\s"'>/=<]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'><]++))?+|[\s/])*+>"""
HREF_VALUE = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
FILE_SUFFIX = r"\.pdf"
STATUS_OK = 200
STATUS_THROTTLED = 429


def hrefs(html: Column) -> Column:
    """Distinct href values of the anchors of a page, with their character references decoded."""
    markup = F.regexp_replace(html, NOT_MARKUP, "")
    anchors = F.regexp_extract_all(markup, F.lit(ANCHOR_TAG), F.lit(0))
    with_href = F.filter(anchors, lambda a: a.rlike(HREF_VALUE))
    return F.array_distinct(
        F.transform(
            with_href,
            lambda a: decoded(F.concat(*(F.regexp_extract(a, HREF_VALUE, g) for g in (1, 2, 3)))),
        )
    )


def is_site_link(href: Column, base: str | Column) -> Column:
    """Plain string prefix, so a longer host name passes too."""
    return href.startswith(base)


def is_file_link(href: Column, suffix: str = FILE_SUFFIX) -> Column:
    """Root-relative and ending in ``suffix`` (case-sensitive)."""
    return href.rlike(f"^/.*{suffix}$")


def found_urls(links: Column, base: str | Column, suffix: str = FILE_SUFFIX) -> Column:
    """Per-page set of URLs to follow: site links and, made absolute, file links."""
    base = F.lit(base) if isinstance(base, str) else base
    site = F.filter(links, lambda h: is_site_link(h, base))
    files = F.filter(links, lambda h: is_file_link(h, suffix))
    return F.array_union(site, F.transform(files, lambda h: F.concat(base, h)))


def page_links(
    pages: DataFrame,
    base: str | Column,
    url: str = "url",
    html: str = "text",
    suffix: str = FILE_SUFFIX,
) -> DataFrame:
    """Edge table ``links(src, dst)``; pdf pages have no out-links."""
    return (
        pages.filter(document_type(F.col(url)) == "html")
        .select(
            F.col(url).alias("src"),
            F.explode(found_urls(hrefs(F.col(html)), base, suffix)).alias("dst"),
        )
    )


def latest_per_storage_key(pages: DataFrame, seq: str = "seq") -> DataFrame:
    """One page per storage key: the one with the highest ``seq``, then the highest URL.

    Only keys, sequence numbers and URLs are aggregated; the page texts then move
    once, hashed by sequence number, URL and key together, so a key with a third
    of all pages is neither sorted nor gathered anywhere. Pages without a URL or a
    sequence number have a key of their own kind and are compared like any other.
    """
    keyed = pages.withColumn("key", storage_key(F.col("url")))
    best = keyed.groupBy("key").agg(F.max(F.struct(seq, "url")).alias("best"))
    winners = best.select(F.col("key").alias("_key"), F.col(f"best.{seq}").alias("_seq"), F.col("best.url").alias("_url"))
    same = F.col(seq).eqNullSafe(F.col("_seq")) & F.col("url").eqNullSafe(F.col("_url")) & F.col("key").eqNullSafe(F.col("_key"))
    return keyed.join(winners, same).drop("_key", "_seq", "_url")


def fetched_pages(fetch_log: DataFrame) -> DataFrame:
    return fetch_log.filter(F.col("status_code") == STATUS_OK)


def fetch_outcome(fetch_log: DataFrame) -> DataFrame:
    """Per URL: latest status, whether to fetch again, whether it was throttled."""
    return (
        fetch_log.groupBy("url")
        .agg(
            F.max_by("status_code", "seq").alias("status_code"),
            F.max(F.col("status_code") == STATUS_THROTTLED).alias("was_throttled"),
        )
        .select(
            "url",
            "status_code",
            (F.col("status_code") != STATUS_OK).alias("retry"),
            (F.col("status_code") == STATUS_THROTTLED).alias("throttled"),
            "was_throttled",
        )
    )


def retry_urls(fetch_log: DataFrame) -> DataFrame:
    """``(url, throttled)`` of the URLs whose latest fetch failed."""
    return fetch_outcome(fetch_log).filter("retry").select("url", "throttled")


def unvisited(urls: DataFrame, visited: DataFrame, url: str = "url") -> DataFrame:
    """Each URL once, without those already visited."""
    return urls.select(url).distinct().join(visited.select(url), url, "left_anti")



def attempt_outcomes(fetch_log: DataFrame, max_attempts: int) -> DataFrame:
    """Per URL what its first ``max_attempts`` fetches come to: ``(url, attempts, status_code, fetched)``.

    ``attempts`` counts up to the first success, or all that are allowed;
    ``status_code`` is the status of the last of them. Of a URL with very many
    attempts each task passes on only the first few.
    """
    order = Window.partitionBy("url").orderBy("seq")
    first = fetch_log.select("url", "seq", "status_code").withColumn("attempt", F.row_number().over(order))
    first = first.filter(F.col("attempt") <= max_attempts)
    success = F.min(F.when(F.col("status_code") == STATUS_OK, F.col("attempt")))
    return first.groupBy("url").agg(
        F.coalesce(success, F.max("attempt")).alias("attempts"),
        F.when(success.isNotNull(), F.lit(STATUS_OK)).otherwise(F.max_by("status_code", "attempt")).alias("status_code"),
        success.isNotNull().alias("fetched"),
    )
