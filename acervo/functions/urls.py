"""URL columns: document type, storage key, title from a path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
PDF_SUFFIX = ".pdf"
SECURE_SCHEME = "^https://"
QUERY_PART = r"\?[^\n]*$"
LAST_PATH_PART = r"([^/]+?)(?:\.[^./]+)?/*$"


def document_type(url: Column) -> Column:
    return F.when(url.endswith(PDF_SUFFIX), F.lit("pdf")).otherwise(F.lit("html"))


def without_parameters(url: Column) -> Column:
    """Drop everything from the first ``?``; a fragment alone stays."""
    return F.regexp_replace(url, QUERY_PART, "")


def storage_key(url: Column) -> Column:
    """The folder a page is stored under: no ``https://``, no parameters."""
    return without_parameters(F.regexp_replace(url, SECURE_SCHEME, ""))


def storage_file(folder: str, url: Column) -> Column:
    return F.concat_ws("/", F.lit(folder.rstrip("/")), storage_key(url), F.lit("content.json"))


def path_title(url: Column) -> Column:
    """Last path part without its last suffix."""
    return F.regexp_extract(url, LAST_PATH_PART, 1)
