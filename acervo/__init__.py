"""Document indexing and boolean ranked search over Spark DataFrames."""

from acervo.operators.index import Index, build_documents, index_from_documents
from acervo.plans.build import index_pages
from acervo.plans.crawl import expand_frontier
from acervo.plans.search import match_one, search_batch, search_one
from acervo.sources.index_store import load_index, save_index

__all__ = [
    "Index",
    "build_documents",
    "expand_frontier",
    "index_from_documents",
    "index_pages",
    "load_index",
    "match_one",
    "save_index",
    "search_batch",
    "search_one",
]
