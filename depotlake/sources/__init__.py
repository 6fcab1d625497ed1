from depotlake.sources.adapter import retail_sources
from depotlake.sources.jdbc import jdbc_sources, read_jdbc
from depotlake.sources.registry import Sources, preview, source_counts, with_defaults

__all__ = [
    "Sources",
    "jdbc_sources",
    "preview",
    "read_jdbc",
    "retail_sources",
    "source_counts",
    "with_defaults",
]
