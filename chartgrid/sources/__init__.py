from .tables import TABLES, read_table
from .fixtures import IcuSources, icu_sources

__all__ = ["TABLES", "read_table", "IcuSources", "icu_sources"]
