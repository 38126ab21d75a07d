"""Media-mix analytics on Spark DataFrames."""

from mediamix.catalog import Catalog, load_catalog
from mediamix.grain import Grain

__all__ = ["Catalog", "Grain", "load_catalog"]
