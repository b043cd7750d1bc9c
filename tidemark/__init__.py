"""tidemark: change-log analytics on Spark DataFrames.

Row changes come in as topic records, are decoded and flattened, reduced to the
newest version of each key, and read through business metrics. Every transform
is ``DataFrame -> DataFrame`` and runs unchanged in batch and in a stream.
"""

from tidemark.schemas import CUSTOMERS, ORDERS, PRODUCTS, TABLES, TableSpec

__all__ = ["CUSTOMERS", "ORDERS", "PRODUCTS", "TABLES", "TableSpec"]
