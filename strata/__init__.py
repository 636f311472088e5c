"""strata: a medallion (bronze / silver / gold) retail analytics engine on PySpark.

Every operator is a DataFrame -> DataFrame function; writes go through
:class:`strata.sources.tables.Warehouse`, which keeps all tables under the
shared folder named by ``spark.checkpoint.dir``.
"""

from strata.config import Config

__all__ = ["Config"]
