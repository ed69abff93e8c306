"""billow: layered subscription-billing analytics on Spark.

Raw CSV lands as bronze, is cleaned to silver, checked by a data-quality
report and gate, and modelled into gold dimensions and facts that answer
Spark SQL.  Everything is DataFrame / Spark SQL; order-sensitive steps carry
an explicit ordinal instead of relying on row order.

Layout
------
``functions``  column expressions (dates, text, money)
``operators``  DataFrame -> DataFrame building blocks (dedup, nulls, joins, aggs)
``sources``    CSV / Parquet / catalog readers and writers, layer paths, test roles
``plans``      composed stages: clean, enrich, marts, quality, analytics, pipeline
"""

from billow.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
