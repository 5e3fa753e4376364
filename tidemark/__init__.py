"""tidemark: vintage-aware economic and market time series on PySpark.

Layers: ``sources`` (landed payloads, seeds, log tables), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans``
(end-to-end pipelines and the query registry) and ``streaming``.
"""
