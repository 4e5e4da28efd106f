"""orderlake: a Spark-native engine for cleaning, modelling, scoring and
streaming e-commerce order data.

Layout
------
functions   Column -> Column helpers (cleaners, money, scores)
operators   DataFrame -> DataFrame operators (enrich, quality, model, metrics,
            fraud, live views, message log)
sources     readers, writers and the adapters over the supplied tables
streaming   Structured Streaming sources, transformations and sinks
plans       end-to-end jobs and the registered queries
"""
