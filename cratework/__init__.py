"""cratework: daily ZIP deliveries to typed tables and marts, on Spark.

Layers: a declared source registry becomes a list of expected files, the files
are landed and checked, archive members become Parquet rows (bronze), rows are
cast, cleaned and de-duplicated (silver) and joined into marts (gold).
"""
