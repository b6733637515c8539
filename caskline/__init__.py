"""Sales-warehouse analytics on Spark DataFrames.

``sources``    raw file ingest, load control and versioned publishing
``functions``  column expressions (labels, casts, ratios, calendar arithmetic, display formats)
``operators``  dedup, cleansing, quality checks, global windows, dimensions and facts
``plans``      the business questions: loyalty, dashboard, segmentation, experiments
"""
