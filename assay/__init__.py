"""assay: profile, model and diagnose tables of any size with Spark.

Every operator takes and returns DataFrames. A table is treated as one or many
datasets, told apart by a ``dataset_id`` column, so the same plan serves one
100 TB table or thousands of small ones.
"""
