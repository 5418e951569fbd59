"""vistaloom: spatial-annotation curation on Spark.

Every operator is a lazy DataFrame plan; see README.md for the map of modules.
"""
