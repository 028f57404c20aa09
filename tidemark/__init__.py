"""tidemark: pipeline analytics on Spark, the same operators for tables and for streams."""
