"""Random forest training, search, evaluation and scoring with pyspark.ml."""
