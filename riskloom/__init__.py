"""riskloom: transaction-risk analytics and lake operations as Spark jobs.

Every operator is a function over DataFrames (or a pyspark.ml Estimator /
Transformer) so planning, shuffles and execution stay with Spark.
"""

__version__ = "0.1.0"
