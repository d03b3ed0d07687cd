"""tessera: tabular analytics on Spark.

Readers and writers, column expressions, relational and statistical
operators, sampling, plot data computed on the cluster, MLlib feature /
model / tuning / pipeline jobs, and a file-stream scorer.  Every public
function takes and returns Spark DataFrames (or Columns); nothing pulls a
whole table through the driver.
"""

__version__ = "0.1.0"
