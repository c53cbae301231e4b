"""corpuslink: Spark-native analytics over structured text corpora and weighted links.

Every operator is a function from DataFrames (and column names) to a DataFrame.
Nothing here calls an action unless the docstring says so (ML fits, dense-id
offsets, sinks).
"""

from corpuslink.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
