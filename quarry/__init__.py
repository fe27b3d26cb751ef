"""quarry: PySpark-native jobs for link graphs, ordered exports, labelled
feature tables, classifier training and experiment-sheet reports.

Every public function takes and returns DataFrames; the caller owns the
SparkSession and its configuration.
"""

__version__ = "0.1.0"
