"""murmur: Spark-native opinion analytics over large comment collections.

Every public function takes and returns Spark DataFrames (or Columns). Nothing
collects rows to the driver except small model summaries (topic-word tables).
"""

__version__ = "0.1.0"
