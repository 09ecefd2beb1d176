"""tillroll: Spark-native operators for retail price observations.

Bronze (raw observations) -> Silver (clean, deduplicated, upserted history)
-> Gold (price change, unit prices, recipe costing) plus data-quality and
audit reports.  Every operator is DataFrame in -> DataFrame out and is built
from Spark's built-in functions only.
"""

__version__ = "0.1.0"
