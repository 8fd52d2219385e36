"""shardloom: Spark-native preparation, scoring and evaluation of
machine-learning data (text encoding, splits and batches, shard export,
batch inference, box transforms, detection metrics, restartable per-row work).
"""

__version__ = "0.1.0"
