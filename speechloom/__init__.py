"""A Spark-native engine for speech-and-text corpora: codec alphabets, interleaved documents, views, statistics, audits."""
