"""A Spark-native engine for message archives, story analytics and training-data preparation."""
