"""shelf: a Spark-native analytics engine for bibliographic catalogues."""
