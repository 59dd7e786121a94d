"""skein: a Spark-native engine for curating large media and text collections."""
