"""phonoloom: a PySpark-native engine for the data processing around speech-corpus annotation."""
