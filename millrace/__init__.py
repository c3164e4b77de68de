"""millrace: a PySpark-native engine for curating conversational and training text."""
