"""Speech-corpus analytics and training-data operators as Spark plans."""
