"""Speech-and-text corpus engine on Spark."""
