"""Text analytics and extractive-QA evaluation as Spark DataFrame operators."""
