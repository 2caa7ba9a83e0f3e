"""countcast: daily event-count forecasting as Spark DataFrame transformations."""
