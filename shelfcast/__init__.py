"""Feature engineering, profiling and forecasting for retail time series, as Spark jobs."""
