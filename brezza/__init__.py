"""brezza: a Spark-first engine for environmental time series and the data pipelines around them."""
