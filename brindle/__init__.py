"""brindle: tabular preparation, feature serving, modelling, forecasting and retrieval as PySpark jobs."""
