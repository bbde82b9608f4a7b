"""DataFrame operators: profiling, quantiles, outliers, correlation,
transformers, splits and metrics."""
