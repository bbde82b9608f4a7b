"""Pipeline builders (spec in, ``Pipeline`` out), tuning and summaries."""
