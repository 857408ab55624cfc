"""The daily jobs, put together from operators and tables."""
