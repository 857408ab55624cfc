"""Payments mart on Spark: message stream -> outbox -> staging -> daily turnover mart."""
