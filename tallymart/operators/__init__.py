"""DataFrame -> DataFrame operators. None of them writes."""
