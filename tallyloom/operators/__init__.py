"""DataFrame operators: clean, join, count, order, sample and measure."""
