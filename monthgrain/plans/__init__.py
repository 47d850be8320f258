"""Feature sets, labels and the monthly job, put together from the operators."""
