"""DataFrame -> DataFrame operators. None of them collects to the driver."""
