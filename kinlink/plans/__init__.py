"""Named jobs (compositions of operators) and the test-table catalog."""
