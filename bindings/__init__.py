"""The operators bound to the test tables, each with SQL that states the expected result."""
