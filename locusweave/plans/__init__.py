"""The virtual genome over the test tables and the registered queries."""
