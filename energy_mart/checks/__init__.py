"""The library run on the driver's generated tables, with a SQL twin for each query."""
