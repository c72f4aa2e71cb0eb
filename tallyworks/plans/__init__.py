"""Bindings of the operators to the driver's tables, with the SQL they are checked against."""
