"""Registered queries over the test tables and the SQL to check them with."""
