"""Registered queries over the driver's tables, each with the SQL that another engine can check it by."""
