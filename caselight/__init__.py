"""PySpark operators for building and watching tables of case reports."""
