"""Whole queries over named tables, with SQL that states the same results."""
