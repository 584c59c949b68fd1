"""Tablewright: building, patching, auditing and summarising curated tables as Spark DataFrames."""
