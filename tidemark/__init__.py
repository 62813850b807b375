"""Incremental lake ingestion on Spark: landing, bronze tables and their upkeep.

Every public function takes and returns Spark DataFrames (or Columns); nothing
here moves rows through the driver.
"""
