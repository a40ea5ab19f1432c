"""Terrace: medallion, slowly-changing-dimension and star-schema analytics as Spark jobs.

Every public function takes and returns DataFrames or Columns and is
parameterised by column names, so the same operator serves any catalog.
"""
