"""Panel analytics on Spark: raw wide files to a small star schema to answers.

Every operator is a function from DataFrame to DataFrame. The shape most of them
share is the panel: one row per (date, entity) with a value.
"""
