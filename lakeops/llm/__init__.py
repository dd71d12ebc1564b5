"""Operators for large training-data pipelines. Nothing outside this folder imports it, except that
``__spark_entry__`` adds its queries when the folder is present."""
