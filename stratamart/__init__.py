"""Layered retail analytics on Spark: raw tables -> clean -> star schema -> reports.

Every public function takes and returns DataFrames and stays lazy unless its name says
that it writes (``write_*``, ``publish_*``) or gates (``enforce``).
"""
