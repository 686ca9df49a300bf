"""Retail analytics on Spark: snapshots -> staging -> star schema -> marts."""
