"""Warehouse medallion jobs on PySpark: landing, conforming, marts, checks and the ship verdict."""
