"""Operators and ready queries for click, order, login and sensor data on PySpark."""
