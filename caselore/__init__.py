"""Support-case analytics as PySpark DataFrame operators."""
