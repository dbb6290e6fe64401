"""Delivery-operations warehouse built from Spark DataFrame jobs."""
