"""Parcel revenue and profit analytics as Spark DataFrame transformations."""
