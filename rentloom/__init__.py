"""Rental-listing analytics on Spark: cleaning, expansion, location and rent quantiles."""
