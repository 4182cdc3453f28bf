"""Review curation on Spark: clean, filter, sample and package customer reviews."""
