"""Training-data operators on Spark: token files, packing, WARC, filters, near-duplicate and benchmark checks."""
