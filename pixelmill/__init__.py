"""Image-collection curation on Spark: scan, filter chain, archive, manifest, labels."""
