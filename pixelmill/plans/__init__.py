"""The filter chain, archiving, manifests, summaries and whole runs."""
