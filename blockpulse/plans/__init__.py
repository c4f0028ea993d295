"""Named queries: each takes (spark, sf_dir) and returns a DataFrame."""
