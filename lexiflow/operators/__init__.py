"""DataFrame → DataFrame jobs: counts, indexes, preprocessing, similarity joins."""
