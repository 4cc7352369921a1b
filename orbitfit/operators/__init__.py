"""Distributed operators: points, sampling, seeding, k-means, reports,
prefix sums, least squares and the ordered affine scan."""
