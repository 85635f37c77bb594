"""Streaming.

The original job has no streaming part, so this package adds no stream operators. The
row-level scoring steps are stateless column expressions and run unchanged on a streaming
DataFrame from ``spark.readStream``: ``operators.kmeans.assign`` (nearest center, ML1a) and
``operators.gmm.e_step`` (mixture responsibilities, ML9a), both with a fitted model's
literal parameters.
"""
