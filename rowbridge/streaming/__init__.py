"""The engine is batch only; there is no streaming operator.

Transformer chains are stateless column expressions, so
``rowbridge.operators.transforms.apply_chain`` also accepts a DataFrame from
``spark.readStream``.
"""
