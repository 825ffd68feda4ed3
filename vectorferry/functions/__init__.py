"""Column functions: each takes and returns ``Column``, none needs a shuffle."""

from vectorferry.functions import arrays, hashing, payload, sparse, text, vectors

__all__ = ["arrays", "hashing", "payload", "sparse", "text", "vectors"]
