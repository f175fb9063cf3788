"""Memory of Python workers, which Spark keeps for later tasks."""

from lodestrata.operators.batches import release  # noqa: F401
