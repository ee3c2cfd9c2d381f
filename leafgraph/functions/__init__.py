"""Column functions: positions in texts, and edits of components, lists, task lists and tables."""

from leafgraph.functions import components, edits, models, positions

__all__ = ["components", "edits", "models", "positions"]
