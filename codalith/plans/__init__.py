"""The registry of queries: catalog holds it, the others add to it."""

from codalith.plans import catalog, evaluations, learning, scorings

__all__ = ["catalog", "evaluations", "learning", "scorings"]
