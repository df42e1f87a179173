"""Components of a link table without hub tasks."""

from ..operators.graph import roots as components

__all__ = ["components"]
