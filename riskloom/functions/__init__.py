"""Column-expression building blocks (rules, time keys, text renderings)."""

from . import rules, text, timecols  # noqa: F401
