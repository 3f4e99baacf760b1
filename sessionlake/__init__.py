"""sessionlake — Spark jobs that turn AI coding-assistant session files into
five fixed tables (conversations, plans, todos, history, stats) and a library
of DataFrame queries over them."""

from sessionlake.schemas import CONVERSATIONS, HISTORY, PLANS, STATS, TODOS, align

__all__ = ["CONVERSATIONS", "PLANS", "TODOS", "HISTORY", "STATS", "align"]
