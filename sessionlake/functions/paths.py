"""Path-derived columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_project_path(enc: Column) -> Column:
    """``-home-dev-app`` → ``/home/dev/app``; without a leading dash every dash
    becomes a slash. Lossy by design: dashes inside names come back as slashes,
    which is why the real ``cwd`` of the file is back-filled later."""
    slashed = F.regexp_replace(enc, "-", "/")
    return F.when(enc.startswith("-"), F.concat(F.lit("/"), F.substring(slashed, 2, 1 << 30))).otherwise(slashed)


def url_decode(s: Column) -> Column:
    """Percent-decoding where ``+`` stays a plus and a ``%`` that begins no
    escape stays as it is."""
    kept = F.regexp_replace(F.regexp_replace(s, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.coalesce(F.try_url_decode(kept), s)


# Which assistant and table a session-tree file belongs to, in
# detection precedence (desktop, claude, copilot, cursor, codex, grok, gemini).
PATH_RULES = [
    ("claude-desktop", "conversations", r"/local-agent-mode-sessions/.*/\.claude/projects/[^/]+/([^/]+/subagents/)?[^/]+\.jsonl$"),
    ("claude", "conversations", r"/projects/[^/]+/([^/]+/subagents/)?[^/]+\.jsonl$"),
    ("claude", "history", r"/history\.jsonl$"),
    ("claude", "todos", r"/todos/[^/]+-agent-[^/]+\.json$"),
    ("claude", "plans", r"/plans/[^/]+\.md$"),
    ("claude", "stats", r"/stats-cache\.json$"),
    ("copilot", "conversations", r"/session-state/([^/]+/events|[^/]+)\.jsonl$"),
    ("copilot", "plans", r"/session-state/[^/]+/plan\.md$"),
    ("copilot", "todos", r"/session-state/[^/]+/checkpoints/[^/]+\.md$"),
    ("copilot", "history", r"/command-history-state\.json$"),
    ("copilot", "metadata", r"/session-state/([^/]+/)?workspace\.yaml$"),
    ("cursor", "conversations", r"/state\.vscdb$"),
    ("codex", "conversations", r"/sessions/(.+/)?rollout-[^/]*\.jsonl$"),
    ("grok", "conversations", r"/sessions/[^/]+/[^/]+/chat_history\.jsonl$"),
    ("grok", "plans", r"/sessions/[^/]+/[^/]+/plan\.md$"),
    ("grok", "metadata", r"/sessions/[^/]+/[^/]+/((subagents/[^/]+/)?meta|summary|signals)\.json$|/sessions/[^/]+/[^/]+/updates\.jsonl$"),
    ("gemini", "conversations", r"/tmp/[^/]+/chats/session-[^/]*\.json$"),
    ("gemini", "metadata", r"/projects\.json$"),
]
