"""Which assistant a session tree belongs to.

Only file paths are needed. Every rule that fits a path proposes a root (what
lies before the rule's part of the path) and a (source, kind). A root's assistant
is the first in precedence that its files give evidence of, so a file counts only
as what its root is; a given ``source`` overrides detection on every root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.functions.paths import PATH_RULES
from sessionlake.operators.codex import session_from_file

# The assistants in detection precedence, and which of their files
# prove one (Gemini needs its installation marker beside the chats).
PRECEDENCE = ["claude-desktop", "claude", "copilot", "cursor", "codex", "grok", "gemini"]
EVIDENCE = {
    "claude-desktop": r"/local-agent-mode-sessions/.+$",
    "claude": r"/projects/.+$",
    "copilot": r"/session-state/.+$",
    "cursor": r"/state\.vscdb$",
    "codex": r"/sessions/[0-9]+/.+$",
    "grok": r"/sessions/%[^/]*/.+$",
    "gemini": r"/tmp/.+$",
}
GEMINI_MARK = r"/installation_id$"


def classify(files: DataFrame, source: str | None = None) -> DataFrame:
    """``file_path`` with ``source, kind, root, project_dir, session_id, is_agent``;
    NULL for files that no rule of their root's assistant fits. ``source`` is
    compared without case, and an unknown one means detection."""
    c, path = F.col, F.col("file_path")
    files = files.select("file_path").distinct()
    rank = {s: i for i, s in enumerate(PRECEDENCE)}
    proposals = F.filter(F.array(*[F.when(path.rlike(rx), F.struct(
        F.lit(i).alias("rule"), F.lit(rank[s]).alias("rank"), F.lit(s).alias("source"), F.lit(k).alias("kind"),
        # the part that the rule anchors at the end goes; a desktop tree's root lies above its session folders
        F.regexp_replace(path, "/local-agent-mode-sessions/.*$" if s == "claude-desktop" else rx, "").alias("root")))
        for i, (s, k, rx) in enumerate([*PATH_RULES, ("gemini", "metadata", GEMINI_MARK)])]), lambda x: x.isNotNull())
    proposed = files.select("file_path", F.explode(proposals).alias("p")).select("file_path", "p.*")
    given = (source or "").lower()
    if given in rank:
        fit = proposed.where(c("source") == given)
    else:
        proves = F.lit(False)
        for s, rx in EVIDENCE.items():
            proves = proves | ((c("source") == s) & path.rlike(rx))
        mark = F.max((c("source") == "gemini") & path.rlike(GEMINI_MARK))
        roots = proposed.groupBy("root").agg(
            F.min(F.when(proves & (c("source") != "gemini"), c("rank"))).alias("first"),
            F.max(proves & (c("source") == "gemini")).alias("chats"), mark.alias("mark"))
        roots = roots.groupBy("root").agg(F.min(F.coalesce("first", F.when(c("chats") & c("mark"), F.lit(rank["gemini"])))).alias("rank"))
        fit = proposed.join(roots, ["root", "rank"])
    best = fit.groupBy("file_path").agg(F.min(F.struct("rank", "rule", "source", "kind", "root")).alias("b")).select("file_path", "b.*")
    out = files.join(best, "file_path", "left")
    below = F.substring(path, F.length("root") + 1, F.length(path))
    below = F.when(c("source") == "claude-desktop", F.regexp_extract(below, r"(/projects/.*)$", 1)).otherwise(below)
    part = lambda rx: F.nullif(F.regexp_extract(below, rx, 1), F.lit(""))
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    conv, claude = c("kind") == "conversations", c("source").isin("claude", "claude-desktop")
    sub = part(r"^/projects/[^/]+/([^/]+)/subagents/[^/]+$")
    return out.select(
        "file_path", "source", "kind", "root",
        F.when(conv & claude, part(r"^/projects/([^/]+)/")).when(c("source") == "gemini", part(r"^/tmp/([^/]+)/"))
        .when(c("source") == "grok", part(r"^/sessions/([^/]+)/")).alias("project_dir"),
        F.when(conv & claude, F.coalesce(sub, stem)).when(c("kind") == "todos", F.when(claude, F.substring_index(stem, "-agent-", 1))
                                                          .otherwise(part(r"^/session-state/([^/]+)/")))
        .when(c("source") == "copilot", F.coalesce(part(r"^/session-state/([^/]+)/"), part(r"^/session-state/([^/]+)\.jsonl$")))
        .when(conv & (c("source") == "codex"), session_from_file(path))
        .when(c("source") == "grok", part(r"^/sessions/[^/]+/([^/]+)/")).alias("session_id"),
        F.coalesce(conv & claude & (sub.isNotNull() | F.substring_index(path, "/", -1).startswith("agent-")), F.lit(False)).alias("is_agent"))
