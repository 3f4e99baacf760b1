"""Display labels computed as columns (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def project_short(path: Column) -> Column:
    """Last path component; the path itself when it has no slash; ``—`` when NULL."""
    return F.when(path.isNull(), F.lit("—")).when(path.contains("/"), F.split_part(path, F.lit("/"), F.lit(-1))) \
        .otherwise(path)


def project_two_parts(path: Column) -> Column:
    """Last two path components (``a/b``), used when short names collide."""
    parts = F.split(path, "/")
    n = F.size(parts)
    return F.when(n >= 2, F.concat_ws("/", F.element_at(parts, n - 1), F.element_at(parts, n))).otherwise(path)


def delta_label(ms: Column) -> Column:
    """``+12ms`` / ``+1.2s`` / ``+1m 05s``; empty for NULL or non-positive."""
    m = F.floor(ms / 60000).cast("bigint")
    s = F.floor((ms % 60000) / 1000).cast("bigint")
    return (F.when(ms.isNull() | (ms <= 0), F.lit(""))
            .when(ms < 1000, F.concat(F.lit("+"), ms.cast("bigint").cast("string"), F.lit("ms")))
            .when(ms < 60000, F.concat(F.lit("+"), tenths_label(ms), F.lit("s")))
            .otherwise(F.format_string("+%dm %02ds", m, s)))


def duration_label(ms: Column) -> Column:
    """``4.2s`` / ``3m 07s`` / ``2h 5m``; empty for NULL or non-positive."""
    m = F.floor(ms / 60000).cast("bigint")
    s = F.floor((ms % 60000) / 1000).cast("bigint")
    h = F.floor(ms / 3600000).cast("bigint")
    hm = F.floor((ms % 3600000) / 60000).cast("bigint")
    return (F.when(ms.isNull() | (ms <= 0), F.lit(""))
            .when(ms < 60000, F.concat(tenths_label(ms), F.lit("s")))
            .when(ms < 3600000, F.format_string("%dm %02ds", m, s))
            .otherwise(F.format_string("%dh %dm", h, hm)))


# Summary texts of the event list.
CALLS, STARTED, TURN_START, TURN_END = "calls ", "Session started", "Turn started", "Turn ended"
TOOL_MARK, DONE_MARK = "⚡ ", "✓ "


def tenths_label(ms: Column) -> Column:
    """``ms / 1000`` with one decimal, as binary floats print: a tie goes where
    the nearest float lies, an exact tie to the even digit. For 0 < ms < 60000."""
    whole, rest = F.call_function("div", ms.cast("bigint"), F.lit(100).cast("bigint")), ms.cast("bigint") % 100
    # The float scaled by 2**57 is a whole number, so it can be compared with the exact quotient.
    scaled = ((ms / 1000.0) * F.lit(float(1 << 57))).cast("bigint").cast("decimal(20,0)") * F.lit(1000).cast("decimal(4,0)")
    exact = ms.cast("decimal(5,0)") * F.lit(str(1 << 57)).cast("decimal(18,0)")
    up = F.when(rest != 50, rest > 50).when(scaled != exact, scaled > exact).otherwise(whole % 2 == 1)
    t = whole + up.cast("bigint")
    return F.concat(F.call_function("div", t, F.lit(10).cast("bigint")).cast("string"), F.lit("."), (t % 10).cast("string"))


def event_summary(max_len: int = 300) -> Column:
    """One-line summary of an event by its type, cut at ``max_len`` with ``…``."""
    c = F.col
    content = F.regexp_replace(F.replace(F.coalesce(c("message_content"), F.lit("")), F.lit("\n"), F.lit(" ")), r"^\s+|\s+$", "")
    tool = F.coalesce(c("tool_name"), F.lit(""))
    keys = F.json_object_keys(c("tool_input"))
    args = F.when(c("tool_input").isNull() | (c("tool_input") == ""), F.lit("")) \
        .when(keys.isNull(), F.lit("…")) \
        .otherwise(F.array_join(F.transform(F.slice(keys, 1, 2), lambda k: F.concat(k, F.lit("=…"))), ", "))
    t = c("message_type")
    nz = lambda x, alt: F.when(x != "", x).otherwise(F.lit(alt))
    text = (F.when(t == "user", nz(content, "(empty)"))
            .when(t == "assistant", F.when(tool != "", F.concat(F.lit(CALLS), tool)).otherwise(nz(content, "(no content)")))
            .when(t == "tool_start", F.concat(F.lit(TOOL_MARK), tool, F.lit("("), args, F.lit(")")))
            .when(t == "tool_result", F.concat(F.lit(DONE_MARK), tool, F.lit(" completed")))
            .when(t == "session_start", F.when(c("version").isNotNull(), F.concat(F.lit(STARTED + " — v"), c("version")))
                  .otherwise(F.lit(STARTED)))
            .when(t == "session_info", nz(content, "Session info"))
            .when(t == "session_error", nz(content, "Error"))
            .when(t == "turn_start", F.lit(TURN_START))
            .when(t == "turn_end", F.lit(TURN_END))
            .when(t == "truncation", F.when(c("input_tokens").isNotNull(),
                                            F.concat(F.lit("Truncation: "), c("input_tokens").cast("string"), F.lit(" tokens")))
                  .otherwise(F.lit("Truncation")))
            .when(t == "reasoning", nz(content, "Reasoning"))
            .otherwise(F.when(content != "", content).otherwise(F.coalesce(t, F.lit("")))))
    return F.when(F.length(text) > max_len, F.concat(F.substring(text, 1, max_len), F.lit("…"))).otherwise(text)
