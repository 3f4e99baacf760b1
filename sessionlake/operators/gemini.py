"""Gemini CLI chat sessions (``tmp/<project>/chats/session-*.json``, one JSON
document per session) → conversations.

Each message is a row at ``line_number = message position``; each of its tool
calls is one more ``tool_call`` row at the same position. ``projects.json``
maps absolute project paths to the directory aliases under ``tmp/``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import json as J
from sessionlake.operators.json_split import split_array
from sessionlake.schemas import CONVERSATIONS, align

_PATH = r"/tmp/([^/]+)/chats/(session-[^/]*\.json)$"
# Message type → (message_type, message_role)
TYPE_MAP = {"user": ("user", "user"), "gemini": ("assistant", "assistant"), "info": ("info", None), "error": ("error", None)}


def alias_map(projects: DataFrame) -> DataFrame:
    """``projects.json`` → ``(root, alias, abs_path)``; aliases belong to the
    root whose file lists them, non-string ones are skipped and, for an alias
    listed twice, the last path in key order wins."""
    m = F.try_variant_get(J.parse("content"), "$.projects", "map<string,variant>")
    return (projects.select(F.regexp_replace("file_path", r"/projects\.json$", "").alias("root"), F.explode(m).alias("abs_path", "a"))
            .select("root", J.as_string(F.col("a")).alias("alias"), "abs_path").where(F.col("alias").isNotNull())
            .groupBy("root", "alias").agg(F.max("abs_path").alias("abs_path")))


def _msg_ok(m: Column) -> Column:
    calls = F.try_variant_get(m, "$.toolCalls", "array<variant>")
    call_ok = lambda tc: J.is_object(tc) & J.all_ok(*[J.opt_string_ok(J.field(tc, f"$.{k}")) for k in ("id", "name", "status", "timestamp")])
    return J.is_object(m) & J.all_ok(
        *[J.opt_string_ok(J.field(m, f"$.{k}")) for k in ("id", "timestamp", "type", "content", "model")],
        J.opt_object_ok(J.field(m, "$.tokens")),
        *[J.opt_int_ok(J.field(m, f"$.tokens.{k}")) for k in ("input", "output", "cached")],
        J.opt_array_ok(J.field(m, "$.toolCalls")), F.coalesce(F.forall(calls, call_ok), F.lit(True)))


def _head(v: Column) -> list[Column]:
    """Checks of a document besides its messages."""
    return [v.isNotNull(), J.is_object(v), *[J.opt_string_ok(J.field(v, f"$.{k}")) for k in ("sessionId", "startTime", "kind")]]


def _placed(docs: DataFrame, projects: DataFrame | None) -> DataFrame:
    """Documents with what their path tells."""
    c = F.col
    docs = docs.select("*", F.regexp_extract("file_path", _PATH, 1).alias("project_dir"), F.regexp_extract("file_path", _PATH, 2).alias("file_name"),
                       F.regexp_replace("file_path", _PATH, "").alias("file_root"))
    if projects is None:
        return docs.withColumn("abs_path", F.lit(None).cast("string"))
    return docs.join(alias_map(projects), (c("project_dir") == c("alias")) & (c("file_root") == c("root")), "left")


def normalise(files: DataFrame, projects: DataFrame | None = None) -> DataFrame:
    """Whole documents, one a row."""
    c = F.col
    docs = J.parse_lines(files.withColumnRenamed("content", "value"), "file_path")
    msgs = F.try_variant_get(c("v"), "$.messages", "array<variant>")
    valid = J.all_ok(*_head(c("v")), msgs.isNotNull(), F.forall(msgs, _msg_ok))
    docs = _placed(docs.select("file_path", "v", valid.alias("ok"), F.lit(False).alias("large")), projects)
    return _rows(docs, lambda good: good.select("*", F.posexplode(msgs).alias("pos", "m")))


#: Characters of one message that a VARIANT certainly takes.
LARGEST_MESSAGE = 16_000_000


def normalise_pieces(pieces: DataFrame, projects: DataFrame | None = None, largest: int = LARGEST_MESSAGE) -> DataFrame:
    """Documents of any size, as a stream of the pieces between their commas
    (:mod:`sessionlake.operators.json_split`): only one message at a time is a
    row. A file with a message beyond ``largest`` says so in its error row."""
    c = F.col
    elements, rest = split_array(pieces, "messages")
    msgs = J.parse_lines(elements.select("file_path", "pos", F.when(F.length("value") <= largest, c("value")).alias("value"),
                                         (F.length("value") > largest).alias("large")), "file_path", "pos", "large").withColumnRenamed("v", "m")
    facts = msgs.groupBy("file_path").agg(F.min(F.coalesce(c("m").isNotNull() & _msg_ok(c("m")), F.lit(False))).alias("msgs_ok"),
                                          F.max("large").alias("large"))
    none = J.present(J.field(c("v"), "$.messages"))  # a messages member that is no array stays in the rest
    docs = (J.parse_lines(rest, "file_path", "whole").join(facts, "file_path", "left")
            .join(pieces.groupBy("file_path").agg(F.max(c("value").rlike(r'(?s)"messages"\s*:\s*\[')).alias("has")), "file_path"))
    valid = J.all_ok(c("whole"), c("has"), ~none, *_head(c("v")), F.coalesce(c("msgs_ok"), F.lit(True)))
    docs = _placed(docs.select("file_path", "v", valid.alias("ok"), F.coalesce("large", F.lit(False)).alias("large")), projects)
    return _rows(docs, lambda good: good.join(msgs.select("file_path", "pos", "m"), "file_path"))


def _rows(docs: DataFrame, with_messages) -> DataFrame:
    c = F.col
    project = F.coalesce(c("abs_path"), F.lit(""))
    cwd = F.nullif(project, F.lit(""))

    bad = docs.where(~c("ok")).select(
        F.lit("gemini").alias("source"), c("project_dir").alias("session_id"), F.lit("").alias("project_path"),
        "project_dir", "file_name", F.lit(1).cast("bigint").alias("line_number"), F.lit("_parse_error").alias("message_type"),
        F.when(c("large"), F.lit("Parse error: a message is too large")).otherwise(F.lit("Parse error: invalid session file")).alias("message_content"))

    v = c("v")
    good = with_messages(docs.where(c("ok"))).select(
        "project_dir", "file_name", project.alias("project_path"), cwd.alias("cwd"),
        F.coalesce(J.get_string(v, "$.sessionId"), c("project_dir")).alias("session_id"),
        F.coalesce(J.get_string(v, "$.kind") == "subagent", F.lit(False)).alias("is_agent"),
        J.get_string(v, "$.startTime").alias("start_time"), "pos", "m")
    m = c("m")
    mtype = J.get_string(m, "$.type")
    mts = J.get_string(m, "$.timestamp")
    mid = J.get_string(m, "$.id")
    model = J.get_string(m, "$.model")
    row_t = "struct<message_type:string,message_role:string,uuid:string,parent_uuid:string,timestamp:string," \
            "message_content:string,tool_name:string,tool_use_id:string,tool_input:string,input_tokens:bigint," \
            "output_tokens:bigint,cache_read_tokens:bigint>"

    def type_of(i: int) -> Column:
        out = F.lit("unknown" if i == 0 else None)
        for k, val in TYPE_MAP.items():
            out = F.when(mtype == k, F.lit(val[i])).otherwise(out)
        return out

    msg_row = F.struct(
        type_of(0), type_of(1), mid, F.lit(None).cast("string"), F.coalesce(mts, c("start_time")),
        F.nullif(J.get_string(m, "$.content"), F.lit("")), F.lit(None).cast("string"), F.lit(None).cast("string"),
        F.lit(None).cast("string"), J.get_long(m, "$.tokens.input"), J.get_long(m, "$.tokens.output"),
        J.get_long(m, "$.tokens.cached")).cast(row_t)
    calls = F.try_variant_get(m, "$.toolCalls", "array<variant>")
    tool_rows = F.transform(F.coalesce(calls, F.array().cast("array<variant>")), lambda tc: F.struct(
        F.lit("tool_call"), F.lit("tool"), J.get_string(tc, "$.id"), mid,
        F.coalesce(J.get_string(tc, "$.timestamp"), mts), J.get_string(tc, "$.status"), J.get_string(tc, "$.name"),
        J.get_string(tc, "$.id"), J.json_text(J.field(tc, "$.args")), F.lit(None).cast("bigint"),
        F.lit(None).cast("bigint"), F.lit(None).cast("bigint")).cast(row_t))
    rows = good.select(
        F.lit("gemini").alias("source"), "session_id", "project_path", "project_dir", "file_name", "is_agent",
        (c("pos") + 1).cast("bigint").alias("line_number"), model.alias("model"), "cwd",
        F.explode(F.concat(F.array(msg_row), tool_rows)).alias("r")).select("*", "r.*").drop("r")
    return align(rows.unionByName(bad, allowMissingColumns=True), CONVERSATIONS)
