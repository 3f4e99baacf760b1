"""Cursor chat state (the ``cursorDiskKV`` key/value table of
``state.vscdb``) → conversations.

``composerData:<composer>`` holds the ordered bubble headers of a chat;
``bubbleId:<composer>:<bubble>`` holds one message. Every header with a bubble
id is a row at ``line_number = header position`` (id-less headers are skipped
but still counted), joined to its bubble when one exists; ``parent_uuid`` is
the previous emitted bubble id. It comes from shifting the composer's array of
emitted ids by one, so the work grows with the headers and no window or extra
shuffle is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import json as J
from sessionlake.functions.time import epoch_ms_to_iso
from sessionlake.schemas import CONVERSATIONS, align


def keys(kv: DataFrame) -> DataFrame:
    """``key`` with its ``kind`` (composer, bubble; null for others), ``composer``
    and ``bubble``; decided on the key text alone, before anything is parsed."""
    c = F.col
    parts = F.split(c("key"), ":", 3)
    head, rest = "composerData:", F.substring(c("key"), len("composerData:") + 1, 1 << 30)
    is_bubble = c("key").startswith("bubbleId:") & (F.size(parts) == 3)
    kind = F.when(c("key").startswith(head), "composer").when(is_bubble, "bubble")
    return kv.select("key", kind.alias("kind"), F.when(c("key").startswith(head), rest).when(is_bubble, F.get(parts, 1)).alias("composer"),
                     F.when(is_bubble, F.get(parts, 2)).alias("bubble"), *[x for x in kv.columns if x != "key"])


def normalise(kv: DataFrame, file_name: str = "state.vscdb") -> DataFrame:
    c = F.col
    known = keys(kv.select("key", F.col("value").cast("string").alias("value")))
    v = c("v")
    parsed = lambda kind: J.parse_lines(known.where(c("kind") == kind), "composer", "bubble")
    headers = F.try_variant_get(v, "$.fullConversationHeadersOnly", "array<variant>")
    comp_ok = J.all_ok(
        v.isNotNull(), J.is_object(v), J.opt_string_ok(J.field(v, "$.composerId")), J.opt_int_ok(J.field(v, "$.createdAt")),
        J.opt_array_ok(J.field(v, "$.fullConversationHeadersOnly")),
        F.coalesce(F.forall(headers, lambda h: J.is_object(h) & J.opt_string_ok(J.field(h, "$.bubbleId"))
                            & J.opt_int_ok(J.field(h, "$.type"))), F.lit(True)),
        J.opt_object_ok(J.field(v, "$.modelConfig")), J.opt_string_ok(J.field(v, "$.modelConfig.modelName")))
    # headers with an id, in order and with their positions; the one before in this array is the predecessor
    emitted = F.filter(F.transform(F.coalesce(headers, F.array().cast("array<variant>")), lambda h, i: F.struct(
        i.alias("pos"), J.get_string(h, "$.bubbleId").alias("bubble"), J.get_long(h, "$.type").alias("btype"))), lambda x: x["bubble"].isNotNull())
    composers = parsed("composer").where(comp_ok).select(
        "composer", J.get_string(v, "$.modelConfig.modelName").alias("model"),
        # materialised once, not once an element
        F.when(F.spark_partition_id() >= 0, emitted).alias("hs"))
    rows = composers.select("composer", "model", F.explode(F.arrays_zip(
        c("hs").alias("h"), F.concat(F.array(F.lit(None).cast("string")), c("hs.bubble")).alias("prev"))).alias("x")) \
        .where(c("x.h").isNotNull()).select("composer", "model", "x.h.*", "x.prev")

    b_ok = J.all_ok(
        v.isNotNull(), J.is_object(v), J.opt_string_ok(J.field(v, "$.text")), J.opt_int_ok(J.field(v, "$.createdAt")),
        ~J.present(J.field(v, "$.isAgentic")) | (J.kind(J.field(v, "$.isAgentic")) == "BOOLEAN"),
        J.opt_object_ok(J.field(v, "$.tokenCount")), J.opt_int_ok(J.field(v, "$.tokenCount.inputTokens")),
        J.opt_int_ok(J.field(v, "$.tokenCount.outputTokens")), J.opt_object_ok(J.field(v, "$.timingInfo")),
        J.opt_int_ok(J.field(v, "$.timingInfo.clientStartTime")), J.opt_object_ok(J.field(v, "$.toolFormerData")),
        *[J.opt_string_ok(J.field(v, f"$.toolFormerData.{k}")) for k in ("tool", "name", "toolCallId")])
    tool = J.field(v, "$.toolFormerData")
    args = F.coalesce(J.json_text(J.field(tool, "$.rawArgs")), J.json_text(J.field(tool, "$.params")))
    bubbles = parsed("bubble").where(b_ok).select(
        "composer", "bubble",
        J.get_string(v, "$.text").alias("message_content"),
        F.coalesce(J.get_long(v, "$.createdAt"), J.get_long(v, "$.timingInfo.clientStartTime")).alias("ms"),
        F.try_variant_get(v, "$.isAgentic", "boolean").alias("agentic"),
        F.coalesce(J.get_string(tool, "$.name"), J.get_string(tool, "$.tool")).alias("tool_name"),
        J.get_string(tool, "$.toolCallId").alias("tool_use_id"), args.alias("tool_input"),
        J.get_long(v, "$.tokenCount.inputTokens").alias("input_tokens"),
        J.get_long(v, "$.tokenCount.outputTokens").alias("output_tokens"))
    out = rows.join(bubbles, ["composer", "bubble"], "left").select(
        F.lit("cursor").alias("source"), c("composer").alias("session_id"), F.lit(file_name).alias("file_name"),
        F.coalesce(c("agentic"), F.lit(False)).alias("is_agent"), (c("pos") + 1).cast("bigint").alias("line_number"),
        F.when(c("btype") == 1, F.lit("user")).when(c("btype") == 2, F.lit("assistant")).otherwise(F.lit("unknown")).alias("message_type"),
        F.when(c("btype") == 1, F.lit("user")).when(c("btype") == 2, F.lit("assistant")).alias("message_role"),
        c("bubble").alias("uuid"), c("prev").alias("parent_uuid"), epoch_ms_to_iso(c("ms")).alias("timestamp"),
        "message_content", "model", "tool_name", "tool_use_id", "tool_input", "input_tokens", "output_tokens")
    return align(out, CONVERSATIONS)
