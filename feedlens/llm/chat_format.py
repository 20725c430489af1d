"""Chat formatting in token-budgeted windows, with DataFrame functions only.

A conversation is cut into windows of whole turns.  Prefix sums of the turns' tokens choose
the spans: turns whose prefix sum ends in the same stride share a window.  A large turn (over
half of what a window has for new turns) is a window of its own, and the prefix sums start
again behind it, so the strides of the other turns do not depend on it.  Each window
retains the leading system turn, repeats limited history from the window before it, and
carries a loss mask over its new assistant turns; what is repeated is marked and masked.

The template marks turns with control strings and escapes texts and roles, so no text can
contain a control string:

    <|im_start|>role<|im_sep|>text<|im_end|>     a new turn
    <|im_repeat|>role<|im_sep|>text<|im_end|>    a repeated turn

Escaping puts a backslash after every ``<``, ``[`` and backslash; as every one of them is then
followed by a backslash, dropping that backslash restores the text.  Control strings of
other templates (``</s>``, ``[INST]``, ``<|...|>``, ``<<SYS>>``) are broken up as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEW, REPEAT, SEP, END = "<|im_start|>", "<|im_repeat|>", "<|im_sep|>", "<|im_end|>"
END_LINE = END + "\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def turn_tokens(role: Column, text: Column) -> Column:
    """Tokens a turn is budgeted for: a quarter of its UTF-8 bytes, rounded up, and 4 for its marks."""
    return (F.ceil((F.octet_length(text) + F.octet_length(role)) / F.lit(4)) + F.lit(4)).cast("bigint")


def format_chat(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = 1024, history: int = 256) -> DataFrame:
    """One row per window: conv_id, window (from 1), n_tokens, formatted, loss_spans.

    ``loss_spans`` are (start, length) in code points of ``formatted``: the escaped texts
    of the new assistant turns.  Turns are ordered by (turn, role, text), nulls first, so
    repeated rows and equal turn numbers have a fixed order.  Null text or role: empty.
    The first turn, if its role is ``system``, is retained in all windows.  A window holds
    at most ``budget`` tokens unless one turn with the system turn is larger by itself; no
    turn is cut.  History is the tail of the previous window, whole turns, as far as
    ``history`` and the budget allow.  A null conv_id is one conversation.  Columns other
    than the four named play no part.  An empty table gives no rows.
    """
    conv = Window.partitionBy("conv_id")
    order = ["turn", "role", "text"]
    base = turns.select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    seen = base.withColumn("i", F.row_number().over(conv.orderBy(*order))).withColumn("tokens", turn_tokens(F.col("role"), F.col("text")))
    seen = seen.withColumn("system", (F.col("i") == 1) & (F.col("role") == "system"))
    body = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    seen = seen.withColumn("ends", F.sum(body).over(conv.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)))
    seen = seen.withColumn("kept", F.max(F.when(F.col("system"), F.col("tokens")).otherwise(0)).over(conv))
    room = F.greatest(F.lit(budget - history) - F.col("kept"), F.lit(1))  # for the new turns of a window
    seen = seen.withColumn("large", body * 2 > room)
    large_before = F.coalesce(F.sum(F.col("large").cast("int")).over(conv.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    seen = seen.withColumn("stretch", 2 * large_before + F.col("large").cast("int")).withColumn("largest", F.max(F.when(~F.col("large"), body)).over(conv))
    # a span is at most a stride and the part of its first turn that lies before it
    stride = F.greatest(room - F.coalesce("largest", F.lit(0)), F.lit(1))
    within = F.sum(body).over(Window.partitionBy("conv_id", "stretch").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    cell = F.floor(F.greatest(within - 1, F.lit(0)) / stride)
    seen = seen.withColumn("cell", F.when(F.col("system") | F.col("large"), F.lit(0)).otherwise(cell)).withColumn("window", F.dense_rank().over(conv.orderBy("stretch", "cell")))
    following = conv.orderBy("window").rangeBetween(1, 1)
    seen = seen.withColumn("windows", F.max("window").over(conv)).withColumn("next_start", F.min(F.col("ends") - body).over(following)).withColumn("next_tokens", F.sum(body).over(following))
    spare = F.least(F.lit(history), F.lit(budget) - F.col("kept") - F.col("next_tokens"))
    again = ~F.col("system") & (F.col("next_start") - (F.col("ends") - F.col("tokens")) <= spare)
    copy = lambda window, new: F.struct(window.alias("window"), new.alias("new"))
    copies = (
        F.when(F.col("system"), F.transform(F.sequence(F.lit(1), F.col("windows")), lambda w: copy(w, w == 1)))
        .when(again, F.array(copy(F.col("window"), F.lit(True)), copy(F.col("window") + 1, F.lit(False))))
        .otherwise(F.array(copy(F.col("window"), F.lit(True))))
    )
    dealt = seen.select("conv_id", "i", "role", "text", "tokens", F.inline(copies))
    head = F.concat(F.when(F.col("new"), NEW).otherwise(REPEAT), escape(F.col("role")), F.lit(SEP))
    pieces = dealt.select("conv_id", "window", "i", "tokens", (F.col("new") & (F.col("role") == "assistant")).alias("loss"), head.alias("head"), escape(F.col("text")).alias("said"))
    size = F.char_length("head") + F.char_length("said") + F.lit(len(END_LINE))
    before = F.coalesce(F.sum(size).over(Window.partitionBy("conv_id", "window").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.withColumn("start", before + F.char_length("head")).withColumn("piece", F.concat("head", "said", F.lit(END_LINE)))
    span = F.when(F.col("loss"), F.struct(F.col("start").cast("bigint").alias("start"), F.char_length("said").cast("bigint").alias("length")))
    return pieces.groupBy("conv_id", "window").agg(
        F.sum("tokens").alias("n_tokens"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "piece"))), lambda p: p["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
    )


def read_chat(windows: DataFrame) -> DataFrame:
    """(conv_id, window, formatted_chars, turns, loss_texts) read back from formatted windows alone.

    ``turns`` holds (role, text) of the new turns in order, ``loss_texts`` the unescaped texts under the mask.
    """
    parts = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p.startswith(NEW))
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(NEW) + 1)), SEP, 1)).alias("role"),
            unescape(F.substring_index(p, SEP, -1)).alias("text"),
        ),
    )
    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.select("conv_id", "window", F.char_length("formatted").cast("bigint").alias("formatted_chars"), turns.alias("turns"), masked.alias("loss_texts"))


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows."""
    per = read.select(
        "conv_id",
        "window",
        "formatted_chars",
        F.size("turns").cast("bigint").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("loss_texts", "").alias("loss"),
    )
    joined = lambda c: F.array_join(F.transform("parts", lambda p: p[c]), "")
    whole = per.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
        F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("parts"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("bigint").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )


#: DuckDB SQL of the registered query: the same windows and digests from the definition
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS "text" FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), a AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, "text") AS i,
    CAST(ceil((strlen("text") + strlen(role)) / 4.0) AS BIGINT) + 4 AS tokens FROM c
), b AS (
  SELECT *, i = 1 AND role = 'system' AS sys, CASE WHEN i = 1 AND role = 'system' THEN 0 ELSE tokens END AS body FROM a
), d AS (
  SELECT *, sum(body) OVER (PARTITION BY conv_id ORDER BY i) AS ends, greatest(1024 - 256 - max(CASE WHEN sys THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id), 1) AS room,
    max(CASE WHEN sys THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS kept FROM b
), l AS (
  SELECT *, body * 2 > room AS large, 2 * count(*) FILTER (body * 2 > room) OVER (PARTITION BY conv_id ORDER BY i) - CASE WHEN body * 2 > room THEN 1 ELSE 0 END AS stretch,
    coalesce(max(body) FILTER (body * 2 <= room) OVER (PARTITION BY conv_id), 0) AS largest FROM d
), e AS (
  SELECT *, CASE WHEN sys OR large THEN 0 ELSE CAST(greatest(sum(body) OVER (PARTITION BY conv_id, stretch ORDER BY i) - 1, 0) AS BIGINT) // CAST(greatest(room - largest, 1) AS BIGINT) END AS cell FROM l
), f AS (
  SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY stretch, cell) AS w FROM e
), g AS (
  SELECT conv_id, w, min(ends - body) AS start, sum(body) AS total FROM f GROUP BY conv_id, w
), h AS (
  SELECT f.*, n.start AS next_start, n.total AS next_total, max(f.w) OVER (PARTITION BY f.conv_id) AS windows,
    length(role) + length(regexp_replace(role, '[^<\[\\]', '', 'g')) + length("text") + length(regexp_replace("text", '[^<\[\\]', '', 'g'))
      + length('<|im_sep|>') + length('<|im_end|>') + 1 AS chars
  FROM f LEFT JOIN g n ON n.conv_id IS NOT DISTINCT FROM f.conv_id AND n.w = f.w + 1
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || "text" || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length("text")) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg("text", '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + length('<|im_start|>') + CASE WHEN sys THEN (windows - 1) * (chars + length('<|im_repeat|>'))
    WHEN next_start - (ends - tokens) <= least(256, 1024 - kept - next_total) THEN chars + length('<|im_repeat|>') ELSE 0 END) AS BIGINT) AS formatted_chars,
  max(windows) AS n_windows
FROM h GROUP BY conv_id
"""
