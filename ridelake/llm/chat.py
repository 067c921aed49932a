"""Chat formatting with a verified grammar round trip, in DataFrame functions only.

A conversation is rendered as a sequence of turns::

    <|im_start|>role NEWLINE text<|im_end|> NEWLINE

``<|`` is reserved for control strings. A deterministic parser reads the
rendered text back; where the turns it recovers differ from the source, the
conversation is rendered again with its conflicting content escaped: a
backslash goes into every ``<|`` (``<\\|``), one more into every ``<\\|``, and a
newline in a role becomes ``<n|``. The parser always unescapes, so the escaped
form reads back to the source whatever the source holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
START, END, ASSISTANT = "<|im_start|>", "<|im_end|>", "assistant"
_START_RE = r"<\|im_start\|>"


def escape(text, role: bool = False):
    out = F.regexp_replace(text, r"<(\\*)(n?)\|", r"<\\$1$2|")
    return F.regexp_replace(out, "\n", "<n|") if role else out


def unescape(text, role: bool = False):
    out = F.regexp_replace(text, r"<n\|", "\n") if role else text
    return F.regexp_replace(out, r"<\\(\\*)(n?)\|", r"<$1$2|")


def render(turns, escaped: bool):
    """Text of an array of (role, text) turns."""
    same = lambda c, role=False: c
    put = escape if escaped else same
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), put(t["role"], True), F.lit("\n"), put(t["text"], False), F.lit(END + "\n"))), "")


def segments(formatted):
    """What stands between the start marks, and after the last."""
    parts = F.split(formatted, _START_RE, -1)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def _raw_role(segment):
    return F.substring_index(segment, "\n", 1)


def _raw_text(segment):
    head = F.length(_raw_role(segment)) + 2
    return F.substring(segment, head, F.length(segment) - head + 1 - len(END) - 1)


def parse(formatted):
    """Recovered turns: an array of (role, text); null where the text is not of the grammar.

    Each segment must end in the end mark and a newline, hold a newline after
    the role, and hold no other control string.
    """
    segs = segments(formatted)
    ok = F.forall(segs, lambda s: s.endswith(END + "\n") & (F.instr(s, "\n") > 0)
                  & (F.instr(F.concat(_raw_role(s), F.lit("\n"), _raw_text(s)), "<|") == 0))
    # without a newline after the role, the role would hold the end mark, and so a "<|"
    turns = F.transform(segs, lambda s: F.struct(unescape(_raw_role(s), True).alias("role"), unescape(_raw_text(s)).alias("text")))
    begins = (formatted == "") | formatted.startswith(START)
    return F.when(begins & ok, turns)


def loss_runs(formatted):
    """The loss mask as runs of characters, one (before, loss, after) per turn in order; they add up to the text.

    Only the text of assistant turns is under the mask.
    """
    def runs(s):
        role, n = _raw_role(s), F.length(s) + len(START)
        before = F.when(unescape(role, True) == ASSISTANT, F.length(role) + 1 + len(START)).otherwise(n)
        loss = F.when(unescape(role, True) == ASSISTANT, F.length(_raw_text(s))).otherwise(F.lit(0))
        return F.struct(before.alias("before"), loss.alias("loss"), (n - before - loss).alias("after"))
    return F.transform(segments(formatted), runs)


def loss_text(formatted, runs):
    """The characters under the mask, unescaped turn by turn."""
    return F.array_join(F.zip_with(segments(formatted), runs, lambda s, r: unescape(
        F.substring(F.concat(F.lit(START), s), r["before"] + 1, r["loss"]))), "")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_col``, ``formatted``, ``escaped`` (whether it had to be), ``loss_mask``, ``turns``.

    ``turns`` are those read back from ``formatted``. Turns stand by ``turn_col``,
    ties by role and then text, null turn numbers first; repeated rows are turns
    of their own. A null role or text is empty, a null conversation id is one
    conversation. No rows give no conversations. Other columns are ignored.

    A conversation is one row of the output and is put together in one task;
    its texts are gathered there and nowhere else.
    """
    said = turns.select(
        F.col(conv_col).alias("_conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("_said"))
    source = said.groupBy("_conv").agg(F.sort_array(F.collect_list("_said")).alias("_turns")).select(
        "_conv", F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_turns"))
    plain = source.withColumn("_plain", render(F.col("_turns"), False))
    tried = plain.withColumn("escaped", ~F.coalesce(parse(F.col("_plain")) == F.col("_turns"), F.lit(False)))
    done = tried.withColumn("formatted", F.when(F.col("escaped"), render(F.col("_turns"), True)).otherwise(F.col("_plain")))
    back = done.withColumn("turns", parse(F.col("formatted")))
    checked = F.when(back["turns"] == back["_turns"], back["turns"]).otherwise(
        F.raise_error(F.lit("a conversation does not read back as it was written")).cast(back.schema["turns"].dataType))
    return back.select(F.col("_conv").alias(conv_col), "formatted", "escaped",
                       loss_runs(F.col("formatted")).alias("loss_mask"), checked.alias("turns"))


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests of what is read back from the formatted conversations."""
    loss = formatted.withColumn("_loss", loss_text(F.col("formatted"), F.col("loss_mask")))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return loss.select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
