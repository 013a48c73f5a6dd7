"""Chat formatting: a finite-state machine over roles, and a declarative template.

A conversation's rows, ordered by turn (ties by role, then text; null turns
first), become text segments ``(text, loss)``. Each turn gives an opening, its
text and a closing segment; only the text of ``loss`` roles is under the loss
mask. Control strings inside texts and roles get a backslash after their first
character, and backslashes are doubled, so texts can't fake a turn and the
output reads back exactly.

``valid`` tells whether the roles follow the template's transitions from
``start`` to an accepting state; ``first_bad`` is the first turn that doesn't
(0-based, null if valid; the number of turns if it merely ends too early).
Invalid conversations are formatted all the same and can be filtered.

A null text or role is empty. Rows with a null conversation id form one
conversation. A conversation is one row of the output, so it must fit a task;
the shuffle carries each row once. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPLATE = {
    "open": "<|im_start|>",
    "split": "<|im_sep|>",
    "close": "<|im_end|>",
    "controls": ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"),
    "loss": ("assistant",),
    "start": "begin",
    "accept": ("answered",),
    "steps": {
        ("begin", "system"): "instructed",
        ("begin", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
}


def escape(text: Column, template=TEMPLATE) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template["controls"]:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", template=TEMPLATE) -> DataFrame:
    """One row a conversation: ``id_col``, ``segments``, ``formatted``, ``valid``, ``first_bad``."""
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    talks = rows.groupBy(F.col(f"`{id_col}`").alias("__conv")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    steps = F.create_map(*[F.lit(x) for (a, b), c in template["steps"].items() for x in (f"{a} {b}", c)])
    bad = F.lit("bad")

    def segments(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(template["open"]), escape(t["role"], template), F.lit(template["split"])).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"], template).alias("text"), t["role"].isin(*template["loss"]).alias("loss")),
            F.struct(F.lit(template["close"]).alias("text"), F.lit(False).alias("loss")))

    walk = F.aggregate(
        "turns", F.struct(F.lit(template["start"]).alias("state"), F.lit(0).alias("n")),
        lambda s, t: F.when(s["state"] == bad, s).otherwise(
            F.struct(F.coalesce(F.element_at(steps, F.concat_ws(" ", s["state"], t["role"])), bad).alias("state"),
                     (s["n"] + F.element_at(steps, F.concat_ws(" ", s["state"], t["role"])).isNotNull().cast("int")).alias("n"))))
    out = talks.select("__conv", F.flatten(F.transform("turns", segments)).alias("segments"), walk.alias("walk"))
    valid = F.col("walk.state").isin(*template["accept"])
    return out.select(
        F.col("__conv").alias(id_col), "segments", F.array_join("segments.text", "").alias("formatted"), valid.alias("valid"),
        F.when(~valid, F.col("walk.n")).alias("first_bad"))


def turns_of(text: Column, template=TEMPLATE) -> Column:
    """The turns ``(role, text)`` read back from a formatted conversation."""
    quote = "".join("\\" + c if c in r"\^$.|?*+()[]{}" else c for c in template["open"])
    cut = "".join("\\" + c if c in r"\^$.|?*+()[]{}" else c for c in template["split"])
    parts = F.slice(F.split(text, quote), F.lit(2), F.greatest(F.size(F.split(text, quote)) - 1, F.lit(0)))
    split = F.transform(parts, lambda p: F.split(p, cut))
    end = len(template["close"])
    return F.transform(split, lambda p: F.struct(
        unescape(p[0]).alias("role"), unescape(F.substring(p[1], F.lit(1), F.length(p[1]) - end)).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
