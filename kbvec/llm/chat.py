"""Chat formatting by a declarative template and a finite-state machine over roles.

The template names the states a conversation may be in, the roles that lead from one to the next, the header and
footer of a turn, and the roles whose text carries loss. From it come the check of the turn order and the text
segments, each with its loss flag. Control characters inside texts and roles are replaced by escapes, so a marker can
only come from the template, and ``read_back`` restores every turn exactly.

All of it is DataFrame functions. A formatted conversation is one row, so a task holds one conversation at a time;
the shuffle is by conversation.

Defined cases: null text and null role count as empty; turns are ordered by turn (nulls first), then role and text,
so ties and repeated rows have one order; rows without conversation id form one conversation with a null id; turn
orders that the machine refuses are formatted like the others and marked ``valid = false`` with the first refused
position; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The escape comes first when escaping and last when restoring; no replacement holds an escaped character.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


@dataclass(frozen=True)
class Template:
    """header and footer surround a text; ``steps`` maps state and role to the next state."""

    head: str = "### "
    after_role: str = ": "
    footer: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    ends: tuple[str, ...] = ("answered",)
    steps: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked"})


DEFAULT = Template()


def escape(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


def _walk(turns: Column, template: Template) -> Column:
    """End state, and the first position whose role the machine refuses (null if none)."""
    table = F.create_map(*[F.lit(x) for (state, role), to in template.steps.items() for x in (f"{state} {role}", to)])
    start = F.struct(F.lit(template.start).alias("state"), F.lit(None).cast("int").alias("refused"),
                     F.lit(0).alias("at"))

    def step(s, t):
        to = F.when(s["refused"].isNull(), F.try_element_at(table, F.concat_ws(" ", s["state"], t["role"])))
        refused = F.coalesce(s["refused"], F.when(to.isNull(), s["at"]))
        return F.struct(F.coalesce(to, s["state"]).alias("state"), refused.alias("refused"), (s["at"] + 1).alias("at"))

    return F.aggregate(turns, start, step)


def format_chats(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, segments (text, loss), formatted text, whether the order is valid, and where it is first refused."""
    rows = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(t):
        header = F.concat(F.lit(template.head), escape(t["role"]), F.lit(template.after_role))
        return F.array(F.struct(header.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
                       F.struct(F.lit(template.footer).alias("text"), F.lit(False).alias("loss")))

    made = whole.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"),
                        _walk(F.col("turns"), template).alias("end"))
    return made.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("end.refused").isNull() & F.col("end.state").isin(*template.ends)).alias("valid"),
        F.col("end.refused").alias("refused_at"))


def read_back(chats: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """The turns (role, text) and the text under the loss mask, restored from the formatted output alone."""
    cut = F.split("formatted", F.lit(template.footer.replace("\n", "\\n")))
    blocks = F.slice(cut, F.lit(1), F.size(cut) - 1)

    def turn(block):
        role = F.substring_index(block, template.after_role, 1)
        text = F.substr(block, F.char_length(role) + len(template.after_role) + 1)
        return F.struct(unescape(F.substr(role, F.lit(len(template.head) + 1))).alias("role"),
                        unescape(text).alias("text"))

    losses = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return chats.withColumn("turns", F.transform(blocks, turn)).withColumn("loss_text", F.array_join(losses, ""))


def digest(chats: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row for each conversation with the digests of what ``read_back`` restores."""
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chats, template).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(plain, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid", "refused_at")
