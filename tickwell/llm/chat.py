"""Chat formatting from a declarative template (operator 1), in DataFrame functions only.

A template gives each role the marks around its turns and says which texts a model learns from; a table of allowed
steps between roles is the finite-state machine that checks turn order. A conversation becomes its formatted string and
segments (text, loss) that join to it. Control strings inside texts and role names are escaped, so the marks alone split
the string, and ``read_back`` restores every role and text from it.

Escaping: the escape character becomes itself and ``0``, control string number n becomes the escape character and its code
(one character, more where a template has more than 35 control strings). A template whose marks are empty, hold its escape
character or each other, or don't tell its turns apart is refused.
Every escape character of an escaped text starts such a pair, so the pairs are replaced back in the reverse order.

A conversation is one training example, one row; its turns meet in one task and nothing larger does.

Defined cases: null text is empty; a null role is the empty role; roles without marks of their own use the template's
general marks and are errors to the state machine; turns are ordered by turn (null first), then role, then text; repeated
rows are turns of their own; rows with a null conv_id form one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import islice, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Marks:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Marks]
    #: For any other role: before its name, between name and text, after the text.
    general: tuple[str, str, str]
    #: (state, role) pairs that are allowed; the state is the last role, at first "start".
    steps: frozenset[tuple[str, str]]
    accept: frozenset[str]
    escape: str = "\\"
    alphabet: str = field(default="123456789abcdefghijklmnopqrstuvwxyz", repr=False)

    def __post_init__(self) -> None:
        controls = self.controls
        if any(not c or self.escape in c for c in controls):
            raise ValueError("a template's marks can't be empty or hold its escape character")
        if any(a != b and a in b for a in controls for b in controls):
            raise ValueError("a template's mark can't hold another one")
        opens, closes = [m.open for m in self.roles.values()] + [self.general[0]], {m.close for m in self.roles.values()} | {self.general[2]}
        if len(set(opens)) < len(opens) or self.general[1] in (*opens, *closes) or closes & set(opens):
            raise ValueError("a template's marks must tell its turns apart")

    @property
    def codes(self) -> list[str]:
        """A code for each control string, all of one length and none with the 0 of the escape character itself."""
        width = 1
        while len(self.alphabet) ** width < len(self.controls):
            width += 1
        return ["".join(c) for c in islice(product(self.alphabet, repeat=width), len(self.controls))]

    @property
    def controls(self) -> list[str]:
        marks = [x for m in self.roles.values() for x in (m.open, m.close)]
        return list(dict.fromkeys([*marks, *self.general]))


INSTRUCT = Template(
    roles={"system": Marks("<<SYS>>", "<</SYS>>"), "user": Marks("[INST]", "[/INST]"), "assistant": Marks("<s>", "</s>", loss=True)},
    general=("[ROLE]", "[TEXT]", "[/TEXT]"),
    steps=frozenset({("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}),
    accept=frozenset({"assistant"}),
)


def escaped(text: Column, t: Template) -> Column:
    out = F.replace(text, F.lit(t.escape), F.lit(t.escape + "0"))
    for code, control in zip(t.codes, t.controls, strict=True):
        out = F.replace(out, F.lit(control), F.lit(t.escape + code))
    return out


def unescaped(text: Column, t: Template) -> Column:
    out = text
    for code, control in reversed(list(zip(t.codes, t.controls, strict=True))):
        out = F.replace(out, F.lit(t.escape + code), F.lit(control))
    return F.replace(out, F.lit(t.escape + "0"), F.lit(t.escape))


def _pick(role: Column, t: Template, of, other: Column) -> Column:
    out = other
    for name, marks in t.roles.items():
        out = F.when(role == name, F.lit(of(marks))).otherwise(out)
    return out


def _segments(turn: Column, t: Template) -> Column:
    role = turn["role"]
    general = F.concat(F.lit(t.general[0]), escaped(role, t), F.lit(t.general[1]))
    one = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(one(_pick(role, t, lambda m: m.open, general), F.lit(False)),
                   one(escaped(turn["text"], t), _pick(role, t, lambda m: m.loss, F.lit(False))),
                   one(_pick(role, t, lambda m: m.close, F.lit(t.general[2])), F.lit(False)))


def _walk(turns: Column, t: Template) -> Column:
    """Runs the state machine: its last state, how many turns it has read, and the first turn it can't read (from 0) or null."""
    allowed = F.lit(False)
    zero = F.struct(F.lit("start").alias("state"), F.lit(0).alias("read"), F.lit(None).cast("int").alias("bad"))

    def step(s: Column, turn: Column) -> Column:
        ok = allowed
        for state, role in sorted(t.steps):
            ok = ok | ((s["state"] == state) & (turn["role"] == role))
        bad = F.when(s["bad"].isNotNull(), s["bad"]).when(~ok, s["read"])
        return F.struct(turn["role"].alias("state"), (s["read"] + 1).alias("read"), bad.alias("bad"))

    return F.aggregate(turns, zero, step)


def format_conversations(turns: DataFrame, template: Template = INSTRUCT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation: conv_id, formatted, segments, valid, bad_turn (the first one out of order)."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    walk = _walk(F.col("turns"), template)
    segments = F.flatten(F.transform("turns", lambda t: _segments(t, template)))
    out = whole.select("conv_id", segments.alias("segments"), walk.alias("walk"))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    valid = F.col("walk.bad").isNull() & F.col("walk.state").isin(sorted(template.accept))
    return out.select("conv_id", formatted.alias("formatted"), "segments", valid.alias("valid"), F.col("walk.bad").alias("bad_turn"))


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) of a formatted conversation, from the string alone."""
    closes = [m.close for m in template.roles.values()] + [template.general[2]]
    parts = F.split(formatted, "|".join(_quoted(c) for c in closes), -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    name, middle, _ = template.general

    def turn(part: Column) -> Column:
        at = F.instr(part, middle)
        role = unescaped(F.substr(part, F.lit(len(name) + 1), F.greatest(at - len(name) - 1, F.lit(0))), template)
        text = F.substr(part, at + len(middle))
        for r, marks in template.roles.items():
            role = F.when(F.startswith(part, F.lit(marks.open)), F.lit(r)).otherwise(role)
            text = F.when(F.startswith(part, F.lit(marks.open)), F.substr(part, F.lit(len(marks.open) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text, template).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")
