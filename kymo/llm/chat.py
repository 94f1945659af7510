r"""Chat formatting with DataFrame functions only.

A :class:`ChatTemplate` states, for each role, what stands before and after a
turn and whether its text counts for the loss, and which role may follow
which.  ``format_chats`` runs the ordered roles of a conversation through that
transition table: the automaton emits one symbol a turn, which names the marks
around the text, its loss flag and whether the turn was in order, and the text
segments are written from those symbols alone.  Their concatenation is the
training text; ``read_back`` recovers turns and loss flags from it.

Control strings inside texts are broken with ``\;`` and back-slashes doubled,
so that a mark never occurs inside a text and reading back is exact.

Defined cases: null text or role counts as empty; a null ``conv_id`` is one
conversation; rows of equal ``turn`` are ordered by role, then text; repeated
rows are turns of their own; a turn out of order is formatted like any other and
makes its conversation invalid from there on; an empty table gives no rows;
other columns of the input are ignored.  A conversation is one training
sequence and one output row, so it has to fit into a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Declarative template; ``other`` serves roles that ``roles`` lacks and carries their name."""

    begin: str = "<s>"
    roles: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
            "user": Turn("[INST] ", " [/INST]"),
            "assistant": Turn("[ASST] ", " </s>", loss=True),
        }
    )
    other: tuple[str, str, str] = ("[ROLE:", "] ", " [/ROLE]")
    #: (state, role) -> next state; a missing pair is an invalid turn.
    follows: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    #: States in which a conversation may end.
    final: tuple[str, ...] = ("assistant",)

    def forms(self) -> list[tuple[str, Turn | None]]:
        """What the automaton may emit, in order of the symbols: every role's form, and ``None`` for the roles without one."""
        return [*self.roles.items(), ("", None)]

    def transitions(self) -> dict[tuple[str, str], tuple[str, str]]:
        """(state, role) -> (next state, symbol); the role ``""`` stands for all that the table does not name."""
        names = [name for name, _ in self.forms()]
        states = {"start", "bad", *(s for s, _ in self.follows), *self.follows.values()}
        out = {}
        for state in sorted(states):
            for role in sorted({*names, *(r for _, r in self.follows)}):
                to = self.follows.get((state, role))
                out[state, role] = (to or "bad", symbol(names.index(role if role in self.roles else ""), to is None))
        return out

    def marks(self) -> list[str]:
        found = [self.begin, *(x.strip() for t in self.roles.values() for x in (t.before, t.after)), self.other[0], self.other[2].strip()]
        return sorted({m for m in found if m})


def symbol(form: int, bad: bool) -> str:
    """The automaton's output for a turn: one character, odd if the turn is out of order."""
    return chr(0x100 + 2 * form + bad)


def _java(literal: str) -> str:
    """``literal`` quoted for a Java regex."""
    return rf"\Q{literal}\E"


def escape(text: Column, template: ChatTemplate) -> Column:
    firsts = "|".join(f"{_java(m[0])}(?={_java(m[1:])})" for m in template.marks())
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({firsts})", r"$1\\;")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:;|(\\))", "$1")


def _role_name(role: Column, template: ChatTemplate) -> Column:
    """A role for use inside its mark: no bracket in it can close the mark."""
    return F.regexp_replace(escape(role, template), r"\]", r"]\\;")


def format_chats(df: DataFrame, template: ChatTemplate | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, valid, first_bad_turn, segments, formatted``."""
    t = template or ChatTemplate()
    rows = df.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("row"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))

    moves = t.transitions()
    table = F.create_map(*[x for (state, r), (to, out) in moves.items() for x in (F.lit(f"{state}\x00{r}"), F.struct(F.lit(to).alias("to"), F.lit(out).alias("out")))])

    def step(acc: Column, r: Column) -> Column:
        move = F.coalesce(F.try_element_at(table, F.concat(acc["state"], F.lit("\x00"), r["role"])), F.try_element_at(table, F.concat(acc["state"], F.lit("\x00"))))
        return F.struct(move["to"].alias("state"), F.concat(acc["trace"], move["out"]).alias("trace"))

    def segment(value: Column, loss: bool) -> Column:
        return F.struct(value.alias("text"), F.lit(loss).alias("loss"))

    def emit(r: Column, out: Column) -> Column:
        body = escape(r["text"], t)
        made = F.array(
            segment(F.concat(F.lit(t.other[0]), _role_name(r["role"], t), F.lit(t.other[1])), False),
            segment(body, False),
            segment(F.lit(t.other[2]), False),
        )
        for k, (_, form) in enumerate(t.forms()):
            if form:
                made = F.when(out.isin(symbol(k, False), symbol(k, True)), F.array(segment(F.lit(form.before), False), segment(body, form.loss), segment(F.lit(form.after), False))).otherwise(made)
        return made

    seed = F.struct(F.lit("start").alias("state"), F.lit("").alias("trace"))
    out = chats.withColumn("fsm", F.aggregate("turns", seed, step))
    out = out.withColumn("symbols", F.split("fsm.trace", "(?!^)(?!$)"))
    out = out.withColumn("segments", F.concat(F.array(segment(F.lit(t.begin), False)), F.flatten(F.zip_with("turns", "symbols", emit))))
    first_bad = F.array_position(F.transform("symbols", lambda x: x.isin(*[symbol(k, True) for k in range(len(t.forms()))])), True)
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.col("fsm.state").isin(*t.final).alias("valid"),
        F.when(first_bad > 0, first_bad - 1).alias("first_bad_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_back(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """The turns of a formatted text: ``array<struct<role, text, loss>>``."""
    t = template or ChatTemplate()
    forms = [f"{_java(x.before)}.*?{_java(x.after)}" for x in t.roles.values()]
    forms.append(f"{_java(t.other[0])}.*?{_java(t.other[1])}.*?{_java(t.other[2])}")
    turns = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(forms)), F.lit(0))

    def made(role: Column, text: Column, loss: bool) -> Column:
        return F.struct(role.alias("role"), unescape(text).alias("text"), F.lit(loss).alias("loss"))

    def turn(x: Column) -> Column:
        head = F.instr(x, t.other[1])
        name = x.substr(F.lit(len(t.other[0]) + 1), head - len(t.other[0]) - 1)
        start = head + len(t.other[1])
        found = made(unescape(name), x.substr(start, F.length(x) - start + 1 - len(t.other[2])), False)
        for role, form in t.roles.items():
            body = x.substr(F.lit(len(form.before) + 1), F.length(x) - len(form.before) - len(form.after))
            found = F.when(x.startswith(F.lit(form.before)), made(F.lit(role), body, form.loss)).otherwise(found)
        return found

    return F.transform(turns, turn)


def loss_text(turns: Column) -> Column:
    """All text under the loss mask of turns that were read back, nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda x: x["loss"]), lambda x: x["text"]), "")
