"""Chat formatting from a declarative template, with DataFrame functions only.

A template names the roles, whether a role's text counts for the loss, and which role may
follow which: the states of a finite-state machine are the roles, plus the start; some of
them are accepting, and a conversation is accepted if every turn is allowed and the last
one leaves the machine in such a state. Every turn becomes three segments (mark, escaped
text, end), each with its loss flag, and a flag that tells whether the machine allows the
turn there. Turns that it does not allow are formatted like any other.

Control strings inside texts are broken up by a backslash. The template's mark and end
each begin, blanks aside, with a pair of characters; in a text a backslash goes between
the two characters of any such pair (after ``#`` of ``##`` and ``<`` of ``</`` in the
default template), before any backslash, and after a first character that ends the text.
An escaped text holds no such pair, nor does it form one with the end, so a turn's end is
found by plain search, and taking the backslashes out again gives the text back. A template
for which that would not hold is refused.

Scale: a conversation's turns are put in order in cells of ``CELL`` turn numbers; only the
last role of each cell crosses to the next one. A conversation that holds much of the
table is thus sorted in many tasks. Only ``conversations``, which joins a conversation's
turns into one row, needs it whole.

Null texts and roles are empty. Turns of equal number are ordered by role, then text; null
turn numbers come first. A null ``conv_id`` is a conversation of its own. Roles that the
template does not know are marked in hexadecimal and allowed nowhere. Extra columns are
not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = 4096
START = "(start)"


@dataclass(frozen=True)
class Template:
    """How a turn is marked, which roles count for the loss, and which may follow which."""

    mark: str = "### "
    after_role: str = ": "
    end: str = " </turn>\n"
    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    loss: tuple = ("assistant",)
    follows: dict = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    #: The states in which a conversation may end.
    accepts: tuple = ("assistant",)

    def __post_init__(self):
        pairs = self.pairs
        if any(len(p) < 2 or "\\" in p for p in pairs):
            raise ValueError("mark and end need two characters that are neither blank at the outside nor a backslash")
        # No end may stand in what names a role, nor begin there and be completed by a text.
        heads = [self.mark + name + self.after_role for name in [*self.names.values(), *["=" + c for c in ["", *HEX]]]]
        end, pair = self.end, self.end.strip()[:2]
        begun = any(h.endswith(end[:n]) and pair not in end[n:] for h in heads for n in range(1, len(end)))
        if begun or any(end in h for h in heads) or set(pair) <= set("=" + HEX):
            raise ValueError("an end could be read where a role is named")
        if not self.after_role or set(self.after_role) <= set("=" + HEX) or any((n + self.after_role).index(self.after_role) != len(n) for n in self.names.values()):
            raise ValueError("after_role could be read inside a role's name")
        if len(set(self.names.values())) < len(self.names) or any(n.startswith("=") for n in self.names.values()):
            raise ValueError("names of roles must differ and not begin with =")

    @property
    def pairs(self) -> list[str]:
        """The first two characters of the mark and of the end, blanks aside."""
        return sorted({c.strip()[:2] for c in (self.mark, self.end)})


#: Unknown roles are written with these.
HEX = "0123456789ABCDEF"
TEMPLATE = Template()


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in pairs for x in pair])


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    text = F.regexp_replace(text, r"\\", r"\\\\")
    for a, b in template.pairs:
        text = F.regexp_replace(text, f"({_quoted(a)})(?={_quoted(b)}|\\z)", r"$1\\")
    return text


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    seconds = "|".join(_quoted(b) for _, b in template.pairs)
    return F.regexp_replace(text, rf"\\(\\|{seconds}|\z)", "$1")


def format_turns(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, cell, place, allowed, ends, segments) for every turn; (cell, place) is its order.

    ``ends`` tells whether a conversation may end with it.
    """
    clean = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("cell", F.coalesce(F.floor(F.col("turn") / CELL), F.lit(-(1 << 62))).cast("long"))
    order = Window.partitionBy("conv_id", "cell").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = clean.withColumn("place", F.row_number().over(order)).withColumn("before", F.lag("role").over(order))
    last = clean.groupBy("conv_id", "cell").agg(F.max_by("role", F.struct("turn", "role", "text")).alias("last"))
    cells = last.select("conv_id", "cell", F.lag("last").over(Window.partitionBy("conv_id").orderBy("cell")).alias("crossing")).where("crossing is not null")
    crossed = placed.alias("p").join(
        cells.alias("c"), F.expr("p.place = 1 and p.conv_id <=> c.conv_id and p.cell = c.cell"), "left"
    ).select("p.*", "c.crossing")
    state = F.coalesce("before", "crossing", F.lit(START))
    allowed = F.coalesce(F.array_contains(F.try_element_at(_map(template.follows.items()), state), F.col("role")), F.lit(False))
    name = F.coalesce(F.try_element_at(_map(template.names.items()), F.col("role")), F.concat(F.lit("="), F.hex(F.col("role").cast("binary"))))
    mark = F.concat(F.lit(template.mark), name, F.lit(template.after_role))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.array(
        part(mark, F.lit(False)), part(escape(F.col("text"), template), F.col("role").isin(*template.loss)), part(F.lit(template.end), F.lit(False))
    )
    ends = F.col("role").isin(*template.accepts)
    return crossed.select("conv_id", "cell", "place", allowed.alias("allowed"), ends.alias("ends"), segments.alias("segments"))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, segments, formatted, allowed, accepted): each conversation whole, in order."""
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("cell", "place", "segments"))).alias("t"), F.min("allowed").alias("allowed"),
        F.max_by("ends", F.struct("cell", "place")).alias("ends"),
    )
    segments = F.flatten(F.transform("t", lambda t: t["segments"]))
    whole = whole.select("conv_id", "allowed", (F.col("allowed") & F.col("ends")).alias("accepted"), segments.alias("segments"))
    return whole.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The (role, text) turns of a formatted conversation."""
    known = _map((v, k) for k, v in template.names.items())

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(template.mark) + 1, 1 << 30)
        name = F.substring_index(body, template.after_role, 1)
        role = F.coalesce(F.try_element_at(known, name), F.decode(F.unhex(F.substring(name, 2, 1 << 30)), "UTF-8"))
        text = F.substring(body, F.length(name) + F.lit(len(template.after_role) + 1), F.lit(1 << 30))
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    pieces = F.split(formatted, _quoted(template.end))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def loss_texts(segments: Column, template: Template = TEMPLATE) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template))
