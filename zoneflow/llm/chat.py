"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only.

A template gives each role the strings before and after its text and says whether the text is trained on. Turns
become text segments with loss flags; control strings inside a text are escaped, so the formatted string can be
read back to exactly the turns that went in.

Escaping puts one backslash behind the first character of a control string, and one more where backslashes stand
there already; removing one undoes it. An escaped text holds no control string.

The machine reads the roles in turn order and stops in a state: conversations that leave it, or end in a state
that doesn't accept, are formatted like the others and marked invalid, with the first offending turn.

Defined results: null text is the empty text; a null role is the empty role; roles without an entry in the
template use the entry of ``None``, which carries the role's name, escaped, in the text; turns with equal
numbers (repeated rows too) are kept, ordered by role and text; a null turn comes first; a null ``conv_id`` is
one conversation; an empty table gives an empty result. Other columns are ignored. All turns of one conversation meet in one row, as its formatted string must.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RoleFormat:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles``: format by role. ``other``: before the name of an unknown role, between name and text, after the text.
    ``control``: every string that has a meaning in the output; all ``before``/``after`` strings consist of them and white space."""

    roles: dict[str, RoleFormat]
    other: tuple[str, str, str]
    control: tuple[str, ...]
    #: state -> role -> next state; the machine starts in "start".
    transitions: dict[str, dict[str, str]] = field(default_factory=dict)
    accepting: tuple[str, ...] = ()


INSTRUCT = Template(
    roles={
        "system": RoleFormat("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": RoleFormat("[INST] ", " [/INST]"),
        "assistant": RoleFormat("<s> ", " </s>", loss=True),
    },
    other=("[ROLE] ", " [/ROLE] ", " </s>"),
    control=("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "<<SYS>>", "<</SYS>>"),
    transitions={
        "start": {"system": "primed", "user": "asked"},
        "primed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    accepting=("asked", "answered"),
)


def _quoted(s: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", s)


def _control(template: Template, slashes: str) -> str:
    """A control string with backslashes behind its first character: groups are first, backslashes, rest.

    Any first character may meet any rest; escaping such a mixture too does no harm, as it is undone.
    """
    firsts = sorted({c[0] for c in template.control})
    rests = sorted({c[1:] for c in template.control}, key=lambda x: (-len(x), x))
    return f"({'|'.join(map(_quoted, firsts))})({slashes})({'|'.join(map(_quoted, rests))})"


def escape(text: Column, template: Template = INSTRUCT) -> Column:
    return F.regexp_replace(text, _control(template, r"\\*"), r"$1$2\\$3")


def unescape(text: Column, template: Template = INSTRUCT) -> Column:
    return F.regexp_replace(text, _control(template, r"\\+").replace(r"(\\+)", r"\\(\\*)"), "$1$2$3")


def _chain(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = reduce(lambda acc, x: acc.when(*x) if acc is not None else F.when(*x), cases, None)
    return otherwise if out is None else out.otherwise(otherwise)


def _by_role(role: Column, template: Template, value) -> Column:
    return _chain([(role == k, value(f)) for k, f in template.roles.items()], value(None))


def _pieces(turn: Column, template: Template) -> Column:
    """The three segments of a turn: what stands before its text, the text, what stands after."""
    role, text = turn["role"], turn["text"]
    a, b, c = template.other
    before = _by_role(role, template, lambda f: F.lit(f.before) if f else F.concat(F.lit(a), escape(role, template), F.lit(b)))
    after = _by_role(role, template, lambda f: F.lit(f.after) if f else F.lit(c))
    loss = _by_role(role, template, lambda f: F.lit(bool(f and f.loss)))

    def segment(value: Column, trained: Column) -> Column:
        return F.struct(value.alias("text"), trained.alias("loss"))

    return F.array(segment(before, F.lit(False)), segment(escape(text, template), loss), segment(after, F.lit(False)))


def _walk(roles: Column, template: Template) -> Column:
    """(state, at): the state after all roles and the index of the first role without a transition (or null)."""
    edges = [(s, r, t) for s, out in template.transitions.items() for r, t in out.items()]

    def step(state: Column, role: Column) -> Column:
        return _chain([((state == s) & (role == r), F.lit(t)) for s, r, t in edges], F.lit(None).cast("string"))

    def merge(acc: Column, role: Column) -> Column:
        then = step(acc["state"], role)  # null from "failed"
        return F.struct(
            F.coalesce(then, F.lit("failed")).alias("state"),
            F.coalesce(acc["at"], F.when(then.isNull(), acc["n"])).alias("at"),
            (acc["n"] + 1).alias("n"),
        )

    start = F.struct(F.lit("start").alias("state"), F.lit(None).cast("int").alias("at"), F.lit(0).alias("n"))
    return F.aggregate(roles, start, merge)


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, formatted, segments: array<struct<text, loss>>, n_turns, valid, failed_at)."""
    rows = turns.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    made = whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", lambda t: _pieces(t, template))).alias("segments"),
        _walk(F.transform("turns", lambda t: t["role"]), template).alias("walk"),
    )
    return made.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        "n_turns",
        (F.col("walk.at").isNull() & F.col("walk.state").isin(*template.accepting)).alias("valid"),
        F.col("walk.at").alias("failed_at"),
    )


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Adds turns: array<struct<role, text>>, read from the formatted string alone."""
    a, b, c = template.other
    forms = [(k, f.before, f.after) for k, f in template.roles.items()] + [(None, a, c)]
    pattern = "(?s)" + "|".join(f"{_quoted(x)}.*?{_quoted(y)}" for _, x, y in forms)

    def turn(found: Column) -> Column:
        def role_of(k: str | None, x: str, y: str) -> Column:
            inner = F.substr(found, F.lit(len(x) + 1), F.length(found) - len(x) - len(y))
            if k is not None:
                return F.struct(F.lit(k).alias("role"), unescape(inner, template).alias("text"))
            cut = F.instr(inner, b)
            name = F.substr(inner, F.lit(1), cut - 1)
            rest = F.substr(inner, cut + len(b), F.length(inner))
            return F.struct(unescape(name, template).alias("role"), unescape(rest, template).alias("text"))

        return _chain([(F.startswith(found, F.lit(x)), role_of(k, x, y)) for k, x, y in forms[:-1]], role_of(*forms[-1]))

    return formatted.withColumn("turns", F.transform(F.regexp_extract_all("formatted", F.lit(pattern), F.lit(0)), turn))


def digest(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """The columns of query op3, taken from the formatted string and its segments."""
    back = read_back(formatted, template)
    trained = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), ""
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.col("turns"), said.alias("said"), trained.alias("trained"), "formatted", "valid").select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns plus conversation -1, whose texts are made of control strings."""
    spark: SparkSession = turns.sparkSession
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


_RX = r"(<|\[)(\\*)(/?s>|/?INST\]|/?ROLE\]|<SYS>>|</SYS>>)"

SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(text, '(<|\[)(\\*)(/?s>|/?INST\]|/?ROLE\]|<SYS>>|</SYS>>)', '\1\2\\\3', 'g') AS x,
    CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END AS r FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(x) + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE length(role) + 21 END) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(r, '' ORDER BY turn, role, text), 's?u(au)*a?') AS valid
FROM e GROUP BY conv_id
"""
