"""Chat formatting with typed content parts, a reversible template and a loss mask.

A turn holds parts: text, image, audio or document. `flatten` visits them in order:
text stays, every other part becomes a placeholder that names its kind and its
number in the turn, and is recorded as an attachment with the tokens it expands to. `render` wraps
a turn by the template

    <turn ROLE>\\nTEXT</turn>\\n

In texts, each `<` of a would-be control string (`<turn`, `</turn`, a placeholder's `<|`, with
any number of backslashes after the `<`) gets one backslash more; unescaping takes one
away. Neighbouring texts are escaped as one, and the kind of an attachment is escaped too. So
neither can close its turn, open another or forge a placeholder, and every text, kind and number comes back exactly.

The loss mask is run-length coded, three runs a turn (before, under, after, in
code points), covering the formatted string without gaps: under the mask lies
the escaped text of the trained role, and nothing else.

All is built-in functions and one shuffle by conversation: one conversation is
one row, as its output is one string; numbers of turns in a conversation bound a
task, not the number of conversations that are alike.

Defined results: a null text is empty, a null role is empty; turns are ordered by
turn (nulls first), then role and text; repeated rows are turns of their own; an
empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"

# --- Fixed values: the template's control strings and what they look like inside texts ---
END = "</turn>\n"
_CONTROL = r"<(\\*)(/?turn|\|)"
_ESCAPED = r"<\\(\\*)(/?turn|\|)"
# Tokens an attachment stands for: a fixed part, and one more per `every` units of its size.
EXPANSION = {"image": (85, 196), "audio": (8, 320), "document": (4, 512)}
# ------------------------------------------------------------------------------------------

PARTS_TYPE = "array<struct<type:string,text:string,ref:string,size:bigint>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "<$1$2")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    """One backslash pair, `\\g` or `\\n` at a time; a stand-in keeps pairs apart."""
    apart = F.replace(role, F.lit("\\\\"), F.lit("\\\x00"))
    apart = F.replace(F.replace(apart, F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n"))
    return F.replace(apart, F.lit("\\\x00"), F.lit("\\"))


# Characters that end a placeholder's kind or open something else, and how a kind holds them.
_KIND_SIGNS = {"\\": "\\\\", "<": "\\l", ">": "\\g", "|": "\\p", ":": "\\c", "\n": "\\n"}


def _escape_kind(kind: Column) -> Column:
    for sign, held in _KIND_SIGNS.items():
        kind = F.replace(kind, F.lit(sign), F.lit(held))
    return kind


def _unescape_kind(kind: Column) -> Column:
    """The first replacement of `_escape_kind` last; a stand-in keeps backslash pairs apart."""
    out = F.replace(kind, F.lit("\\\\"), F.lit("\\\x00"))
    for sign, held in reversed(list(_KIND_SIGNS.items())[1:]):
        out = F.replace(out, F.lit(held), F.lit(sign))
    return F.replace(out, F.lit("\\\x00"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A turn's parts, where it is plain text."""
    null = F.lit(None)
    part = F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
        null.cast("string").alias("ref"), null.cast("bigint").alias("size"),
    )
    return F.array(part)


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def tokens_of(part: Column) -> Column:
    """Tokens an attachment expands to; unknown kinds and sizes count the fixed part of a document."""
    size = F.greatest(F.coalesce(part["size"], F.lit(0)), F.lit(0))
    out = F.lit(EXPANSION["document"][0]).cast("bigint")
    for kind, (fixed, every) in EXPANSION.items():
        out = F.when(part["type"] == kind, F.ceil(size / every) + fixed).otherwise(out)
    return out


def flatten(parts: Column) -> tuple[Column, Column]:
    """The turn's escaped text with placeholders, and its attachments (number, kind, ref, tokens).

    Texts that stand side by side are escaped as the one text they make: control strings may lie across parts.
    """
    parts = F.coalesce(parts, F.array().cast(PARTS_TYPE))
    numbered = F.transform(parts, lambda part, at: F.struct(part.alias("part"), at.alias("at")))

    def visit(seen: Column, one: Column) -> Column:
        mark = F.concat(F.lit("<|"), _escape_kind(one["part"]["type"]), F.lit(":"), one["at"].cast("string"), F.lit("|>"))
        text = _is_text(one["part"])
        return F.struct(
            F.when(text, seen["done"]).otherwise(F.concat(seen["done"], escape(seen["open"]), mark)).alias("done"),
            F.when(text, F.concat(seen["open"], F.coalesce(one["part"]["text"], F.lit("")))).otherwise("").alias("open"),
        )

    start = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))
    shown = F.aggregate(numbered, start, visit, lambda seen: F.concat(seen["done"], escape(seen["open"])))
    attached = F.transform(
        F.filter(numbered, lambda one: ~_is_text(one["part"])),
        lambda one: F.struct(
            one["at"].cast("bigint").alias("number"), one["part"]["type"].alias("kind"),
            one["part"]["ref"].alias("ref"), tokens_of(one["part"]).alias("tokens"),
        ),
    )
    return shown, attached


def render(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """conv_id, formatted, loss_runs, attachments, n_tokens_attached; `turns` has conv_id, turn, role and parts or text."""
    parts = F.col("parts") if "parts" in turns.columns else text_part(F.col("text"))
    body, attached = flatten(parts)
    role = F.coalesce(F.col("role"), F.lit(""))
    slim = turns.select("conv_id", "turn", role.alias("role"), body.alias("body"), attached.alias("attached"))
    head = F.concat(F.lit("<turn "), _escape_role(F.col("role")), F.lit(">\n"))
    under = F.when(F.col("role") == trained_role, F.char_length("body")).otherwise(0)
    runs = F.struct(
        F.when(F.col("role") == trained_role, F.char_length(head)).otherwise(F.char_length(head) + F.char_length("body"))
        .cast("bigint").alias("before"),
        under.cast("bigint").alias("under"),
        F.lit(len(END)).cast("bigint").alias("after"),
    )
    one = F.struct("turn", "role", F.concat(head, "body", F.lit(END)).alias("shown"), runs.alias("runs"), "attached")
    gathered = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("_turns"))
    attachments = F.flatten(F.transform("_turns", lambda t, at: F.transform(
        t["attached"], lambda a: F.struct(at.cast("bigint").alias("turn_at"), a.alias("part"))
    )))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t["shown"]), "").alias("formatted"),
        F.transform("_turns", lambda t: t["runs"]).alias("loss_runs"),
        attachments.alias("attachments"),
    ).withColumn(
        "n_tokens_attached",
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda total, a: total + a["part"]["tokens"]),
    )


def _shown_turns(formatted: Column) -> Column:
    """The turns of a formatted string, without their ends."""
    pieces = F.split(formatted, END)
    return F.slice(pieces, 1, F.size(pieces) - 1)


_PLACEHOLDER = r"<\|([^|]*):([0-9]+)\|>"


def _parts_of(body: Column) -> Column:
    """(kind, number, text) of a turn's body in order; texts have kind 'text' and no number, and empty ones are left out."""
    texts = F.split(body, _PLACEHOLDER)
    kinds, numbers = (F.regexp_extract_all(body, F.lit(_PLACEHOLDER), F.lit(group)) for group in (1, 2))

    def pair(text: Column, at: Column) -> Column:
        said = F.struct(F.lit("text").alias("kind"), F.lit(None).cast("bigint").alias("number"), unescape(text).alias("text"))
        kind, number = F.get(kinds, at.cast("int")), F.get(numbers, at.cast("int"))
        shown = F.struct(_unescape_kind(kind).alias("kind"), number.cast("bigint").alias("number"), F.lit(None).cast("string").alias("text"))
        return F.filter(F.array(said, shown), lambda part: part["kind"].isNotNull() & (F.coalesce(part["text"], F.lit("x")) != ""))

    return F.flatten(F.transform(texts, pair))


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id with `turns` (role, text), `parts` (kind, number, text) of each turn and `trained` (texts under the mask).

    From formatted and loss_runs only. A turn's text has its placeholders as they stand; in its parts, texts that
    stood side by side are one.
    """

    def turn_of(shown: Column) -> Column:
        head = F.regexp_extract(shown, r"^<turn ([^>]*)>\n", 1)
        body = F.substr(shown, F.char_length(head) + F.lit(len("<turn >\n") + 1))
        return F.struct(_unescape_role(head).alias("role"), unescape(body).alias("text"))

    under = F.zip_with(
        "_shown",
        "loss_runs",
        lambda shown, run: F.when(
            run["under"] > 0, unescape(F.substr(shown, (run["before"] + 1).cast("int"), run["under"].cast("int")))
        ).otherwise(""),
    )
    def parts_of(shown: Column) -> Column:
        head = F.regexp_extract(shown, r"^<turn ([^>]*)>\n", 1)
        return _parts_of(F.substr(shown, F.char_length(head) + F.lit(len("<turn >\n") + 1)))

    return rendered.withColumn("_shown", _shown_turns(F.col("formatted"))).select(
        "conv_id", "formatted", F.transform("_shown", turn_of).alias("turns"),
        F.transform("_shown", parts_of).alias("parts"), under.alias("trained"),
    )
