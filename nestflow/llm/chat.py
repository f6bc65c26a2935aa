"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, and adjacent turns
of one role are merged into a run.  A run is written as::

    <|role|>ROLE<|text|>TEXT<|sep|>TEXT...<|end|>

The loss mask (``loss_spans``: start and length in code points) covers the
texts of the trained roles and nothing between them.  Inside roles and texts
a backslash is doubled and every control string, this template's and those
that other templates use, gets a backslash after its first character, so
none can occur in the output unless the template put it there; ``read_back``
undoes it exactly.

Turns are in order of ``turn`` (null first), ties by role, then text; null
roles and texts are empty; repeated rows are turns of their own; rows with a
null conv_id form one conversation.  Extra columns are not read.  An empty
table gives no rows.

A conversation is one output value, so its turns meet in one task; all array
work is linear in them but for sorting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import bind, text_or_empty

ROLE, TEXT, SEP, END = "<|role|>", "<|text|>", "<|sep|>", "<|end|>"

#: Control strings of common templates, neutralised inside texts (fixed values); the first covers this template's own.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CHUNK = 512


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in "\\[](){}.*+?^$|/" else c for c in s)


_CONTROL_PATTERN = "|".join(f"(?<={_quoted(c[0])})(?={_quoted(c[1:])})" for c in CONTROL)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL_PATTERN, "\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def offsets(lengths: Column) -> Column:
    """Of each place the sum of the lengths before it: sums of chunks first, then inside a chunk."""
    def inside(values: Column) -> Column:
        count = F.size(values)
        chunks = F.transform(F.sequence(F.lit(0), F.floor((count - 1) / _CHUNK).cast("int")),
                             lambda c: F.slice(values, c * _CHUNK + 1, F.lit(_CHUNK)))
        total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

        def placed(parts: Column) -> Column:
            sums = F.transform(parts, total)
            return bind(sums, lambda t: F.flatten(F.transform(parts, lambda p, c: bind(
                total(F.slice(t, 1, c)), lambda begin: F.transform(
                    p, lambda _, k: begin + total(F.slice(p, 1, k)))))))

        return F.when(count == 0, F.array().cast("array<long>")).otherwise(bind(chunks, placed))

    return bind(lengths.cast("array<long>"), inside)


def _runs(turns: Column) -> Column:
    """Sorted turns merged into runs of one role: struct(role, texts)."""
    def merged(t: Column) -> Column:
        starts = F.filter(F.transform(t, lambda _, i: i), lambda i: (i == 0) | (F.get(t, i - 1)["role"] != F.get(t, i)["role"]))
        return bind(starts, lambda s: F.transform(s, lambda at, k: F.struct(
            F.get(t, at)["role"].alias("role"),
            F.transform(F.slice(t, at + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - at), lambda x: x["text"]).alias("texts"))))

    return bind(turns, merged)


def format_chats(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Of each conversation: conv_id, formatted, loss_spans (array of start, length)."""
    row = F.struct(F.col("turn").alias("turn"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    runs = turns.groupBy("conv_id").agg(F.collect_list(row).alias("turns")).select(
        "conv_id", F.transform(_runs(F.array_sort("turns")), lambda r: F.struct(
            r["role"].isin(*trained).alias("trained"), escape(r["role"]).alias("role"),
            F.transform(r["texts"], escape).alias("texts"))).alias("runs"))
    body = F.transform("runs", lambda r: F.concat(F.lit(ROLE), r["role"], F.lit(TEXT), F.array_join(r["texts"], SEP), F.lit(END)))
    written = runs.select("conv_id", "runs", body.alias("bodies"))
    begins = offsets(F.transform("bodies", F.length))

    def spans(begin: Column) -> Column:
        return F.flatten(F.transform("runs", lambda r, k: F.when(r["trained"], bind(
            offsets(F.transform(r["texts"], lambda x: F.length(x) + len(SEP))),
            lambda o: F.transform(r["texts"], lambda x, j: F.struct(
                (F.get(begin, k) + len(ROLE) + F.length(r["role"]) + len(TEXT) + F.get(o, j)).alias("start"),
                F.length(x).cast("long").alias("length"))))).otherwise(
                    F.array().cast("array<struct<start:long,length:long>>"))))

    return written.select("conv_id", F.array_join("bodies", "").alias("formatted"), bind(begins, spans).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Of each conversation: conv_id, turns (role, text), loss_texts, formatted; from the output alone.

    A text is under the loss mask if a span begins at its place; what is
    returned is the span's length of it.
    """
    bodies = F.filter(F.split("formatted", r"(?<=<\|end\|>)"), lambda b: b != "")
    split = formatted.select("conv_id", "formatted", "loss_spans", bodies.alias("bodies"))

    def parsed(b: Column, begin: Column) -> Column:
        inner = F.substring(b, F.lit(len(ROLE) + 1), F.length(b) - len(ROLE) - len(END))
        return bind(F.split(inner, r"<\|text\|>", 2), lambda p: bind(F.split(p[1], r"<\|sep\|>", -1), lambda texts: bind(
            offsets(F.transform(texts, lambda x: F.length(x) + len(SEP))), lambda o: F.transform(texts, lambda x, j: F.struct(
                p[0].alias("role"), x.alias("text"),
                (begin + len(ROLE) + F.length(p[0]) + len(TEXT) + F.get(o, j)).alias("start"))))))

    runs = bind(offsets(F.transform("bodies", F.length)), lambda o: F.flatten(
        F.transform("bodies", lambda b, k: parsed(b, F.get(o, k)))))
    found = split.select("conv_id", "formatted", "loss_spans", runs.alias("found"))
    # Spans and texts in order of their start, a span just before its text.
    marked = F.array_sort(F.concat(
        F.transform("loss_spans", lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("kind"), s["length"].alias("length"), F.lit("").alias("text"))),
        F.transform("found", lambda t: F.struct(t["start"].alias("start"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("length"), t["text"].alias("text")))))
    under = bind(marked, lambda m: F.filter(F.transform(m, lambda x, k: F.when(
        (x["kind"] == 1) & (F.get(m, k - 1)["kind"] == 0) & (F.get(m, k - 1)["start"] == x["start"]),
        F.substring(x["text"], F.lit(1), F.get(m, k - 1)["length"].cast("int")))), lambda x: x.isNotNull()))
    return found.select(
        "conv_id", "formatted",
        F.transform("found", lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))).alias("turns"),
        F.transform(under, unescape).alias("loss_texts"))
