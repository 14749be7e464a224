"""Chat formatting with typed content parts, native.

A turn's content is an array of typed parts. A visitor, one expression per type,
flattens them in order: text parts are escaped, image, audio and document parts
become placeholders, whose attachment references and expanded token counts are
recorded. Turns are then framed by control strings. Escaping takes every control
string out of roles and texts and can be undone, so the output parses back to
what went in whatever the texts say. The loss mask is a list of spans of the
formatted text: the content of the assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Tokens per unit of a part's ``size``: an image's patches, an audio's seconds, a document's pages.
RATES = {"image": 1.0, "audio": 25.0, "document": 600.0}
PART = "struct<type:string,text:string,ref:string,size:double>"


def escaped(c: Column) -> Column:
    """``%`` and ``<|`` written as ``%25`` and ``%3C|``: no control string is left."""
    return F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def text_part(text: Column) -> Column:
    """One text part as a part array (null text: empty)."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("size")))


def _is_text(part: Column) -> Column:
    return ~F.coalesce(part["type"], F.lit("text")).isin(*RATES)


def _said(part: Column) -> Column:
    return F.coalesce(part["text"], F.lit(""))


def _visit(part: Column, following: Column) -> Column:
    """The flat text of a part: its escaped text, or a placeholder naming its type. Adjacent texts are escaped as
    the one text they become: a ``<`` before a text that starts with ``|`` is part of a ``<|``."""
    own = escaped(_said(part))
    split = F.endswith(_said(part), F.lit("<")) & F.coalesce(_is_text(following) & F.startswith(_said(following), F.lit("|")), F.lit(False))
    flat = F.when(split, F.concat(F.substr(own, F.lit(1), F.length(own) - 1), F.lit("%3C"))).otherwise(own)
    for name in RATES:
        flat = F.when(part["type"] == name, F.lit(f"<|{name}|>")).otherwise(flat)
    return flat


def _flat(parts: Column) -> Column:
    """The flat text of a turn's parts; empty texts stand between no others."""
    heard = F.filter(parts, lambda p: ~_is_text(p) | (_said(p) != ""))
    each = F.transform(F.array(heard), lambda h: F.transform(h, lambda p, i: _visit(p, F.get(h, i + 1))))
    return F.concat_ws("", F.flatten(each))


def _tokens(part: Column) -> Column:
    n = F.lit(0.0)
    for name, rate in RATES.items():
        n = F.when(part["type"] == name, F.ceil(F.coalesce(part["size"], F.lit(0.0)) * rate).cast("double")).otherwise(n)
    return n.cast("long")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts") -> DataFrame:
    """One row per conversation: the id, ``formatted``, ``loss_spans`` (array of start, end in
    code points, end exclusive), ``attachments`` (array of turn index from 0, type, ref, tokens
    in order of their placeholders), ``placeholder_tokens`` (their sum).

    ``turns``: one row per turn with ``parts_col`` (array of type, text, ref, size). Turns are
    ordered by number, ties by role, then content; a null number comes first. Null roles, texts
    and part arrays count as empty, an unknown or null type as text, a null id as an id of its
    own; repeated rows are turns of their own. An empty table gives an empty one. Further
    columns are not read. A conversation becomes one text, so its turns meet in one row;
    they are gathered per task before the shuffle.
    """
    part = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    media = F.filter(part, lambda p: p["type"].isin(*RATES))
    flat = turns.select(
        F.col(conv_col).alias("c"), F.col(turn_col).alias("t"), role.alias("r"),
        _flat(part).alias("x"),
        F.transform(media, lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens"))).alias("m"))
    chats = flat.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("t", "r", "x", "m"))).alias("turns"))
    head = F.transform("turns", lambda t: F.concat(F.lit(TURN), escaped(t["r"]), F.lit(BODY)))
    framed = F.zip_with(F.col("turns"), F.col("heads"), lambda t, h: F.concat(h, t["x"], F.lit(END)))
    chats = chats.withColumn("heads", head).withColumn("framed", framed)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, z: Column) -> Column:
        start = acc["at"] + F.length(z["heads"])
        end = start + F.length(z["turns"]["x"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"),
                        F.when(z["turns"]["r"] == "assistant", F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    spans = F.aggregate(F.arrays_zip("turns", "heads"), empty, step, lambda acc: acc["out"])
    attached = F.flatten(F.transform("turns", lambda t, i: F.transform(t["m"], lambda m: F.struct(
        i.alias("turn"), m["type"].alias("type"), m["ref"].alias("ref"), m["tokens"].alias("tokens")))))
    return (chats.select(F.col("c").alias(conv_col), F.concat_ws("", "framed").alias("formatted"),
                         spans.alias("loss_spans"), attached.alias("attachments"))
            .withColumn("placeholder_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"])))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with what ``formatted`` and ``loss_spans`` say: ``turns`` (array of role, text, unescaped;
    placeholders stay) and ``loss_text`` (all text under the mask, unescaped)."""
    cut = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda t: t != "")
    turns = F.transform(cut, lambda t: F.struct(
        unescaped(F.substring_index(t, BODY, 1)).alias("role"),
        unescaped(F.substr(t, F.instr(t, BODY) + len(BODY), F.length(t) - F.instr(t, BODY) - len(BODY) - len(END) + 1)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return chats.withColumn("turns", turns).withColumn("loss_text", F.concat_ws("", loss))
