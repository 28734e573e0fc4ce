"""Chat formatting with a grammar round trip, in column expressions only.

    conversation = turn*
    turn         = "<|im_start|>" role "\n" text "<|im_end|>" "\n"

A role ends at its first line break, a text at the next end mark. The parser is
deterministic: it cuts at start marks, then at the first line break, and takes
off one escape sign where a text or role shows an escaped mark. Turns are
rendered as they are, parsed again and compared with the source; those that come
back otherwise are escaped, and the whole conversation is rendered and parsed
once more. Escaping adds one `\\` inside everything that looks like a mark, with
or without such signs, and reading takes one off, so one pass always suffices;
should a conversation still differ, the job fails rather than write it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_MARK = r"<(\\*)\|im_(start|end)\|>"
_ESCAPED = r"<\\(\\*)\|im_(start|end)\|>"
#: A role also ends at a line break, which is written as `\n`; `\` before `n` or `\` gets one more.
_TURN = "struct<role:string,text:string>"
_RENDERED = "array<struct<role:string,text:string,escape:boolean>>"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, _MARK, r"<\\$1|im_$2|>")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"<$1|im_$2|>")


def escape_role(role: Column) -> Column:
    """Backslashes are doubled, and line breaks and `<` spelled out, so that no mark or line end is left."""
    out = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("<"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<")))
    return F.array_join(plain, "\\")


def _shown(turn: Column) -> Column:
    """What a turn looks like between its marks."""
    role = F.when(turn["escape"], escape_role(turn["role"])).otherwise(turn["role"])
    text = F.when(turn["escape"], escape_text(turn["text"])).otherwise(turn["text"])
    return F.concat(role, F.lit("\n"), text)


def render(turns: Column) -> Column:
    """The text of a conversation; `turns` are (role, text, escape)."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), _shown(t), F.lit(END + "\n"))), "")


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text; what does not follow the grammar gives turns that differ."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        rest = F.substring(piece, line + 1, F.length(piece))
        end = F.instr(rest, END)
        role = F.substring(piece, F.lit(1), line - 1)
        text = F.substring(rest, F.lit(1), end - 1)
        whole = (line > 0) & (end > 0) & (F.substring(rest, end, F.length(rest)) == END + "\n")
        return F.when(whole, F.struct(unescape_role(role).alias("role"), unescape_text(text).alias("text"))).otherwise(
            F.lit(None).cast(_TURN)
        )

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def _source(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _comes_back(turn: Column) -> Column:
    """Whether a turn by itself is read as it was written."""
    return F.coalesce(parse(render(F.array(turn))) == _source(F.array(turn)), F.lit(False))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of turns(conv_id, turn, role, text): conv_id, formatted, loss.

    `loss` lists the places (start, end) of the assistant's texts in `formatted`,
    in code points and end exclusive. Turns go by `turn`, ties by role and text;
    repeated rows are turns of their own. Null roles and texts are empty ones,
    nulls in `turn` go first, and rows without a conv_id form one conversation.
    A conversation is one training example, so it must fit one row.
    """
    raw = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("escape"))
    row = turns.select("conv_id", "turn", raw.alias("t"))
    # rendered turn by turn, before conversations meet in one row
    escaped = F.struct(F.col("t.role").alias("role"), F.col("t.text").alias("text"), (~_comes_back(F.col("t"))).alias("escape"))
    row = row.select("conv_id", "turn", escaped.alias("t"))
    order = F.struct("turn", F.col("t.role").alias("role"), F.col("t.text").alias("text"), F.col("t.escape").alias("escape"))
    each = row.groupBy("conv_id").agg(F.sort_array(F.collect_list(order)).alias("turns"))
    each = each.withColumn(
        "turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["escape"].alias("escape")))
    )
    each = each.withColumn("formatted", render(F.col("turns")))
    same = F.coalesce(parse(F.col("formatted")) == _source(F.col("turns")), F.lit(False))
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation cannot be read back")).cast("string"))
    return each.select("conv_id", checked.alias("formatted"), "turns").select("conv_id", "formatted", loss_places(F.col("formatted")).alias("loss"))


def loss_places(formatted: Column) -> Column:
    """Where the assistant's texts stand, found in the formatted text itself."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    spans = "array<struct<start:int,end:int>>"
    first = F.struct((-F.lit(len(START))).alias("at"), F.array().cast(spans).alias("spans"))

    def add(done, piece):
        begin = done["at"] + len(START)
        line = F.instr(piece, "\n")
        start = begin + line
        end = begin + F.length(piece) - len(END) - 1
        is_loss = unescape_role(F.substring(piece, F.lit(1), line - 1)) == "assistant"
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        out = F.when((done["at"] >= 0) & is_loss, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((begin + F.length(piece)).cast("int").alias("at"), out.cast(spans).alias("spans"))

    return F.aggregate(pieces, first, add, lambda done: done["spans"])


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Digests read from (conv_id, formatted, loss) alone."""
    text = F.col("formatted")
    own = formatted.withColumn("turns", parse(text))
    own = own.withColumn(
        "loss_text",
        F.array_join(F.transform("loss", lambda s: unescape_text(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), ""),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return own.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length(text).cast("long").alias("formatted_chars"),
    )
