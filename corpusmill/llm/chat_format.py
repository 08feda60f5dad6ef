r"""Chat formatting with a grammar round trip.

Template: ``<turn role="ROLE">TEXT</turn>`` for each turn, turns following each other without anything between. The
parser is deterministic: cut after each ``</turn>``, take the role up to ``">``, then undo the escapes ``\l`` (``<``)
and ``\b`` (a backslash).

Each turn is first rendered as it is and parsed back. Only if role and text do not come back identical is it rendered
anew with its control strings escaped, and if that still differs, with every backslash and ``<`` (and ``"`` in roles)
escaped, which always comes back. A turn that parses alone parses in any sequence, since each ends with its own mark; the
conversation is parsed once more as a whole and compared with its source.

Native column functions only. Turns of a conversation meet in one row, as its format is one string; everything else is
per row.

Defined results: a null text or role is the empty string; turns go by number, nulls first, equal numbers by role, then
text; repeated rows are repeated turns; rows with a null conversation id are one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = '<turn role="', '">', "</turn>"
LOSS_ROLES = ("assistant",)


def _all_escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit('"'), F.lit("\\q"))


def _controls_escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(CLOSE), F.lit("\\l/turn>")), F.lit("<turn"), F.lit("\\lturn"))


def _unescaped(text: Column) -> Column:
    # A backslash is only ever left as \b, so undoing the others first cannot make new escapes.
    return F.replace(F.replace(F.replace(text, F.lit("\\q"), F.lit('"')), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """Turns of a formatted string as an array of (role, text)."""
    pieces = F.split(formatted, F.lit(CLOSE))
    # What follows the last mark is empty.
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        middle = F.locate(MIDDLE, piece)
        return F.struct(
            _unescaped(F.substring(piece, F.lit(len(OPEN) + 1), middle - len(OPEN) - 1)).alias("role"),
            _unescaped(F.substring(piece, middle + len(MIDDLE), F.length(piece))).alias("text"),
        )

    return F.transform(turns, turn)


def _comes_back(formatted: Column, role: Column, text: Column) -> Column:
    """One rendered turn parses to exactly its source."""
    parsed = parse(formatted)
    return F.coalesce((F.size(parsed) == 1) & (parsed[0]["role"] == role) & (parsed[0]["text"] == text), F.lit(False))


def render_turns(turns: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` with ``rendered`` and ``level``, the number of times escaping had to be widened (0, 1 or 2)."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    forms = [_rendered(role, text), _rendered(role, _controls_escaped(text)), _rendered(_all_escaped(role), _all_escaped(text))]
    # A turn without a backslash or "<" or quote has nothing to escape and is only parsed as part of the whole.
    plain = ~(F.contains(text, F.lit("\\")) | F.contains(text, F.lit("<")) | role.rlike(r'[\\<">]'))
    level = F.when(plain | _comes_back(forms[0], role, text), 0).when(_comes_back(forms[1], role, text), 1).otherwise(2)
    out = turns.drop("level", "rendered").withColumn("level", level)
    chosen = F.when(F.col("level") == 0, forms[0]).when(F.col("level") == 1, forms[1]).otherwise(forms[2])
    return out.withColumn("rendered", chosen)


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row a conversation: ``conv_col``, ``formatted``, ``turns`` (parsed back) and ``round_trip``, whether the parsed
    turns are the source."""
    source = F.struct(
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows = render_turns(turns.select(conv_col, turn_col, role_col, text_col), role_col, text_col)
    packed = F.struct(F.col(turn_col).alias("at"), source.alias("source"), F.col("rendered"))
    told = rows.groupBy(conv_col).agg(F.sort_array(F.collect_list(packed)).alias("__turns"))
    return told.select(
        F.col(conv_col),
        F.array_join(F.col("__turns.rendered"), "").alias("formatted"),
        F.col("__turns.source").alias("__source"),
    ).select(conv_col, "formatted", parse(F.col("formatted")).alias("turns"), "__source").select(
        conv_col, "formatted", "turns", (F.col("turns") == F.col("__source")).alias("round_trip")
    )


def conversation_digests(formatted: DataFrame, conv_col: str = "conv_id", loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """Counts and digests of what was parsed back; the loss mask covers the texts of ``loss_roles``."""
    lines = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform(F.filter(F.col("turns"), lambda t: t["role"].isin(*loss_roles)), lambda t: t["text"])
    return formatted.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.array_join(masked, "").alias("__loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    ).select(
        conv_col, "n_turns", "turns_sha256",
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "round_trip",
    )
