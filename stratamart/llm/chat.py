r"""Chat formatting of typed content parts, in DataFrame functions only.

A turn holds parts of a kind: text, image, audio or document. Each part is rendered by the
rule of its kind: text is escaped, an attachment becomes a placeholder. The i-th placeholder
of a conversation belongs to the i-th entry of ``attachments``, which records the reference
and how many tokens the placeholder expands to. ``loss`` holds the spans of assistant text:
the turn (from 1), the first code point within the turn's block (from 1) and the length.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` per turn. In texts and roles a backslash is
doubled and ``<|`` becomes ``<\|``; in roles a line end becomes ``<\/|``. So no text holds a
control string, and ``unescape`` gives back every text exactly.

Defined cases: rows of a conversation are ordered by turn (null first), then role, then
parts, so ties and repeated rows have one order and all are kept. A null text, role or list
of parts is empty. A null conversation id is a conversation of its own. An empty table gives
no rows. Only the named columns are read. A conversation becomes one string, hence one row;
its rows reach that row pre-collected by the tasks that read them.
"""

from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import let

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens that a placeholder expands to, per unit: image patch, audio second, page.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 512}
PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text):
    return F.replace(
        F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|")
    )


def unescape(text):
    return F.replace(
        F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\")
    )


def _escape_role(role):
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\/|"))


def _unescape_role(role):
    return unescape(F.replace(role, F.lit("<\\/|"), F.lit("\n")))


def text_parts(text):
    """A column of plain text as a list of one text part."""
    nothing = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"), text.alias("text"), nothing.alias("ref"), nothing.alias("units")
    )
    return F.array(part).cast(PARTS)


def _is_text(part):
    return ~F.coalesce(part["kind"], F.lit("text")).isin(*TOKENS_PER_UNIT)


def _render(part):
    """The visitor: what a part of each kind looks like in the formatted string."""
    shown = F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit(""))))
    for kind in TOKENS_PER_UNIT:
        shown = shown.when(part["kind"] == kind, F.lit(f"<|{kind}|>"))
    return shown


def _attachment(part):
    tokens = F.lit(0)
    for kind, rate in TOKENS_PER_UNIT.items():
        tokens = F.when(part["kind"] == kind, F.coalesce(part["units"], F.lit(0)) * rate).otherwise(
            tokens
        )
    return F.struct(
        part["kind"].alias("kind"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens")
    )


def _head(turn):
    return F.concat(F.lit(START), _escape_role(turn["role"]), F.lit("\n"))


def _block(turn):
    return F.concat(_head(turn), F.array_join(F.transform(turn["parts"], _render), ""), F.lit(END))


def _spans(turn, index):
    """Spans of the text parts of an assistant's turn."""
    lengths = F.transform(turn["parts"], lambda p: F.length(_render(p)))

    def span(part, i):
        before = F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, x: a + x)
        return F.struct(
            (index + 1).cast("long").alias("turn"),
            (F.length(_head(turn)) + 1 + before).cast("long").alias("start"),
            F.length(_render(part)).cast("long").alias("length"),
            _is_text(part).alias("text"),
        )

    spans = F.filter(F.transform(turn["parts"], span), lambda s: s["text"])
    kept = F.transform(
        spans,
        lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length")),
    )
    return F.when(turn["role"] == "assistant", kept).otherwise(F.slice(kept, 1, 0))


def format_chat(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts=None
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss, attachments, expanded_tokens``.

    ``parts`` is a column of typed parts; by default the column ``text`` is one text part.
    """
    column = text_parts(F.col("text")) if parts is None else parts.cast(PARTS)
    row = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(column, F.array().cast(PARTS)).alias("parts"),
    )
    grouped = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(
        F.sort_array(F.collect_list(row)).alias("turns")
    )
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(F.filter(t["parts"], lambda p: ~_is_text(p)), _attachment),
        )
    )
    return (
        grouped.select(
            "conv_id",
            F.array_join(F.transform("turns", _block), "").alias("formatted"),
            F.flatten(F.transform("turns", _spans)).alias("loss"),
            attached.alias("attachments"),
        )
        .withColumn(
            "expanded_tokens",
            F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]),
        )
    )


def _blocks(formatted):
    """Blocks of a formatted conversation, without the end marks."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    return let(pieces, lambda p: F.slice(p, F.lit(1), F.size(p) - 1))


def read_turns(formatted):
    """Roles and texts read back from a formatted column, as an array of structs."""

    def turn(block):
        line = F.locate("\n", block)
        role = F.substring(block, F.lit(len(START) + 1), line - len(START) - 1)
        return F.struct(
            _unescape_role(role).alias("role"),
            unescape(F.substring(block, line + 1, F.length(block))).alias("text"),
        )

    return F.transform(_blocks(formatted), lambda b: let(b, turn))


def loss_text(formatted, loss):
    """All text under the loss mask, unescaped."""
    return let(
        _blocks(formatted),
        lambda blocks: F.array_join(
            F.transform(
                loss,
                lambda s: unescape(
                    F.substring(
                        F.element_at(blocks, s["turn"].cast("int")),
                        s["start"].cast("int"),
                        s["length"].cast("int"),
                    )
                ),
            ),
            "",
        ),
    )
