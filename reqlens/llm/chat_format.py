"""Chat formatting with typed content parts.

A message's content is an ordered list of parts: text, image, audio or document.  A visitor
(:class:`PartVisitor`) turns each into its piece of the formatted text, its attachment (if
any) and its number of tokens once placeholders are expanded; a subclass can price or mark
parts in another way.  Everything is a column expression over one row, so formatting needs
no shuffle; only the order of a conversation's turns does.

**Template.**  A turn is ``<|turn|>role<|says|>content<|end|>``; text parts that follow one another are
parted by ``<|part|>``; other parts stand as ``<|image|>``, ``<|audio|>`` or ``<|document|>``, the k-th
placeholder of a turn for its k-th attachment.

**Escapes.**  Wherever a text or role holds a control string, of this template (all begin
``<|``) or one that chat tokenizers commonly read as control (``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), a
backslash goes in after its first character; one that already has backslashes there gets one
more.  So no text can end its turn, and taking one backslash away again gives every text back.

**Loss mask.**  ``loss`` holds the spans (start, length, in code points) of text pieces said by
the trained role.

Defined cases: NULL text or role is empty; a NULL or empty list of parts is an empty content; a part
of unknown kind, or a NULL one, is an empty text; a turn's place is by turn (NULL first), then its
formatted text; repeated rows are turns of their own; rows with a NULL conv_id are one conversation; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import load

TURN, SAYS, END, PART = "<|turn|>", "<|says|>", "<|end|>", "<|part|>"
#: The first character of a control string, any backslashes after it, and what follows.
_CONTROL = r"([<\[])(\\*)(?=\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(?=\||/?s>|/?INST\])"

#: Content parts as Spark sees them.  ``ref`` locates an attachment; sizes are those of its kind.
PARTS = "array<struct<kind string, text string, ref string, width int, height int, millis long, pages int>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2")


def unescaped(text: str) -> str:
    return re.sub(_ESCAPED, r"\1\2", text)


class PartVisitor:
    """One method per kind of part: (piece of formatted text, tokens it stands for)."""

    image_patch = 14  # pixels of a square patch; a patch is a token
    audio_ms = 40  # of a frame; a frame is a token
    page_tokens = 256

    def tokens_of_text(self, text: Column) -> Column:
        """Words and marks: a tokenizer-free count; give another visitor one's own."""
        return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long")

    def text(self, part: Column) -> tuple[Column, Column]:
        said = F.coalesce(part["text"], F.lit(""))
        return escaped(said), self.tokens_of_text(said)

    def image(self, part: Column) -> tuple[Column, Column]:
        patches = lambda size: F.ceil(F.greatest(F.coalesce(size, F.lit(0)), F.lit(1)) / self.image_patch)
        return F.lit("<|image|>"), (patches(part["width"]) * patches(part["height"])).cast("long")

    def audio(self, part: Column) -> tuple[Column, Column]:
        millis = F.greatest(F.coalesce(part["millis"], F.lit(0)), F.lit(1))
        return F.lit("<|audio|>"), F.ceil(millis / self.audio_ms).cast("long")

    def document(self, part: Column) -> tuple[Column, Column]:
        pages = F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(1))
        return F.lit("<|document|>"), (pages * self.page_tokens).cast("long")

    def visit(self, part: Column) -> Column:
        """struct(kind, piece, tokens, ref) of a part."""
        kind = F.when(part["kind"].isin("image", "audio", "document"), part["kind"]).otherwise(F.lit("text"))
        piece, tokens = self.text(part)
        for name in ("image", "audio", "document"):
            own, n = getattr(self, name)(part)
            piece, tokens = F.when(kind == name, own).otherwise(piece), F.when(kind == name, n).otherwise(tokens)
        return F.struct(kind.alias("kind"), piece.alias("piece"), tokens.alias("tokens"), part["ref"].alias("ref"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    fields = {"ref": "string", "width": "int", "height": "int", "millis": "long", "pages": "int"}
    part = F.struct(
        F.lit("text").alias("kind"), text.cast("string").alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in fields.items()]
    )
    return F.array(part)


def render_turns(turns: DataFrame, trained_role: str = "assistant", visitor: PartVisitor | None = None) -> DataFrame:
    """Each row of ``turns`` (conv_id, turn, role, parts: PARTS, or text) as one formatted turn, without a shuffle.

    conv_id, turn, formatted, loss: array of (start, length) in code points of formatted, attachments: array of
    (kind, ref, tokens) in the order of placeholders, n_tokens: of text and expanded placeholders.
    """
    visitor = visitor or PartVisitor()
    parts = turns["parts"].cast(PARTS) if "parts" in turns.columns else text_parts(turns["text"])
    seen = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
        F.transform(F.coalesce(parts, F.array().cast(PARTS)), visitor.visit).alias("seen"),
    )
    text = lambda p: p["kind"] == "text"
    # each piece with the separator before it: two texts in a row would else run together
    before = F.transform("seen", lambda p, i: F.when((i > 0) & text(p) & text(F.get("seen", i - 1)), F.lit(PART)).otherwise(F.lit("")))
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SAYS))
    pieces = seen.withColumns({"before": before, "head": head})
    zero = F.struct(F.length("head").alias("at"), F.expr("cast(array() AS array<struct<start: int, length: int>>)").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start, n = acc["at"] + F.length(x["before"]), F.length(x["seen"]["piece"])
        span = F.array(F.struct(start.alias("start"), n.alias("length")))
        return F.struct((start + n).alias("at"), F.when(text(x["seen"]), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(F.arrays_zip("before", "seen"), zero, step, lambda acc: acc["spans"])
    body = F.array_join(F.transform(F.arrays_zip("before", "seen"), lambda x: F.concat(x["before"], x["seen"]["piece"])), "")
    files = F.transform(F.filter("seen", lambda p: p["kind"] != "text"), lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))
    return pieces.select(
        "conv_id",
        "turn",
        F.concat("head", body, F.lit(END)).alias("formatted"),
        F.when(F.col("role") == trained_role, spans).otherwise(F.expr("cast(array() AS array<struct<start: int, length: int>>)")).alias("loss"),
        files.alias("attachments"),
        F.aggregate("seen", F.lit(0).cast("long"), lambda n, p: n + p["tokens"]).alias("n_tokens"),
    )


def conversations(rendered: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss, attachments, n_tokens.

    Spans are moved to the conversation's text.  A conversation becomes one value and must fit one; longer ones stay
    as the turns that :func:`render_turns` gives, which :func:`read_back` reads as a stream.
    """
    turns = F.sort_array(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("t"), "formatted", "loss", "attachments", "n_tokens")))
    got = rendered.groupBy("conv_id").agg(turns.alias("turns"))
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<struct<start: int, length: int>>)").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        moved = F.transform(x["loss"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), s["length"].alias("length")))
        return F.struct((acc["at"] + F.length(x["formatted"])).alias("at"), F.concat(acc["spans"], moved).alias("spans"))

    return got.select(
        "conv_id",
        F.array_join("turns.formatted", "").alias("formatted"),
        F.aggregate("turns", zero, step, lambda acc: acc["spans"]).alias("loss"),
        F.flatten("turns.attachments").alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["n_tokens"]).alias("n_tokens"),
    )


_READ = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(END), re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document|part)\|>")


def read_turns(formatted: str) -> list[tuple[str, list[str]]]:
    """(role, its texts) of each turn of a formatted text."""
    return [(unescaped(role), [unescaped(t) for t in _PLACEHOLDER.split(content)]) for role, content in _READ.findall(formatted)]


def _read(batches):
    """Digests of conversations from their turns in order: holds one turn and the digests, however long a conversation is."""
    now, got = object(), None
    keys = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def closed(done):
        rows = [(c, n, a.hexdigest(), m, b.hexdigest(), w) for c, n, a, m, b, w in done]
        return pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(6)], list(keys))

    for batch in batches:
        done = []
        for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True):
            if conv != now or got is None:
                if got is not None:
                    done.append(got)
                now, got = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, texts in read_turns(formatted):
                got[1] += 1
                got[2].update(f"{role}\n{''.join(texts)}\n".encode())
            for span in loss:
                text = unescaped(formatted[span["start"] : span["start"] + span["length"]])
                got[3] += len(text)
                got[4].update(text.encode())
            got[5] += len(formatted)
        if done:
            yield closed(done)
    if got is not None:
        yield closed([got])


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from formatted texts and loss spans alone."""
    ordered = rendered.select("conv_id", "turn", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


#: A conversation of control strings, for the round trip.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text")
    )
    return read_back(render_turns(given.unionByName(control)))
