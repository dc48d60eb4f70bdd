"""Chat formatting: every participant's view of a dialogue, with DataFrame functions only.

For each participant the dialogue is rendered with that speaker as ``assistant`` and all others as
named users; speakers in ``context_roles`` (system prompts) stay as they are and get no view of
their own. The mask marks what is learned in that view: the assistant's content and its end mark.

A dialogue is rendered in parts of consecutive turn numbers (``turn div turns_per_part``), one row a
part, so an ordinary dialogue is one row. Turn numbers that repeat, null turns and null dialogue ids can
make a part of any size. A part of more than ``PIECE_BYTES`` is therefore cut into pieces in the order of
its turns, each a row with a rendering and spans of its own; pieces 0, 1, 2 ... of a part joined give its
text. Order and cuts come from a range sort with the sizes of the ranges before, so neither a dialogue nor
a part has to fit into a row or a task. The speakers are joined as rows.

Turns are ordered by number, then speaker, then text; repeated rows are rendered as often as they
stand. A null text is empty content, a null speaker is the user ``unknown`` without a view, null turns
come first, in a part of their own; rows with a null dialogue id form one dialogue. Dialogues of
context turns only have no view and no row. Control marks inside content lose their bar, so that
content cannot end a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from centroidal.llm.frames import written

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS_PER_PART = 512
#: Bytes of text in a piece, a turn counting TURN_BYTES besides; a piece holds less than twice this, or one turn.
PIECE_BYTES, TURN_BYTES = 32 << 20, 512
#: Characters of speaker and text by which ranges are cut (the driver samples these); inside a range both count in full.
RANGE_CHARS = 256


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< ")), F.lit("|>"), F.lit(" >"))


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Equal keys; null ids are a dialogue of their own, hence null-safe."""
    on = [a[n].eqNullSafe(b[n]) for n in names]
    return on[0] if len(on) == 1 else on[0] & _same(a, b, *names[1:])


def _cut(rows: DataFrame, piece_bytes: int) -> DataFrame:
    """``rows`` (of parts too large for a row) with their ``piece``. Repeated rows are one row with a count
    until the pieces are known, in chunks that fit into a piece."""
    key = ["conv_id", "part", "turn", "who", "text"]
    per = F.greatest(F.lit(1), F.floor(F.lit(piece_bytes) / F.col("bytes"))).cast("long")
    chunks = rows.groupBy(*key, "bytes").agg(F.count(F.lit(1)).alias("copies")).withColumn("per", per) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.col("per"))))) \
        .select(*key, "chunk", F.least("per", F.col("copies") - F.col("chunk") * F.col("per")).alias("n"), "bytes")
    ranged = chunks.withColumn("whos", F.substring("who", 1, RANGE_CHARS)).withColumn("texts", F.substring("text", 1, RANGE_CHARS)) \
        .repartitionByRange("conv_id", "part", "turn", "whos", "texts").sortWithinPartitions(*key, "chunk") \
        .select(*key, "n", (F.col("n") * F.col("bytes")).alias("size"), F.spark_partition_id().alias("range"),
                F.monotonically_increasing_id().alias("at"))
    ranged = written(rows.sparkSession, ranged, "chat-ranges")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("conv_id", "part", "range").agg(F.sum("size").alias("size"))
    totals = totals.select("conv_id", "part", "range", F.coalesce(
        F.sum("size").over(earlier.partitionBy("conv_id", "part").orderBy("range")), F.lit(0)).alias("offset"))
    local = ranged.withColumn("before", F.coalesce(
        F.sum("size").over(earlier.partitionBy("range", "conv_id", "part").orderBy("at")), F.lit(0)))
    # one row a range and part that it touches
    placed = local.join(F.broadcast(totals), _same(local, totals, "conv_id", "part", "range")) \
        .select(*(local[c] for c in key), local["n"], F.floor((F.col("offset") + F.col("before")) / piece_bytes).cast("long").alias("piece"))
    return placed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(*key, "piece")


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
                 text_col: str = "text", context_roles: tuple[str, ...] = ("system",),
                 turns_per_part: int = TURNS_PER_PART, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per dialogue, participant, part and piece: ``conv_id, perspective, part, piece, n_turns,
    rendered, mask, n_masked``. ``piece`` is 0 for every part of up to ``piece_bytes``.

    ``mask``: array of ``struct<start, end>``, the learned character spans of ``rendered`` in order
    (code points, end exclusive); ``n_masked``: their total length.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(speaker_col).cast("string").alias("who"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / turns_per_part), F.lit(-1)).cast("long")) \
        .withColumn("bytes", F.octet_length("text").cast("long") + F.coalesce(F.octet_length("who"), F.lit(0)) + TURN_BYTES)

    def is_context(who: Column) -> Column:
        return F.coalesce(who.isin(*context_roles), F.lit(False))

    def name(who: Column) -> Column:
        return _escaped(F.coalesce(who, F.lit("unknown")))

    # few: each has more than piece_bytes of the input
    large = written(turns.sparkSession, rows.groupBy("conv_id", "part").agg(F.sum("bytes").alias("size"))
                    .filter(F.col("size") > piece_bytes).select("conv_id", "part"), "chat-large")
    on = _same(rows, large, "conv_id", "part")
    whole = rows.join(F.broadcast(large), on, "left_anti").select("conv_id", "part", "turn", "who", "text", F.lit(0).cast("long").alias("piece"))
    cut = _cut(rows.join(F.broadcast(large), on, "left_semi"), piece_bytes)

    # the turns of a piece, each with the length of those before it as an outsider reads them
    plain = F.concat(F.lit(START), F.when(is_context(F.col("who")), name(F.col("who")))
                     .otherwise(F.concat(F.lit("user name="), name(F.col("who")))), F.lit("\n"))
    ordered = Window.partitionBy("conv_id", "part", "piece").orderBy("turn", "who", "text").rowsBetween(Window.unboundedPreceding, -1)
    lined = whole.unionByName(cut).withColumn("head", plain).withColumn("body", F.concat(_escaped(F.col("text")), F.lit(END))) \
        .withColumn("at", F.coalesce(F.sum(F.length("head") + F.length("body")).over(ordered), F.lit(0)).cast("long"))
    # "at" grows from turn to turn, as no turn is empty
    parts = lined.groupBy("conv_id", "part", "piece").agg(
        F.sort_array(F.collect_list(F.struct("at", "who", "head", "body"))).alias("turns"))
    speakers = rows.filter(F.col("who").isNotNull() & ~is_context(F.col("who"))).select("conv_id", F.col("who").alias("perspective")).distinct()
    viewed = parts.join(speakers, _same(parts, speakers, "conv_id")).select(parts["conv_id"], "perspective", "part", "piece", "turns")

    me = F.col("perspective")
    own_head = F.lit(f"{START}assistant\n")
    shorter = F.length(F.concat(F.lit("user name="), name(me))) - F.length(F.lit("assistant"))
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(
        F.when(t["who"].eqNullSafe(me), own_head).otherwise(t["head"]), t["body"])), "")
    mine = F.filter("turns", lambda t: t["who"].eqNullSafe(me))

    def span(t: Column, earlier: Column) -> Column:
        start = t["at"] - earlier * shorter + F.length(own_head)
        return F.struct(start.cast("long").alias("start"), (start + F.length(t["body"])).cast("long").alias("end"))

    masked = F.aggregate("turns", F.lit(0).cast("long"),
                         lambda a, t: a + F.when(t["who"].eqNullSafe(me), F.length(t["body"])).otherwise(0).cast("long"))
    return viewed.select("conv_id", "perspective", "part", "piece", F.size("turns").cast("long").alias("n_turns"), rendered.alias("rendered"),
                         F.transform(mine, span).alias("mask"), masked.alias("n_masked"))
