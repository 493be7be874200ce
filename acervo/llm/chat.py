"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn becomes ``<s>[ROLE]role[/ROLE]text</s>``; inside roles and texts ``\\``,
``<`` and ``[`` are written ``\\0``, ``\\1`` and ``\\2``, so no control string can
occur there and the text can be read back. A turn costs its words and
``TURN_COST`` tokens for its marks.

Windows are cut by prefix sums: a conversation's turns (but for its leading
system turns) are laid end to end, and a turn belongs to the window in whose
span of ``unit`` tokens it begins, with ``unit`` half of what the budget leaves
besides history. A window is thus within the budget unless one of its turns is
longer than ``unit``; turns are never cut. Each window starts with the leading
system turns, which count on top of the budget, then repeats the turns that
begin at most ``history`` tokens before its first own turn. Only own assistant
turns are under the loss mask, so each target counts once.

Prefix sums do not gather a conversation in one task: turns are dealt by
conversation and stretch of turn numbers, summed there, and the stretches'
totals are summed in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from acervo.llm.common import stored

BUDGET, HISTORY = 1024, 256
TURN_COST = 4
OPEN, MIDDLE, CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"
STRETCH = 64  # turn numbers that are summed in one task


def escaped(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for mark, code in (("\\", "\\0"), ("<", "\\1"), ("[", "\\2")):
        out = F.replace(out, F.lit(mark), F.lit(code))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for mark, code in (("[", "\\2"), ("<", "\\1"), ("\\", "\\0")):
        out = F.replace(out, F.lit(code), F.lit(mark))
    return out


def numbered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with their tokens and marks, stored; rows of equal turn number are ordered by role and text."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 40))).cast("long").alias("stretch"),
        (words + TURN_COST).cast("long").alias("tokens"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``lead`` (a leading system turn) and ``before``: tokens of the turns before that are not leading."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    by_stretch = ["conv_id", "stretch"]
    # Where the first turn of another role is; all before it are leading.
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn", "role", "text", "row")
    local = rows.groupBy(*by_stretch).agg(F.min(F.when(F.col("role") != "system", place)).alias("own"))
    first = local.groupBy("conv_id").agg(F.min("own").alias("first"))
    keyed = rows.withColumn("place", place)
    keyed = keyed.join(first.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    keyed = keyed.withColumn("lead", F.col("first").isNull() | (F.col("place") < F.col("first"))).drop("first", "place")
    counted = F.when(F.col("lead"), 0).otherwise(F.col("tokens"))
    inside = Window.partitionBy(*by_stretch).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy(*by_stretch).agg(F.sum(counted).alias("total"))
    across = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), F.coalesce(F.sum("total").over(across), F.lit(0)).alias("offset"))
    local = keyed.withColumn("within", F.coalesce(F.sum(counted).over(inside), F.lit(0)))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s"))
    return local.join(sums, same).withColumn("before", F.col("within") + F.col("offset")).drop("c", "s", "within", "offset")


def windows(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """``(conv_id, window, formatted, repeated, own_turns, loss_spans)``, one row per window.

    ``repeated`` turns at the head are not new there. ``loss_spans`` are
    ``(start, length)`` in code points of ``formatted``. A null role or text is
    empty. Rows of equal conversation and turn number are all kept, ordered by
    role and text; a null conversation is one of its own, and a null turn number
    comes first. Other columns are not read.
    """
    unit = max((budget - history) // 2, 1)
    history = min(history, unit)
    rows = stored(placed(stored(numbered(turns, conv_id, turn, role, text), "chat-turns", "zstd")), "chat-places", "zstd")
    own = rows.withColumn("window", F.when(F.col("lead"), 0).otherwise(F.floor(F.col("before") / unit)).cast("long"))

    # Windows that have own turns, where they start, and the window before each.
    starts = own.groupBy("conv_id", "window").agg(F.min(F.when(~F.col("lead"), F.col("before"))).alias("start"))
    line = Window.partitionBy("conv_id").orderBy("window")
    starts = starts.select("conv_id", "window", "start", F.lead("window").over(line).alias("next"), F.lead("start").over(line).alias("next_start"))
    starts = stored(starts, "chat-windows")
    heads = starts.select(F.col("conv_id").alias("c"), F.col("window").alias("w"), "next", "next_start")
    here = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("window") == F.col("w"))
    near = own.filter(~F.col("lead")).join(heads.filter("next is not null"), here)
    near = near.filter(F.col("next_start") - F.col("before") <= history)

    columns = ["conv_id", "window", "kind", "turn", "role", "text", "row"]
    first = own.withColumn("kind", F.when(F.col("lead"), 0).otherwise(2))
    again = near.withColumn("window", F.col("next")).withColumn("kind", F.lit(1))
    others = starts.filter("window > 0").select(F.col("conv_id").alias("c"), F.col("window").alias("w"))
    system = own.filter("lead").drop("window").join(others, F.col("conv_id").eqNullSafe(F.col("c")))
    system = system.withColumn("window", F.col("w")).withColumn("kind", F.lit(0))
    all_rows = first.select(*columns).unionByName(again.select(*columns)).unionByName(system.select(*columns))

    is_new = (F.col("kind") == 2) | ((F.col("window") == 0) & (F.col("kind") == 0))
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    entry = F.struct(
        "kind",
        F.col("turn").isNotNull().alias("some"),
        "turn",
        "role",
        "text",
        "row",
        F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.length(head).cast("long").alias("head"),
        F.length(body).cast("long").alias("body"),
        is_new.alias("new"),
        ((F.col("kind") == 2) & (F.col("role") == "assistant")).alias("target"),
    )
    gathered = all_rows.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    turns_of = F.col("turns")
    at = F.aggregate(
        turns_of,
        F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["end"] + F.length(t["formatted"])).alias("end"),
            F.when(t["target"], F.concat(acc["spans"], F.array(F.struct((acc["end"] + t["head"]).alias("start"), t["body"].alias("length")))))
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return gathered.select(
        "conv_id",
        "window",
        F.array_join(turns_of["formatted"], "").alias("formatted"),
        F.size(F.filter(turns_of, lambda t: ~t["new"])).alias("repeated"),
        F.size(F.filter(turns_of, lambda t: t["new"])).alias("own_turns"),
        at.alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from the windows' texts alone."""
    pieces = F.slice(F.split("formatted", CLOSE, -1), F.col("repeated") + 1, F.col("own_turns"))

    def told(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece)), MIDDLE, 1)
        text = F.substring(piece, F.length(role) + len(OPEN) + len(MIDDLE) + 1, F.length(piece))
        return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    target = F.transform("loss_spans", lambda s: unescaped(F.substring("formatted", s["start"].cast("int") + 1, s["length"].cast("int"))))
    own = formatted.select(
        "conv_id",
        "window",
        F.size(pieces).cast("long").alias("n"),
        F.array_join(F.transform(pieces, told), "").alias("told"),
        F.array_join(target, "").alias("target"),
        F.length("formatted").cast("long").alias("chars"),
    )
    part = F.sort_array(F.collect_list(F.struct("window", "told", "target")))
    whole = own.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), part.alias("parts"))
    target = F.array_join(F.col("parts")["target"], "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("parts")["told"], ""), 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"),
        F.sha2(target, 256).alias("loss_sha256"),
        "formatted_chars",
    )
