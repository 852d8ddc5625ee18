"""Chat formatting in budgeted windows, in DataFrame operations alone.

A turn is written as `<|turn|>role\\ntext<|end|>\\n`. Inside roles and texts `&`, `<` and `[` are escaped (and line
ends inside roles), so that no control string between such brackets survives in them, of this template or of another, and
unescaping gives back every text. Windows are runs of whole turns within a token budget, chosen on prefix sums of
the turns' tokens: each window holds the conversation's system turn, the latest earlier turns that fit the
history limit, and then new turns. Only the assistant texts among the new turns bear loss: system turn and
history repeat earlier turns, and their targets are masked. mask lists the ranges that bear loss. A turn longer than the budget
gets a window of its own, whole.

Turns are grouped by conversation and block of BLOCK turn numbers, so that a long conversation is not one group;
a window ends where its block ends, and the next one begins with history from the blocks before.

Defined results: a null text or role is an empty one; null turn numbers sort first, by a hash of role and text; rows that repeat a
turn number are kept, ordered by role and text, in one block; rows with a null conv_id form one conversation; a conversation's
first turn, whatever its number, is the system turn if its role is `system`, others are ordinary. An empty table gives an empty result.
Very long texts are one turn, whole. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

#: Tokens in a window, and those of them that history may take.
BUDGET, HISTORY = 512, 128
#: Turn numbers that are formatted together, and groups of turns without a number.
BLOCK, UNNUMBERED = 1024, 1024
START, END = "<|turn|>", "<|end|>\n"
#: Tokens are runs of word characters of any script and single other characters; the template costs so many more a turn.
TOKEN, TURN_COST = r"(?U)\w+|[^\w\s]", 4


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&lsqb;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lsqb;"), F.lit("[")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def _pieces(turns: Column) -> Column:
    """Each turn as it is written: what stands before its text, and its text."""
    return F.transform(turns, lambda t: F.struct(F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("said"), (t["role"] == "assistant").alias("target")))


def _mask(pieces: Column, lead: Column) -> Column:
    """Ranges (start, end) of the characters that bear loss: the assistant texts after the first `lead` turns."""
    spans = F.array().cast("array<struct<start:long,end:long>>")
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("i"), spans.alias("spans"))

    def step(s: Column, p: Column) -> Column:
        start = s["at"] + F.length(p["head"])
        end = start + F.length(p["said"])
        span = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))
        return F.struct((end + len(END)).cast("long").alias("at"), (s["i"] + 1).alias("i"), F.when(p["target"] & (s["i"] >= lead), F.array_append(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(pieces, begin, step, lambda s: s["spans"])


def _blocks(conversations: DataFrame, history: int, block: int) -> DataFrame:
    """conv_id, block and turns: before is the tokens of the block's turns before; back and from_ say which earlier turns of the block fit the history limit."""
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    unnumbered = F.pmod(F.xxhash64("role", "text"), F.lit(UNNUMBERED)) - (1 << 60)
    rows = rows.withColumn("block", F.when(F.col("turn").isNull(), unnumbered).otherwise(F.floor(F.col("turn") / block)))
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + TURN_COST)
    own = W.partitionBy("conv_id", "block")
    order = own.orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = rows.withColumn("before", F.coalesce(F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    fits = own.orderBy("before").rangeBetween(-history, -1)
    rows = rows.withColumn("back", F.count("*").over(fits)).withColumn("from_", F.coalesce(F.min("before").over(fits), F.col("before")))
    return rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("before", "turn", "role", "text", "tokens", "back", "from_"))).alias("turns"))


def format_conversations(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, block: int = BLOCK) -> DataFrame:
    """A row for each window: conv_id, block, window, formatted, mask (ranges of formatted that bear loss), lead (system and history turns in it), n_turns (in it), first (it begins with the system turn as a new one)."""
    grouped = _blocks(conversations, history, block)
    opening = F.get("turns", F.lit(0))
    # a row for each block, then for each conversation, of those whose first turn is a system turn
    leads = grouped.select("conv_id", "block", F.when(opening["role"] == "system", opening).alias("opening")).groupBy("conv_id").agg(F.min(F.struct("block", "opening")).alias("lead"))
    leads = leads.filter("lead.opening is not null").select(F.col("conv_id").alias("s_id"), F.col("lead.block").alias("s_block"), F.col("lead.opening").alias("system"))
    blocks = grouped.join(leads, F.col("conv_id").eqNullSafe(F.col("s_id")), "left").drop("s_id")
    opens = F.col("system").isNotNull() & (F.col("block") == F.col("s_block"))
    blocks = blocks.withColumn("own", F.when(opens, F.slice("turns", 2, F.greatest(F.size("turns") - 1, F.lit(0)))).otherwise(F.col("turns"))).withColumn("first", opens).drop("turns", "s_block")
    # the last turns of a block within the history limit, and from them what the next blocks begin with. A turn costs TURN_COST at least.
    slim = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["tokens"].cast("long").alias("tokens"))
    last = F.element_at("own", -1)
    full = F.when(F.size("own") > 0, last["before"] + last["tokens"]).otherwise(0)
    tail = F.transform(F.filter("own", lambda t: full - t["before"] <= history), slim)
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(-(history // TURN_COST + 1), -1)
    tails = blocks.select(F.col("conv_id").alias("t_id"), F.col("block").alias("t_block"), tail.alias("tail"), (full - F.coalesce(F.get("own", F.lit(0))["before"], F.lit(0)) <= history).alias("whole"))
    before = F.col("before")
    # of earlier blocks, those behind one that did not fit as a whole do not count
    reach = F.aggregate(F.reverse(before), F.struct(F.lit(True).alias("goes"), F.slice(F.flatten(F.transform(before, lambda b: b["tail"])), 1, 0).alias("turns")), lambda s, b: F.struct((s["goes"] & b["whole"]).alias("goes"), F.when(s["goes"], F.concat(b["tail"], s["turns"])).otherwise(s["turns"]).alias("turns")), lambda s: s["turns"])
    tails = tails.withColumnRenamed("t_id", "conv_id").withColumnRenamed("t_block", "block").withColumn("before", F.collect_list(F.struct("tail", "whole")).over(earlier)).select(F.col("conv_id").alias("t_id"), F.col("block").alias("t_block"), reach.alias("earlier"))
    total = F.aggregate("earlier", F.lit(0).cast("long"), lambda s, t: s + t["tokens"])
    # their prefix sums end at 0, where the block begins; those that do not fit together go
    counted = F.aggregate("earlier", F.struct((-total).alias("at"), F.transform(F.slice("earlier", 1, 0), lambda t: F.struct(F.lit(0).cast("long").alias("before"), t["role"].alias("role"), t["text"].alias("text"))).alias("turns")), lambda s, t: F.struct((s["at"] + t["tokens"]).alias("at"), F.array_append(s["turns"], F.struct(s["at"].alias("before"), t["role"].alias("role"), t["text"].alias("text"))).alias("turns")), lambda s: s["turns"])
    tails = tails.withColumn("carried", counted).select("t_id", "t_block", F.filter("carried", lambda t: t["before"] >= -history).alias("carried"))
    blocks = blocks.join(tails, F.col("conv_id").eqNullSafe(F.col("t_id")) & (F.col("block") == F.col("t_block"))).drop("t_id", "t_block")
    base = F.when(F.col("first"), F.col("system")["tokens"].cast("long")).otherwise(F.lit(-(1 << 50)))
    room = F.lit(budget) - F.coalesce(F.col("system")["tokens"], F.lit(0))
    # a window is (h, i, j): history turns h..i-1, new turns i..j-1 of carried and own turns; at is the tokens before h. The next one starts at j.

    def window(h: Column, i: Column, j: Column, at: Column) -> Column:
        return F.struct(h.cast("long").alias("h"), i.cast("long").alias("i"), j.cast("long").alias("j"), at.cast("long").alias("at"))

    def extend(windows: Column, x: Column) -> Column:
        """Turn x joins the last window if that stays in the budget, else it starts another, with what history leaves it room."""
        last = F.element_at(windows, -1)
        t, end = last["j"], x["before"] + x["tokens"]
        more = F.filter("carried", lambda c: c["before"] >= x["before"] - history)
        at = F.greatest(F.coalesce(F.get(more, F.lit(0))["before"], x["from_"]), base)
        remembers = end - at <= room
        fresh = window(F.when(remembers, F.greatest(t - x["back"] - F.size(more), F.lit(0))).otherwise(t), t, t + 1, F.when(remembers, at).otherwise(x["before"]))
        grown = F.concat(F.slice(windows, 1, F.size(windows) - 1), F.array(window(last["h"], last["i"], t + 1, last["at"])))
        return F.when(last["j"] == last["i"], F.array(fresh)).when(end - last["at"] <= room, grown).otherwise(F.array_append(windows, fresh))

    n = F.size("carried")
    windows = F.aggregate("own", F.array(window(n, n, n, F.lit(0))), extend)
    blocks = blocks.withColumn("windows", windows).withColumn("body", F.concat("carried", F.transform("own", lambda t: F.struct(t["before"].cast("long").alias("before"), t["role"].alias("role"), t["text"].alias("text")))))
    each = blocks.select("conv_id", "block", "system", "body", "first", F.posexplode("windows").alias("window", "w"))
    has = F.col("system").isNotNull()
    head = F.when(has, F.array(F.struct(F.lit(0).cast("long").alias("before"), F.col("system")["role"].alias("role"), F.col("system")["text"].alias("text")))).otherwise(F.slice("body", 1, 0))
    turns = F.concat(head, F.slice("body", (F.col("w.h") + 1).cast("int"), (F.col("w.j") - F.col("w.h")).cast("int")))
    each = each.select("conv_id", "block", "window", _pieces(turns).alias("pieces"), (has.cast("int") + F.col("w.i") - F.col("w.h")).alias("lead"), (F.col("first") & (F.col("window") == 0)).alias("first"))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["said"], F.lit(END))), "")
    return each.select("conv_id", "block", "window", text.alias("formatted"), _mask(F.col("pieces"), F.col("lead")).alias("mask"), "lead", F.size("pieces").alias("n_turns"), "first")


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, block, window, turns (each turn of the conversation once: role and text) and targets (the texts under the mask), parsed from the formatted windows."""
    parts = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda p: p != "")
    said = F.transform(parts, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    turns = F.transform(said, lambda p: F.struct(_unescape_role(F.substring(p, F.lit(1), F.instr(p, "\n") - 1)).alias("role"), unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p))).alias("text")))
    # the system turn counts in the first window only, history never
    fresh = F.filter(turns, lambda t, i: (i >= F.col("lead")) | (F.col("first") & (i == 0)))
    targets = F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    return windows.select("conv_id", "block", "window", fresh.alias("turns"), targets.alias("targets"), F.length("formatted").cast("long").alias("chars"))


def digest(windows: DataFrame) -> DataFrame:
    """What each conversation's formatted windows say, as counts and hashes."""
    rows = read_back(windows)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = rows.select("conv_id", "block", "window", said.alias("said"), F.array_join("targets", "").alias("loss"), F.size("turns").alias("n"), "chars")
    found = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "window", "said", "loss"))).alias("parts"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    whole = F.array_join(F.transform("parts", lambda p: p["said"]), "")
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return found.select("conv_id", "n_turns", F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digest(format_conversations(rows.unionByName(probe)))
