"""Repair of conversations: the cheapest edits that make a conversation's turns follow the grammar ``(s?(ua)+)?``.

For each cost in turn, bitsets tell the grammar's states from which the rest of a conversation can be accepted at that
cost (Wu-Manber's layers, one bit a state); the first layer that has the start state gives the cost, and the bits of the
layers below give the least audit.  Many conversations are worked on at once, as arrays.

Conversations of more than SEGMENT rows are cut into segments: each one's least costs between states are a 4 x 4 matrix,
and minimum-plus products of those, block by block, give every segment the costs behind it and then its first state.
So no task sees a whole long conversation; only its audit, and the repaired text for who hashes it, are one cell or
one stream, as a conversation has one.

Results for the odd cases: a null role or text is one space; rows of one turn are taken by role, then text; a null turn
comes first and makes no gap; rows without a conversation's id are a conversation; a role that begins with none of s, u,
a can't be kept; a conversation without rows needs no edits; an empty table gives an empty result; further columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, join_hot, released, sliced, table

#: Costs: Rerole, Insert and a truncated row that stays; Delete.
CHANGE, DELETE = 3, 4
#: Rows of a segment as a power of two, and segments of a block.
SEGMENT, BLOCK = 6, 10
FAR = 1 << 40
START, AFTER_S, AFTER_U, AFTER_A = range(4)
INITIALS = {"s": 1, "u": 2, "a": 3}
ROLES = {"u": "user", "a": "assistant"}
#: What it costs to end in each state: nothing where the grammar accepts, else the missing turns.
ENDING = (0, 2 * CHANGE, CHANGE, 0)
#: The state after the only turn that can be inserted, and the missing turns' initials.
INSERTED, MISSING = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U]), ("", "ua", "a", "")
#: The state after a kept row of initial 1 to 3, -1 for none.
KEPT = np.array([[-1, AFTER_S, AFTER_U, -1], [-1, -1, AFTER_U, -1], [-1, -1, -1, AFTER_A], [-1, -1, AFTER_U, -1]])
#: A last state that costs so much more than the best one is on no cheapest path: at most two turns have to be inserted
#: to get from the best one wherever the other leads, and one deleted.
SLACK = 2 * CHANGE + DELETE
#: In a row's code: bits 0 and 1 the initial, MUST_GO for blanks and duplicates, CUT_OFF for truncated rows.
MUST_GO, CUT_OFF = 4, 8


def _before_s(x: np.ndarray) -> np.ndarray:
    """Sets of four bits, four of them in a number: the states that an s turns into one of the set."""
    return (x >> 1 & 0x1111) * np.uint16(1 << START)


def _before_u(x: np.ndarray) -> np.ndarray:
    return (x >> 2 & 0x1111) * np.uint16(1 << START | 1 << AFTER_S | 1 << AFTER_A)


def _before_a(x: np.ndarray) -> np.ndarray:
    return (x >> 3 & 0x1111) * np.uint16(1 << AFTER_U)


class Layers:
    """Layers of a batch of row codes (as many columns as the longest has, -1 before a shorter one's rows).

    ``layers[c][i]`` has the states from which the rows from column i on lead to an end at cost c at most.
    ``ends`` has the cost of ending in each state, for each row of the batch; without it four sets stand in a
    number, one for each last state.
    """

    def __init__(self, codes: np.ndarray, ends: np.ndarray | None, wanted: int):
        self.pad, self.may = (codes < 0).T, ((codes >= 0) & (codes & MUST_GO == 0)).T
        self.late, self.kind = ((codes >= 0) & (codes & CUT_OFF > 0)).T, np.where(codes < 0, 0, codes & 3).T
        full = lambda c: np.where(c, np.uint16(0xFFFF), np.uint16(0))
        may, s, u, a = full(self.may), *(full(self.kind == k) for k in (1, 2, 3))
        width, n = codes.shape[1], len(codes)
        none, some = np.zeros((width + 1, n), np.uint16), np.zeros(n, np.int64)
        at = lambda c: self.layers[c] if c >= 0 else none
        self.layers: list[np.ndarray] = []
        rest = None
        for c in range(DELETE * width + SLACK + 3 * CHANGE + 1):
            now = np.zeros((width + 1, n), np.uint16)
            now[width] = 0x8421 if ends is None else ((ends <= c) << np.arange(4)).sum(1)
            three, six, four = at(c - CHANGE), at(c - 2 * CHANGE), at(c - DELETE)
            for i in range(width - 1, -1, -1):
                k = np.where(self.late[i], three[i + 1], now[i + 1])
                r = np.where(self.late[i], six[i + 1], three[i + 1])
                stays = _before_s(k) & s[i] | _before_u(k) & u[i] | _before_a(k) & a[i] | _before_u(r) | _before_a(r)
                now[i] = np.where(self.pad[i], now[i + 1], four[i + 1] | may[i] & stays | _before_u(three[i]) | _before_a(three[i]))
            self.layers.append(now)
            first = now[0] | now[0] >> 4 | now[0] >> 8 | now[0] >> 12 if ends is None else now[0]
            if (first & wanted == wanted).all():
                if ends is not None:
                    break
                rest = SLACK if rest is None else rest - 1
                if rest == 0:
                    break

    def cost(self, bit: np.ndarray, column: np.ndarray | int = 0) -> np.ndarray:
        """The first layer that has the bit in the column, for each row of the batch; FAR if none has."""
        rows, found = np.arange(len(bit)), np.full(len(bit), FAR)
        for c in range(len(self.layers) - 1, -1, -1):
            found[(self.layers[c][column, rows] >> bit & 1).astype(bool)] = c
        return found

    def trace(self, start: int) -> tuple[np.ndarray, list[str], np.ndarray]:
        """(cost, the least audit, last state) from a start state."""
        layers, n, width = np.stack(self.layers), self.pad.shape[1], self.pad.shape[0]
        rows = np.arange(n)
        state, i, cost = np.full(n, start), self.pad.sum(0), self.cost(np.full(n, start))
        left, steps = cost.copy(), []
        has = lambda c, i, s: (c >= 0) & (s >= 0) & (layers[np.maximum(c, 0), i, rows] >> np.maximum(s, 0) & 1).astype(bool)
        while (i < width).any():
            on = i < width
            at, after = np.minimum(i, width - 1), np.minimum(i + 1, width)
            late = CHANGE * self.late[at, rows]
            other, kept = INSERTED[state], np.where(self.may[at, rows], KEPT[state, self.kind[at, rows]], -1)
            ways = [(DELETE + 0 * left, after, state), (CHANGE + 0 * left, at, other), (late, after, kept), (late + CHANGE, after, np.where(self.may[at, rows], other, -1))]
            step = np.select([has(left - c, j, s) for c, j, s in ways], [0, 1, 2, 3], -1)
            if (on & (step < 0)).any():
                raise AssertionError("a path left the layers")
            for k, (c, j, s) in enumerate(ways):
                mine = on & (step == k)
                left, i, state = np.where(mine, left - c, left), np.where(mine, j, i), np.where(mine, s, state)
            steps.append(np.where(on, step, -1))
        audits = ["".join("DIKR"[k] for k in column if k >= 0) for column in np.array(steps).reshape(len(steps), n).T.tolist()]
        return cost, audits, state


def _padded(lists: list[list[int]]) -> np.ndarray:
    width = max(map(len, lists), default=0)
    out = np.full((len(lists), width), -1, dtype=np.int64)
    for row, codes in zip(out, lists, strict=True):
        row[width - len(codes) :] = codes
    return out


def _by_length(lists: list[list[int]]):
    """Places of lists that are about as long as each other."""
    length = np.array([max(len(x) - 1, 0).bit_length() for x in lists])
    for size in np.unique(length):
        yield np.flatnonzero(length == size)


def unfold(codes: list[int], audit: str, state: int) -> tuple[list[tuple[str, str, str]], str]:
    """((initials inserted before, edit, new initial) for each row of a segment, initials inserted behind the last)."""
    rows, before = [], ""
    for step in audit:
        other = "a" if state == AFTER_U else "u"
        if step == "I":
            before, state = before + other, int(INSERTED[state])
            continue
        code = codes[len(rows)]
        rows.append((before, step, other if step == "R" else ""))
        before, state = "", {"K": int(KEPT[state][code & 3]), "R": int(INSERTED[state]), "D": state}[step]
    return rows, before


TRACED = "ck string, seg long, entry int, last_state int, cost long, audit string"


def _short(batches):
    """Whole conversations in one segment: cost and audit."""
    for batch in batches:
        lists = batch.column("codes").to_pylist()
        cost, audits = np.zeros(len(lists), np.int64), [""] * len(lists)
        for mine in _by_length(lists):
            codes = _padded([lists[k] for k in mine])
            c, texts, state = Layers(codes, np.tile(np.array(ENDING), (len(mine), 1)), 1 << START).trace(START)
            cost[mine] = c
            for k, text, s in zip(mine, texts, state, strict=True):
                audits[k] = text + "I" * len(MISSING[s])
        n = pa.array(np.zeros(len(lists), np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("ck"), batch.column("seg"), n, n, pa.array(cost), pa.array(audits, pa.string())], [x.split()[0] for x in TRACED.split(", ")])


def _matrices(batches):
    """The least costs from each state to each other of segments, entry by entry."""
    for batch in batches:
        lists = batch.column("codes").to_pylist()
        out = np.full((len(lists), 4, 4), FAR)
        for mine in _by_length(lists):
            layers = Layers(_padded([lists[k] for k in mine]), None, 0b1111)
            for s in range(4):
                for e in range(4):
                    out[mine, s, e] = layers.cost(np.full(len(mine), 4 * e + s))
        yield pa.RecordBatch.from_arrays([batch.column("ck"), batch.column("seg"), pa.array(list(out.reshape(-1, 16)), pa.list_(pa.int64()))], ["ck", "seg", "m"])


def _long(batches):
    """Segments of long conversations with ``v``, the costs behind them: what follows from each first state."""
    for batch in batches:
        lists = batch.column("codes").to_pylist()
        behind, last = np.array(batch.column("v").to_pylist()), batch.column("is_last").to_pylist()
        for mine in _by_length(lists):
            ends = behind[mine] - behind[mine].min(1, keepdims=True)
            layers = Layers(_padded([lists[k] for k in mine]), ends, 0b1111)
            for s in range(4):
                cost, texts, state = layers.trace(s)
                cost = cost - np.where([last[k] for k in mine], 0, ends[np.arange(len(mine)), state])  # what the segment itself costs
                texts = [t + "I" * len(MISSING[e]) if last[k] else t for t, e, k in zip(texts, state, mine, strict=True)]
                take = pa.array(mine)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ck").take(take), batch.column("seg").take(take), pa.array(np.full(len(mine), s, np.int32)), pa.array(state.astype(np.int32)), pa.array(cost), pa.array(texts, pa.string())],
                    [x.split()[0] for x in TRACED.split(", ")],
                )


def scan(parts: DataFrame, start: tuple[int, ...], backwards: bool) -> DataFrame:
    """(ck, seg, v): the vector ``start`` taken through the matrices ``m`` (a row for each state before) of all segments
    of ck before seg, or behind it, by minimum-plus products.  Blocks of segments meet, then blocks of blocks."""

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        out = None
        for m in pdf.sort_values("seg")["m"]:
            m = np.array(m).reshape(4, 4)
            out = m if out is None else np.minimum((out[:, :, None] + m[None, :, :]).min(1), FAR)
        return pd.DataFrame({"ck": [pdf["ck"].iloc[0]], "seg": [pdf["seg"].iloc[0] >> BLOCK], "m": [out.ravel()]})

    def through(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seg", ascending=not backwards)
        v, out = np.array(pdf["v"].iloc[0]), []
        for m in pdf["m"]:
            m = np.array(m).reshape(4, 4)
            out.append(v)
            v = np.minimum((m + v[None, :]).min(1) if backwards else (v[:, None] + m).min(0), FAR)
        return pd.DataFrame({"ck": pdf["ck"].to_numpy(), "seg": pdf["seg"].to_numpy(), "v": out})

    block = F.shiftright("seg", BLOCK)
    levels = [parts.select("ck", "seg", "m")]
    while True:
        up = cut(levels[-1].groupBy("ck", block.alias("block")).applyInPandas(released(product), "ck string, seg long, m array<long>"), "turn-blocks")
        levels.append(up)
        if up.groupBy("ck").count().filter("count > 1").isEmpty():
            break
    v = up.select("ck", "seg", F.array(*[F.lit(x).cast("long") for x in start]).alias("v"))
    for level in levels[-2::-1]:
        above = v.select("ck", F.col("seg").alias("block"), "v")
        v = level.withColumn("block", block).join(above, ["ck", "block"]).select("ck", "block", "seg", "m", "v").groupBy("ck", "block").applyInPandas(released(through), "ck string, seg long, v array<long>")
    return v


def damage(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults put in by the checksum of conversation and turn; nulls are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20).alias("_how"))
    how = F.col("_how")
    text = F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter(how != 0).select("conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


class Repair:
    """Faults and cheapest repair of conversations (conv, turn, role, text)."""

    def __init__(self, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        conv = F.col(conv_col).cast("long")
        rows = turns.select(conv.alias("conv"), F.coalesce(conv.cast("string"), F.lit("")).alias("ck"), F.col(turn_col).cast("long").alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"))
        # In order, numbered: a number tells the task that sorted the row, and its place there.
        self.rows = cut(rows.orderBy("ck", "turn", "role", "text").withColumn("g", F.monotonically_increasing_id()), "turns")
        self.marks = cut(self._marked(), "turn-marks")
        self.traced, self.segments = self._solved()

    def _marked(self) -> DataFrame:
        """(ck, g, turn, code, blank, duplicate, truncated, illegal, n, begin, finish) of each row."""
        inside = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
        first = F.substring("role", 1, 1)
        initial = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in INITIALS.items() for x in kv]), first), F.lit(0))
        own = self.rows.select(
            "ck", "g", "turn", "role", F.sha2("text", 256).alias("_h"), first.alias("_i"), initial.alias("code"), (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
            (~F.substring(inside, -1, 1).isin(".", "!", "?")).alias("_open"),
        )
        firsts = own.groupBy("ck", "role", "_h").agg(F.min("g").alias("g")).select("g", F.lit(True).alias("_first"))
        own = own.join(firsts, "g", "left")
        # The row before: within a sorting task by a window, across two of them from a row for each task.
        task = F.shiftright("g", 33)
        ends = own.groupBy(task.alias("_task")).agg(F.max_by(F.struct("ck", "_i"), "g").alias("_end"))
        ends = ends.select("_task", F.lag("_end").over(Window.orderBy("_task")).alias("_end"))  # one row a task
        own = own.withColumn("_task", task).join(F.broadcast(ends), "_task")
        before = F.coalesce(F.lag(F.struct("ck", "_i")).over(Window.partitionBy("_task").orderBy("g")), F.col("_end"))
        own = own.withColumn("_pair", F.when(before["ck"] == F.col("ck"), F.concat(before["_i"], F.col("_i"))))
        duplicate = ~F.col("blank") & F.col("_first").isNull()
        truncated = ~F.col("blank") & ~duplicate & F.col("_open")
        code = F.col("code") + F.when(F.col("blank") | duplicate, MUST_GO).otherwise(0) + F.when(truncated, CUT_OFF).otherwise(0)
        own = own.select("ck", "g", "turn", code.cast("int").alias("code"), "blank", duplicate.alias("duplicate"), truncated.alias("truncated"), F.coalesce(~F.col("_pair").isin("su", "ua", "au"), F.lit(False)).alias("illegal"))
        sizes = own.groupBy("ck").agg(F.count("*").alias("n"), F.min("g").alias("begin"), F.max("g").alias("finish"))
        return join_hot(own, sizes, "ck", "n", self.rows.count()).select(*own.columns, "n", "begin", "finish")

    def _solved(self) -> tuple[DataFrame, DataFrame]:
        whole = F.col("n") <= 1 << SEGMENT
        seg = F.when(whole, F.shiftright("begin", SEGMENT)).otherwise(F.shiftright("g", SEGMENT))
        lists = self.marks.groupBy("ck", seg.alias("seg"), whole.alias("whole"), (F.shiftright("finish", SEGMENT) == seg).alias("is_last")).agg(F.sort_array(F.collect_list(F.struct("g", "code"))).alias("x"))
        segments = cut(lists.select("ck", "seg", "whole", F.col("is_last") | F.col("whole"), F.transform("x", lambda x: x["g"]).alias("gs"), F.transform("x", lambda x: x["code"]).alias("codes")).toDF("ck", "seg", "whole", "is_last", "gs", "codes"), "turn-segments")
        traced = segments.filter("whole").select("ck", "seg", "codes").mapInArrow(sliced(_short), TRACED)
        parts = segments.filter("not whole")
        if not parts.isEmpty():
            matrices = cut(parts.select("ck", "seg", "codes").mapInArrow(sliced(_matrices), "ck string, seg long, m array<long>"), "turn-matrices")
            behind = scan(matrices, ENDING, backwards=True)
            ways = cut(parts.join(behind, ["ck", "seg"]).select("ck", "seg", "codes", "is_last", "v").mapInArrow(sliced(_long), TRACED), "turn-ways")
            leads = F.array(*[F.when(F.max(F.when(F.col("entry") == s, F.col("last_state"))) == e, 0).otherwise(FAR).cast("long") for s in range(4) for e in range(4)])
            states = scan(ways.groupBy("ck", "seg").agg(leads.alias("m")), (0, FAR, FAR, FAR), backwards=False)
            entered = states.select("ck", "seg", (F.array_position("v", F.lit(0).cast("long")) - 1).cast("int").alias("entry"))
            traced = traced.unionByName(ways.join(entered, ["ck", "seg", "entry"]).select(*ways.columns))
        return cut(traced, "turn-audits"), segments

    def report(self) -> DataFrame:
        """A row for each conversation that has rows: ck, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        count = lambda c: F.count_if(c).alias(c)
        turns = self.marks.groupBy("ck", "turn").agg(*[count(c) for c in ("blank", "duplicate", "truncated", "illegal")])
        faults = turns.groupBy("ck").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
        pieces = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "")
        return faults.join(self.traced.groupBy("ck").agg(F.sum("cost").alias("cost"), pieces.alias("audit")), "ck")

    def repaired(self) -> DataFrame:
        """(ck, g, k, conv, role, text): the conversations after the edits, in the order of g and k within ck; g is the row that a turn was,
        or stands at."""

        def edits(batches):
            for batch in batches:
                out = []
                for gs, codes, audit, entry in zip(*(batch.column(c).to_pylist() for c in ("gs", "codes", "audit", "entry")), strict=True):
                    rows, behind = unfold(codes, audit, entry)
                    rows = [(g, *x, "") for g, x in zip(gs, rows, strict=True)]
                    out += [*rows[:-1], (*rows[-1][:4], behind)]
                kinds = [pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["g", "before", "edit", "initial", "behind"])

        each = self.segments.select("ck", "seg", "gs", "codes").join(self.traced.select("ck", "seg", "entry", "audit"), ["ck", "seg"]).select("gs", "codes", "audit", "entry")
        found = self.rows.join(each.mapInArrow(sliced(edits), "g long, before string, edit string, initial string, behind string"), "g")
        named = lambda i: F.when(i == "u", ROLES["u"]).otherwise(ROLES["a"])
        new = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda i: F.struct(named(i).alias("role"), F.lit("").alias("text")))
        role = F.when(F.col("edit") == "R", named(F.col("initial"))).otherwise(F.col("role"))
        own = F.when(F.col("edit") != "D", F.array(F.struct(role.alias("role"), F.col("text").alias("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
        return found.select("ck", "g", "conv", F.posexplode(F.concat(new("before"), own, new("behind"))).alias("k", "x")).select("ck", "g", "k", "conv", "x.role", "x.text")


def joined_digests(lines: DataFrame, key: str, order: list[str], value: Column) -> DataFrame:
    """(key, sha256) of each key's values, joined by line feeds.  A key's rows pass one task in their order, a batch at a
    time: a digest can't be made of parts."""

    def hashed(batches):
        current, digest = None, None
        for batch in batches:
            done = []
            for k, v in zip(batch.column("_key").to_pylist(), batch.column("_value").to_pylist(), strict=True):
                if k == current:
                    digest.update(b"\n")
                else:
                    if current is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = k, hashlib.sha256()
                digest.update(v.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], ["_key", "sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.string()), pa.array([digest.hexdigest()], pa.string())], ["_key", "sha256"])

    sent = lines.select(F.col(key).alias("_key"), *order, value.alias("_value")).repartition("_key").sortWithinPartitions("_key", *order)
    return sent.select("_key", "_value").mapInArrow(hashed, "_key string, sha256 string").withColumnRenamed("_key", key)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    every = turns.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("ck")).distinct()
    repair = Repair(damage(turns))
    digests = joined_digests(repair.repaired(), "ck", ["g", "k"], F.concat("role", F.lit(":"), "text"))
    out = every.join(repair.report(), "ck", "left").join(digests, "ck", "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
