"""Repair of conversation structure by cheapest edits, least audit first.

A conversation's rows are taken by turn (nulls first; then role, then text).
A row's first fault counts: blank (white space only), duplicate (role and text
seen earlier in the conversation), truncated (the last character that is no
white space is none of ``.!?``). Edits make the roles a system turn or none,
then user and assistant in turn, or nothing at all: Keep (0), Rerole to user or
assistant (2), Delete (3; a must for blank and duplicate rows), Insert an empty
user or assistant turn (2); a truncated row that stays adds 1. The audit is the
edits' initials; of the cheapest ones the ASCII-least is taken.

Method: nodes are (rows done, state of the role pattern). A cost DP from the end
gives every node its least cost to go; arcs on cheapest paths are the optimal
ones. An edit leads from a node to one node only, so optimal arcs of a node
differ in their letter. Prefix doubling ranks the nodes: by the first letter of
their least audits, then by pairs (rank, rank of the node that many letters on),
which compares audits of lengths 1, 2, 4, ...; each node takes its arc of least
(letter, rank of target), and the audit is read off through doubled pointers.

Conversations of at most SEGMENT rows and SEGMENT_BYTES are solved whole, many at
once. A longer one is put in order by range, equal rows counted as one, and cut
into segments of that size: their min-plus matrices (costs from state to state),
combined from the end, give the costs at each segment's end, and the states in
which the least path leaves the segments, followed from the start, each
segment's entry. So no task holds such a conversation, only 16 numbers a segment.

Edge cases: null roles and texts are one space; null conversation ids are one
conversation; null turns come first and don't count for gaps; repeated rows are
duplicates; a conversation whose rows are all ``gone`` (dropped before) has
zeros, an empty audit and no turns; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import written

WHOLE = -1                      # segment number of a conversation that is one segment
SEGMENT = 8192
SEGMENT_BYTES = 8 << 20
SOLVE_ROWS = 8192               # rows solved at once, whole segments
PREFIX = 64                     # characters of a text in the range bounds of long conversations

# states of the role pattern: nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
# state after a kept row by its role's initial (u, a, s, another); none: -1
KEPT = np.array([[USER, -1, SYSTEM, -1], [USER, -1, -1, -1], [-1, ASSISTANT, -1, -1], [USER, -1, -1, -1]])
SPOKEN = np.array([USER, USER, ASSISTANT, USER])   # after a rerole or insert, the only one that fits
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"u": 0, "a": 1, "s": 2}
LEGAL = {"su", "ua", "au"}
REROLED, DELETED, INSERTED, CUT_OFF = 2, 3, 2, 1    # costs
NEVER = 1 << 40
# cost to go and last letters after the last row: the pattern has to be complete
ENDING = np.array([0, 2 * INSERTED, INSERTED, 0])
LAST_LETTERS = ["", "II", "I", ""]
LETTERS = "DIKR"                # ASCII order

FINE, BLANK, TRUNCATED = range(3)
WHITE = "\\u0020\\t\\n\\u000B\\f\\r"

SOLVED = ("key string, segment long, n_rows long, blank long, duplicate long, truncated long, illegal long, "
          "first string, last string, n_turns long, least_turn long, last_turn long, cost long, audit string, "
          "turns array<struct<role: string, text: string, edit: string>>")


# --- numpy: cost DP, ranks, audits -------------------------------------------

class Segments:
    """Rows of several segments, one after the other."""

    def __init__(self, ends: np.ndarray, initial: np.ndarray, bad: np.ndarray, cut_off: np.ndarray,
                 copies: np.ndarray):
        """``ends``: end row of each segment (none is empty); ``copies`` of a row after the
        first are deleted with it or after it."""
        self.ends, self.initial, self.bad, self.copies = ends, initial, bad, copies
        self.n = len(initial)
        self.starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        self.segment = np.repeat(np.arange(len(ends)), ends - self.starts)
        self.more = DELETED * (copies - 1)
        self.stay = np.where(bad, NEVER, CUT_OFF * cut_off)
        self.to = KEPT[:, initial].T                       # (rows, states)

    def _choices(self, after: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Costs (letters, rows, states) of D, I, K, R; of I only the cost."""
        more = self.more[rows, None]
        stay = self.stay[rows, None]
        to = self.to[rows]
        keep = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1), NEVER)
        return np.stack((after + DELETED + more, np.full_like(after, NEVER), keep + stay + more,
                         after[:, SPOKEN] + REROLED + stay + more))

    def costs(self, end: np.ndarray) -> np.ndarray:
        """Cost to go (rows + segments, states); ``end``: costs after each segment's last row."""
        out = np.empty((self.n + len(self.ends), 4), np.int64)
        out[self.n:] = end
        left = self.ends[self.segment] - 1 - np.arange(self.n)     # rows behind
        order = np.argsort(left, kind="stable")
        bounds = np.searchsorted(left[order], np.arange(left.max(initial=-1) + 2))
        behind = self.behind()
        for begin, stop in zip(bounds[:-1], bounds[1:]):
            rows = order[begin:stop]
            base = self._choices(out[behind[rows]], rows).min(axis=0)
            now = base
            for _ in range(2):     # at most two turns are inserted at one place
                now = np.minimum(base, now[:, SPOKEN] + INSERTED)
            out[rows] = now
        return np.minimum(out, NEVER)

    def behind(self) -> np.ndarray:
        """Place in the cost table of what follows each row."""
        after = np.arange(1, self.n + 1)
        after[self.ends - 1] = self.n + np.arange(len(self.ends))
        return after

    def matrices(self) -> np.ndarray:
        """(segments, entry, exit): least costs."""
        out = np.empty((len(self.ends), 4, 4), np.int64)
        for state in range(4):
            end = np.full(4, NEVER)
            end[state] = 0
            out[:, :, state] = self.costs(end)[self.starts]
        return out

    def arcs(self, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(letter, target) of the arc that every node's least path takes.

        Node 4 r + q: row r in state q; end nodes have letter 0 and lead to themselves.
        """
        n, rows = self.n, np.arange(self.n)
        behind = self.behind()
        choices = self._choices(costs[behind], rows)
        choices[1] = costs[:n][:, SPOKEN] + INSERTED
        states = np.arange(4)
        targets = np.stack((4 * behind[:, None] + states, 4 * rows[:, None] + SPOKEN,
                            4 * behind[:, None] + np.maximum(self.to, 0), 4 * behind[:, None] + SPOKEN)
                           ).reshape(4, 4 * n)
        optimal = (choices == costs[:n]).reshape(4, 4 * n) & (costs[:n] < NEVER).ravel()
        every = np.arange(4 * len(costs))
        # ranks by audits of length 1
        live = optimal.any(axis=0)
        first = np.where(live, optimal.argmax(axis=0), 0)
        rank = np.zeros(len(every), np.int64)
        rank[:4 * n] = np.where(live, first + 1, 0)
        jump = every.copy()
        jump[:4 * n] = np.where(live, targets[first, every[:4 * n]], every[:4 * n])
        while (rank[jump] > 0).any():
            # audits of twice the length: by this half, then by the half behind it
            rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]   # end nodes: 0
            jump = jump[jump]
        worst = (rank.max() + 1) * 5
        score = np.where(optimal, np.arange(4)[:, None] * (rank.max() + 1) + rank[targets], worst)
        best = score.argmin(axis=0)
        letter = np.zeros(len(every), np.int64)
        letter[:4 * n] = np.where(live, best + 1, 0)
        target = every
        target[:4 * n] = np.where(live, targets[best, np.arange(4 * n)], np.arange(4 * n))
        return letter, target

    def paths(self, letter: np.ndarray, target: np.ndarray, entry: np.ndarray) -> list[np.ndarray]:
        """Nodes of each segment's least path from its entry state to its end node."""
        start = 4 * self.starts + entry
        jumps, reach = [target], target
        while (letter[reach[start]] > 0).any():
            reach = reach[reach]
            jumps.append(reach)
        # length of every path by descending powers of two
        at, length = start.copy(), np.zeros(len(start), np.int64)
        for k in range(len(jumps) - 1, -1, -1):
            further = letter[jumps[k][at]] > 0
            at = np.where(further, jumps[k][at], at)
            length += further.astype(np.int64) << k
        length += letter[start] > 0
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        node = np.repeat(start, length)
        for k, jump in enumerate(jumps):
            node = np.where(step >> k & 1, jump[node], node)
        return np.split(node, np.cumsum(length)[:-1])

    def exits(self, letter: np.ndarray, target: np.ndarray) -> np.ndarray:
        """(segments, entry): state in which the least path leaves the segment."""
        reach = target
        while (letter[reach] > 0).any():
            reach = reach[reach]
        return reach[4 * self.starts[:, None] + np.arange(4)] % 4


# --- a batch of segments -----------------------------------------------------

def _segments_of(rows: pa.Table) -> tuple[Segments, dict, np.ndarray]:
    """The segments, faults and initials of rows that are not gone, grouped by key and segment."""
    group = _group_numbers(rows)
    n_groups = int(group[-1]) + 1
    initials = [r[:1] for r in rows.column("role").to_pylist()]
    initial = np.array([INITIALS.get(i, 3) for i in initials], np.int64)
    base = rows.column("fault").to_numpy()
    seen = rows.column("earlier").to_numpy().astype(bool)
    digest = rows.column("digest").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    pair = group * (digest.max() + 1) + digest
    first = np.zeros(len(pair), bool)
    first[np.unique(pair, return_index=True)[1]] = True
    duplicate = (base != BLANK) & (seen | ~first)
    blank, cut_off = base == BLANK, (base == TRUNCATED) & ~duplicate
    copies = rows.column("copies").to_numpy()
    ends = np.searchsorted(group, np.arange(n_groups), side="right")
    faults = {"blank": np.where(blank, copies, 0),
              "duplicate": np.where(blank, 0, copies - 1 + duplicate), "truncated": cut_off.astype(np.int64)}
    pairs = np.array([a + b not in LEGAL for a, b in zip([""] + initials, initials)], np.int64)
    begin = np.concatenate(([0], ends[:-1]))
    pairs[begin] = 0
    faults["illegal"] = pairs + copies - 1
    return Segments(ends, initial, blank | duplicate, cut_off, copies), faults, initials


def _group_numbers(rows: pa.Table) -> np.ndarray:
    keys = rows.column("key").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    segment = rows.column("segment").to_numpy()
    new = (np.diff(keys, prepend=-1) != 0) | (np.diff(segment, prepend=-1) != 0)
    return np.cumsum(new) - 1


def solve(rows: pa.Table) -> pa.RecordBatch:
    """Faults, cost, audit and repaired turns of whole segments."""
    names = [f.split()[0] for f in SOLVED.split(", ")[:14]] + ["turns"]
    all_groups = _group_numbers(rows)
    heads = np.unique(all_groups, return_index=True)[1]
    n = len(heads)
    out = {c: np.zeros(n, np.int64).tolist() for c in names}
    out |= {"key": rows.column("key").take(pa.array(heads)).to_pylist(),
            "segment": rows.column("segment").take(pa.array(heads)).to_pylist(),
            "first": [""] * n, "last": [""] * n, "audit": [""] * n, "turns": [[] for _ in range(n)],
            "least_turn": [None] * n, "last_turn": [None] * n}
    here = np.flatnonzero(~rows.column("gone").to_numpy().astype(bool))
    if len(here):
        place = np.unique(all_groups[here])                   # result row of each segment with rows
        some = rows.take(pa.array(here)).combine_chunks()
        segments, faults, initials = _segments_of(some)
        last = segments.ends - 1
        for name, values in faults.items():
            _put(out[name], place, np.add.reduceat(values, segments.starts))
        _put(out["n_rows"], place, np.add.reduceat(segments.copies, segments.starts))
        _put(out["first"], place, [initials[i] for i in segments.starts])
        _put(out["last"], place, [initials[i] for i in last])
        turn = some.column("turn").combine_chunks()
        known = np.asarray(turn.is_valid())
        value = turn.fill_null(0).to_numpy()
        fresh = known.copy()
        fresh[1:] &= (value[1:] != value[:-1]) | ~known[:-1]
        fresh[segments.starts] = known[segments.starts]
        _put(out["n_turns"], place, np.add.reduceat(fresh.astype(np.int64), segments.starts))
        for s, (begin, end) in enumerate(zip(segments.starts, segments.ends)):
            mine = value[begin:end][known[begin:end]]          # they rise
            if len(mine):
                out["least_turn"][place[s]], out["last_turn"][place[s]] = int(mine[0]), int(mine[-1])
        end = np.array(some.column("end").take(pa.array(segments.starts)).to_pylist(), np.int64)
        entry = some.column("entry").take(pa.array(segments.starts)).to_numpy().astype(np.int64)
        final = some.column("final").take(pa.array(segments.starts)).to_pylist()
        costs = segments.costs(end)
        _put(out["cost"], place, costs[segments.starts, entry])
        letter, target = segments.arcs(costs)
        roles, texts = some.column("role").to_pylist(), some.column("text").to_pylist()
        for s, path in enumerate(segments.paths(letter, target, entry)):
            audit, turns = [], []
            for node, code in zip(path.tolist(), letter[path].tolist()):
                edit, row = LETTERS[code - 1], node // 4
                audit.append(edit)
                if edit == "I":
                    turns.append({"role": ROLES[SPOKEN[node % 4]], "text": "", "edit": edit})
                    continue
                if edit != "D":
                    role = roles[row] if edit == "K" else ROLES[SPOKEN[node % 4]]
                    turns.append({"role": role, "text": texts[row], "edit": edit})
                audit.append("D" * int(segments.copies[row] - 1))
            if final[s]:
                state = int(target[path[-1]]) % 4
                for edit in LAST_LETTERS[state]:
                    state = int(SPOKEN[state])
                    audit.append(edit)
                    turns.append({"role": ROLES[state], "text": "", "edit": edit})
            out["audit"][place[s]], out["turns"][place[s]] = "".join(audit), turns
    types = {"key": pa.string(), "first": pa.string(), "last": pa.string(), "audit": pa.string(),
             "turns": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))}
    return pa.RecordBatch.from_arrays([pa.array(out[c], types.get(c, pa.int64())) for c in names], names)


def _put(column: list, place: np.ndarray, values) -> None:
    for i, v in zip(place.tolist(), values.tolist() if isinstance(values, np.ndarray) else values):
        column[i] = v


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole segments of about SOLVE_ROWS rows; rows come by key and segment."""
    held: list[pa.RecordBatch] = []
    n_rows = n_bytes = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, 1024):
            part = batch.slice(begin, 1024)
            held.append(part)
            n_rows += part.num_rows
            n_bytes += part.nbytes
            if n_rows < SOLVE_ROWS and n_bytes < SEGMENT_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            group = _group_numbers(table)
            cut = int(np.searchsorted(group, group[-1]))       # the last segment may go on
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            n_rows, n_bytes = table.num_rows - cut, sum(b.nbytes for b in held)
    if n_rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _whole(batches):
        yield solve(rows)


# --- Spark jobs --------------------------------------------------------------

def _prepared(rows: DataFrame) -> DataFrame:
    """key, turn, role, text, gone with the row's own fault and the digest of role and text."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    out = rows.select(
        _key("conv_id").alias("key"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), gone.alias("gone"))
    return out.withColumn("ending", F.expr(f"rtrim('{WHITE}', text)")).select(
        "key", "turn", "role", "text", "gone",
        F.expr(f"CASE WHEN ending = '' THEN {BLANK} WHEN right(ending, 1) IN ('.', '!', '?') THEN {FINE} "
               f"ELSE {TRUNCATED} END").alias("fault"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"))


def _longs(values) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _short(rows: DataFrame) -> DataFrame:
    whole = (rows.repartition("key")
             .sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text")
             .withColumns({"segment": F.lit(WHOLE).cast("long"), "copies": F.lit(1).cast("long"),
                           "earlier": F.lit(False), "end": _longs(ENDING), "entry": F.lit(START),
                           "final": F.lit(True)}))
    return whole.mapInArrow(_solve, SOLVED)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of ordered rows: at most SEGMENT rows, about SEGMENT_BYTES, one key."""
    number, n_rows, n_bytes, now = TaskContext.get().partitionId() << 32, 0, 0, None
    for batch in batches:
        segment, place = [], []
        for key, size in zip(batch.column("key").to_pylist(), batch.column("size").to_pylist()):
            if now is not None and (key != now or n_rows >= SEGMENT or n_bytes >= SEGMENT_BYTES):
                number, n_rows, n_bytes = number + 1, 0, 0
            now, n_rows, n_bytes = key, n_rows + 1, n_bytes + size
            segment.append(number)
            place.append(n_rows)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(segment, pa.int64()), pa.array(place, pa.int64())],
            [*batch.schema.names, "segment", "place"])


def _on_segments(rows: DataFrame, function, schema: str) -> DataFrame:
    return (rows.repartition("key", "segment").sortWithinPartitions("key", "segment", "place")
            .mapInArrow(function, schema))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _whole(batches):
        segments, _, _ = _segments_of(rows)
        heads = pa.array(segments.starts)
        yield pa.RecordBatch.from_arrays(
            [rows.column("key").take(heads).combine_chunks(), rows.column("segment").take(heads).combine_chunks(),
             pa.array(segments.matrices().reshape(-1, 16).tolist(), pa.list_(pa.int64()))],
            ["key", "segment", "costs"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _whole(batches):
        segments, _, _ = _segments_of(rows)
        heads = pa.array(segments.starts)
        end = np.array(rows.column("end").take(heads).to_pylist(), np.int64)
        exits = segments.exits(*segments.arcs(segments.costs(end)))
        yield pa.RecordBatch.from_arrays(
            [rows.column("key").take(heads).combine_chunks(), rows.column("segment").take(heads).combine_chunks(),
             rows.column("end").take(heads).combine_chunks(), rows.column("final").take(heads).combine_chunks(),
             pa.array(exits.tolist(), pa.list_(pa.int64()))], ["key", "segment", "end", "final", "exits"])


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """Costs after each segment's last row, from the conversation's end (a row a segment)."""
    group = group.sort_values("segment")
    after, ends = ENDING, []
    for costs in reversed(group["costs"].tolist()):
        ends.append(np.minimum(after, NEVER).tolist())
        after = (np.asarray(costs).reshape(4, 4) + after).min(axis=1)
    final = np.arange(len(group)) == len(group) - 1
    return group[["key", "segment"]].assign(end=ends[::-1], final=final)


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """State in which the least path enters each segment."""
    group = group.sort_values("segment")
    state, entry = START, []
    for exits in group["exits"]:
        entry.append(state)
        state = int(exits[state])
    return group[["key", "segment", "end", "final"]].assign(entry=entry)


def _long(rows: DataFrame, n_rows: int) -> DataFrame:
    """Segments of conversations too long for one task."""
    counted = (rows.where("NOT gone").groupBy("key", "turn", "role", "text", "fault", "digest")
               .agg(F.count(F.lit(1)).alias("copies")))
    bounds = ["key", F.asc_nulls_first("turn"), "role", F.substring("text", 1, PREFIX)]
    in_order = (counted.repartitionByRange(max(1, -(-n_rows // SEGMENT)), *bounds)
                .sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text")
                .withColumn("size", F.octet_length("text")))
    schema = in_order.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    rows = written(in_order.mapInArrow(_numbered, f"{schema}, segment long, place long"), "long-conversations")
    # digests that an earlier segment of the conversation has, by segment
    met = rows.select("key", "segment", "digest").distinct()
    home = met.groupBy("key", "digest").agg(F.min("segment").alias("home"))
    earlier = (met.join(home, ["key", "digest"]).where("home < segment")
               .select("key", "segment", "digest", F.lit(True).alias("earlier")))
    rows = written(rows.join(earlier, ["key", "segment", "digest"], "left")
                   .withColumns({"earlier": F.coalesce("earlier", F.lit(False)), "gone": F.lit(False)}),
                   "long-conversations")
    light = rows.select("key", "segment", "place", "role", "fault", "earlier", "digest", "copies")
    costs = _on_segments(light, _matrices, "key string, segment long, costs array<long>")
    # a row a segment: at most a conversation's rows / SEGMENT meet
    ends = written(costs.groupBy("key").applyInPandas(
        _ends, "key string, segment long, end array<long>, final boolean"), "segment-ends")
    exits = _on_segments(light.join(ends, ["key", "segment"]), _exits,
                         "key string, segment long, end array<long>, final boolean, exits array<long>")
    entries = written(exits.groupBy("key").applyInPandas(
        _entries, "key string, segment long, end array<long>, final boolean, entry int"), "segment-entries")
    return _on_segments(rows.join(entries, ["key", "segment"]), _solve, SOLVED)


def _key(conv_id: str) -> Column:
    return F.concat(F.when(F.col(conv_id).isNull(), "-").otherwise("+"),
                    F.coalesce(F.col(conv_id).cast("string"), F.lit("")))


def repair(rows: DataFrame) -> DataFrame:
    """Repaired segments of conversations, as a written table: conv_id, faults, cost, audit, turns.

    ``rows``: conv_id, turn, role, text and, if there is one, ``gone`` (true: the
    row was dropped before and only names its conversation). Nearly every
    conversation is one segment, numbered WHOLE; those of a longer one follow
    each other by number, their audits and turns join, and the first one's cost
    is the conversation's.
    """
    prepared = _prepared(rows)
    there = prepared.where("NOT gone")
    sizes = there.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long_keys = written(sizes.where(f"n > {SEGMENT} OR bytes > {SEGMENT_BYTES}"), "long-keys")
    n_rows = long_keys.agg(F.sum(F.col("n") + F.col("bytes") * SEGMENT / SEGMENT_BYTES)).first()[0]   # one number
    # one row names a conversation that lost rows, however many it lost
    named = prepared.where("gone").select("key").distinct().select(
        "key", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.lit(True).alias("gone"), F.lit(BLANK).alias("fault"), F.lit("").alias("digest"))
    if n_rows is None:
        solved = _short(there.unionByName(named))
    else:
        keys = long_keys.select("key")
        solved = _short(there.unionByName(named).join(keys, "key", "left_anti")).unionByName(
            _long(there.join(keys, "key", "left_semi"), int(n_rows)))
    conv_type = rows.schema["conv_id"].dataType
    original = F.when(F.col("key") != "-", F.expr("substring(key, 2)")).cast(conv_type)
    return written(solved.select(original.alias("conv_id"), *solved.columns), "repaired-conversations")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of newline-joined pieces; pieces come by key and segment, one is held at a time."""
    now, state, begun = None, None, False
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["key"] != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state, begun = row["key"], hashlib.sha256(), False
            if row["n_turns"]:
                state.update((b"\n" if begun else b"") + row["piece"].encode())
                begun = True
        yield pa.RecordBatch.from_pylist([{"key": k, "repaired_sha256": d} for k, d in done], DIGESTS)
    if now is not None:
        yield pa.RecordBatch.from_pylist([{"key": now, "repaired_sha256": state.hexdigest()}], DIGESTS)


DIGESTS = pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())])
# pairs of neighbouring segments of ``s`` for which a condition on a and b holds
PAIRS = ("CAST(size(filter(zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s)), "
         "(a, b) -> {condition}), x -> x)) AS BIGINT)")


def report(segments: DataFrame) -> DataFrame:
    """A row per conversation: gaps, faults, cost, audit and the digest of its repaired turns.

    ``segments``: the table of :func:`repair`. A digest runs over the turns in
    order, so a conversation of several segments passes one task piece by piece.
    """
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    faults = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    gaps = F.expr("coalesce(last_turn - least_turn + 1 - n_turns, 0)").alias("gaps")
    whole = segments.where(F.col("segment") == WHOLE).select(
        "conv_id", gaps, *faults, F.sha2(joined.cast("binary"), 256).alias("repaired_sha256"))
    parts = segments.where(F.col("segment") != WHOLE)
    ends = F.struct("segment", "first", "last", "least_turn", "last_turn", "cost", "audit")
    long = (parts.groupBy("key", "conv_id").agg(
        F.min("least_turn").alias("least_turn"), F.max("last_turn").alias("last_turn"),
        F.sum("n_turns").alias("n_turns"), *[F.sum(c).alias(c) for c in faults[:4]],
        F.array_sort(F.collect_list(ends)).alias("s"))        # letters of the audit, no texts
        .withColumn("n_turns", F.col("n_turns") - F.expr(PAIRS.format(
            condition="coalesce(a.last_turn = b.least_turn, false)")))
        .withColumn("illegal", F.col("illegal") + F.expr(PAIRS.format(
            condition=f"concat(a.last, b.first) NOT IN ({', '.join(repr(p) for p in sorted(LEGAL))})")))
        .withColumns({"cost": F.col("s")[0]["cost"], "audit": F.array_join(F.col("s.audit"), "")}))
    pieces = parts.select("key", "segment", joined.alias("piece"), F.size("turns").alias("n_turns"))
    digests = (pieces.repartition("key").sortWithinPartitions("key", "segment")
               .mapInArrow(_digests, "key string, repaired_sha256 string"))
    return whole.unionByName(long.join(digests, "key").select("conv_id", gaps, *faults, "repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a hash of conversation and turn.

    One kind in twenty each: dropped (``gone``), emptied, without its ``.!?``,
    repeated, role set to user. Null roles and texts are one space.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                       F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kinds = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("kind"))
    return kinds.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")
