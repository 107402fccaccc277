import hashlib
import heapq
import random
import re
import zlib

import pytest

from gridmix.llm import conversations as conv

random.seed(12)
SCHEMA = "conv_id long, turn long, role string, text string, key int, segment string, cost int"
WHITE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Cheapest, then ASCII-least edits by a search over (cost, audit)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for turn, role, text in rows:
        if not text.strip(WHITE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if text.rstrip(WHITE)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    step = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        for s in "ua":
            if (state, s) in step:
                heapq.heappush(heap, (cost + 2, audit + "I", i, s, out + (names[s] + ":",)))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = faults[i] == "truncated"
        if (state, role[:1]) in step:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], out + (f"{role}:{text}",)))
        for s in "ua":
            if (state, s) in step:
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, s, out + (f"{names[s]}:{text}",)))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    first = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain(original, damaged):
    by = {r[0]: [] for r in original}
    for c, *rest in damaged:
        by[c].append(tuple(rest))
    return {c: plain_repair(rows) for c, rows in by.items()}


def reported(segments):
    rows = conv.report(segments).collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(n, most, turns=True):
    texts = ["Hello.", "Why?", "no end", " \t", "", "Yes!  ", "x" * 50, "a.\n", "é…", None, "ok."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "assistant"]
    rows = []
    for c in range(n):
        good = random.random() < 0.5
        for t in range(random.randint(1, most)):
            role = ["user", "assistant"][t % 2] if good else random.choice(roles)
            text = f"Text {random.randint(0, 9)}." if good else random.choice(texts)
            turn = None if random.random() < 0.05 else t + 3 * random.randint(0, 1)
            rows.append((None if c == 3 else c, turn, role, text))
    return rows


def test_equals_search(spark):
    rows = random_rows(250, 12)
    got = reported(conv.repair(conv.damaged(frame(spark, rows))))
    assert got == plain(rows, plain_damage(rows))


def test_undamaged_rows_and_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."),
            (2, 0, "assistant", "Begin."), (2, 5, "user", "cut of"), (5, None, "system", "Alone.")]
    segments = conv.repair(frame(spark, rows))
    got = reported(segments)
    assert got == plain(rows, rows)
    turns = {r.conv_id: [(t.role, t.text, t.edit) for t in r.turns] for r in segments.collect()}
    assert turns[1] == [("system", "Be kind.", "K"), ("user", "Hi!", "K"), ("assistant", "Hello.", "K")]


@pytest.mark.parametrize("segment", [2, 5])
def test_long_conversations_in_segments(spark, monkeypatch, segment):
    """Conversations beyond SEGMENT rows take the ranged way; same results."""
    monkeypatch.setattr(conv, "SEGMENT", segment)
    rows = random_rows(25, 30) + [(500, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(40)]
    rows += [(600, 7, "user", "Same.")] * 30 + [(600, 8, "assistant", " ")] * 9 + [(700, None, "tool", "x.")] * 8
    got = reported(conv.repair(conv.damaged(frame(spark, rows))))
    assert got == plain(rows, plain_damage(rows))


def test_long_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(conv, "SEGMENT_BYTES", 5000)
    rows = [(1, t, "user", f"{t} " * 2000 + ".") for t in range(6)] + [(2, 0, "user", "Short.")]
    assert reported(conv.repair(frame(spark, rows))) == plain(rows, rows)


def test_empty_and_all_gone(spark):
    assert reported(conv.repair(conv.damaged(frame(spark, [])))) == {}
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    got = reported(conv.repair(conv.damaged(frame(spark, gone * 3))))
    assert got == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in gone}


def test_column_types(spark):
    types = dict(conv.report(conv.repair(frame(spark, [(1, 0, "user", "x")]))).dtypes)
    assert types == {"conv_id": "bigint", **{c: "bigint" for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")}, "audit": "string", "repaired_sha256": "string"}
