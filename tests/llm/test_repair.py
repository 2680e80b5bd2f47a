from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from zoneflow.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """Row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    said, out = set(), []
    for _, _, role, text in rows:
        signs = re.findall(r"[^\x20\x09-\x0D]", text)
        if not signs:
            out.append("blank")
        elif (role, text) in said:
            out.append("duplicate")
        else:
            out.append("" if signs[-1] in ".!?" else "truncated")
        said.add((role, text))
    return out


def cheapest(rows, found):
    """Uniform-cost search over (rows used, roles said), least (cost, audit) first."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, used, state, said = heapq.heappop(heap)
        if (used, state) in done:
            continue
        done.add((used, state))
        if used == len(rows) and state in ("", "a"):
            return cost, audit, said
        for role in ("user", "assistant"):
            if allowed(state, role[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", used, role[0], (*said, (role, ""))))
        if used < len(rows):
            _, _, role, text = rows[used]
            heapq.heappush(heap, (cost + 3, audit + "D", used + 1, state, said))
            if found[used] in ("", "truncated"):
                extra = int(found[used] == "truncated")
                if allowed(state, role[:1]):
                    heapq.heappush(heap, (cost + extra, audit + "K", used + 1, role[:1], (*said, (role, text))))
                for new in ("user", "assistant"):
                    if allowed(state, new[0]):
                        heapq.heappush(heap, (cost + extra + 2, audit + "R", used + 1, new[0], (*said, (new, text))))
    raise AssertionError


def allowed(state, initial):
    return (state, initial) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def expected(rows):
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    by_conv = {}
    for row in damaged(rows):
        by_conv.setdefault(row[0], []).append(row)
    for conv, mine in by_conv.items():
        mine.sort(key=key)
        found = faults(mine)
        turns = {r[1] for r in mine if r[1] is not None}
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, said = cheapest(mine, found)
        assert LEGAL.fullmatch("".join(role[0] for role, _ in said))
        text = "\n".join(f"{role}:{text}" for role, text in said)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def some_rows(seed, conversations=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            text = rng.choice(["Yes.", "No!", "cut", "a. \n", " ", "", None, "\x0b", "é?", "\x85", "same.", f"own {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None, 2 * turn]), role, text))
    return rows


def check(spark, rows, **limits):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, cell string").repartition(3)
    out = repair.digest(df, repair.repair(repair.damaged(df), **limits)).collect()
    got = {r.conv_id: tuple(r)[1:] for r in out}
    assert len(out) == len(got) and got == expected(rows)


def test_against_search(spark):
    check(spark, some_rows(1, 300))


def test_conversations_handed_on_as_rows(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 2)
    monkeypatch.setattr(repair, "ROUND", 2)
    monkeypatch.setattr(repair, "EMIT_ROWS", 3)
    check(spark, some_rows(2), held_rows=2)
    check(spark, some_rows(3), held_chars=0)


def test_one_conversation_over_all_tasks(spark):
    rng = random.Random(5)
    rows = [(7, t // 2 if t % 50 == 0 else t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"c {t}.", " "])) for t in range(3000)]
    check(spark, rows + some_rows(4, 20))


def all_splits(symbols):
    """Plain CYK: every span, every split."""
    n = len(symbols)
    cell = {(i, i + 1): repair.LEAVES[s] for i, s in enumerate(symbols)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            table = {}
            for k in range(i + 1, i + length):
                for pair, value in repair.combine(cell[i, k], cell[k, i + length]).items():
                    table[pair] = min(value, table.get(pair, value))
            cell[i, i + length] = table
    return cell[0, n]


def test_one_split_gives_the_cells_of_all_splits():
    rng = random.Random(6)
    for _ in range(150):
        symbols = "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(1, 9)))
        assert repair.parse(symbols).table == all_splits(symbols)


def test_cells_survive_packing():
    span = repair.parse("048c15")
    again = repair.Span.unpack(span.pack())
    assert again.table == span.table and again.pack() == span.pack()


def test_table_and_no_rows(spark, sf):
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    out = repair.digest(conversations, repair.repair(repair.damaged(conversations)))
    assert {r.conv_id: tuple(r)[1:] for r in out.collect()} == expected(rows)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    none = conversations.limit(0)
    assert repair.digest(none, repair.repair(repair.damaged(none))).count() == 0
