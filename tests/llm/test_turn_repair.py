"""Conversation repair against a search over all edit strings, streamed in batches of any size."""

import hashlib
import heapq
import random
import re

import pandas as pd
import pytest

from modtally.llm import turn_repair
from modtally.llm.queries import damaged

WORD = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        if not WORD.search(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if WORD.findall(text)[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least cost, then least string, over all edit sequences (uniform-cost search; an insertion is allowed anywhere)."""
    bad = faults(rows)
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if (i, roles) in done:
            continue
        done.add((i, roles))
        if i == len(rows) and PATTERN.fullmatch(roles):
            return cost, audit, "\n".join(lines)
        ways = [(2, "I", i, n[0], (n + ":",)) for n in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            ways.append((3, "D", i + 1, "", ()))
            if bad[i] not in ("blank", "duplicate"):
                extra = bad[i] == "truncated"
                ways.append((extra, "K", i + 1, role[:1] or "?", (f"{role}:{text}",)))
                ways += [(2 + extra, "R", i + 1, n[0], (f"{n}:{text}",)) for n in ("user", "assistant")]
        for paid, edit, to, initial, line in ways:
            if re.fullmatch(r"s?(ua)*u?", roles + initial):
                heapq.heappush(heap, (cost + paid, audit + edit, to, roles + initial, lines + line))


def plain(rows):
    """``rows``: turn, role, text of one conversation, in any order."""
    turns = sorted(((t is not None, t or 0, r, x) for t, r, x in rows))
    said = [(r, x) for *_, r, x in turns]
    numbers = {t for known, t, *_ in turns if known}
    bad = faults(said)
    initials = [r[:1] for r, _ in said]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    cost, audit, text = cheapest(said)
    return gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def chats(seed, n=60):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "u", None])
            text = rng.choice(["Yes.", "no", "", " \t", "One?", "more and more", "x.\n", None, "Yes.", f"n{rng.randint(0, 3)}!"])
            number = rng.choice([turn, turn, turn, turn + 2, None])
            out += [(c if c else None, number, role, text)] * rng.choice([1, 1, 1, 1, 2])
    rng.shuffle(out)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, key int, same string, repeat string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b") for r in rows], SCHEMA)


def wanted(rows):
    groups = {}
    for c, turn, role, text in rows:
        groups.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: plain(g) for c, g in groups.items()}


@pytest.mark.parametrize("spill", [8, 4 << 20])
def test_random_conversations(spark, spill):
    rows = chats(spill)
    found = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(frame(spark, rows), spill).collect()}
    assert found == wanted(rows)


def test_small_batches(spark):
    """State goes on from batch to batch."""
    rows = chats(3, 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        found = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(frame(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == wanted(rows)


def test_one_giant_conversation_spills(spark, tmp_path):
    """Backpointers leave memory in blocks; the edits are those of one piece."""
    rng = random.Random(5)
    said = [(rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", ""]) + str(i) + ".") for i in range(3000)]
    batch = pd.DataFrame(
        [("1", True, True, i, r, t, not WORD.search(t), False, WORD.findall(t)[-1:] != ["."]) for i, (r, t) in enumerate(said)],
        columns=["key", "present", "timed", "turn", "role", "text", "blank", "repeat", "cut"],
    )
    cut = [batch.iloc[i : i + 700] for i in range(0, len(batch), 700)]
    whole, spilled = (pd.concat(turn_repair.stream(iter(cut), str(tmp_path), size)) for size in (1 << 30, 1 << 10))
    assert whole.equals(spilled) and len(whole) == 1 and len(whole.audit[0]) >= 3000
    assert not list(tmp_path.iterdir())


def test_dropped_rows_and_no_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "Hi.", False), (2, 0, "user", "Hi.", True), (2, 1, "assistant", "Hi.", None), (2, 9, "user", "Hi.", False)],
        "conv_id long, turn long, role string, text string, present boolean",
    )
    empty = hashlib.sha256(b"").hexdigest()
    found = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(rows).collect()}
    assert found == {1: (0, 0, 0, 0, 0, 0, "", empty), 2: plain([(0, "user", "Hi."), (1, "assistant", "Hi.")])}
    assert turn_repair.repair(rows.limit(0)).collect() == []


def test_damage(spark):
    rows = damaged(frame(spark, chats(9))).collect()
    assert {r.present for r in rows} <= {True, False} and all(r.role is not None and r.text is not None for r in rows)
