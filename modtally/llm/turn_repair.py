"""Conversation structure repair: the cheapest edits that make a conversation alternate.

Rows are brought together by conversation, sorted by turn (nulls first; equal turns by role, then
text), and streamed: one pass of ``mapInPandas`` carries the state of a dynamic program over four
positions of the pattern ``(s?(ua)+)?`` from batch to batch, so a conversation may be of any
length. Per position it holds the least cost, the rank of its edits among the four, and a running
digest of the repaired text; each row adds four bytes of backpointers. Backpointers of a giant
conversation are spilled in compressed blocks to the cluster's shared folder and read back from
the end once the conversation is over.

Faults of a row, the first that holds: ``blank`` (no visible character), ``duplicate`` (role and
text seen earlier in the conversation), ``truncated`` (the last visible character ends no
sentence). Edits: Keep costs 0, Rerole to ``user`` or ``assistant`` 2, Delete 3 (required for blank
and duplicate rows), Insert of an empty turn 2; a truncated row that stays adds 1. Of equal costs
the ASCII-least string of initials wins.

Null roles and texts count as one space. Rows of a null conversation form one conversation, and
null turns come first. Repeated rows are duplicates. A conversation without rows (all of them
``present = false``) has zeros, no edits and the digest of the empty text; an empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modtally.session import scratch_path

# White space of the contract's patterns, sentence ends, what may follow what.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1

# Backpointers of one conversation that a task holds before it spills them.
SPILL_BYTES = 4 << 20

# Positions: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
# Edits of one row: its own, perhaps with one insertion before it. No token begins another one,
# so strings of as many tokens compare as their first different token does. Two insertions lead
# nowhere one cannot, and an insertion before a deletion is the same later and ASCII-less.
TOKENS = ("D", "IK", "IR", "K", "R")
INSERTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: b"user:", ASSISTANT: b"assistant:"}
# Insertions that close a conversation.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

RESULT = (
    "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _moves(initial: str, must_go: bool, cut: bool) -> list[tuple[int, int, int, int]]:
    """What a row may do: ``from, to, token, cost``."""
    moves = [(p, p, TOKENS.index("D"), DELETE) for p in range(4)]
    if must_go:
        return moves
    for p in range(4):
        for before, q, paid in (("", p, 0), ("I", INSERTED[p], INSERT)):
            kept = {"s": SYSTEM if q == START else None, "u": USER if q != USER else None, "a": ASSISTANT if q == USER else None}.get(initial)
            if kept is not None:
                moves.append((p, kept, TOKENS.index(before + "K"), paid + CUT * cut))
            moves.append((p, INSERTED[q], TOKENS.index(before + "R"), paid + REROLE + CUT * cut))
    return moves


MOVES = {(i, g, c): _moves(i, g, c) for i in ("s", "u", "a", "") for g in (False, True) for c in (False, True)}


class Spill:
    """Compressed blocks in one file of the shared folder, read back last first."""

    def __init__(self, folder: str):
        from pyarrow import fs

        local = re.sub("^file:/+", "/", folder)
        self.system, base = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(folder)
        self.system.create_dir(base)
        self.path = f"{base}/{uuid.uuid4().hex}"
        self.sizes: list[int] = []
        self.out = self.system.open_output_stream(self.path, compression=None)

    def add(self, block: bytes) -> None:
        packed = zlib.compress(block, 1)
        self.out.write(packed)
        self.sizes.append(len(packed))

    def backwards(self) -> Iterator[bytes]:
        self.out.close()
        at = sum(self.sizes)
        with self.system.open_input_file(self.path) as stored:
            for size in reversed(self.sizes):
                at -= size
                stored.seek(at)
                yield zlib.decompress(stored.read(size))
        self.system.delete_file(self.path)


class Conversation:
    """The state carried along one conversation."""

    def __init__(self, key: str | None, folder: str, spill_bytes: int):
        self.key, self.folder, self.spill_bytes = key, folder, spill_bytes
        # Per position: cost, rank of its edits, digest of the repaired text. Only START is reached.
        self.best: list[tuple | None] = [(0, 0, None), None, None, None]
        self.back = bytearray()
        self.spill: Spill | None = None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.initial = None

    def add(self, turn: int | None, role: str, text: str, blank: bool, repeat: bool, cut: bool) -> None:
        duplicate, cut = repeat and not blank, cut and not blank and not repeat
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        self.step(initial if initial in ("s", "u", "a") else "", blank or duplicate, cut, role, text)

    def step(self, initial: str, must_go: bool, cut: bool, role: str, text: str) -> None:
        best = self.best
        found: list[tuple | None] = [None] * 4
        for p, q, token, cost in MOVES[initial, must_go, cut]:
            if best[p] is not None:
                way = (best[p][0] + cost, best[p][1], token, p)
                if found[q] is None or way < found[q]:
                    found[q] = way
        order = sorted((way[1:] for way in found if way is not None))
        said = None
        new: list[tuple | None] = [None] * 4
        for q, way in enumerate(found):
            if way is None:
                self.back.append(0)
                continue
            cost, rank, token, p = way
            digest = best[p][2]
            if TOKENS[token] != "D":
                said = said or (f"{role}:".encode(errors="surrogatepass"), text.encode(errors="surrogatepass"))
                digest = _then(digest, NAMES[INSERTED[p]]) if TOKENS[token][0] == "I" else digest
                digest = _then(digest, said[0] if TOKENS[token][-1] == "K" else NAMES[q])
                digest.update(said[1])
            new[q] = (cost, order.index(way[1:]), digest)
            self.back.append(token << 2 | p)
        self.best = new
        if len(self.back) >= self.spill_bytes:
            self.spill = self.spill or Spill(self.folder)
            self.spill.add(bytes(self.back))
            self.back.clear()

    def result(self) -> tuple:
        ends = [(b[0] + INSERT * CLOSING[q], b[1], q) for q, b in enumerate(self.best) if b is not None]
        cost, _, at = min(ends)
        digest, place = self.best[at][2], at
        for _ in range(CLOSING[at]):
            place = INSERTED[place]
            digest = _then(digest, NAMES[place])
        audit = self.edits(at) + "I" * CLOSING[at]
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        sha = (digest or hashlib.sha256()).hexdigest()
        return self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, sha

    def edits(self, at: int) -> str:
        """The edits that lead to a position, from the last row to the first."""
        parts: list[str] = []
        for block in (bytes(self.back), *(self.spill.backwards() if self.spill else ())):
            tokens = []
            for row in range(len(block) - 4, -1, -4):
                code = block[row + at]
                tokens.append(TOKENS[code >> 2])
                at = code & 3
            parts.append("".join(reversed(tokens)))
        return "".join(reversed(parts))


def _then(digest, said: bytes):
    """A digest that goes on with another line; the one given stays as it is."""
    if digest is None:
        return hashlib.sha256(said)
    digest = digest.copy()
    digest.update(b"\n" + said)
    return digest


def stream(batches: Iterator[pd.DataFrame], folder: str, spill_bytes: int) -> Iterator[pd.DataFrame]:
    """Sorted rows in, one row a conversation out; a conversation may run over any number of batches."""
    names = RESULT.replace(" string", "").replace(" long", "").split(", ")
    current: Conversation | None = None
    for batch in batches:
        done = []
        columns = ("key", "present", "timed", "turn", "role", "text", "blank", "repeat", "cut")
        for key, present, timed, turn, role, text, blank, repeat, cut in zip(*(batch[c].tolist() for c in columns), strict=True):
            if current is None or key != current.key:
                if current is not None:
                    done.append(current.result())
                current = Conversation(key, folder, spill_bytes)
            if present:
                current.add(turn if timed else None, role, text, blank, repeat, cut)
        if done:
            yield pd.DataFrame(done, columns=names)
    if current is not None:
        yield pd.DataFrame([current.result()], columns=names)


def repair(turns: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row a conversation of ``conv_id, turn, role, text`` and perhaps ``present``: its faults and cheapest repair."""
    spark = turns.sparkSession
    folder = scratch_path(spark, "turn-spill")
    space = F.lit(" ")
    present = F.coalesce("present", F.lit(True)) if "present" in turns.columns else F.lit(True)
    rows = turns.select(
        "conv_id",
        present.alias("present"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    shown = F.rtrim("text", F.lit(SPACE))
    # What makes two turns the same, in 32 characters: the sort does not compare whole texts.
    same = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    judged = rows.select(
        "*",
        (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(*ENDS)).alias("cut"),
        same.alias("same"),
    )
    # One shuffle, by conversation, serves the window and the stream.
    seen = Window.partitionBy("conv_id", "present", "same").orderBy(F.col("turn").asc_nulls_first())
    sorted_rows = (
        judged.repartition("conv_id")
        .withColumn("repeat", F.row_number().over(seen) > 1)
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "repeat")
    )
    fed = sorted_rows.select(
        F.col("conv_id").cast("string").alias("key"),
        "present",
        F.col("turn").isNotNull().alias("timed"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        "role",
        "text",
        "blank",
        "repeat",
        "cut",
    )
    over = stream
    found = fed.mapInPandas(lambda batches: over(batches, folder, spill_bytes), RESULT)
    return found.withColumn("key", F.col("key").cast(turns.schema["conv_id"].dataType)).withColumnRenamed("key", "conv_id")
