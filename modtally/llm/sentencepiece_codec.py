"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding follows the published algorithm: symbols start as characters, an agenda of adjacent
pairs ordered by piece score (ties: leftmost) is worked off, stale entries are skipped, and
symbols outside the vocabulary fall back to byte pieces. No piece of such a vocabulary
continues over the start of a white-space run, so a text is cut there and the cuts are
encoded one by one and remembered; the result is that of the whole text.

Every Arrow batch checks whole texts (one row in ``check_every``) against the library and
fails on any difference. Null texts count as empty; empty texts have only the end id.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import id_and_text, pieces

SPACE = "▁"
# Distinct cuts a task remembers before it starts afresh (about 350 bytes each).
REMEMBERED = 1_000_000


class Agenda:
    """Encoder built from a model's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        normal = [i for i in range(sp.get_piece_size()) if not special(i)]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        by_score = sorted((i for i in normal if len(sp.id_to_piece(i)) > 1), key=lambda i: -sp.get_score(i))
        # Equal scores share a place, so that position decides between them.
        self.place, place, last = {}, -1, None
        for i in by_score:
            if sp.get_score(i) != last:
                place, last = place + 1, sp.get_score(i)
            self.place[sp.id_to_piece(i)] = place
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece continues over white space; cuts would change the result")
        merging = {c for p in self.place for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in merging)
        self.cut = re.compile(f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.end = sp.eos_id()
        self.known: dict[str, tuple[str, tuple[int, ...]]] = {}

    def cuts(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def symbols(self, cut: str) -> list[str]:
        """Work off the agenda of one cut."""
        symbol, place = list(cut), self.place
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(place[p], i, 2) for i in range(n - 1) if (p := cut[i : i + 2]) in place]
        heapq.heapify(agenda)
        while agenda:
            _, i, length = heapq.heappop(agenda)
            if not symbol[i] or (j := after[i]) >= n or len(symbol[i]) + len(symbol[j]) != length:
                continue
            symbol[i] += symbol[j]
            symbol[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := symbol[i] + symbol[k]) in place:
                    heapq.heappush(agenda, (place[p], i, len(p)))
            h = before[i]
            if h >= 0 and (p := symbol[h] + symbol[i]) in place:
                heapq.heappush(agenda, (place[p], h, len(p)))
        return [s for s in symbol if s]

    def encode_cut(self, cut: str) -> tuple[str, tuple[int, ...]]:
        found: list[int] = []
        for s in self.symbols(cut):
            if s in self.ids:
                found.append(self.ids[s])
            else:
                found.extend(self.bytes[b] for b in s.encode())
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[cut] = out = (" ".join(map(str, found)), tuple(found))
        return out

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids without the end id, and the decimal ids of the whole with the end id."""
        known, cuts = self.known, self.cuts(text)
        parts = [known.get(c) or self.encode_cut(c) for c in cuts]
        ids = [i for p in parts for i in p[1]]
        return ids, " ".join([*(p[0] for p in parts), str(self.end)])


OUTPUT = {"ids": "array<int>", "decoded": "string", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_texts(
    docs: DataFrame, model_path: str, columns: tuple[str, ...] = tuple(OUTPUT), check_every: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the asked ``columns`` of ``OUTPUT``.

    ``ids`` ends with the end id. ``decoded`` is the library's decoding of ``ids``. Repeated
    rows give repeated results; an empty table gives an empty one.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    agenda_of, cut = Agenda, pieces

    def run(batches):
        agenda = None
        for piece in cut(batches):
            agenda = agenda or agenda_of(model)
            texts = piece.column(piece.schema.get_field_index("text")).to_pylist()
            all_ids, digests = [], []
            for at, text in enumerate(texts):
                ids, line = agenda.encode(text)
                ids.append(agenda.end)
                if at % check_every == 0 and agenda.library.encode(text, add_eos=True) != ids:
                    raise AssertionError(f"encoding differs from the library's: {text[:200]!r}")
                all_ids.append(ids)
                digests.append(hashlib.sha256(line.encode()).hexdigest())
            decoded = agenda.library.decode(all_ids, num_threads=1)
            found = {
                "ids": lambda: pa.array(all_ids, pa.list_(pa.int32())),
                "decoded": lambda: pa.array(decoded, pa.string()),
                "n_tokens": lambda: pa.array([len(i) for i in all_ids], pa.int64()),
                "ids_sha256": lambda: pa.array(digests, pa.string()),
                "decoded_sha256": lambda: pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            }
            yield pa.RecordBatch.from_arrays([piece.column(piece.schema.get_field_index("doc_id")), *(found[c]() for c in columns)], ["doc_id", *columns])

    schema = ", ".join(["doc_id long", *(f"{c} {OUTPUT[c]}" for c in columns)])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
