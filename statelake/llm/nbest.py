"""N-best segmentation over a SentencePiece vocabulary, and decoding.

A text's lattice has an edge for every piece that occurs in it. Forward Viterbi scores
say how well each prefix can be segmented; they are exact heuristics for an A-star search
that runs backwards from the end, which therefore delivers whole segmentations best first.

No piece goes on across a space or a line feed, so the lattice falls apart there into units. Forward
scores of all units of a batch are computed together in numpy, with the best and the
second best path of each. Only the n - 1 units of a text with the smallest distance
between both can differ from their best path in the n best segmentations of the text
(any other would need n better ones to fail): the search runs on these and their
lists are merged.

The vocabulary is a byte-pair one whose scores are merge ranks; a piece's weight is
-log(2 + rank), the logarithm of a Zipf law, in units of 2 ** -20 so that sums are exact. A character outside the
vocabulary is spelled in byte pieces, at the lowest weight less ten.

Defined results: null or empty text has one segmentation, the empty one; a text with fewer
than n segmentations has fewer rows; equal scores come in a fixed order; rows with a null
``doc_id`` and repeated rows are answered like others; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Lately, lasting, small_batches, text_of
from .prefix_join import mixed

SCALE = 1 << 20
FAR = 1 << 50
SPACE_MARK = "▁"
STEP = np.uint64(0x100000001B3)
LONG = 40
SLOT_BITS = 18


class Vocabulary:
    """Pieces with integer weights; bytes of every id for decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.weight: dict[str, tuple[int, int]] = {}
        self.bytes: list[bytes] = []
        spell = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                spell[int(piece[1:-1], 16)] = i
                self.bytes.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
            else:
                self.weight[piece] = (i, round(-math.log(2 - min(0.0, model.get_score(i))) * SCALE))
                self.bytes.append(piece.encode())
        self.spell = [spell[b] for b in range(256)]
        self.outside = min(w for _, w in self.weight.values()) - 10 * SCALE
        self.longest = max(map(len, self.weight))
        # Characters that stand in no longer piece: every segmentation cuts around them.
        inner = {c for p in self.weight if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\r\t" if c not in inner)
        self.units = re.compile(f"[{re.escape(alone)}]|{SPACE_MARK}+[^{SPACE_MARK}{re.escape(alone)}]*|[^{SPACE_MARK}{re.escape(alone)}]+")
        pieces = list(self.weight)
        codes = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(codes)
        self.codes = codes[order]
        self.ids = np.array([self.weight[p][0] for p in pieces], np.int64)[order]
        self.weights = np.array([self.weight[p][1] for p in pieces], np.int64)[order]
        # Where a code may be found, by its first bits: -1 nowhere, -2 ask the sorted codes.
        slot = (self.codes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slots[slot] = np.where(np.bincount(slot, minlength=1 << SLOT_BITS)[slot] > 1, -2, np.arange(len(slot)))

    def find(self, code: np.ndarray) -> np.ndarray:
        """Place of each code among the sorted ones, -1 where it is none of them."""
        at = self.slots[(code >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.int64)
        if (at == -2).any():
            some = at == -2
            at[some] = np.minimum(np.searchsorted(self.codes, code[some]), len(self.codes) - 1)
        return np.where((at >= 0) & (self.codes[at] == code), at, -1)

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * STEP + np.uint64(ord(c) + 1)
        return mixed(h)[0]

    def letters(self, char: str) -> bytes:
        """Ids of a character outside the vocabulary."""
        return np.array([self.spell[b] for b in char.encode("utf-8", "surrogatepass")], "<u4").tobytes()

    def split(self, text: str) -> list[str]:
        return self.units.findall(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace").replace(SPACE_MARK, " ")
        return text[1:] if text.startswith(" ") else text

    def edges(self, unit: str) -> list[list[tuple[int, bytes, int]]]:
        """For each place, the pieces that end there: (start, ids, weight)."""
        found: list[list[tuple[int, bytes, int]]] = [[] for _ in range(len(unit) + 1)]
        for start in range(len(unit)):
            if unit[start] not in self.weight:
                found[start + 1].append((start, self.letters(unit[start]), self.outside))
            for end in range(start + 1, min(len(unit), start + self.longest) + 1):
                if (hit := self.weight.get(unit[start:end])) is not None:
                    found[end].append((start, np.array([hit[0]], "<u4").tobytes(), hit[1]))
        return found

    def search(self, unit: str, n: int) -> list[tuple[int, bytes]]:
        """The n best (score, ids) of a unit."""
        edges = self.edges(unit)
        best = [0] * (len(unit) + 1)
        for place in range(1, len(unit) + 1):
            best[place] = max(best[start] + w for start, _, w in edges[place])
        # (minus the score of the best completion, tie, place, score behind it, ids behind it)
        heap = [(-best[-1], 0, len(unit), 0, None)]
        count, visits, found = 0, [0] * (len(unit) + 1), []
        while heap and len(found) < n:
            _, _, place, behind, tail = heapq.heappop(heap)
            if place == 0:
                parts = []
                while tail is not None:
                    parts.append(tail[0])
                    tail = tail[1]
                found.append((behind, b"".join(parts)))
                continue
            visits[place] += 1
            if visits[place] > n:
                continue
            for start, ids, w in edges[place]:
                count += 1
                heapq.heappush(heap, (-(behind + w + best[start]), count, start, behind + w, (ids, tail)))
        return found

    def forward(self, units: list[str]) -> list[tuple[int, int, bytes]]:
        """(best score, distance to the second best path, ids of the best) of each unit."""
        out: list[tuple[int, int, bytes] | None] = [None] * len(units)
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        at = 0
        while at < len(order):
            if len(units[order[at]]) > LONG:
                two = self.search(units[order[at]], 2)
                out[order[at]] = (two[0][0], two[0][0] - two[1][0] if len(two) > 1 else FAR, two[0][1])
                at += 1
                continue
            to = at + 1
            while to < len(order) and len(units[order[to]]) <= LONG and (to - at) * len(units[order[to]]) < 40_000:
                to += 1
            part = order[at:to]
            for i, row in zip(part, self._forward([units[i] for i in part]), strict=True):
                out[i] = row
            at = to
        return out

    def _forward(self, units: list[str]) -> list[tuple[int, int, bytes]]:
        sizes = np.array([len(u) for u in units])
        n, wide = len(units), int(sizes.max())
        chars = np.frombuffer("".join(u.ljust(wide, "\0") for u in units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, wide).astype(np.uint64)
        best, second = np.full((wide + 1, n), -FAR, np.int64), np.full((wide + 1, n), -FAR, np.int64)
        span, piece = np.zeros((wide + 1, n), np.int64), np.full((wide + 1, n), -1, np.int64)
        best[0] = 0
        h = np.zeros((n, wide), np.uint64)
        hits = []
        for length in range(1, min(self.longest, wide) + 1):
            # h[:, s] covers the ``length`` characters from s on.
            h = h[:, :wide - length + 1] * STEP + chars[:, length - 1:] + np.uint64(1)
            code = mixed(h)
            place = self.find(code).T
            hit = place >= 0
            weight = np.where(hit, self.weights[place], self.outside if length == 1 else -FAR)
            hits.append((weight, np.where(hit, self.ids[place], -1), hit.any(1) | (length == 1)))
        for end in range(1, wide + 1):
            for length in range(1, min(end, len(hits)) + 1):
                start = end - length
                if not hits[length - 1][2][start]:
                    continue
                weight = hits[length - 1][0][start]
                one = best[start] + weight
                # Second best: of what ends here so far, the new path and its own second.
                np.maximum(second[end], second[start] + weight, out=second[end])
                np.maximum(second[end], np.minimum(best[end], one), out=second[end])
                better = one > best[end]
                np.copyto(best[end], one, where=better)
                np.copyto(span[end], length, where=better)
                np.copyto(piece[end], hits[length - 1][1][start], where=better)
        rows = np.arange(n)
        score, other = best[sizes, rows], second[sizes, rows]
        # Back along the best path, all units at once.
        at, steps = sizes.copy(), []
        while (at > 0).any():
            ids, back = piece[at, rows], span[at, rows]
            live = at > 0
            steps.append(np.where(live, ids, -2))
            at = np.where(live, at - back, 0)
        path = np.stack(steps[::-1], 1)
        gap = np.where(other > -FAR // 2, score - other, FAR)
        plain = ~(path == -1).any(1)
        packed, counts = path.astype("<u4"), (path >= 0).sum(1)
        found = []
        width = path.shape[1]
        for i, (s, g, easy, c) in enumerate(zip(score.tolist(), gap.tolist(), plain.tolist(), counts.tolist(), strict=True)):
            found.append((s, g, packed[i, width - c:].tobytes() if easy else self._spelled(units[i], path[i])))
        return found

    def _spelled(self, unit: str, path: np.ndarray) -> bytes:
        parts, at = [], 0
        for i in path.tolist():
            if i == -1:
                parts.append(self.letters(unit[at]))
                at += 1
            elif i >= 0:
                parts.append(np.array([i], "<u4").tobytes())
                at += len(self.bytes[i].decode())
        return b"".join(parts)


class Segmenter:
    """N best segmentations of whole texts; knows the units of the last texts."""

    def __init__(self, vocabulary: Vocabulary, n: int, most: int = 300_000):
        self.vocabulary, self.n, self.known = vocabulary, n, Lately(most)

    def __call__(self, texts: list[str]) -> Iterator[list[tuple[int, bytes]]]:
        split = [self.vocabulary.split(t) for t in texts]
        self.known.provide(set().union(*split), self.vocabulary.forward)
        for units in split:
            rows = list(map(self.known.__getitem__, units))
            best = sum(r[0] for r in rows)
            ids = [r[2] for r in rows]
            near = np.argsort([r[1] for r in rows], kind="stable")[:self.n - 1].tolist() if rows else []
            # Merge the lists of these units, always keeping the n best.
            merged: list[tuple[int, tuple[tuple[int, bytes], ...]]] = [(0, ())]
            for i in near:
                if rows[i][1] >= FAR:
                    continue
                options = [(rows[i][0] - s, part) for s, part in self.vocabulary.search(units[i], self.n)]
                merged = sorted(
                    ((loss + more, (*chosen, (i, part))) for loss, chosen in merged for more, part in options), key=lambda x: (x[0], x[1]))[:self.n]
            found = []
            for loss, chosen in merged:
                parts = ids
                if chosen:
                    parts = ids.copy()
                    for i, part in chosen:
                        parts[i] = part
                found.append((best - loss, b"".join(parts)))
            yield found


ANSWER = "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"


def segmentations(documents: DataFrame, model: str, n: int = 3, ids: bool = True) -> DataFrame:
    """doc_id, rank (from 1), score, n_pieces, ids_crc32, round_trip and, if wanted, ids of the n best."""
    small_batches(documents.sparkSession)
    schema = ANSWER + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = lasting(f"segmenter {model} {n}", lambda: Segmenter(Vocabulary(model), n))
        vocabulary = segment.vocabulary
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows, pieces = [], []
            for doc, text, found in zip(batch.column("doc_id").to_pylist(), texts, segment(texts), strict=True):
                for rank, (score, data) in enumerate(found, 1):
                    rows.append((doc, rank, score / SCALE, len(data) // 4, zlib.crc32(data), vocabulary.decode(data) == text))
                    if ids:
                        pieces.append(np.frombuffer(data, "<i4"))
            if rows:
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                columns[0], columns[1] = columns[0].cast(pa.int64()), columns[1].cast(pa.int32())
                names = ["doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip"]
                if ids:
                    columns.append(pa.array(pieces, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(documents).alias("text")).mapInArrow(run, schema)


def decoded(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, rank, text of rows with ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            texts = [vocabulary.decode(np.array(i or [], "<u4").tobytes()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rank"), pa.array(texts, pa.string())], names=["doc_id", "rank", "text"])

    return encoded.select("doc_id", "rank", "ids").mapInArrow(run, "doc_id long, rank int, text string")
