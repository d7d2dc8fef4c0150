"""Encoding with a sentencepiece BPE model, and decoding, without the library's own encoder.

Merge-type BPE has one encoding of a text: the sequence of pieces in which every two neighbours are what
merging their joined text gives back. So a text can be encoded without merging it as a whole: walk from
left to right, take the longest piece that starts here (an Aho-Corasick pass lists all of them), accept it
if it is compatible with the piece before it, else try the next shorter one; with none left, step back over
the piece before and mark its end as failed in a bit field, so that no position is tried twice. Whether two
pieces are compatible is found by merging their joined text again, once for each pair.

No piece of the model holds a blank mark after another character, so merges never pass the start of a run of
blanks. Pieces of blanks alone have the worst score of all, so a word with one blank before it is merged as if no other blank
were there; it is encoded on its own and remembered while its partition lasts. The blanks before that, and the last one too if it
stays alone, merge from the left to the longest piece that there is of them. A model that isn't like this is refused.

Nulls count as empty texts and have no ids. A literal U+2581 is a blank, as for the library. Repeated rows
give repeated results; an empty table gives an empty table; columns other than the two named are ignored.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import lean

BLANK = "▁"
#: Words that a task remembers in each of two generations, the longest of them in characters, and pairs of pieces; some 70 MB in all.
REMEMBERED, REMEMBERED_CHARS, PAIRS = 120_000, 48, 200_000
#: Texts that are given back together.
AT_ONCE = 1000


class Pieces:
    """The tables of one model."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = [0] * 256
        plain = []
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(self.text[i][3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append(i)
        self.id_of = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: model.get_score(i) for i in plain}
        if any(BLANK in piece.lstrip(BLANK) for piece in self.id_of):
            raise ValueError("a piece of this model holds a blank after another character")
        blanks = sorted((piece for piece in self.id_of if not piece.strip(BLANK)), key=len, reverse=True)
        worst = min(self.score.values())
        others = (score for piece, score in self.score.items() if len(piece) > 1 and piece.strip(BLANK))
        if any(self.score[piece] > worst for piece in blanks) or min(others, default=0.0) <= worst:
            raise ValueError("blanks of this model don't merge last")
        if blanks[-1:] != [BLANK] or any(piece.startswith(BLANK * 2) and piece.strip(BLANK) for piece in self.id_of):
            raise ValueError("a word of this model has more blanks than one, or none")
        self.blanks = [(len(piece), self.id_of[piece]) for piece in blanks]
        self.blank = array("i", [self.id_of[BLANK]]).tobytes()
        self.finder = ahocorasick.Automaton()
        # pieces of more blanks than one are left to their own rule
        reachable = {piece for piece in self.id_of if not piece.startswith(BLANK * 2) and self.merged(piece) == [piece]}
        for piece in reachable:
            self.finder.add_word(piece, piece)
        self.finder.make_automaton()
        #: The next shorter piece that a piece starts with.
        self.shorter = {
            piece: next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in reachable), None)
            for piece in reachable
        }
        self.fits: dict[tuple[str, str], bool] = {}
        self.chars = {piece for piece in self.id_of if len(piece) == 1}
        #: What each id stands for, in UTF-8.
        self.raw = [piece.encode("utf-8") for piece in self.text]
        for b, i in enumerate(self.byte_ids):
            self.raw[i] = bytes((b,))
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Merge the characters of text pair by pair: the best score first, of equal ones the leftmost."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (score := self.score.get(both := parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, j, both))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or after[i] != j or parts[j] is None or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [part for part in parts if part is not None]

    def compatible(self, left: str, right: str) -> bool:
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            # a piece of its own never splits again; else merge once more and see
            both = left + right
            found = self.fits[left, right] = both not in self.shorter and self.merged(both) == [left, right]
        return found

    def backtracked(self, text: str) -> list[str]:
        """Encode text, each character of which is a piece."""
        best: list[str] = [""] * len(text)
        for end, piece in self.finder.iter(text):
            start = end + 1 - len(piece)
            if len(piece) > len(best[start]):
                best[start] = piece
        failed = bytearray(len(text) // 8 + 1)
        out: list[str] = []
        at, size, piece = 0, len(text), best[0] if text else ""
        fits, compatible = self.fits, self.compatible
        while at < size:
            while piece:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not out:
                        break
                    pair = (out[-1], piece)
                    if fits[pair] if pair in fits else compatible(*pair):
                        break
                piece = self.shorter[piece]
            if piece:
                out.append(piece)
                at = end
                piece = best[at] if at < size else ""
            else:
                if not out:
                    raise ValueError(f"no encoding of {text!r}")
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= len(last)
                piece = self.shorter[last]
        return out

    def stretch(self, text: str) -> list[str]:
        """Encode a word with unknown characters, which stand alone."""
        out: list[str] = []
        run: list[str] = []
        for char in text:
            if char in self.id_of:
                run.append(char)
            else:
                out += self.backtracked("".join(run))
                out.append(char)
                run = []
        return out + self.backtracked("".join(run))

    def coded(self, word: str) -> bytes:
        """The ids of a blank and the word after it, as int32 bytes."""
        text = BLANK + word
        ids: list[int] = []
        for piece in self.backtracked(text) if self.chars.issuperset(text) else self.stretch(text):
            if (i := self.id_of.get(piece)) is not None:
                ids.append(i)
            else:
                ids += [self.byte_ids[b] for b in piece.encode("utf-8")]
        found = array("i", ids).tobytes()
        if len(word) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.before, self.known = self.known, {}
            self.known[word] = found
        return found

    def run_of(self, n: int) -> bytes:
        """The ids of n blanks: the leftmost two merge first, so each piece grows as far as it can."""
        ids = array("i")
        for length, i in self.blanks:
            ids.extend([i] * (n // length))
            n %= length
        return ids.tobytes()

    def decode(self, ids: bytes) -> str:
        """The text that ids, as int32 bytes, stand for; the blank put before a text goes again."""
        raw = self.raw
        return b"".join([raw[i] for i in array("i", ids)]).decode("utf-8", "replace").replace(BLANK, " ")[1:]

    def encode(self, text: str | None) -> bytes:
        """The ids of text, as int32 bytes."""
        if not text:
            return b""
        ids: list[bytes] = []
        blanks = 0
        for word in text.replace(BLANK, " ").split(" "):
            if not word:
                blanks += 1
                continue
            found = self.known.get(word) or self.before.get(word) or self.coded(word)
            if blanks:
                if found.startswith(self.blank):
                    blanks, found = blanks + 1, found[len(self.blank) :]
                ids.append(self.run_of(blanks))
                blanks = 0
            ids.append(found)
        if blanks:
            ids.append(self.run_of(blanks))
        return b"".join(ids)

    def forget(self) -> None:
        """Give up what is remembered, as workers outlive their tasks."""
        self.known, self.before, self.fits = {}, {}, {}


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, ``ids`` array<int> (never null), ``decoded`` string (the text decoded from ids)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model_path)
        for large in batches:
            for at in range(0, large.num_rows, AT_ONCE):
                batch = large.slice(at, AT_ONCE)
                coded = [coder.encode(x) for x in batch.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
                values = np.frombuffer(b"".join(coded), dtype="<i4")
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                plain = pa.array([coder.decode(x) for x in coded], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, plain], names=[id_col, "ids", "decoded"])
        coder.forget()

    narrow = docs.select(F.col(id_col), F.col(text_col))
    return narrow.mapInArrow(lean(run), f"`{id_col}` {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id", more: Sequence[str] = ()) -> DataFrame:
    """The contract's columns from those of encode(), and more of them."""
    return encoded.select(
        F.col(id_col),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        *more,
    )
