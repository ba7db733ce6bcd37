"""Operator 7, encoding and decoding with a merge-type SentencePiece vocabulary."""

from __future__ import annotations

import hashlib
import heapq
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.llm.common import pieces, text_or_empty, texts
from reelkit.llm.vocab import PartCache

#: Fixed value: the library writes a space as this character.
SPACE = "▁"
#: Parts that a worker keeps; at about 200 bytes each.
ENTRIES = 600_000
#: One in so many whole texts is also encoded by the library, and compared.
CHECK_EVERY = 64


#: Symbols up to which the agenda is a list, and what stands for a pair that makes no piece.
SHORT, NONE = 40, float("inf")


class Agenda:
    """Merges symbols of a part in the order of their pairs' scores, leftmost first among equals.

    The agenda is a heap of adjacent pairs whose joined string is a piece (for
    short parts a list in the order of places, with the same result).  Symbols are a doubly linked list; a pair popped after one of its symbols
    has been merged is stale and skipped.
    """

    def __init__(self, model: str):
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = sp.unk_id()
        kept = (i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
        self.ids = {sp.id_to_piece(i): i for i in kept}
        self.score = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.fallback = sp.is_byte(self.bytes[0])
        #: no piece joins a character to a following space or line feed, so that a part may begin there
        self.breaks = [c for c in (SPACE, "\n") if not any(c in p[1:].lstrip(c if p[0] == c else "") for p in self.ids)]

    def symbols(self, part: str) -> list[str]:
        return self._short(part) if len(part) <= SHORT else self._long(part)

    def _short(self, part: str) -> list[str]:
        """The agenda as a plain list in the order of places: for few symbols its least entry is found fastest so."""
        score, none = self.score.get, NONE
        sym = list(part)
        agenda = [score(a + b, none) for a, b in zip(part, part[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            sym[i] += sym.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = score(sym[i - 1] + sym[i], none)
            if i < len(agenda):
                agenda[i] = score(sym[i] + sym[i + 1], none)
        return sym

    def _long(self, part: str) -> list[str]:
        score = self.score
        sym, n = list(part), len(part)
        prev, nxt, gone = list(range(-1, n - 1)), list(range(1, n + 1)), [False] * n
        heap = []
        for i in range(n - 1):
            s = score.get(sym[i] + sym[i + 1])
            if s is not None:
                heap.append((s, i, i + 1, len(sym[i]) + len(sym[i + 1])))
        heapq.heapify(heap)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if gone[i] or gone[j] or len(sym[i]) + len(sym[j]) != size or nxt[i] != j:
                continue
            sym[i] += sym[j]
            gone[j] = True
            k = nxt[i] = nxt[j]
            if k < n:
                prev[k] = i
                s = score.get(sym[i] + sym[k])
                if s is not None:
                    heapq.heappush(heap, (s, i, k, len(sym[i]) + len(sym[k])))
            h = prev[i]
            if h >= 0:
                s = score.get(sym[h] + sym[i])
                if s is not None:
                    heapq.heappush(heap, (s, h, i, len(sym[h]) + len(sym[i])))
        return [x for x, dead in zip(sym, gone, strict=True) if not dead]

    def encode(self, part: str) -> list[int]:
        """Ids of a part in which spaces are written as SPACE."""
        out, ids = [], self.ids
        for x in self.symbols(part):
            i = ids.get(x)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out += [self.bytes[b] for b in x.encode()]
            else:
                out.append(self.unknown)
        return out


class PieceEncoder:
    """Whole texts by parts: a part is what stands before the next space that follows another character.

    Every part that is new to this worker is encoded by the agenda, and the
    batch of new parts that begin with a space, as well as some whole texts, is
    checked against the library; a difference raises.
    """

    def __init__(self, model: str):
        self.agenda = Agenda(model)
        self.library = self.agenda.library
        self.checked = 0
        size = self.library.get_piece_size()
        self.kind = "H" if size <= 1 << 16 else "I"
        self.decimal = [str(i) for i in range(size)]
        self.known = PartCache(lambda ps: self._encode(ps, SPACE), lambda p: self._split(p))
        self.bare = PartCache(lambda ps: self._encode(ps, ""), lambda p: [(self.bare, p)])  # parts that no space precedes
        self.by_space = SPACE in self.agenda.breaks
        self.by_line = "\n" in self.agenda.breaks
        #: marks that no piece joins to a letter before them, so that they are parts of their own at a word's end
        self.marks = {c for c in ".,;:!?" if not any(x.isalpha() and y == c for p in self.agenda.ids for x, y in zip(p, p[1:]))}

    def _split(self, part: str) -> list[tuple[PartCache, str]]:
        out, of = [], self.known
        for i, x in enumerate(part.split("\n") if self.by_line else [part]):
            if i:
                out.append((self.bare, "\n"))
                of = self.bare
            if len(x) > 2 and x[-1] in self.marks and x[-2].isalpha():
                out += [(of, x[:-1]), (self.bare, x[-1])]
            elif x or of is self.known:
                out.append((of, x))
        return out

    def _encode(self, parts: list[str], before: str) -> list[bytes]:
        got = [self.agenda.encode(before + p.replace(" ", SPACE)) for p in parts]
        if before:
            for p, a, b in zip(parts, got, self.library.encode(parts, num_threads=1), strict=True):
                if a != b and p:
                    raise AssertionError(f"agenda and library differ on {p!r}: {a} and {b}")
        kind = self.kind
        return [array(kind, ids).tobytes() for ids in got]

    def parts(self, text: str) -> list[str]:
        """Parts without the space before them; runs of spaces stay with the word that they precede."""
        found = text.replace(SPACE, " ").split(" ") if self.by_space else [text]
        if "" not in found or len(found) == 1:
            return found
        out, run = [], ""
        for x in found:
            if x:
                out.append(run + x)
                run = ""
            else:
                run += " "
        if run:  # the text ends in spaces
            out.append(run[:-1])
        return out

    def encode(self, texts: list[str]) -> list[tuple[str, list[int]]]:
        """(decimal ids, ids) of each text; an empty text has none."""
        cut = [self.parts(t) if t else [] for t in texts]
        self.bare.trim(ENTRIES)
        found = self.known.values_of(cut, ENTRIES)
        decimal = self.decimal.__getitem__
        out = []
        for values in found:
            ids = memoryview(b"".join(values)).cast(self.kind).tolist()
            out.append((" ".join(map(decimal, ids)), ids))
        check = self.checked % CHECK_EVERY  # whole texts too, now and then: that parts join as the library joins them
        for i in range(-check % CHECK_EVERY, len(texts), CHECK_EVERY):
            if self.library.encode(texts[i]) != out[i][1]:
                raise AssertionError(f"parts and library differ on {texts[i][:200]!r}")
        self.checked += len(texts)
        return out


@lru_cache(maxsize=2)
def encoder(model: str) -> PieceEncoder:
    return PieceEncoder(model)


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _run(model: str, keep: list[str], with_ids: bool):
    def run(batches):
        enc = encoder(model)
        end = enc.library.eos_id()
        for batch in batches:
            for part in pieces(batch, "__text", 2 << 20):
                found = enc.encode(texts(part, "__text"))
                decoded = enc.library.decode([[*ids, end] for _, ids in found])
                sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
                cols = [part.column(c) for c in keep]
                cols += [pa.array([len(ids) + 1 for _, ids in found], pa.int64()),
                         pa.array([sha(f"{s} {end}" if s else str(end)) for s, _ in found]),
                         pa.array([sha(d) for d in decoded])]
                names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.array([[*ids, end] for _, ids in found], pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def encode_decode(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, with an end id (and, if asked, ids and decoded).

    Runs in the scan's tasks, with no shuffle.  Null text: empty, only the end
    id.  Repeated ids: a row each.  Empty table: no rows.  Very long texts are
    handled one a slice.  Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("__text"))
    extra = ", ids array<int>, decoded string" if with_ids else ""
    return rows.mapInArrow(_run(model, ["doc_id"], with_ids), f"doc_id long, {SCHEMA}{extra}")
