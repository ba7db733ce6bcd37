"""Texts cut where a tokenizer's own rules always cut, so that a part is encoded once and its ids are reused.

A cache lives as long as its Python worker and is emptied when it is full, so that memory is bounded.
"""

from __future__ import annotations

import hashlib
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Entries of a worker's cache, at about 200 bytes each.
CACHE_PARTS = 1_000_000
#: New parts that go to a byte-level tokenizer as the lines of one text.
JOINED_PARTS = 500


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def file_digest(path: str) -> str:
    """The tokenizer's version: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _plain_stem(part: str) -> bool:
    """Whether the part is a word of Latin letters' end plus one punctuation mark, which every splitter here parts.

    The last letter must stay one character when lowered: what a longer form ends with may go with the mark.
    """
    if len(part) < 3 or part[-1] not in ".,;:!?":
        return False
    last = part[-2]
    return last.isalpha() and (last.isascii() or last < "ɐ" and len(unicodedata.normalize("NFC", last.lower())) == 1)


class PartCache(dict):
    """part -> encoded value.  A part that is asked for and unknown gives None and is noted, for the next ``fill``.

    ``split`` cuts a part into stems, each with the cache that holds it, or
    refuses it (None); parts that are ``plain`` are stems themselves.
    ``encode`` turns a list of stems into values that join by ``+``.
    """

    def __init__(self, encode: Callable[[list[str]], list], split: Callable[[str], list[tuple[PartCache, str]] | None],
                 plain: Callable[[str], bool] = str.isalpha):
        self.encode, self.split, self.plain, self.asked, self.old = encode, split, plain, set(), {}

    def __missing__(self, part: str) -> None:
        self.asked.add(part)

    def trim(self, parts: int) -> None:
        """Make a half-full cache the old one, from which parts come back as they are asked for: those that never are
        go with the next one.  Between batches only, as a batch needs all its parts at once."""
        if len(self) > parts // 2:
            self.old = dict(self)
            self.clear()

    def learn(self, stems: set[str]) -> None:
        new = list(stems)
        self.update(zip(new, self.encode(new), strict=True))

    def fill(self) -> None:
        """Encode what was asked for.  What ``split`` refuses stays unknown."""
        asked, self.asked = self.asked, set()
        back = asked & self.old.keys()
        self.update({p: self.old[p] for p in back})
        asked -= back
        plain = set(filter(self.plain, asked))
        cut, new = {}, {id(self): (self, plain)}
        for p in asked - plain:
            subs = self.split(p)
            if not subs:
                continue
            if len(subs) > 1:
                cut[p] = subs
            for cache, s in subs:
                if s not in cache:
                    new.setdefault(id(cache), (cache, set()))[1].add(s)
        for cache, stems in new.values():
            cache.learn(stems)
        for p, subs in cut.items():
            v = subs[0][0][subs[0][1]]
            for cache, s in subs[1:]:
                v = v + cache[s]
            self[p] = v

    def values_of(self, cut: list[list[str]], parts: int) -> list[list]:
        """The values of each text's parts; None for those that were refused."""
        self.trim(parts)
        found = [list(map(self.__getitem__, ps)) for ps in cut]
        if self.asked:
            self.fill()
            for values, ps in zip(found, cut, strict=True):
                if None in values:  # only unknown places are looked up again
                    for i in [i for i, v in enumerate(values) if v is None]:
                        values[i] = self.get(ps[i])
            self.asked = set()
        return found


# ------------------------------------------------------------------ byte-level BPE (tokenizers library)


def _usual(path: str) -> bool:
    """Whether a file's texts are taken as they are and cut by the byte-level pre-tokenizer's own expression."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    cut = spec.get("pre_tokenizer") or {}
    return not spec.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")


def _latin_word(part: str) -> bool:
    """Whether a part is Latin letters, perhaps after a space: one word for the byte-level pre-tokenizer's expression,
    so that the library's model alone encodes it."""
    word = part[1:] if part[:1] == " " else part
    return word.isalpha() and (word.isascii() or max(word) < "ɐ")


def _bytes_in(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Bytes: ASCII white space, other visible ASCII, letters, and what begins U+00C0 to U+07FF, none of which is white space.
_BLANK, _SEEN = _bytes_in([(0x09, 0x0D), (0x1C, 0x20)]), _bytes_in([(0x21, 0x7E)])
_LETTER, _LATIN = _bytes_in([(0x41, 0x5A), (0x61, 0x7A)]), _bytes_in([(0xC3, 0xDF)])


class ByteLevelParts:
    """Ids of whole texts under a byte-level BPE file of the tokenizers library.

    Its pre-tokenizer always starts a new token at a single space that stands
    between two characters that are no white space, and at a single line feed
    that does, on both sides; a special token's string holds neither.  Its
    usual expression also parts a letter from a mark after it; marks of special
    strings are left out.  A word of Latin letters, which that expression never
    parts, goes to the library's model at once, its bytes as the characters that
    the pre-tokenizer shows them by.  Texts with any other white space beside a
    space go to the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer = library_tokenizer(path)
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        special = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.usual = _usual(path)
        self.marks = _bytes_in([(ord(m), ord(m)) for m in ".,;:!?" if self.usual and m not in special])
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that are shown as themselves
        self.shown = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in kept)}
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None
        self.first = PartCache(self._encode, lambda p: self._split(p, self.first))
        self.later = PartCache(lambda ps: self._encode([" " + p for p in ps]), lambda p: self._split(p, self.later))

    def _encode(self, parts: list[str]) -> list[bytes]:
        if not self.usual:
            return self._piped(parts)
        kind, model, shown, space = self.kind, self.tokenizer.model.tokenize, self.shown, chr(self.shown[32])
        out = [array(kind, [t.id for t in model(p.replace(" ", space) if p.isascii() else p.encode().decode("latin-1").translate(shown))]).tobytes()
               if _latin_word(p) else None for p in parts]
        others = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(others, self._piped([parts[i] for i in others]), strict=True):
            out[i] = ids
        return out

    def _piped(self, parts: list[str]) -> list[bytes]:
        """Parts encoded by all steps of the library."""
        kind, out = self.kind, []
        for at in range(0, len(parts), JOINED_PARTS):
            some = parts[at:at + JOINED_PARTS]
            out += self._joined(some) or [
                array(kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def _joined(self, parts: list[str]) -> list[bytes] | None:
        """Parts encoded as the lines of one text, which the library does in less time; None where a line feed's id
        doesn't stand between all of them and nowhere else, as with parts that hold one or that white space ends."""
        if self.feed is None or len(parts) < 2 or any(p[-1:].isspace() or "\n" in p for p in parts):
            return None
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(parts)], add_special_tokens=False)[0].ids, dtype=self.kind)
        cuts = np.flatnonzero(ids == self.feed)
        if len(cuts) != len(parts) - 1:
            return None
        return [ids[a:b].tobytes() for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True)]

    def _split(self, part: str, of: PartCache) -> list[tuple[PartCache, str]] | None:
        """Stems of a part that follows a space (``later``) or none (``first``)."""
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        if "\n" not in part:
            return [(of, part[:-1]), (self.first, part[-1])] if _plain_stem(part) else [(of, part)]
        lines = part.split("\n")
        if any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return [(of, part)]
        out = []
        for i, x in enumerate(lines):
            if i:
                out.append((self.first, "\n"))
                of = self.first
            out += [(of, x[:-1]), (self.first, x[-1])] if _plain_stem(x) else [(of, x)]
        return out

    def _cuts(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places where the parts of texts begin, texts with ASCII white space or an end beside a space): the texts'
        UTF-8 bytes follow each other in ``data``, from one of ``ends`` to the next."""
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[ends] = True  # ends of texts, and the place after the last
        beside = np.concatenate([[32], data, [32]])  # the byte before place i is beside[i], the one after it beside[i + 2]
        at = np.flatnonzero(data == 32)
        bad = _BLANK[beside[at]] | _BLANK[beside[at + 2]] | begins[at] | begins[at + 1]
        odd = np.unique(np.searchsorted(ends, at[bad], side="right") - 1)
        feeds = np.flatnonzero(data == 10)
        feeds = feeds[~(begins[feeds] | begins[feeds + 1])]
        before, after = beside[feeds], beside[feeds + 2]
        two = (before >= 0x80) & _LATIN[beside[np.maximum(feeds - 1, 0)]]
        feeds = feeds[(_SEEN[before] | two) & (_SEEN[after] | _LATIN[after])]
        marks = np.flatnonzero(self.marks[data])
        begins[marks[_LETTER[beside[marks]]]] = True
        begins[at] = begins[feeds] = begins[feeds + 1] = True
        begins[-1] = False
        return np.flatnonzero(begins), odd

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 16-bit ids of each text, or 32-bit ones where the vocabulary needs them.

        The texts are cut as bytes, before spaces and some marks and around
        line feeds; a part that comes often in them is looked up once."""
        rows = pa.array(texts, pa.large_string())
        ends = np.frombuffer(rows.buffers()[1], np.int64, len(texts) + 1) if texts else np.zeros(1, np.int64)
        if not ends[-1]:
            return [np.empty(0, self.kind)] * len(texts)
        data = np.frombuffer(rows.buffers()[2], np.uint8, ends[-1])
        begins, odd = self._cuts(data, ends)
        parts = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(data))), rows.buffers()[2]).dictionary_encode()
        codes, known = parts.indices.to_numpy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        if "\n" not in self.first:
            self.first.learn({"\n"})
        spaced = np.fromiter((p[0] == " " for p in known), bool, len(known))
        (heads,) = self.first.values_of([[p for p in known if p[0] != " "]], CACHE_PARTS // 4)
        (rest,) = self.later.values_of([[p[1:] for p in known if p[0] == " "]], CACHE_PARTS)
        place = np.where(spaced, np.cumsum(spaced) - 1 + len(heads), np.cumsum(~spaced) - 1)
        values = heads + rest
        of = np.searchsorted(begins, ends)  # each text's first part
        unknown = np.fromiter((v is None for v in values), bool, len(values))[place]
        if unknown.any():
            odd = np.union1d(odd, np.searchsorted(of, np.flatnonzero(unknown[codes]), side="right") - 1)
        joined = pa.array(values, pa.large_binary()).fill_null(b"").take(pa.array(place[codes]))
        width = np.dtype(self.kind).itemsize
        to = np.frombuffer(joined.buffers()[1], np.int64, len(codes) + 1)[of] // width
        ids = np.frombuffer(joined.buffers()[2], self.kind, to[-1])
        out = [ids[a:b] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]
        for i, one in zip(odd.tolist(), self._encode([texts[i] for i in odd]), strict=True):
            out[i] = np.frombuffer(one, self.kind)
        return out


# ------------------------------------------------------------------ counts under any file


class WordCounts:
    """Token counts of whole texts under a tokenizers file that drops white space.

    Each run between spaces, tabs and line ends is counted by itself: the
    normalizer turns white space into one space, the pre-tokenizer removes it,
    and no token or special string holds any.  ASCII runs share an entry in
    lower case, but for those that hold a special string as they are or lowered:
    the library looks for these before it lowers a text.
    """

    def __init__(self, path: str):
        self.tokenizer = library_tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = PartCache(self._encode, self._split, lambda p: p.isalpha() and (p.islower() or not p.isascii()))

    def _split(self, part: str) -> list[tuple[PartCache, str]]:
        lower = part.lower() if part.isascii() else part
        if any(s in part or s in lower for s in self.special):
            return [(self.known, part)]
        if _plain_stem(lower):
            return [(self.known, lower[:-1]), (self.known, lower[-1])]
        return [(self.known, part)] if lower == part else [(self.known, lower), (self.known, "")]

    def _encode(self, parts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        cut = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        return [sum(v) for v in self.known.values_of(cut, CACHE_PARTS)]


class WholeCounts:
    """Token counts of whole texts under any file, each text encoded by its library at once."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            t = library_tokenizer(path)
            self.counts = lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def byte_level(path: str) -> ByteLevelParts:
    return ByteLevelParts(path)


@lru_cache(maxsize=4)
def counter(path: str) -> WordCounts | WholeCounts:
    """The counter for a file: by parts where its normalizer and pre-tokenizer drop white space, else by whole texts."""
    import json

    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if any(s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " " for s in steps) \
                and any(c.get("behavior") == "Removed" and c.get("invert") for c in cuts):
            return WordCounts(path)
    return WholeCounts(path)
