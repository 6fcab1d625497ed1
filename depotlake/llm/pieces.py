"""Token ids of texts by way of their pieces between single spaces, each encoded once and remembered.

A pre-tokenizer that joins one space to the word after it never joins text across a single space
that stands between two characters that are not white space. So the ids of a text are those of its
pieces in order, each piece with the space before it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that a worker's memory of pieces takes at most.
MEMORY = 256 << 20
#: Strings of more characters are not remembered; there are too many of them, and each is rare.
LONGEST = 64
#: What a dictionary takes for an entry, besides its key and value.
_ENTRY = 100
#: Characters handled at once; a longer text is cut at single spaces.
CHUNK = 1 << 18

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def cuts(text: str, size: int = CHUNK) -> Iterator[tuple[bool, str]]:
    """The text in parts of about size characters, and whether the part stands after a single space."""
    start, after_space = 0, False
    while len(text) - start > size:
        found = _SINGLE_SPACE.search(text, start + size)
        if not found:
            break
        yield after_space, text[start : found.start()]
        start, after_space = found.end(), True
    yield after_space, text[start:]


class Memory:
    """Bytes by short strings, in at most about limit bytes, keys and entries counted.

    There are two generations: if the younger has half of the limit, it becomes the older. Users look
    into both, and put again what they find in the older.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.held = 0  # by the younger
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, found: dict[str, bytes]) -> None:
        """Remembers all short ones, or none if they take more than half of the limit."""
        self.young.update(found)
        self.keep(found)

    def keep(self, found: dict[str, bytes]) -> None:
        """What ``put`` does, with what the younger generation has been given already."""
        short = found
        if max(map(len, found), default=0) > LONGEST:
            short = {key: value for key, value in found.items() if len(key) <= LONGEST}
        cost = sum(map(sys.getsizeof, short)) + sum(map(sys.getsizeof, short.values())) + _ENTRY * len(short)
        full = self.held + cost > self.limit // 2
        if full or short is not found:
            for key in found if full else found.keys() - short.keys():
                del self.young[key]
        if full:
            self.old, self.young, self.held = self.young, {}, 0
            if cost > self.limit // 2:
                return
            self.young.update(short)
        self.held += cost


class Pieces:
    """Encodes texts with encode_many, which gives the ids of each of some strings as bytes."""

    def __init__(self, encode_many: Callable[[Sequence[str]], list[bytes]], memory: int = MEMORY):
        self.encode_many = encode_many
        self.memory = Memory(memory)  # by the piece without its space; none has white space at an end

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text, part by part."""
        for after_space, part in cuts(text):
            yield self._encoded([(after_space, part)])[0]

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text; what is new in any of them is encoded at once."""
        out, short = [b""] * len(texts), []
        for n, text in enumerate(texts):
            if len(text) > CHUNK:
                out[n] = b"".join(self.encode(text))
            else:
                short.append(n)
        for n, ids in zip(short, self._encoded([(False, texts[n]) for n in short])):
            out[n] = ids
        return out

    def encode_column(self, texts: pa.Array, aside: pa.Array | None = None) -> list[np.ndarray]:
        """The ids of each text of an Arrow column, null as empty; the same as ``encode_all`` gives.

        A piece is looked up once in the column, however often it stands there. Texts that are
        ``aside``, very long, or have white space next to a space go through ``encode_all``.
        """
        if not len(texts):
            return []
        texts = pc.fill_null(texts, "")
        long = pc.greater(pc.utf8_length(texts), CHUNK)
        aside = long if aside is None else pc.or_(long, aside)
        split = pc.split_pattern(pc.if_else(aside, pa.scalar("", texts.type), texts), " ")
        ends = split.offsets.to_numpy()[1:].astype(np.int64)
        at_first = split.offsets.to_numpy()[:-1].astype(np.int64)
        pieces = split.flatten()
        later = np.ones(len(pieces), bool)
        later[at_first] = False
        firsts = pieces.take(pa.array(at_first)).to_numpy(zero_copy_only=False).tolist()
        coded = pieces.filter(pa.array(later)).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = np.empty(len(pieces), np.int32)
        codes[later] = coded.indices.to_numpy()
        codes[at_first] = len(names) + np.arange(len(firsts))

        ids = list(map(self.memory.young.get, names))
        holes = [n for n, found in enumerate(ids) if found is None]
        uneven = {n for n in holes if not names[n] or names[n][0].isspace() or names[n][-1].isspace()}
        fresh = {names[n]: self.memory.old.get(names[n]) for n in holes if n not in uneven}
        new = [p for p, found in fresh.items() if found is None]
        made = self.encode_many([first for first in firsts if first] + [" " + p for p in new])
        of_first = iter(made)
        heads = [next(of_first) if first else b"" for first in firsts]
        fresh.update(zip(new, of_first))
        for n in holes:
            ids[n] = b"" if n in uneven else fresh[names[n]]
        self.memory.put(fresh)

        by_library = aside.to_numpy(zero_copy_only=False).copy()
        more = ends - at_first > 1
        by_library |= more & np.array([not first or first[-1].isspace() for first in firsts])
        if uneven:
            odd = np.zeros(len(names) + len(firsts), bool)
            odd[list(uneven)] = True
            by_library |= np.logical_or.reduceat(odd[codes], at_first)

        ids += heads
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        tokens = np.frombuffer(b"".join(ids), "<u4")
        counts = sizes[codes]
        reached = np.cumsum(counts)
        at = np.repeat((np.cumsum(sizes) - sizes)[codes] - reached + counts, counts)
        at += np.arange(len(at))
        found = tokens[at]
        out = np.split(found, reached[ends[:-1] - 1])
        for n in np.flatnonzero(by_library).tolist():
            out[n] = np.frombuffer(self.encode_all([texts[n].as_py()])[0], "<u4")
        return out

    def _encoded(self, parts: Sequence[tuple[bool, str]]) -> list[bytes]:
        known = self.memory.young
        rows = []  # first piece, pieces, last piece
        new: set[str] = set()
        for after_space, part in parts:
            pieces = part.split(" ")
            first, last = "" if after_space else pieces.pop(0), ""
            missing = set(pieces).difference(known)
            uneven = pieces and not after_space and (not first or first[-1].isspace())
            if uneven or any(not p or p[0].isspace() or p[-1].isspace() for p in missing):
                # white space next to a space: pieces end at single spaces only
                pieces = _SINGLE_SPACE.split(part)
                first = "" if after_space else pieces.pop(0)
                if pieces and pieces[-1][-1].isspace():
                    last = " " + pieces.pop()
                missing = set(pieces).difference(known)
            new.update(missing)
            rows.append((first, pieces, last))
        edges = [x for first, _, last in rows for x in (first, last) if x]
        older = self.memory.old
        fresh = {p: older[p] for p in new if p in older}
        ordered = [p for p in new if p not in fresh]
        made = self.encode_many(edges + [" " + p for p in ordered])
        fresh.update(zip(ordered, made[len(edges) :]))
        known.update(fresh)
        of_edge = iter(made)
        out = []
        for first, pieces, last in rows:
            head = next(of_edge) if first else b""
            tail = next(of_edge) if last else b""
            out.append(head + b"".join(map(known.__getitem__, pieces)) + tail)
        self.memory.keep(fresh)
        return out
