"""Token ids of whole texts, by the tokenizers library, word by word from a bounded cache.

Encoding a text word by word equals encoding it whole where every cut is one that the tokenizer's own
pre-splitting makes. ``dropped`` tokenizers (white space is thrown away) are cut at every space and line
end. ``glued`` tokenizers (byte level, a space opens the next word) are cut before a space and around a line
end; texts with other or longer runs of white space, where the pre-splitting depends on the run, and texts
that hold one of the tokenizer's added tokens, are encoded whole.

Texts are cut and their words numbered many at once by Arrow kernels, so Python sees a word once a block of
texts; ids are then gathered from one array. A new word of a plain alphabet is split as the tokenizer's
pre-splitting does, and each piece goes through the library's merges; others are encoded by the whole library,
many at once, with a separator between them whose own id shows where each ends. The cache is emptied when
full of all words but those that came up most, which bounds a worker's memory, and of everything when a worker has
had no text for some seconds, so that later stages get the memory back.
"""

from __future__ import annotations

import gc
import os
import re
import threading
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from leafspark.llm.store import give_back

CACHE_WORDS = 1_000_000
BATCH = 4096
BLOCK_CHARS = 1 << 20
IDLE_SECONDS = 4.0
LINE, BARE = "\n", "\x01"
NEW, WHOLE = -1, -2
#: Letters up to U+024F, of which all are stable under composition, ASCII digits, and ASCII marks without the
#: apostrophe: on these, pre-splitting is into runs (``dropped`` tokenizers take digits one by one).
_LETTERS, _MARKS = r"[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+", r"[!-&(-/:-@\[-`{-~]+"
PLAIN = re.compile(rf"(?:{_LETTERS}|[0-9]+|{_MARKS})+")
GLUED, DROPPED = re.compile(rf"{_LETTERS}|[0-9]+|{_MARKS}"), re.compile(rf"{_LETTERS}|[0-9]|{_MARKS}")
#: Byte-level tokenizers write a byte as the character of its number if that is printable, else as the next from U+0100.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_NAMES = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
_ENCODERS: dict[tuple[str, str], Encoder] = {}


class Encoder:
    """encode(text) gives the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cut: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if cut not in ("glued", "dropped"):
            raise ValueError(f"cut is glued or dropped, not {cut!r}")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.glued = cut == "glued"
        self.mark = "\n" if self.glued else " | "
        (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.lock, self.users, self.cache_words = threading.Lock(), 0, CACHE_WORDS
        self._empty()

    def _empty(self) -> None:
        """Word number k has the ids ids[starts[k] : starts[k] + sizes[k]]."""
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 12, dtype="<u4")
        self.starts, self.sizes, self.hits = (np.zeros(1 << 10, dtype=np.int64) for _ in range(3))
        self.held = 0

    def _shrink(self) -> None:
        """Keep the words that most blocks have asked for since the last time, half of the cache at most."""
        n = len(self.known)
        hits = self.hits[:n]
        least = 1
        while np.count_nonzero(hits >= least) > self.cache_words // 2:
            least += 1
        kept = hits >= least
        words = [w for w, k in zip(self.known, kept.tolist()) if k]
        at = np.flatnonzero(kept)
        ids, sizes = self.gathered(at), self.sizes[at]
        self._empty()
        self._put(words, sizes, ids)

    def __enter__(self) -> Encoder:
        with self.lock:
            self.users += 1
        return self

    def __exit__(self, *_: object) -> None:
        with self.lock:
            self.users -= 1
        timer = threading.Timer(IDLE_SECONDS, self.forget)
        timer.daemon = True
        timer.start()

    def forget(self) -> None:
        """Empty the cache unless a task uses it."""
        with self.lock:
            if not self.users and self.known:
                self._empty()
                gc.collect()
                give_back()

    def whole(self, text: str) -> np.ndarray:
        (e,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(e.ids, dtype="<u4")

    def _many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of words that hold no mark."""
        sizes, ids = [], []
        for i in range(0, len(words), BATCH):
            part = words[i : i + BATCH]
            got = self.whole(self.mark.join(part))
            marked = got == self.mark_id
            ends = np.flatnonzero(marked)
            if len(ends) != len(part) - 1:
                raise ValueError("a separator's id occurs in a word")
            sizes.append(np.diff(np.concatenate([[-1], ends, [len(got)]])) - 1)
            ids.append(got[~marked])
        return np.concatenate(sizes or [np.zeros(0, np.int64)]), np.concatenate(ids or [np.zeros(0, "<u4")])

    def _put(self, units: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, k = len(self.known), len(units)
        while self.held + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + k > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.hits = np.concatenate([self.hits, np.zeros_like(self.hits)])
        self.ids[self.held : self.held + len(ids)] = ids
        self.sizes[n : n + k] = sizes
        self.starts[n : n + k] = self.held + np.cumsum(sizes) - sizes
        self.held += len(ids)
        self.known.update(zip(units, range(n, n + k)))

    def gathered(self, at: np.ndarray) -> np.ndarray:
        """Ids of words of these numbers, one after the other."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def _pieces(self, unit: str) -> list[str] | None:
        """Keys of the pieces that pre-splitting makes of a unit, where it is of a plain alphabet."""
        first, word = (BARE, unit[1:]) if self.glued and unit[:1] in (LINE, BARE) else ("", unit)
        if word.isascii() and word.isalpha():
            return [first + word]
        if not PLAIN.fullmatch(word) or "\u0130" in word:
            return None
        parts = (GLUED if self.glued else DROPPED).findall(word)
        return [first + parts[0], *((BARE + p for p in parts[1:]) if self.glued else parts[1:])]

    def _merged(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of pieces, by the tokenizer's merges alone."""
        sizes, ids = np.zeros(len(keys), dtype=np.int64), []
        tokenize = self.tokenizer.model.tokenize
        for i, key in enumerate(keys):
            word = key.lower() if not self.glued else key[1:] if key[0] == BARE else " " + key
            if not word.isascii() or word[0] == " ":
                word = word.encode().decode("latin-1").translate(BYTE_NAMES)
            got = tokenize(word)
            sizes[i] = len(got)
            ids += [t.id for t in got]
        return sizes, np.array(ids, dtype="<u4")

    def _learn(self, units: list[str]) -> set[str]:
        """New units into the cache, but those that can't be cut out of their text, which are returned.

        A unit is what a space precedes; after LINE it opens a line, after BARE nothing precedes it.
        """
        bare = (lambda u: u[1:] if u[:1] in (LINE, BARE) else u) if self.glued else (lambda u: u)
        made: list[str] = []
        parts: list[list[str]] = []
        rest: list[str] = []
        bad: set[str] = set()
        for u in units:
            if (pieces := self._pieces(u)) is not None:
                made.append(u)
                parts.append(pieces)
            elif u in (LINE, BARE) and self.glued:
                made.append(u)
                parts.append([])
            elif any(a in u for a in self.added) or (self.glued and bare(u).split() != [bare(u)]):
                bad.add(u)
            else:
                rest.append(u)
        keys = [k for k in {k for p in parts for k in p} if k not in self.known]
        self._put(keys, *self._merged(keys))
        left = [(u, p) for u, p in zip(made, parts) if u not in self.known]
        if left:
            made, parts = zip(*left)
            at = np.fromiter((self.known[k] for p in parts for k in p), np.int64)
            bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
            sizes = np.diff(np.concatenate([[0], np.cumsum(self.sizes[at])])[bounds])
            lines = np.array([self.glued and u[0] == LINE for u in made], dtype=bool)
            ids = np.insert(self.gathered(at), (np.cumsum(sizes) - sizes)[lines], self.mark_id)
            self._put(list(made), sizes + lines, ids)
        if self.glued:
            inner = [u for u in rest if u[:1] not in (LINE, BARE)]
            self._put(inner, *self._many([" " + u for u in inner]))
            outer = [u for u in rest if u[:1] in (LINE, BARE)]
            sizes, ids = self._many([u[1:] for u in outer])
            lines = np.array([u[0] == LINE for u in outer], dtype=bool)
            self._put(outer, sizes + lines, np.insert(ids, (np.cumsum(sizes) - sizes)[lines], self.mark_id))
        else:
            clean = [u for u in rest if "|" not in u]
            self._put(clean, *self._many(clean))
            for u in rest:
                if "|" in u:
                    ids = self.whole(u)
                    self._put([u], np.array([len(ids)]), ids)
        return bad

    def _rows(self, text: str) -> list[str] | None:
        """A text with spaces at its cuts, long ones in several pieces; none where it is to be encoded whole."""
        if any(a in text for a in self.added):
            return None
        if self.glued:
            if BARE in text or text[-1].isspace() or text[0].isspace() or "\n\n\n" in text or "\n\n " in text:
                return None
            text = BARE + text.replace("\n", " \n")
        else:
            text = text.replace("\n", " ")
        out, at = [], 0
        while len(text) - at > BLOCK_CHARS and (cut := text.find(" ", at + BLOCK_CHARS)) >= 0:
            out.append(text[at:cut])
            at = cut + 1
        return [*out, text[at:]]

    def _block(self, rows: list[str]) -> list[np.ndarray | None]:
        """Ids of each row; none for a row with a unit that can't be cut out."""
        if not rows:
            return []
        column = pa.array(rows, pa.large_string())
        cut = pc.split_pattern(column if self.glued else pc.ascii_lower(column), " ")
        offsets = cut.offsets.to_numpy()
        words = cut.flatten().dictionary_encode()
        units = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > self.cache_words:
            self._shrink()
        at = np.fromiter(map(self.known.get, units, repeat(NEW)), np.int64, len(units))
        self.hits[at[at >= 0]] += 1
        fresh = np.flatnonzero(at == NEW)
        if len(fresh):
            names = [units[i] for i in fresh.tolist()]
            bad = self._learn(names)
            at[fresh] = np.fromiter((WHOLE if u in bad else self.known[u] for u in names), np.int64, len(names))
        place = at[words.indices.to_numpy()]
        broken = np.zeros(len(rows), dtype=bool)
        if len(fresh) and len(odd := np.flatnonzero(place == WHOLE)):
            broken[np.searchsorted(offsets, odd, side="right") - 1] = True
            place[odd] = 0
        counts = np.concatenate([[0], np.cumsum(self.sizes[place])])[offsets]
        ids = self.gathered(place)
        return [None if b else ids[x:y] for b, x, y in zip(broken.tolist(), counts[:-1].tolist(), counts[1:].tolist())]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, in blocks of bounded size."""
        out: list[list[np.ndarray | None]] = [[] for _ in texts]
        owners: list[int] = []
        rows: list[str] = []
        size = 0

        def flush() -> None:
            for k, ids in zip(owners, self._block(rows)):
                out[k].append(ids)

        for k, text in enumerate(texts):
            pieces = self._rows(text) if text else []
            if pieces is None:
                out[k].append(None)
                continue
            for piece in pieces:
                if size + len(piece) > BLOCK_CHARS and rows:
                    flush()
                    owners, rows, size = [], [], 0
                owners.append(k)
                rows.append(piece)
                size += len(piece)
        flush()
        return [
            self.whole(t).tobytes() if any(i is None for i in ids) else b"".join(i.tobytes() for i in ids)
            for t, ids in zip(texts, out)
        ]


def encoder(path: str, cut: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """One encoder a Python worker, whose cache outlives the task; a word takes some 200 bytes of it."""
    if (path, cut) not in _ENCODERS:
        gc.set_threshold(100_000, 20, 100)  # words and ids make no cycles
        _ENCODERS[path, cut] = Encoder(path, cut)
    _ENCODERS[path, cut].cache_words = cache_words
    return _ENCODERS[path, cut]


def encoded(
    batches: Iterable[pa.RecordBatch], path: str, cut: str, end_id: int | None, cache_words: int = CACHE_WORDS
) -> Iterator[tuple[int | None, bytes]]:
    """(first column, ids with end_id) of each row of two-column batches; a null text is empty."""
    end = b"" if end_id is None else np.asarray([end_id], dtype="<u4").tobytes()
    with encoder(path, cut, cache_words) as enc:
        for batch in batches:
            keys, texts = (batch.column(c).to_pylist() for c in (0, 1))
            at = 0
            while at < len(texts):  # as many texts as make a block
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= BLOCK_CHARS):
                    size += len(texts[stop] or "")
                    stop += 1
                for key, ids in zip(keys[at:stop], enc.encode_all([t or "" for t in texts[at:stop]])):
                    yield key, ids + end
                at = stop
