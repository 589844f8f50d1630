"""Token ids of whole texts by the tokenizers library.

Natural text repeats its words, and a byte-level tokenizer treats the pieces between certain borders
alone. So a batch is cut at such borders, the library encodes each distinct piece once, and numpy lays
the ids out again. Texts in which a border might not be one (letters outside the Latin blocks, a
special token's string) go to the library whole, and so does everything for other kinds of tokenizer.
"""

from __future__ import annotations

import os

import numpy as np

from clickloom.llm import arrays as A
from clickloom.llm.shared import resident

#: Pieces of one generation; a worker keeps the ids of two.
KEPT_PIECES = 400_000
_JOINED = 200
#: Bytes of text in one step, which bounds a worker's memory.
STEP_BYTES = 2 << 20
_LETTER = A.byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_SPACE = A.byte_class((0x09, 0x0D), (0x1C, 0x20))
# UTF-8 bytes that are no part of ASCII or of U+00C0 to U+024F.
_FOREIGN = A.byte_class((0xC0, 0xC2), (0xCA, 0xFF))


class Pieces:
    """Ids of pieces by 96 bits of hashes of their bytes, in a table of numpy arrays with open addressing."""

    def __init__(self, most: int) -> None:
        slots = 1 << (2 * most - 1).bit_length()
        self.most, self.count, self.mask = most, 0, np.int64(slots - 1)
        self.key, self.check = np.zeros(slots, np.uint64), np.zeros(slots, np.uint32)
        self.start, self.size = np.zeros(slots, np.int32), np.full(slots, -1, np.int32)  # size -1: free
        self.values, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The slot of each piece, -1 for those not there."""
        out = np.full(len(key), -1, np.int64)
        left, at = np.arange(len(key)), key.view(np.int64) & self.mask
        while len(left):
            here = self.size[at] >= 0
            same = here & (self.key[at] == key[left]) & (self.check[at] == check[left])
            out[left[same]] = at[same]
            on = here & ~same
            left, at = left[on], (at[on] + 1) & self.mask
        return out

    def add(self, key: np.ndarray, check: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        """Different pieces that are not there yet; ``values`` holds the ids of one after the other."""
        while self.used + len(values) > len(self.values):
            self.values = np.concatenate((self.values, np.zeros_like(self.values)))
        self.values[self.used : self.used + len(values)] = values
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(values)
        self.count += len(key)
        left, at = np.arange(len(key)), key.view(np.int64) & self.mask
        while len(left):
            free = np.flatnonzero(self.size[at] < 0)
            to, first = np.unique(at[free], return_index=True)  # one piece for each free slot
            who = left[free[first]]
            self.key[to], self.check[to], self.start[to], self.size[to] = key[who], check[who], starts[who], sizes[who]
            rest = np.ones(len(left), bool)
            rest[free[first]] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and the ids one after the other."""
        size = self.size[slots].astype(np.int64)
        until = np.cumsum(size)
        total = int(until[-1]) if len(until) else 0
        return size, self.values[np.arange(total) + np.repeat(self.start[slots] - (until - size), size)]


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


class Encoder:
    """``ids(texts)``: the ids of all texts in one array, and where each text's ids start."""

    def __init__(self, path: str) -> None:
        # A task has one core; threads of the library's own would only wait for work.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        model, before = self.tokenizer.model, str(self.tokenizer.pre_tokenizer)
        self.line_break = self.tokenizer.token_to_id("Ċ")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_pieces = (
            self.tokenizer.normalizer is None
            and self.tokenizer.truncation is None
            and self.tokenizer.padding is None
            and before.startswith("ByteLevel(")
            and "add_prefix_space=False" in before
            and "use_regex=True" in before
            and type(model).__name__ == "BPE"
            and not model.dropout
            and self.line_break is not None
            and all(s.startswith("<|") for s in special)
        )
        self.young, self.old = Pieces(KEPT_PIECES), Pieces(1)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: A.Texts) -> tuple[np.ndarray, np.ndarray]:
        odd = np.ones(len(texts), bool)
        flat, first = np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if self.by_pieces:
            odd = self._odd(texts)
            found = self._by_pieces(texts)
            if found is None:
                odd[:] = True
            else:
                flat, first = found
        if not odd.any():
            return flat, first
        at = np.flatnonzero(odd)
        own = dict(zip(at.tolist(), self.whole([texts.bytes_of(i).decode("utf-8", "replace") for i in at]), strict=True))
        parts = [own[i] if i in own else flat[first[i] : first[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def _odd(self, texts: A.Texts) -> np.ndarray:
        data = texts.data[: int(texts.offsets[-1]) + 1]
        foreign = _FOREIGN[data[:-1]]
        foreign |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the signs for times and divided by
        foreign |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(texts.offsets, np.flatnonzero(foreign), "right") - 1] = True
        return odd

    def _borders(self, texts: A.Texts) -> np.ndarray:
        """Places between which a byte-level tokenizer's pattern matches as if a piece stood alone."""
        n = int(texts.offsets[-1])
        data = texts.data[:n]
        letter = _LETTER[data]
        border = np.zeros(n + 1, bool)
        border[1:-1] = letter[:-1] & ~letter[1:]  # behind letters
        start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
        last = data[start - 1]
        border[start[last == 0x20] - 1] = True  # a space goes with the letters behind it
        # An apostrophe may take letters; of several blanks the last one is matched by what follows.
        blanks = _SPACE[last] & _SPACE[data[np.maximum(start - 2, 0)]]
        border[start[(last != 0x20) & (last != 0x27) & ~blanks]] = True
        border[texts.offsets] = True
        at = np.flatnonzero(border)
        return at if n else np.zeros(1, np.int64)

    def _by_pieces(self, texts: A.Texts) -> tuple[np.ndarray, np.ndarray] | None:
        at = self._borders(texts)
        start, end = at[:-1], at[1:]
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        key, check = A.hash_spans(texts.data, start, end), (A.hash_spans(texts.data, start, end, 1) >> A.U(32)).astype(np.uint32)
        slot = self.young.find(key, check)
        new = np.flatnonzero(slot < 0)
        if len(new):
            one = new[np.unique(key[new], return_index=True)[1]]
            if self.young.count + len(one) > KEPT_PIECES:
                self.young, self.old = Pieces(max(KEPT_PIECES, len(key))), self.young
                new = np.arange(len(key))
                one = np.unique(key, return_index=True)[1]
            known = self.old.find(key[one], check[one])
            again = known >= 0
            self.young.add(key[one[again]], check[one[again]], *self.old.take(known[again]))
            one = one[~again]
            found = self._encoded(texts, start[one], end[one])
            if found is None:
                return None
            self.young.add(key[one], check[one], *found)
            slot[new] = self.young.find(key[new], check[new])
            if slot.min() < 0:  # two pieces of one hash
                return None
        size, flat = self.young.take(slot)
        until = np.concatenate(([0], np.cumsum(size)))
        return flat, until[np.searchsorted(at, texts.offsets)]

    def _encoded(self, texts: A.Texts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """How many ids each piece has, and the ids; None if the library does not keep pieces apart at line breaks."""
        raw = texts.data.tobytes()
        pieces = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        blank = np.concatenate(([0], np.cumsum(_SPACE[texts.data[: int(texts.offsets[-1])]])))
        opens = texts.data[start]
        # Without blanks but for a space in front; a line break between two of these is a token of its own.
        plain = (blank[end] == blank[start + 1]) & (~_SPACE[opens] | ((opens == 0x20) & (end > start + 1)))
        values, sizes, order = [], [], []
        joined = np.flatnonzero(plain)
        groups = [joined[k : k + _JOINED] for k in range(0, len(joined), _JOINED)]
        for group, ids in zip(groups, self.whole([b"\n".join([pieces[i] for i in g]).decode() for g in groups]), strict=True):
            edge = np.concatenate(([-1], np.flatnonzero(ids == self.line_break), [len(ids)]))
            if len(edge) != len(group) + 1:
                return None
            values.append(ids[ids != self.line_break])
            sizes.append(np.diff(edge) - 1)
            order.append(group)
        single = np.flatnonzero(~plain)
        ids = self.whole([pieces[i].decode() for i in single])
        counts = np.array([len(x) for x in ids], np.int64)
        sizes, who = np.concatenate([*sizes, counts]), np.concatenate([*order, single]).astype(np.int64)
        flat = np.concatenate([*values, *ids, np.zeros(0, np.uint32)])
        # Back into the order of the pieces.
        first = np.cumsum(sizes) - sizes
        back = np.argsort(who, kind="stable")
        size = sizes[back].astype(np.int64)
        until = np.cumsum(size)
        total = int(until[-1]) if len(until) else 0
        return size, flat[np.arange(total) + np.repeat(first[back] - (until - size), size)]


def encoder(path: str) -> Encoder:
    """The encoder of a worker process; the tokenizer's file must be at ``path`` on every machine."""
    return resident(("encoder", path), lambda: Encoder(path))
