"""Token ids of whole texts at array speed, the same ids as the tokenizer gives.

Made for tokenizers that split a text into words that are encoded on their own (letters, one digit,
or other signs; lower case).  Plain words are cut out with NumPy and each distinct one is encoded
once for a worker; white-space separated stretches that hold anything else (an apostrophe, a
character beyond Latin-1's letters, a control string) go to the tokenizer as they are.
"""

from __future__ import annotations

import numpy as np

from ._text import U, cache, mix, powers, tables

#: Distinct words that a worker remembers; when full it starts anew.
REMEMBERED = 800_000

#: Bytes as byte-level models write them: visible characters as themselves, the others from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}

SPACE, LETTER, DIGIT, SIGN, ODD = range(5)


def kinds() -> np.ndarray:
    out = np.full(256, ODD, dtype=np.uint8)
    for b in range(33, 127):
        c = chr(b)
        out[b] = LETTER if c.isalpha() else DIGIT if c.isdigit() else SIGN
    out[[9, 10, 11, 12, 13, 32]] = SPACE
    out[ord("'")] = ODD
    return out


class Encoder:
    """Encodes batches of texts with the tokenizer in a file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.uint16 if self.tokenizer.get_vocab_size() < 1 << 16 else np.uint32
        self.kinds = kinds()
        #: The model without what comes before it, for words that are cut out already; whether it can be used (None: not known).
        self.model, self.direct = self.tokenizer.model, None
        self.forget()

    def forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, dtype=self.width)
        self.used = 0
        self.begin = np.zeros(1 << 16, dtype=np.int64)
        self.size = np.zeros(1 << 16, dtype=np.int64)

    def add(self, hashes: list[int], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember pieces: their hashes, their ids one after another, and how many each has."""
        n, k = len(hashes), len(self.slot)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), dtype=self.width)])
        while k + n > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros(len(x), dtype=np.int64)]) for x in (self.begin, self.size))
        self.ids[self.used : self.used + len(ids)] = ids
        self.begin[k : k + n] = self.used + np.cumsum(sizes) - sizes
        self.size[k : k + n] = sizes
        self.used += len(ids)
        self.slot.update(zip(hashes, range(k, k + n)))

    def pieces(self, blob: bytes):
        """Begin, end, hash and oddness of each piece, and the lower-cased bytes."""
        buf = np.frombuffer(blob, dtype=np.uint8)
        kind = self.kinds[buf]
        lead = np.zeros(len(buf), dtype=bool)
        lead[:-1] = buf[:-1] == 0xC3
        tail = np.zeros(len(buf), dtype=bool)
        tail[1:] = lead[:-1]
        good = tail & (buf != 0x97) & (buf != 0xB7)  # the letters among them
        kind[good] = LETTER
        kind[:-1][good[1:]] = LETTER
        # a control string begins with <|
        kind[:-1][(buf[:-1] == ord("<")) & (buf[1:] == ord("|"))] = ODD
        low = buf.copy()
        low[(buf >= 65) & (buf <= 90)] += 32
        low[good & (buf <= 0x9E)] += 32
        inside = None  # inside words that stay whole
        if (kind == ODD).any():
            space = kind == SPACE
            word_begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
            word_end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
            odd_word = np.logical_or.reduceat(kind == ODD, word_begin) if len(word_begin) else np.zeros(0, bool)
            whole = np.zeros(len(buf) + 1, dtype=np.int8)
            whole[word_begin[odd_word]] += 1
            whole[word_end[odd_word]] -= 1
            inside = np.cumsum(whole[:-1], dtype=np.int8) > 0
            kind[inside] = ODD
            low[inside] = buf[inside]
        start = np.zeros(len(buf), dtype=bool)
        start[0] = True
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        begin = np.flatnonzero(start)
        end = np.concatenate([begin[1:], [len(buf)]])
        keep = kind[begin] != SPACE
        begin, end = begin[keep], end[keep]
        odd = kind[begin] == ODD
        values, _ = tables(False, False)
        up, down = powers(len(buf) + 1)
        total = np.zeros(len(buf) + 1, dtype=U)
        np.cumsum(values[low] * up[: len(buf)], out=total[1:])
        h = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(U) * U(0xA24BAED4963EE407) + odd.astype(U))
        return begin, end, h, odd, low

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        blob = b"\n".join(texts)
        if not blob.strip():
            return [np.zeros(0, dtype=self.width) for _ in texts]
        begin, end, h, odd, low = self.pieces(blob)
        if len(self.slot) > REMEMBERED:
            self.forget()
        kind, first, back = np.unique(h, return_index=True, return_inverse=True)
        new = [(int(x), k) for x, k in zip(kind.tolist(), first.tolist()) if x not in self.slot]
        self.learn(new, begin, end, odd, low)
        at = np.array([self.slot[x] for x in kind.tolist()], dtype=np.int64)[back]
        starts, sizes = self.begin[at], self.size[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.ids[np.repeat(starts - total[:-1], sizes) + np.arange(total[-1])]
        cut = np.cumsum([len(t) + 1 for t in texts])[:-1]
        where = np.concatenate([[0], total[np.searchsorted(begin, cut)], [total[-1]]])
        return [flat[a:b] for a, b in zip(where[:-1], where[1:])]

    def learn(self, new: list[tuple[int, int]], begin, end, odd, low) -> None:
        data = low.tobytes()
        plain = [(x, data[begin[k] : end[k]]) for x, k in new if not odd[k]]
        for a in range(0, len(plain), 4096):
            part = plain[a : a + 4096]
            if self.direct is not False:
                own = [[t.id for t in self.model.tokenize(w.decode("latin-1").translate(BYTES))] for _, w in part]
                if self.direct is None:  # the short way must give what the tokenizer does
                    self.direct = own == [e.ids for e in self.tokenizer.encode_batch([w.decode() for _, w in part], add_special_tokens=False)]
                if self.direct:
                    self.add([p[0] for p in part], np.array([i for ids in own for i in ids]), np.array([len(ids) for ids in own]))
                    continue
            found = self.tokenizer.encode(" ".join(w.decode() for _, w in part), add_special_tokens=False)
            of = np.array([-1 if x is None else x for x in found.word_ids], dtype=np.int64)
            sizes = np.bincount(of, minlength=len(part)) if len(of) and of[0] >= 0 else np.zeros(0, dtype=np.int64)
            if len(sizes) == len(part) and sizes.min() > 0 and (np.diff(of) >= 0).all():
                self.add([p[0] for p in part], np.array(found.ids), sizes)
            else:
                for x, word in part:
                    self.add_one(x, word.decode())
        for x, k in new:
            if odd[k]:
                self.add_one(x, data[begin[k] : end[k]].decode())

    def add_one(self, h: int, word: str) -> None:
        ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype=self.width)
        self.add([h], ids, np.array([len(ids)]))


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    key = ("encoder", path)
    if key not in cache():
        cache()[key] = Encoder(path)
    return cache()[key]
