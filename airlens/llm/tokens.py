"""Token ids through a remembered word table.

Public tokenizers cut a text into pre-tokens before any merge, so the ids of
a text are the ids of its pieces, one after another, wherever a cut is known
to be a pre-token border.  Words repeat: a worker encodes each one once and
then only looks it up.  The vocabulary file is read by path on each worker.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Composed lower-case Latin letters, then at most one mark: letters and marks
#: are different pre-tokens, and normalising leaves both as they are.
_PLAIN = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u00ff]+)([.,;:!?]?)")
_MARKS = frozenset(b".,;:!?"[k:k + 1] for k in range(6))
_TOGETHER = 256
#: Longer words are encoded each time: where a script has no spaces a whole text
#: is one word, and no table of those would be bounded or of use.
LONGEST = 64
#: Bytes of a remembered table, with what an entry costs beside its contents.
TABLE_BYTES, ENTRY_BYTES = 160 << 20, 180


class WordIds:
    """ids of texts for a lower-casing vocabulary that drops white space.

    ASCII white space always parts pre-tokens there, and A-Z may be
    lower-cased beforehand.  Texts with a special token's opening (``<|``)
    are encoded whole.  The table holds up to ``most`` bytes and words of up to
    64; when it is full it is emptied and fills again, which changes time,
    never ids."""

    def __init__(self, path: str, most: int = TABLE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers
        self.encoder = Tokenizer.from_file(path)
        self.most, self.held = most, 0
        self.known: dict[bytes, bytes] = {}
        # Plain words need neither normalising nor splitting by a pattern.
        self.plain = Tokenizer(self.encoder.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.encoder.model, "end_of_word_suffix", None)
        vocabulary = self.encoder.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """ids of plain words, many to a call: a word ends where a token with
        the end-of-word suffix does."""
        parts = [words[k:k + _TOGETHER] for k in range(0, len(words), _TOGETHER)]
        out: list[bytes] = []
        for part, e in zip(parts, self.plain.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            if len(ends) != len(part):
                out += self._packed([w.decode() for w in part])
                continue
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip([0, *ends], ends)]
        return out

    def _learn(self, words: set[bytes]) -> None:
        known, plain, marked, other = self.known, set(), [], []
        for w in words:
            stem, mark = w[:-1], w[-1:]
            if w.isalpha():  # ASCII letters, lower-cased
                plain.add(w)
            elif mark in _MARKS and stem.isalpha():
                marked.append((w, stem, mark))
                plain.add(stem)
            elif w.isascii() or not (m := _PLAIN.fullmatch(w.decode())):
                other.append(w)
            elif m[2]:
                marked.append((w, stem, mark))
                plain.add(stem)
            else:
                plain.add(w)
        new = [w for w in plain if w not in known]
        known.update(zip(new, self._plain(new)))
        other += [mark for mark in {x[2] for x in marked} if mark not in known]
        known.update(zip(other, self._packed([w.decode() for w in other])))
        for w, stem, mark in marked:
            known[w] = known[stem] + known[mark]
        for kind in (new, other, [x[0] for x in marked]):
            self.held += sum(map(len, kind)) + sum(map(len, map(known.__getitem__, kind))) + ENTRY_BYTES * len(kind)

    def many(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text; words that
        are new to the table are learned together."""
        if self.held > self.most:
            self.known.clear()
            self.held = 0
        known, lists = self.known, [None if "<|" in t else t.encode().lower().split() for t in texts]
        found = [list(map(known.get, words or ())) for words in lists]
        missing = [[k for k, ids in enumerate(x) if ids is None] for x in found]
        new = {words[k] for words, at in zip(lists, missing) for k in at}
        long = [w for w in new if len(w) > LONGEST]
        if len(new) > len(long):
            self._learn(new.difference(long))
        once = dict(zip(long, self._packed([w.decode() for w in long])))
        for words, x, at in zip(lists, found, missing):
            for k in at:
                x[k] = known[words[k]] if len(words[k]) <= LONGEST else once[words[k]]
        return [self._packed([t])[0] if words is None else b"".join(x) for t, words, x in zip(texts, lists, found)]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


def slices(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters, one text at least."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One table for each vocabulary and worker process, kept between tasks."""
    return WordIds(path)


#: Letters, digits, marks and underscores: never white space in any table.
_CUT = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")


class SpacedIds:
    """Token counts for a byte-level vocabulary that keeps white space.

    A single space between two visible characters always opens a pre-token,
    so the text is cut before each of those."""

    def __init__(self, path: str, most: int = TABLE_BYTES):
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_file(path)
        self.encoder.encode_special_tokens = True
        self.most, self.held = most, 0
        self.known: dict[str, int] = {}

    @staticmethod
    def pieces(text: str) -> list[str]:
        return _CUT.split(text)

    def counts(self, pieces: list[str]) -> list[int]:
        if self.held > self.most:
            self.known.clear()
            self.held = 0
        known = self.known
        new = list({p for p in pieces if p not in known})
        once = {}
        # In calls of about a million characters, so that no call holds many encodings.
        for part in slices(new):
            sizes = dict(zip(part, (len(e.ids) for e in self.encoder.encode_batch_fast(part, add_special_tokens=False))))
            once.update({p: n for p, n in sizes.items() if len(p) > LONGEST})
            short = {p: n for p, n in sizes.items() if len(p) <= LONGEST}
            known.update(short)
            self.held += sum(map(len, short)) + ENTRY_BYTES * len(short)
        if not once:
            return [known[p] for p in pieces]
        return [known[p] if len(p) <= LONGEST else once[p] for p in pieces]


@lru_cache(maxsize=2)
def spaced_ids(path: str) -> SpacedIds:
    """One table for each vocabulary and worker process, kept between tasks."""
    return SpacedIds(path)
