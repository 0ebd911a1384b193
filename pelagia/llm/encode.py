"""Token ids of whole Arrow batches of texts with a tokenizer that never joins words.

A tokenizer of this kind drops blanks and cuts at them, so a text's ids are
those of its words in a row. Each different word is encoded once and kept in the
worker; a batch is then a lookup of its distinct words and one gather, both on
Arrow arrays. ``encode`` gives exactly what the tokenizer gives for the whole
text; the tests hold it against that.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept by one worker before it starts anew.
KEPT_WORDS = 1_000_000
#: Signs that end a word and are one token of their own after a letter or a digit.
_TAIL = ",.!?;:"
#: Letters that fold to one letter; a last one that folds to a letter and a mark would join the signs.
_LETTER = "a-zA-ZÀ-ÖØ-öø-įı-ɏ"
_WORD_END = "</w>"


def _strings(values: list[str] | pa.Array = ()) -> pa.Array:
    return pa.array(values, pa.large_string()) if not isinstance(values, pa.Array) else values


class _Store:
    """Ids of known strings, in the order in which they came, as one flat array."""

    def __init__(self, kind: type):
        self.known, self.flat, self.start = _strings(), np.zeros(0, kind), np.zeros(1, np.int64)

    def at(self, values: pa.Array) -> pa.Array:
        """The place of each value, null where it is not known."""
        return pc.index_in(values, value_set=self.known)

    def add(self, values: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, values])
        self.flat = np.concatenate([self.flat, ids])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings at ``at`` in a row, and how many each has."""
        lead, size = self.start[at], self.start[at + 1] - self.start[at]
        end = np.cumsum(size)
        return self.flat[np.repeat(lead - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)], size


class WordEncoder:
    """Ids of words by the tokenizer file ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.mark_id = next((t.content, i) for i, t in added.items())
        #: What a special token begins with: words that hold it are encoded as they are.
        self.special = [t.content for t in added.values()]
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(_WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.words, self.stems = _Store(self.kind), _Store(self.kind)

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _learn_stems(self, stems: pa.Array) -> None:
        """Encodes ``stems``: those of letters or signs alone in one call, cut after each token that ends a word; the rest around a mark."""
        simple = pc.match_substring_regex(stems, f"^(?:[{_LETTER}]+|[{_TAIL}]+)$")
        own = stems.filter(simple)
        ids = self.plain(" ".join(own.to_pylist()))
        size = np.diff(np.append(-1, np.flatnonzero(self.ends[ids])))
        self.stems.add(own, ids, size)
        own = stems.filter(pc.invert(simple))
        odd = own.to_pylist()
        special = [any(s in x for s in self.special) for x in odd]
        joined = self.plain(self.mark.join(x for x, s in zip(odd, special, strict=True) if not s))
        parts = iter(np.split(joined, np.flatnonzero(joined == self.mark_id)))
        pieces, first = [], True
        for x, s in zip(odd, special, strict=True):
            if s:
                pieces.append(self.plain(x))
            else:
                pieces.append(next(parts)[0 if first else 1 :])
                first = False
        self.stems.add(own, np.concatenate(pieces) if pieces else np.zeros(0, self.kind), np.array([len(p) for p in pieces], np.int64))

    def _learn(self, words: pa.Array) -> None:
        stem = pc.utf8_rtrim(words, _TAIL)
        cut = pc.match_substring_regex(stem, f"[{_LETTER}0-9]$")
        for s in self.special:
            cut = pc.and_(cut, pc.invert(pc.match_substring(words, s)))
        tail = pc.struct_field(pc.extract_regex(words, f"(?P<tail>[{_TAIL}]*)$"), "tail").cast(pa.large_string())
        low = pc.ascii_lower(stem)
        for s in self.special:  # folded, it must not become a special token
            low = pc.if_else(pc.match_substring(low, s), stem, low)
        stem, tail = pc.if_else(cut, low, words), pc.if_else(cut, tail, pa.scalar("", pa.large_string()))
        both = pa.concat_arrays([stem, tail])
        new = pc.unique(both)
        new = new.filter(pc.is_null(self.stems.at(new)))
        if len(new):
            self._learn_stems(new)
        at = self.stems.at(both).to_numpy().reshape(2, -1)
        ids, size = self.stems.gather(at.T.ravel())
        self.words.add(words, ids, size.reshape(-1, 2).sum(1))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (and the last's end); null is empty."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        words = lists.flatten().dictionary_encode()
        held = words.dictionary
        if len(self.words.known) + len(held) > KEPT_WORDS and len(self.words.known):
            self._forget()
        new = held.filter(pc.is_null(self.words.at(held)))
        if len(new):
            self._learn(new)
        ids, size = self.words.gather(self.words.at(held).to_numpy()[words.indices.to_numpy()])
        end = np.append(0, np.cumsum(size))
        off = lists.offsets.to_numpy()
        return ids, end[off - off[0]] if len(off) else end[:1]


@cache
def encoder(path: str) -> WordEncoder:
    """One encoder a worker."""
    return WordEncoder(path)
