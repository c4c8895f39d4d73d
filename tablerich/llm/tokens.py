"""Token ids of texts, the same in every operator that needs them.

The tokenizer splits a text before each last white space that a word follows, and never joins what it has
split. So a text is encoded word by word, and words that were seen are looked up: ``Encoder`` gives exactly
the ids the tokenizer gives for the whole text, several times as fast. Words are split, numbered and looked up by
column, and their ids lie in one buffer, so there is no Python object per word but for words that are new.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words an encoder learns before it starts anew with those it needs.
MOST_WORDS = 700_000
#: Words encoded as one text, and texts in one call: what the tokenizer returns for a word is large.
_CALL = 64
#: Bytes of text handled at once.
_STEP_CHARS = 3 << 20
#: Put before words that follow no space, and before marks. Texts that hold either are encoded whole.
_FIRST, _MARK = "\x01", "\x02"
#: Marks that are often behind a word.
_MARKS = ".,!?;:"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _gathered(buffer: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts of a buffer in a row, and where each ends."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return buffer[np.repeat(first - (ends - size), size) + np.arange(total)], ends


class Encoder:
    """Encodes texts to ids below 65536, 16 bits each."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        if self.size > 1 << 16:
            raise ValueError("more than 65536 token ids")
        # Byte-level vocabularies write a space as this character.
        self.starts = np.zeros(self.size, bool)
        for token, i in vocabulary.items():
            self.starts[i] = token.startswith("Ġ")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint16)
        self.first = self.lengths = np.zeros(0, np.int64)

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for i in range(0, len(texts), _CALL):
            found = self.tokenizer.encode_batch_fast(texts[i : i + _CALL], add_special_tokens=False)
            out += [np.array(f.ids, np.uint16) for f in found]
        return out

    def _spaced(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids in a row, and their number for each word; a word that follows a space begins with a token that holds it."""
        groups = [words[i : i + _CALL] for i in range(0, len(words), _CALL)]
        found = self._direct([" " + " ".join(g) for g in groups])
        begins = [self.starts[ids] for ids in found]
        for i, (group, at) in enumerate(zip(groups, begins)):
            if np.count_nonzero(at) != len(group):
                apart = self._direct([" " + w for w in group])
                found[i], begins[i] = np.concatenate(apart), np.concatenate([np.arange(len(ids)) == 0 for ids in apart])
        total = sum(map(len, found))
        return found, np.diff(np.append(np.flatnonzero(np.concatenate([*begins, np.zeros(0, bool)])), total))

    def _learn(self, keys: pa.Array) -> np.ndarray:
        """Add words; their places."""
        plain = pc.and_(pc.not_equal(keys, "\n"), pc.invert(pc.match_substring_regex(keys, f"^[{_FIRST}{_MARK}]")))
        spaced = keys.filter(plain)
        others = keys.filter(pc.invert(plain))
        found, lengths = self._spaced(spaced.to_pylist())
        direct = self._direct([w if w == "\n" else w[1:] for w in others.to_pylist()])
        lengths = np.concatenate([lengths, np.array([len(f) for f in direct], np.int64)])
        place = np.empty(len(keys), np.int64)
        order = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")
        place[order] = np.arange(len(keys)) + len(self.words)
        self.words = pa.concat_arrays([self.words, spaced, others])
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, *found, *direct])
        return place

    def _entries(self, keys: pa.Array) -> np.ndarray:
        """The places of the keys among the words, which are learnt if need be."""
        distinct = keys.dictionary_encode()
        known = pc.index_in(distinct.dictionary, self.words)
        place = pc.fill_null(known, -1).to_numpy().astype(np.int64)
        if known.null_count and len(self.words) + known.null_count > MOST_WORDS:
            self._forget()
            place[:] = -1
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = self._learn(distinct.dictionary.take(pa.array(new)))
        return place[distinct.indices.to_numpy()]

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A buffer with the ids of each word, where they begin, how many they are, and which words are none."""
        first = pc.starts_with(words, _FIRST)
        body = pc.utf8_ltrim(words, _FIRST)
        newline = pc.equal(words, "\n")
        leading = pc.utf8_slice_codeunits(body, 0, 1)
        none = pc.and_(pc.invert(newline), pc.or_(pc.equal(body, ""), pc.utf8_is_space(leading)))
        # Marks behind letters are split off by the tokenizer as well.
        core = pc.utf8_rtrim(words, _MARKS)
        cut = pc.less(pc.binary_length(core), pc.binary_length(words))
        marked = pc.and_(cut, pc.utf8_is_alpha(pc.if_else(first, pc.utf8_ltrim(core, _FIRST), core)))
        keys = pc.if_else(none, "\n", pc.if_else(marked, core, words))
        behind = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        marks = pc.extract_regex(words.take(pa.array(behind)), f"(?P<m>[{_MARKS}]+)$").field("m")
        every = pa.concat_arrays([keys, pc.binary_join_element_wise(_MARK, marks, "")])
        place = self._entries(every)
        n = len(words)
        pairs = np.repeat(place[:n], 2)
        size = np.zeros(2 * n, np.int64)
        size[::2] = self.lengths[place[:n]]
        pairs[2 * behind + 1] = place[n:]
        size[2 * behind + 1] = self.lengths[place[n:]]
        ids, ends = _gathered(self.ids, self.first[pairs], size)
        size = size[::2] + size[1::2]
        return ids, ends[1::2] - size, size, none.to_numpy(zero_copy_only=False)

    def encode_steps(self, texts: pa.Array, end_id: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts in a row, each followed by ``end_id`` if given, and their bounds; null counts as empty."""
        texts = texts.cast(pa.string()).fill_null("")
        rows, start = len(texts), 0
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < rows:
            # A step of bounded size, one text at least.
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _STEP_CHARS)))
            yield self._encode_step(texts.slice(start, stop - start), end_id)
            start = stop

    def encode_batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for ids, bounds in self.encode_steps(texts):
            yield from np.split(ids, bounds[1:-1])

    def _encode_step(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring(texts, _FIRST)
        for special in [_MARK, *self.special]:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        odd = odd.to_numpy(zero_copy_only=False).copy()
        marked = pc.binary_join_element_wise(_FIRST, pc.replace_substring(texts, "\n", " \n " + _FIRST), "")
        split = pc.split_pattern(marked, " ")
        coded = split.flatten().dictionary_encode()
        buffer, first, size, none = self._look_up(coded.dictionary)
        words = coded.indices.to_numpy()
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        if none.any():
            odd |= np.add.reduceat(none[words].astype(np.int64), bounds[:-1]) > 0
        if end_id is not None:
            # The end is one more word, in place of which each text has one.
            buffer = np.append(buffer, np.uint16(end_id))
            first, size = np.append(first, len(buffer) - 1), np.append(size, 1)
            words = np.insert(words, bounds[1:], len(first) - 1)
            bounds = bounds + np.arange(len(bounds))
        ids, ends = _gathered(buffer, first[words], size[words])
        bounds = np.append(0, ends)[bounds]
        if odd.any():
            parts = np.split(ids, bounds[1:-1])
            at = np.flatnonzero(odd).tolist()
            end = np.array([] if end_id is None else [end_id], np.uint16)
            for i, whole in zip(at, self._direct(texts.take(pa.array(at)).to_pylist())):
                parts[i] = np.concatenate([whole, end])
            ids, bounds = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
        return ids, bounds


def binaries(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The ids of each text as little-endian 16-bit bytes."""
    data = pa.py_buffer(np.ascontiguousarray(ids.astype("<u2", copy=False)))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((2 * bounds).astype(np.int32)), data])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
