"""Token ids of whole texts by way of their distinct words.

A slice of texts is split at spaces by Arrow, its distinct words are looked up or encoded once, and the ids of the texts
are gathered from one flat array. The result equals encoding each text as a whole: for a tokenizer that drops white space every
word is on its own; for one that keeps it (``space=" "``) the space belongs to the word after it, and texts in which a run of
white space reaches over such a cut are encoded as a whole, as are texts with a special token.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of texts taken together; a longer text is a slice of its own.
SLICE_CHARS = 8_000_000
KEPT_WORDS = 800_000
#: Words encoded in one text.
TOGETHER = 256

#: Latin letters whose lower case is one letter, and a mark that is always split from them.
_LATIN = r"\A[A-Za-zÀ-ÖØ-öø-įı-ɏ]+[,.]?\z"
_NO_SPACE = re.compile(r"\S+")


class TextEncoder:
    """Ids of texts; remembers up to about KEPT_WORDS distinct words (those of one slice always stay together)."""

    def __init__(self, path: str, space: str = ""):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.space = space
        self.special = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        tokens = self.encoder.get_vocab(with_added_tokens=True)
        #: Ids that begin a word with its space, or end a word where white space is dropped.
        self.edge = np.zeros(max(tokens.values()) + 1, bool)
        self.edge[[i for t, i in tokens.items() if (t.startswith("\u0120") if space else t.endswith("</w>"))]] = True
        self.known = pa.array([], pa.large_string())
        self.flat = np.zeros(0, "<u4")
        self.starts, self.lengths, self.slices = (np.zeros(0, np.int64) for _ in range(3))
        self.left, self.right, self.alone = (np.zeros(0, bool) for _ in range(3))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        begin = chars = 0
        for end, text in enumerate(texts):
            if chars and chars + len(text) > SLICE_CHARS:
                yield from self._slice(texts[begin:end])
                begin, chars = end, 0
            chars += len(text)
        if begin < len(texts):
            yield from self._slice(texts[begin:])

    def _slice(self, texts: list[str]) -> Iterator[np.ndarray]:
        # a newline is white space like the space where white space is dropped
        plain = texts if self.space else [t.replace("\n", " ") for t in texts]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        at = split.offsets.to_numpy()
        words = coded.dictionary
        code = coded.indices.to_numpy()
        if self.space:  # the first word of a text has no space before it
            distinct, new = np.unique(code[at[:-1]], return_inverse=True)
            code = code.astype(np.int64)
            code[at[:-1]] = len(words) + new
            spaced = pc.binary_join_element_wise(pa.scalar(self.space, pa.large_string()), words, pa.scalar("", pa.large_string()))
            words = pa.concat_arrays([spaced, words.take(pa.array(distinct))])
        place = self._known(words)[code]
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[place] - ends + lengths, lengths)]
        bounds = np.concatenate([[0], ends])[at]
        whole = self._whole(place, at) if self.space else np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            if whole[i]:
                yield np.array(self.encoder.encode(text, add_special_tokens=False).ids, "<u4")
            else:
                yield ids[bounds[i] : bounds[i + 1]]

    def _whole(self, place: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which texts must be encoded as a whole: white space meets at a cut, or a special token is inside."""
        bad = self.left[place]
        bad[:-1] &= self.right[place[1:]]
        bad[at[1:] - 1] = False  # the last word of a text and the first of the next do not meet
        bad |= self.alone[place]
        return np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at))[bad], minlength=len(at) - 1) > 0

    def _known(self, words: pa.Array) -> np.ndarray:
        """Place in the arrays of each word."""
        found = pc.index_in(words, value_set=self.known)
        missing = words.filter(found.is_null())
        if len(missing) and len(self.known) + len(missing) > KEPT_WORDS and len(self.known):
            self._forget()
            return self._known(words)
        places = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(missing):
            places[places < 0] = self._learn(missing)
        self.slices[places] += 1
        pa.default_memory_pool().release_unused()  # workers outlive the stage
        return places

    def _forget(self) -> None:
        """Of the words that came in several slices, those of the most stay: at most half of what is kept."""
        often = np.flatnonzero(self.slices > 1)
        kept = np.sort(often[np.argsort(-self.slices[often], kind="stable")[: KEPT_WORDS // 2]])
        self.known = self.known.take(pa.array(kept))
        lengths = self.lengths[kept]
        ends = np.cumsum(lengths)
        self.flat = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[kept] - ends + lengths, lengths)]
        self.starts, self.lengths, self.slices = ends - lengths, lengths, self.slices[kept] // 2
        self.left, self.right, self.alone = self.left[kept], self.right[kept], self.alone[kept]

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Takes distinct words in; returns their places."""
        missing = words.to_pylist()
        if self.space:
            bare = [w.removeprefix(self.space) for w in missing]
            alone = [("|" in w and any(s in w for s in self.special)) for w in bare]
            joint = [w is not b and not a and bool(_NO_SPACE.fullmatch(b)) for w, b, a in zip(missing, bare, alone, strict=True)]
            left = [not w or w[-1].isspace() for w in bare]
            right = [not w or w[0].isspace() for w in bare]
        else:
            joint = pc.match_substring_regex(words, _LATIN).to_numpy(zero_copy_only=False)
            left = right = alone = np.zeros(len(missing), bool)
        # words that may be encoded together come first
        order = np.argsort(~np.array(joint, bool), kind="stable")
        self.left, self.right, self.alone = (
            np.concatenate([held, np.array(new, bool)[order]])
            for held, new in ((self.left, left), (self.right, right), (self.alone, alone))
        )
        missing = [missing[i] for i in order.tolist()]
        count = int(np.sum(joint))
        flat, lengths = [self.flat], []
        for i in range(0, count, 64 * TOGETHER):
            self._learn_together(missing[i : min(count, i + 64 * TOGETHER)], flat, lengths)
        for i in range(count, len(missing), 10_000):
            self._learn_each(missing[i : i + 10_000], flat, lengths)
        places = np.empty(len(order), np.int64)
        places[order] = len(self.known) + np.arange(len(order))
        self.known = pa.concat_arrays([self.known, words.take(pa.array(order))])
        new = np.concatenate(lengths)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(new) - new])
        self.lengths = np.concatenate([self.lengths, new])
        self.slices = np.concatenate([self.slices, np.zeros(len(new), np.int64)])
        self.flat = np.concatenate(flat)
        return places

    def _learn_each(self, words: list[str], flat: list[np.ndarray], lengths: list[np.ndarray]) -> None:
        ids = [e.ids for e in self.encoder.encode_batch_fast(words, add_special_tokens=False)]
        lengths.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(itertools.chain.from_iterable(ids), "<u4", int(lengths[-1].sum())))

    def _learn_together(self, words: list[str], flat: list[np.ndarray], lengths: list[np.ndarray]) -> None:
        """Many words in one text. How many ids of each word are edges is known, so the edges say where it ends."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        texts = [("" if self.space else " ").join(g) for g in groups]
        for group, e in zip(groups, self.encoder.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            edges = np.flatnonzero(self.edge[ids])
            if self.space:
                expected, ends = len(group), np.append(edges[1:], len(ids))
            else:
                own = np.fromiter((1 + (w[-1] in ",.") for w in group), np.int64, len(group))
                expected = int(own.sum())
                ends = edges[np.minimum(np.cumsum(own), len(edges)) - 1] + 1
            if len(edges) != expected:
                self._learn_each(group, flat, lengths)
                continue
            lengths.append(np.diff(ends, prepend=0))
            flat.append(ids)


_loaded: dict[tuple[str, str], TextEncoder] = {}


def text_encoder(path: str, space: str = "") -> TextEncoder:
    """One per Python worker and tokenizer."""
    if (path, space) not in _loaded:
        _loaded[path, space] = TextEncoder(path, space)
    return _loaded[path, space]
