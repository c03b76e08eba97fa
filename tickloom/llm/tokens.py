"""Token ids of many texts: each distinct word of a batch is encoded once.

The tokenizers here never merge across a space or line break that stands between two
plain characters, so a text is cut there and its pieces encoded by themselves. A text with
anything else next to a space or line break (a second one, say) is encoded as a whole. So
is, if special tokens count as such, a text that holds the spelling of one.

Most words are letters, or letters and punctuation: those are cut once more, into units that
many words share, and the units are kept with their ids. The cuts are made on whole columns.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickloom.llm.common import per_worker

#: Units and odd words kept with their ids in a worker; beyond that, those that only one batch held go.
CACHE_WORDS = 1_000_000
#: A word that starts and ends with printable ASCII, a letter, a digit or "_".
PLAIN = re.compile(r"[!-~\w](?:.*[!-~\w])?", re.DOTALL)
#: Letters, then punctuation: two units of any of these tokenizers, which the model takes as they are.
MARKS = ".,;:!?"
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_ID = attrgetter("id")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """A tokenizer file with a cache of words. ``encode`` gives ids and counts for a column of texts."""

    def __init__(self, path: str, special: bool = False) -> None:
        """``special``: the spelling of a special token in a text is that token, as is the library's default."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.marked = [t.content for t in added] if special else [t.content for t in added if not t.special]
        self.letters = _byte_letters()
        self.break_ids = self.whole(["\n"])[0]
        # does the space before a word belong to it, and are letters lowered?
        self.spaced = len(self.whole([" "])[0]) > 0
        self.lowered = self.whole(["A"])[0].tolist() == self.whole(["a"])[0].tolist()
        self._clear()

    def _clear(self) -> None:
        self.places: tuple[dict[str, int], dict[str, int]] = ({}, {})  # at the start of a line, after a space
        self.pool = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)  # place 0 holds no ids
        self.length = np.zeros(1, np.int64)
        self.uses = np.zeros(1, np.uint8)  # batches that held it, up to 2

    def _forget(self) -> None:
        """Keep what several batches held."""
        kept = self.uses > 1
        kept[0] = True
        moved = np.cumsum(kept) - 1
        self.pool = _gather(self.pool, self.begin[kept], self.length[kept])
        self.length = self.length[kept]
        self.begin = np.cumsum(self.length) - self.length
        self.uses = np.minimum(self.uses[kept], 1)
        stays, to = kept.tolist(), moved.tolist()
        self.places = tuple({w: to[p] for w, p in held.items() if p > 0 and stays[p]} for held in self.places)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def _spelled(self, units: list[str], space: str) -> list[str]:
        """The units, a space before each, in the letters that stand for their bytes."""
        foreign = "\n".join(space + u for u in units if not u.isascii())
        spelled = iter(foreign.encode().decode("latin-1").translate(self.letters).split(self.letters[10]))
        lead = self.letters[32] if space else ""
        return [lead + u if u.isascii() else next(spelled) for u in units]

    def _learn(self, words: list[str], is_unit: np.ndarray, after_space: bool) -> None:
        """Find ids for units and for words that are none; -1 is the place of a word that can't stand by itself."""
        space = " " if after_space and self.spaced else ""
        tokenize = self.tokenizer.model.tokenize
        units, rest, stuck = [], [], []
        for word, unit in zip(words, is_unit.tolist()):
            (units if unit else rest if PLAIN.fullmatch(word) else stuck).append(word)
        # flat, as a list for each unit would keep the garbage collector busy
        flat: list[int] = []
        ends = [0]
        for unit in self._spelled(units, space):
            flat.extend(map(_ID, tokenize(unit)))
            ends.append(len(flat))
        for ids in self.whole([space + w for w in rest]):
            flat.extend(ids.tolist())
            ends.append(len(flat))
        sizes = np.diff(ends)
        at, held = len(self.begin), self.places[after_space]
        held.update(zip(units + rest, range(at, at + len(sizes))))
        held.update((w, -1) for w in stuck)
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.uint8)])
        self.begin = np.concatenate([self.begin, np.cumsum(sizes) - sizes + len(self.pool)])
        self.length = np.concatenate([self.length, sizes])
        self.pool = np.concatenate([self.pool, np.array(flat, np.uint32)])

    def _look_up(self, words: pa.Array, is_unit: pa.Array, after_space: bool) -> np.ndarray:
        """Cache places of units and whole words."""
        coded = words.dictionary_encode()
        index, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        get = self.places[after_space].get
        found = list(map(get, distinct))
        if None in found:
            unit = np.zeros(len(distinct), bool)
            unit[index] = is_unit.to_numpy(zero_copy_only=False)
            new = [i for i, p in enumerate(found) if p is None]
            self._learn([distinct[i] for i in new], unit[new], after_space)
            found = list(map(get, distinct))
        places = np.array(found, np.int64)
        used = np.maximum(places, 0)  # each place once, but for 0
        self.uses[used] = np.minimum(self.uses[used] + 1, 2)
        return places[index]

    def _words(self, words: pa.Array, after_space: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of each word and of the marks behind it: 0 for no marks, -1 for a word that can't stand by itself."""
        names = pc.utf8_rtrim(words, MARKS)
        is_unit = pc.match_substring_regex(names, f"^{LETTERS}$")
        place = self._look_up(pc.if_else(is_unit, pc.utf8_lower(names) if self.lowered else names, words), is_unit, after_space)
        marked = pc.and_(is_unit, pc.not_equal(pc.binary_length(names), pc.binary_length(words)))
        tails = pc.replace_substring_regex(words.filter(marked), f"^{LETTERS}", "")
        marks = np.zeros(len(words), np.int64)
        marks[marked.to_numpy(zero_copy_only=False)] = self._look_up(tails, pa.array(np.ones(len(tails), bool)), False)
        return place, marks

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many each text has. Null is empty."""
        if len(self.begin) > CACHE_WORDS:
            self._forget()
            if len(self.begin) > CACHE_WORDS // 2:
                self._clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lines = pc.split_pattern(texts, "\n")
        line_words = pc.split_pattern(lines.values, " ")
        line_at = lines.offsets.to_numpy()  # lines of a text
        word_at = line_words.offsets.to_numpy()  # words of a line
        # what stands before a word decides its ids: a space, a line break or nothing
        leads = np.zeros(len(line_words.values), bool)
        leads[word_at[:-1]] = True
        breaks = leads.copy()
        breaks[word_at[line_at[:-1]]] = False
        coded = line_words.values.dictionary_encode()
        index = coded.indices.to_numpy()
        n = len(coded.dictionary)
        # a word with no space of its own has the same ids everywhere
        if self.spaced:
            index = index + leads * np.int32(n)
        used = np.zeros(2 * n, bool)
        used[index] = True
        place, marks = np.full(2 * n, -1, np.int64), np.zeros(2 * n, np.int64)
        for half, after_space in enumerate((True, False) if self.spaced else (False,)):
            here = half * n + np.flatnonzero(used[half * n : (half + 1) * n])
            place[here], marks[here] = self._words(coded.dictionary.take(pa.array(here - half * n)), after_space)
        text_at = word_at[line_at]  # words of a text
        plain = (place >= 0)[index]
        # ids of the distinct words, end to end
        parts = np.stack([np.maximum(place, 0), marks], axis=1)
        pool = _gather(self.pool, self.begin[parts.ravel()], self.length[parts.ravel()])
        word_length = self.length[parts].sum(axis=1)
        begin, length = (np.cumsum(word_length) - word_length)[index], word_length[index]
        counts = _sums(length + breaks * len(self.break_ids), text_at)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(text_at, np.flatnonzero(~plain), "right") - 1] = True
        for spelling in self.marked:
            odd |= pc.match_substring(texts, spelling, ignore_case=True).to_numpy(zero_copy_only=False)
        ids = _gather(pool, begin, length)
        if len(self.break_ids):
            ids = np.insert(ids, np.repeat((np.cumsum(length) - length)[breaks], len(self.break_ids)), np.tile(self.break_ids, int(breaks.sum())))
        if not odd.any():
            return ids, counts
        spelled = self.whole(texts.filter(pa.array(odd)).to_pylist())
        start = np.cumsum(counts) - counts
        sizes = np.array([len(x) for x in spelled], np.int64)
        start[odd] = len(ids) + np.cumsum(sizes) - sizes
        counts[odd] = sizes
        return _gather(np.concatenate([ids, *spelled]), start, counts), counts


def _gather(pool: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs pool[begin : begin + length], end to end."""
    to = np.cumsum(length)
    if not len(length) or not to[-1]:
        return np.zeros(0, pool.dtype)
    return pool[np.arange(to[-1]) + np.repeat(begin - (to - length), length)]


def _sums(length: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(length)])
    return np.diff(total[at])


def encoder(path: str, special: bool = False) -> WordEncoder:
    return per_worker(("encoder", path, special), lambda: WordEncoder(path, special))


def token_runs(ids: np.ndarray, counts: np.ndarray, end_id: int) -> Iterator[np.ndarray]:
    """Each text's ids with the end id behind them, as little-endian 32-bit numbers."""
    at = 0
    for count in counts.tolist():
        run = np.empty(count + 1, "<u4")
        run[:count] = ids[at : at + count]
        run[count] = end_id
        at += count
        yield run
