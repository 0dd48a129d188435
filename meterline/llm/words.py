"""Whole columns of texts to token ids, each distinct word encoded once.

For byte-level vocabularies whose pattern gives a word its leading space and
leaves a line end alone. Every line end and every single space starts a new
word; runs of more white space, white space of other kinds and special strings
may be matched across such places, so texts that hold them are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Where words may not be told apart: longer runs, runs at the end, other white space than space and line end.
UNUSUAL = r"[ \n]{3}|[ \n]{2}\z|[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: So many distinct words are remembered by a worker; so many bytes of them go to the encoder at a time.
REMEMBERED, BATCH_BYTES = 300_000, 1 << 18
#: What a column's encoder remembers lies in arrays, so it can be more. So many words are encoded side by side.
ENCODED_WORDS, WORDS_A_TEXT = 1_000_000, 500

Encode = Callable[[list[str]], list[Sequence[int]]]


def by_bytes(words: list[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """The words in batches of about ``most`` bytes; a longer word is a batch of its own."""
    batch, held = [], 0
    for word in words:
        n = len(word.encode())
        if batch and held + n > most:
            yield batch
            batch, held = [], 0
        batch.append(word)
        held += n
    if batch:
        yield batch


def _gathered(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin there, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class ColumnEncoder:
    """Ids of many texts. ``encode`` gives those of strings; ``special`` are strings it may take for one id.

    With ``bytes_of_ids``, how many bytes each id stands for, words are encoded
    side by side and the ids cut where the words' bytes end; no token crosses that.
    The first words met are remembered, as they are the frequent ones.
    """

    def __init__(self, encode: Encode, special: Sequence[str] = (), bytes_of_ids: np.ndarray | None = None):
        self.encode, self.special, self.bytes_of_ids = encode, list(special), bytes_of_ids
        self.words = pa.array([], pa.string())
        self.ids, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _encoded(self, words: list[str]) -> Iterator[np.ndarray]:
        for batch in by_bytes(words):
            yield from (np.array(ids, dtype="<u4") for ids in self.encode(batch))

    def _unusual(self, texts: pa.Array) -> np.ndarray:
        found = pc.match_substring_regex(texts, UNUSUAL)
        for string in self.special:
            found = pc.or_(found, pc.match_substring(texts, string))
        return found.to_numpy(zero_copy_only=False)

    def _side_by_side(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their number by word, for words that are one white space with something behind."""
        cuts = list(range(0, len(words), WORDS_A_TEXT))
        groups = pa.ListArray.from_arrays(pa.array([*cuts, len(words)], pa.int32()), words)
        found = [np.zeros(0, "<u4"), *self._encoded(pc.binary_join(groups, "").to_pylist())]
        ids = np.concatenate(found)
        ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)
        reached = np.cumsum(self.bytes_of_ids[ids])
        places = np.searchsorted(reached, ends, side="right")
        if len(ends) and not np.array_equal(reached[places - 1], ends):
            return None  # ids that stand for other bytes than the words': not such a vocabulary
        return ids, np.diff(places, prepend=0)

    def _learned(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number by word. Marked words are led by a line end, others by their space."""
        led = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise(pa.scalar(" "), words, ""))
        bare = pc.equal(pc.binary_length(led), 1).to_numpy(zero_copy_only=False)
        if self.bytes_of_ids is not None and not bare.any():
            found = self._side_by_side(led)
            if found:
                return found
        each = list(self._encoded(led.to_pylist()))
        return np.concatenate([np.zeros(0, "<u4"), *each]), np.fromiter(map(len, each), np.int64, len(each))

    def _ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, sizes): where the ids of each of these distinct words lie."""
        place = pc.index_in(words, value_set=self.words)
        new = place.is_null().to_numpy(zero_copy_only=False)
        bare = pc.is_in(words, value_set=pa.array(["", "\n"])).to_numpy(zero_copy_only=False)
        ids, sizes = [self.ids], [self.sizes]
        at = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        known = len(self.words)
        for some in (np.flatnonzero(new & ~bare), np.flatnonzero(new & bare)):
            if len(some):
                more, lengths = self._learned(words.take(pa.array(some)))
                at[some] = sum(map(len, sizes)) + np.arange(len(some))
                ids.append(more)
                sizes.append(lengths)
        all_ids, all_sizes = np.concatenate(ids), np.concatenate(sizes)
        if known + int(new.sum()) <= ENCODED_WORDS:
            order = np.flatnonzero(new)[np.argsort(at[new], kind="stable")]
            self.words = pa.concat_arrays([self.words, words.take(pa.array(order))])
            self.ids, self.sizes = all_ids, all_sizes
        begins = np.cumsum(all_sizes) - all_sizes
        return all_ids, begins[at] if len(at) else begins[:0], all_sizes[at] if len(at) else all_sizes[:0]

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # A line end before the text marks its first word, which has no space; it is taken off again.
        marked = pc.binary_join_element_wise(pa.scalar("\n"), pc.replace_substring(texts, "\n", " \n"), "")
        split = pc.split_pattern(marked, " ")
        coded = split.flatten().dictionary_encode()
        ids, word_begins, word_sizes = self._ids_of(coded.dictionary)
        which = coded.indices.to_numpy(zero_copy_only=False)
        lengths, begins = word_sizes[which], word_begins[which]
        ends = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))
        first = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        lengths[first] -= 1
        begins[first] += 1
        counts = np.add.reduceat(lengths, first) if len(first) else np.zeros(0, np.int64)
        return _gathered(ids, begins, lengths), counts

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        odd = self._unusual(texts)
        found: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        usual = np.flatnonzero(~odd)
        if len(usual):
            flat, counts = self._by_words(texts.take(pa.array(usual)) if odd.any() else texts)
            for k, ids in zip(usual, np.split(flat, np.cumsum(counts)[:-1])):
                found[k] = ids
        whole = np.flatnonzero(odd)
        for k, ids in zip(whole, self._encoded([texts[int(k)].as_py() for k in whole])):
            found[k] = ids
        return found
